"""CSV sources: the six tables named by file stem, read with explicit schemas."""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import schema as S

log = logging.getLogger(__name__)

ORDER_COLUMN = "_ROW_ORDER"


def table_name_from_file(path: str) -> str:
    """File stem, '.csv' removed (either case), upper-cased."""
    base = os.path.basename(path)
    return re.sub(r"\.csv$", "", base, flags=re.IGNORECASE).upper()


def missing_tables(tables: Iterable[str], expected: Iterable[str] = S.EXPECTED_TABLES) -> set[str]:
    return set(expected) - set(tables)


def expected_table_report(spark: SparkSession, tables: Iterable[str],
                          expected: Iterable[str] = S.EXPECTED_TABLES) -> DataFrame:
    """(TABLE_NAME, PRESENT) for every expected table: the load check as data."""
    have = set(tables)
    return spark.createDataFrame([(t, t in have) for t in expected], "TABLE_NAME string, PRESENT boolean")


#: Dialect of the files that are read and written: quotes doubled inside quoted fields, no trimming.
CSV_READ = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE", "enforceSchema": False}
CSV_WRITE = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "ignoreLeadingWhiteSpace": False,
             "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
#: Field contents that mean "no value" (fixed values, as data frame libraries read them).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
               "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
MONEY = T.DecimalType(24, 6)


def _text(column: str):
    """A field as text, null tokens as null."""
    c = F.col(f"`{column}`")
    return F.when(~c.isin(*NULL_TOKENS), c)


def _kinds(name: str) -> dict[str, T.DataType]:
    """Declared columns that are not text; money is read as an exact decimal."""
    known = S.TABLE_SCHEMAS.get(name)
    return {f.name: MONEY if isinstance(f.dataType, T.DoubleType) else f.dataType
            for f in (known.fields if known else ()) if not isinstance(f.dataType, T.StringType)}


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every column as text with null tokens read as null.  Files of one folder must have their
    columns in one order: Spark compares each file's header with the first and fails if not."""
    reader = spark.read.options(**CSV_READ).option("multiLine", multi_line)
    return reader.csv(path)


def read_csv_table(spark: SparkSession, path: str, name: str | None = None,
                   with_order: bool = True, multi_line: bool = False) -> DataFrame:
    """One table. Keys and dates are read as text; money as an exact decimal, null where the
    text is no number (``malformed_values`` counts those).

    ``with_order`` adds a file-order column (file, block, position) used to
    keep the *first* of duplicate primary keys.  ``multi_line`` reads fields
    with line breaks inside quotes (a file is then one task).
    """
    raw = read_csv_text(spark, path, multi_line)
    if with_order:
        raw = raw.withColumn(ORDER_COLUMN, F.struct(
            F.col("_metadata.file_path").alias("f"),
            F.col("_metadata.file_block_start").alias("b"),
            F.monotonically_increasing_id().alias("i")))
    return typed(raw, name or table_name_from_file(path))


def typed(raw: DataFrame, name: str) -> DataFrame:
    """Text columns of table ``name`` with null tokens as null and numbers as numbers."""
    kinds = _kinds(name)
    return raw.select(*[F.col(c) if c == ORDER_COLUMN else (_text(c).try_cast(kinds[c]) if c in kinds else _text(c)).alias(c)
                        for c in raw.columns])


def malformed_values(spark: SparkSession, path: str, name: str | None = None, multi_line: bool = False) -> DataFrame:
    """(TABLE_NAME, COLUMN_NAME, MALFORMED): values of declared number columns that are no number."""
    name = name or table_name_from_file(path)
    raw = read_csv_text(spark, path, multi_line)
    kinds = {c: k for c, k in _kinds(name).items() if c in raw.columns}
    if not kinds:
        return spark.createDataFrame([], "TABLE_NAME string, COLUMN_NAME string, MALFORMED long")
    row = raw.agg(*[F.count_if(_text(c).isNotNull() & _text(c).try_cast(k).isNull()).alias(c) for c, k in kinds.items()])
    return row.unpivot([], list(kinds), "COLUMN_NAME", "MALFORMED").select(F.lit(name).alias("TABLE_NAME"), "COLUMN_NAME", "MALFORMED")


def load_csv_tables(spark: SparkSession, folder: str, expected: Iterable[str] = S.EXPECTED_TABLES,
                    problems: dict[str, str] | None = None, multi_line: bool = False) -> dict[str, DataFrame] | None:
    """All expected tables from ``folder``; None when any is missing, unreadable or empty.
    ``problems`` is filled with the reason for each table that failed.

    Emptiness is checked with ``isEmpty`` (reads one row), not a count.
    """
    from ledgerflow.plans.materialize import list_names
    files = {table_name_from_file(f): f"{folder.rstrip('/')}/{f}"
             for f in list_names(spark, folder) if f.lower().endswith(".csv")}
    tables: dict[str, DataFrame] = {}
    problems = {} if problems is None else problems
    for name in expected:
        if name not in files:
            problems[name] = "no file of this name"
            continue
        try:
            df = read_csv_table(spark, files[name], name, multi_line=multi_line)
            if df.isEmpty():
                problems[name] = "no rows"
                continue
        except PySparkException as e:
            problems[name] = f"unreadable: {str(e).splitlines()[0]}"
            continue
        tables[name] = df
    for name, reason in problems.items():
        log.warning("table %s: %s", name, reason)
    return None if problems else tables


def choose_tables(tables: dict[str, DataFrame] | None, load: bool,
                  loader=None) -> dict[str, DataFrame] | None:
    """Given tables win; else load when asked; else nothing."""
    if tables is not None:
        return tables
    if load and loader is not None:
        return loader()
    return None

"""Cleaning operators: dedup, key repair, technical keys, null policy, dates.

Each operator is a pure DataFrame -> DataFrame function; each ``*_report``
returns a small DataFrame of counts computed in one aggregate pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.columns import normalise_numeric_key, parse_yyyymmdd, to_key
from ledgerflow.schema import is_date_like
from ledgerflow.session import looked_up
from ledgerflow.sources.csv_tables import ORDER_COLUMN


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ORDER_COLUMN]


# --- S1: full-row dedup -----------------------------------------------------

def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop repeated rows, keeping the first (nulls compare equal).

    Equal rows are interchangeable, so this is a plain ``distinct`` whose
    partial aggregation collapses copies before the shuffle.  With a file
    order column the earliest position survives.
    """
    cols = data_columns(df)
    if ORDER_COLUMN not in df.columns:
        return df.distinct()
    return df.groupBy(*cols).agg(F.min(ORDER_COLUMN).alias(ORDER_COLUMN)).select(df.columns)


def dedup_report(name: str, df: DataFrame, deduped: DataFrame | None = None) -> DataFrame:
    """(TABLE_NAME, ROWS_BEFORE, ROWS_AFTER, REMOVED).

    Given the deduplicated table (e.g. the stored one), this is two counting
    passes and no shuffle; otherwise one grouped pass over the input.  The
    two counts are combined by a conditional sum over their union (no join).
    """
    if deduped is None:
        grouped = df.groupBy(*data_columns(df)).count()
        counts = grouped.agg(F.sum("count").alias("ROWS_BEFORE"), F.count(F.lit(1)).alias("ROWS_AFTER"))
    else:
        both = (df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("before").alias("k"), "n")
                .unionByName(deduped.agg(F.count(F.lit(1)).alias("n")).select(F.lit("after").alias("k"), "n")))
        counts = both.agg(F.sum(F.when(F.col("k") == "before", F.col("n"))).alias("ROWS_BEFORE"),
                          F.sum(F.when(F.col("k") == "after", F.col("n"))).alias("ROWS_AFTER"))
    return counts.select(
        F.lit(name).alias("TABLE_NAME"),
        F.coalesce("ROWS_BEFORE", F.lit(0)).cast("long").alias("ROWS_BEFORE"),
        F.coalesce("ROWS_AFTER", F.lit(0)).cast("long").alias("ROWS_AFTER"),
        (F.coalesce("ROWS_BEFORE", F.lit(0)) - F.coalesce("ROWS_AFTER", F.lit(0))).cast("long").alias("REMOVED"))


# --- S2: primary keys -------------------------------------------------------

def repair_pk(df: DataFrame, pk_cols: Sequence[str]) -> DataFrame:
    """Each listed key in turn: cast to text, null keys dropped, one row kept per key.

    The kept row is the first in file order when the table carries one, else
    the smallest row (a defined tie-break; ``dropDuplicates`` would pick an
    arbitrary one).  Grouping by the key keeps its uniqueness visible to the
    optimizer, so unused lookups can be pruned from later joins.
    """
    for pk in pk_cols:
        if pk in df.columns:
            df = _one_row_per_key(df, pk)
    return df


def _one_row_per_key(df: DataFrame, pk: str) -> DataFrame:
    df = df.withColumn(pk, to_key(pk)).dropna(subset=[pk])
    others = [c for c in df.columns if c != pk]
    if not others:
        return df.distinct()
    row = F.struct(*others)
    if ORDER_COLUMN in df.columns:
        kept = F.min_by(row, F.col(ORDER_COLUMN))
    else:
        kept = F.min(row)
    return df.groupBy(pk).agg(kept.alias("_kept")).select(pk, "_kept.*").select(df.columns)


def pk_report(name: str, df: DataFrame, pk: str) -> DataFrame:
    """(TABLE, COLUMN, ROWS, NULL_KEYS, DUPLICATE_ROWS); duplicates counted
    after null keys are dropped."""
    if pk not in df.columns:
        return _missing_column_row(name, pk)
    per_key = df.groupBy(to_key(pk).alias("k")).count()
    return per_key.agg(
        F.sum("count").alias("ROWS"),
        F.sum(F.when(F.col("k").isNull(), F.col("count"))).alias("NULL_KEYS"),
        F.sum(F.when(F.col("k").isNotNull(), F.col("count") - 1)).alias("DUPLICATE_ROWS"),
    ).select(F.lit(name).alias("TABLE_NAME"), F.lit(pk).alias("COLUMN_NAME"),
             *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("ROWS", "NULL_KEYS", "DUPLICATE_ROWS")])


def _missing_column_row(name: str, column: str) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(name, column, None, None, None)],
                                 "TABLE_NAME string, COLUMN_NAME string, ROWS long, NULL_KEYS long, DUPLICATE_ROWS long")


# --- S3 / J3: foreign keys --------------------------------------------------

def parent_keys(parent: DataFrame, pk: str, as_name: str, normalise: bool = False) -> DataFrame:
    key = normalise_numeric_key(pk) if normalise else to_key(pk)
    return parent.select(key.alias(as_name)).where(F.col(as_name).isNotNull())


def repair_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str | None = None,
              normalise: bool = False, large: bool = False) -> DataFrame:
    """Null keys dropped, then rows whose key is absent from the parent
    (a semi join; the parent side is broadcast only if the planner's size
    check allows, never if it is said to be ``large``).  ``normalise`` compares all-digit keys without leading
    zeros on both sides (and stores the child key that way)."""
    pk = pk or fk
    if fk not in child.columns or pk not in parent.columns:
        return child
    if normalise:
        child = child.withColumn(fk, normalise_numeric_key(fk)).where(F.col(fk).isNotNull())
        return child.join(looked_up(parent_keys(parent, pk, fk, True), large), on=fk, how="left_semi").select(child.columns)
    child = child.withColumn(fk, to_key(fk)).where(F.col(fk).isNotNull())
    return child.join(looked_up(parent_keys(parent, pk, fk), large), on=fk, how="left_semi").select(child.columns)


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str | None = None, large: bool = False) -> DataFrame:
    """Distinct orphan key values with their row counts (a left anti join; a ``large`` parent is never broadcast)."""
    pk = pk or fk
    per_key = child.groupBy(to_key(fk).alias(fk)).agg(F.count(F.lit(1)).alias("ROWS"))
    return per_key.where(F.col(fk).isNotNull()).join(looked_up(parent_keys(parent, pk, fk), large), on=fk, how="left_anti")


def fk_report(child_name: str, child: DataFrame, fk: str, parent_name: str,
              parent: DataFrame, pk: str | None = None, large: bool = False) -> DataFrame:
    """(CHILD, FK, PARENT, ROWS, NULL_FK, ORPHAN_VALUES, ORPHAN_ROWS) in one pass
    over the child's key counts; a ``large`` parent is never broadcast."""
    pk = pk or fk
    if fk not in child.columns or pk not in parent.columns:         # a key that isn't there can't be checked
        return child.sparkSession.createDataFrame(
            [], "CHILD string, FK string, PARENT string, ROWS long, NULL_FK long, ORPHAN_VALUES long, ORPHAN_ROWS long")
    per_key = child.groupBy(to_key(fk).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    hits = parent_keys(parent, pk, "k").distinct().withColumn("_hit", F.lit(True))
    joined = per_key.join(looked_up(hits, large), on="k", how="left")
    orphan = F.col("k").isNotNull() & F.col("_hit").isNull()
    return joined.agg(
        F.sum("n").alias("ROWS"),
        F.sum(F.when(F.col("k").isNull(), F.col("n"))).alias("NULL_FK"),
        F.count_if(orphan).alias("ORPHAN_VALUES"),
        F.sum(F.when(orphan, F.col("n"))).alias("ORPHAN_ROWS"),
    ).select(F.lit(child_name).alias("CHILD"), F.lit(fk).alias("FK"), F.lit(parent_name).alias("PARENT"),
             *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
               for c in ("ROWS", "NULL_FK", "ORPHAN_VALUES", "ORPHAN_ROWS")])


# --- S4: technical keys -----------------------------------------------------

def cast_technical_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Technical keys cast to text; nulls reported, never removed."""
    present = [k for k in keys if k in df.columns]
    return df.withColumns({k: to_key(k) for k in present}) if present else df


def technical_key_report(name: str, df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """(TABLE, COLUMN, NULLS) per technical key present in the table."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "TABLE_NAME string, COLUMN_NAME string, NULLS long")
    row = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in present])
    return (row.unpivot([], present, "COLUMN_NAME", "NULLS")
            .select(F.lit(name).alias("TABLE_NAME"), "COLUMN_NAME", F.col("NULLS").cast("long").alias("NULLS")))


# --- S6 / S7 / S8: null policy ------------------------------------------------

def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(COLUMN, NULLS, POSITION) for every column with at least one null."""
    cols = list(columns or data_columns(df))
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return (row.unpivot([], cols, "COLUMN_NAME", "NULLS")
            .where(F.col("NULLS") > 0)
            .select("COLUMN_NAME", F.col("NULLS").cast("long").alias("NULLS"),
                    pos[F.col("COLUMN_NAME")].alias("POSITION")))


def _kind(df: DataFrame, col: str, dates: Sequence[str], critical: Sequence[str],
          derived: Sequence[str]) -> str:
    if col in derived:
        return "DERIVED"
    if col in dates:
        return "DATE"
    if col in critical:
        return "CRITICAL"
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        return "TEXT"
    if isinstance(dtype, T.NumericType):
        return "NUMERIC"
    return "OTHER"


_DROP_KINDS = {"DATE", "CRITICAL"}
_LEVEL = {"DERIVED": "ERROR", "DATE": "ERROR", "CRITICAL": "ERROR"}


def apply_null_policy(df: DataFrame, dates: Sequence[str], critical: Sequence[str]) -> DataFrame:
    """Rows with a null date or critical value are dropped; others stay."""
    drop = [c for c in data_columns(df) if c in set(dates) | set(critical)]
    return df.dropna(subset=drop) if drop else df


def null_policy_counts(df: DataFrame, dates: Sequence[str], critical: Sequence[str], derived: Sequence[str] = (),
                       alive: Column | None = None, values: dict[str, Column] | None = None) -> tuple[dict[str, Column], dict[str, str]]:
    """({column: its nulls among the rows that earlier columns leave, starting from ``alive``}, {column: kind}).
    ``values`` may give a column's value as an expression over the rows that are counted."""
    cols = data_columns(df)
    kinds = {c: _kind(df, c, dates, critical, derived) for c in cols}
    counts, alive = {}, F.lit(True) if alive is None else alive
    for c in cols:
        value = (values or {}).get(c, F.col(c))
        counts[c] = F.count_if(alive & value.isNull())
        if kinds[c] in _DROP_KINDS:
            alive = alive & value.isNotNull()
    return counts, kinds


def policy_of(kind: str) -> tuple[str, str]:
    """(ACTION, LEVEL) of a kind of column that has nulls."""
    return "DROP" if kind in _DROP_KINDS else "KEEP", _LEVEL.get(kind, "WARNING")


def null_policy_report(name: str, df: DataFrame, dates: Sequence[str], critical: Sequence[str],
                       derived: Sequence[str] = ()) -> DataFrame:
    """(TABLE, COLUMN, KIND, NULLS, ACTION, LEVEL) with the sequential rule:
    columns are visited in order and each count is taken over the rows that
    survive the drops of earlier columns.  One aggregate pass."""
    counts, kinds = null_policy_counts(df, dates, critical, derived)
    cols = list(counts)
    row = df.agg(*[n.alias(c) for c, n in counts.items()])
    kind_map = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(kinds[c]))])
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    kind = kind_map[F.col("COLUMN_NAME")]
    return (row.unpivot([], cols, "COLUMN_NAME", "NULLS").where(F.col("NULLS") > 0)
            .select(F.lit(name).alias("TABLE_NAME"), "COLUMN_NAME", kind.alias("KIND"),
                    F.col("NULLS").cast("long").alias("NULLS"),
                    F.when(kind.isin(*_DROP_KINDS), "DROP").otherwise("KEEP").alias("ACTION"),
                    F.when(kind.isin(*_LEVEL), "ERROR").otherwise("WARNING").alias("LEVEL"),
                    pos[F.col("COLUMN_NAME")].alias("POSITION")))


# --- S9 / S10: dates ----------------------------------------------------------

def date_columns(df: DataFrame) -> list[str]:
    return [c for c in data_columns(df) if is_date_like(c)]


def date_shapes(c: str) -> tuple[Column, Column]:
    """(whether a value has eight digits, whether it is such a date after 2262)."""
    txt = F.trim(F.col(c).cast("string"))
    eight = txt.rlike(r"^\d{8}$")
    return eight, eight & (F.substring(txt, 1, 4).try_cast("int") > 2262)


def date_profile(name: str, df: DataFrame, columns: Sequence[str] | None = None,
                 examples: int = 5) -> DataFrame:
    """(TABLE, COLUMN, N_8_DIGITS, N_OTHER, N_YEAR_GT_2262, EXAMPLES).

    Counts come from one aggregate; the examples are the smallest distinct
    far-future values, found with a per-column top-k whose partial limit
    runs before the shuffle (bounded per task).
    """
    cols = list(columns if columns is not None else date_columns(df))
    if not cols:
        return None
    txt = {c: F.trim(F.col(c).cast("string")) for c in cols}
    eight, far = ({c: date_shapes(c)[k] for c in cols} for k in (0, 1))
    counts = df.agg(*[e for c in cols for e in (
        F.count_if(eight[c]).alias(f"{c}__8"),
        F.count(F.lit(1)).alias(f"{c}__n"),
        F.count_if(far[c]).alias(f"{c}__far"))])
    counts = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(f"{c}__8").cast("long").alias("N_8_DIGITS"),
                 (F.col(f"{c}__n") - F.col(f"{c}__8")).cast("long").alias("N_OTHER"),
                 F.col(f"{c}__far").cast("long").alias("N_YEAR_GT_2262"))
        for c in cols])).alias("r")).select("r.*")

    values = df.select(F.explode(F.array(*[
        F.when(far[c], F.struct(F.lit(c).alias("COLUMN_NAME"), txt[c].alias("V"))) for c in cols
    ])).alias("r")).where(F.col("r").isNotNull()).select("r.*").distinct()
    from pyspark.sql import Window
    w = Window.partitionBy("COLUMN_NAME").orderBy("V")
    smallest = (values.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= examples)
                .groupBy("COLUMN_NAME")
                .agg(F.array_join(F.array_sort(F.collect_list("V")), ",").alias("EXAMPLES")))
    return (counts.join(smallest, on="COLUMN_NAME", how="left")
            .select(F.lit(name).alias("TABLE_NAME"), "COLUMN_NAME", "N_8_DIGITS", "N_OTHER", "N_YEAR_GT_2262",
                    "EXAMPLES"))


def normalise_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """YYYYMMDD (or ISO) text to DateType; unparseable values become null."""
    cols = [c for c in (columns if columns is not None else date_columns(df)) if c in df.columns]
    return df.withColumns({c: to_date(df, c) for c in cols}) if cols else df


def to_date(df: DataFrame, c: str) -> Column:
    dtype = df.schema[c].dataType
    if isinstance(dtype, T.DateType):
        return F.col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col(c).cast("date")
    return parse_yyyymmdd(c)

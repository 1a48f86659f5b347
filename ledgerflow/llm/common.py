"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.session import checkpoint_dir

#: Rows that a Python function gets at a time: what it builds beside an Arrow batch stays small.
SLICE_ROWS = 512
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and a
    lost executor costs a re-read of files, not a recomputation."""
    path = f"{checkpoint_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; null counts as empty.  Pure ASCII texts take the
    byte-wise ``lower``, which is the same mapping there."""
    text = F.coalesce(col.cast("string"), F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, UPPER.lower()))


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of an id written as text, modulo ``n``."""
    return F.crc32(col.cast("string").cast("binary")) % n


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def arrow_column(df: DataFrame, source: str, out: str, kind: T.DataType,
                 make: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """``df`` with column ``out`` computed batch by batch from ``source``; a column
    of that name is replaced.  ``make`` builds the function once per task."""
    at = df.columns.index(source)
    keep = [k for k, c in enumerate(df.columns) if c != out]
    schema = T.StructType([*(df.schema.fields[k] for k in keep), T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), of(batch.column(at))], schema.names)

    # mapInArrow looks its input columns up by name, where a dot would be read as a field
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(run, schema)

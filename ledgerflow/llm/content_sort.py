"""Exact dedup by content sort.

Rows are range-partitioned on sampled splitters of (first bytes, 64-bit hash,
id) and sorted inside each partition by (first bytes, hash, whole normalised
text, id), so equal texts lie next to each other and neighbours are compared
in full.  The id in the splitters lets one text that holds a third of all rows
span many partitions; only the first and last run of a partition can continue
in another one, and those two texts per partition are compared across
partitions afterwards.  Splitters carry a bounded number of bytes per row;
equality always rests on the whole text.

Defined results: a null text counts as empty, all empty texts are one group;
rows repeated with the same id count in the group size and exactly one of them
is kept; a null id never wins over another id (a group of null ids only keeps
one row, with a null ``keep_id``); an empty table gives an empty result; other
columns are ignored by ``content_groups`` and kept as they are by
``drop_copies``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerflow.llm.common import ascii_lower, free_name, sliced, stored

#: Bytes of the text that a splitter may carry.
SPLITTER_BYTES = 24
CHUNK_ROWS = 4096

_RUNS = ("doc_id long, part int, run long, group_size long, low long, high long, is_low boolean, "
         "is_high boolean, is_edge boolean, text_sha256 string, edge_text binary")


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        texts = [(t or "").encode().lower() for t in batch.column(1).to_pylist()]   # bytes.lower: A-Z only
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([t[:SPLITTER_BYTES] for t in texts], pa.binary()),
             pa.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts], pa.int64()),
             pa.array(texts, pa.binary())], ["doc_id", "head", "hash", "norm"])


class _Out:
    """Rows of finished runs, handed on in chunks."""

    def __init__(self, part: int):
        self.part, self.rows = part, []

    def run(self, number: int, ids: list, text: bytes, edge: bool) -> None:
        known = [i for i in ids if i is not None]      # sorted, nulls come first
        low, high = (known[0], known[-1]) if known else (None, None)
        first, digest = len(ids) - len(known) if known else 0, hashlib.sha256(text).hexdigest()
        for k, i in enumerate(ids):
            self.rows.append((i, self.part, number, len(ids), low, high, k == first, k == len(ids) - 1,
                              edge, digest, text if edge and k == 0 else None))

    def batches(self, all_of_them: bool = False) -> Iterator[pa.RecordBatch]:
        full = len(self.rows) if all_of_them else len(self.rows) // CHUNK_ROWS * CHUNK_ROWS
        ready, self.rows = self.rows[:full], self.rows[full:]
        for k in range(0, full, CHUNK_ROWS):
            now = ready[k:k + CHUNK_ROWS]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(),
                     pa.bool_(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*now), types)],
                                             [c.split()[0] for c in _RUNS.split(", ")])


def _adjacent_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring full comparison over one sorted partition; one run at a time."""
    out = _Out(TaskContext.get().partitionId())
    text, ids, number = None, [], 0
    for batch in sliced(batches):
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if t == text:
                ids.append(i)
                continue
            if text is not None:
                out.run(number, ids, text, edge=number == 0)
                number += 1
                yield from out.batches()
            text, ids = t, [i]
    if text is not None:
        out.run(number, ids, text, edge=True)
    yield from out.batches(all_of_them=True)


def content_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep: str = "smallest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` says which id of equal texts (after lower-casing A-Z) stays:
    ``smallest`` or ``largest``.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    norm = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_normalise, "doc_id long, head binary, hash long, norm binary")
    runs = stored(norm.repartitionByRange("head", "hash", "doc_id")
                  .sortWithinPartitions("head", "hash", "norm", "doc_id")
                  .select("doc_id", "norm").mapInArrow(_adjacent_runs, _RUNS), "content-runs")
    pick, id_of, is_keeper = (F.min, "low", "is_low") if keep == "smallest" else (F.max, "high", "is_high")
    across = Window.partitionBy("edge_text")
    edges = runs.filter(F.col("edge_text").isNotNull()).select(
        F.col("part").alias("e_part"), F.col("run").alias("e_run"),
        pick(id_of).over(across).alias("e_keep"), F.sum("group_size").over(across).alias("e_size"))
    joined = runs.join(edges, (runs.part == edges.e_part) & (runs.run == edges.e_run), "left")
    keep_id = F.when(F.col("is_edge"), F.col("e_keep")).otherwise(F.col(id_of))
    return joined.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("e_size", "group_size").alias("group_size"),
        (F.col(is_keeper) & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` without the copies: every column as it was, one row of each equal text."""
    def key(i, sha):
        return F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("null")), sha)

    name, number = free_name(docs, "__key"), free_name(docs, "__n")
    stays = content_groups(docs, id_col, text_col, keep).filter("kept") \
        .select(key(F.col("doc_id"), F.col("text_sha256")).alias(name))
    keyed = docs.withColumn(name, key(F.col(id_col), F.sha2(ascii_lower(F.col(text_col)).cast("binary"), 256)))
    one = Window.partitionBy(name).orderBy(F.lit(0))
    return keyed.join(stays, name, "left_semi").withColumn(number, F.row_number().over(one)) \
        .filter(F.col(number) == 1).drop(name, number)

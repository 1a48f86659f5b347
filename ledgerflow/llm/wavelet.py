"""Token ids in wavelet-matrix shards.

Documents are range-partitioned and sorted by id; each task encodes its texts
and closes a shard at the first document that ends beyond ``SHARD_TOKENS`` ids.
A shard is one self-contained compressed file: document ids and ends, then one
bit plane per bit of an id, each with a rank directory.  Without decoding the
whole, it answers ``access`` (the id at a place), ``count`` and ``rank`` (how
often an id occurs), ``select`` and ``occurrences`` (where).  Spark writes and
commits the files (a Parquet row each), so any store it can write will do and a
lost executor costs a task.

Encoding is that of the tokenizers library, for byte-level BPE with the usual
split into words, numbers and signs.  Texts of Latin letters without a control
string are encoded whole by tiktoken with the ranks of the same file, if the
file's merges are in the order of its ids (checked).  In all others, a blank that
follows a visible character always starts a new unit of byte-level BPE, so units
between such blanks are encoded once and remembered, Latin ones by tiktoken and
the rest by the tokenizers library; a text with other runs of white space is
encoded whole by that.

Defined results: a null text is empty, an empty text is the end id alone; null
document ids sort first; rows repeat as they come (same id: in text order);
an empty table gives no shard.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerflow.llm.token_align import _byte_of_char
from ledgerflow.session import checkpoint_dir

SHARD_TOKENS = 1 << 20
#: Bits to one entry of a rank directory.
BLOCK = 2048
#: Units a worker remembers before it starts anew; new units that are encoded as one text.
REMEMBER, TOGETHER = 600_000, 500
#: Letters up to here are letters for every version of Unicode.
LATIN_END = "\u0250"
_FAR = re.compile(f"[{LATIN_END}-\U0010ffff]")
MAGIC = b"WMX1"
_HEAD = struct.Struct("<4sBQQ")
_PLANE = struct.Struct("<QI")


class WaveletMatrix:
    """A sequence of integers below ``2 ** width`` as bit planes with rank and select."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.width, self.planes, self.zeros, self.ranks = n, len(planes), planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        planes, zeros, ranks = [], [], []
        kind = np.uint16 if width <= 16 else np.uint32
        now = ids.astype(kind)
        for level in range(width):
            bit = (now & kind(1 << (width - 1 - level))) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(packed)
            zeros.append(int(len(now) - bit.sum()))
            ranks.append(cls._directory(packed))
            now = np.concatenate([np.compress(~bit, now), np.compress(bit, now)])
        return cls(len(ids), planes, zeros, ranks)

    @staticmethod
    def _directory(packed: np.ndarray) -> np.ndarray:
        per = BLOCK // 8
        ones = np.bitwise_count(np.pad(packed, (0, -len(packed) % per))).reshape(-1, per).sum(1)
        return np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits."""
        block, plane = i // BLOCK, self.planes[level]
        got = int(self.ranks[level][block]) + int(np.bitwise_count(plane[block * (BLOCK // 8):i >> 3]).sum())
        return got + (int(plane[i >> 3] & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else 0)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) such bit."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.planes[level][block * (BLOCK // 8):(block + 1) * (BLOCK // 8)], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        got = 0
        for level in range(self.width):
            bit, one = self._bit(level, i), self._rank1(level, i)
            i = self.zeros[level] + one if bit else i - one
            got = got << 1 | bit
        return got

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        if value < 0 or value >> self.width:
            return 0, 0
        for level in range(self.width):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if value >> (self.width - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def rank(self, value: int, i: int) -> int:
        return self.count(value, 0, i)

    def select(self, value: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence."""
        a, b = self._range(value, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        place = a + k
        for level in range(self.width - 1, -1, -1):
            bit = value >> (self.width - 1 - level) & 1
            place = self._select(level, bit, place - self.zeros[level] if bit else place)
        return place

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def ids(self) -> np.ndarray:
        """The whole sequence: planes undone from the last to the first."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for level in range(self.width - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            now = np.empty_like(out)
            now[np.flatnonzero(~bit)] = out[:self.zeros[level]]
            now[np.flatnonzero(bit)] = out[self.zeros[level]:] | kind(1 << (self.width - 1 - level))
            out = now
        return out.astype(np.uint32)


class Shard:
    """Documents and their ids: the content of one file."""

    def __init__(self, doc_ids: list[int | None], ends: np.ndarray, matrix: WaveletMatrix):
        self.doc_ids, self.ends, self.matrix = doc_ids, ends, matrix

    @classmethod
    def build(cls, doc_ids: list[int | None], ids: list[bytes], width: int) -> Shard:
        ends = np.cumsum([len(i) // 4 for i in ids]).astype(np.uint64)
        return cls(doc_ids, ends, WaveletMatrix.build(np.frombuffer(b"".join(ids), "<u4"), width))

    def to_bytes(self) -> bytes:
        z = zstandard.ZstdCompressor(level=3)
        m = self.matrix
        known = np.array([i is not None for i in self.doc_ids], np.uint8)
        docs = z.compress(np.array([i or 0 for i in self.doc_ids], "<i8").tobytes() + known.tobytes() + self.ends.astype("<u8").tobytes())
        parts = [_HEAD.pack(MAGIC, m.width, m.n, len(self.doc_ids)), struct.pack("<I", len(docs)), docs]
        for plane, zeros, ranks in zip(m.planes, m.zeros, m.ranks):
            data = z.compress(ranks.astype("<u4").tobytes() + plane.tobytes())
            parts += [_PLANE.pack(zeros, len(data)), data]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        magic, width, n, n_docs = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet-matrix shard")
        z, at = zstandard.ZstdDecompressor(), _HEAD.size
        size, = struct.unpack_from("<I", data, at)
        docs = z.decompress(data[at + 4:at + 4 + size])
        at += 4 + size
        known = docs[8 * n_docs:9 * n_docs]
        ids = [i if k else None for i, k in zip(np.frombuffer(docs, "<i8", n_docs).tolist(), known)]
        ends = np.frombuffer(docs, "<u8", n_docs, 9 * n_docs)
        planes, zeros, ranks = [], [], []
        blocks = -(-((n + 7) // 8) // (BLOCK // 8)) + 1
        for _ in range(width):
            zero, size = _PLANE.unpack_from(data, at)
            raw = np.frombuffer(z.decompress(data[at + _PLANE.size:at + _PLANE.size + size]), np.uint8)
            at += _PLANE.size + size
            zeros.append(zero)
            ranks.append(raw[:4 * blocks].view("<u4"))
            planes.append(raw[4 * blocks:])
        return cls(ids, ends, WaveletMatrix(n, planes, zeros, ranks))


def _ranked(tokenizer_json: str):
    """tiktoken's encoder with the ranks of a byte-level BPE file; None if the file's merges
    aren't in the order of its ids or it does more than byte-level BPE."""
    import public_tokenizers
    import tiktoken

    config = json.loads(tokenizer_json)
    vocabulary, pre = config["model"]["vocab"], config.get("pre_tokenizer") or {}
    results = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in config["model"]["merges"]]
    if results != sorted(results) or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
            or pre.get("add_prefix_space") or config.get("normalizer"):
        return None
    chars = _byte_of_char()
    control = {t["content"] for t in config.get("added_tokens", ())}
    ranks = {bytes(chars[c] for c in t): i for t, i in vocabulary.items() if t not in control and all(c in chars for c in t)}
    return tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class UnitEncoder:
    """Exact ids of whole texts with the tokenizers library; units remembered."""

    def __init__(self, tokenizer_json: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.end = np.array([end_id], "<u4").tobytes()
        self.known: dict[str, bytes | None] = {}          # units behind a blank; None: not a unit
        self.pauses = {c: self._ids(c) for c in ",.;:!?"}
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)          # bytes of each id
        self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]   # a character stands for a byte
        control = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.control = re.compile("|".join(map(re.escape, control))) if control else None
        self.ranked = _ranked(tokenizer_json)
        self.joins = not any(c.isspace() for t in self.tokenizer.get_added_tokens_decoder().values() for c in t.content)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, units: set[str]) -> None:
        if len(self.known) + len(units) > REMEMBER:
            self.known.clear()
        unseen = units.difference(self.known)
        # an empty unit or one that ends in white space is part of a run of white space
        runs = [u for u in unseen if not u or u[-1].isspace()]
        self.known.update(dict.fromkeys(runs))
        # a pause behind a letter is a piece of its own: the word without it is encoded once
        stems = {u: u[:-1] for u in unseen if len(u) > 1 and u[-1] in self.pauses and u[-2].isalpha() and u[-2] < LATIN_END}
        new = [u for u in unseen.difference(runs).union(stems.values()) if u not in stems and u not in self.known]
        near = [u for u in new if self._is_near(u)] if self.ranked else []
        self._fill(near, self.ranked.encode_ordinary if near else None)
        self._fill([u for u in new if u not in self.known] if near else new, self._whole)
        for u in sorted(stems, key=len):
            self.known[u] = self.known[stems[u]] + self.pauses[u[-1]]

    def _is_near(self, text: str) -> bool:
        return not _FAR.search(text) and not (self.control and self.control.search(text))

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _fill(self, units: list[str], encode: Callable[[str], list[int]]) -> None:
        for k in range(0, len(units), TOGETHER):
            some = units[k:k + TOGETHER]
            self.known.update(zip(some, self._together(some, encode)))

    def _together(self, units: list[str], encode: Callable[[str], list[int]]) -> list[bytes]:
        """Ids of units, encoded as one text and cut where the bytes of the ids reach each unit's end."""
        behind = [" " + u for u in units]
        if self.joins:
            ids = np.array(encode("".join(behind)), "<u4")
            reached = np.cumsum(self.sizes[ids])
            ends = np.cumsum([len(u.encode()) for u in behind])
            cuts = np.searchsorted(reached, ends)
            if len(ids) and cuts[-1] == len(ids) - 1 and (reached[cuts] == ends).all():
                data, cuts = ids.tobytes(), [0, *(4 * (cuts + 1)).tolist()]
                return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(behind, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out, split = [], []
        for k, t in enumerate(texts):
            if self.ranked and self._is_near(t or ""):
                out.append(array("I", self.ranked.encode_ordinary(t or "")).tobytes() + self.end)
                continue
            first, blank, rest = (t or "").partition(" ")
            split.append((k, first, rest.split(" ") if blank else []))
            out.append(b"")
        self._learn(set().union(*(rest for _, _, rest in split)))
        for k, first, rest in split:
            out[k] = self._one(texts[k], first, rest)
        return out

    def _one(self, text: str | None, first: str, rest: list[str]) -> bytes:
        if rest and (not first or first[-1].isspace()):
            return self._ids(text) + self.end
        try:
            tail = b"".join(map(self.known.__getitem__, rest))
        except TypeError:                                  # a run of white space: no units here
            return self._ids(text) + self.end
        return (self._ids(first) if first else b"") + tail + self.end


@lru_cache(maxsize=2)
def unit_encoder(tokenizer_json: str, end_id: int) -> UnitEncoder:
    """One for each worker process, so that later tasks find the units of earlier ones."""
    return UnitEncoder(tokenizer_json, end_id)


def write_shards(df: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> str:
    """Encode every whole text, end it with ``end_id`` and write the shards, one file each, in
    ascending document order.  Returns the folder: ``path``, or a new one in the shared folder."""
    with open(tokenizer_path, encoding="utf-8") as f:        # a tokenizer file beside the driver, 1.5 MB
        tokenizer_json = f.read()
    from tokenizers import Tokenizer
    width = max(max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1) - 1, 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = unit_encoder(tokenizer_json, end_id), TaskContext.get().partitionId()
        docs, ids, size, before, number = [], [], 0, 0, 0

        def shard() -> pa.RecordBatch:
            row = {"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                   "before": pa.array([before], pa.int64()), "n_tokens": pa.array([size], pa.int64()),
                   "shard": pa.array([Shard.build(docs, ids, width).to_bytes()], pa.binary())}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                for i, one in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist())):
                    docs.append(i)
                    ids.append(one)
                    size += len(one) // 4
                    if size >= shard_tokens:
                        yield shard()
                        before, number = before + size, number + 1
                        docs, ids, size = [], [], 0
        if docs:
            yield shard()

    path = path or f"{checkpoint_dir(df.sparkSession)}/llm-wavelet-{uuid.uuid4().hex}"
    df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text") \
        .mapInArrow(run, "part int, number int, before long, n_tokens long, shard binary") \
        .write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(path)
    return path


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the shards."""
    shards = spark.read.schema("part int, number int, before long, n_tokens long, shard binary").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                shard = Shard.from_bytes(data.as_py())
                ids, ends = shard.matrix.ids().astype("<u4"), shard.ends.tolist()
                starts = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array([part] * len(ends), pa.int32()),
                     pa.array([before + s for s in starts], pa.int64()),
                     pa.array([e - s for s, e in zip(starts, ends)], pa.int64()),
                     pa.array([zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends)], pa.int64())],
                    ["doc_id", "part", "offset", "n_tokens", "ids_crc32"])

    docs = shards.select("part", "before", "shard").mapInArrow(
        run, "doc_id long, part int, offset long, n_tokens long, ids_crc32 long")
    # one row per writing task
    parts = shards.groupBy(F.col("part").alias("p")).agg(F.sum("n_tokens").alias("size"))
    base = parts.select("p", F.coalesce(F.sum("size").over(
        Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return docs.join(base, F.col("part") == F.col("p")).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")

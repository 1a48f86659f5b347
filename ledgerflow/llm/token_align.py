"""Alignment of two tokenizers by merge path, and corpus-wide counts of linked ids.

A document is read as one blank and its text.  A is a byte-level BPE file of the
tokenizers library, B a merge-type SentencePiece model that adds the blank
itself.  Every token covers a range of bytes; offsets where a token of A and one
of B both end cut the tokens into groups, and tokens whose ranges overlap are
linked.

The ends of A and of B are two sorted sequences.  Merging them gives the groups
and the links, one link for each different end.  Binary searches along diagonals
divide that merge into pieces of ``PIECE_WORK`` ends each, whatever the lengths of
the documents; a piece is merged by itself, and pieces are stitched: an end that
two pieces share is emitted once, and groups go on across the cut.

Documents are gathered into blocks of about ``BLOCK_LINKS`` links.  A block names
its different id pairs once, so what Spark counts, joins and shuffles is (block,
pair), not (document, pair); a pair that stands in every document is one row a
block.  Counts cover all documents.

Encoding remembers the units between blanks.  That is exact: a blank between two
visible characters starts a unit of byte-level BPE, and no piece of B has the
space mark behind another character (checked).  Units of Latin letters are
encoded by tiktoken with the ranks of the same file, if the file's merges are in
the order of its ids (checked); all others by the tokenizers library.

Defined results: null and empty texts, and texts whose bytes the joined tokens do
not give back (a U+2581 inside), have no tokens: zeros and an empty digest.
Control strings inside texts are plain text.  A row without an id is a document
like others; rows repeat as they come, each counts; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import stored

#: Ends that one piece of a merge covers; links of a block of documents.
PIECE_WORK, BLOCK_LINKS = 1 << 15, 1 << 21
#: Units a worker remembers before it starts anew; documents that are split into units at a time.
REMEMBER, TOGETHER = 200_000, 64
#: Characters up to here are letters, or not, for every version of Unicode.
LATIN_END = "ɐ"
SPACE = "▁"
_RUN = re.compile(r" \s|\s ")
_CUT = re.compile(r"(?<=\S) (?=\S)")

_BLOCK = ("block long, pairs array<long>, in_docs array<long>, doc_ids array<long>, n_a array<long>, n_b array<long>, "
          "n_groups array<long>, n_links array<long>, digests array<string>, n_pairs array<long>, links binary")
_REPORT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


# -- merge path -------------------------------------------------------------------

def diagonals(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first ``at`` ends of the merge (on a tie a comes first)."""
    low, high = np.maximum(at - len(b), 0), np.minimum(at, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high) >> 1
        take = a[np.where(open_, mid, 0)] <= b[np.where(open_, at - 1 - mid, 0)]
        low = np.where(open_ & take, mid + 1, low)
        high = np.where(open_ & ~take, mid, high)


def merge_pieces(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the merge of two rising sequences of ends that close with one common end:
    (token of a, token of b, whether both end there) for every different end."""
    at = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    of_a = diagonals(a, b, at)
    of_b = at - of_a
    before = -1
    for i, j, m, n in zip(of_a[:-1], of_a[1:], of_b[:-1], of_b[1:]):
        ours, theirs = a[i:j], b[m:n]
        ends = np.concatenate([ours, theirs])
        ends.sort(kind="stable")
        fresh = np.empty(len(ends), bool)
        fresh[0], fresh[1:] = ends[0] != before, ends[1:] != ends[:-1]     # the piece before may have had the first
        before = ends[-1]
        ends = ends[fresh]
        x, y = i + np.searchsorted(ours, ends), m + np.searchsorted(theirs, ends)
        yield x, y, (a[x] == ends) & (b[y] == ends)


def overlaps(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b, group) of every link, pieces stitched."""
    xs, ys, groups, done = [], [], [], 0
    for x, y, both in merge_pieces(a, b, work):
        closed = np.cumsum(both)
        xs.append(x)
        ys.append(y)
        groups.append(done + closed - both)
        done += int(closed[-1]) if len(closed) else 0
    return np.concatenate(xs), np.concatenate(ys), np.concatenate(groups)


# -- tokens -----------------------------------------------------------------------

def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabets write printable bytes as themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokens:
    """Ids of A and B for units of text."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        import sentencepiece
        import tiktoken
        from sentencepiece import sentencepiece_model_pb2 as pb
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        config = json.loads(a_json)
        chars = _byte_of_char()
        vocabulary = config["model"]["vocab"]
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in config["model"]["merges"]]
        results = [vocabulary[x + y] for x, y in merges]
        pre = config.get("pre_tokenizer") or {}
        self.ranked = None
        if results == sorted(results) and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) \
                and not pre.get("add_prefix_space") and not config.get("normalizer"):
            import public_tokenizers
            ranks = {self.a_bytes[i]: i for t, i in vocabulary.items() if all(c in chars for c in t) and self.a_bytes[i]}
            special = {t["content"] for t in config.get("added_tokens", ())}
            ranks = {k: i for k, i in ranks.items() if k.decode("utf-8", "replace") not in special}
            self.ranked = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        proto = pb.ModelProto()
        proto.ParseFromString(b_model)
        kind = pb.ModelProto.SentencePiece
        if any(re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in proto.pieces if p.type == kind.NORMAL):
            raise ValueError("a piece goes across a blank: units can't be encoded alone")
        if proto.normalizer_spec.remove_extra_whitespaces or not proto.normalizer_spec.add_dummy_prefix:
            raise ValueError("the model must add a blank and keep the text's own")
        self.b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else
                        p.piece.replace(SPACE, " ").encode() if p.type == kind.NORMAL else b"" for p in proto.pieces]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.b_bits = max(len(self.b_bytes) - 1, 1).bit_length()
        self.pair_bits = self.b_bits + max(len(self.a_bytes) - 1, 1).bit_length()
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.digits = [_digit_table(len(t)) for t in (self.a_bytes, self.b_bytes)]

    def _a_ids(self, text: str) -> list[int]:
        if self.ranked is not None and max(text) < LATIN_END:
            return self.ranked.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _learn(self, units: set[str]) -> None:
        new = list(units.difference(self.known))
        if len(self.known) + len(new) > REMEMBER:
            self.known.clear()
            new = list(units)
        for u, b in zip(new, self.b.encode(new, num_threads=1) if new else ()):
            a, whole = self._a_ids(" " + u), (" " + u).encode()
            same = b"".join([self.a_bytes[i] for i in a]) == whole and b"".join([self.b_bytes[i] for i in b]) == whole
            self.known[u] = (np.array(a, np.int32).tobytes(), np.array(b, np.int32).tobytes()) if same else None

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(ids of A, ids of B) of each text; None where it has no tokens."""
        out = []
        for k in range(0, len(texts), TOGETHER):
            split = [[] if not t else _CUT.split(t) if t[0] == " " or t[-1] == " " or _RUN.search(t) else t.split(" ")
                     for t in texts[k:k + TOGETHER]]
            self._learn(set().union(*split))
            for units in split:
                got = list(map(self.known.__getitem__, units))
                if not got or None in got:
                    out.append(None)
                    continue
                a, b = zip(*got)
                out.append((np.frombuffer(b"".join(a), np.int32), np.frombuffer(b"".join(b), np.int32)))
        return out


@lru_cache(maxsize=1)
def tokens(a_json: str, b_model: bytes) -> Tokens:
    return Tokens(a_json, b_model)


def _digit_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1, left-justified, room for a sign behind them; their number."""
    width = len(str(n - 1))
    table = np.zeros((n, width + 1), np.uint8)
    sizes = np.array([len(str(i)) for i in range(n)], np.int64)
    for size in range(1, width + 1):
        rows = np.flatnonzero(sizes == size)
        for k in range(size):
            table[rows, k] = rows // 10 ** (size - 1 - k) % 10 + ord("0")
    return table, sizes


def _written(ids: np.ndarray, signs: np.ndarray, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of digits and a sign, length of each)."""
    table, sizes = digits
    rows, size = table[ids], sizes[ids]
    rows[np.arange(len(ids)), size] = signs
    return rows, size + 1


def group_digests(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
                  digits: list[tuple[np.ndarray, np.ndarray]]) -> list[str]:
    """SHA-256 of each document's ``a1,a2|b1;a3|b2,b3``."""
    at_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
    at_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
    last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
    width = max(digits[0][0].shape[1], digits[1][0].shape[1])
    rows, sizes = np.zeros((len(a) + len(b), width), np.uint8), np.zeros(len(a) + len(b), np.int64)
    for at, ids, last, sign, table in ((at_a, a, last_a, "|", digits[0]), (at_b, b, last_b, ";", digits[1])):
        text, sizes[at] = _written(ids, np.where(last, ord(sign), ord(",")).astype(np.uint8), table)
        rows[at, :text.shape[1]] = text
    flat = rows[np.arange(width) < sizes[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
    return [hashlib.sha256(flat[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(ends[:-1], ends[1:])]


# -- blocks -----------------------------------------------------------------------

def _block(number: int, ids: list, coded: list, t: Tokens, work: int) -> pa.RecordBatch:
    some = [c if c is not None else (np.empty(0, np.int32),) * 2 for c in coded]
    n_a, n_b = (np.array([len(c[k]) for c in some], np.int64) for k in (0, 1))
    a, b = (np.concatenate([c[k] for c in some]) for k in (0, 1))
    n_groups, n_links, n_pairs = (np.zeros(len(ids), np.int64) for _ in range(3))
    pairs = counts = in_docs = np.empty(0, np.int64)
    links, digests = b"", [""] * len(ids)
    if len(a):
        x, y, group = overlaps(np.cumsum(t.a_sizes[a]), np.cumsum(t.b_sizes[b]), work)
        doc = np.repeat(np.arange(len(ids)), n_a)[x]
        group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
        group_a[x], group_b[y] = group, group
        digests = group_digests(a, b, group_a, group_b, n_a, n_b, t.digits)
        n_links = np.bincount(doc, minlength=len(ids))
        closes = np.append(group[1:] != group[:-1], True)
        n_groups = np.bincount(doc[closes], minlength=len(ids))
        key, counts = np.unique(doc << t.pair_bits | a[x].astype(np.int64) << t.b_bits | b[y], return_counts=True)
        n_pairs = np.bincount(key >> t.pair_bits, minlength=len(ids))
        pairs, place, in_docs = np.unique(key & ((1 << t.pair_bits) - 1), return_inverse=True, return_counts=True)
        # places rise inside a document: their steps pack well
        links = zstandard.compress(np.concatenate([np.diff(place, prepend=0), counts]).astype(np.int32).tobytes(), 1)
    row = {"block": number, "pairs": pairs, "in_docs": in_docs, "doc_ids": ids, "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
           "n_links": n_links, "digests": digests, "n_pairs": n_pairs, "links": links}
    long = pa.list_(pa.int64())
    types = {"block": pa.int64(), "digests": pa.list_(pa.string()), "links": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], types.get(k, long)) for k, v in row.items()], list(row))


def aligned_blocks(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                   block_links: int = BLOCK_LINKS, piece_work: int = PIECE_WORK) -> DataFrame:
    """Stored blocks of aligned documents (columns of ``_BLOCK``).  A block ends at the first document
    that brings it to ``block_links`` ends, so its size is bounded but for one whole text."""
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:      # tokenizer files beside the driver, 2 MB
        a_json, b_model = f.read(), g.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokens(a_json, b_model)
        number, ids, coded, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(k, TOGETHER)
                for i, c in zip(some.column(0).to_pylist(), t.encode(some.column(1).to_pylist())):
                    ids.append(i)
                    coded.append(c)
                    size += 1 + (len(c[0]) + len(c[1]) if c is not None else 0)
                    if size >= block_links:
                        yield _block(number, ids, coded, t, piece_work)
                        number, ids, coded, size = number + 1, [], [], 0
        if ids:
            yield _block(number, ids, coded, t, piece_work)

    return stored(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                  .mapInArrow(run, _BLOCK), "aligned-blocks")


def _named_pairs(blocks: DataFrame) -> DataFrame:
    """(block, place, pair, n): the different pairs of each block and how many of its documents hold them."""
    return blocks.select("block", F.posexplode(F.arrays_zip("pairs", "in_docs")).alias("place", "p")) \
        .select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.in_docs").alias("n"))


def link_counts(blocks: DataFrame, b_path: str) -> DataFrame:
    """(pair, a, b, n_docs, best): how many documents hold the ids a and b linked, and whether no other
    b has more with this a."""
    import sentencepiece
    bits = max(sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size() - 1, 1).bit_length()
    counts = _named_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("n_docs")) \
        .withColumn("a", F.shiftrightunsigned("pair", bits))
    counts = stored(counts, "link-counts")
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))      # a row an id of A: as many as its vocabulary has
    return counts.join(top, "a").select("pair", "a", (F.col("pair") - F.shiftleft("a", bits)).alias("b"), "n_docs",
                                        (F.col("n_docs") == F.col("top")).alias("best"))


def _of_documents(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """One block: its documents' links looked up in the counts of its pairs."""
    row = left.to_pylist()[0]
    docs = len(row["doc_ids"])
    place, n, best = (right.column(c).to_numpy() for c in ("place", "n_docs", "best"))
    total, top = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    total[place], top[place] = n, best
    packed = np.frombuffer(zstandard.decompress(row["links"]) if row["links"] else b"", np.int32).astype(np.int64)
    steps, counts = packed[:len(packed) // 2], packed[len(packed) // 2:]
    place = np.cumsum(steps)
    ends = np.cumsum(row["n_pairs"])
    sums = []
    for v in (counts * total[place], counts * top[place]):
        run = np.concatenate([[0], np.cumsum(v)])
        sums.append(np.diff(run[ends], prepend=0) if docs else v)
    count_sum, n_best = sums
    longs = [pa.array(row[c], pa.int64()) for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
    return pa.Table.from_arrays([*longs, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()),
                                 pa.array(row["digests"], pa.string())], [c.split()[0] for c in _REPORT.split(", ")])


def report(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    looked_up = _named_pairs(blocks).select("block", "place", "pair").join(counts.select("pair", "n_docs", "best"), "pair") \
        .select(F.col("block").alias("of_block"), "place", "n_docs", "best")
    documents = blocks.select("block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests", "n_pairs", "links")
    return documents.groupBy("block").cogroup(looked_up.groupBy("of_block")).applyInArrow(_of_documents, _REPORT)


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          block_links: int = BLOCK_LINKS, piece_work: int = PIECE_WORK) -> DataFrame:
    """The report of ``df`` with counts over all of its documents."""
    blocks = aligned_blocks(df, a_path, b_path, id_col, text_col, block_links, piece_work)
    return report(blocks, link_counts(blocks, b_path))

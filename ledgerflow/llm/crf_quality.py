"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad.  Its features describe the line itself
(shares of character classes and of neighbouring class pairs, length, words,
repetition) and the lines before and after it.  The field is fitted on the
lines of labelled documents, each line carrying its document's label; the
scores of a document are the forward-backward marginals of "good", averaged
over its lines by length.

The sample for fitting is bounded: the ``sample_docs`` labelled documents that
come first in the order of a hash of their id, whole texts, whose line features
(not texts) are gathered.  Scoring reads whole texts, any number of lines.

Defined results: a null or empty text is one empty line and gets that line's
score; rows repeat as they come; without labelled rows, or with one class only,
the score is that class's share (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import arrow_column, sliced

#: Character classes by byte: new line, blank, lower, upper, digit, sentence end, pause, quote or bracket,
#: symbol, byte of a multi-byte character, control.
N_CLASSES = 11


def _byte_classes() -> np.ndarray:
    c = np.full(256, 10, np.uint8)
    for k, chars in enumerate(["\n", " \t\r", None, None, None, ".!?", ",;:", "'\"()[]{}-`", "#$%&*+/<=>@\\^_|~"]):
        if chars:
            c[[ord(x) for x in chars]] = k
    c[ord("a"):ord("z") + 1], c[ord("A"):ord("Z") + 1], c[ord("0"):ord("9") + 1], c[128:] = 2, 3, 4, 9
    return c


BYTE_CLASS = _byte_classes()
N_OWN = N_CLASSES + N_CLASSES * N_CLASSES + 7
N_SUMMARY = N_CLASSES + 7
N_FEATURES = N_OWN + 2 * (N_SUMMARY + 1)
#: Lines and characters whose features are built at a time.
BLOCK_LINES, BLOCK_CHARS = 2048, 1 << 18


def _word_facts(lines: list[str], first: np.ndarray) -> np.ndarray:
    """For each line: words, share of different words, whether the text had the line before, overlap with the line above."""
    out = np.zeros((len(lines), 4), np.float32)
    before: set[str] = set()
    last: set[str] = set()
    for k, (line, starts) in enumerate(zip(lines, first.tolist())):
        if starts:
            before, last = set(), set()
        found = line.split()
        now = set(found)
        if found:
            out[k] = len(found), len(now) / len(found), line in before, len(now & last) / len(now)
            before.add(line)
        else:
            out[k, 1] = 1
        last = now
    return out


def _blocks_of(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of lines of at most ``BLOCK_LINES`` lines and about ``BLOCK_CHARS`` characters."""
    start = size = 0
    for k, line in enumerate(lines):
        size += len(line) + 1
        if size >= BLOCK_CHARS or k + 1 - start >= BLOCK_LINES:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(lines):
        yield start, len(lines)


def _own_features(lines: list[str], words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of the lines by themselves, what their neighbours see of them, bytes of each line)."""
    data = np.frombuffer(("\n".join(lines) + "\n").encode(), np.uint8)
    cls = BYTE_CLASS[data]
    ends, n = np.flatnonzero(data == 10), len(lines)
    sizes = np.diff(ends, prepend=-1) - 1
    line_of = np.repeat(np.arange(n, dtype=np.int32), sizes + 1)
    counts = np.bincount(line_of * N_CLASSES + cls, minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(np.float32)
    inside = np.flatnonzero(cls[1:] != 0)
    inside = inside[cls[inside] != 0]
    pair = line_of[inside] * (N_CLASSES * N_CLASSES) + cls[inside].astype(np.int32) * N_CLASSES + cls[inside + 1]
    pairs = np.bincount(pair, minlength=n * N_CLASSES * N_CLASSES).reshape(n, -1).astype(np.float32)
    per = 1 / np.maximum(sizes, 1).astype(np.float32)[:, None]
    n_words = words[:, 0]
    extra = np.stack([np.log1p(sizes), np.log1p(n_words), np.minimum(sizes / np.maximum(n_words, 1), 40) / 10, *words.T[1:],
                      (sizes == 0)], 1).astype(np.float32)
    shares = counts * per
    return np.concatenate([shares, pairs * per, extra], 1), np.concatenate([shares, extra], 1), sizes


def feature_blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features, first line of a text, bytes) of the lines of all texts, a block of lines at a time: the wide
    features of a text of very many lines never exist together."""
    split = [(t or "").split("\n") for t in texts]
    lines = [line for one in split for line in one]
    first, final = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    ends = np.cumsum([len(one) for one in split])
    final[ends - 1] = True
    first[0], first[ends[:-1]] = True, True
    words = _word_facts(lines, first)
    nothing = np.zeros((1, N_SUMMARY), np.float32)
    above, waiting = nothing, None

    def whole(block, below):
        a, b, own, summary, sizes, above = block
        before = np.where(first[a:b, None], 0, np.concatenate([above, summary[:-1]]))
        after = np.where(final[a:b, None], 0, np.concatenate([summary[1:], below]))
        return np.concatenate([own, before, first[a:b, None], after, final[a:b, None]], 1).astype(np.float32), first[a:b], sizes
    for a, b in _blocks_of(lines):
        own, summary, sizes = _own_features(lines[a:b], words[a:b])
        if waiting is not None:
            yield whole(waiting, summary[:1])
        waiting, above = (a, b, own, summary, sizes, above), summary[-1:]
    yield whole(waiting, nothing)


def _starts(first: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(first), len(first))


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, first line of each text and the end, bytes of each line)."""
    x, first, sizes = (np.concatenate(c) for c in zip(*feature_blocks(texts)))
    return x, _starts(first), sizes


@dataclass
class LineField:
    """A fitted field: weight of each standardised feature for "good", and the transition scores."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray          # moves[a, b]: from label a to label b, 0 bad, 1 good
    constant: float | None = None

    def node_scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) * self.scale).clip(-6, 6) @ self.weights + self.bias

    def marginals(self, node: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return _forward_backward(node, starts, self.moves)[0]

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean marginal of "good" for each text."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        blocks = [(self.node_scores(x).astype(np.float64), first, sizes) for x, first, sizes in feature_blocks(texts)]
        node, first, sizes = (np.concatenate(c) for c in zip(*blocks))
        starts = _starts(first)
        good = self.marginals(node, starts)
        weight = sizes + 1.0
        return np.clip(np.add.reduceat(good * weight, starts[:-1]) / np.add.reduceat(weight, starts[:-1]), 0, 1)


def _forward_backward(node: np.ndarray, starts: np.ndarray, moves: np.ndarray):
    """All chains side by side, one line further at a time; the longest chains first,
    so the chains still running are a prefix.  Returns the marginals of "good",
    the log partition of each chain and the expected moves."""
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, count = starts[:-1][order], sizes[order]
    steps = int(count[0]) if len(count) else 0
    alive = np.searchsorted(-count, -np.arange(1, steps + 1), side="right")       # chains with a line t
    alpha = np.zeros((len(node), 2))
    beta = np.zeros((len(node), 2))
    alpha[first, 1] = node[first]
    for t in range(1, steps):
        at = first[:alive[t]] + t
        back = alpha[at - 1]
        alpha[at] = np.logaddexp(back[:, :1] + moves[0], back[:, 1:] + moves[1])
        alpha[at, 1] += node[at]
    for t in range(steps - 2, -1, -1):
        at = first[:alive[t + 1]] + t
        ahead = beta[at + 1].copy()
        ahead[:, 1] += node[at + 1]
        beta[at] = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
    ends = starts[1:] - 1
    log_z = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    z = np.repeat(log_z, sizes)
    good = np.exp(np.clip(alpha[:, 1] + beta[:, 1] - z, -700, 0))
    inner = np.ones(len(node), bool)
    inner[starts[:-1]] = False
    at = np.flatnonzero(inner)
    ahead = beta[at].copy()
    ahead[:, 1] += node[at]
    expected = np.exp(np.minimum(alpha[at - 1][:, :, None] + moves + ahead[:, None, :] - z[at][:, None, None], 0)).sum(0)
    return good, log_z, expected


def fit_field(x: np.ndarray, starts: np.ndarray, labels: np.ndarray, rounds: int = 120, rate: float = 0.06,
              ridge: float = 1e-3) -> LineField:
    """Maximum conditional likelihood of the line labels (per line), ridge on all weights, by Adam."""
    mean, std = x.mean(0), x.std(0)
    scale = np.where(std > 1e-6, 1 / np.maximum(std, 1e-6), 0).astype(np.float32)
    z = ((x - mean) * scale).clip(-6, 6)
    sizes = np.diff(starts)
    y = np.repeat(labels, sizes).astype(np.float64)
    seen_moves = np.zeros((2, 2))
    for label in (0, 1):
        seen_moves[label, label] = (sizes[labels == label] - 1).sum()
    theta = np.zeros(x.shape[1] + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, b, moves = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        good, _, expected = _forward_backward(z @ w + b, starts, moves)
        off = good - y
        grad = np.concatenate([z.T @ off, [off.sum()], (expected - seen_moves).ravel()]) / len(y) + ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return LineField(mean, scale, theta[:-5].astype(np.float32), float(theta[-5]), theta[-4:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_docs: int = 2000) -> LineField:
    """Fit on at most ``sample_docs`` labelled documents, whole texts.  Rows of ``labels``
    with a null id or label are passed over; an id labelled twice takes the smaller label."""
    chosen = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(id_col).agg(F.min(label_col).cast("int").alias("y")) \
        .orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(sample_docs).collect()
    label = {r[0]: r[1] for r in chosen}
    if len(set(label.values())) < 2:
        share = float(next(iter(label.values()))) if label else 0.5
        return LineField(np.zeros(1), np.zeros(1), np.zeros(1), 0.0, np.zeros((2, 2)), share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in sliced([batch], 16):
                x, starts, _ = line_features(one.column(1).to_pylist())
                rows = [x[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays([one.column(0), pa.array(rows, pa.binary())], ["id", "x"])

    sample = docs.filter(F.col(id_col).isin(list(label))) \
        .select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).dropDuplicates(["id"])
    rows = sorted(sample.mapInArrow(run, "id long, x binary").collect())
    y = np.array([label[r[0]] for r in rows])
    if len(set(y.tolist())) < 2:
        return LineField(np.zeros(1), np.zeros(1), np.zeros(1), 0.0, np.zeros((2, 2)), float(y[0]) if len(y) else 0.5)
    parts = [np.frombuffer(r[1], np.float32).reshape(-1, N_FEATURES) for r in rows]
    return fit_field(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]), y)


#: Bytes of text scored at a time, so that a task's memory stays bounded.
SLICE_BYTES = 2 << 20


def score_column(df: DataFrame, field: LineField, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``df`` with ``out_col``: the quality of each whole text, 0 to 1."""
    def make():
        def of(texts: pa.Array) -> pa.Array:
            out, now, size = [], [], 0
            for t in texts.to_pylist():
                now.append(t)
                size += len(t or "")
                if size >= SLICE_BYTES:
                    out.append(field.score(now))
                    now, size = [], 0
            if now:
                out.append(field.score(now))
            return pa.array(np.concatenate(out) if out else [], pa.float64())
        return of

    return arrow_column(df, text_col, out_col, T.DoubleType(), make)

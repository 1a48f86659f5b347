"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of short passages of
labelled documents.  A whole text, in lower case and with one space for each
run of other characters than letters, is cut into blocks; each block is
compressed with every dictionary, and the language with the smallest total wins.  Blocks
keep a long text from serving as its own dictionary.  Where the best two totals
are close, the text is measured once more in shorter blocks; equal totals go to
the language with more labelled documents.

``accepted`` is false where the margin over the second language, in saved bytes
per byte of text, stays under ``reject_margin``.

The sample is bounded: ``sample_docs`` documents a language, in the order of a
hash of their id, ``passage`` characters of each from a place that the hash
sets.  Prediction reads whole texts.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or when no language was learned; rows repeat as they come; a null language is
never learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerflow.llm.common import sliced

UNDETERMINED = "und"
BLOCK, SHORT_BLOCK = 1024, 128
#: Saved bytes per byte of text under which the shorter blocks decide.
CLOSE = 0.02
NOT_LETTERS, LETTER = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\p{L}")

_OUT = "doc_id long, lang_pred string, score double, margin double, accepted boolean"


def _words(text: str) -> str:
    """Letters, with the marks that go with them; nothing if there is no letter."""
    return NOT_LETTERS.sub(" ", text.lower()).strip() if LETTER.search(text) else ""


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language, most frequent language first."""
    passages: tuple[tuple[str, bytes], ...]
    reject_margin: float

    def compressors(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        out = []
        for lang, content in self.passages:
            how = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_GREEDY, min_match=3, hash_log=16, chain_log=16, search_log=4,
                target_length=8, window_log=18, write_content_size=False, write_checksum=False, write_dict_id=False)
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            out.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=how)))
        return out


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = 64, passage: int = 800, reject_margin: float = 0.01) -> LanguageModel:
    """Learn from the labelled rows of ``df`` (rows with a null language or text are passed over)."""
    known = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = F.xxhash64(F.col(id_col).cast("string"))
    first = Window.partitionBy(lang_col).orderBy(order, id_col)
    slim = known.select(id_col, lang_col).withColumn("__n", F.row_number().over(first)).filter(F.col("__n") <= sample_docs)
    ids = [r[0] for r in slim.select(id_col).distinct().collect()]          # sample_docs a language at most
    counts = dict(known.groupBy(lang_col).count().collect())
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(1)), F.greatest(F.char_length(text_col) - passage, F.lit(1)))
    rows = known.filter(F.col(id_col).isin(ids)) \
        .select(lang_col, order.alias("o"), F.substr(F.col(text_col), (place + 1).cast("int"), F.lit(passage)).alias("t")) \
        .dropDuplicates().withColumn("__n", F.row_number().over(Window.partitionBy(lang_col).orderBy("o", "t"))) \
        .filter(F.col("__n") <= sample_docs).collect() if ids else []
    texts: dict[str, list] = {}
    for lang, o, t, _ in rows:
        texts.setdefault(lang, []).append((o, t))
    made = {lang: " ".join(_words(t) for _, t in sorted(parts)).encode() for lang, parts in texts.items()}
    langs = sorted((x for x in made if len(made[x]) >= 16), key=lambda x: (-counts[x], x))
    return LanguageModel(tuple((x, made[x]) for x in langs), reject_margin)


class _Measure:
    def __init__(self, model: LanguageModel):
        self.reject_margin, self.by_lang = model.reject_margin, model.compressors()

    def sizes(self, data: bytes, block: int) -> list[int]:
        parts = [data[k:k + block] for k in range(0, len(data), block)]
        return [sum(len(c.compress(p)) for p in parts) for _, c in self.by_lang]

    def of(self, text: str | None) -> tuple[str, float, float, bool]:
        data = _words(text or "").encode()
        if not data or not self.by_lang:
            return UNDETERMINED, 0.0, 0.0, False
        sizes = self.sizes(data, BLOCK)
        ranked = sorted(sizes)
        if len(sizes) > 1 and ranked[1] - ranked[0] < CLOSE * len(data):
            sizes = [a + b for a, b in zip(sizes, self.sizes(data, SHORT_BLOCK))]
            ranked = sorted(sizes)
        best = sizes.index(ranked[0])
        margin = (ranked[1] - ranked[0]) / len(data) if len(sizes) > 1 else 1.0
        # a byte less is taken as odds of 2 to 1, at most 40 bytes apart
        score = 1 / sum(2.0 ** -min(s - ranked[0], 40) for s in sizes)
        return self.by_lang[best][0], score, margin, margin >= self.reject_margin


def predict(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, margin, accepted: one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = _Measure(model)
        for batch in sliced(batches):
            got = [measure.of(t) for t in batch.column(1).to_pylist()]
            cols = zip(*got) if got else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.float64(), pa.float64(), pa.bool_()]))],
                ["doc_id", "lang_pred", "score", "margin", "accepted"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, _OUT)

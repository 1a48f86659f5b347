"""Benchmark decontamination with DataFrame expressions only.

Words are runs of digits, a-z and characters beyond ASCII, after lower-casing
A-Z.  Every window of ``width`` consecutive words of a benchmark item (an item
of fewer words is one window) goes into a hash set that each task gets with its
code.  A document's windows are hashed in place, looked up, and a window whose
hash is found is verified by its words; the words under any verified window are
hits.  Nothing is shuffled for that: ``remove_documents`` and ``remove_spans``
work row by row.  Only the report of item ids joins the (few) hits.

The set travels with the plan only up to ``MAX_SET_WINDOWS`` different windows;
a larger benchmark is joined window by window instead, with the same result.

Defined results: null and empty texts have no words and no hits; items without
words are ignored; a window that several items share reports all of them; rows
repeat as they come, each with its own result; an empty benchmark hits nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import ascii_lower, stored

WIDTH = 10
MAX_SET_WINDOWS = 50_000
#: Characters between words, for a regular expression class.
BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: The same in a text whose capitals were not lowered.
BETWEEN_ANY_CASE = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"

_HIT = "array<struct<pos: int, k: int, gram: string>>"


def word_array(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), f"[{BETWEEN}]+"), lambda w: w != "")


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """k, gram (words joined by a space), items (sorted ids as text): one row per different window."""
    words = benchmark.select(F.col(id_col).cast("string").alias("item"), word_array(F.col(text_col)).alias("w")) \
        .filter("item IS NOT NULL AND size(w) > 0").withColumn("k", F.least(F.size("w"), F.lit(width)))
    return words.select("item", "k", F.explode(F.expr(
        "transform(sequence(1, size(w) - k + 1), i -> array_join(slice(w, i, k), ' '))")).alias("gram")) \
        .groupBy("k", "gram").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _in_place(words: str, k: int, grams: list[str], hashes: list[int]) -> Column:
    """Verified windows of ``k`` words, in order of position."""
    numbers = ", ".join(f"{h}L" for h in hashes)
    strings = ", ".join(f"'{g}'" for g in grams)               # words hold no quotes or backslashes
    return F.expr(f"""CASE WHEN size({words}) >= {k} THEN filter(transform(
        filter(sequence(1, size({words}) - {k - 1}), i -> xxhash64(slice({words}, i, {k})) IN ({numbers})),
        i -> struct(i AS pos, {k} AS k, array_join(slice({words}, i, {k}), ' ') AS gram)),
        x -> x.gram IN ({strings})) END""")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row: a generator of one row keeps
    the optimiser from copying the expression into every place that reads it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def find_hits(docs: DataFrame, windows: DataFrame, text_col: str = "text",
              max_set: int = MAX_SET_WINDOWS) -> DataFrame:
    """``docs`` with __n_words, __hits (verified windows by position) and __n_hit (words under them)."""
    few = windows.select("k", "gram", F.expr("xxhash64(split(gram, ' '))").alias("h")).limit(max_set + 1).collect()
    with_words = _once(docs, "__words", word_array(F.col(f"`{text_col}`")))
    if len(few) <= max_set:
        found = with_words.withColumn("__n_words", F.size("__words").cast("long"))
        empty = F.expr(f"CAST(array() AS {_HIT})")
        by_k = [F.coalesce(_in_place("__words", k, [r.gram for r in few if r.k == k], sorted({r.h for r in few if r.k == k})),
                           empty) for k in sorted({r.k for r in few})]
        hits = reduce(F.concat, by_k) if by_k else empty
        found = _once(found, "__hits", F.array_sort(hits) if len(by_k) > 1 else hits).drop("__words")
    else:
        found = _by_join(with_words, windows)
    covered = F.expr("""aggregate(__hits, struct(0 AS n, 0 AS till), (a, x) -> struct(
        a.n + greatest(0, x.pos + x.k - greatest(x.pos, a.till)) AS n, greatest(a.till, x.pos + x.k) AS till), a -> a.n)""")
    return found.withColumn("__n_hit", covered.cast("long"))


def _by_join(with_words: DataFrame, windows: DataFrame) -> DataFrame:
    """The same hits through a join on the window, for a benchmark of any size."""
    rows = stored(with_words.withColumn("__row", F.monotonically_increasing_id()), "decontam-rows")
    lengths = sorted(r[0] for r in windows.select("k").distinct().collect())        # width values at most
    each = F.flatten(F.array(*[F.expr(
        f"CASE WHEN size(__words) >= {k} THEN transform(sequence(1, size(__words) - {k - 1}), "
        f"i -> struct(i AS pos, {k} AS k, array_join(slice(__words, i, {k}), ' ') AS gram)) "
        f"ELSE CAST(array() AS {_HIT}) END") for k in lengths]))
    hits = rows.select("__row", F.explode(each).alias("x")).select("__row", "x.*") \
        .join(windows.select("k", "gram"), ["k", "gram"], "left_semi") \
        .groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("pos", "k", "gram"))).alias("__hits"))
    return rows.join(hits, "__row", "left").withColumn("__n_words", F.size("__words").cast("long")) \
        .withColumn("__hits", F.coalesce("__hits", F.expr(f"CAST(array() AS {_HIT})"))).drop("__row", "__words")


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                     item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; columns as they were."""
    found = find_hits(docs, item_windows(benchmark, item_col, item_text_col, width), text_col)
    return found.filter("__n_hit = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with the hit words, and what stands behind each up to the next word, cut out of the text."""
    found = find_hits(docs, item_windows(benchmark, item_col, item_text_col, width), text_col)
    spans = F.expr("""aggregate(__hits, CAST(array() AS array<struct<a: int, b: int>>), (m, x) ->
        CASE WHEN size(m) > 0 AND element_at(m, -1).b >= x.pos
             THEN concat(slice(m, 1, size(m) - 1), array(struct(element_at(m, -1).a AS a,
                         greatest(element_at(m, -1).b, x.pos + x.k) AS b)))
             ELSE concat(m, array(struct(x.pos AS a, x.pos + x.k AS b))) END)""")
    text = F.col(f"`{text_col}`")
    lead = F.regexp_extract(text, f"^[{BETWEEN_ANY_CASE}]*", 0)
    pieces = F.regexp_extract_all(text, F.lit(f"[^{BETWEEN_ANY_CASE}]+[{BETWEEN_ANY_CASE}]*"), F.lit(0))
    left = F.filter(pieces, lambda p, i: ~F.exists(F.col("__spans"), lambda s: (i + 1 >= s.a) & (i + 1 < s.b)))
    cut = F.when(F.col("__n_hit") > 0, F.concat(lead, F.array_join(left, ""))).otherwise(text)
    return _once(found, "__spans", spans).withColumn(text_col, cut).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
           max_set: int = MAX_SET_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of ``docs``."""
    windows = stored(item_windows(benchmark, item_col, item_text_col, width), "decontam-windows")
    whole = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    found = find_hits(whole, windows, "text", max_set)
    # a gram says its number of words, so the text alone names the window
    grams = F.array_distinct(F.transform("__hits", lambda x: x.gram))
    rows = found.select("doc_id", "row", "__n_words", "__n_hit", F.explode_outer(grams).alias("gram"))
    joined = rows.join(windows.select("gram", "items"), "gram", "left")
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
    return joined.groupBy("row", "doc_id", "__n_words", "__n_hit").agg(items.alias("items")).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("__n_hit") > 0).alias("contaminated"))

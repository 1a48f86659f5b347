"""Near-duplicate groups by b-bit MinHash.

A document is the set of its distinct ``width``-word shingles (64-bit hashes of
the words).  One pass over the texts keeps 256 minima a document; ``BANDS``
bands of ``ROWS`` minima give the candidate keys, and the low ``BITS`` bits of
all minima are packed as bit planes.  Documents with one and the same set are
one class from then on, so copies cost nothing further.

Classes that share a band key are candidates.  A pair is kept if the
similarity estimated by bit counts, corrected for chance collisions, reaches
``cut``; kept pairs are confirmed on the full sets of the whole texts, and
confirmed pairs link.

Large buckets are not expanded into pairs.  Each class is compared with the
three pivots of its bucket.  A pair inside one component is never confirmed
again.  In buckets that still hold several components, the shingles that a class
shares with no other such class are counted: two classes have at most as many in
common as either shares with anyone, which bounds their similarity exactly.  The
classes with the least share of own shingles, those in the middle of a group of
near copies, are the next pivots.  After that, classes outside the main component
are compared with the members of other components that differ from a class in the middle
in the same shingles; a link demands that they share about half of these, so this
keeps every link between groups without comparing all their members.

With 42 bands of 6 rows a pair at similarity 0.8 shares no key with
probability 3e-6 (1e-9 at 0.86); the estimate's standard error at 0.8 is 0.025,
so ``cut`` lies more than five of them below the threshold.

Defined results: null texts and texts without words have an empty set, link
with nothing and are their own component; fewer words than ``width`` are one
shingle; rows repeated with one id have one result each, the same for equal
sets, and each goes with its own text where the texts differ; a row with a null id is never kept (its component is that of its text
among known ids, or null); other columns are ignored or kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerflow.llm.common import arrow_column, free_name, sliced, stored

N_HASHES, ROWS, BANDS, BITS = 256, 6, 42, 4
CUT_BELOW = 0.14
PIVOTS = 3
#: Parts in which classes of one component, or of one bucket, are dealt.
PARTS = 16
#: Members that are confirmed against one partner's text in one sorted run.
SALT = 64
#: Partners that a class has confirmed in the rounds before all the rest.
TRIES = (1, 8)
_WORDS_REMEMBERED = 100_000
_NO_WORD = np.uint64(0x9E3779B97F4A7C15)


def _coefficients(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 2 ** 32, N_HASHES, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 2 ** 32, N_HASHES, dtype=np.uint32))


MULTIPLY, ADD = _coefficients()


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_REMEMBERED:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, width: int, words: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; A-Z lower-cased, words between ASCII white space."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = max(len(h) - width + 1, 1)
    got = np.full(n, np.uint64(min(len(h), width)))
    for k in range(min(len(h), width)):
        got = _mix(got * np.uint64(0xD6E8FEB86659FD93) + h[k:k + n])
    return np.unique(got)


def minima(shingles: np.ndarray) -> np.ndarray:
    """256 minima of 32-bit permutations, in blocks that stay in the cache."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 256):
        np.minimum(best, (low[k:k + 256, None] * MULTIPLY + ADD).min(0), out=best)
    return best


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def band_keys(best: np.ndarray) -> np.ndarray:
    rows = best[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = _mix(key * np.uint64(0xD6E8FEB86659FD93) + rows[:, k])
    return _signed(key)


def packed(best: np.ndarray) -> np.ndarray:
    """Low bits of the minima as planes of 4 x 64 bits each."""
    mixed = best * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    planes = [np.packbits(((mixed >> np.uint32(k)) & np.uint32(1)).astype(np.uint8), bitorder="little") for k in range(BITS)]
    return np.concatenate(planes).view(np.int64)


_SIGNED_ROWS = "doc_id long, n_shingles long, set_hash binary, bands array<long>, signature array<long>"


def _set_hash(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signatures(df: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_hash, bands, signature: one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch = whole.slice(k, 1024)
                seen: dict[bytes, tuple] = {}
                rows = []
                for text in batch.column(1).to_pylist():
                    s = shingle_set(text, width, words)
                    key = _set_hash(s)
                    if key not in seen:
                        best = minima(s)
                        seen[key] = (len(s), key, band_keys(best).tolist(), packed(best).tolist())
                    rows.append(seen[key])
                n, keys, bands, sigs = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_hash", "bands", "signature"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, _SIGNED_ROWS)


def _with_set_hash(df: DataFrame, text_col: str, width: int, out: str) -> DataFrame:
    """``df`` with the hash of each text's shingle set."""
    def make():
        words = _Words()
        return lambda texts: pa.array([_set_hash(shingle_set(t, width, words)) for t in texts.cast(pa.string()).to_pylist()], pa.binary())
    return arrow_column(df, text_col, out, T.BinaryType(), make)


def _class_texts(df: DataFrame, classes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(rep, text): one text of each class.  The id names candidates; rows of one id may differ in
    text, so the text's own set decides."""
    texts = df.select(F.col(id_col).cast("long").alias("low"), F.col(text_col).cast("string").alias("text"))
    rows = _with_set_hash(texts.join(classes.select("low", "rep", "set_hash"), "low"), "text", width, "h")
    return rows.filter("h = set_hash").groupBy("rep").agg(F.min("text").alias("text"))


def _estimate(a: str, b: str):
    """Similarity from equal low bits, corrected for equality by chance."""
    words = N_HASHES // 64
    differ = [" | ".join(f"({a}[{p * words + w}] ^ {b}[{p * words + w}])" for p in range(BITS)) for w in range(words)]
    unequal = " + ".join(f"bit_count({d})" for d in differ)
    chance = 2.0 ** -BITS
    return F.expr(f"(({N_HASHES} - ({unequal})) / {float(N_HASHES)} - {chance}) / {1 - chance}")


def _possible(percent: int) -> Column:
    """Whether the most that x and y can have in common (``mx``, ``my``: the shingles of each that
    stand elsewhere too) is enough for their sizes."""
    return F.least("mx", "my") * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent


def _side(sigs: DataFrame, side: str) -> DataFrame:
    return sigs.select(F.col("rep").alias(side), F.col("signature").alias(f"s{side}"),
                       F.col("n_shingles").alias(f"n{side}"), F.col("most").alias(f"m{side}"))


def _with_signatures(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (x, y) whose estimate reaches the cut and whose sizes leave the threshold in reach."""
    return pairs.join(_side(sigs, "x"), "x").join(_side(sigs, "y"), "y").filter(_possible(percent)) \
        .filter(_estimate("sx", "sy") >= percent / 100 - CUT_BELOW).select("x", "y")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (x, y) whose full sets are similar enough.  A partner's text travels once for
    each ``SALT``-th of its members; members stream past it in sorted order."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("x"), F.lit(SALT)))
    partners = salted.select("y", "salt").distinct().withColumn("role", F.lit(0)).withColumn("rep", F.col("y"))
    members = salted.withColumn("role", F.lit(1)).withColumnRenamed("x", "rep")
    rows = partners.unionByName(members).join(texts, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, now, partner = _Words(), None, None
        for batch in batches:
            xs, ys = [], []
            cols = [batch.column(k).to_pylist() for k in range(4)]
            for y, role, rep, text in zip(*cols):
                s = shingle_set(text, width, words)
                if role == 0:
                    now, partner = y, s
                elif y == now:
                    both = len(np.intersect1d(partner, s, assume_unique=True))
                    if 100 * both >= percent * (len(partner) + len(s) - both):
                        xs.append(rep)
                        ys.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], ["x", "y"])

    return rows.repartition("y", "salt").sortWithinPartitions("y", "salt", "role") \
        .select("y", "role", "rep", "text").mapInArrow(run, "x long, y long")


def _components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, comp) after adding links between components: smallest label wins, in rounds
    of neighbour minima with pointer jumping until nothing changes."""
    edges = links.join(labels.select(F.col("rep").alias("x"), F.col("comp").alias("a")), "x") \
        .join(labels.select(F.col("rep").alias("y"), F.col("comp").alias("b")), "y").filter("a <> b") \
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "minhash-edges")
    nodes = edges.select(F.col("u").alias("n")).union(edges.select("v")).distinct().withColumn("c", F.col("n"))
    nodes = stored(nodes, "minhash-nodes")
    both = edges.union(edges.select("v", "u")).toDF("n", "m")
    while True:
        near = both.join(nodes.select(F.col("n").alias("m"), F.col("c").alias("cm")), "m").groupBy("n").agg(F.min("cm").alias("cm"))
        step = nodes.join(near, "n").select("n", "c", F.least("c", "cm").alias("d"))
        jump = nodes.select(F.col("n").alias("d"), F.col("c").alias("e"))
        step = stored(step.join(jump, "d", "left").select("n", "c", F.least("d", "e").alias("d")), "minhash-nodes")
        moved = step.filter("c <> d").limit(1).count()
        nodes = step.select("n", F.col("d").alias("c"))
        if not moved:
            break
    renamed = nodes.select(F.col("n").alias("comp"), F.col("c").alias("new"))
    return labels.join(renamed, "comp", "left").select("rep", F.coalesce("new", "comp").alias("comp"))


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose two classes are in different components."""
    return pairs.join(labels.select(F.col("rep").alias("x"), F.col("comp").alias("a")), "x") \
        .join(labels.select(F.col("rep").alias("y"), F.col("comp").alias("b")), "y").filter("a <> b").select("x", "y")


def _link_all(kept: DataFrame, labels: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Labels after confirming every kept pair that still joins two components; ``texts`` has
    (rep, text) of the classes.  A class confirms
    its lowest partner first, which joins most groups, then a few more, then all that are left."""
    for tries in (*TRIES, None):
        left = stored(_between(kept, labels), "minhash-left")
        if not left.limit(1).count():
            break
        ranked = left.withColumn("k", F.row_number().over(Window.partitionBy("x").orderBy("y")))
        now, kept = (left, None) if tries is None else (
            ranked.filter(F.col("k") <= tries).select("x", "y"), ranked.filter(F.col("k") > tries).select("x", "y"))
        links = stored(_confirm(now, texts, width, percent), "minhash-links")
        if links.limit(1).count():
            labels = stored(_components(labels, links), "minhash-labels")
    return labels


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(rep, s): the full shingle set of each class of ``texts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in sliced(batches, 64):
            sets = [_signed(shingle_set(t, width, words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["rep", "s"])

    return texts.select("rep", "text").mapInArrow(run, "rep long, s array<long>")


def _shared(sets: DataFrame) -> DataFrame:
    """(rep, own): how many shingles of a class stand in none of the other classes of ``sets``."""
    return sets.select("rep", F.explode("s").alias("s")) \
        .groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep")).filter("n = 1") \
        .groupBy("rep").agg(F.count(F.lit(1)).alias("own"))


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, comp, main): members of the buckets that hold several components; main is one of these."""
    rows = buckets.join(labels, "rep")
    several = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                      F.min_by("comp", "rep").alias("main")).filter("lo <> hi").select("key", "main")
    return rows.join(several, "key").select("key", "rep", "comp", "main")


def _weight() -> Column:
    return F.struct("own", F.xxhash64("rep"), "rep")


def _weighed(mixed: DataFrame, sigs: DataFrame) -> DataFrame:
    return mixed.join(sigs.select("rep", (1 - F.col("most") / F.col("n_shingles")).alias("own")), "rep")


def _light_pairs(mixed: DataFrame, sigs: DataFrame) -> DataFrame:
    """Distinct pairs (x, y) of bucket members and their bucket's light classes: those with the least
    share of own shingles, of all, of either half by hash and of those outside the main component."""
    rows, weight = _weighed(mixed, sigs), _weight()
    half = F.pmod(F.xxhash64("rep"), F.lit(2))
    picks = [F.min(weight), *(F.min(F.when(half == k, weight)) for k in (0, 1)), F.min(F.when(F.col("comp") != F.col("main"), weight))]
    pivots = rows.groupBy("key").agg(F.array(*[p["rep"] for p in picks]).alias("pivots"))
    return rows.join(pivots, "key").select("rep", F.explode(F.array_distinct(F.array_compact("pivots"))).alias("p")).filter("rep <> p") \
        .select(F.greatest("rep", "p").alias("x"), F.least("rep", "p").alias("y")).distinct()


def _differences(mixed: DataFrame, sigs: DataFrame, sets: DataFrame) -> DataFrame:
    """(main, hub, rep, comp, n, nh, d): each class of the buckets with one main component, and the shingles
    ``d`` that stand either in it or in the hub (the lightest class of the main component), not in both;
    n and nh are the sizes of the two sets."""
    rows = _weighed(mixed.select("main", "rep", "comp").distinct(), sigs)
    hubs = rows.filter("comp = main").groupBy("main").agg(F.min(_weight())["rep"].alias("hub"))
    hubs = hubs.join(sets.select(F.col("rep").alias("hub"), F.col("s").alias("h")), "hub") \
        .select("main", "hub", "h", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    members = rows.select("main", "rep", "comp", F.pmod(F.xxhash64("rep"), F.lit(PARTS)).cast("int").alias("part")).join(sets, "rep")
    return members.join(hubs, ["main", "part"]).select("main", "hub", "rep", "comp", F.size("s").alias("n"), F.size("h").alias("nh"),
                                                       F.concat(F.array_except("s", "h"), F.array_except("h", "s")).alias("d"))


def _across(mixed: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components that the pivots have not compared, of a class x outside the main
    component and a class y of a bucket with that component.

    Sets are told by their differences from the hub: |x ^ y| = |dx ^ dy|, which a link bounds by
    ``t = (nx + ny) * (100 - percent) / (100 + percent)``.  So dx and dy share at least (|dx| + |dy| - t) / 2 shingles, and
    as x has no link with the hub, about half of dy at least.  With the rarest shingles first, one of these stands in the
    first half of dy.  Members of a group of near copies whose edits differ share none there, so that they make no pairs."""
    far, near = 100 - percent, 100 + percent
    apart = stored(_differences(mixed, sigs, sets), "minhash-differences")
    # a class that the hub itself reaches, should the bands have missed it
    pairs = apart.filter((F.col("comp") != F.col("main")) & (F.size("d") * near <= (F.col("n") + F.col("nh")) * far)) \
        .select(F.col("rep").alias("x"), F.col("hub").alias("y"))
    rows = apart.select("main", "rep", "comp", "n", "nh", F.size("d").alias("z"), F.explode("d").alias("s"))
    often = rows.groupBy("main", "s").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    of = Window.partitionBy("main", "rep")
    # what stands in one difference only comes first and meets nothing; ``left``: the shingle itself and those behind it
    rows = stored(rows.join(often, ["main", "s"])
                  .withColumn("left", F.count(F.lit(1)).over(of) - F.row_number().over(of.orderBy("f", "s")) + 1).drop("f"), "minhash-places")

    def side(df: DataFrame, x: str) -> DataFrame:
        return df.select("main", "s", *[F.col(c).alias(f"{c}{x}") for c in ("rep", "comp", "n", "z", "left")])
    few = side(rows.filter("comp <> main"), "x")
    every = side(rows.filter(F.col("left") * 2 * near >= F.col("z") * near + (F.col("nh") - F.col("n")) * far), "y")
    least = (F.col("zx") + F.col("zy")) * near - (F.col("nx") + F.col("ny")) * far
    close = (few.main == every.main) & (few.s == every.s) & (F.col("compx") != F.col("compy")) \
        & (F.least("leftx", "lefty") * 2 * near >= least)
    pairs = pairs.union(few.join(every, close).select("repx", "repy"))
    return _with_signatures(pairs.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), sigs, percent)


def _found(df: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, set_hash: one row per row of ``df``."""
    docs = stored(signatures(df, width, id_col, text_col), "minhash-signatures")
    # a class is its set; it gets a number of its own, as rows of one id may stand in several classes
    classes = stored(docs.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_hash").agg(
        F.min("doc_id").alias("low"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("signature").alias("signature")).withColumn("rep", F.monotonically_increasing_id()), "minhash-classes")
    sigs = classes.select("rep", "n_shingles", "signature", F.col("n_shingles").alias("most"))
    keys = classes.select("rep", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stored(keys.join(shared, "key"), "minhash-buckets")
    pivots = buckets.groupBy("key").agg(F.array(F.min("rep"), *[
        F.min_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(1, PIVOTS)]).alias("pivots"))
    pairs = buckets.join(pivots, "key").select("rep", F.explode(F.array_distinct("pivots")).alias("p")).filter("rep <> p") \
        .select(F.greatest("rep", "p").alias("x"), F.least("rep", "p").alias("y")).distinct()
    labels = stored(classes.select("rep", F.col("rep").alias("comp")), "minhash-labels")

    def texts(named: DataFrame) -> DataFrame:
        return stored(_class_texts(df, classes.join(named, "rep", "left_semi"), width, id_col, text_col), "minhash-texts")

    near = stored(_with_signatures(pairs, sigs, percent), "minhash-pairs")
    named = stored(near.select("x").union(near.select("y")).toDF("rep").distinct(), "minhash-named")
    if named.limit(1).count():
        labels = _link_all(near, labels, texts(named), width, percent)
    buckets = buckets.filter("n > 2").select("key", "rep")
    mixed = stored(_mixed(buckets, labels), "minhash-mixed")
    named = stored(mixed.select("rep").distinct(), "minhash-named")
    if named.limit(1).count():
        some = texts(named)
        sets = stored(_sets(some, width), "minhash-sets")
        sigs = sigs.join(named, "rep").join(_shared(sets), "rep", "left") \
            .withColumn("most", F.col("n_shingles") - F.coalesce("own", F.lit(0))).drop("own")
        # a class that shares too little with all others together has no link
        sigs = stored(sigs.filter(F.col("most") * 100 >= F.col("n_shingles") * percent), "minhash-shared")
        buckets = stored(mixed.select("key", "rep").join(sigs.select("rep"), "rep", "left_semi"), "minhash-buckets")
        near = stored(_with_signatures(_light_pairs(_mixed(buckets, labels), sigs), sigs, percent), "minhash-pairs")
        labels = _link_all(near, labels, some, width, percent)
        mixed = stored(_mixed(buckets, labels), "minhash-mixed")
        labels = _link_all(stored(_across(mixed, sigs, sets, percent), "minhash-pairs"), labels, some, width, percent)
    by_set = classes.select("rep", "low", F.col("set_hash").alias("h")).join(labels, "rep").select("rep", "h", "comp", "low")
    # a component's lowest id goes to each part of its classes; a class alone has its own
    lowest = by_set.groupBy("comp").agg(F.min("low").alias("lowest"), F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .select("comp", "lowest", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    by_set = by_set.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(PARTS)).cast("int")).join(lowest, ["comp", "part"], "left") \
        .select("h", F.coalesce("lowest", "low").alias("lowest"))
    found = docs.select("doc_id", "n_shingles", "set_hash").join(by_set, F.col("set_hash") == F.col("h"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "set_hash")


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``df``.  Documents link when
    100 * intersection >= percent * union of their shingle sets."""
    return _found(df, width, percent, id_col, text_col).drop("set_hash")


def drop_near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose id is not the smallest of their component; columns as they
    were.  A row without an id can't be named and stays.  Where rows of one id have different
    fates, the row's own text decides."""
    ident, its_set, its_hash = (free_name(df, n) for n in ("__id", "__set", "__hash"))
    found = _found(df, width, percent, id_col, text_col).filter(F.col("doc_id").isNotNull()) \
        .groupBy(F.col("doc_id").alias(ident), F.col("set_hash").alias(its_set)).agg(F.max("kept").alias("kept"))
    found = stored(found, "minhash-found")
    gone = found.groupBy(ident).agg(F.max("kept").alias("mixed"), F.min("kept").alias("all")).filter("NOT all")
    gone = stored(gone, "minhash-gone")
    named = F.col(id_col).cast("long") == F.col(ident)
    left = df.join(gone, named, "left_anti")
    mixed = gone.filter("mixed")
    if not mixed.limit(1).count():
        return left
    rows = _with_set_hash(df.join(mixed.select(ident), named, "left_semi"), text_col, width, its_hash)
    pairs = found.filter("NOT kept").join(mixed, ident, "left_semi").select(ident, its_set)
    return left.unionByName(rows.join(pairs, named & (F.col(its_hash) == F.col(its_set)), "left_anti").drop(its_hash))

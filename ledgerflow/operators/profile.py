"""Column profiles and chart-ready distributions (C1-C13).

Wide-to-long reshaping (``unpivot`` / ``explode`` of structs) turns
per-column statistics into one grouped aggregate instead of one job per
column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.columns import round_exact, safe_corr
from ledgerflow.operators.quantiles import quantile_columns, small
from ledgerflow.schema import is_profiled_numeric
from ledgerflow.session import cut_lineage
from ledgerflow.sources.csv_tables import ORDER_COLUMN


def _cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ORDER_COLUMN]


def numeric_columns(df: DataFrame, profiled_only: bool = True) -> list[str]:
    out = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != ORDER_COLUMN]
    return [c for c in out if is_profiled_numeric(c)] if profiled_only else out


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name != ORDER_COLUMN]


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def _position(cols: Sequence[str]):
    return F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])


# --- C1 --------------------------------------------------------------------------

def shape(datasets: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("ROWS")).select(
        F.lit(name).alias("DATASET"), "ROWS", F.lit(len(_cols(df))).alias("COLUMNS"))
        for name, df in datasets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- C2 --------------------------------------------------------------------------

def missing(df: DataFrame) -> DataFrame:
    """(COLUMN, MISSING, PCT, POSITION) for columns with nulls; PCT has 2 decimals."""
    cols = _cols(df)
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (row.unpivot(["_rows"], cols, "COLUMN_NAME", "MISSING").where(F.col("MISSING") > 0)
            .select("COLUMN_NAME", F.col("MISSING").cast("long").alias("MISSING"),
                    round_exact(F.col("MISSING") * 100.0 / F.col("_rows"), 2, 10).alias("PCT"),
                    _position(cols)[F.col("COLUMN_NAME")].alias("POSITION")))


# --- C3 --------------------------------------------------------------------------

def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """(COLUMN_NAME, N_DISTINCT), nulls excluded.  Exact by default: the different values of each column on their
    own, in their own type (partial sets before the shuffle, which carries one value and nothing of the other
    columns); every column is a scan of that column, so give a stored table.  ``approx`` uses HyperLogLog++
    sketches in one aggregate instead (fixed memory per column)."""
    cols = list(columns or _cols(df))
    if approx:
        row = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias(c) for c in cols])
        return row.unpivot([], [F.col(f"`{c}`") for c in cols], "COLUMN_NAME", "N_DISTINCT").select(
            "COLUMN_NAME", F.col("N_DISTINCT").cast("long").alias("N_DISTINCT"))
    return reduce(DataFrame.unionByName, [
        df.select(F.col(f"`{c}`").alias("VALUE")).where(F.col("VALUE").isNotNull()).distinct()
        .agg(F.count(F.lit(1)).alias("N_DISTINCT")).select(F.lit(c).alias("COLUMN_NAME"), "N_DISTINCT") for c in cols])


# --- C4 / C6 -----------------------------------------------------------------------

def describe(df: DataFrame, columns: Sequence[str] | None = None, rounded: bool = True,
             approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """count, mean, std (sample), min, quartiles (exact, interpolated), max per
    numeric column; ID-like and calendar columns excluded by default.
    ``approx`` takes the quartiles from a sketch (``percentile_approx``)."""
    cols = list(columns if columns is not None else numeric_columns(df))
    types = [df.schema[c].dataType for c in cols]
    exact = all(isinstance(t, (T.DecimalType, T.IntegralType)) for t in types)
    scale = max([t.scale for t in types if isinstance(t, T.DecimalType)] + [0])
    as_type = f"decimal(38,{scale})" if exact else "double"   # exact sums when the inputs are exact
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(c).cast(as_type).alias("X")) for c in cols
    ])).alias("r")).select("r.*")
    moments = long.groupBy("COLUMN_NAME").agg(
        F.count("X").alias("COUNT"), F.avg("X").alias("MEAN"),
        F.stddev_samp(F.col("X").cast("double")).alias("STD"),
        F.min("X").alias("MIN"), F.max("X").alias("MAX"))
    if approx:
        pq = F.percentile_approx(F.col("X").cast("double"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)
        q = long.groupBy("COLUMN_NAME").agg(pq.alias("_q")).select(
            "COLUMN_NAME", *[F.col("_q")[i].alias(n) for i, n in enumerate(("P25", "P50", "P75"))])
    else:
        values = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(c).cast("double").alias("X")) for c in cols])))
        q = quantile_columns(values, ["COLUMN_NAME"], "X", [0.25, 0.5, 0.75], ["P25", "P50", "P75"])
    out = moments.join(q, on="COLUMN_NAME", how="left")
    stats = ["MEAN", "STD", "MIN", "P25", "P50", "P75", "MAX"]
    fix = (lambda c: round_exact(c, 2)) if rounded else (lambda c: F.col(c).cast("double"))
    return out.select("COLUMN_NAME", F.col("COUNT").cast("double").alias("COUNT"), *[fix(c).alias(c) for c in stats])


def numeric_range(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns if columns is not None else numeric_columns(df))
    row = df.agg(*[e for c in cols for e in (F.min(c).cast("double").alias(f"{c}__min"),
                                             F.max(c).cast("double").alias(f"{c}__max"))])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(f"{c}__min").alias("MIN"), F.col(f"{c}__max").alias("MAX"))
        for c in cols])).alias("r")).select("r.*")


# --- C5 --------------------------------------------------------------------------

def top_values(df: DataFrame, k: int = 5, columns: Sequence[str] | None = None,
               include_nulls: bool = True) -> DataFrame:
    """(COLUMN, RANK, VALUE, FREQUENCY, PCT) per categorical column.

    One grouped count for each column (a scan of that column, so give a stored
    table); ties are broken by value ascending (null last).  Every partition
    keeps its first k values, so the ranking reads k rows a partition.
    """
    cols = list(columns if columns is not None else categorical_columns(df))
    order = [F.desc("FREQUENCY"), F.asc_nulls_last("VALUE")]

    def first_of(c: str) -> DataFrame:
        values = df.select(F.col(f"`{c}`").cast("string").alias("VALUE"))
        counts = (values if include_nulls else values.where(F.col("VALUE").isNotNull())).groupBy("VALUE").agg(F.count(F.lit(1)).alias("FREQUENCY"))
        return counts.select(F.lit(c).alias("COLUMN_NAME"), "VALUE", "FREQUENCY")
    top = reduce(DataFrame.unionByName, [first_of(c) for c in cols])
    top = top.withColumn("RANK", F.row_number().over(Window.partitionBy("COLUMN_NAME").orderBy(*order))).where(F.col("RANK") <= k)
    if include_nulls:
        base = df.agg(F.count(F.lit(1)).alias("_n")).select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("COLUMN_NAME"), F.col("_n").alias("_n")) for c in cols])).alias("r")).select("r.*")
    else:
        base = df.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "COLUMN_NAME", "_n")
    return top.join(base, on="COLUMN_NAME").select(
        "COLUMN_NAME", F.col("RANK").cast("int").alias("RANK"), "VALUE", "FREQUENCY",
        round_exact(F.col("FREQUENCY") * 100.0 / F.col("_n"), 2, 10).alias("PCT"))


# --- C7 --------------------------------------------------------------------------

def date_range(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns if columns is not None else date_columns(df))
    row = df.agg(*[e for c in cols for e in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(f"{c}__min").alias("MIN"), F.col(f"{c}__max").alias("MAX"))
        for c in cols])).alias("r")).select("r.*")


# --- C8 / C9 ------------------------------------------------------------------------

EXPRESSION_COLUMNS = 64     # wider tables take co-moment blocks instead of an expression for each pair
BLOCK_COLUMNS = 512         # of one side of a block: a task holds six matrices of this width
BLOCK_ROWS = 1024


def correlation(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 3) -> DataFrame:
    """Pearson matrix in long form (COL_A, COL_B, CORR), pairwise-complete
    rows, null (not an error) for a constant column.

    The matrix is symmetric, so only the upper triangle is computed, in one
    ungrouped aggregate over the input rows; tables of more than 64 columns
    take ``correlation_blocks``.
    """
    cols = list(columns if columns is not None else numeric_columns(df, profiled_only=False))
    if len(cols) < 2:
        return None
    if len(cols) > EXPRESSION_COLUMNS:
        return correlation_blocks(df, cols, digits)
    upper = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[safe_corr(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in upper])
    cells = [F.struct(F.lit(cols[i]).alias("COL_A"), F.lit(cols[j]).alias("COL_B"),
                      F.round(F.col(f"c{min(i, j)}_{max(i, j)}"), digits).alias("CORR"))
             for i in range(len(cols)) for j in range(len(cols))]
    return row.select(F.inline(F.array(*cells)))


def _co_moments(df: DataFrame, cols: list[str], left: range, right: range, shift: list[float]) -> DataFrame:
    """(I, J, N, SX, SY, SXX, SYY, SXY) for the pairs I <= J of two column blocks: every task sums its rows with
    matrix products (values about ``shift``, zeros and a mask for nulls) and gives one row a pair."""
    own = sorted({*left, *right})
    at = {c: k for k, c in enumerate(own)}
    a, b = [at[i] for i in left], [at[j] for j in right]

    def partial(batches):
        import numpy as np
        import pyarrow as pa
        n, sx, sy, sxx, syy, sxy = (np.zeros((len(a), len(b))) for _ in range(6))
        for whole in batches:
            for s in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(s, BLOCK_ROWS)
                x, m = np.zeros((batch.num_rows, len(own))), np.zeros((batch.num_rows, len(own)))
                for k, i in enumerate(own):
                    m[:, k] = batch.column(k).is_valid().to_numpy(zero_copy_only=False)
                    x[:, k] = np.where(m[:, k] > 0, batch.column(k).fill_null(0.0).to_numpy(zero_copy_only=False) - shift[i], 0.0)
                xa, xb, ma, mb = x[:, a], x[:, b], m[:, a], m[:, b]
                n += ma.T @ mb
                sx += xa.T @ mb
                sy += ma.T @ xb
                sxx += (xa * xa).T @ mb
                syy += ma.T @ (xb * xb)
                sxy += xa.T @ xb
        i, j = np.meshgrid(np.array(left), np.array(right), indexing="ij")
        keep = i <= j
        yield pa.RecordBatch.from_arrays(
            [pa.array(i[keep], pa.int32()), pa.array(j[keep], pa.int32()), *[pa.array(v[keep]) for v in (n, sx, sy, sxx, syy, sxy)]],
            names=["I", "J", "N", "SX", "SY", "SXX", "SYY", "SXY"])

    values = df.select(*[F.col(f"`{cols[i]}`").cast("double").alias(f"c{i}") for i in own])
    return values.mapInArrow(partial, "I int, J int, N double, SX double, SY double, SXX double, SYY double, SXY double")


def correlation_blocks(df: DataFrame, cols: Sequence[str], digits: int = 3, block: int = BLOCK_COLUMNS) -> DataFrame:
    """``correlation`` for wide tables: co-moments of column blocks by row batches.  The plan has a scan for each
    pair of blocks, not an expression for each pair of columns, and a task's memory is set by the block.

    Values are taken about the column's mean (one aggregate before).  A pair with one row or none, with a NaN or
    an infinite value, or whose spread over the common rows is under 3e-7 of their distance from the column's
    mean (constant, up to rounding) has a null correlation."""
    cols = list(cols)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    finite = [m is not None and abs(m) < float("inf") for m in means]          # False for NaN too
    shift = [float(m) if ok else 0.0 for m, ok in zip(means, finite)]
    blocks = [range(s, min(s + block, len(cols))) for s in range(0, len(cols), block)]
    parts = [_co_moments(df, cols, u, v, shift) for p, u in enumerate(blocks) for v in blocks[p:]]
    # every pair once with zeros, so that an empty table has its rows too
    moments = df.sparkSession.range(len(cols)).select(
        F.col("id").cast("int").alias("I"), F.explode(F.sequence(F.col("id").cast("int"), F.lit(len(cols) - 1))).alias("J"),
        *[F.lit(0.0).alias(c) for c in ("N", "SX", "SY", "SXX", "SYY", "SXY")])
    for part in parts:
        moments = moments.unionByName(part)
    total = moments.groupBy("I", "J").agg(*[F.sum(c).alias(c) for c in ("N", "SX", "SY", "SXX", "SYY", "SXY")])
    vx, vy = F.col("SXX") - F.col("SX") * F.col("SX") / F.col("N"), F.col("SYY") - F.col("SY") * F.col("SY") / F.col("N")
    spread = (F.col("N") > 1) & (vx > F.col("SXX") * 1e-13) & (vy > F.col("SYY") * 1e-13)
    r = F.when(spread, (F.col("SXY") - F.col("SX") * F.col("SY") / F.col("N")) / (F.sqrt(vx) * F.sqrt(vy)))
    r = F.when(r.isNotNull() & ~F.isnan(r), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    names = F.array(*[F.lit(c) for c in cols])
    both = total.select("I", "J", F.round(r, digits).alias("CORR")).select("CORR", F.explode(F.when(
        F.col("I") == F.col("J"), F.array(F.struct(F.col("I").alias("A"), F.col("J").alias("B")))).otherwise(
        F.array(F.struct(F.col("I").alias("A"), F.col("J").alias("B")), F.struct(F.col("J").alias("A"), F.col("I").alias("B"))))).alias("p"))
    return both.select(F.element_at(names, F.col("p.A") + 1).alias("COL_A"), F.element_at(names, F.col("p.B") + 1).alias("COL_B"), "CORR")


def correlation_with_profit(df: DataFrame, digits: int = 3) -> DataFrame:
    with_profit = df.withColumn("VAL_PROFIT", F.col("VAL_REVENUES") - F.col("VAL_COST"))
    return correlation(with_profit, ["VAL_REVENUES", "VAL_COST", "VAL_PROFIT"], digits)


# --- C10 / C11 / C13: equal-width bins and density -------------------------------------

def _bounds(df: DataFrame, col: str):
    x = F.col(col).cast("double")
    return df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()


def _bin(x, lo, hi, bins: int):
    """0-based equal-width bin; the top edge belongs to the last bin."""
    raw = F.floor((x - lo) * F.lit(float(bins)) / (hi - lo))
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, col: str = "VAL_REVENUES", bins: int = 50) -> DataFrame:
    """(BIN, LOWER, UPPER, COUNT) for all bins, empty ones included.  The
    range comes from two scalar subqueries (one value each); constant data
    get a range of 1 around the value."""
    x = F.col(col).cast("double")
    lo, hi = _bounds(df, col)
    lo, hi = F.when(hi == lo, lo - 0.5).otherwise(lo), F.when(hi == lo, hi + 0.5).otherwise(hi)
    counts = df.where(x.isNotNull()).groupBy(_bin(x, lo, hi, bins).alias("BIN")).agg(
        F.count(F.lit(1)).alias("COUNT"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("BIN"))
    width = (hi - lo) / F.lit(float(bins))
    return edges.join(counts, on="BIN", how="left").select(
        "BIN", (lo + F.col("BIN") * width).alias("LOWER"), (lo + (F.col("BIN") + 1) * width).alias("UPPER"),
        F.coalesce("COUNT", F.lit(0)).cast("long").alias("COUNT"))


TERMS = 12          # of the kernel's series in a cell; with cells of a quarter bandwidth the rest is below 3e-16


def kernel_moments(values: DataFrame, lo: float, h: float) -> DataFrame:
    """(CELL, M0, M1, ..): for every occupied cell of a quarter bandwidth, from ``lo`` on, the sums over its
    rows of exp(-t^2/2) t^k / k!, with t the distance to the middle of the cell in bandwidths.  Sums of
    disjoint inputs add up."""
    at = (F.col("x") - F.lit(lo)) / F.lit(h)
    cell = F.floor(at * 4.0)
    rows = values.select(cell.alias("CELL"), (at - (cell + 0.5) / 4.0).alias("t"))
    rows = rows.select("CELL", "t", F.exp(F.col("t") * F.col("t") * -0.5).alias("e"))
    factorial, sums, power = 1.0, [], F.col("e")
    for k in range(TERMS):
        sums.append((F.sum(power) / F.lit(factorial)).alias(f"M{k}"))
        factorial, power = factorial * (k + 1), power * F.col("t")
    return rows.groupBy("CELL").agg(*sums)


def density(df: DataFrame, col: str = "VAL_REVENUES", grid: int = 200, bins: int = 50,
            digits: int = 6, count_digits: int = 3) -> DataFrame:
    """Gaussian kernel density on ``grid`` points spanning [min, max]
    (no extension past the data), Scott bandwidth ``std * n^(-1/5)``.

    The four parameters come from one 1-row aggregate.  One JVM aggregate then reduces the rows to
    kernel moments of cells a quarter bandwidth wide, and each occupied cell adds to every grid point
    exp(-z^2/2) * sum(M_k z^k), with z the distance of the point to the cell's middle: the kernel's
    exponential series about the middle.  Since |t| <= 1/8, what the series leaves out is at most
    z^12 exp(z/8 - z^2/2) / (8^12 12!) < 1e-15 of a kernel's height for each row, less than a double's
    rounding.  The shuffle carries cells, not rows, and no Python worker sees a row.
    DENSITY_PER_MILLION is the pdf times 1e6; COUNT_DENSITY scales it to the histogram's expected
    count per bin.  Both are rounded to about 8 significant digits: the kernel sums depend on summation
    order in the last few digits.  Null and NaN are left out; no data or constant data give None.
    """
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    st = df.where(x.isNotNull()).select(x.alias("x"))
    p = st.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"),
               F.stddev_samp("x").alias("sd")).first()
    if not p["n"] or not p["sd"] or p["hi"] == p["lo"]:
        return None                      # no data or constant data: no curve
    lo, hi, n = float(p["lo"]), float(p["hi"]), float(p["n"])
    h = p["sd"] * n ** -0.2
    step = (hi - lo) / (grid - 1)

    points = F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("POINT")
    z = F.col("POINT") * F.lit(step / h) - (F.col("CELL") + 0.5) / 4.0
    series = F.lit(0.0)
    for k in reversed(range(TERMS)):
        series = series * F.col("z") + F.col(f"M{k}")
    cells = kernel_moments(st, lo, h).select("*", points).withColumn("z", z)
    sums = cells.groupBy("POINT").agg(F.sum(F.exp(F.col("z") * F.col("z") * -0.5) * series).alias("S"))
    pdf = F.col("S") / (F.lit(n) * F.lit(h) * F.lit(2.5066282746310002))
    return sums.select("POINT", (F.lit(lo) + F.col("POINT") * F.lit(step)).alias("X"),
                       F.round(pdf * F.lit(1e6), digits).alias("DENSITY_PER_MILLION"),
                       F.round(pdf * F.lit(n) * F.lit((hi - lo) / bins), count_digits).alias("COUNT_DENSITY"))


def binned_pairs(df: DataFrame, x_col: str = "VAL_COST", y_col: str = "VAL_REVENUES",
                 bins: int = 50) -> DataFrame:
    """2-D equal-width bin counts (BIN_X, BIN_Y, COUNT): the scatter plot's
    data reduced to at most bins^2 rows, whatever the input size."""
    x, y = F.col(x_col).cast("double"), F.col(y_col).cast("double")
    xlo, xhi = _bounds(df, x_col)
    ylo, yhi = _bounds(df, y_col)
    return df.where(x.isNotNull() & y.isNotNull()).groupBy(
        _bin(x, xlo, xhi, bins).alias("BIN_X"), _bin(y, ylo, yhi, bins).alias("BIN_Y")).agg(
        F.count(F.lit(1)).alias("COUNT"))


# --- C12 -----------------------------------------------------------------------------

def box_stats(df: DataFrame, group: str = "ID_BUSINESS_LINE", col: str = "VAL_REVENUES",
              whisker: float = 1.5) -> DataFrame:
    """Per group: quartiles (exact), IQR, whisker ends (most extreme values
    within 1.5 IQR of the box), outlier count.  NaN counts as null."""
    q = quantile_columns(df, [group], col, [0.25, 0.5, 0.75], ["Q1", "MEDIAN", "Q3"])
    q = cut_lineage(q.withColumn("IQR", F.col("Q3") - F.col("Q1")))
    lo = F.col("Q1") - F.lit(whisker) * F.col("IQR")
    hi = F.col("Q3") + F.lit(whisker) * F.col("IQR")
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    rows = df.select(group, x.alias("_x")).where(F.col("_x").isNotNull())
    inside = (F.col("_x") >= lo) & (F.col("_x") <= hi)
    tails = rows.join(small(q), on=group).groupBy(group).agg(
        F.count(F.lit(1)).alias("N"),
        F.min(F.when(inside, F.col("_x"))).alias("WHISKER_LOW"),
        F.max(F.when(inside, F.col("_x"))).alias("WHISKER_HIGH"),
        F.sum(F.when(inside, 0).otherwise(1)).alias("N_OUTLIERS"))
    out = q.join(tails, on=group)
    return out.select(group, "N", *[round_exact(c, 2).alias(c) for c in
                                    ("Q1", "MEDIAN", "Q3", "IQR", "WHISKER_LOW", "WHISKER_HIGH")], "N_OUTLIERS")

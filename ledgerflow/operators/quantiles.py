"""Exact quantiles with bounded per-task memory, one path for every size.

Spark's ``percentile`` keeps every distinct value of a group in one buffer,
which a hot group at scale cannot afford, and a shuffle of all distinct values
is as large as the table.  Here each target order statistic keeps a bracket of
values around it with the exact number of rows below (NaN counts as null):

1. every bracket starts as the whole range of its group;
2. while a bracket may hold more than ``rank_limit`` *different* values, one pass
   cuts it into ``grid`` cells, counts the rows of each exactly (partial sums, so
   that the shuffle carries cells) and moves the bracket to the range of values
   in the cell that holds its target.  Cells are equally wide by value and by
   logarithm in turn, so that a range of many magnitudes narrows as fast;
3. inside the final brackets equal values are counted and a running count over
   the different values finds the order statistics, which are interpolated
   linearly (numpy's default, DuckDB's ``quantile_cont``).

The lowest and the highest value of a bracket lie in different cells, so every
round narrows it.  The limits only say when to narrow further, never what is
counted: any limit gives the same result.  Driver-side, two numbers are read a
round.  The rows are read once a round: give a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_LIMIT = 1_000_000
GRID = 4096          # cells of a bracket
SMALL_ROWS = 10_000  # of brackets or groups that are broadcast to the rows; more of them are joined by key
_MAX = 1.7976931348623157e308


def _rows(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys.., _x) of the rows whose value is neither null nor NaN."""
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    return df.select(*keys, x.alias("_x")).where(F.col("_x").isNotNull())


def small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it has few rows: the other side of its join isn't shuffled then."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def _inside(rows: DataFrame, keys: list[str], brackets: DataFrame) -> DataFrame:
    """The rows in each different bracket of a stored table of brackets."""
    b = small(_freeze(brackets.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_lo", "_hi").distinct()))
    on = [rows[k].eqNullSafe(b[f"_k_{k}"]) for k in keys]
    return rows.join(b, on).where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))).drop(*[f"_k_{k}" for k in keys])


def _joined(state: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """The state with the columns of ``other`` (a table by bracket) beside it."""
    o = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_lo").alias("_l"), F.col("_hi").alias("_h"),
                     *[c for c in other.columns if c not in (*keys, "_lo", "_hi")])
    on = [state[k].eqNullSafe(o[f"_k_{k}"]) for k in keys] + [state["_lo"] == o["_l"], state["_hi"] == o["_h"]]
    return state.join(o, on).drop(*[f"_k_{k}" for k in keys], "_l", "_h")


def _cell(grid: int, by_logarithm: bool) -> Column:
    """0-based cell of ``_x`` in its bracket; never falls as ``_x`` grows, 0 for ``_lo`` and the last for ``_hi``."""
    def at(c: str) -> Column:
        x = F.greatest(F.lit(-_MAX), F.least(F.lit(_MAX), F.col(c)))
        far = F.greatest(F.abs("_lo"), F.abs("_hi")) > 1e307               # a difference could overflow
        return F.signum(x) * (F.log2(F.abs(x) + 1e-300) + 1000.0) if by_logarithm else F.when(far, x / 4.0).otherwise(x)
    x, lo, hi = at("_x"), at("_lo"), at("_hi")
    even = F.floor(F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(0.5) * F.lit(float(grid - 2)))
    return F.when(F.col("_x") == F.col("_lo"), F.lit(0)).when(F.col("_x") == F.col("_hi"), F.lit(grid - 1)) \
        .otherwise(F.greatest(F.lit(0), F.least(F.lit(grid - 3), even)) + 1).cast("int")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    rank_limit: int = RANK_LIMIT, grid: int = GRID) -> DataFrame:
    """(keys.., PROB, QUANTILE) per group with at least one value that is neither null nor NaN."""
    keys, grid = list(keys), max(grid, 3)
    if not keys:
        raise ValueError("at least one grouping column is needed")
    rows = _rows(df, keys, value)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    targets = sizes.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("PROB")) \
        .withColumn("_pos", F.col("PROB") * (F.col("_n") - 1)).withColumn("_i", F.floor("_pos").cast("long")) \
        .withColumn("_frac", F.col("_pos") - F.col("_i"))
    # with a fraction of 0 the next order statistic has no weight
    ranks = F.when(F.col("_frac") == 0, F.array(F.col("_i"))).otherwise(F.array(F.col("_i"), F.col("_i") + 1))
    state = _freeze(targets.select(
        *keys, "PROB", "_frac", F.posexplode(ranks).alias("_side", "_t"), "_lo", "_hi",
        F.when(F.col("_lo") == F.col("_hi"), 1).otherwise(F.col("_n")).cast("long").alias("_m")))      # groups x probabilities rows
    turn = 0
    while True:
        widest = state.agg(F.max("_m")).first()[0]
        if widest is None or widest <= max(rank_limit, 1):
            break
        open_ = state.where(F.col("_m") > rank_limit)
        cells = _inside(rows, keys, open_).groupBy(*keys, "_lo", "_hi", _cell(grid, turn % 2 == 1).alias("_cell")).agg(
            F.count(F.lit(1)).alias("_cw"), F.min("_x").alias("_cl"), F.max("_x").alias("_ch"))
        run = Window.partitionBy(*keys, "_lo", "_hi").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
        cells = cells.withColumn("_to", F.sum("_cw").over(run))
        # ``_t`` counts from the bracket's first row
        moved = _joined(open_, cells, keys).where((F.col("_to") > F.col("_t")) & (F.col("_to") - F.col("_cw") <= F.col("_t")))
        state = _freeze(moved.select(
            *keys, "PROB", "_frac", "_side", (F.col("_t") - F.col("_to") + F.col("_cw")).alias("_t"), F.col("_cl").alias("_lo"),
            F.col("_ch").alias("_hi"), F.when(F.col("_cl") == F.col("_ch"), 1).otherwise(F.col("_cw")).cast("long").alias("_m"))
            .unionByName(state.where(F.col("_m") <= rank_limit)))
        turn += 1

    # a bracket of one value is that value; one running count per different bracket of more
    known = state.where(F.col("_lo") == F.col("_hi")).withColumn("_x", F.col("_lo"))
    wide = state.where(F.col("_lo") < F.col("_hi"))
    run = Window.partitionBy(*keys, "_lo", "_hi").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _inside(rows, keys, wide).groupBy(*keys, "_lo", "_hi", "_x").agg(F.count(F.lit(1)).alias("_c")) \
        .withColumn("_to", F.sum("_c").over(run))
    found = _joined(wide, ranked, keys).where((F.col("_to") > F.col("_t")) & (F.col("_to") - F.col("_c") <= F.col("_t")))
    vals = known.unionByName(found.select(known.columns)).groupBy(*keys, "PROB", "_frac").agg(
        F.max(F.when(F.col("_side") == 0, F.col("_x"))).alias("_a"), F.max(F.when(F.col("_side") == 1, F.col("_x"))).alias("_b"))
    return vals.select(*keys, "PROB", F.when(F.col("_frac") == 0, F.col("_a")).otherwise(
        F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac")).alias("QUANTILE"))


def _freeze(state: DataFrame) -> DataFrame:
    """Store a table that several rounds read, so that each starts from stored
    rows instead of replaying the ones before."""
    from ledgerflow.session import cut_lineage
    return cut_lineage(state)


def quantile_columns(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                     names: Sequence[str], **kw) -> DataFrame:
    """Quantiles as columns: (keys.., names..)."""
    q = exact_quantiles(df, keys, value, probs, **kw)
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("PROB") == F.lit(float(p)), F.col("QUANTILE"))).alias(n)
                                  for p, n in zip(probs, names)])

"""Monthly revenue forecasting (F1-F10).

The default is one total series (the source's behaviour); ``series_keys``
fits one model per company, business line, ... in the same jobs: every
window is partitioned by the series and every aggregate groups by it.

Linear regression is solved in column expressions (centred moments, 3x3
Cramer), so fitting any number of series is one aggregate.  Gradient
boosting (operators.boosting) fits all series and folds together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.aggregate import monthly_total
from ledgerflow.operators.boosting import Boosting, fit, importances, predict

FEATURES = ("MONTH_IDX", "ORDER_MONTH", "LAG_1")
TARGET = "TOTAL_REVENUES"


def _series_window(series_keys: Sequence[str]):
    w = Window.partitionBy(*series_keys) if series_keys else Window.partitionBy()
    return w.orderBy("ORDER_YEAR", "ORDER_MONTH")


# --- F1 -----------------------------------------------------------------------------

def monthly_series(monthly: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Consolidated monthly totals with MONTH_IDX over the months present
    (gaps are not filled)."""
    mt = monthly_total(monthly, series_keys, as_double=True)
    return mt.withColumn("MONTH_IDX", (F.row_number().over(_series_window(series_keys)) - 1).cast("int"))


def features(monthly: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """(series.., ORDER_YEAR, ORDER_MONTH, MONTH_IDX, LAG_1, TOTAL_REVENUES, N_ORDERS, SAMPLE):
    LAG_1 is the previous present month; the first month is dropped.
    SAMPLE is the 0-based position among the kept rows."""
    s = monthly_series(monthly, series_keys)
    s = s.withColumn("LAG_1", F.lag(TARGET, 1).over(_series_window(series_keys)))
    return s.where(F.col("LAG_1").isNotNull()).withColumn("SAMPLE", F.col("MONTH_IDX") - 1)


# --- F2 -----------------------------------------------------------------------------

def cv_folds(feats: DataFrame, series_keys: Sequence[str] = (), n_splits: int = 3) -> DataFrame:
    """Expanding-window folds: each series' samples split into n_splits+1
    blocks of n // (n_splits+1) (the remainder joins the first training
    block); fold f tests block f and trains on everything before it.  Fold 0
    is the final fit on all samples.  Rows: (.., FOLD, ROLE)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*series_keys) if series_keys else Window.partitionBy())
    with_n = feats.withColumn("_n", n).withColumn("_ts", F.floor(F.col("_n") / (n_splits + 1)).cast("long"))
    roles = []
    for f in range(0, n_splits + 1):
        if f == 0:
            role = F.lit("TRAIN")
        else:
            start = F.col("_n") - (n_splits - f + 1) * F.col("_ts")
            role = (F.when(F.col("_ts") < 1, F.lit(None))
                    .when(F.col("SAMPLE") < start, F.lit("TRAIN"))
                    .when(F.col("SAMPLE") < start + F.col("_ts"), F.lit("TEST")))
        roles.append(F.struct(F.lit(f).alias("FOLD"), role.alias("ROLE")))
    return (with_n.select("*", F.explode(F.array(*roles)).alias("_f")).select("*", "_f.*")
            .drop("_f", "_n", "_ts").where(F.col("ROLE").isNotNull()))


# --- F3 -----------------------------------------------------------------------------

def _det3(a):
    return (a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1])
            - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0])
            + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0]))


def linear_fit(folded: DataFrame, series_keys: Sequence[str] = (), rel_tol: float = 1e-10) -> DataFrame:
    """OLS with intercept per (series, FOLD) on the TRAIN rows; of all solutions the one of
    minimum norm, as least-squares solvers give for collinear features.

    Slopes solve A b = c with A = Cov(X), c = Cov(X, y) (sample covariances from a stable
    online aggregate; 0 for a single row); intercept = mean(y) - b . mean(X).  RANK is the
    rank of the correlation matrix: 3 gives Cramer's rule, 2 and 1 the closed forms of the
    pseudo-inverse (from A's characteristic polynomial on its range), 0 a constant.
    SINGULAR says RANK < 3.
    """
    keys = [*series_keys, "FOLD"]
    xs = [F.col(c).cast("double") for c in FEATURES]
    y = F.col(TARGET).cast("double")
    train = folded.where(F.col("ROLE") == "TRAIN")
    zero = F.lit(0.0)
    aggs = [F.count(F.lit(1)).alias("N_TRAIN"), F.avg(y).alias("_my")]
    aggs += [F.avg(x).alias(f"_m{i}") for i, x in enumerate(xs)]
    aggs += [F.coalesce(F.covar_samp(xs[i], xs[j]), zero).alias(f"_c{i}{j}") for i in range(3) for j in range(i, 3)]
    aggs += [F.coalesce(F.covar_samp(xs[i], y), zero).alias(f"_c{i}y") for i in range(3)]
    return _solve(train.groupBy(*keys).agg(*aggs), keys, rel_tol)


def _solve(m: DataFrame, keys: Sequence[str], rel_tol: float = 1e-10) -> DataFrame:
    """Coefficients from moments: N_TRAIN, means ``_m0.._m2`` and ``_my``, sample covariances ``_c01``, ``_c0y``, ..."""
    zero = F.lit(0.0)

    def c(i, j):
        i, j = min(i, j), max(i, j)
        return F.col(f"_c{i}{j}")
    a = [[c(i, j) for j in range(3)] for i in range(3)]
    rhs = [F.col(f"_c{i}y") for i in range(3)]
    varies = [c(i, i) > F.lit(1e-24) * F.col(f"_m{i}") * F.col(f"_m{i}") for i in range(3)]
    unit = [[F.when(varies[i], 1.0).otherwise(0.0) if i == j else
             F.when(varies[i] & varies[j], c(i, j) / F.sqrt(c(i, i) * c(j, j))).otherwise(0.0)
             for j in range(3)] for i in range(3)]
    pairs = [(0, 1), (0, 2), (1, 2)]
    minors = sum((unit[i][i] * unit[j][j] - unit[i][j] * unit[i][j] for i, j in pairs), zero)
    rank = F.when(_det3(unit) > rel_tol, 3).when(minors > rel_tol, 2) \
        .when(varies[0] | varies[1] | varies[2], 1).otherwise(0)
    m = m.withColumn("RANK", rank)
    det = _det3(a)
    e2 = sum((a[i][i] * a[j][j] - a[i][j] * a[i][j] for i, j in pairs), zero)
    trace = a[0][0] + a[1][1] + a[2][2]
    betas = []
    for k in range(3):
        ak = [[rhs[i] if j == k else a[i][j] for j in range(3)] for i in range(3)]
        two = sum((a[j][j] * rhs[k] - a[k][j] * rhs[j] for j in range(3) if j != k), zero)
        betas.append(F.when(F.col("RANK") == 3, _det3(ak) / det).when(F.col("RANK") == 2, two / e2)
                     .when(F.col("RANK") == 1, rhs[k] / trace).otherwise(0.0))
    out = m.select(*keys, "N_TRAIN", "RANK", *[b.alias(f"B_{FEATURES[k]}") for k, b in enumerate(betas)],
                   (F.col("RANK") < 3).alias("SINGULAR"), "_my", "_m0", "_m1", "_m2")
    intercept = F.col("_my") - (F.col(f"B_{FEATURES[0]}") * F.col("_m0") + F.col(f"B_{FEATURES[1]}") * F.col("_m1")
                                + F.col(f"B_{FEATURES[2]}") * F.col("_m2"))
    return out.withColumn("INTERCEPT", intercept).drop("_my", "_m0", "_m1", "_m2")


def linear_predict(idx: Column, month: Column, lag: Column) -> Column:
    """b0 + b1*MONTH_IDX + b2*ORDER_MONTH + b3*LAG_1, always in this order."""
    return (((F.col("B_MONTH_IDX") * idx.cast("double") + F.col("B_ORDER_MONTH") * month.cast("double"))
             + F.col("B_LAG_1") * lag.cast("double")) + F.col("INTERCEPT"))


# --- F5 -----------------------------------------------------------------------------

def fold_metrics(predicted: DataFrame, series_keys: Sequence[str] = (), model: str = "LINEAR") -> DataFrame:
    """Per (series, FOLD>0): MAE, RMSE, R2 over TEST rows (R2 = 1 - SSE/SST;
    a constant test target gives 1 if perfectly predicted, else 0); then a
    FOLD = 0 row holding their plain means.  Nothing is rounded here."""
    keys = [*series_keys, "FOLD"]
    test = predicted.where((F.col("ROLE") == "TEST") & (F.col("FOLD") > 0))
    err = F.col(TARGET).cast("double") - F.col("PREDICTION")
    per = test.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("N_TEST"),
        F.avg(F.abs(err)).alias("MAE"),
        F.sqrt(F.avg(err * err)).alias("RMSE"),
        F.sum(err * err).alias("_sse"),
        (F.count(F.lit(1)) * F.var_pop(F.col(TARGET).cast("double"))).alias("_sst"))
    r2 = (F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst")))
    per = per.withColumn("R2", r2).drop("_sse", "_sst")
    mean = per.groupBy(*series_keys).agg(
        F.lit(0).alias("FOLD"), F.lit(None).cast("long").alias("N_TEST"),
        F.avg("MAE").alias("MAE"), F.avg("RMSE").alias("RMSE"), F.avg("R2").alias("R2"))
    both = per.unionByName(mean)
    return both.select(F.lit(model).alias("MODEL"), *keys, "N_TEST", "MAE", "RMSE", "R2")


def rounded_metrics(metrics: DataFrame) -> DataFrame:
    """MAE and RMSE in whole units, R2 with 4 decimals: the precision of a printed report."""
    return metrics.withColumns({"MAE": F.round("MAE", 0), "RMSE": F.round("RMSE", 0), "R2": F.round("R2", 4)})


def fold_blocks(feats: DataFrame, series_keys: Sequence[str] = (), n_splits: int = 3) -> DataFrame:
    """``feats`` with BLOCK: the fold whose TEST rows hold the sample, 0 for the samples before the first test block.
    The TRAIN rows of fold f are the blocks below f, those of fold 0 are all."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*series_keys) if series_keys else Window.partitionBy())
    size = F.floor(n / (n_splits + 1)).cast("long")
    into = F.col("SAMPLE") - (n - n_splits * size)
    return feats.withColumn("BLOCK", F.when((size < 1) | (into < 0), 0).otherwise(F.floor(into / size) + 1).cast("int"))


_PAIRS = [(i, j) for i in range(3) for j in range(i, 3)] + [(i, 3) for i in range(3)]     # 3 is the target


def prefix_moments(blocked: DataFrame, series_keys: Sequence[str] = (), n_splits: int = 3) -> DataFrame:
    """Moments of the TRAIN rows of every (series, FOLD), as ``_solve`` reads them.

    Each block is summed once (count, means, co-moments); a fold is a prefix of its series' blocks, merged with
    Chan's formula, so rows are not copied for the folds they train, however many folds there are."""
    cols = [F.col(c).cast("double") for c in (*FEATURES, TARGET)]
    n = F.count(F.lit(1)).cast("double")
    parts = blocked.groupBy(*series_keys, "BLOCK").agg(
        n.alias("n"), F.array(*[F.avg(c) for c in cols]).alias("m"),
        F.array(*[F.coalesce(F.covar_pop(cols[i], cols[j]), F.lit(0.0)) * n for i, j in _PAIRS]).alias("c"))
    listed = F.sort_array(F.collect_list(F.struct("BLOCK", "n", "m", "c"))).alias("_blocks")        # n_splits + 1 at most
    series = parts.groupBy(*series_keys).agg(listed) if series_keys else parts.agg(listed)

    def merge(a, b):
        total = a["n"] + b["n"]
        d = [b["m"][i] - a["m"][i] for i in range(4)]
        return F.struct(total.alias("n"), F.array(*[a["m"][i] + d[i] * (b["n"] / total) for i in range(4)]).alias("m"),
                        F.array(*[a["c"][k] + b["c"][k] + d[i] * d[j] * (a["n"] * b["n"] / total)
                                  for k, (i, j) in enumerate(_PAIRS)]).alias("c"))
    nothing = F.struct(F.lit(0.0).alias("n"), F.array(*[F.lit(0.0)] * 4).alias("m"), F.array(*[F.lit(0.0)] * len(_PAIRS)).alias("c"))
    last = F.array_max(F.transform("_blocks", lambda x: x["BLOCK"]))
    folds = series.where(F.size("_blocks") > 0).select(*series_keys, "_blocks", F.explode(F.sequence(F.lit(0), last)).alias("FOLD"))
    train = F.filter("_blocks", lambda x: (F.col("FOLD") == 0) | (x["BLOCK"] < F.col("FOLD")))
    merged = folds.select(*series_keys, "FOLD", F.aggregate(train, nothing, merge).alias("_s"))
    freedom = F.when(F.col("_s.n") > 1, F.col("_s.n") - 1).otherwise(1.0)
    return merged.select(
        *series_keys, "FOLD", F.col("_s.n").cast("long").alias("N_TRAIN"), F.col("_s.m")[3].alias("_my"),
        *[F.col("_s.m")[i].alias(f"_m{i}") for i in range(3)],
        *[(F.col("_s.c")[k] / freedom).alias(f"_c{i}{'y' if j == 3 else j}") for k, (i, j) in enumerate(_PAIRS)])


def linear_cv(monthly: DataFrame, series_keys: Sequence[str] = (), n_splits: int = 3):
    """(TEST rows of every fold with PREDICTION, coefficients of every fold; FOLD 0 is fitted on all samples)."""
    blocked = fold_blocks(features(monthly, series_keys), series_keys, n_splits)
    coef = _solve(prefix_moments(blocked, series_keys, n_splits), [*series_keys, "FOLD"])
    test = blocked.where(F.col("BLOCK") > 0).withColumnRenamed("BLOCK", "FOLD").withColumn("ROLE", F.lit("TEST"))
    pred = test.join(coef, on=[*series_keys, "FOLD"]).withColumn(
        "PREDICTION", linear_predict(F.col("MONTH_IDX"), F.col("ORDER_MONTH"), F.col("LAG_1")))
    return pred, coef


# --- F7 -----------------------------------------------------------------------------

def last_month(monthly: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Last present month per series: (series.., LAST_IDX, LAST_YEAR, LAST_MONTH, LAST_REVENUE)."""
    s = monthly_series(monthly, series_keys)
    last = F.max_by(F.struct("MONTH_IDX", "ORDER_YEAR", "ORDER_MONTH", TARGET),
                    F.struct("ORDER_YEAR", "ORDER_MONTH"))
    g = s.groupBy(*series_keys).agg(last.alias("_l")) if series_keys else s.agg(last.alias("_l"))
    return g.select(*series_keys, F.col("_l.MONTH_IDX").alias("LAST_IDX"), F.col("_l.ORDER_YEAR").alias("LAST_YEAR"),
                    F.col("_l.ORDER_MONTH").alias("LAST_MONTH"), F.col(f"_l.{TARGET}").alias("LAST_REVENUE"))


def _rollout(monthly: DataFrame, models: DataFrame, predict, horizon: int, series_keys: Sequence[str]) -> DataFrame:
    """Autoregressive forecast: each month's clipped, unrounded prediction is
    the next month's LAG_1.  ``models`` has one row per series with the columns
    that ``predict(index, month, lag)`` reads.  The recursion runs inside ONE
    expression per series (``aggregate`` over ``sequence(1, horizon)``); the
    output is rounded to 2 decimals.  Columns: series.., ORDER_YEAR,
    ORDER_MONTH, DATE, FORECAST_REVENUES, TIPO."""
    models = models.withColumn("_has_fit", F.lit(True))
    last = last_month(monthly, series_keys).withColumn("_has_last", F.lit(True))
    # one row per series from both sides, without a join: union by name, then
    # collapse each series' two rows (keeps series present on both sides)
    cols = [c for c in last.columns + models.columns if c not in series_keys]
    merged = last.unionByName(models, allowMissingColumns=True)
    firsts = [F.first(c, ignorenulls=True).alias(c) for c in dict.fromkeys(cols)]
    base = merged.groupBy(*series_keys).agg(*firsts) if series_keys else merged.agg(*firsts)
    base = base.where(F.col("_has_fit") & F.col("_has_last"))
    m, y0, i0 = F.col("LAST_MONTH"), F.col("LAST_YEAR"), F.col("LAST_IDX")

    def step(acc, k):
        month = ((m + k - 1) % 12 + 1)
        pred = F.greatest(predict(i0 + k, month, acc["lag"]), F.lit(0.0))
        row = F.struct(k.alias("STEP"), pred.alias("P"))
        return F.struct(pred.alias("lag"), F.array_append(acc["rows"], row).alias("rows"))

    init = F.struct(F.col("LAST_REVENUE").cast("double").alias("lag"),
                    F.array().cast("array<struct<STEP:int,P:double>>").alias("rows"))
    rolled = base.select(*series_keys, m.alias("_m"), y0.alias("_y"),
                         F.explode(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, step)["rows"]).alias("r"))
    month = ((F.col("_m") + F.col("r.STEP") - 1) % 12 + 1).cast("int")
    year = (F.col("_y") + F.floor((F.col("_m") + F.col("r.STEP") - 1) / 12)).cast("int")
    return rolled.select(*series_keys, year.alias("ORDER_YEAR"), month.alias("ORDER_MONTH"),
                         F.make_date(year, month, F.lit(1)).alias("DATE"),
                         F.round(F.col("r.P"), 2).alias("FORECAST_REVENUES"), F.lit("PREVISIONE").alias("TIPO"))


def rollout_linear(monthly: DataFrame, coef: DataFrame, horizon: int = 6,
                   series_keys: Sequence[str] = ()) -> DataFrame:
    """Roll-out of the final (FOLD 0) linear model of each series."""
    final = coef.where(F.col("FOLD") == 0).select(*series_keys, "B_MONTH_IDX", "B_ORDER_MONTH", "B_LAG_1", "INTERCEPT")
    return _rollout(monthly, final, linear_predict, horizon, series_keys)


# --- F9 / F10 / W7 -------------------------------------------------------------------------

def history_for_export(monthly: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    mt = monthly_total(monthly, series_keys, as_double=True)
    return mt.select(*series_keys, "ORDER_YEAR", "ORDER_MONTH", F.col(TARGET).alias("FORECAST_REVENUES"),
                     F.make_date("ORDER_YEAR", "ORDER_MONTH", F.lit(1)).alias("DATE"),
                     F.lit("STORICO").alias("TIPO"))


def history_plus_forecast(monthly: DataFrame, forecast: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """History (TIPO = STORICO) and forecast (TIPO = PREVISIONE) by column name."""
    return history_for_export(monthly, series_keys).unionByName(forecast.select(
        *series_keys, "ORDER_YEAR", "ORDER_MONTH", "FORECAST_REVENUES", "DATE", "TIPO"))


def separation_date(monthly: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """(series.., DATE): the last month of the history, where a chart separates it from the forecast."""
    return last_month(monthly, series_keys).select(*series_keys, F.make_date("LAST_YEAR", "LAST_MONTH", F.lit(1)).alias("DATE"))


def compare_horizons(forecasts: dict[int, DataFrame]) -> DataFrame:
    out = None
    for h, df in forecasts.items():
        part = df.withColumn("HORIZON", F.lit(h))
        out = part if out is None else out.unionByName(part)
    return out


# --- F4 / F6 / F7 / F8: gradient boosting --------------------------------------------------

def gbt_cv(monthly: DataFrame, series_keys: Sequence[str] = (), n_splits: int = 3, params: Boosting | None = None, **kw):
    """(TEST rows of every fold with PREDICTION, models of every fold; FOLD 0 is the final one on all samples).
    Models are stored, so that metrics, importances and roll-outs read the same fit.  A series too short for
    folds has its final model only, one of a single month none."""
    from ledgerflow.session import cut_lineage
    keys = [*series_keys, "FOLD"]
    folded = cv_folds(features(monthly, series_keys), series_keys, n_splits)
    models = cut_lineage(fit(folded.where(F.col("ROLE") == "TRAIN"), keys, FEATURES, TARGET, "SAMPLE", params, **kw))
    test = folded.where(F.col("ROLE") == "TEST")
    same = [test[k].eqNullSafe(models[k]) for k in keys]
    pred = test.join(models, same).select(*[test[c] for c in test.columns],
                                          predict([F.col(c) for c in FEATURES], params).alias("PREDICTION"))
    return pred, models


def gbt_importance(models: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """(series.., FEATURE, IMPORTANCE) of the final models."""
    return importances(models.where(F.col("FOLD") == 0), series_keys, FEATURES)


def rollout_gbt(monthly: DataFrame, models: DataFrame, horizon: int = 6, series_keys: Sequence[str] = (),
                params: Boosting | None = None) -> DataFrame:
    """Roll-out of the final boosted model of each series, its trees walked inside the same expression."""
    final = models.where(F.col("FOLD") == 0).select(*series_keys, "BASE", "TREES")
    return _rollout(monthly, final, lambda *x: predict(x, params), horizon, series_keys)


def compare_models(monthly: DataFrame, forecasts: dict[str, DataFrame], series_keys: Sequence[str] = ()) -> DataFrame:
    """History and each model's forecast in long form: (MODEL, series.., ORDER_YEAR, ORDER_MONTH, DATE, REVENUES)."""
    hist = history_for_export(monthly, series_keys).select(F.lit("STORICO").alias("MODEL"), *series_keys, "ORDER_YEAR", "ORDER_MONTH",
                                                           "DATE", F.col("FORECAST_REVENUES").alias("REVENUES"))
    out = hist
    for name, df in forecasts.items():
        out = out.unionByName(df.select(F.lit(name).alias("MODEL"), *series_keys, "ORDER_YEAR", "ORDER_MONTH", "DATE",
                                        F.col("FORECAST_REVENUES").alias("REVENUES")))
    return out

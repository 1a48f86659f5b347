import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import forecast as FC


def _monthly(spark, revenues, start=(2020, 1)):
    y, m = start
    data = []
    for r in revenues:
        data.append((y, m, float(r), 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return spark.createDataFrame(data, "ORDER_YEAR int, ORDER_MONTH int, TOTAL_REVENUES double, N_ORDERS long")


def test_features_and_folds_follow_expanding_split(spark):
    monthly = _monthly(spark, range(100, 180))           # 80 months -> 79 samples
    feats = FC.features(monthly)
    assert feats.count() == 79
    folds = FC.cv_folds(feats).collect()
    test = {f: sorted(r.SAMPLE for r in folds if r.FOLD == f and r.ROLE == "TEST") for f in (1, 2, 3)}
    train = {f: sorted(r.SAMPLE for r in folds if r.FOLD == f and r.ROLE == "TRAIN") for f in (0, 1, 2, 3)}
    # n = 79, test size 79 // 4 = 19: tests start at 22, 41, 60
    assert test == {1: list(range(22, 41)), 2: list(range(41, 60)), 3: list(range(60, 79))}
    assert train[1] == list(range(22)) and train[3] == list(range(60)) and train[0] == list(range(79))


def test_too_few_samples_have_no_cv_folds(spark):
    folds = FC.cv_folds(FC.features(_monthly(spark, [1, 2, 3]))).collect()
    assert {r.FOLD for r in folds} == {0}


def test_ols_matches_lstsq(spark):
    rng = np.random.default_rng(0)
    rev = 1000 + np.cumsum(rng.normal(10, 50, 40))
    monthly = _monthly(spark, rev)
    folded = FC.cv_folds(FC.features(monthly))
    coef = {r.FOLD: r for r in FC.linear_fit(folded).collect()}
    pdf = FC.features(monthly).orderBy("SAMPLE").toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf.MONTH_IDX, pdf.ORDER_MONTH, pdf.LAG_1])
    beta = np.linalg.lstsq(X, pdf.TOTAL_REVENUES.to_numpy(), rcond=None)[0]
    c = coef[0]
    assert [c.INTERCEPT, c.B_MONTH_IDX, c.B_ORDER_MONTH, c.B_LAG_1] == pytest.approx(beta, rel=1e-6)


@pytest.mark.parametrize("revenues,rank", [
    ([100 + 7 * i + (i * i) % 11 for i in range(30)], 3),
    ([100 + 7 * i + (i * i) % 11 for i in range(12)], 2),       # one calendar year: month and index are collinear
    ([5.0] * 12, 1), ([5.0] * 30, 2), ([3.0, 5.0], 0)])
def test_minimum_norm_fit_equals_lstsq(spark, revenues, rank):
    monthly = _monthly(spark, revenues, start=(2025, 1))
    c = FC.linear_fit(FC.cv_folds(FC.features(monthly))).where("FOLD = 0").first()
    pdf = FC.features(monthly).orderBy("SAMPLE").toPandas()
    X = pdf[["MONTH_IDX", "ORDER_MONTH", "LAG_1"]].to_numpy(float)
    y = pdf.TOTAL_REVENUES.to_numpy()
    beta = np.linalg.lstsq(X - X.mean(0), y - y.mean(), rcond=1e-9)[0]
    assert c.RANK == rank and c.SINGULAR == (rank < 3)
    assert [c.B_MONTH_IDX, c.B_ORDER_MONTH, c.B_LAG_1] == pytest.approx(beta, rel=1e-6, abs=1e-8)
    assert c.INTERCEPT == pytest.approx(y.mean() - X.mean(0) @ beta, rel=1e-6)


def test_fifteen_months_have_metrics_and_a_forecast(spark):
    monthly = _monthly(spark, [0.3 + 0.01 * i + 0.02 * (i % 3) for i in range(15)], start=(2025, 1))
    pred, coef = FC.linear_cv(monthly)
    metrics = FC.fold_metrics(pred).collect()
    assert len(metrics) == 4 and all(None not in (r.MAE, r.RMSE, r.R2) for r in metrics)
    assert 0 < [r.MAE for r in metrics if r.FOLD == 0][0] < 0.5            # not rounded away
    assert all(r.FORECAST_REVENUES is not None for r in FC.rollout_linear(monthly, coef, 6).collect())
    assert str(FC.separation_date(monthly).first().DATE) == "2026-03-01"


def test_gbt_on_a_short_series(spark):
    preds, models = FC.gbt_cv(_monthly(spark, [1.0, 2.0, 3.0]))
    assert preds.count() == 0 and [r.FOLD for r in models.collect()] == [0]
    assert FC.gbt_cv(_monthly(spark, [1.0]))[1].count() == 0


def test_rollout_wraps_months_and_clips(spark):
    monthly = _monthly(spark, [300, 250, 200, 150, 100, 60, 40, 20, 10, 5], start=(2021, 6))
    _, coef = FC.linear_cv(monthly)
    out = FC.rollout_linear(monthly, coef, horizon=12).orderBy("DATE").collect()
    assert [(r.ORDER_YEAR, r.ORDER_MONTH) for r in out[:3]] == [(2022, 4), (2022, 5), (2022, 6)]
    assert out[-1].ORDER_MONTH == 3 and out[-1].ORDER_YEAR == 2023
    assert all(r.FORECAST_REVENUES >= 0 for r in out) and {r.TIPO for r in out} == {"PREVISIONE"}


def test_rollout_feeds_unrounded_prediction(spark):
    monthly = _monthly(spark, [100.0 + 3 * i + (i % 5) for i in range(30)])
    _, coef = FC.linear_cv(monthly)
    c = coef.where("FOLD = 0").first()
    last = FC.last_month(monthly).first()
    lag, idx, m = last.LAST_REVENUE, last.LAST_IDX, last.LAST_MONTH
    expect = []
    for k in range(1, 4):
        month = (m + k - 1) % 12 + 1
        p = max(((c.B_MONTH_IDX * (idx + k) + c.B_ORDER_MONTH * month) + c.B_LAG_1 * lag) + c.INTERCEPT, 0.0)
        expect.append(round(p, 2))
        lag = p
    got = [r.FORECAST_REVENUES for r in FC.rollout_linear(monthly, coef, 3).orderBy("DATE").collect()]
    assert got == pytest.approx(expect, abs=0.011)


def test_metrics_and_series(spark):
    a = _monthly(spark, [100 + 2 * i + (i % 3) * 5 for i in range(60)]).withColumn("S", F.lit("a"))
    b = _monthly(spark, [500 - 3 * i + (i % 4) ** 2 for i in range(60)]).withColumn("S", F.lit("b"))
    both = a.unionByName(b)
    pred, coef = FC.linear_cv(both, ["S"])
    m = FC.fold_metrics(pred, ["S"]).collect()
    assert {(r.S, r.FOLD) for r in m} == {(s, f) for s in "ab" for f in range(4)}
    assert all(r.MAE is not None and r.MAE >= 0 and r.R2 <= 1 for r in m)
    assert not any(r.SINGULAR for r in coef.collect())
    out = FC.rollout_linear(both, coef, 2, ["S"]).collect()
    assert len(out) == 4


def test_gbt_importances_sum_to_one(spark):
    monthly = _monthly(spark, [100 + 5 * i + (i % 12) * 3 for i in range(36)])
    preds, models = FC.gbt_cv(monthly)
    imp = FC.gbt_importance(models).collect()
    assert {r.FEATURE for r in imp} == set(FC.FEATURES) and sum(r.IMPORTANCE for r in imp) == pytest.approx(1.0)
    assert preds.count() == 3 * (35 // 4)
    assert FC.rollout_gbt(monthly, models, 2).count() == 2


@pytest.mark.parametrize("n_splits", [1, 3, 12, 50])
def test_prefix_moments_equal_a_fit_of_every_fold(spark, n_splits):
    """Folds as prefixes of blocks give what a copy of the rows for each fold gives."""
    series = {"a": [1e6 + 3000 * i + 70 * (i * i % 13) for i in range(70)], "b": [500 - 3 * i + (i % 4) ** 2 for i in range(20)], "c": [4.0, 9.0]}
    parts = [_monthly(spark, v).withColumn("S", F.lit(k)) for k, v in series.items()]
    monthly = parts[0].unionByName(parts[1]).unionByName(parts[2])
    folded = FC.cv_folds(FC.features(monthly, ["S"]), ["S"], n_splits)
    want = {(r.S, r.FOLD): r for r in FC.linear_fit(folded, ["S"]).collect()}
    pred, coef = FC.linear_cv(monthly, ["S"], n_splits)
    got = {(r.S, r.FOLD): r for r in coef.collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert (r.N_TRAIN, r.RANK, r.SINGULAR) == (want[k].N_TRAIN, want[k].RANK, want[k].SINGULAR)
        for c in ("B_MONTH_IDX", "B_ORDER_MONTH", "B_LAG_1", "INTERCEPT"):
            assert r[c] == pytest.approx(want[k][c], rel=1e-5, abs=1e-6)
    tested = sorted((r.S, r.FOLD, r.SAMPLE) for r in folded.where("ROLE = 'TEST'").collect())
    assert sorted((r.S, r.FOLD, r.SAMPLE) for r in pred.collect()) == tested
    plan = coef._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")           # folds are made from summed blocks, not from rows

import numpy as np
import pandas as pd
import pytest

from tests.helpers import rows
from ledgerflow.operators import profile as P
from ledgerflow.operators.quantiles import exact_quantiles


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.1), (3.0, 5.0, None)], "a double, b double, c double")
    out = {(r.COL_A, r.COL_B): r.CORR for r in P.correlation(df).collect()}
    assert out[("a", "b")] is None and out[("b", "b")] is None
    assert out[("a", "a")] == 1.0 and out[("a", "c")] == 1.0    # pairwise complete
    assert out[("c", "a")] == out[("a", "c")]


def test_histogram_top_value_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 10]], "VAL_REVENUES double")
    h = {r.BIN: r.COUNT for r in P.histogram(df, bins=5).collect()}
    assert len(h) == 5 and h[4] == 1 and h[0] == 2 and sum(h.values()) == 4
    assert h == dict(enumerate(np.histogram([0, 1, 2, 10], bins=5)[0].tolist()))


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_exact_quantiles_brute_force(spark, limit):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 3000), "x": rng.integers(0, 50, 3000) * 1.25})
    tied = pd.DataFrame({"g": "t", "x": np.where(rng.random(1000) < 0.9, 5.0, rng.normal(size=1000))})
    nans = pd.DataFrame({"g": "n", "x": [*range(300), *[float("nan")] * 200, None]})
    pdf = pd.concat([pdf, tied, nans, pd.DataFrame({"g": [None, "one", "none"], "x": [2.0, 3.0, None]})])
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["g"], "x", probs, rank_limit=limit, grid=20).collect()
    for r in got:
        own = pdf[pdf.g.isna() if r.g is None else pdf.g == r.g].x.dropna()
        assert r.QUANTILE == pytest.approx(np.quantile(own, r.PROB), abs=1e-9)
    assert len(got) == 7 * len(probs)


def test_constant_data(spark):
    df = spark.createDataFrame([(4.0,)] * 3, "VAL_REVENUES double")
    assert P.density(df) is None
    h = {r.BIN: (r.LOWER, r.COUNT) for r in P.histogram(df, bins=10).collect()}
    counts, edges = np.histogram([4.0] * 3, bins=10)
    assert [h[i][1] for i in range(10)] == counts.tolist()
    assert [h[i][0] for i in range(10)] == pytest.approx(edges[:-1].tolist())


def test_describe_matches_pandas(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.5]
    df = spark.createDataFrame([(v, 7, "x") for v in vals], "VAL double, ID_X int, S string")
    r = P.describe(df).collect()
    assert [x.COLUMN_NAME for x in r] == ["VAL"]           # ID-like column excluded
    d = pd.Series(vals).describe()
    x = r[0]
    assert (x.COUNT, x.MEAN, x.STD, x.MIN, x.P25, x.P50, x.P75, x.MAX) == tuple(round(v, 2) for v in d.values)


def test_top_values_ties_and_nulls(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "b", "a", None, None, "c"]], "S string")
    with_nulls = rows(P.top_values(df, k=3, include_nulls=True), "RANK", "VALUE", "FREQUENCY", "PCT")
    assert with_nulls == [(1, "a", 2, 28.57), (2, "b", 2, 28.57), (3, None, 2, 28.57)]
    without = rows(P.top_values(df, k=2, include_nulls=False), "RANK", "VALUE", "PCT")
    assert without == [(1, "a", 40.0), (2, "b", 40.0)]


def test_missing_and_distinct(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, None)], "a int, b string")
    assert rows(P.missing(df), "COLUMN_NAME", "MISSING", "PCT") == [("b", 2, 66.67)]
    assert rows(P.distinct_counts(df)) == [("a", 2), ("b", 1)]


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(100, 10, 2000)], "VAL_REVENUES double")
    d = sorted(P.density(df, grid=200).collect(), key=lambda r: r.POINT)
    xs = np.array([r.X for r in d])
    ys = np.array([r.DENSITY_PER_MILLION for r in d]) / 1e6
    assert np.trapezoid(ys, xs) == pytest.approx(1.0, abs=0.03)


def test_box_stats(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals], "ID_BUSINESS_LINE string, VAL_REVENUES double")
    r = P.box_stats(df).first()
    assert (r.Q1, r.MEDIAN, r.Q3, r.WHISKER_HIGH, r.N_OUTLIERS) == (2.0, 3.0, 4.0, 4.0, 1)


def test_describe_approx_option(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 1001)], "VAL double")
    exact = P.describe(df).first()
    approx = P.describe(df, approx=True).first()
    assert exact.P50 == 500.5 and abs(approx.P50 - 500.5) <= 1.0


VALUES = {
    "i": ("bigint", [0, -1, -64, -65, 63, 64, 64, 2 ** 63 - 1, -2 ** 63, None]),
    "s": ("string", ["7", "07", "007", "a7", "a07", "", "a", "7a", "1" * 40, "0" + "1" * 39]),
    "u": ("string", ["é9", "é09", " 9", "9 ", "9", "\u0669", None, "123456789012345678", "1234567890123456789", "9"]),
    "d": ("date", [None, "1969-12-31", "1970-01-01", "1970-01-01", "2788-01-01", "0001-01-01", None, None, None, None]),
    "t": ("timestamp", ["2024-01-01 00:00:00", "2024-01-01 00:00:00.000001", *["2024-01-01 00:00:00"] * 8]),
    "m": ("decimal(18,2)", ["0.00", "0.01", "-0.01", "9999999999999999.99", "-9999999999999999.99", "0.01", *[None] * 4]),
    "w": ("decimal(38,2)", ["0.00", "0.01", "123456789012345678901234567890.12", *[None] * 7]),
    "f": ("double", ["0.0", "-0.0", "NaN", "NaN", "1.5", *[None] * 5]),
    "b": ("boolean", [True, False, None, *[True] * 7]),
    "n": ("int", [None] * 10),
    "a.b": ("int", [*range(10)]),
}


def odd_values(spark):
    text = ", ".join(f"`{c}` string" for c in VALUES)
    raw = [tuple(None if v[k] is None else str(v[k]) for _, v in VALUES.values()) for k in range(10)]
    df = spark.createDataFrame(raw, text)
    return df.selectExpr(*[f"cast(`{c}` as {t}) as `{c}`" for c, (t, _) in VALUES.items()])


def test_distinct_counts_of_odd_values(spark):
    df = odd_values(spark)
    got = dict(rows(P.distinct_counts(df)))
    want = {c: df.selectExpr(f"count(distinct `{c}`) as n").first().n for c in VALUES}
    assert got == want and want["s"] == 10 and want["n"] == 0 and want["f"] == 3
    assert dict(rows(P.distinct_counts(df.limit(0)))) == dict.fromkeys(VALUES, 0)
    approx = dict(rows(P.distinct_counts(df, ["i", "a.b"], approx=True)))
    assert approx == {"i": want["i"], "a.b": 10}


def exact_density(v, grid=200):
    v = np.asarray(v, dtype="float64")
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), grid)
    return np.array([np.exp(-0.5 * ((p - v) / h) ** 2).sum() for p in x]) / (len(v) * h * np.sqrt(2 * np.pi))


@pytest.mark.parametrize("kind", ["normal", "lognormal", "two values", "ties and outlier", "uniform"])
def test_density_equals_the_whole_sum(spark, kind):
    rng = np.random.default_rng(5)
    v = {"normal": lambda: rng.normal(100, 10, 3000), "lognormal": lambda: rng.lognormal(3, 1.2, 3000),
         "two values": lambda: np.array([1.0, 2.0]), "ties and outlier": lambda: np.array([*[5.0] * 500, *range(20), 1e6]),
         "uniform": lambda: rng.random(3000) * 1e-6}[kind]()
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "VAL_REVENUES double")
    got = sorted(P.density(df, digits=300, count_digits=300).collect(), key=lambda r: r.POINT)
    want = exact_density(v)
    assert np.abs(np.array([r.DENSITY_PER_MILLION for r in got]) / 1e6 - want).max() <= 1e-13 * want.max()


def test_kernel_moments_of_parts_add_up(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(0, 1, 400)], "x double")
    from pyspark.sql import functions as F
    both = P.kernel_moments(df.where("x < 0.3"), -5.0, 0.3).unionByName(P.kernel_moments(df.where("x >= 0.3"), -5.0, 0.3))
    both = {r.CELL: r for r in both.groupBy("CELL").agg(*[F.sum(f"M{k}").alias(f"M{k}") for k in range(P.TERMS)]).collect()}
    whole = {r.CELL: r for r in P.kernel_moments(df, -5.0, 0.3).collect()}
    assert both.keys() == whole.keys()
    for c, r in whole.items():
        assert [both[c][f"M{k}"] for k in range(P.TERMS)] == pytest.approx([r[f"M{k}"] for k in range(P.TERMS)], abs=1e-12)


def test_density_plans_no_python(spark):
    df = spark.range(100).selectExpr("cast(id as double) as VAL_REVENUES")
    plan = P.density(df)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "Python" not in plan


def wide_table(spark, n_cols, n_rows=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(1000, 3, (n_rows, n_cols))
    x[:, 1] = x[:, 0] * -2 + rng.normal(0, 0.5, n_rows)
    x[:, 2] = 0.1 if n_cols > 9 else 0.5                 # constant (0.1: up to rounding)
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(n_cols)])
    pdf = pdf.mask(rng.random(pdf.shape) < 0.1)
    pdf["c3"] = np.where(pdf.c0.isna(), pdf.c3, 7.25)    # constant wherever c0 is present
    pdf["c4"] = np.nan                                   # nothing at all
    data = [tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(data, ", ".join(f"{c} double" for c in pdf.columns))


@pytest.mark.parametrize("block", [512, 4])
def test_correlation_blocks_equal_the_expressions(spark, block):
    _, df = wide_table(spark, 9)
    assert rows(P.correlation_blocks(df, df.columns, 9, block=block)) == rows(P.correlation(df, df.columns, 9))


def test_correlation_of_300_columns(spark):
    pdf, df = wide_table(spark, 300)
    got = {(r.COL_A, r.COL_B): r.CORR for r in P.correlation(df, df.columns, 6).collect()}
    want = pdf.corr(min_periods=2)
    assert len(got) == 90_000
    for c in ("c2", "c4"):
        assert all(got[(c, o)] is None for o in pdf.columns)
    assert got[("c0", "c3")] is None and got[("c1", "c0")] == pytest.approx(want.loc["c1", "c0"], abs=1e-6)
    skip = {"c2", "c3", "c4"}
    assert all(got[(a, b)] == pytest.approx(want.loc[a, b], abs=1.1e-6) for a in pdf.columns for b in pdf.columns
               if not {a, b} & skip)


def test_correlation_blocks_odd_tables(spark):
    _, df = wide_table(spark, 5)
    empty = P.correlation_blocks(df.limit(0), df.columns).collect()
    assert len(empty) == 25 and all(r.CORR is None for r in empty)
    bad = spark.createDataFrame([(1.0, 2.0, 3), (2.0, float("nan"), 4), (4.0, 1.0, 9), (None, 1.0, None)], "`a.b` double, n double, i int")
    got = {(r.COL_A, r.COL_B): r.CORR for r in P.correlation_blocks(bad, bad.columns).collect()}
    assert got[("a.b", "n")] is None and got[("n", "n")] is None and got[("a.b", "i")] == got[("i", "a.b")] == 0.984


def test_quantiles_store_targets_not_values(spark, monkeypatch):
    """What is stored between the rounds grows with groups and probabilities, not with the different values."""
    from ledgerflow.operators import quantiles as Q
    stored, freeze = [], Q._freeze

    def counted(df):
        out = freeze(df)
        stored.append(out.count())
        return out
    monkeypatch.setattr(Q, "_freeze", counted)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=2000), 10.0 ** rng.uniform(-250, 250, 1000), -(10.0 ** rng.uniform(-5, 300, 500)), [-np.inf, np.inf] * 3])
    df = spark.createDataFrame([("a", float(v)) for v in x], "g string, x double").repartition(4)
    probs = [0.0, 0.2, 0.3331, 0.5, 0.9, 1.0]
    got = {r.PROB: r.QUANTILE for r in exact_quantiles(df, ["g"], "x", probs, rank_limit=20, grid=50).collect()}
    for p in probs[1:-1]:
        assert got[p] == pytest.approx(np.quantile(x, p))
    assert got[0.0] == -np.inf and got[1.0] == np.inf
    assert max(stored) <= 2 * len(probs)


def test_distinct_counts_and_top_values_shuffle_single_columns(spark):
    rows = [(f"k{i}", "x" if i % 3 else None, float(i % 4), float("nan") if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "a string, b string, c double, d double")
    out = P.distinct_counts(df)
    assert {r.COLUMN_NAME: r.N_DISTINCT for r in out.collect()} == {"a": 40, "b": 1, "c": 4, "d": 1}
    top = P.top_values(df, k=2)
    assert {(r.COLUMN_NAME, r.RANK, r.VALUE, r.FREQUENCY) for r in top.collect()} == {
        ("a", 1, "k0", 1), ("a", 2, "k1", 1), ("b", 1, "x", 26), ("b", 2, None, 14)}
    for df in (out, top):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "struct(COLUMN_NAME, a, VALUE" not in plan

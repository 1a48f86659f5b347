"""Monthly state: equal to a full rebuild, and only the changed months are read."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import SF_SMALL, rows
from ledgerflow.operators import aggregate as G
from ledgerflow.operators import sketches as S
from ledgerflow.plans import incremental as I
from ledgerflow.registry import olap
from ledgerflow.sources.sinks import write_olap


@pytest.fixture(scope="module")
def table(spark):
    t = olap(spark, SF_SMALL, dirty=True)
    extra = t.limit(1).withColumns({"ORDER_YEAR": F.lit(None).cast("int"), "ORDER_MONTH": F.lit(None).cast("int")})
    return t.unionByName(extra)          # a month without a date


def test_append_recomputes_only_its_months(spark, table, tmp_path, monkeypatch):
    path, state = str(tmp_path / "olap"), str(tmp_path / "state")
    first, later = table.where("ORDER_YEAR < 1996 or ORDER_YEAR is null"), table.where("ORDER_YEAR >= 1996")
    write_olap(first, path)
    seen = []

    def build(r):
        seen.append(sorted(x.PART for x in r.select("PART").distinct().collect()))
        plan = r._jdf.queryExecution().executedPlan().toString()
        assert "concat(" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        return G.sales_totals(r, ["PART", *G.CUSTOMER_KEYS], as_double=False)

    monkeypatch.setattr(I, "total_parts", lambda keys: build)
    assert rows(I.customer_sales(spark, path, state)) == rows(G.customer_sales(first))
    again = I.customer_sales(spark, path, state)
    assert len(seen) == 1 and rows(again) == rows(G.customer_sales(first))
    write_olap(later, path, mode="append")
    assert rows(I.customer_sales(spark, path, state)) == rows(G.customer_sales(table))
    months = {f"y{r.ORDER_YEAR}m{r.ORDER_MONTH}" for r in later.select(*I.MONTH).distinct().collect()}
    assert len(seen) == 2 and months and set(seen[1]) == months and not months & set(seen[0])
    one = table.where("ORDER_YEAR = 1995 and ORDER_MONTH = 2")
    write_olap(one, path, mode="append")                    # more files in a known month
    assert rows(I.customer_sales(spark, path, state)) == rows(G.customer_sales(table.unionByName(one)))
    assert seen[2] == ["y1995m2"] and one.count() > 0


def test_cubes_equal_full_rebuild(spark, table, tmp_path):
    path, state = str(tmp_path / "olap"), str(tmp_path / "state")
    write_olap(table, path)
    assert rows(I.monthly_sales(spark, path, state)) == rows(G.monthly_sales(table))
    assert rows(I.item_sales(spark, path, state)) == rows(G.item_sales(table))
    history = G.monthly_history(I.monthly_sales(spark, path, state, as_double=False))
    assert rows(history) == rows(G.monthly_history(G.monthly_sales(table, as_double=False)))


def test_removed_month_is_gone(spark, table, tmp_path):
    state = str(tmp_path / "state")
    write_olap(table, str(tmp_path / "a"))
    I.item_sales(spark, str(tmp_path / "a"), state)
    left = table.where("not (ORDER_YEAR = 1995)")
    assert 0 < left.count() < table.count()
    write_olap(left, str(tmp_path / "b"))
    assert rows(I.item_sales(spark, str(tmp_path / "b"), state)) == rows(G.item_sales(left))


def test_tables_without_rows(spark, table, tmp_path):
    with pytest.raises(ValueError, match="no month"):
        I.refresh(spark, str(tmp_path / "nothing"), str(tmp_path / "s"), I.total_parts(G.ITEM_KEYS))
    write_olap(table.limit(3).withColumn("IDS_ITEM", F.lit(None).cast("string")), str(tmp_path / "olap"))
    assert rows(I.item_sales(spark, str(tmp_path / "olap"), str(tmp_path / "s"))) == []


def test_profile_of_months_against_pandas(spark, table, tmp_path):
    path, state = str(tmp_path / "olap"), str(tmp_path / "state")
    write_olap(table, path)
    got = {r.COLUMN_NAME: r for r in I.profile(spark, path, state).collect()}
    pdf = table.toPandas()
    assert set(got) == set(pdf.columns)
    for c in pdf.columns:
        assert (got[c].ROWS, got[c].MISSING) == (len(pdf), pdf[c].isna().sum())
        assert got[c].N_DISTINCT == pdf[c].nunique()        # exact below 16,384 values
    for c in ("VAL_REVENUES", "VAL_COST", "VAL_MARGIN"):
        v = pdf[c].dropna().astype(float)
        r = got[c]
        assert (r.MIN, r.MAX) == (v.min(), v.max())
        assert (r.MEAN, r.STD) == (pytest.approx(v.mean(), rel=1e-12), pytest.approx(v.std(), rel=1e-9))
        for p, x in ((0.25, r.P25), (0.5, r.P50), (0.75, r.P75)):
            assert (v < x).mean() - S.rank_error() <= p <= (v <= x).mean() + S.rank_error()


def test_sketch_bounds_on_many_values(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") % 37).alias("part"), (F.xxhash64("id") % 1_000_000_007).cast("double").alias("x"),
                               F.concat(F.lit("k"), F.col("id")).alias("k"))
    got = {r.COLUMN_NAME: r for r in S.merge_profile(S.profile_parts(df, ["part"])).collect()}
    v = np.sort(np.array([r.x for r in df.select("x").collect()]))
    for p, x in ((0.25, got["x"].P25), (0.5, got["x"].P50), (0.75, got["x"].P75)):
        assert abs(np.searchsorted(v, x) / n - p) <= S.rank_error()
    assert abs(got["k"].N_DISTINCT / n - 1) <= 4 * 2 ** (-S.LG_NOMINAL / 2)


def test_odd_columns(spark):
    df = spark.createDataFrame([(1, float("nan"), None, "a", 0.0), (1, None, None, "b", -0.0), (2, 2.0, None, None, 0.0)],
                               "part int, `a.b` double, none int, s string, z double")
    got = {r.COLUMN_NAME: r for r in S.merge_profile(S.profile_parts(df, ["part"])).collect()}
    assert (got["a.b"].COUNT, got["a.b"].MEAN, got["a.b"].STD, got["a.b"].P50, got["a.b"].N_DISTINCT) == (1, 2.0, None, 2.0, 1)
    assert (got["none"].COUNT, got["none"].MISSING, got["none"].MEAN, got["none"].P50, got["none"].N_DISTINCT) == (0, 3, None, None, 0)
    assert (got["s"].COUNT, got["s"].MEAN, got["s"].N_DISTINCT) == (2, None, 2) and got["z"].N_DISTINCT == 1
    assert S.merge_profile(S.profile_parts(df.limit(0), ["part"])).collect() == []
    a, b = S.profile_parts(df.where("part = 1"), ["part"]), S.profile_parts(df.where("part = 2"), ["part"])
    assert sorted(map(repr, S.merge_profile(a.unionByName(b)).drop("P25", "P50", "P75").collect())) == \
        sorted(map(repr, S.merge_profile(S.profile_parts(df, ["part"])).drop("P25", "P50", "P75").collect()))

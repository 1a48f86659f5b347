"""Invariants from the test strategy, on the perturbed star at sf0.001."""

from pyspark.sql import functions as F

from tests.helpers import SF_SMALL
from ledgerflow import schema as S
from ledgerflow.operators import aggregate as G
from ledgerflow.operators import clean
from ledgerflow.registry import etl, olap


def test_semi_plus_anti_is_non_null_child(spark):
    st = etl(spark, SF_SMALL, dirty=True).stages
    for rel, child, parent in st["fk_seen"]:
        pk = S.PRIMARY_KEYS[rel.parent][0]
        keys = clean.parent_keys(parent, pk, rel.fk)
        non_null = child.where(F.col(rel.fk).isNotNull())
        semi = non_null.join(keys, on=rel.fk, how="left_semi").count()
        anti = non_null.join(keys, on=rel.fk, how="left_anti").count()
        assert semi + anti == non_null.count()
        assert clean.repair_fk(child, rel.fk, parent, pk).count() == semi


def test_monthly_total_equals_olap_minus_null_keys(spark):
    o = olap(spark, SF_SMALL, dirty=True)
    m = G.monthly_sales(o, as_double=False)
    keys = list(G.MONTH_KEYS)
    expect = o.dropna(subset=keys).agg(F.sum("VAL_REVENUES")).first()[0]
    assert m.agg(F.sum("TOTAL_REVENUES")).first()[0] == expect
    assert o.where(F.col("ID_COUNTRY").isNull()).count() > 0          # the perturbation did drop rows


def test_fused_join_keeps_fact_rows_that_pass_checks(spark):
    res = etl(spark, SF_SMALL, dirty=True)
    assert res.olap.count() == res.stages["final"][S.SALES].count()

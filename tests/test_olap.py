import datetime as dt

from pyspark.sql import functions as F

from tests.helpers import rows
from ledgerflow import schema as S
from ledgerflow.operators import clean, olap
from ledgerflow.plans.etl import build_audit, run_etl


def _tables(spark):
    sales = spark.createDataFrame([
        ("C1", "1", "U1", "I1", "20240105", "20240110", 10.0, 4.0),
        ("C1", "1", "U1", "I1", "20240105", "20240110", 10.0, 4.0),    # full duplicate
        (None, "2", "U1", "I1", "20240105", "20240110", 5.0, 1.0),     # null FK
        ("C1", "3", "U9", "I1", "20240105", "20240110", 5.0, 1.0),     # orphan customer
        ("C2", "4", "U2", "I2", "20241230", "20250102", 7.0, 2.0),     # customer fails its own FK check
        ("C2", "5", "U3", "I2", "20240301", "20251345", 7.0, 2.0),     # invalid invoice date
        ("C2", "6", "U3", "I2", "20240301", "20240302", None, 2.0),    # null critical value
        ("C2", "7", "U3", "I3", "20240301", "20240302", 3.0, 1.0),     # item whose line is missing
    ], S.TABLE_SCHEMAS[S.SALES])
    customer = spark.createDataFrame([("U1", "cust 1", "IT", "A1"), ("U2", "cust 2", None, "A9"),
                                      ("U3", "cust 3", "FR", None)], S.TABLE_SCHEMAS[S.CUSTOMER])
    item = spark.createDataFrame([("I1", "item 1", "B1"), ("I2", "item 2", "B1"), ("I2", "item 2 B", "B1"),
                                  ("I3", "item 3", "B7")], S.TABLE_SCHEMAS[S.ITEM])
    return {S.SALES: sales, S.CUSTOMER: customer, S.ITEM: item,
            S.COMPANY: spark.createDataFrame([("C1", "co 1"), ("C2", "co 2")], S.TABLE_SCHEMAS[S.COMPANY]),
            S.AREA_MANAGER: spark.createDataFrame([("A1", "am 1")], S.TABLE_SCHEMAS[S.AREA_MANAGER]),
            S.BUSINESS_LINE: spark.createDataFrame([("B1", "bl 1")], S.TABLE_SCHEMAS[S.BUSINESS_LINE])}


def test_fused_equals_sequential(spark):
    t = _tables(spark)
    fused = run_etl(t, fused=True).olap
    seq = run_etl(t, fused=False).olap
    assert fused.columns == seq.columns
    assert rows(fused) == rows(seq)
    got = {r.ID_ORDER_NUM: r for r in fused.collect()}
    assert sorted(got) == ["1", "4", "7"]
    assert got["4"].DESC_CUSTOMER is None and got["4"].ID_AREA_MANAGER is None   # T8: no cascade
    assert got["7"].DESC_ITEM is None and got["7"].DESC_BUSINESS_LINE is None
    assert got["1"].DESC_AREA_MANAGER == "am 1" and got["1"].DESC_ITEM == "item 1"
    assert got["1"].VAL_MARGIN == 6.0
    assert (got["4"].ORDER_YEAR, got["4"].ORDER_MONTH, got["4"].ORDER_WEEK) == (2024, 12, 1)   # ISO week


def test_olap_column_order(spark):
    cols = run_etl(_tables(spark)).olap.columns
    assert cols == ["ID_COMPANY", "ID_ORDER_NUM", "IDS_CUSTOMER", "IDS_ITEM", "ID_ORDER_DATE", "ID_INVOICE_DATE",
                    "VAL_REVENUES", "VAL_COST", "VAL_MARGIN", "DESC_COMPANY", "DESC_CUSTOMER", "ID_COUNTRY",
                    "ID_AREA_MANAGER", "DESC_AREA_MANAGER", "DESC_ITEM", "ID_BUSINESS_LINE", "DESC_BUSINESS_LINE",
                    "ORDER_YEAR", "ORDER_MONTH", "ORDER_WEEK"]


def test_missing_table_returns_none(spark):
    t = _tables(spark)
    del t[S.COMPANY]
    assert run_etl(t) is None


def test_margin_and_calendar(spark):
    df = spark.createDataFrame([(5.0, 3.0, "20241230")], "VAL_REVENUES double, VAL_COST double, ID_ORDER_DATE string")
    out = olap.add_order_calendar(olap.add_margin(df)).first()
    assert (out.VAL_MARGIN, out.ORDER_YEAR, out.ORDER_WEEK, out.ID_ORDER_DATE) == (2.0, 2024, 1, dt.date(2024, 12, 30))
    assert olap.add_margin(df.drop("VAL_COST")).columns == ["VAL_REVENUES", "ID_ORDER_DATE"]


def test_snowflake_join_suffixes_clashing_columns(spark):
    fact = spark.createDataFrame([("k1", "fact note")], "ID_COMPANY string, NOTE string")
    company = spark.createDataFrame([("k1", "parent note")], "ID_COMPANY string, NOTE string")
    out = olap.snowflake_join(fact, S.SALES, {S.COMPANY: company}, {S.SALES: (("ID_COMPANY", S.COMPANY),)})
    assert out.columns == ["ID_COMPANY", "NOTE", "NOTE_COMPANY_LOOKUP"]
    assert out.first().NOTE_COMPANY_LOOKUP == "parent note"


def test_fanout_report(spark):
    t = _tables(spark)
    rep = {(r.CHILD, r.FK): r for r in olap.fanout_report(t).collect()}
    r = rep[(S.SALES, "IDS_ITEM")]
    assert (r.ROWS_BEFORE, r.ROWS_AFTER) == (8, 11)   # three sales rows of I2 meet two I2 rows
    assert rep[(S.SALES, "ID_COMPANY")].ROWS_AFTER == 8


def test_audit_levels(spark):
    res = run_etl(_tables(spark))
    audit = {(r.PHASE, r.TABLE_NAME, r.COLUMN_NAME, r.CHECK): (r.LEVEL, r.N) for r in res.audit().collect()}
    assert audit[("LOAD", S.COMPANY, None, "PRESENT")] == ("OK", 1)
    assert audit[("DEDUP", S.SALES, None, "REMOVED")] == ("INFO", 1)
    assert audit[("PK", S.ITEM, "IDS_ITEM", "DUPLICATE_ROWS")] == ("ERROR", 1)
    assert audit[("FK", S.SALES, "ID_COMPANY", "NULL_FK")] == ("ERROR", 1)
    assert audit[("FK", S.SALES, "IDS_CUSTOMER", "ORPHAN_VALUES")] == ("ERROR", 1)
    assert audit[("FK", S.CUSTOMER, "ID_AREA_MANAGER", "NULL_FK")] == ("ERROR", 1)
    # the only null country belongs to a customer removed by its own FK check,
    # and technical keys are checked after the FK phase
    assert audit[("TECHNICAL", S.CUSTOMER, "ID_COUNTRY", "NULLS")] == ("OK", 0)
    assert audit[("DATES", S.SALES, "ID_INVOICE_DATE", "N_YEAR_GT_2262")] == ("OK", 0)
    assert audit[("NULLS_PRE", S.SALES, "ID_INVOICE_DATE", "NULLS_DROP")] == ("ERROR", 1)


def test_other_relation_order_falls_back_to_sequential(spark):
    from ledgerflow.plans.etl import EtlConfig, _fused_allowed
    t = _tables(spark)
    # lookups checked first: the fact then meets customers already filtered, so checks cascade
    order = {S.CUSTOMER: S.RELATIONS[S.CUSTOMER], S.ITEM: S.RELATIONS[S.ITEM], S.SALES: S.RELATIONS[S.SALES]}
    cfg = EtlConfig(relations=order)
    assert not _fused_allowed(cfg) and _fused_allowed(EtlConfig())
    got = sorted(r.ID_ORDER_NUM for r in run_etl(t, cfg).olap.collect())
    assert got == ["1"]          # order 4's customer and order 7's item fail their own checks first


def _of_many_rows(spark, tmp_path, n=450_000):
    """The tables with ``n`` more items; all of them stored, the items in a file far below the broadcast threshold."""
    t = _tables(spark)
    more = spark.range(n).select(F.concat(F.lit("X"), "id").alias("IDS_ITEM"), F.lit("item").alias("DESC_ITEM"), F.lit("B1").alias("ID_BUSINESS_LINE"))
    for name, df in {**t, S.ITEM: t[S.ITEM].unionByName(more)}.items():
        df.write.parquet(str(tmp_path / name))
        t[name] = spark.read.parquet(str(tmp_path / name))
    return t


def _joins(df, key: str) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Join [")[0].split()[-1] for line in plan.splitlines() if f"Join [{key}#" in line]


def test_lookups_of_many_rows_are_not_broadcast(spark, tmp_path):
    t = _of_many_rows(spark, tmp_path)
    res, want = run_etl(t), run_etl(_tables(spark))
    assert _joins(res.olap, "IDS_ITEM") == _joins(res.stages["fk"][S.SALES], "IDS_ITEM") == ["SortMerge"]
    assert _joins(run_etl(t, fused=False).olap, "IDS_ITEM") == ["SortMerge"] * 2
    assert _joins(res.olap, "IDS_CUSTOMER") == ["BroadcastHash"]                # a small one still is
    assert rows(res.olap) == rows(want.olap)
    assert rows(res.stages["fk"][S.SALES]) == rows(want.stages["fk"][S.SALES])
    audit = build_audit(res, phases=("FK",))
    assert "BroadcastHashJoin [key" not in audit._jdf.queryExecution().executedPlan().toString()
    assert rows(audit.where("TABLE_NAME = 'SALES'")) == rows(build_audit(want, phases=("FK",)).where("TABLE_NAME = 'SALES'"))


def test_orphans_and_fanout_of_many_rows(spark, tmp_path):
    t = _of_many_rows(spark, tmp_path)
    small, large = run_etl(_tables(spark)).stages, run_etl(t).stages
    assert large["large"] == {S.ITEM} and small["large"] == set()
    orphans = [clean.fk_orphans(st["pk"][S.SALES], "IDS_ITEM", st["pk"][S.ITEM], large=S.ITEM in st["large"]) for st in (large, small)]
    assert _joins(orphans[0], "IDS_ITEM") == ["SortMerge"]
    assert rows(orphans[0]) == rows(orphans[1])
    reports = [olap.fanout_report(st["deduped"], large=st["large"]).where("CHILD = 'SALES'") for st in (large, small)]
    assert _joins(reports[0], "IDS_ITEM") == ["SortMerge"]
    assert rows(reports[0]) == rows(reports[1])

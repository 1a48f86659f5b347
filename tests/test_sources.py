import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import SF_SMALL, rows
from ledgerflow import schema as S
from ledgerflow.plans.etl import run_etl
from ledgerflow.plans.report import statistics_report
from ledgerflow.sources import csv_tables as CSV
from ledgerflow.sources import sinks
from ledgerflow.sources.star import star_tables


def _write_csv(tables, folder):
    for name, df in tables.items():
        out = os.path.join(folder, f"_{name}")
        df.coalesce(1).write.option("header", True).mode("overwrite").csv(out)
        part = [f for f in os.listdir(out) if f.startswith("part-")][0]
        os.rename(os.path.join(out, part), os.path.join(folder, f"{name}.csv"))


def test_csv_round_trip_matches_parquet_star(spark, tmp_path):
    tables = star_tables(spark, SF_SMALL)
    _write_csv(tables, str(tmp_path))
    loaded = CSV.load_csv_tables(spark, str(tmp_path))
    assert set(loaded) == set(S.EXPECTED_TABLES)
    assert dict(loaded[S.SALES].dtypes)["VAL_REVENUES"] == "decimal(24,6)"
    assert dict(loaded[S.CUSTOMER].dtypes)["IDS_CUSTOMER"] == "string"
    a = run_etl(loaded).olap
    b = run_etl(tables).olap
    assert a.count() == b.count()
    assert rows(a.select("ID_ORDER_NUM", "IDS_ITEM", "DESC_BUSINESS_LINE")) == \
        rows(b.select("ID_ORDER_NUM", "IDS_ITEM", "DESC_BUSINESS_LINE"))


def test_missing_or_empty_table_fails_load(spark, tmp_path):
    tables = star_tables(spark, SF_SMALL)
    _write_csv({k: v for k, v in tables.items() if k != S.COMPANY}, str(tmp_path))
    problems = {}
    assert CSV.load_csv_tables(spark, str(tmp_path), problems=problems) is None
    assert problems == {S.COMPANY: "no file of this name"}
    (tmp_path / f"{S.COMPANY}.csv").write_text("ID_COMPANY,DESC_COMPANY\n")
    assert CSV.load_csv_tables(spark, str(tmp_path)) is None
    assert CSV.missing_tables(["SALES"]) == set(S.EXPECTED_TABLES) - {"SALES"}


def test_table_name_from_file_and_choice():
    assert CSV.table_name_from_file("/x/Sales.CSV") == "SALES"
    assert CSV.table_name_from_file("item_lookup.csv") == "ITEM_LOOKUP"
    assert CSV.choose_tables({"A": 1}, load=True, loader=lambda: None) == {"A": 1}
    assert CSV.choose_tables(None, load=False) is None
    assert CSV.choose_tables(None, load=True, loader=lambda: {"B": 2}) == {"B": 2}


def test_olap_sink_partitioned_round_trip(spark, tmp_path):
    olap = run_etl(star_tables(spark, SF_SMALL)).olap
    path = str(tmp_path / "olap")
    sinks.write_olap(olap, path)
    back = sinks.read_olap(spark, path, year_from=1996, year_to=1996)
    assert back.count() == olap.where("ORDER_YEAR = 1996").count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ORDER_YEAR" in plan
    files = [f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-")]
    months = olap.select("ORDER_YEAR", "ORDER_MONTH").distinct().count()
    assert months <= len(files) <= 2 * months                    # not one file per task and month
    sinks.write_olap(olap, str(tmp_path / "csv"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == olap.count()


def test_statistics_report(spark, tmp_path):
    olap = run_etl(star_tables(spark, SF_SMALL, dirty=True)).olap
    long = "CUSTOMER_LOOKUP_SNAPSHOT_2025_12_31"
    parts = statistics_report({"SALES/OLAP": olap, long: olap})
    kinds = ("info", "missing", "numeriche", "categoriche")
    assert set(parts) == {("riepilogo",), *(("SALES/OLAP", k) for k in kinds), *((long, k) for k in kinds)}
    written = sinks.write_report(parts, str(tmp_path))
    assert len(set(written)) == 9
    assert spark.read.parquet(f"{tmp_path}/{long}/info").count() == 2 == spark.read.parquet(f"{tmp_path}/SALES%2FOLAP/info").count()


DIALECT = """ID_COMPANY,ID_ORDER_NUM,IDS_CUSTOMER,IDS_ITEM,ID_ORDER_DATE,ID_INVOICE_DATE,VAL_REVENUES,VAL_COST
40,1,"pipe 3"" wide, blue",i,20250101,20250102,10.5,1
NA,2,c,NULL,20250101,,NaN,2.25
 7 ,3,c,i,20250101,20250102,abc,3
"""


def test_csv_dialect_null_tokens_and_malformed_numbers(spark, tmp_path):
    (tmp_path / "SALES.csv").write_text(DIALECT)
    got = CSV.read_csv_table(spark, str(tmp_path / "SALES.csv"), with_order=False).orderBy("ID_ORDER_NUM").collect()
    assert got[0].IDS_CUSTOMER == 'pipe 3" wide, blue' and str(got[0].VAL_REVENUES) == "10.500000"
    assert got[1].ID_COMPANY is None and got[1].IDS_ITEM is None and got[1].VAL_REVENUES is None and got[1].ID_INVOICE_DATE is None
    assert got[2].ID_COMPANY == " 7 " and got[2].VAL_REVENUES is None
    bad = {r.COLUMN_NAME: r.MALFORMED for r in CSV.malformed_values(spark, str(tmp_path / "SALES.csv")).collect()}
    assert bad == {"VAL_REVENUES": 1, "VAL_COST": 0}


def test_csv_lines_in_quotes_and_other_column_order(spark, tmp_path):
    (tmp_path / "AREA_MANAGER_LOOKUP.csv").write_text('ID_AREA_MANAGER,DESC_AREA_MANAGER\n1,"two\nlines"\n2,x\n')
    got = CSV.read_csv_table(spark, str(tmp_path / "AREA_MANAGER_LOOKUP.csv"), with_order=False, multi_line=True)
    assert sorted(map(tuple, got.collect())) == [("1", "two\nlines"), ("2", "x")]
    folder = tmp_path / "COMPANY_LOOKUP.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("ID_COMPANY,DESC_COMPANY\n1,one\n")
    (folder / "b.csv").write_text("DESC_COMPANY,ID_COMPANY\ntwo,2\n")
    with pytest.raises(Exception, match="header|Header"):
        CSV.read_csv_table(spark, str(folder), with_order=False).collect()


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", now', " padded ", None), ("line", "x", "y")], "ID_COMPANY string, DESC_COMPANY string, C string")
    sinks.write_olap(df, str(tmp_path / "COMPANY_LOOKUP.csv"), fmt="csv")
    assert rows(CSV.read_csv_table(spark, str(tmp_path / "COMPANY_LOOKUP.csv"), with_order=False)) == rows(df)


def test_stored_tables_follow_nested_changes(spark, tmp_path):
    from ledgerflow.plans.materialize import _fs_exists, fingerprint, list_names, materialized
    inner = tmp_path / "in" / "lineitem.parquet"
    spark.range(3).write.parquet(str(inner))
    one = fingerprint("v", inputs=str(tmp_path / "in"), spark=spark)
    assert one == fingerprint("v", inputs=f"file:{tmp_path}/in", spark=spark)
    spark.range(4).write.mode("overwrite").parquet(str(inner))
    assert one != fingerprint("v", inputs=str(tmp_path / "in"), spark=spark)
    assert list_names(spark, f"file://{tmp_path}/in") == ["lineitem.parquet"] and not _fs_exists(spark, f"{tmp_path}/none")
    name = f"t{tmp_path.name}"
    assert materialized(spark, name, lambda: spark.range(5), "k").count() == 5
    assert materialized(spark, name, lambda: spark.range(9), "k").count() == 5


def test_command_line_run(spark, tmp_path):
    from ledgerflow.__main__ import main
    _write_csv(star_tables(spark, SF_SMALL), str(tmp_path / "in"))
    out = tmp_path / "out"
    # the test session is reused (getOrCreate); stop() at the end is skipped by patching
    import pyspark.sql
    stop = pyspark.sql.SparkSession.stop
    pyspark.sql.SparkSession.stop = lambda self: None
    try:
        assert main(["--csv-dir", str(tmp_path / "in"), "--out", str(out), "--no-gbt"]) == 0
    finally:
        pyspark.sql.SparkSession.stop = stop
    for part in ("olap", "audit", "report/riepilogo", "charts/rfm", "forecast", "models/linear_metrics", "models/horizons",
                 "models/separation_date", "aggregates/mensile", "aggregates/clienti", "aggregates/articoli"):
        assert (out / part).exists(), part
    items = [r.IDS_ITEM for r in spark.read.parquet(str(out / "aggregates/articoli")).collect()]
    assert items == sorted(items)
    assert spark.read.parquet(str(out / "olap")).count() == run_etl(star_tables(spark, SF_SMALL)).olap.count()


def test_stored_star_has_repeated_rows_from_one_join(spark, tmp_path):
    """The perturbed fact's repeated rows come from the join that makes the others; stored tables are zstd Parquet."""
    from ledgerflow import schema as S
    from ledgerflow.plans.materialize import materialized
    from ledgerflow.sources.star import star_tables
    tables = {
        "lineitem": "SELECT id DIV 2 AS l_orderkey, id AS l_partkey, 1L AS l_suppkey, CAST(id % 2 AS int) AS l_linenumber, 10.0D AS l_extendedprice, "
                    "0.1D AS l_discount, 0.2D AS l_tax, TIMESTAMP '2020-01-02 00:00:00' AS l_shipdate FROM range(404)",
        "orders": "SELECT id AS o_orderkey, id AS o_custkey, TIMESTAMP '2020-01-01 00:00:00' AS o_orderdate FROM range(202)",
        "customer": "SELECT id AS c_custkey, 'n' AS c_name, 'm' AS c_mktsegment, 1 AS c_nationkey FROM range(3)",
        "part": "SELECT id AS p_partkey, 'p' AS p_name, 't' AS p_type FROM range(3)",
        "supplier": "SELECT id AS s_suppkey, 's' AS s_name FROM range(3)",
        "nation": "SELECT CAST(id AS int) AS n_nationkey, 'x' AS n_name FROM range(3)"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    sales = star_tables(spark, str(tmp_path), dirty=True)[S.SALES]
    counts = {r.ID_ORDER_NUM: r.n for r in sales.groupBy("ID_ORDER_NUM").count().withColumnRenamed("count", "n").collect()}
    assert {k: n for k, n in counts.items() if n != 2} == {"0": 4, "100": 4, "200": 4} and len(counts) == 202
    plan = sales._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1
    kept = materialized(spark, "zstd-test", lambda: sales, f"{abs(hash(str(tmp_path)))}")
    assert all(".zstd." in f for f in kept.inputFiles()) and kept.count() == sales.count()


def test_orders_of_many_rows_are_not_broadcast(spark, tmp_path):
    """The planner goes by the size of the compressed file, 450,000 equal rows but for their key."""
    for name in ("customer", "part", "supplier", "nation", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    spare = orders.limit(1).crossJoin(spark.range(450_000)).withColumn("o_orderkey", F.col("id") + 10 ** 9).drop("id")
    orders.unionByName(spare).write.parquet(str(tmp_path / "orders.parquet"))
    got = star_tables(spark, str(tmp_path))[S.SALES]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [l_orderkey" in plan and "BroadcastHashJoin [l_orderkey" not in plan
    assert rows(got) == rows(star_tables(spark, SF_SMALL)[S.SALES])

from tests.helpers import SF_SMALL, rows
from ledgerflow import schema as S
from ledgerflow.plans.etl import run_etl
from ledgerflow.sources import csv_tables as CSV
from ledgerflow.sources.star import star_tables
from ledgerflow.streaming import olap_stream, sales_stream, start_olap_sink


def test_stream_equals_batch(spark, tmp_path):
    tables = star_tables(spark, SF_SMALL)
    src = tmp_path / "incoming"
    sales = tables[S.SALES]
    # three files; the third repeats rows of the first (copies arriving later)
    sales.repartition(2).write.option("header", True).csv(str(src))
    sales.limit(50).write.mode("append").option("header", True).csv(str(src))
    lookups = {n: df for n, df in tables.items() if n != S.SALES}
    stream = olap_stream(sales_stream(spark, str(src), max_files_per_trigger=1), lookups)
    out = str(tmp_path / "olap")
    q = start_olap_sink(stream, out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    batch_tables = dict(lookups)
    batch_tables[S.SALES] = CSV.read_csv_table(spark, str(src), S.SALES, with_order=False)
    want = run_etl(batch_tables).olap
    cols = ("ID_ORDER_NUM", "IDS_ITEM", "VAL_MARGIN", "DESC_CUSTOMER", "ORDER_WEEK")
    assert got.count() == want.count()
    assert rows(got.select(*cols)) == rows(want.select(*cols))

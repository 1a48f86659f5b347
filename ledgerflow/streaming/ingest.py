"""Incremental ETL: new SALES files flow through the same row rules and the
same key-check-and-enrich joins into the OLAP sink.

The lookups are static (primary-key-checked once); the fact arrives as a
file stream.  Each micro-batch is deduplicated in itself and then against
the rows already in the sink (a null-safe anti join on every column, which
Spark runs as a distributed join), so the stream keeps no growing state
and a copy arriving in any later file is still dropped, as in the batch
ETL.  Dedup compares the sales columns after date parsing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import schema as S
from ledgerflow.operators import clean, olap
from ledgerflow.plans.etl import EtlConfig, lookup_policy, row_prep
from ledgerflow.plans.materialize import _fs_exists, cache_root, list_names
from ledgerflow.session import cut_lineage, has_many_rows
from ledgerflow.sources.csv_tables import CSV_READ, typed
from ledgerflow.sources.sinks import together


def sales_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SALES rows of arriving files, typed as the batch reader types them.  The column order is that
    of the files already there (the declared one for an empty folder); a file whose header differs
    stops the stream instead of being read by position."""
    first = [n for n in list_names(spark, source_dir) if not n.startswith(("_", "."))]
    header = spark.read.options(**CSV_READ).csv(f"{source_dir.rstrip('/')}/{first[0]}").columns if first else \
        S.TABLE_SCHEMAS[S.SALES].fieldNames()
    reader = spark.readStream.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).options(**CSV_READ)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed(reader.csv(source_dir), S.SALES)


def olap_rows(sales: DataFrame, lookups: dict[str, DataFrame], cfg: EtlConfig | None = None) -> DataFrame:
    """OLAP rows for a batch or stream of SALES rows against static lookups
    (row rules and null policies of the batch, margin, fused key check + join, calendar)."""
    cfg = cfg or EtlConfig()
    pk = {n: clean.repair_pk(clean.dedup_rows(df), cfg.primary_keys.get(n, ())) for n, df in lookups.items()}
    dates = {n: clean.date_columns(df) for n, df in {**pk, cfg.fact: sales}.items()}
    views = {n: row_prep(df, n, cfg, dates[n]) for n, df in pk.items()}
    rows = clean.apply_null_policy(row_prep(sales, cfg.fact, cfg, dates[cfg.fact]), dates[cfg.fact], cfg.critical)
    rows = olap.add_margin(rows)
    large = {n for n, df in lookups.items() if has_many_rows(df)}
    joined = olap.check_and_enrich(rows, cfg.fact, views, cfg.relations, lookup_policy(views, dates, cfg), cfg.primary_keys, large)
    order = olap.olap_column_order(rows.columns, {n: d.columns for n, d in lookups.items()}, cfg.fact, cfg.relations)
    every_date = sorted({c for cols in dates.values() for c in cols})
    return olap.add_order_calendar(clean.apply_null_policy(joined.select(order), every_date, cfg.critical))


def olap_stream(sales: DataFrame, lookups: dict[str, DataFrame], cfg: EtlConfig | None = None) -> DataFrame:
    """Streaming OLAP rows (stream-static joins); dedup happens at the sink."""
    return olap_rows(sales, lookups, cfg)


def new_rows(batch: DataFrame, seen: DataFrame, fact_columns: list[str]) -> DataFrame:
    """Rows of ``batch`` that the sink does not hold.  The sink is first cut to the months of the
    batch by an equality on its partition columns, which Spark prunes at run time, so only the
    folders of those months are read."""
    month = ["ORDER_YEAR", "ORDER_MONTH"]
    seen = seen.join(F.broadcast(batch.select(*month).distinct()), month, "left_semi")       # a row a month
    keys = [*month, *fact_columns]
    cond = reduce(lambda a, b: a & b, [batch[k].eqNullSafe(seen[k]) for k in keys])
    return batch.join(seen.select(*keys), cond, "left_anti")


def _append_new(batch: DataFrame, path: str, fact_columns: list[str]) -> None:
    batch = batch.dropDuplicates()
    spark = batch.sparkSession
    if _fs_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        batch = cut_lineage(batch)              # read twice below
        batch = new_rows(batch, spark.read.parquet(path), fact_columns)
    together(batch, ["ORDER_YEAR", "ORDER_MONTH"]).write.mode("append").partitionBy("ORDER_YEAR", "ORDER_MONTH").parquet(path)


def start_olap_sink(stream: DataFrame, path: str, name: str = "olap", available_now: bool = True,
                    checkpoint: str | None = None):
    """Append new OLAP rows into the Parquet table partitioned by year and month.  Progress lives in
    ``checkpoint``, by default a folder beside the stored tables that outlives the application, so a
    restarted query resumes where it stopped."""
    spark = stream.sparkSession
    checkpoint = checkpoint or f"{cache_root(spark).rstrip('/')}/streams/{name}"
    fact_cols = [c for c in S.TABLE_SCHEMAS[S.SALES].fieldNames()]
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, _id: _append_new(df, path, fact_cols)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

"""The six sales tables as views over the TPC-H-like test tables.

Mapping (FIXTURES.md §2): the fact is lineitem joined to orders; supplier,
customer, nation and part play company, customer, area manager and item;
business lines are the distinct part types.  ``dirty=True`` adds the
deterministic perturbation of FIXTURES.md §3 so the cleaning operators have
something to find.  Both variants read the whole tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import schema as S
from ledgerflow.session import has_many_rows, looked_up


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _dec(c: str, p: int, s: int):
    return F.col(c).cast(f"decimal({p},{s})")


def star_tables(spark: SparkSession, sf_dir: str, dirty: bool = False) -> dict[str, DataFrame]:
    li = _read(spark, sf_dir, "lineitem")
    orders = _read(spark, sf_dir, "orders")
    price = _dec("l_extendedprice", 12, 2)
    revenue = price * (F.lit(1).cast("decimal(3,2)") - _dec("l_discount", 3, 2))
    cost = price * (F.lit(0.5).cast("decimal(3,2)") + _dec("l_tax", 3, 2))
    key = F.col("l_orderkey")

    sales_cols = {
        "ID_COMPANY": F.col("l_suppkey").cast("string"),
        "ID_ORDER_NUM": key.cast("string"),
        "IDS_CUSTOMER": F.col("o_custkey").cast("string"),
        "IDS_ITEM": F.col("l_partkey").cast("string"),
        "ID_ORDER_DATE": F.date_format("o_orderdate", "yyyyMMdd"),
        "ID_INVOICE_DATE": F.date_format("l_shipdate", "yyyyMMdd"),
        "VAL_REVENUES": revenue,
        "VAL_COST": cost,
    }
    if dirty:
        sales_cols["ID_COMPANY"] = F.when(key % 53 != 0, sales_cols["ID_COMPANY"])
        sales_cols["IDS_ITEM"] = (
            F.when(key % 61 != 0, sales_cols["IDS_ITEM"])
            .when(F.col("l_linenumber") == 1, F.lit("99999999")).otherwise(F.lit("-1")))
        sales_cols["ID_INVOICE_DATE"] = (
            F.when(key % 67 == 0, F.lit("27881231"))
            .when(key % 71 == 0, F.lit("20251345"))
            .otherwise(sales_cols["ID_INVOICE_DATE"]))
        sales_cols["VAL_REVENUES"] = F.when(key % 73 != 0, revenue)

    fact = li.join(looked_up(orders, has_many_rows(orders)), li.l_orderkey == orders.o_orderkey)
    if dirty:                   # repeated rows, from the one join
        fact = fact.withColumn("_copy", F.explode(F.when(key % 100 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    sales = fact.select([c.alias(n) for n, c in sales_cols.items()])

    cust = _read(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    area = F.col("c_nationkey").cast("string")
    country = F.col("c_mktsegment")
    if dirty:
        area = (F.when(ck % 59 == 0, F.lit(None).cast("string"))
                .when(ck % 47 == 0, (F.col("c_nationkey") + 1000).cast("string"))
                .otherwise(area))
        country = F.when(ck % 43 != 0, country)
    customer = cust.select(ck.cast("string").alias("IDS_CUSTOMER"),
                           F.col("c_name").alias("DESC_CUSTOMER"),
                           country.alias("ID_COUNTRY"), area.alias("ID_AREA_MANAGER"))

    part = _read(spark, sf_dir, "part")
    item = part.select(F.col("p_partkey").cast("string").alias("IDS_ITEM"),
                       F.col("p_name").alias("DESC_ITEM"),
                       F.col("p_type").alias("ID_BUSINESS_LINE"))
    if dirty:
        item = item.unionByName(
            part.filter(F.col("p_partkey") % 37 == 0).select(
                F.col("p_partkey").cast("string").alias("IDS_ITEM"),
                F.concat(F.col("p_name"), F.lit(" B")).alias("DESC_ITEM"),
                F.col("p_type").alias("ID_BUSINESS_LINE")))

    business_line = part.select(F.col("p_type").alias("ID_BUSINESS_LINE")).distinct().select(
        "ID_BUSINESS_LINE", F.concat(F.lit("BL "), F.col("ID_BUSINESS_LINE")).alias("DESC_BUSINESS_LINE"))

    company = _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ID_COMPANY"), F.col("s_name").alias("DESC_COMPANY"))
    area_manager = _read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("ID_AREA_MANAGER"),
        F.col("n_name").alias("DESC_AREA_MANAGER"))

    return {
        S.SALES: sales,
        S.AREA_MANAGER: area_manager,
        S.COMPANY: company,
        S.CUSTOMER: customer,
        S.BUSINESS_LINE: business_line,
        S.ITEM: item,
    }

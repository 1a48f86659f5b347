"""Sales aggregates over the OLAP table (G1-G11).

Money stays an exact decimal through every sum; ``as_double`` casts the
totals at the edge.  Group keys that are null are dropped before grouping
(the source semantics), and an all-null sum is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.columns import zero_if_null_sum

MONTH_KEYS = ("ORDER_YEAR", "ORDER_MONTH", "ID_COMPANY", "DESC_BUSINESS_LINE", "ID_COUNTRY")
CUSTOMER_KEYS = ("IDS_CUSTOMER", "DESC_CUSTOMER", "ID_COUNTRY", "DESC_AREA_MANAGER")
ITEM_KEYS = ("IDS_ITEM", "DESC_ITEM", "DESC_BUSINESS_LINE")


def _edge(c: Column, as_double: bool) -> Column:
    return c.cast("double") if as_double else c


def sales_totals(olap: DataFrame, keys: Sequence[str], as_double: bool = True) -> DataFrame:
    """TOTAL_REVENUES / TOTAL_COST / TOTAL_MARGIN sums and N_ORDERS (count of
    non-null order numbers, not distinct) per group; null keys dropped."""
    return (olap.dropna(subset=list(keys)).groupBy(*keys).agg(
        _edge(zero_if_null_sum("VAL_REVENUES"), as_double).alias("TOTAL_REVENUES"),
        _edge(zero_if_null_sum("VAL_COST"), as_double).alias("TOTAL_COST"),
        _edge(zero_if_null_sum("VAL_MARGIN"), as_double).alias("TOTAL_MARGIN"),
        F.count("ID_ORDER_NUM").alias("N_ORDERS")))


def monthly_sales(olap: DataFrame, as_double: bool = True) -> DataFrame:          # G1
    return sales_totals(olap, MONTH_KEYS, as_double)


def customer_sales(olap: DataFrame, as_double: bool = True) -> DataFrame:         # G2
    return sales_totals(olap, CUSTOMER_KEYS, as_double)


def item_sales(olap: DataFrame, as_double: bool = True) -> DataFrame:             # G3
    return sales_totals(olap, ITEM_KEYS, as_double)


def aggregate_all(olap: DataFrame, as_double: bool = True) -> dict[str, DataFrame]:
    return {"mensile": monthly_sales(olap, as_double), "clienti": customer_sales(olap, as_double),
            "articoli": item_sales(olap, as_double)}


def monthly_total(monthly: DataFrame, series_keys: Sequence[str] = (),
                  as_double: bool = True) -> DataFrame:                            # G4
    """Month consolidation: revenue and order sums per (series, year, month)."""
    keys = [*series_keys, "ORDER_YEAR", "ORDER_MONTH"]
    return monthly.groupBy(*keys).agg(
        _edge(F.sum("TOTAL_REVENUES"), as_double).alias("TOTAL_REVENUES"),
        F.sum("N_ORDERS").alias("N_ORDERS"))


def monthly_history(monthly: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:   # G5
    """(series.., ORDER_YEAR, ORDER_MONTH, REVENUES, DATE) with DATE the first of the month."""
    keys = [*series_keys, "ORDER_YEAR", "ORDER_MONTH"]
    return monthly.groupBy(*keys).agg(F.sum("TOTAL_REVENUES").cast("double").alias("REVENUES")).withColumn(
        "DATE", F.make_date("ORDER_YEAR", "ORDER_MONTH", F.lit(1)))


def revenue_by_company(olap: DataFrame) -> DataFrame:                              # G6
    return olap.dropna(subset=["ID_COMPANY"]).groupBy("ID_COMPANY").agg(
        zero_if_null_sum("VAL_REVENUES").cast("double").alias("VAL_REVENUES"),
        (zero_if_null_sum("VAL_REVENUES").cast("double") / F.lit(1_000_000.0)).alias("VAL_REVENUES_MLN"))


def orders_by_country(olap: DataFrame) -> DataFrame:                               # G7
    return olap.dropna(subset=["ID_COUNTRY"]).groupBy("ID_COUNTRY").agg(F.count(F.lit(1)).alias("N_ROWS"))


def daily_revenue(olap: DataFrame) -> DataFrame:                                   # G8
    d = F.col("ID_ORDER_DATE").cast("date")
    return olap.where(d.isNotNull()).groupBy(d.alias("ORDER_DATE")).agg(
        zero_if_null_sum("VAL_REVENUES").cast("double").alias("VAL_REVENUES"))


def customer_frequency(olap: DataFrame) -> DataFrame:                              # G9
    return olap.dropna(subset=["IDS_CUSTOMER"]).groupBy("IDS_CUSTOMER").agg(
        F.count("ID_ORDER_NUM").alias("N_ORDERS"),
        zero_if_null_sum("VAL_REVENUES").cast("double").alias("TOTAL_REVENUES"))


def rfm(olap: DataFrame) -> DataFrame:                                             # G10
    """Recency = days from a customer's last order to the day after the
    latest order overall (a scalar subquery, one value); Frequency = distinct
    orders; Monetary = revenue sum."""
    d = F.col("ID_ORDER_DATE").cast("date")
    snapshot = F.date_add(olap.agg(F.max(d)).scalar(), 1)
    per = olap.dropna(subset=["IDS_CUSTOMER"]).groupBy("IDS_CUSTOMER").agg(
        F.max(d).alias("_last"),
        F.count_distinct("ID_ORDER_NUM").alias("Frequency"),
        zero_if_null_sum("VAL_REVENUES").cast("double").alias("Monetary"))
    return per.select("IDS_CUSTOMER", F.datediff(snapshot, F.col("_last")).alias("Recency"),
                      "Frequency", "Monetary")


def invoice_delay(olap: DataFrame) -> DataFrame:                                   # G11
    """Rows with both dates: days from order to invoice, with the revenue."""
    o, i = F.col("ID_ORDER_DATE").cast("date"), F.col("ID_INVOICE_DATE").cast("date")
    return olap.where(o.isNotNull() & i.isNotNull()).select(
        "ID_ORDER_NUM", "IDS_CUSTOMER", F.col("VAL_REVENUES").cast("double").alias("VAL_REVENUES"),
        F.datediff(i, o).alias("INVOICE_DAYS"))

"""E3: the statistics report (five parts per dataset) and chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators import aggregate as G
from ledgerflow.operators import profile as P

SUMMARY = "riepilogo"


def statistics_report(datasets: dict[str, DataFrame], top_k: int = 5) -> dict[tuple[str, ...], DataFrame]:
    """Parts by (dataset, part): the summary of all datasets as ("riepilogo",), and for each
    dataset info, missing, numeriche and categoriche.  Names are kept whole; ``write_report``
    makes folders of them."""
    parts: dict[tuple[str, ...], DataFrame] = {(SUMMARY,): P.shape(datasets)}
    for name, df in datasets.items():
        figures = F.array(*[F.struct(F.lit(label).alias("METRIC"), value.cast("long").alias("VALUE")) for label, value in (
            ("Numero righe", F.col("v")), ("Numero colonne", F.lit(len(df.columns))))])
        parts[name, "info"] = df.agg(F.count(F.lit(1)).alias("v")).select(F.inline(figures))
        parts[name, "missing"] = P.missing(df)
        if P.numeric_columns(df):
            parts[name, "numeriche"] = P.describe(df)
        if P.categorical_columns(df):
            parts[name, "categoriche"] = P.top_values(df, k=top_k, include_nulls=True)
    return parts


def chart_data(olap: DataFrame) -> dict[str, DataFrame]:
    """The data behind every chart of the source app (drawing is not done here)."""
    return {
        "revenue_histogram": P.histogram(olap, "VAL_REVENUES", 50),
        "revenue_density": P.density(olap, "VAL_REVENUES"),
        "orders_by_country": G.orders_by_country(olap),
        "revenue_by_company": G.revenue_by_company(olap),
        "revenue_box": P.box_stats(olap, "ID_BUSINESS_LINE", "VAL_REVENUES"),
        "cost_revenue_bins": P.binned_pairs(olap, "VAL_COST", "VAL_REVENUES"),
        "correlation": P.correlation(olap, ["VAL_REVENUES", "VAL_COST"]),
        "correlation_profit": P.correlation_with_profit(olap),
        "daily_revenue": G.daily_revenue(olap),
        "customer_frequency": G.customer_frequency(olap),
        "invoice_delay": G.invoice_delay(olap),
        "rfm": G.rfm(olap),
    }

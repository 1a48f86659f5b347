import datetime as dt

from tests.helpers import rows
from ledgerflow.operators import aggregate as G


def _olap(spark):
    return spark.createDataFrame([
        ("C1", "o1", "U1", dt.date(2024, 1, 3), dt.date(2024, 1, 5), 10.0, 4.0, 6.0, "IT", "B", 2024, 1),
        ("C1", "o1", "U1", dt.date(2024, 1, 3), dt.date(2024, 1, 1), 5.0, 1.0, 4.0, "IT", "B", 2024, 1),
        ("C1", "o2", "U2", dt.date(2024, 2, 3), dt.date(2024, 2, 4), None, None, None, None, "B", 2024, 2),
        ("C2", None, "U2", dt.date(2024, 2, 9), dt.date(2024, 2, 9), None, 1.0, None, "FR", "B", 2024, 2),
    ], "ID_COMPANY string, ID_ORDER_NUM string, IDS_CUSTOMER string, ID_ORDER_DATE date, ID_INVOICE_DATE date, "
       "VAL_REVENUES double, VAL_COST double, VAL_MARGIN double, ID_COUNTRY string, DESC_BUSINESS_LINE string, "
       "ORDER_YEAR int, ORDER_MONTH int")


def test_monthly_drops_null_keys_and_counts_non_null_orders(spark):
    out = rows(G.monthly_sales(_olap(spark)), "ORDER_MONTH", "ID_COMPANY", "ID_COUNTRY", "TOTAL_REVENUES",
               "TOTAL_COST", "N_ORDERS")
    # the null-country row is gone; the all-null revenue sum is 0; null order numbers are not counted
    assert out == [(1, "C1", "IT", 15.0, 5.0, 2), (2, "C2", "FR", 0.0, 1.0, 0)]


def test_rfm(spark):
    out = {r.IDS_CUSTOMER: r for r in G.rfm(_olap(spark)).collect()}
    assert (out["U1"].Recency, out["U1"].Frequency, out["U1"].Monetary) == (38, 1, 15.0)
    assert (out["U2"].Recency, out["U2"].Frequency) == (1, 1)


def test_invoice_delay_and_frequency(spark):
    o = _olap(spark)
    assert sorted(r.INVOICE_DAYS for r in G.invoice_delay(o).collect()) == [-2, 0, 1, 2]
    f = {r.IDS_CUSTOMER: (r.N_ORDERS, r.TOTAL_REVENUES) for r in G.customer_frequency(o).collect()}
    assert f == {"U1": (2, 15.0), "U2": (1, 0.0)}


def test_company_and_country(spark):
    o = _olap(spark)
    assert rows(G.revenue_by_company(o)) == [("C1", 15.0, 1.5e-05), ("C2", 0.0, 0.0)]
    assert rows(G.orders_by_country(o)) == [("FR", 1), ("IT", 2)]

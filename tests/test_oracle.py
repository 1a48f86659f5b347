"""Every registered query against its DuckDB statement on the small tables."""

import math
import os

import duckdb
import pytest

from tests.helpers import SF_SMALL
from __spark_entry__ import entry, oracle_sql, queries
from ledgerflow.oracle_sql import statements
from ledgerflow.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()
SQL = statements()
#: Checked against a plain booster in test_boosting.py.
BRUTE_FORCED = {"gbt_model", "gbt_by_company", "gbt_importance", "gbt_importance_by_company", "forecast_gbt", "forecast_gbt_by_company",
                "compare_models", "compare_models_by_company"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_sql_or_is_model_based():
    no_sql = set(QUERIES) - set(SQL)
    assert no_sql <= BRUTE_FORCED
    assert set(SQL) <= set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, want)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["ORDER_YEAR", "ORDER_MONTH", "ID_COMPANY", "DESC_BUSINESS_LINE", "ID_COUNTRY",
                          "TOTAL_REVENUES", "TOTAL_COST", "TOTAL_MARGIN", "N_ORDERS"]

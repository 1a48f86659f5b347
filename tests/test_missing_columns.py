"""Key columns that a source lacks are reported and passed over, in the fused and the step-by-step plan."""

import pytest
from tests.helpers import SF_SMALL, rows

from ledgerflow import schema as S
from ledgerflow.plans.etl import EtlConfig, run_etl
from ledgerflow.sources.star import star_tables

COLS = ("ID_ORDER_NUM", "IDS_ITEM", "DESC_ITEM")


@pytest.fixture(scope="module")
def small(spark):
    tables = star_tables(spark, SF_SMALL, dirty=True)
    sales = tables[S.SALES].where("ID_ORDER_NUM % 20 = 0")
    return {**tables, S.SALES: sales}


@pytest.mark.parametrize("table,column", [(S.SALES, "ID_COMPANY"), (S.COMPANY, "ID_COMPANY"), (S.CUSTOMER, "ID_COUNTRY")])
def test_missing_column_is_passed_over(small, table, column):
    tables = {**small, table: small[table].drop(column)}
    res = run_etl(tables)
    assert rows(res.olap.select(*COLS)) == rows(run_etl(tables, fused=False).olap.select(*COLS))
    audit = res.audit().collect()
    assert all(r.N is None and r.LEVEL == "WARNING" for r in audit if r.TABLE_NAME == table and r.COLUMN_NAME == column)
    assert [r for r in audit if r.PHASE == "FK" and r.COLUMN_NAME == "IDS_ITEM"]


def test_configured_table_names_and_keys(small):
    renamed = {("FIRM" if n == S.COMPANY else n): df for n, df in small.items()}
    cfg = EtlConfig(relations={c: tuple((fk, "FIRM" if p == S.COMPANY else p) for fk, p in r) for c, r in S.RELATIONS.items()},
                    primary_keys={("FIRM" if n == S.COMPANY else n): k for n, k in S.PRIMARY_KEYS.items()})
    assert rows(run_etl(renamed, cfg).olap.select(*COLS)) == rows(run_etl(small).olap.select(*COLS))

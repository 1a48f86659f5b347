"""Star-schema configuration: table names, explicit CSV schemas, key maps.

The values in this module are fixed by the data model of the sales
pipeline being rebuilt (six tables, one fact, five lookups).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: table names, key configuration, critical columns --------
SALES = "SALES"
CUSTOMER = "CUSTOMER_LOOKUP"
ITEM = "ITEM_LOOKUP"
COMPANY = "COMPANY_LOOKUP"
AREA_MANAGER = "AREA_MANAGER_LOOKUP"
BUSINESS_LINE = "ITEM_BUSINESS_LINE_LOOKUP"

EXPECTED_TABLES = (SALES, AREA_MANAGER, COMPANY, CUSTOMER, BUSINESS_LINE, ITEM)

# child table -> ordered (fk column, parent table); the order is the check
# order and the depth-first join order.
RELATIONS: dict[str, tuple[tuple[str, str], ...]] = {
    SALES: (("ID_COMPANY", COMPANY), ("IDS_CUSTOMER", CUSTOMER), ("IDS_ITEM", ITEM)),
    CUSTOMER: (("ID_AREA_MANAGER", AREA_MANAGER),),
    ITEM: (("ID_BUSINESS_LINE", BUSINESS_LINE),),
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    SALES: (),
    CUSTOMER: ("IDS_CUSTOMER",),
    ITEM: ("IDS_ITEM",),
    AREA_MANAGER: ("ID_AREA_MANAGER",),
    BUSINESS_LINE: ("ID_BUSINESS_LINE",),
    COMPANY: ("ID_COMPANY",),
}

TECHNICAL_KEYS: dict[str, tuple[str, ...]] = {
    SALES: ("ID_ORDER_NUM", "ID_ORDER_DATE", "ID_INVOICE_DATE"),
    CUSTOMER: ("ID_COUNTRY",),
}

CRITICAL_NUMERIC = ("VAL_REVENUES", "VAL_COST")
DERIVED = ("VAL_MARGIN",)
CALENDAR_COLUMNS = ("ORDER_YEAR", "ORDER_MONTH", "ORDER_WEEK")
# ---------------------------------------------------------------------------

_S = T.StringType()
_D = T.DoubleType()

TABLE_SCHEMAS: dict[str, T.StructType] = {
    SALES: T.StructType([
        T.StructField("ID_COMPANY", _S), T.StructField("ID_ORDER_NUM", _S),
        T.StructField("IDS_CUSTOMER", _S), T.StructField("IDS_ITEM", _S),
        T.StructField("ID_ORDER_DATE", _S), T.StructField("ID_INVOICE_DATE", _S),
        T.StructField("VAL_REVENUES", _D), T.StructField("VAL_COST", _D),
    ]),
    CUSTOMER: T.StructType([
        T.StructField("IDS_CUSTOMER", _S), T.StructField("DESC_CUSTOMER", _S),
        T.StructField("ID_COUNTRY", _S), T.StructField("ID_AREA_MANAGER", _S),
    ]),
    ITEM: T.StructType([
        T.StructField("IDS_ITEM", _S), T.StructField("DESC_ITEM", _S),
        T.StructField("ID_BUSINESS_LINE", _S),
    ]),
    COMPANY: T.StructType([T.StructField("ID_COMPANY", _S), T.StructField("DESC_COMPANY", _S)]),
    AREA_MANAGER: T.StructType([
        T.StructField("ID_AREA_MANAGER", _S), T.StructField("DESC_AREA_MANAGER", _S),
    ]),
    BUSINESS_LINE: T.StructType([
        T.StructField("ID_BUSINESS_LINE", _S), T.StructField("DESC_BUSINESS_LINE", _S),
    ]),
}


@dataclass(frozen=True)
class Relation:
    child: str
    fk: str
    parent: str


def relations(config: dict[str, tuple[tuple[str, str], ...]] = RELATIONS) -> list[Relation]:
    """Relations flattened in check order (child tables in config order)."""
    return [Relation(child, fk, parent) for child, pairs in config.items() for fk, parent in pairs]


def is_id_like(name: str) -> bool:
    """Columns excluded from numeric profiling: 'ID' anywhere in the name.

    This is a substring rule on purpose (a column called WIDTH matches).
    """
    return "ID" in name


def is_date_like(name: str) -> bool:
    """Date columns are found by the substring DATE in the upper-cased name."""
    return "DATE" in name.upper()


def is_profiled_numeric(name: str) -> bool:
    return not is_id_like(name) and name not in CALENDAR_COLUMNS

import datetime as dt

from pyspark.sql import functions as F

from tests.helpers import rows
from ledgerflow.operators import clean
from ledgerflow.schema import is_date_like, is_id_like, is_profiled_numeric
from ledgerflow.sources.csv_tables import ORDER_COLUMN


def test_dedup_rows_nulls_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "k string, v double")
    assert rows(clean.dedup_rows(df)) == [("a", None), ("b", 1.0)]
    rep = clean.dedup_report("T", df).first()
    assert (rep.ROWS_BEFORE, rep.ROWS_AFTER, rep.REMOVED) == (3, 2, 1)


def test_dedup_keeps_first_position(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1)], "k string, o int").withColumn(
        ORDER_COLUMN, F.struct(F.col("o"))).drop("o")
    out = clean.dedup_rows(df).first()
    assert out[ORDER_COLUMN][0] == 1


def test_repair_pk_drops_null_and_keeps_smallest(spark):
    df = spark.createDataFrame([(1, "x B"), (1, "x"), (None, "n"), (2, "y")], "id long, d string")
    out = clean.repair_pk(df, ["id"])
    assert dict(out.schema.fields and [(f.name, f.dataType.simpleString()) for f in out.schema.fields])["id"] == "string"
    assert rows(out) == [("1", "x"), ("2", "y")]
    rep = clean.pk_report("T", df, "id").first()
    assert (rep.NULL_KEYS, rep.DUPLICATE_ROWS, rep.ROWS) == (1, 1, 4)


def test_repair_pk_keeps_first_in_file_order(spark):
    df = spark.createDataFrame([("1", "late", 5), ("1", "early", 2)], "id string, d string, o int")
    df = df.withColumn(ORDER_COLUMN, F.struct("o")).drop("o")
    assert clean.repair_pk(df, ["id"]).first()["d"] == "early"


def test_repair_fk_semi_and_orphans(spark):
    child = spark.createDataFrame([(1, "k1"), (2, None), (3, "zz"), (4, "k2"), (5, "zz")], "n int, fk string")
    parent = spark.createDataFrame([("k1",), ("k2",), (None,)], "fk string")
    out = clean.repair_fk(child, "fk", parent)
    assert out.columns == ["n", "fk"]          # column order kept
    assert rows(out) == [(1, "k1"), (4, "k2")]
    assert rows(clean.fk_orphans(child, "fk", parent)) == [("zz", 2)]
    rep = clean.fk_report("C", child, "fk", "P", parent).first()
    assert (rep.NULL_FK, rep.ORPHAN_VALUES, rep.ORPHAN_ROWS, rep.ROWS) == (1, 1, 2, 5)


def test_technical_keys_never_delete(spark):
    df = spark.createDataFrame([(1, None), (2, 7)], "a int, t int")
    out = clean.cast_technical_keys(df, ["t", "missing"])
    assert out.count() == 2 and dict(out.dtypes)["t"] == "string"
    assert clean.technical_key_report("T", df, ["t"]).first().NULLS == 1


def test_parse_dates_rules(spark):
    vals = ["20250108", " 20250108 ", "27881231", "20251345", "2025010", "2025", "2025-01-08", "abc", None]
    df = spark.createDataFrame([(v,) for v in vals], "ID_ORDER_DATE string")
    got = [r[0] for r in clean.normalise_dates(df).collect()]
    d = dt.date
    assert got == [d(2025, 1, 8), d(2025, 1, 8), d(2788, 12, 31), None, None, None, d(2025, 1, 8), None, None]


def test_date_profile(spark):
    df = spark.createDataFrame([("27881231",), ("27881231",), ("29990101",), ("20250101",), ("x",), (None,)],
                               "ID_INVOICE_DATE string")
    r = clean.date_profile("SALES", df).first()
    assert (r.N_8_DIGITS, r.N_OTHER, r.N_YEAR_GT_2262, r.EXAMPLES) == (4, 2, 3, "27881231,29990101")


def test_null_policy_sequential_counts(spark):
    df = spark.createDataFrame(
        [(None, 1.0, None, "a"), (dt.date(2020, 1, 1), None, None, "c"), (dt.date(2020, 1, 1), 2.0, 1.0, None)],
        "ID_ORDER_DATE date, VAL_REVENUES double, VAL_MARGIN double, NOTE string")
    rep = {r.COLUMN_NAME: r for r in clean.null_policy_report(
        "T", df, ["ID_ORDER_DATE"], ["VAL_REVENUES"], ["VAL_MARGIN"]).collect()}
    assert rep["ID_ORDER_DATE"].NULLS == 1 and rep["ID_ORDER_DATE"].ACTION == "DROP"
    assert rep["VAL_REVENUES"].NULLS == 1                 # counted after the date drop
    assert "VAL_MARGIN" not in rep                        # its null rows were dropped earlier
    assert rep["NOTE"].NULLS == 1 and rep["NOTE"].LEVEL == "WARNING"
    assert clean.apply_null_policy(df, ["ID_ORDER_DATE"], ["VAL_REVENUES"]).count() == 1


def test_derived_nulls_are_errors_not_drops(spark):
    df = spark.createDataFrame([(1.0, None)], "VAL_REVENUES double, VAL_MARGIN double")
    r = clean.null_policy_report("T", df, [], ["VAL_REVENUES"], ["VAL_MARGIN"]).first()
    assert (r.KIND, r.LEVEL, r.ACTION) == ("DERIVED", "ERROR", "KEEP")


def test_name_predicates_are_substring_rules():
    assert is_id_like("WIDTH") and is_id_like("ID_COMPANY") and not is_id_like("VAL_COST")
    assert is_date_like("UPDATED_BY") and is_date_like("id_order_date") and not is_date_like("VAL")
    assert not is_profiled_numeric("ORDER_WEEK") and is_profiled_numeric("VAL_REVENUES")


def test_null_report(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(clean.null_report(df)) == [("a", 1, 0), ("b", 2, 1)]


def test_numeric_keys_with_and_without_zero_padding(spark):
    from ledgerflow.functions.columns import normalise_numeric_key
    df = spark.createDataFrame([("00040",), ("40",), ("000",), (" 7 ",), ("4C1",), ("00040-10277",), (None,)], "k string")
    got = [r[0] for r in df.select(normalise_numeric_key("k")).collect()]
    assert got == ["40", "40", "0", "7", "4C1", "00040-10277", None]
    child = spark.createDataFrame([(1, "40"), (2, "00041")], "n int, ID_COMPANY string")
    parent = spark.createDataFrame([("00040",), ("41",)], "ID_COMPANY string")
    assert clean.repair_fk(child, "ID_COMPANY", parent).count() == 0          # text keys: no match (default)
    assert rows(clean.repair_fk(child, "ID_COMPANY", parent, normalise=True)) == [(1, "40"), (2, "41")]


def test_several_keys_are_repaired_one_after_the_other(spark):
    df = spark.createDataFrame([("1", "x", 1), ("1", "y", 2), ("2", "x", 3), ("3", None, 4), (None, "z", 5)], "p string, q string, v int")
    assert [tuple(r) for r in clean.repair_pk(df, ["p", "q"]).collect()] == [("1", "x", 1)]
    assert rows(clean.repair_pk(df, ["p"])) == [("1", "x", 1), ("2", "x", 3), ("3", None, 4)]

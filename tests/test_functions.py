from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.functions import hashing as H
from cardlake.functions.naming import normalize_columns, to_snake
from cardlake.functions.payload import REQUIRED_FIELDS, json_path, json_paths_missing, normalize_payload


def one(spark, values, make, kind="string"):
    """make() applied to each value, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", make(F.col("v"))).collect())]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("CustomerId", "customer_id"),
        ("% Change", "pct_change"),
        ("Sales & Admin", "sales_and_admin"),
        ("2nd Value", "c_2nd_value"),
        (" spaced  name ", "spaced_name"),
        ("HasCrCard", "has_cr_card"),
        ("NumOfProducts", "num_of_products"),
        ("GICS Sub Industry", "gics_sub_industry"),
        ("Add'l income/expense items", "add_l_income_expense_items"),
        ("CIK", "cik"),
        ("OpenInt", "open_int"),
        ("SECFilings", "sec_filings"),
        ("a__B--c", "a_b_c"),
        ("", ""),
    ],
)
def test_to_snake(name, expected):
    assert to_snake(name) == expected


def test_normalize_columns_names_the_empty_header(spark):
    df = spark.createDataFrame([(1, 2)], ["_c0", "Period Ending"])
    assert normalize_columns(df).columns == ["unnamed_0", "period_ending"]


def test_money(spark):
    values = ["$14,500.00", "$-77.00", "", "N/A", None, "1.2.3"]
    assert one(spark, values, lambda c: C.money(c, signed=True)) == [14500.0, -77.0, None, None, None, None]
    assert one(spark, values, C.money) == [14500.0, 77.0, None, None, None, None]


def test_whole_numbers(spark):
    values = ["12", "5812.0", " 7 ", "x", "", None, "99999999999"]
    assert one(spark, values, C.to_int) == [12, 5812, 7, None, None, None, None]
    assert one(spark, values, C.to_long)[-1] == 99999999999


def test_bool_yn(spark):
    values = ["Yes", "n", "1", "0", "", "maybe", None, " true "]
    assert one(spark, values, C.bool_yn) == [True, False, True, False, None, None, None, True]
    assert one(spark, ["J"], lambda c: C.bool_yn(c, ["j"], ["n"])) == [True]


def test_date_multi(spark):
    values = ["2020-01-31", "01/31/2020", "2020/01/31", "31.01.2020", "09/2002", "13/2020", None, "x"]
    day = date(2020, 1, 31)
    assert one(spark, values, C.date_multi) == [day, day, day, day, date(2002, 9, 1), None, None, None]


def test_expiry_month(spark):
    values = ["12/2022", "12/22", "1/22", "", None, "13/22", "12-2022"]
    first = date(2022, 12, 1)
    assert one(spark, values, C.expiry_month) == [first, first, None, None, None, None, first]


def test_mcc_code(spark):
    assert one(spark, [742, 5411, 54111, None], C.mcc_code, "int") == ["0742", "5411", "5411", None]
    assert one(spark, ["0742", "74", "74a1", None], C.is_mcc_code) == [True, False, False, None]


def test_error_code(spark):
    values = [None, "", "0", "5", "Insufficient Balance"]
    assert one(spark, values, C.error_code) == [0, 0, 0, 5, 0]
    assert one(spark, values, lambda c: C.error_code(c, "text")) == [0, 0, 0, 5, -1]
    with pytest.raises(ValueError):
        C.error_code("v", "other")


def test_is_chip_used(spark):
    values = ["Chip Transaction", "ONLINE", None, ""]
    assert one(spark, values, C.is_chip_used) == [True, False, None, False]


def test_calendar(spark):
    days = spark.createDataFrame([(date(2000, 1, 1),), (date(2001, 12, 31),)], "d date")
    got = days.select(*[c.alias(n) for n, c in C.calendar_columns("d").items()]).orderBy("date_id").collect()
    saturday, monday = got[0], got[1]
    assert saturday["date_id"] == 20000101 and saturday["day_of_week_iso"] == 6 and saturday["is_weekend"]
    assert saturday["day_name"] == "Saturday" and saturday["week_of_year"] == 52
    assert monday["day_of_week_iso"] == 1 and monday["week_of_year"] == 1 and not monday["is_weekend"]
    assert monday["month_name"] == "December" and monday["quarter_number"] == 4


def test_small_scalars(spark):
    df = spark.createDataFrame([(date(2001, 2, 28), 6.0, 0.0, "abcdef", "x/aapl.us.txt", Decimal("1.005"))],
                               "d date, a double, b double, t string, p string, m decimal(18,3)")
    got = df.select(
        C.month_start("d"), C.date_id("d"), C.yyyymm("d"), C.month_label("d"), C.iso_weekday("d"),
        C.safe_divide(F.col("a"), F.col("b")), C.safe_divide(F.col("a"), F.col("b"), None),
        C.varchar("t", 3), C.ticker_from_path("p"), C.to_decimal("m"), C.is_blank("t"),
    ).first()
    assert tuple(got) == (date(2001, 2, 1), 20010228, 200102, "2001-02", 3, 0.0, None, "abc", "aapl", Decimal("1.01"), False)


def test_hash_forms(spark):
    import hashlib

    df = spark.createDataFrame([(1, None, True, datetime(2020, 1, 2, 3, 4, 5))], "a int, b string, c boolean, t timestamp")
    got = df.select(H.record_hash(["a", "b", "c", "t"]), H.warehouse_hash(["a", "b", H.bit("c")]),
                    H.natural_keys_json(["a", "b"])).first()
    assert got[0] == hashlib.sha256("1||∅||true||2020-01-02 03:04:05".encode()).hexdigest()
    assert got[1] == hashlib.sha256(b"1||1").hexdigest().upper()
    assert got[2] == '{"a":1}'
    with pytest.raises(ValueError):
        H.add_record_hash(df, ["a", "zz"])


def test_hash_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).select("id", F.col("id").cast("string").alias("s"))
    a = H.add_record_hash(df.repartition(1), ["id", "s"])
    b = H.add_record_hash(df.repartition(7), ["id", "s"])
    assert a.exceptAll(b).count() == 0


def test_payload(spark):
    nested = '{"contract_version":"1.0","layer":"silver","run_id":"r","entity_code":"e","load_mode":"full",' \
             '"status":"SUCCESS","metrics":{"row_out":1},"table":{"target_table":"t"},' \
             '"timing":{"started_utc":"a","ended_utc":"b","duration_ms":0}}'
    flat = '{"row_out":5,"target_table":"t"}'
    df = spark.createDataFrame([(1, nested), (2, flat), (3, '{"metrics":{}}')], "i int, p string")
    missing = dict(df.select("i", json_paths_missing("p")).collect())
    assert missing[1] == [] and len(missing[2]) == len(REQUIRED_FIELDS)
    fixed = df.select("i", normalize_payload("p", F.lit("2020-01-01").cast("timestamp"), F.lit("r9"), F.lit("e9")).alias("p"))
    got = dict(rows(fixed.select("i", json_path("p", "metrics.row_out"))))
    assert got == {1: "1", 2: "5", 3: None}
    version = dict(rows(fixed.select("i", json_path("p", "contract_version"))))
    assert version[1] == "1.0" and version[2] == "0.x-legacy"
    again = dict(fixed.select("i", json_paths_missing("p")).collect())
    assert again[1] == [] and again[2] == ["load_mode"]


def test_text_that_is_no_number_is_not_cast(spark):
    values = ["5", " 5.0 ", "-3", "1e3", "1E2", "Insufficient Balance", "N/A", " ", "", "-", "e", "5x", "٣", "true", "NaN", None]
    plain = lambda c: F.coalesce(c.try_cast("int"), c.try_cast("decimal(38,10)").try_cast("int"))
    assert one(spark, values, C.to_int) == one(spark, values, plain)
    assert one(spark, [True, False, None], C.to_int, "boolean") == [1, 0, None]
    assert one(spark, ["$", "N/A", "", "-$1.5", None], lambda c: C.money(c, signed=True)) == [None, None, None, -1.5, None]
    df = spark.createDataFrame([("x",)], "v string").select(C.to_int("v"), C.money("v"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in text

"""Registered queries: a Spark frame and the DuckDB text that must equal it.

Load times and hashes of a clock are left out; timestamps are given as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.catalog import landing as L
from cardlake.catalog import views as V
from cardlake.catalog.oracle import AGGREGATE, bucketed_number, money_sum, with_views
from cardlake.functions import columns as C
from cardlake.functions import hashing as H
from cardlake.functions.naming import normalize_columns
from cardlake.functions.payload import check_payloads, json_path, normalize_payload
from cardlake.operators import compliance, projection, quality
from cardlake.operators import upsert as U
from cardlake.operators.conform import (
    anomaly_count,
    anomaly_kpis,
    conforming,
    orphan_report,
    tag_orphans,
)
from cardlake.operators.dedup import dedup_latest
from cardlake.operators.projection import filter_as_of
from cardlake.plans import contracts as K
from cardlake.plans import controls, gold, ingest, measures, ops_measures, runlog, silver, warehouse
from cardlake.plans.bronze import ENTITIES, FUNDAMENTAL_MEASURES, pairs_from_object, to_bronze
from cardlake.session import checkpoint_dir
from cardlake.sources import numbered, readers, writers
from cardlake.sources.readers import spine_over
from cardlake.streaming.files import read_latest, stream_ingest, stream_latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

STAMP = "yyyy-MM-dd HH:mm:ss"
TECHNICAL = ("source_file", "ingestion_date", "ingestion_ts", "entity", "gold_run_id", "gold_load_ts")


def query(sql: str | None = None, name: str | None = None):
    def register(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLE[key] = with_views(sql)
        return f

    return register


def business(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL)


def now():
    return V._ts("2024-12-31 00:00:00")


# --- functions --------------------------------------------------------------


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, t AS amount_text,
           CAST(regexp_replace(t, '[^0-9.-]', '', 'g') AS DOUBLE) AS amount_signed,
           CAST(regexp_replace(t, '[^0-9.]', '', 'g') AS DOUBLE) AS amount_unsigned
    FROM (SELECT *, concat('$', format('{:,.2f}', CASE WHEN l_returnflag = 'R' THEN -l_extendedprice
                 ELSE l_extendedprice END)) AS t FROM lineitem)""")
def money_strip(spark, sf):
    price = F.col("l_extendedprice")
    text = F.concat(F.lit("$"), F.format_number(F.when(F.col("l_returnflag") == "R", -price).otherwise(price), 2))
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.alias("amount_text"),
        C.money(text, signed=True).alias("amount_signed"), C.money(text).alias("amount_unsigned"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, upper(trim(t)) AS flag_text,
           CASE WHEN upper(trim(t)) IN ('Y', 'YES', 'TRUE', '1') THEN true
                WHEN upper(trim(t)) IN ('N', 'NO', 'FALSE', '0') THEN false END AS flag
    FROM (SELECT *, CASE l_linenumber WHEN 1 THEN 'Yes' WHEN 2 THEN ' n ' WHEN 3 THEN '1' WHEN 4 THEN '0'
                 WHEN 5 THEN '' WHEN 6 THEN 'maybe' END AS t FROM lineitem)""")
def parse_bool(spark, sf):
    words = F.array(*[F.lit(w) for w in ("Yes", " n ", "1", "0", "", "maybe")])
    text = F.get(words, F.col("l_linenumber") - 1)
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", C.clean_text(text).alias("flag_text"), C.bool_yn(text).alias("flag")
    )


@query("""
    SELECT o_orderkey, CASE o_orderkey % 6
        WHEN 4 THEN CAST(date_trunc('month', o_orderdate) AS DATE) WHEN 5 THEN NULL
        ELSE CAST(o_orderdate AS DATE) END AS open_date FROM orders""")
def parse_dates(spark, sf):
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 6
    text = F.when(kind == 5, "13/2020")
    for i, layout in enumerate(C.OPEN_DATE_FORMATS):
        text = text.when(kind == i, F.date_format(day, layout))
    return V.table(spark, sf, "orders").select("o_orderkey", C.date_multi(text).alias("open_date"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(date_trunc('month', o_orderdate) AS DATE) + 0
        END AS expires_month FROM orders""")
def expiry_month(spark, sf):
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 4
    # Years written with two digits mean 20xx, so they are moved there and back.
    century = F.add_months(F.to_date(day), F.when(F.year(day) < 2000, 1200).otherwise(0))
    text = (
        F.when(kind == 0, F.date_format(day, "MM/yyyy")).when(kind == 1, F.date_format(century, "MM/yy"))
        .when(kind == 2, F.concat(F.lit("1/"), F.date_format(century, "yy")))
    )
    month = C.expiry_month(text)
    back = F.when((kind == 1) & (F.year(day) < 2000), F.add_months(month, -1200)).otherwise(month)
    return V.table(spark, sf, "orders").select("o_orderkey", back.alias("expires_month"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, left(lpad(c, CAST(greatest(length(c), 4) AS INTEGER), '0'), 4) AS mcc_code,
           CASE WHEN l_linenumber = 4 THEN 5 ELSE 0 END AS code_numeric,
           CASE WHEN l_linenumber <= 3 THEN 0 WHEN l_linenumber = 4 THEN 5 ELSE -1 END AS code_text
    FROM (SELECT *, CAST(l_partkey * 7 AS VARCHAR) AS c FROM lineitem)""")
def scalar_codes(spark, sf):
    line = F.col("l_linenumber")
    error = (
        F.when(line == 2, " ").when(line == 3, "0").when(line == 4, "5").when(line >= 5, "Bad PIN")
    )
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", C.mcc_code(F.col("l_partkey") * 7).alias("mcc_code"),
        C.error_code(error).alias("code_numeric"), C.error_code(error, "text").alias("code_text"),
    )


@query("""
    SELECT o_orderkey AS order_id, o_totalprice AS pct_change, o_orderpriority AS sales_and_admin,
           o_orderstatus AS c_2nd_value, o_custkey AS unnamed_0, CAST(o_orderdate AS DATE) AS spaced_name FROM orders""",
       name="normalize_columns")
def normalized(spark, sf):
    odd = V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("OrderId"), F.col("o_totalprice").alias("% Change"),
        F.col("o_orderpriority").alias("Sales & Admin"), F.col("o_orderstatus").alias("2nd Value"),
        F.col("o_custkey").alias("_c0"), F.to_date("o_orderdate").alias(" spaced  name "),
    )
    return normalize_columns(odd)


@query("SELECT transaction_id, record_hash FROM silver_txn", name="record_hash")
def record_hashes(spark, sf):
    return V.silver_transactions(spark, sf).select("transaction_id", "record_hash")


@query("""
    SELECT o_orderkey, upper(sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR),
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END,
               CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END))) AS wh_hash,
           sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR),
               CASE WHEN o_orderkey % 3 = 0 THEN '∅' ELSE o_orderpriority END)) AS key_hash,
           CASE WHEN o_orderkey % 3 = 0 THEN concat('{"o_orderkey":', o_orderkey, '}')
                ELSE concat('{"o_orderkey":', o_orderkey, ',"priority":"', o_orderpriority, '"}') END AS natural_keys
    FROM orders""", name="warehouse_hash")
def warehouse_hashes(spark, sf):
    df = V.table(spark, sf, "orders").withColumn(
        "priority", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    )
    return df.select(
        "o_orderkey",
        H.warehouse_hash(["o_orderkey", C.to_decimal("o_totalprice"), H.bit(F.col("o_orderstatus") == "F"), "priority"]).alias("wh_hash"),
        H.key_hash(["o_orderkey", "priority"]).alias("key_hash"),
        H.natural_keys_json(["o_orderkey", "priority"]).alias("natural_keys"),
    )


# --- bronze -----------------------------------------------------------------


def _bronze(raw: DataFrame, entity: str, **formats: str) -> DataFrame:
    df = to_bronze(raw, entity, "2001-07-01", V._ts(V.LOAD_TS), F.lit("landing"))
    for column, layout in formats.items():
        df = df.withColumn(column, F.date_format(column, layout))
    return df.drop("ingestion_ts")


_LINEAGE = "'landing' AS source_file, DATE '2001-07-01' AS ingestion_date, '{0}' AS entity"


_BRONZE_TXN = """
    SELECT l_orderkey * 10 + l_linenumber AS id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date,
           l_orderkey AS client_id, l_suppkey AS card_id,
           CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount,
           CASE WHEN l_linenumber <> 7 THEN concat('CHIP ', l_returnflag) END AS use_chip, l_partkey AS merchant_id,
           concat('CITY ', l_partkey) AS merchant_city, upper(l_linestatus) AS merchant_state,
           concat(l_partkey % 1000, '.0') AS zip, CAST(l_partkey % 60000 AS INTEGER) AS mcc,
           CAST(CASE WHEN l_linenumber = 3 THEN 0 WHEN l_linenumber IN (4, 5) THEN 5 END AS INTEGER) AS errors,
           {0} FROM lineitem"""


@query(_BRONZE_TXN.format(_LINEAGE.format("TRANSACTION")))
def bronze_transactions(spark, sf):
    return _bronze(L.transactions(spark, sf), "transaction", date=STAMP)


@query(f"""
    SELECT printf('C%02d', o_custkey % 25) AS currency, 'EUR' AS base_currency, concat('Currency ', o_custkey % 25) AS currency_name,
           CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS rate_vs_usd,
           CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS date, {_LINEAGE.format('FX')} FROM orders""")
def bronze_fx(spark, sf):
    return _bronze(L.fx(spark, sf), "FX")


@query(f"""
    SELECT CAST(c_custkey + 1 AS INTEGER) AS row_number, c_custkey AS customer_id, upper(c_name) AS surname,
           CAST(CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 550 + 300 END AS INTEGER) AS credit_score,
           upper(c_mktsegment) AS geography, CASE WHEN c_custkey % 2 = 0 THEN 'FEMALE' ELSE 'MALE' END AS gender,
           CAST(c_custkey % 70 + 18 AS INTEGER) AS age, CAST(c_custkey % 10 AS INTEGER) AS tenure, c_acctbal AS balance,
           CAST(c_custkey % 4 AS INTEGER) AS num_of_products, CAST(c_custkey % 2 AS INTEGER) AS has_cr_card,
           CAST((c_custkey + 1) % 2 AS INTEGER) AS is_active_member,
           CASE WHEN c_custkey % 13 <> 0 THEN c_acctbal END AS estimated_salary,
           CAST(CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS exited, {_LINEAGE.format('CUSTOMER')} FROM customer""")
def bronze_customers(spark, sf):
    return _bronze(L.customers(spark, sf), "CUSTOMER")


@query(f"""
    SELECT concat('TK', s_suppkey) AS ticker_symbol, s_name AS security, 'reports' AS sec_filings,
           concat('Sector ', s_suppkey % 11) AS gics_sector, concat('Industry ', s_suppkey % 60) AS gics_sub_industry,
           concat('Nation ', s_nationkey) AS address_of_headquarters,
           CASE WHEN s_suppkey % 4 <> 0 THEN make_date(s_suppkey % 30 + 1980, s_suppkey % 12 + 1, 1) END AS date_first_added,
           lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, {_LINEAGE.format('SECURITIES')} FROM supplier""")
def bronze_securities(spark, sf):
    return _bronze(L.securities(spark, sf), "SECURITIES")


_FUNDAMENTALS = ", ".join(
    f"CASE WHEN (o_orderkey + {i}) % 17 <> 0 THEN CAST(o_orderkey * {i + 1} % 100003 AS DOUBLE) END AS {n}"
    for i, n in enumerate(FUNDAMENTAL_MEASURES)
)


@query(f"""
    SELECT o_orderkey AS unnamed_0, printf('T%03d', o_custkey % 500) AS ticker_symbol, CAST(o_orderdate AS DATE) AS period_ending,
           {_FUNDAMENTALS}, {_LINEAGE.format('FUNDAMENTALS')} FROM orders""")
def bronze_fundamentals(spark, sf):
    return _bronze(L.fundamentals(spark, sf), "FUNDAMENTALS")


_PRICES = """
    SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date, printf('S%03d', l_partkey % 500) AS symbol,
           l_extendedprice AS open, CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS close,
           l_discount AS low, l_tax AS high, l_quantity AS volume, {0} FROM lineitem"""


@query(_PRICES.format(_LINEAGE.format("PRICES")))
def bronze_prices(spark, sf):
    return _bronze(L.prices(spark, sf), "PRICES", date=STAMP)


@query(_PRICES.format(_LINEAGE.format("PRICES_SPLIT_ADJUSTED")))
def bronze_prices_split_adjusted(spark, sf):
    return _bronze(L.prices(spark, sf), "PRICES_SPLIT_ADJUSTED", date=STAMP)


_OHLCV = """
    SELECT printf('S%03d', l_partkey % 500) AS ticker, CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS date,
           l_extendedprice AS open, l_tax AS high, l_discount AS low,
           CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS close,
           CAST(l_quantity AS BIGINT) AS volume, CAST(0 AS BIGINT) AS open_int, {0} FROM lineitem"""


@query(_OHLCV.format(_LINEAGE.format("STOCK")))
def bronze_stock(spark, sf):
    return _bronze(L.ohlcv(spark, sf), "STOCK")


@query(_OHLCV.format(_LINEAGE.format("ETF")))
def bronze_etf(spark, sf):
    return _bronze(L.ohlcv(spark, sf), "ETF")


@query(f"""
    SELECT s_suppkey AS id, CASE WHEN s_suppkey % 10 <> 3 THEN s_suppkey END AS client_id, 'VISA' AS card_brand,
           CASE WHEN s_suppkey % 2 = 0 THEN 'DEBIT' ELSE 'CREDIT (PREPAID)' END AS card_type,
           concat('4', lpad(CAST(s_suppkey AS VARCHAR), 15, '0')) AS card_number,
           concat(lpad(CAST(s_suppkey % 12 + 1 AS VARCHAR), 2, '0'), '/2022') AS expires,
           lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') AS cvv, CASE WHEN s_suppkey % 3 <> 0 THEN 'YES' ELSE 'NO' END AS has_chip,
           CAST(s_suppkey % 3 + 1 AS INTEGER) AS num_cards_issued,
           CASE WHEN s_suppkey % 8 <> 0 THEN abs(s_acctbal) END AS credit_limit,
           concat(lpad(CAST(s_suppkey % 12 + 1 AS VARCHAR), 2, '0'), '/2002') AS acct_open_date,
           CAST(s_suppkey % 20 + 2000 AS INTEGER) AS year_pin_last_changed, 'NO' AS card_on_dark_web,
           {_LINEAGE.format('CARD')} FROM supplier""")
def bronze_cards(spark, sf):
    return _bronze(L.cards(spark, sf), "CARD")


@query(f"""
    SELECT c_custkey AS id, CAST(c_custkey % 70 + 18 AS INTEGER) AS current_age, CAST(c_custkey % 10 + 60 AS INTEGER) AS retirement_age,
           CAST(c_custkey % 60 + 1940 AS INTEGER) AS birth_year, CAST(c_custkey % 12 + 1 AS INTEGER) AS birth_month,
           CASE WHEN c_custkey % 2 = 0 THEN 'FEMALE' ELSE 'MALE' END AS gender, trim(c_name) AS address,
           CAST(c_custkey % 90 AS DOUBLE) AS latitude, -(c_custkey % 180 + 0.25::DOUBLE) AS longitude,
           CASE WHEN c_custkey % 10 <> 0 THEN abs(c_acctbal) END AS per_capita_income,
           CAST(format('{{:.2f}}', abs(c_acctbal * 10)) AS DOUBLE) AS yearly_income, abs(c_acctbal) AS total_debt,
           CAST(c_custkey % 550 + 300 AS INTEGER) AS credit_score, CAST(c_custkey % 5 + 1 AS INTEGER) AS num_credit_cards,
           {_LINEAGE.format('USER')} FROM customer""")
def bronze_users(spark, sf):
    return _bronze(L.users(spark, sf), "USER")


@query(f"""
    SELECT DISTINCT p_size AS mcc, concat('size ', p_size) AS mcc_description, {_LINEAGE.format('MCC')} FROM part""")
def bronze_mcc(spark, sf):
    pairs = pairs_from_object(L.mcc_object(spark, sf), "value", "mcc", "mcc_description")
    return _bronze(pairs, "MCC")


@query("""
    SELECT c_custkey, c_name, c_mktsegment, 'landing' AS source_file, DATE '2001-07-01' AS ingestion_date, 'PARTNER' AS entity
    FROM customer""")
def bronze_unknown_entity(spark, sf):
    return _bronze(V.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "partner")


# --- silver -----------------------------------------------------------------

_TXN = """transaction_id, strftime(txn_ts, '%Y-%m-%d %H:%M:%S') AS txn_ts, txn_date, txn_month, client_id, card_id,
    merchant_id, mcc_code, amount, use_chip, merchant_city, merchant_state, zip, error_code, is_success, record_hash"""


@query(f"SELECT {_TXN} FROM silver_txn")
def silver_transactions(spark, sf):
    return business(V.silver_transactions(spark, sf)).withColumn("txn_ts", F.date_format("txn_ts", STAMP))


@query("SELECT * FROM users")
def silver_users(spark, sf):
    return business(V.silver_users(spark, sf))


@query("SELECT * FROM silver_card")
def silver_cards(spark, sf):
    return business(V.silver_cards(spark, sf))


@query("SELECT * FROM mcc")
def silver_mcc(spark, sf):
    return business(V.silver_mcc(spark, sf))


@query("SELECT * EXCLUDE (quoted) FROM fx")
def silver_fx(spark, sf):
    return business(V.silver_fx(spark, sf))


@query("""
    SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def dedup_latest_transactions(spark, sf):
    lines = V.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
    )
    latest = dedup_latest(lines, ["id"], "l_shipdate", ["l_partkey", "l_suppkey", "l_extendedprice"])
    return latest.select("id", "l_partkey", "l_suppkey", "l_extendedprice", F.to_date("l_shipdate").alias("ship_date"))


@query("""
    SELECT id AS transaction_id, CAST(date AS DATE) AS txn_date, merchant_id, card_id, CAST(amount AS DECIMAL(18,2)) AS amount
    FROM txn_raw WHERE CAST(date AS DATE) = DATE '1998-03-01'
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY date DESC, merchant_id DESC, card_id DESC, abs(amount) DESC) = 1""")
def silver_transactions_as_of(spark, sf):
    day = filter_as_of(V.bronze_transactions(spark, sf), "TRANSACTION", "1998-03-01")
    df = silver.silver_transactions(day, tie_break=V.TXN_TIES)
    return df.select("transaction_id", "txn_date", "merchant_id", "card_id", "amount")


# --- quality ----------------------------------------------------------------


@query("""
    SELECT count(*) FILTER (WHERE use_chip IS NULL) AS use_chip, count(*) FILTER (WHERE errors IS NULL) AS errors,
           count(*) FILTER (WHERE amount IS NULL) AS amount FROM txn_raw""", name="null_counts")
def null_count(spark, sf):
    return quality.null_counts(V.bronze_transactions(spark, sf), ["use_chip", "errors", "amount"])


@query("SELECT id, count(*) AS row_count FROM txn_raw GROUP BY id HAVING count(*) > 1", name="duplicate_keys")
def duplicate_key(spark, sf):
    return quality.duplicate_keys(V.bronze_transactions(spark, sf), ["id"])


@query("""
    SELECT v.name AS check, v.n AS issue_count, CASE WHEN v.n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT greatest(count(DISTINCT txn_month) - 80, 0) AS over FROM silver_txn) c,
         LATERAL (VALUES ('txn_month_partition_not_null', CAST(0 AS BIGINT)), ('partition_count_in_limit', CAST(c.over AS BIGINT))) v(name, n)""")
def partition_check(spark, sf):
    return quality.run_checks(V.silver_transactions(spark, sf), quality.partition_ok(["txn_month"], max_distinct=80))


@query("""
    SELECT v.name AS check, v.n AS issue_count, CASE WHEN v.n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT count(*) FILTER (WHERE transaction_id IS NULL) AS a, count(*) FILTER (WHERE txn_ts IS NULL) AS b,
                 count(*) FILTER (WHERE txn_month IS NULL) AS m, count(*) FILTER (WHERE amount IS NULL) AS d,
                 count(*) FILTER (WHERE mcc_code IS NULL) AS e,
                 count(*) FILTER (WHERE client_id IS NULL OR card_id IS NULL OR merchant_id IS NULL) AS f,
                 count(*) FILTER (WHERE error_code IS NULL) AS g, greatest(count(DISTINCT txn_month) - 300, 0) AS h FROM silver_txn) c,
         LATERAL (VALUES ('transaction_id_not_null', a), ('txn_ts_not_null', b), ('txn_month_not_null', m), ('amount_not_null', d),
                 ('mcc_code_not_null', e), ('required_business_keys_not_null', f), ('error_code_not_null', g),
                 ('txn_month_partition_not_null', m), ('partition_count_in_limit', h)) v(name, n)""")
def silver_transaction_checks(spark, sf):
    return quality.run_checks(V.silver_transactions(spark, sf), silver.transaction_checks())


@query("""
    SELECT v.name AS check, v.n AS issue_count, CASE WHEN v.n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT count(*) FILTER (WHERE card_id IS NULL) AS a, count(*) FILTER (WHERE client_id IS NULL) AS b FROM silver_card) c,
         LATERAL (VALUES ('card_id_not_null', a), ('client_id_not_null', b)) v(name, n)""")
def silver_card_checks(spark, sf):
    return quality.run_checks(V.silver_cards(spark, sf), silver.card_checks())


@query("""
    SELECT v.name AS check, v.n AS issue_count, CASE WHEN v.n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT count(*) FILTER (WHERE base_currency IS DISTINCT FROM 'EUR') AS a,
                 count(*) FILTER (WHERE base_currency IS NULL OR currency IS NULL OR fx_date IS NULL) AS b,
                 count(*) FILTER (WHERE fx_month IS NULL) AS m, greatest(count(DISTINCT fx_month) - 300, 0) AS h FROM fx_plain) c,
         LATERAL (VALUES ('base_currency_is_EUR', a), ('natural_keys_not_null', b), ('fx_month_partition_not_null', m),
                 ('partition_count_in_limit', h)) v(name, n)""")
def silver_fx_checks(spark, sf):
    return quality.run_checks(V.silver_fx(spark, sf), silver.fx_checks())


@query("""
    SELECT 'client_id_not_null' AS check, count(*) FILTER (WHERE client_id IS NULL) AS issue_count, 'PASS' AS status FROM users""")
def silver_user_checks(spark, sf):
    return quality.run_checks(V.silver_users(spark, sf), silver.user_checks())


@query("""
    SELECT 'mcc_code_not_null' AS check, count(*) FILTER (WHERE mcc_code IS NULL) AS issue_count, 'PASS' AS status FROM mcc
    UNION ALL SELECT 'mcc_code_is_4_digits', count(*) FILTER (WHERE NOT regexp_full_match(mcc_code, '[0-9]{4}')), 'PASS' FROM mcc""")
def silver_mcc_checks(spark, sf):
    return quality.run_checks(V.silver_mcc(spark, sf), silver.mcc_checks())


@query("""
    SELECT v.name AS check, CAST(v.n AS BIGINT) AS issue_count, CASE WHEN v.n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT count(*) FILTER (WHERE client_id IS NULL) AS a, count(*) - count(DISTINCT client_id) AS b FROM users) c,
         LATERAL (VALUES ('client_id_not_null', a), ('source_file_not_null', 0), ('ingestion_date_not_null', 0),
                 ('ingestion_ts_not_null', 0), ('record_hash_not_null', 0), ('gold_run_id_not_null', 0),
                 ('gold_load_ts_not_null', 0), ('client_id_unique', b)) v(name, n)""")
def contract_check(spark, sf):
    return quality.check_contract(V.gold_users(spark, sf), K.GOLD_DIM_USER)


_DRIFT = {
    "id": ("count(*)", "0"), "date": ("count(*)", "0"), "client_id": ("count(*)", "0"), "card_id": ("count(*)", "0"),
    "amount": ("count(*)", "count(*) FILTER (WHERE l_linenumber = 7)"),
    "use_chip": ("count(*) FILTER (WHERE l_linenumber <> 7)", "0"), "merchant_id": ("count(*)", "0"),
    "merchant_city": ("count(*)", "0"), "merchant_state": ("count(*)", "0"), "zip": ("count(*)", "0"), "mcc": ("count(*)", "0"),
    "errors": ("count(*) FILTER (WHERE l_linenumber > 2)", "count(*) FILTER (WHERE l_linenumber > 5)"),
}


@query("\nUNION ALL\n".join(
    f"SELECT '{n}' AS column_name, {p} AS present_count, CAST({d} AS BIGINT) AS drift_count FROM lineitem"
    for n, (p, d) in _DRIFT.items()
))
def value_drift(spark, sf):
    return compliance.value_drift(L.transactions(spark, sf), ENTITIES["TRANSACTION"].spec)


# What a stale registry declares for the transaction table.
_DECLARED = [
    ("id", "INT"), ("date", "TIMESTAMP"), ("client_id", "INT"), ("card_id", "INT"), ("amount", "STRING"),
    ("use_chip", "STRING"), ("merchant_id", "INT"), ("merchant_city", "STRING"), ("merchant_state", "STRING"),
    ("zip", "DOUBLE"), ("mcc", "INT"), ("errors", "STRING"),
]
_ACTUAL = {"id": "BIGINT", "date": "TIMESTAMP", "client_id": "BIGINT", "card_id": "BIGINT", "amount": "DOUBLE",
           "merchant_id": "BIGINT", "mcc": "INT", "errors": "INT"}


@query("\nUNION ALL\n".join(
    f"SELECT '{n}' AS column_name, '{k}' AS expected_type, '{_ACTUAL.get(n, 'STRING')}' AS actual_type, "
    f"'{'OK' if _ACTUAL.get(n, 'STRING') == k else 'TYPE'}' AS verdict, {_DRIFT[n][0]} AS present_count, "
    f"CAST({_DRIFT[n][1]} AS BIGINT) AS drift_count FROM lineitem" for n, k in _DECLARED
))
def schema_compliance(spark, sf):
    """Declared against live types per column, beside what the values show."""
    live = to_bronze(L.transactions(spark, sf), "TRANSACTION", "2001-07-01", now(), F.lit("landing"))
    fields = [(f.name, f.dataType.simpleString()) for f in live.schema.fields if f.name in _DRIFT]
    declared = compliance.schema_rows(spark, {"bronze_transactions_raw": _DECLARED})
    differences = compliance.column_differences(
        declared, compliance.schema_rows(spark, {"bronze_transactions_raw": fields})
    ).withColumnRenamed("name", "column_name").drop("table_name")
    return differences.join(value_drift(spark, sf), "column_name")


# --- gold -------------------------------------------------------------------


@query("""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date_value, CAST(day(d) AS INTEGER) AS day_of_month,
           CAST(isodow(d) AS INTEGER) AS day_of_week_iso, dayname(d) AS day_name, CAST(week(d) AS INTEGER) AS week_of_year,
           CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_number,
           CAST(year(d) AS INTEGER) AS year_number, isodow(d) >= 6 AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)""")
def gold_dim_date(spark, sf):
    days = spine_over(V.table(spark, sf, "lineitem"), F.to_date("l_shipdate"))
    return business(gold.calendar(days, V.RUN_ID, now()))


@query("""
    SELECT min(d) AS min_date, max(d) AS max_date, date_diff('day', min(d), max(d)) + 1 AS row_count,
           CAST(1 AS INTEGER) AS min_iso_dow, CAST(7 AS INTEGER) AS max_iso_dow
    FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)""")
def date_summary(spark, sf):
    days = spine_over(V.table(spark, sf, "lineitem"), F.to_date("l_shipdate"))
    return gold.date_summary(gold.calendar(days, V.RUN_ID, now()))


@query("SELECT * FROM users")
def gold_dim_user(spark, sf):
    return business(V.gold_users(spark, sf))


@query("SELECT * FROM mcc")
def gold_dim_mcc(spark, sf):
    return business(V.gold_mcc(spark, sf))


@query("SELECT * FROM cards")
def gold_dim_card(spark, sf):
    return business(V.gold_cards(spark, sf)[0])


@query("""
    SELECT 'ORPHAN_DIM_USER' AS anom_type, 'HIGH' AS severity, 'GOLD.CARD.CONF.001' AS rule_id,
           sha256(concat_ws('||', card_id, client_id)) AS key_hash,
           concat('{"card_id":', card_id, ',"client_id":', client_id, '}') AS natural_keys
    FROM silver_card WHERE client_id IS NOT NULL AND client_id NOT IN (SELECT client_id FROM known_users)""")
def card_anomaly_events(spark, sf):
    return V.gold_cards(spark, sf)[1].select("anom_type", "severity", "rule_id", "key_hash", "natural_keys")


@query(f"SELECT {_TXN}, is_chip_used FROM fact")
def gold_fact_transactions(spark, sf):
    return business(V.gold_fact(spark, sf)[0]).withColumn("txn_ts", F.date_format("txn_ts", STAMP))


_EVENT = ["anom_domain", "anom_type", "severity", "rule_id", "key_hash", "natural_keys", "detail"]


@query(f"SELECT {', '.join(_EVENT)} FROM events_out")
def anomaly_events(spark, sf):
    return V.gold_fact(spark, sf)[1].select(*_EVENT)


@query("""
    SELECT anom_domain, anom_type, severity, rule_id, count(*) AS row_count,
           CAST(to_json(list_sort(list(natural_keys) FILTER (WHERE rn <= 10))) AS VARCHAR) AS sample_keys
    FROM (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY natural_keys) AS rn FROM events_out)
    GROUP BY anom_domain, anom_type, severity, rule_id""", name="anomaly_kpis")
def anomaly_kpi(spark, sf):
    kpis = anomaly_kpis(V.gold_fact(spark, sf)[1], V.RUN_ID, "fact_transactions", now=now())
    return kpis.select("anom_domain", "anom_type", "severity", "rule_id", "row_count", "sample_keys")


@query("""
    SELECT 'GOLD.TXN.CONF.001' AS rule_id, count(*) AS issue_count FROM silver_txn WHERE client_id NOT IN (SELECT client_id FROM known_users)
    UNION ALL SELECT 'GOLD.TXN.CONF.002', count(*) FROM silver_txn WHERE card_id NOT IN (SELECT card_id FROM cards)
    UNION ALL SELECT 'GOLD.TXN.CONF.003', count(*) FROM silver_txn WHERE mcc_code NOT IN (SELECT mcc_code FROM known_mcc)
    UNION ALL SELECT 'GOLD.TXN.CONF.004', count(*) FROM silver_txn WHERE txn_date NOT IN (SELECT date_value FROM days)""")
def foreign_key_report(spark, sf):
    rules = gold.fact_rules(
        *V.fact_dims(spark, sf), V.gold_dates(spark)
    )
    return orphan_report(V.silver_transactions(spark, sf), rules).select("rule_id", "issue_count")


@query(f"SELECT {_TXN}, is_chip_used FROM fact")
def gold_fact_by_orphan_sets(spark, sf):
    """The fact by way of stored orphan keys, as the load builds it."""
    silver_rows = V.silver_transactions(spark, sf)
    rules = gold.fact_rules(*V.fact_dims(spark, sf), V.gold_dates(spark))
    # Keys of rows that silver drops mark no row that it keeps, so they are taken ahead of the ranking.
    keys = V.bronze_transactions(spark, sf).select(*[F.col(k).cast(silver_rows.schema[k].dataType) for k in ("client_id", "card_id")])
    sets = gold.staged_orphan_keys(keys, rules, uuid.uuid4().hex)
    good = conforming(tag_orphans(gold.deduped_fact(silver_rows, unique_input=True), rules, orphan_sets=sets))
    return business(good).withColumn("txn_ts", F.date_format("txn_ts", STAMP))


@query("SELECT count(*) AS anom_count FROM tagged WHERE failed IS NOT NULL", name="anomaly_count")
def anomaly_counts(spark, sf):
    return anomaly_count(V.gold_fact(spark, sf)[1], V.RUN_ID, "fact_transactions")


@query("""
    (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date_value FROM lineitem ORDER BY 1 LIMIT 1)
    UNION ALL (SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem ORDER BY 1 DESC LIMIT 1)""")
def calendar_edges(spark, sf):
    days = gold.calendar(spine_over(V.table(spark, sf, "lineitem"), F.to_date("l_shipdate")), V.RUN_ID, now())
    return gold.edge_days(days, 1).unionByName(gold.edge_days(days, 1, last=True)).select("date_value")


# --- warehouse --------------------------------------------------------------


@query("SELECT * FROM wh_card")
def wh_dim_card(spark, sf):
    return warehouse.wh_dim(V.gold_cards(spark, sf)[0], "dim_card")


@query("SELECT * FROM wh_user")
def wh_dim_user(spark, sf):
    return warehouse.wh_dim(V.gold_users(spark, sf), "dim_user")


@query("SELECT * FROM wh_mcc")
def wh_dim_mcc(spark, sf):
    return warehouse.wh_dim(V.gold_mcc(spark, sf), "dim_mcc")


_DATE_RANGE = """(SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)"""


@query(f"""
    SELECT {bucketed_number('date_id')} AS date_key, *,
           upper(sha256(concat_ws('|', CAST(date_id AS VARCHAR), CAST(full_date AS VARCHAR), CAST(year AS VARCHAR),
               CAST(quarter AS VARCHAR), CAST(month AS VARCHAR), CAST(week AS VARCHAR), CAST(day_of_week AS VARCHAR),
               CASE WHEN is_weekend THEN '1' ELSE '0' END))) AS record_hash
    FROM (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year,
                 CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(week(d) AS INTEGER) AS week,
                 CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) >= 6 AS is_weekend, isodow(d) < 6 AS is_business_day
          FROM {_DATE_RANGE})""")
def wh_dim_date(spark, sf):
    days = spine_over(V.table(spark, sf, "lineitem"), F.to_date("l_shipdate"))
    return warehouse.wh_dim(gold.calendar(days, V.RUN_ID, now()), "dim_date")


@query(f"""
    SELECT CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
           CAST(year(d) * 100 + month(d) AS INTEGER) AS yyyymm, strftime(d, '%Y-%m') AS month_label
    FROM (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS d FROM {_DATE_RANGE})""")
def dim_month(spark, sf):
    days = spine_over(V.table(spark, sf, "lineitem"), F.to_date("l_shipdate"))
    return warehouse.dim_month(gold.calendar(days, V.RUN_ID, now()))


@query(f"""
    SELECT card_id, CASE WHEN CAST(card_id AS BIGINT) % 2 = 0 THEN old_key ELSE base + new_rank END AS card_key
    FROM (SELECT card_id, o.card_key AS old_key, (SELECT count(*) FROM wh_card WHERE CAST(card_id AS BIGINT) % 2 = 0) AS base,
                 n.card_key AS new_rank FROM wh_card a
          LEFT JOIN (SELECT card_id, {bucketed_number('card_id')} AS card_key FROM wh_card WHERE CAST(card_id AS BIGINT) % 2 = 0) o USING (card_id)
          LEFT JOIN (SELECT card_id, {bucketed_number('card_id')} AS card_key FROM wh_card WHERE CAST(card_id AS BIGINT) % 2 = 1) n USING (card_id))""")
def surrogate_keys_card(spark, sf):
    """Even cards are known already and keep their keys; odd ones follow."""
    cards = V.stored_gold(spark, sf, "cards")
    first = warehouse.wh_dim(cards.where(F.col("card_id") % 2 == 0), "dim_card")
    return warehouse.wh_dim(cards, "dim_card", first).select("card_id", "card_key")


def _old_users(users: DataFrame) -> DataFrame:
    """The earlier half of the users, some of them since changed."""
    stale = F.col("client_id") % 10 == 0
    return users.where(F.col("client_id") % 2 == 0).withColumns(
        {
            "credit_score": F.when(stale, F.col("credit_score") - 1).otherwise(F.col("credit_score")),
            "record_hash": F.when(stale, F.lit("old")).otherwise(F.col("record_hash")),
        }
    )


@query(f"""
    SELECT CASE WHEN c % 2 = 0 THEN o.user_key ELSE (SELECT count(*) FROM users WHERE client_id % 2 = 0) + n.user_key END AS user_key,
           a.client_id, current_age, yearly_income, total_debt, credit_score, address, record_hash,
           CASE WHEN c % 2 = 1 THEN 'inserted' WHEN c % 10 = 0 THEN 'updated' ELSE 'unchanged' END AS action
    FROM (SELECT * REPLACE (CAST(client_id AS VARCHAR) AS client_id), client_id AS c FROM users) a
    LEFT JOIN (SELECT CAST(client_id AS VARCHAR) AS client_id, {bucketed_number('client_id')} AS user_key FROM users WHERE client_id % 2 = 0) o USING (client_id)
    LEFT JOIN (SELECT CAST(client_id AS VARCHAR) AS client_id, {bucketed_number('client_id')} AS user_key FROM users WHERE client_id % 2 = 1) n USING (client_id)""")
def upsert_dim_user(spark, sf):
    users = V.stored_gold(spark, sf, "users")
    target = warehouse.wh_dim(_old_users(users), "dim_user")
    return warehouse.dim_rows(users, "dim_user", target).withColumnRenamed(U.ACTION, "action")


def _old_fact(fact: DataFrame) -> DataFrame:
    """Even transactions loaded before, every tenth with another amount."""
    key = F.col("transaction_id").cast("bigint")
    wrong = key % 10 == 0
    return fact.where(key % 2 == 0).withColumns(
        {
            "amount": F.when(wrong, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)"),
            "record_hash": F.when(wrong, F.lit("old")).otherwise(F.col("record_hash")),
        }
    )


_ACTION = """CASE WHEN CAST(transaction_id AS BIGINT) % 2 = 1 THEN 'inserted'
    WHEN CAST(transaction_id AS BIGINT) % 10 = 0 THEN 'updated' ELSE 'unchanged' END"""


@query(f"SELECT *, {_ACTION} AS action FROM wh_fact_known")
def upsert_fact_month(spark, sf):
    fact = V._stored(spark, sf, "wh_fact", lambda: V.warehouse_fact(spark, sf)).drop("gold_load_ts")
    rows = U.merge_rows(_old_fact(fact), fact, ["transaction_id", "txn_month"], "record_hash")
    return rows.withColumnRenamed(U.ACTION, "action")


@query(f"""
    SELECT count(*) FILTER (WHERE action = 'inserted') AS rows_inserted, count(*) FILTER (WHERE action = 'updated') AS rows_updated,
           count(*) FILTER (WHERE action = 'unchanged') AS rows_unchanged, CAST(0 AS BIGINT) AS rows_deleted
    FROM (SELECT {_ACTION} AS action FROM silver_txn)""")
def upsert_counts(spark, sf):
    df = V.silver_transactions(spark, sf).select(
        F.col("transaction_id").cast("string").alias("transaction_id"), "amount", "record_hash"
    )
    return U.upsert(_old_fact(df), df, ["transaction_id"], "record_hash")[1]


@query(f"""
    SELECT CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
           CAST(year(d) * 100 + month(d) AS INTEGER) AS yyyymm, strftime(d, '%Y-%m') AS month_label,
           CASE WHEN month(d) > 6 THEN 'inserted' WHEN month(d) = 3 THEN 'updated' ELSE 'unchanged' END AS action
    FROM (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS d FROM {_DATE_RANGE})""")
def upsert_dim_month(spark, sf):
    """Months of the second half-year are new; March had another label."""
    days = gold.calendar(spine_over(V.table(spark, sf, "lineitem"), F.to_date("l_shipdate")), V.RUN_ID, now())
    old = warehouse.dim_month(days).where("month <= 6").withColumn(
        "month_label", F.when(F.col("month") == 3, "old").otherwise(F.col("month_label"))
    )
    return warehouse.month_rows(days, old).withColumnRenamed(U.ACTION, "action")


_AGG_HASH = """upper(sha256(concat_ws('|', CAST(txn_count_total AS VARCHAR), CAST(txn_count_success AS VARCHAR),
    CAST(txn_count_failed AS VARCHAR), CAST(txn_count_unknown AS VARCHAR), CAST(amount_sum_total AS VARCHAR),
    CAST(amount_sum_success AS VARCHAR), CAST(amount_sum_failed AS VARCHAR), CAST(amount_sum_unknown AS VARCHAR),
    CAST(amount_abs_sum_total AS VARCHAR), coalesce(CAST(amount_avg_success AS VARCHAR), ''),
    coalesce(CAST(amount_min AS VARCHAR), ''), coalesce(CAST(amount_max AS VARCHAR), ''),
    CAST(txn_count_chip_used AS VARCHAR), CAST(amount_sum_chip_used AS VARCHAR)))) AS aggregate_hash"""


def _dated(aggregate: DataFrame) -> DataFrame:
    return aggregate.withColumn("gold_load_ts_max", F.to_date("gold_load_ts_max")).drop("run_id_last")


@query("SELECT * FROM wh_fact_known")
def wh_fact_transactions(spark, sf):
    return V.warehouse_fact(spark, sf).drop("gold_load_ts")


@query(f"SELECT *, {_AGG_HASH} FROM daily")
def fact_daily(spark, sf):
    return _dated(warehouse.fact_daily(V.stored_fact(spark, sf)))


@query(f"SELECT *, {_AGG_HASH} FROM monthly")
def fact_monthly(spark, sf):
    return _dated(warehouse.fact_monthly(V.stored_fact(spark, sf)))


@query(f"""
    SELECT *, {_AGG_HASH} FROM (SELECT txn_month, mcc_code, {AGGREGATE} FROM
        (SELECT * REPLACE (CASE WHEN transaction_id % 10 <> 6 THEN is_success END AS is_success) FROM fact)
        GROUP BY txn_month, mcc_code)""")
def fact_by_month_mcc(spark, sf):
    """The same measures over coarser groups, where averages and sums mix."""
    fact = V.gold_fact(spark, sf)[0]
    fact = fact.withColumn("is_success", F.when(F.col("transaction_id") % 10 != 6, F.col("is_success")))
    return _dated(warehouse.aggregate_fact(fact, ["txn_month", "mcc_code"]))


@query("""
    SELECT count(*) FILTER (WHERE year(txn_month) >= 2000) AS rows_inserted,
           count(*) FILTER (WHERE year(txn_month) < 2000 AND mcc_key % 5 = 0) AS rows_updated,
           count(*) FILTER (WHERE year(txn_month) < 2000 AND mcc_key % 5 <> 0) AS rows_unchanged, CAST(0 AS BIGINT) AS rows_deleted
    FROM monthly""")
def upsert_monthly_counts(spark, sf):
    """Monthly aggregates merged into those of an earlier state of the fact."""
    fresh = warehouse.fact_monthly(V.stored_fact(spark, sf), "run-2")
    stale = F.when(F.col("mcc_key") % 5 == 0, "old").otherwise(F.col("aggregate_hash"))
    old = fresh.where(F.year("txn_month") < 2000).withColumns({"aggregate_hash": stale, "run_id_last": F.lit("run-1")})
    return U.upsert(old, fresh, warehouse.MONTHLY_KEYS, "aggregate_hash")[1]


@query("SELECT txn_month, count(*) AS group_count FROM monthly GROUP BY txn_month")
def group_counts(spark, sf):
    return warehouse.group_counts(warehouse.fact_monthly(V.stored_fact(spark, sf)))


# --- controls ---------------------------------------------------------------


def _run() -> controls.Run:
    return controls.Run("run-1", now())


_RESULT = ["check_code", "txn_month", "status", "issue_count"]
_STATUS = "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS BIGINT) AS issue_count"


@query(f"""
    SELECT 'duplicates_transaction_id' AS check_code, txn_month, {_STATUS} FROM (
        SELECT txn_month, count(*) FILTER (WHERE c > 1) AS n FROM (
            SELECT CAST(date_trunc('month', date) AS DATE) AS txn_month, id, count(*) AS c FROM txn_raw GROUP BY ALL)
        GROUP BY txn_month)""")
def ctl_duplicates(spark, sf):
    raw = V.bronze_transactions(spark, sf).select(
        F.col("id").alias("transaction_id"), C.month_start(F.to_date("date")).alias("txn_month")
    )
    return controls.ctl_duplicates(raw, _run()).select(*_RESULT)


@query(f"""
    SELECT 'empty_record_hash' AS check_code, txn_month, {_STATUS} FROM (
        SELECT txn_month, count(*) FILTER (WHERE transaction_id % 10 = 0 OR transaction_id % 7 = 0) AS n FROM silver_txn GROUP BY txn_month)""")
def ctl_empty_hash(spark, sf):
    key = F.col("transaction_id")
    blanked = F.when(key % 10 == 0, None).when(key % 7 == 0, "  ").otherwise(F.col("record_hash"))
    fact = V.silver_transactions(spark, sf).withColumn("record_hash", blanked)
    return controls.ctl_empty_hash(fact, _run()).select(*_RESULT)


@query(f"""
    SELECT check_code, txn_month, {_STATUS} FROM (
        SELECT 'orphans_card_key' AS check_code, txn_month, count(*) FILTER (WHERE card_key NOT IN (SELECT card_key FROM wh_card WHERE NOT card_on_dark_web)) AS n FROM wh_fact_known GROUP BY txn_month
        UNION ALL SELECT 'orphans_date_key', txn_month, count(*) FILTER (WHERE date_key NOT IN (SELECT date_key FROM wh_date WHERE NOT is_weekend)) FROM wh_fact_known GROUP BY txn_month
        UNION ALL SELECT 'orphans_mcc_key', txn_month, count(*) FILTER (WHERE mcc_key NOT IN (SELECT mcc_key FROM wh_mcc WHERE mcc_code % 2 = 0)) FROM wh_fact_known GROUP BY txn_month
        UNION ALL SELECT 'orphans_user_key', txn_month, count(*) FILTER (WHERE user_key NOT IN (SELECT user_key FROM wh_user WHERE current_age < 80)) FROM wh_fact_known GROUP BY txn_month)""")
def ctl_orphans(spark, sf):
    """Orphans against dimensions that have lost some members."""
    dims = V.stored_dims(spark, sf)
    less = {
        "dim_card": dims["dim_card"].where(~F.col("card_on_dark_web")),
        "dim_date": dims["dim_date"].where(~F.col("is_weekend")),
        "dim_mcc": dims["dim_mcc"].where(F.col("mcc_code") % 2 == 0),
        "dim_user": dims["dim_user"].where(F.col("current_age") < 80),
    }
    return controls.ctl_orphans(V.stored_fact(spark, sf), less, _run()).select(*_RESULT)


def _recon(spark, sf, metric):
    """Gold against a warehouse copy: equal, off in one month, absent in another."""
    key, month = F.col("transaction_id"), F.col("txn_month")
    source = V.stored_amounts(spark, sf)
    copy = source.where(~((F.year(month) == 1999) & (F.month(month) == 5)) & ~((F.month(month) == 2) & (key % 50 == 1)))
    return controls.recon(source, copy, now(), (metric,)).drop("check_ts", "tolerance_abs", "details")


def _recon_sql(metric: str, value: str) -> str:
    return f"""
    SELECT txn_month, 'recon_{metric}_gold_vs_dwh' AS metric_name, CAST(g AS DECIMAL(38,6)) AS gold_value, CAST(w AS DECIMAL(38,6)) AS wh_value,
           CAST(g - w AS DECIMAL(38,6)) AS delta_value, CASE WHEN g = w THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT txn_month, {value.format('true')} AS g,
                 coalesce({value.format("NOT (year(txn_month) = 1999 AND month(txn_month) = 5) AND NOT (month(txn_month) = 2 AND transaction_id % 50 = 1)")}, 0) AS w
          FROM fact GROUP BY txn_month)"""


@query(_recon_sql("counts", "count(*) FILTER (WHERE {0})"))
def recon_counts(spark, sf):
    return _recon(spark, sf, "counts")


@query(_recon_sql("amounts", "sum(amount) FILTER (WHERE {0})"))
def recon_amounts(spark, sf):
    return _recon(spark, sf, "amounts")


_GATE_MONTHS = "(SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS txn_month FROM txn_raw)"


def _gates(spark, sf):
    months = V.bronze_transactions(spark, sf).select(C.month_start(F.to_date("date")).alias("txn_month"))
    monthly = warehouse.fact_monthly(V.stored_fact(spark, sf))
    run = controls.Run("run-1", V._ts("2001-06-15 00:00:00"))
    return controls.gate_present(monthly, run, months), controls.gate_fresh(monthly, run, 24 * 365, months)


@query(f"""
    SELECT 'pub_agg_monthly_present' AS check_code, txn_month, CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END AS status,
           CAST(CASE WHEN n > 0 THEN 0 ELSE 1 END AS BIGINT) AS issue_count, concat('Rows in fact_transactions_monthly = ', n) AS message
    FROM (SELECT w.txn_month, count(m.txn_month) AS n FROM {_GATE_MONTHS} w LEFT JOIN monthly m USING (txn_month) GROUP BY w.txn_month)""")
def gate_present(spark, sf):
    return _gates(spark, sf)[0].select(*_RESULT, "message")


_FRESH = "coalesce(max(gold_load_ts_max) >= DATE '2000-06-15', false)"


@query(f"""
    SELECT 'pub_agg_freshness' AS check_code, w.txn_month, CASE WHEN {_FRESH} THEN 'PASS' ELSE 'FAIL' END AS status,
           CAST(CASE WHEN {_FRESH} THEN 0 ELSE 1 END AS BIGINT) AS issue_count
    FROM {_GATE_MONTHS} w LEFT JOIN monthly m USING (txn_month) GROUP BY w.txn_month""")
def gate_fresh(spark, sf):
    return _gates(spark, sf)[1].select(*_RESULT)


@query(f"""
    SELECT txn_month, CASE WHEN reason = '' THEN 'PUBLISHED' ELSE 'BLOCKED' END AS status, reason
    FROM (SELECT w.txn_month, concat_ws(',', CASE WHEN NOT {_FRESH} THEN 'pub_agg_freshness' END,
                 CASE WHEN count(m.txn_month) = 0 THEN 'pub_agg_monthly_present' END) AS reason
          FROM {_GATE_MONTHS} w LEFT JOIN monthly m USING (txn_month) GROUP BY w.txn_month)""")
def publish_decision(spark, sf):
    present, fresh = _gates(spark, sf)
    return controls.publish_decision(present.unionByName(fresh), now()).select("txn_month", "status", "reason")


# --- runs and logs ----------------------------------------------------------


def job_log(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    ts = F.col("ts").cast("timestamp")
    seconds = F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "STARTED").otherwise("SUCCESS")
    return V.table(spark, sf, "events").select(
        "event_id",
        F.expr("event_id div 6").cast("string").alias("run_id"),
        F.concat(F.lit("job_"), (F.col("event_id") % 3).cast("string")).alias("job_id"),
        ts.alias("exec_ts_start"),
        F.when(F.col("event_type") != "signup", ts + seconds).alias("exec_ts_end"),
        F.to_date(ts).alias("exec_date"),
        C.month_start(F.to_date(ts)).alias("txn_month"),
        status.alias("status"),
        k.alias("rows_source"),
        (k % 7).alias("rows_inserted"),
        (k % 3).alias("rows_updated"),
        F.lit(0).cast("bigint").alias("rows_deleted"),
        F.when(F.col("event_id") % 5 == 0, " ").otherwise(F.concat_ws(" ", "event_type", F.col("event_id").cast("string"))).alias("message"),
    )


def dq_log(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return V.table(spark, sf, "events").select(
        "event_id",
        F.expr("event_id div 6").cast("string").alias("run_id"),
        F.concat(F.lit("chk_"), (F.col("event_id") % 2).cast("string")).alias("check_code"),
        F.col("ts").cast("timestamp").alias("exec_ts"),
        F.when(k < 5, "FAIL").when(k < 80, "PASS").otherwise("INFO").alias("status"),
        (k % 4).alias("issue_count"),
        F.concat(F.lit("check "), F.col("event_id").cast("string")).alias("message"),
    )


def registry(spark, sf):
    """The jobs that occur in the log; the first of them is critical."""
    return job_log(spark, sf).select(F.col("job_id").alias("job_code")).distinct().withColumn(
        "is_critical", F.col("job_code") == "job_0"
    )


def _runs(spark, sf):
    return runlog.run_rollup(
        job_log(spark, sf), dq_log(spark, sf), registry(spark, sf), now(), log_tie="event_id", dq_tie="event_id"
    )


_RUN_STAMPS = """strftime(exec_ts_start, '%Y-%m-%d %H:%M:%S') AS exec_ts_start, strftime(exec_ts_end, '%Y-%m-%d %H:%M:%S') AS exec_ts_end"""


@query(f"SELECT * REPLACE ({_RUN_STAMPS}) FROM runs")
def run_rollup(spark, sf):
    return _runs(spark, sf).withColumns(
        {c: F.date_format(c, STAMP) for c in ("exec_ts_start", "exec_ts_end")}
    )


@query("SELECT run_id, job_id, event_id, status, message FROM jobs_last")
def latest_jobs(spark, sf):
    return runlog.latest_jobs(job_log(spark, sf), "event_id").select("run_id", "job_id", "event_id", "status", "message")


@query("SELECT run_id, check_code, event_id, status, issue_count FROM dq_last")
def latest_checks(spark, sf):
    return runlog.latest_checks(dq_log(spark, sf), "event_id").select("run_id", "check_code", "event_id", "status", "issue_count")


@query("""
    SELECT run_id AS gold_run_id, count(*) AS steps_total, count(*) FILTER (WHERE status = 'SUCCESS') AS steps_success,
           count(*) FILTER (WHERE status = 'FAILED') AS steps_failed,
           CASE WHEN count(*) FILTER (WHERE status = 'FAILED' AND job_id = 'job_0') > 0 THEN 'FAILED'
                WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
    FROM jobs_last GROUP BY run_id""")
def step_status(spark, sf):
    steps = job_log(spark, sf).select(
        F.col("run_id").alias("gold_run_id"), F.col("job_id").alias("entity_code"), F.col("exec_ts_start").alias("start_ts"),
        F.col("exec_ts_end").alias("end_ts"), "status", (F.col("job_id") == "job_0").alias("critical"),
        F.col("event_id").alias("step_seq"),
    )
    return runlog.step_status(steps)


@query("""
    SELECT event_id, 'missing' AS missing_fields, 'FAIL' AS payload_status FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT event_id, '', 'PASS' FROM events WHERE event_id % 2 = 1""")
def payload_contract_check(spark, sf):
    """Odd payloads carry the nested field that even ones lack."""
    nested = F.regexp_replace("props", r"\}$", ', "missing": {"deep": 1}}')
    steps = V.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(nested).alias("payload_json")
    )
    return check_payloads(steps, ["k", "missing"]).drop("payload_json")


@query("""
    SELECT event_id, '0.x-legacy' AS contract_version, CAST(k AS VARCHAR) AS row_out, concat('t_', k) AS target_table, 'SUCCESS' AS status
    FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def payload_normalized(spark, sf):
    """Flat payloads built from the event's value, read back from nested form."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    flat = F.to_json(F.struct(k.alias("row_out"), F.concat(F.lit("t_"), k.cast("string")).alias("target_table")))
    nested = V.table(spark, sf, "events").select("event_id", normalize_payload(flat, now()).alias("p"))
    return nested.select(
        "event_id", json_path("p", "contract_version").alias("contract_version"), json_path("p", "metrics.row_out").alias("row_out"),
        json_path("p", "table.target_table").alias("target_table"), json_path("p", "status").alias("status"),
    )


# --- ingestion control ------------------------------------------------------


def files(spark, sf):
    """Every event a file."""
    return V.table(spark, sf, "events").select(
        F.concat(F.lit("landing/"), F.col("event_id").cast("string")).alias("file_path"),
        F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("source_name"),
        F.col("user_id").alias("file_size"), F.col("ts").cast("timestamp").alias("modified_datetime"),
        "event_id", "event_type", "user_id",
    )


def manifest(spark, sf):
    status = F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS")
    known = files(spark, sf).where(F.col("event_id") % 4 != 0).select(
        F.lit("FX").alias("entity"), "file_path", "source_name", "file_size", "modified_datetime", status.alias("status")
    )
    return ingest.manifest_rows(known, "2024-01-01", "FULL", V._ts("2024-01-01 00:00:00"), 0, 0)


@query("SELECT concat('landing/', event_id) AS file_path FROM events WHERE event_id % 4 = 0 OR event_type = 'error'")
def incremental_candidates(spark, sf):
    return ingest.candidate_files(files(spark, sf), manifest(spark, sf), "FX").select("file_path")


@query("SELECT concat('landing/', event_id) AS file_path FROM events WHERE event_id % 4 = 0")
def incremental_candidates_no_retry(spark, sf):
    return ingest.candidate_files(files(spark, sf), manifest(spark, sf), "FX", retry_failed=False).select("file_path")


@query("""
    SELECT 'FX' AS entity, concat('landing/', event_id) AS file_path, concat('f', event_id) AS source_name, user_id AS file_size,
           CASE WHEN event_id % 4 = 0 THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS first_ingested,
           CASE WHEN event_id % 4 = 0 OR event_type = 'error' THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS last_ingested,
           CASE WHEN event_type = 'error' AND event_id % 4 <> 0 AND event_id % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS last_status,
           CASE WHEN event_id % 4 = 0 OR event_type = 'error' THEN 'INCR' ELSE 'FULL' END AS ingestion_mode
    FROM events""")
def manifest_upsert(spark, sf):
    """The next run: new and retried files recorded, every third retry fails again."""
    todo = ingest.candidate_files(files(spark, sf), manifest(spark, sf), "FX")
    again = (F.col("event_type") == "error") & (F.col("event_id") % 4 != 0) & (F.col("event_id") % 3 == 0)
    outcome = todo.select(
        F.lit("FX").alias("entity"), "file_path", "source_name", "file_size", "modified_datetime",
        F.when(again, "FAILED").otherwise("SUCCESS").alias("status"),
    )
    rows = ingest.manifest_rows(outcome, "2024-02-01", "INCR", V._ts("2024-02-01 00:00:00"), 0, 0)
    return ingest.update_manifest(manifest(spark, sf), rows).select(
        "entity", "file_path", "source_name", "file_size", F.to_date("first_ingested_datetime").alias("first_ingested"),
        F.to_date("last_ingested_datetime").alias("last_ingested"), "last_status", "ingestion_mode",
    )


_FILE_STATUS = """(SELECT CAST(ts AS DATE) AS exec_date, concat('E', user_id % 7) AS entity, 'INCR' AS ingestion_mode,
    CASE WHEN event_id % 4 <> 0 THEN NULL WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS s FROM events)"""


@query(f"""
    SELECT exec_date, entity, ingestion_mode, CAST(count(*) AS INTEGER) AS total_source_files, CAST(count(s) AS INTEGER) AS total_candidate_files,
           CAST(count(*) FILTER (WHERE s = 'SUCCESS') AS INTEGER) AS processed_files, CAST(count(*) FILTER (WHERE s = 'FAILED') AS INTEGER) AS failed_files,
           CASE WHEN count(s) = 0 THEN 'NO_DATA' WHEN count(*) FILTER (WHERE s = 'FAILED') = 0 THEN 'SUCCESS'
                WHEN count(*) FILTER (WHERE s = 'SUCCESS') = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status
    FROM {_FILE_STATUS} GROUP BY exec_date, entity, ingestion_mode""")
def ingestion_run_status(spark, sf):
    status = F.when(F.col("event_id") % 4 != 0, None).when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS")
    listed = files(spark, sf).select(
        F.to_date("modified_datetime").alias("exec_date"), F.concat(F.lit("E"), (F.col("user_id") % 7).cast("string")).alias("entity"),
        F.lit("INCR").alias("ingestion_mode"), status.alias("status"),
    )
    return ingest.ingestion_log(listed, now()).drop("log_timestamp")


@query("""
    SELECT 'FX' AS entity, DATE '2024-01-01' AS exec_date, count(*) AS files_total,
           count(*) FILTER (WHERE event_type <> 'error') AS files_success, count(*) FILTER (WHERE event_type = 'error') AS files_failed,
           CAST(0 AS BIGINT) AS files_partial FROM events WHERE event_id % 4 <> 0""")
def ingestion_monitor(spark, sf):
    return ingest.daily_ingestion(manifest(spark, sf), "2023-12-15")


@query("SELECT 'FX' AS entity, concat('landing/', event_id) AS file_path FROM events WHERE event_id % 4 <> 0 AND event_type = 'error'")
def failed_files(spark, sf):
    return ingest.failed_files(manifest(spark, sf)).select("entity", "file_path")


# --- business measures ------------------------------------------------------

_BASE = f"""
    {money_sum('abs(amount)')} AS amount_abs_sum_total, max(amount) AS amount_max, min(amount) AS amount_min,
    {money_sum('CASE WHEN NOT is_success THEN amount END')} AS amount_sum_failed,
    {money_sum('CASE WHEN is_success THEN amount END')} AS amount_sum_success, {money_sum('amount')} AS amount_sum_total,
    count(*) FILTER (WHERE NOT is_success) AS txn_count_failed, count(*) FILTER (WHERE is_success) AS txn_count_success,
    count(*) AS txn_count_total, count(*) FILTER (WHERE is_chip_used) AS txn_count_chip_used,
    count(*) FILTER (WHERE NOT is_chip_used) AS txn_count_chip_not_used, max(txn_date) AS last_txn_date,
    count(DISTINCT card_key) AS card_count_distinct, count(DISTINCT user_key) AS user_count_distinct,
    count(DISTINCT merchant_id) AS merchant_count_distinct"""
_RATIOS = """
    CAST(txn_count_chip_used AS DOUBLE) / txn_count_total AS chip_adoption_rate, CAST(txn_count_failed AS DOUBLE) / txn_count_total AS failure_rate,
    CAST(txn_count_success AS DOUBLE) / txn_count_total AS success_rate,
    CASE WHEN txn_count_success = 0 THEN 0 ELSE CAST(amount_sum_success AS DOUBLE) / txn_count_success END AS avg_ticket_success"""
_RATE = "CAST(darkweb_cards AS DOUBLE) / card_count_distinct AS darkweb_card_rate"


def _measures(by: str, group: str, dark: str, joins: str = "", level: str = "") -> str:
    head = f"{by}, " if by else ""
    return f"""
    SELECT *, {_RATIOS}, {_RATE} FROM (
        SELECT b.*, {dark} AS darkweb_cards FROM (SELECT {head}{level}{_BASE} FROM wh_fact f {joins} {group}) b)"""


_DARK = "(SELECT count(*) FROM wh_card WHERE card_on_dark_web{0})"
_BY_BRAND = _DARK.format(" AND card_brand = b.card_brand")
_BY_BRAND_OR_ALL = _DARK.format(" AND (b.card_brand IS NULL OR card_brand = b.card_brand)")


def _star(spark, sf):
    return V.stored_fact(spark, sf), V.stored_dims(spark, sf)


@query(_measures("", "", _DARK.format("")))
def kpi_overview(spark, sf):
    return measures.overview(*_star(spark, sf))


@query(_measures("card_brand", "GROUP BY card_brand", _BY_BRAND, "JOIN wh_card c ON c.card_key = f.card_key").replace(
    "count(DISTINCT card_key)", "count(DISTINCT f.card_key)"))
def kpi_by_brand(spark, sf):
    return measures.business_measures(*_star(spark, sf), by=["card_brand"])


@query(_measures("mcc_code", "GROUP BY mcc_code", _DARK.format(""), "JOIN wh_mcc m ON m.mcc_key = f.mcc_key"))
def kpi_by_mcc(spark, sf):
    return measures.business_measures(*_star(spark, sf), by=["mcc_code"])


@query(_measures(
    "card_brand, txn_month", "GROUP BY CUBE (card_brand, txn_month)", _BY_BRAND_OR_ALL,
    "JOIN wh_card c ON c.card_key = f.card_key", "CAST(grouping(card_brand, txn_month) AS BIGINT) AS level, ",
).replace("count(DISTINCT card_key)", "count(DISTINCT f.card_key)"))
def kpi_cube_brand_month(spark, sf):
    return measures.business_measures(*_star(spark, sf), by=["card_brand", "txn_month"], mode="cube")


@query(_measures(
    "year, month", "GROUP BY ROLLUP (year, month)", _DARK.format(""), "JOIN wh_date d ON d.date_key = f.date_key",
    "CAST(grouping(year, month) AS BIGINT) AS level, "))
def kpi_rollup_year_month(spark, sf):
    return measures.business_measures(*_star(spark, sf), by=["year", "month"], mode="rollup")


_SPEND = f"{money_sum('amount')} AS amount_sum_total, count(*) AS txn_count_total, count(*) FILTER (WHERE NOT is_success) AS txn_count_failed"


@query(f"SELECT card_brand, {_SPEND} FROM wh_fact f JOIN wh_card c ON c.card_key = f.card_key GROUP BY card_brand")
def spend_by_brand(spark, sf):
    return measures.spend_by(*_star(spark, sf), ["card_brand"])


@query(f"SELECT mcc_code, mcc_description, {_SPEND} FROM wh_fact f JOIN wh_mcc m ON m.mcc_key = f.mcc_key GROUP BY mcc_code, mcc_description")
def spend_by_mcc(spark, sf):
    return measures.spend_by(*_star(spark, sf), ["mcc_code", "mcc_description"])


@query(f"""SELECT mcc_code, {_SPEND} FROM wh_fact f JOIN wh_mcc m ON m.mcc_key = f.mcc_key GROUP BY mcc_code
    ORDER BY amount_sum_total DESC, mcc_code LIMIT 10""")
def top_mcc(spark, sf):
    return measures.topn(*_star(spark, sf), ["mcc_code"], 10)


@query(f"""SELECT mcc_code, {_SPEND} FROM wh_fact f JOIN wh_mcc m ON m.mcc_key = f.mcc_key GROUP BY mcc_code
    ORDER BY txn_count_failed DESC, mcc_code LIMIT 10""")
def top_failed_mcc(spark, sf):
    return measures.topn(*_star(spark, sf), ["mcc_code"], 10, "txn_count_failed")


def _top1(key: str) -> str:
    return f"""
    SELECT CAST(max(a) AS DECIMAL(18,2)) AS top1_amount, CAST(sum(a) AS DECIMAL(18,2)) AS total_amount,
           CAST(CAST(max(a) AS DECIMAL(18,2)) AS DOUBLE) / CAST(CAST(sum(a) AS DECIMAL(18,2)) AS DOUBLE) AS top1_share
    FROM (SELECT {key}, sum(amount) AS a FROM wh_fact_known GROUP BY {key})"""


@query(_top1("mcc_key"))
def top1_share_mcc(spark, sf):
    return measures.top1_share(V.stored_fact(spark, sf), "mcc_key")


@query(_top1("merchant_id"))
def top1_share_merchant(spark, sf):
    return measures.top1_share(V.stored_fact(spark, sf), "merchant_id")


@query("SELECT card_brand, count(*) AS cards_total, count(*) FILTER (WHERE card_on_dark_web) AS darkweb_cards FROM wh_card GROUP BY card_brand")
def darkweb_by_brand(spark, sf):
    return measures.darkweb_by(V.stored_dims(spark, sf), ["card_brand"])


@query("""SELECT is_chip_used, count(*) AS txn_count,
    CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM wh_fact WHERE is_chip_used IS NOT NULL) AS share
    FROM wh_fact WHERE is_chip_used IS NOT NULL GROUP BY is_chip_used""")
def chip_split(spark, sf):
    return measures.share(V.stored_fact(spark, sf), "is_chip_used")


_TREND = f"""SELECT {{0}}, count(*) AS txn_count_total, {money_sum('amount')} AS amount_sum_total,
    count(*) FILTER (WHERE NOT is_success) AS txn_count_failed,
    CAST(count(*) FILTER (WHERE NOT is_success) AS DOUBLE) / count(*) AS failure_rate FROM wh_fact GROUP BY {{0}}"""


@query(_TREND.format("txn_date"))
def trend_daily(spark, sf):
    return measures.trend(V.stored_fact(spark, sf), "day")


@query(_TREND.format("txn_month"))
def failure_trend(spark, sf):
    return measures.trend(V.stored_fact(spark, sf), "month")


@query("""
    SELECT txn_date, transaction_id, amount, currency, is_chip_used, merchant_state, merchant_city, merchant_name
    FROM wh_fact_known f JOIN wh_card c ON c.card_key = f.card_key
    WHERE card_brand = 'VISA' AND txn_date BETWEEN DATE '1998-01-15' AND DATE '1998-03-10'""")
def transaction_detail(spark, sf):
    return measures.transaction_detail(V.measured_fact(spark, sf), V.stored_dims(spark, sf), "1998-01-15", "1998-03-10", "VISA")


# --- operations measures ----------------------------------------------------


@query("""
    SELECT dq_fail_count, CASE WHEN dq_fail_count > 0 THEN 'FAILED' ELSE 'PASSED' END AS dq_overall_status, jobs_executed, jobs_failed,
           CASE WHEN dq_fail_count > 0 OR jobs_failed > 0 THEN 'CRITICAL' ELSE 'OK' END AS critical_gate,
           CAST(CASE WHEN dq_fail_count > 0 OR jobs_failed > 0 THEN 3 ELSE 1 END AS INTEGER) AS severity_code
    FROM (SELECT (SELECT count(*) FROM dq_log WHERE status = 'FAIL') AS dq_fail_count, (SELECT count(*) FROM jobs_last) AS jobs_executed,
                 (SELECT count(*) FROM jobs_last WHERE status = 'FAILED') AS jobs_failed)""")
def ops_health(spark, sf):
    return ops_measures.health(job_log(spark, sf), dq_log(spark, sf), tie_break="event_id")


@query("SELECT count(*) AS jobs_executed, count(*) FILTER (WHERE status = 'FAILED') AS jobs_failed FROM job_log")
def ops_jobs_raw(spark, sf):
    return ops_measures.job_counts(job_log(spark, sf), raw=True)


@query("""
    SELECT d AS daily_last_date, m AS monthly_last_month, CAST(date_diff('day', d, DATE '2001-07-15') AS INTEGER) AS daily_freshness_days,
           strftime(m, '%Y-%m') AS monthly_last_label, CAST(date_diff('day', m, DATE '2001-07-15') AS INTEGER) AS monthly_freshness_days,
           date_diff('day', m, DATE '2001-07-15') <= 31 AS monthly_is_fresh, CAST(CASE WHEN m = DATE '2001-07-01' THEN 1 ELSE 0 END AS INTEGER) AS monthly_current_present,
           '2001-07' AS monthly_current_label
    FROM (SELECT max(txn_date) AS d, max(txn_month) AS m FROM wh_fact)""")
def ops_freshness(spark, sf):
    fact = V.stored_fact(spark, sf)
    as_of = F.lit("2001-07-15").cast("date")
    return ops_measures.freshness(warehouse.fact_daily(fact), warehouse.fact_monthly(fact), as_of)


@query("""
    SELECT exec_date, count(*) AS runs_total, count(*) FILTER (WHERE run_status = 'SUCCESS') AS runs_success,
           count(*) FILTER (WHERE run_status = 'FAILED') AS runs_failed,
           CAST(count(*) FILTER (WHERE run_status = 'SUCCESS') AS DOUBLE) / count(*) AS success_rate,
           CAST(sum(duration_sec) AS DOUBLE) / 60 AS duration_min, CAST(sum(duration_sec) AS DOUBLE) / 60 / count(duration_sec) AS duration_min_avg,
           max(CAST(duration_sec AS DOUBLE) / 60) AS duration_min_max, max(CAST(duration_sec AS DOUBLE) / 60) > 60 AS has_long_run,
           CAST(sum(rows_inserted + rows_updated + rows_deleted) AS BIGINT) AS rows_processed, CAST(sum(rows_source) AS BIGINT) AS rows_source,
           CAST(CASE WHEN count(*) FILTER (WHERE run_status = 'FAILED') > 0 OR sum(dq_fail_count) > 0 THEN 1 ELSE 0 END AS INTEGER) AS critical_failed
    FROM runs GROUP BY exec_date""")
def ops_run_history(spark, sf):
    return ops_measures.run_history(_runs(spark, sf), ("exec_date",))


@query("""
    SELECT max(run_id) AS latest_run_id, arg_max(run_status, run_id) AS latest_run_status,
           max(run_id) FILTER (WHERE run_status = 'SUCCESS') AS last_success_run_id,
           strftime(max(exec_ts_end) FILTER (WHERE run_status = 'SUCCESS'), '%Y-%m-%d %H:%M:%S') AS last_success_end_ts FROM runs""")
def ops_latest_run(spark, sf):
    return ops_measures.latest_run(_runs(spark, sf)).withColumn("last_success_end_ts", F.date_format("last_success_end_ts", STAMP))


# --- files and streams ------------------------------------------------------


def _landing_files(spark, sf) -> str:
    """The landing text written as CSV files with a header."""
    home = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    L.transactions(spark, sf).write.option("header", True).option("maxRecordsPerFile", 1_000_000).csv(f"{home}/in")
    return home


def _loaded(spark, path: str) -> DataFrame:
    c = ENTITIES["TRANSACTION"].contract
    df = spark.read.schema(c.schema).parquet(path).select(*c.names)
    return df.withColumn("date", F.date_format("date", STAMP)).drop("source_file", "ingestion_ts")


@query(_BRONZE_TXN.format("DATE '2001-07-01' AS ingestion_date, 'TRANSACTION' AS entity"))
def ingest_files(spark, sf):
    """Landing files listed, checked against an empty manifest, scanned in one
    job and appended to bronze."""
    home = _landing_files(spark, sf)
    ingest.ingest(
        spark, "TRANSACTION", f"{home}/in", f"{home}/bronze", f"{home}/manifest", f"{home}/log", "2001-07-01", uuid.uuid4().hex
    )
    return _loaded(spark, f"{home}/bronze")


@query(_BRONZE_TXN.format("DATE '2001-07-01' AS ingestion_date, 'TRANSACTION' AS entity"))
def stream_ingest_files(spark, sf):
    """The same files through the file stream."""
    home = _landing_files(spark, sf)
    stream_ingest(
        spark, "TRANSACTION", f"{home}/in", f"{home}/bronze", f"{home}/manifest", f"{home}/checkpoint", "2001-07-01"
    ).awaitTermination()
    return _loaded(spark, f"{home}/bronze")


@query("""
    SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def stream_latest_transactions(spark, sf):
    """Line items as a file stream, kept as the latest row per id."""
    schema = V.table(spark, sf, "lineitem").schema
    lines = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    keyed = lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        "l_partkey", "l_suppkey", "l_extendedprice", F.to_date("l_shipdate").alias("ship_date"),
    )
    home = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream_latest(
        keyed, f"{home}/table", ["id"], "ship_date", ["l_partkey", "l_suppkey", "l_extendedprice"],
        f"{home}/checkpoint", uuid.uuid4().hex, buckets=8,
    ).awaitTermination()
    return read_latest(spark, f"{home}/table", keyed.schema, ["id"], "ship_date", ["l_partkey", "l_suppkey", "l_extendedprice"])


# --- loads with faulty, moved and late rows ----------------------------------


@query(_BRONZE_TXN.format("DATE '2001-07-01' AS ingestion_date, 'TRANSACTION' AS entity"))
def ingest_mixed_headers(spark, sf):
    """Files of two column orders in one folder; columns go by each file's header."""
    home = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    raw = L.transactions(spark, sf)
    even = F.col(raw.columns[0]).cast("long") % 2 == 0
    raw.where(even).write.option("header", True).csv(f"{home}/in")
    raw.where(~even).select(*reversed(raw.columns)).write.mode("append").option("header", True).csv(f"{home}/in")
    ingest.ingest(
        spark, "TRANSACTION", f"{home}/in", f"{home}/bronze", f"{home}/manifest", f"{home}/log", "2001-07-01", uuid.uuid4().hex
    )
    return _loaded(spark, f"{home}/bronze")


@query("""
    SELECT 'loaded' AS kind, count(*) FILTER (WHERE o_orderkey % 11 <> 0) AS row_count FROM orders
    UNION ALL SELECT 'rejected', count(*) FILTER (WHERE o_orderkey % 11 = 0) FROM orders""")
def ingest_rejects(spark, sf):
    """Every eleventh line has a field too many: it is kept apart, the others of its file load."""
    home = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    raw = L.fx(spark, sf)
    key = V.table(spark, sf, "orders").schema["o_orderkey"].name
    lines = V.table(spark, sf, "orders").select(
        F.concat_ws(",", F.format_string("c%02d", F.col("o_custkey") % 25), F.lit("EUR"), F.lit("C"), F.col("o_totalprice").cast("string"),
                    F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col(key) % 11 == 0, "more")).alias(",".join(raw.columns)))
    lines.write.option("header", True).option("quote", "").option("sep", "|").csv(f"{home}/in")
    ingest.ingest(spark, "FX", f"{home}/in", f"{home}/bronze", f"{home}/manifest", f"{home}/log", "2001-07-01", uuid.uuid4().hex)
    counts = [
        spark.read.parquet(p).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("row_count"))
        for kind, p in (("loaded", f"{home}/bronze"), ("rejected", ingest.rejects_path(f"{home}/bronze")))
    ]
    return counts[0].unionByName(counts[1])


@query(_BRONZE_TXN.format("DATE '2001-07-01' AS ingestion_date, 'TRANSACTION' AS entity"))
def stream_two_sources(spark, sf):
    """Two folders streamed into one table, one after the other."""
    home = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    raw = L.transactions(spark, sf)
    odd = F.col(raw.columns[0]).cast("long") % 2
    for i in (0, 1):
        raw.where(odd == i).write.option("header", True).csv(f"{home}/in{i}")
        stream_ingest(
            spark, "TRANSACTION", f"{home}/in{i}", f"{home}/bronze", f"{home}/manifest", f"{home}/checkpoint{i}", "2001-07-01"
        ).awaitTermination()
    return _loaded(spark, f"{home}/bronze")


@query("""
    SELECT id AS transaction_id, CAST(date_trunc('month', date + INTERVAL 31 DAY) AS DATE) AS txn_month, CAST(amount AS DECIMAL(18,2)) AS amount
    FROM txn_raw WHERE id % 10 = 1
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY merchant_id DESC, card_id DESC, abs(amount) DESC) = 1
    UNION ALL SELECT transaction_id, txn_month, amount FROM silver_txn WHERE transaction_id % 10 <> 1""")
def silver_incremental(spark, sf):
    """A later load moves the first lines to another month; what it has of the
    second lines is older than the stored rows and changes nothing."""
    path = f"{checkpoint_dir(spark)}/silver-{uuid.uuid4().hex}"
    bronze, line = V.bronze_transactions(spark, sf), F.col("id") % 10
    silver.build_silver(bronze, "TRANSACTION", path, uuid.uuid4().hex, tie_break=V.TXN_TIES)
    moved = bronze.where(line == 1).withColumns({
        "date": F.col("date") + F.expr("interval 31 days"), "ingestion_ts": now()})
    stale = bronze.where(line == 2).withColumns({"amount": F.lit(0.0), "ingestion_ts": V._ts("1970-01-01 00:00:00")})
    late = moved.unionByName(stale)
    silver.build_silver(late, "TRANSACTION", path, uuid.uuid4().hex, incremental=True, tie_break=V.TXN_TIES)
    return writers.read(spark, path, K.SILVER_TRANSACTIONS.schema).select("transaction_id", "txn_month", "amount")


@query("""
    SELECT transaction_id, CASE WHEN transaction_id LIKE '%5' THEN CAST(txn_month + INTERVAL 1 MONTH AS DATE) ELSE txn_month END AS txn_month, amount
    FROM wh_fact_known""")
def refresh_slice_moved(spark, sf):
    """A month-wise load by which some transactions leave the month they stood in."""
    path = f"{checkpoint_dir(spark)}/slice-{uuid.uuid4().hex}"
    warehouse.refresh_slice(V.warehouse_fact(spark, sf), "fact_transactions", path, uuid.uuid4().hex)
    fact = writers.read(spark, path, K.WH_FACT.schema)
    later = F.add_months("txn_month", 1)
    moved = fact.where(F.col("transaction_id").endswith("5")).withColumns({
        "txn_month": later, "record_hash": F.sha2(F.concat("record_hash", later.cast("string")), 256)})
    warehouse.refresh_slice(moved, "fact_transactions", path, uuid.uuid4().hex)
    return writers.read(spark, path, K.WH_FACT.schema).select("transaction_id", "txn_month", "amount")


@query(_BRONZE_TXN.format("DATE '2001-07-01' AS ingestion_date, 'TRANSACTION' AS entity"))
def ingest_interleaved(spark, sf):
    """Two loads of one entity from two folders at once: one waits for the other, no row is lost or doubled."""
    home = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    raw = L.transactions(spark, sf)
    odd = F.col(raw.columns[0]).cast("long") % 2
    for i in (0, 1):
        raw.where(odd == i).write.option("header", True).csv(f"{home}/in{i}")

    def load(i: int) -> dict:
        return ingest.ingest(
            spark, "TRANSACTION", f"{home}/in{i}", f"{home}/bronze", f"{home}/manifest", f"{home}/log", "2001-07-01", uuid.uuid4().hex, wait=1800.0
        )

    with ThreadPoolExecutor(2) as both:
        list(both.map(load, (0, 1)))
    recorded = writers.read(spark, f"{home}/manifest").where("last_status = 'SUCCESS'").count()
    if recorded != sum(readers.list_files(spark, f"{home}/in{i}").count() for i in (0, 1)):
        raise AssertionError("a load's files are missing in the manifest")
    return _loaded(spark, f"{home}/bronze")


_SHIFTED = """(SELECT txn_month, transaction_id FROM wh_fact_known UNION ALL
    SELECT CAST(txn_month + INTERVAL 1 MONTH AS DATE), transaction_id FROM wh_fact_known WHERE transaction_id LIKE '%5')"""


def _fact_with_moved_copies(spark, sf):
    fact = V.stored_ids(spark, sf)
    copies = fact.where(F.col("transaction_id").endswith("5")).withColumn("txn_month", F.add_months("txn_month", 1))
    return fact.unionByName(copies)


@query(f"""
    SELECT 'duplicates_transaction_id' AS check_code, CAST(NULL AS DATE) AS txn_month, {_STATUS}
    FROM (SELECT count(*) AS n FROM (SELECT transaction_id FROM {_SHIFTED} GROUP BY transaction_id HAVING count(*) > 1))""")
def ctl_duplicates_all(spark, sf):
    """Ids that stand once in each of two months."""
    return controls.ctl_duplicates(_fact_with_moved_copies(spark, sf), _run(), per_month=False).select(*_RESULT)


@query(f"SELECT DISTINCT txn_month, 'BLOCKED' AS status, 'duplicates_transaction_id' AS reason FROM {_SHIFTED}")
def publish_blocked(spark, sf):
    fact = _fact_with_moved_copies(spark, sf)
    found = controls.ctl_duplicates(fact, _run()).unionByName(controls.ctl_duplicates(fact, _run(), per_month=False))
    return controls.publish_decision(found, now()).select("txn_month", "status", "reason")


@query("""
    SELECT txn_month, 'duplicates_transaction_id' AS metric_name, CAST(n AS BIGINT) AS metric_value, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT txn_month, count(*) FILTER (WHERE c > 1) AS n FROM (
        SELECT CAST(date_trunc('month', date) AS DATE) AS txn_month, id, count(*) AS c FROM txn_raw GROUP BY ALL) GROUP BY txn_month)""")
def ctrl_duplicates(spark, sf):
    raw = V.bronze_transactions(spark, sf).select(
        F.col("id").alias("transaction_id"), C.month_start(F.to_date("date")).alias("txn_month"))
    shaped = controls.ctrl_rows(controls.ctl_duplicates(raw, _run()), K.CTRL_DUPLICATES)
    return shaped.select("txn_month", "metric_name", F.col("metric_value").cast("bigint").alias("metric_value"), "status")


@query("""
    SELECT v.d AS dimension, CAST(v.n AS BIGINT) AS row_count
    FROM (SELECT count(*) FILTER (WHERE client_id NOT IN (SELECT client_id FROM known_users)) AS u,
                 count(*) FILTER (WHERE card_id NOT IN (SELECT card_id FROM cards)) AS c,
                 count(*) FILTER (WHERE mcc_code NOT IN (SELECT mcc_code FROM known_mcc)) AS m,
                 count(*) FILTER (WHERE txn_date NOT IN (SELECT date_value FROM days)) AS t FROM silver_txn) x,
         LATERAL (VALUES ('dim_user', u), ('dim_card', c), ('dim_mcc', m), ('dim_date', t)) v(d, n)""")
def rows_without_key(spark, sf):
    """Rows that a warehouse load would leave out, by the dimension that lacks their key."""
    dims = dict(V.stored_dims(spark, sf))
    dims["dim_user"] = dims["dim_user"].where(F.col("client_id").cast("long") % 50 != 0)
    dims["dim_mcc"] = dims["dim_mcc"].where(F.col("mcc_code") % 13 != 0)
    return warehouse.rows_without_key(V.silver_transactions(spark, sf), dims)


@query("""
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'contract_version,layer,run_id,entity_code,load_mode,status,metrics.row_out,table.target_table,timing.started_utc,timing.ended_utc,timing.duration_ms'
           ELSE '' END AS missing_fields, CASE WHEN event_id % 2 = 0 THEN 'FAIL' ELSE 'PASS' END AS payload_status FROM events""")
def payload_required_fields(spark, sf):
    """The required fields: odd payloads are brought to the common shape, even ones left as they come."""
    flat = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("entity_code"), F.lit("FULL").alias("load_mode"),
        F.get_json_object("props", "$.k").cast("bigint").alias("row_out"), F.lit("t").alias("target_table")))
    payload = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(normalize_payload(flat, now()))
    return check_payloads(V.table(spark, sf, "events").select("event_id", payload.alias("payload_json"))).drop("payload_json")


@query("SELECT s_suppkey, concat('tk', s_suppkey) AS ticker FROM supplier")
def ticker_paths(spark, sf):
    path = F.concat(F.lit("landing/stocks/tk"), F.col("s_suppkey").cast("string"), F.lit(".us.txt"))
    return V.table(spark, sf, "supplier").select("s_suppkey", C.ticker_from_path(path).alias("ticker"))


@query("SELECT rule_id, count(*) AS row_count FROM events_out GROUP BY rule_id")
def gold_fact_loaded_twice(spark, sf):
    """Events of a fact load that ran twice under one run id."""
    home = f"{checkpoint_dir(spark)}/gold-{uuid.uuid4().hex}"
    stored = V._stored(spark, sf, "silver_transactions", lambda: V.silver_transactions(spark, sf))
    for _ in range(2):
        gold.build_fact(
            stored, *V.fact_dims(spark, sf), V.gold_dates(spark), f"{home}/fact", f"{home}/events", f"{home}/kpis", uuid.uuid5(uuid.NAMESPACE_URL, home).hex,
        )
    return spark.read.parquet(f"{home}/events").groupBy("rule_id").agg(F.count(F.lit(1)).alias("row_count"))


@query("""
    SELECT 'rows_inserted' AS measure, count(*) FILTER (WHERE client_id % 2 = 1) AS row_count FROM users
    UNION ALL SELECT 'rows_without_key', count(*) FILTER (WHERE client_id % 7 = 0) FROM users
    UNION ALL SELECT 'rows_inserted_again', 0""")
def dimension_without_keys(spark, sf):
    """Users of whom some come a second time without their id: they are counted and never inserted."""
    path = f"{checkpoint_dir(spark)}/dim-{uuid.uuid4().hex}"
    users = V.stored_gold(spark, sf, "users")
    nameless = users.where(F.col("client_id") % 7 == 0).withColumn("client_id", F.lit(None).cast("bigint"))
    warehouse.refresh_dimension(users.where(F.col("client_id") % 2 == 0), "dim_user", path, uuid.uuid4().hex)
    first = warehouse.refresh_dimension(users.unionByName(nameless), "dim_user", path, uuid.uuid4().hex)
    again = warehouse.refresh_dimension(users.unionByName(nameless), "dim_user", path, uuid.uuid4().hex)
    counts = {"rows_inserted": first["rows_inserted"], "rows_without_key": first["rows_without_key"], "rows_inserted_again": again["rows_inserted"]}
    return spark.createDataFrame(list(counts.items()), "measure string, row_count long")


# --- what loads report, catalog tables, logs ---------------------------------


def _measured(spark, counts: dict) -> DataFrame:
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "measure string, n long")


@query("""
    SELECT 'row_in' AS measure, count(*) AS n FROM txn_raw UNION ALL SELECT 'row_out', count(*) FROM silver_txn
    UNION ALL SELECT 'dedup_dropped', (SELECT count(*) FROM txn_raw) - (SELECT count(*) FROM silver_txn)
    UNION ALL SELECT 'partition_count', count(DISTINCT txn_month) FROM silver_txn""")
def load_counts(spark, sf):
    """What a silver load reports, counted on its one pass."""
    path = f"{checkpoint_dir(spark)}/counts-{uuid.uuid4().hex}"
    bronze = V.bronze_transactions(spark, sf)
    return _measured(spark, silver.build_silver(bronze, "TRANSACTION", path, uuid.uuid4().hex, tie_break=V.TXN_TIES))


@query("""
    SELECT 'fact_transactions' AS entity_code, 'SUCCESS' AS status, (SELECT count(*) FROM silver_txn) AS row_in, (SELECT count(*) FROM fact) AS row_out,
           count(*) AS row_rejected, CAST(0 AS BIGINT) AS dedup_dropped, count(*) AS anom_count,
           CAST((SELECT count(DISTINCT txn_month) FROM fact) AS INTEGER) AS partition_count
    FROM tagged WHERE failed IS NOT NULL""")
def step_log(spark, sf):
    """The step log's row of a fact load, from the metrics that the load returns; fields it lacks are NULL."""
    home, run = f"{checkpoint_dir(spark)}/steps-{uuid.uuid4().hex}", uuid.uuid4().hex
    stored = V._stored(spark, sf, "silver_transactions", lambda: V.silver_transactions(spark, sf))
    began = datetime.now(timezone.utc)
    counts = gold.build_fact(stored, *V.fact_dims(spark, sf), V.gold_dates(spark), f"{home}/fact", f"{home}/events", f"{home}/kpis", run)
    row = runlog.step_row(run, "fact_transactions", began, datetime.now(timezone.utc), "SUCCESS", counts, step_seq=1)
    writers.append_rows(spark, f"{home}/log", [row], K.GOLD_STEP_LOG.schema)
    logged = spark.read.schema(K.GOLD_STEP_LOG.schema).parquet(f"{home}/log").where("duration_ms >= 0 and error_message is null")
    return logged.select("entity_code", "status", "row_in", "row_out", "row_rejected", "dedup_dropped", "anom_count", "partition_count")


@query("SELECT transaction_id, amount FROM wh_fact WHERE txn_month = DATE '1998-02-01'")
def month_scope(spark, sf):
    return projection.month_scope(V.measured_fact(spark, sf), "1998-02-01").select("transaction_id", "amount")


@query("""
    SELECT 'row_count' AS check, abs(count(*) - (date_diff('day', DATE '1995-01-01', DATE '2001-06-30') + 1)) AS issue_count,
           CASE WHEN count(*) = date_diff('day', DATE '1995-01-01', DATE '2001-06-30') + 1 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem)""")
def calendar_row_count(spark, sf):
    """Whether the days that have transactions fill the calendar."""
    days = V.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date_value")).distinct()
    check = [c for c in gold.date_checks(*V.CALENDAR) if c.expected_rows is not None]
    return quality.run_checks(days, check)


@query("""
    SELECT 'mcc_code_not_blank' AS check, count(*) FILTER (WHERE p_size % 5 = 0) AS issue_count,
           CASE WHEN count(*) FILTER (WHERE p_size % 5 = 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM part""")
def mcc_blocking_check(spark, sf):
    """Categories of which some have no code: the check that blocks their load."""
    size = F.col("p_size")
    codes = V.table(spark, sf, "part").select(F.when(size % 5 != 0, size.cast("string")).otherwise(F.when(size % 2 == 0, " ")).alias("mcc_code"))
    return quality.run_checks(codes, [c for c in gold.mcc_checks() if c.name == "mcc_code_not_blank"])


@query("SELECT n_name AS name, n_regionkey AS region FROM nation UNION ALL SELECT r_name, r_regionkey FROM region")
def catalog_rebuild(spark, sf):
    """A catalog table made empty and rebuilt twice, the second time from what it holds."""
    table = f"rebuilt_{uuid.uuid4().hex}"
    nations = V.table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    regions = V.table(spark, sf, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("region"))
    writers.create_if_missing(spark, table, nations.schema)
    writers.rebuild_table(nations, table)
    writers.create_if_missing(spark, table, nations.schema)
    writers.rebuild_table(spark.table(table).unionByName(regions), table)
    return spark.table(table)


@query("""
    SELECT s_name AS source_name, 'landing/2001-07-01/' || s_name AS landing_path, 'archive/2001-07-01/' || s_name AS archive_path FROM supplier""")
def landing_archive_paths(spark, sf):
    files = V.table(spark, sf, "supplier").select(F.col("s_name").alias("source_name"))
    return readers.add_lineage_paths(files, "landing/", "archive/", "2001-07-01")


@query("SELECT strftime(txn_month, '%b %Y') AS month_label, count(*) AS txn_count FROM wh_fact WHERE txn_month = DATE '1998-02-01' GROUP BY 1 "
       "UNION ALL SELECT 'All months', count(*) FROM wh_fact")
def kpi_month_label(spark, sf):
    fact = V.stored_fact(spark, sf)
    one = projection.month_scope(fact, "1998-02-01").agg(F.count(F.lit(1)).alias("txn_count")).select(measures.month_label(1998, 2).alias("month_label"), "txn_count")
    return one.unionByName(fact.agg(F.count(F.lit(1)).alias("txn_count")).select(measures.month_label().alias("month_label"), "txn_count"))


@query("SELECT 'dim_user' AS entity, count(*) AS row_count, CAST(1 AS BIGINT) AS runs, CAST(1 AS BIGINT) AS stamps FROM users")
def audit_columns(spark, sf):
    """Rows of one load carry one run and one load time, taken from the clock."""
    users = gold.dim_user(V.silver_users(spark, sf), V.RUN_ID).where(F.col("gold_load_ts") <= F.current_timestamp())
    return users.groupBy(F.lit("dim_user").alias("entity")).agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("gold_run_id").alias("runs"), F.countDistinct("gold_load_ts").alias("stamps"))


@query("SELECT 'GOLD.CARD.CONF.001' AS rule_id, count(*) AS issue_count FROM silver_card WHERE client_id IS NULL OR client_id NOT IN (SELECT client_id FROM users)")
def foreign_key_report_cards(spark, sf):
    """Cards whose client is missing or not known, reported and not rejected."""
    return orphan_report(V.silver_cards(spark, sf), gold.card_rules(V.gold_users(spark, sf))).select("rule_id", "issue_count")


def _verdicts(spark, sf) -> DataFrame:
    """Gold tables against their contracts: one as declared, one that lacks, adds and changes columns, one that is not there."""
    users, cards = V.stored_gold(spark, sf, "users"), V.stored_gold(spark, sf, "cards")
    changed = cards.drop("card_brand").withColumns({"has_chip": F.col("has_chip").cast("string"), "colour": F.lit("blue")})
    live = {K.GOLD_DIM_USER.table: K.project_to_contract(users, K.GOLD_DIM_USER), K.GOLD_DIM_CARD.table: changed}
    return compliance.schema_compliance(spark, [K.GOLD_DIM_USER, K.GOLD_DIM_CARD, K.GOLD_DIM_MCC], live.__getitem__)


@query(f"""
    SELECT * FROM (VALUES ('{K.GOLD_DIM_USER.table}', 'PASS', 0, 0, 0), ('{K.GOLD_DIM_CARD.table}', 'FAIL', 1, 1, 1), ('{K.GOLD_DIM_MCC.table}', 'MISSING_TABLE', 0, 0, 0))
        v(table_name, compliance_status, missing, extra, mistyped)""")
def schema_verdict(spark, sf):
    found = _verdicts(spark, sf)
    sizes = {"missing": "missing_columns", "extra": "extra_columns", "mistyped": "type_mismatches"}
    return found.select("table_name", "compliance_status", *[F.json_array_length(c).alias(n) for n, c in sizes.items()])


@query("SELECT * FROM (VALUES ('PASS', CAST(1 AS BIGINT)), ('FAIL', 1), ('MISSING_TABLE', 1)) v(compliance_status, tables)")
def schema_verdict_summary(spark, sf):
    return compliance.compliance_summary(_verdicts(spark, sf))


@query("SELECT DISTINCT card_brand, true AS cards_within, true AS users_within, true AS merchants_within FROM wh_fact f JOIN wh_card c ON c.card_key = f.card_key")
def kpi_sketch_error(spark, sf):
    """Distinct members from stored sketches by month and card, within four standard errors of the exact counts."""
    fact, dims = _star(spark, sf)
    path = f"{checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    writers.publish(measures.distinct_sketches(fact, ["txn_month", "card_key"]), path, "sketches", ["txn_month"])
    estimated = measures.counts_from_sketches(writers.read(spark, path), dims, ["card_brand"])
    exact = measures.business_measures(fact, dims, ["card_brand"])
    names = {"cards_within": "card_count_distinct", "users_within": "user_count_distinct", "merchants_within": "merchant_count_distinct"}
    both = exact.select("card_brand", *[F.col(c).alias(f"exact_{c}") for c in names.values()]).join(estimated, "card_brand")
    off = {n: F.abs(F.col(c) - F.col(f"exact_{c}")) <= 4 * measures.SKETCH_ERROR * F.col(f"exact_{c}") + 1 for n, c in names.items()}
    return both.select("card_brand", *[c.alias(n) for n, c in off.items()])


@query("""
    SELECT 'first' AS load, count(*) FILTER (WHERE n_nationkey < 20) AS files, count(*) FILTER (WHERE n_nationkey < 20) AS candidates FROM nation
    UNION ALL SELECT 'second', count(*) FILTER (WHERE n_nationkey >= 20) + 1, count(*) FILTER (WHERE n_nationkey >= 20) FROM nation""")
def ingest_by_watermark(spark, sf):
    """A second load lists only files changed since the last recorded one; that one is seen again and not loaded again."""
    home = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    names = V.table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.concat_ws(",", "n_name", F.lit("2001-01-01")).alias("currency,date"))
    at, fs = numbered.file_system(spark, home)
    out = []
    for load, part in (("first", names.where("k < 20")), ("second", names.where("k >= 20"))):
        lines = part.repartitionByRange(25, "k").drop("k")
        lines.write.mode("append").option("header", True).option("quote", "").option("sep", "|").csv(f"{home}/in")
        made = sorted(n for n in numbered.names(spark, f"{home}/in") if n.endswith(".csv"))
        old = out[0]["names"] if out else set()
        for i, name in enumerate(n for n in made if n not in old):  # one minute apart, the second load's files an hour later
            path, _ = numbered.file_system(spark, f"{home}/in/{name}")
            fs.setTimes(path, (1_000_000 + 60 * i + 36_000 * len(out)) * 1000, -1)
        got = ingest.ingest(spark, "PARTNER", f"{home}/in", f"{home}/bronze", f"{home}/manifest", f"{home}/log", "2001-07-01", uuid.uuid4().hex, overlap=timedelta(seconds=1))
        out.append({"load": load, "files": got["total_source_files"], "candidates": got["total_candidate_files"], "names": set(made)})
    return spark.createDataFrame([(r["load"], r["files"], r["candidates"]) for r in out], "load string, files long, candidates long")

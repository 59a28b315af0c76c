"""Landing text over the test tables: every column a string, as a file would
hold it, with the blanks, signs and spellings the bronze readers must handle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.catalog.views import table
from cardlake.plans.bronze import FUNDAMENTAL_MEASURES


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _dollars(c: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    errors = (
        F.when(line == 1, None).when(line == 2, " ").when(line == 3, "0").when(line == 4, "5")
        .when(line == 5, "5.0").otherwise("Insufficient Balance")
    )
    return table(spark, sf, "lineitem").select(
        _s(F.col("l_orderkey") * 10 + line).alias("id"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        _s("l_orderkey").alias("client_id"),
        _s("l_suppkey").alias("card_id"),
        F.when(line == 7, "N/A").otherwise(_dollars(signed)).alias("amount"),
        F.when(line != 7, F.concat(F.lit(" chip "), F.lower("l_returnflag"), F.lit(" "))).alias("use_chip"),
        _s("l_partkey").alias("merchant_id"),
        F.concat(F.lit(" city "), _s("l_partkey")).alias("merchant_city"),
        F.lower("l_linestatus").alias("merchant_state"),
        F.concat(F.lit(" "), _s(F.col("l_partkey") % 1000), F.lit(".0")).alias("zip"),
        _s(F.col("l_partkey") % 60000).alias("mcc"),
        errors.alias("errors"),
    )


def fx(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.format_string("c%02d", F.col("o_custkey") % 25).alias("Currency"),
        F.lit("EUR").alias("BaseCurrency"),
        F.concat(F.lit("Currency "), _s(F.col("o_custkey") % 25)).alias("CurrencyName"),
        F.when(key % 11 == 0, "n/a").otherwise(_s("o_totalprice")).alias("ExchangeRate"),
        F.when(key % 7 == 0, "31.12.x").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Date"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        _s(key + 1).alias("RowNumber"),
        _s(key).alias("CustomerId"),
        F.concat(F.lit(" "), F.lower("c_name")).alias("Surname"),
        F.when(key % 9 == 0, "").otherwise(_s(key % 550 + 300)).alias("CreditScore"),
        F.lower("c_mktsegment").alias("Geography"),
        F.when(key % 2 == 0, " Female").otherwise("male ").alias("Gender"),
        _s(key % 70 + 18).alias("Age"),
        _s(key % 10).alias("Tenure"),
        _s("c_acctbal").alias("Balance"),
        F.concat(_s(key % 4), F.lit(".0")).alias("NumOfProducts"),
        _s(key % 2).alias("HasCrCard"),
        _s((key + 1) % 2).alias("IsActiveMember"),
        F.when(key % 13 == 0, "unknown").otherwise(_s("c_acctbal")).alias("EstimatedSalary"),
        _s(F.when(key % 5 == 0, 1).otherwise(0)).alias("Exited"),
    )


def securities(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("tk"), _s(key)).alias("Ticker symbol"),
        F.col("s_name").alias("Security"),
        F.lit("reports").alias("SEC filings"),
        F.concat(F.lit("Sector "), _s(key % 11)).alias("GICS Sector"),
        F.concat(F.lit("Industry "), _s(key % 60)).alias("GICS Sub Industry"),
        F.concat(F.lit("Nation "), _s("s_nationkey")).alias("Address of Headquarters"),
        F.when(key % 4 == 0, None).otherwise(F.format_string("%04d-%02d-01", key % 30 + 1980, key % 12 + 1)).alias("Date first added"),
        F.lpad(_s(key), 10, "0").alias("CIK"),
    )


def fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    measures = [
        F.when((key + i) % 17 == 0, "").otherwise(_s(key * (i + 1) % 100003)).alias(name)
        for i, name in enumerate(FUNDAMENTAL_MEASURES)
    ]
    return table(spark, sf, "orders").select(
        _s(key).alias("_c0"),
        F.format_string("T%03d", F.col("o_custkey") % 500).alias("Ticker Symbol"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Period Ending"),
        *measures,
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.format_string("S%03d", F.col("l_partkey") % 500).alias("symbol"),
        _s(price).alias("open"),
        F.when(F.col("l_linenumber") == 7, "null").otherwise(_s(price)).alias("close"),
        _s("l_discount").alias("low"),
        _s("l_tax").alias("high"),
        _s("l_quantity").alias("volume"),
    )


def ohlcv(spark: SparkSession, sf: str) -> DataFrame:
    lines = prices(spark, sf)
    return lines.select(
        F.concat(F.lit(" "), F.lower("symbol"), F.lit(" ")).alias("Ticker"),
        F.when(F.col("close") == "null", F.date_format(F.to_date("date"), "dd/MM/yyyy")).otherwise(F.col("date")).alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
        F.lit("0").alias("OpenInt"),
    )


def cards(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        _s(key).alias("id"),
        F.when(key % 10 != 3, _s(key)).alias("client_id"),
        F.lit(" Visa ").alias("card_brand"),
        F.when(key % 2 == 0, "debit").otherwise("Credit (prepaid)").alias("card_type"),
        F.concat(F.lit("4"), F.lpad(_s(key), 15, "0")).alias("card_number"),
        F.concat(F.lpad(_s(key % 12 + 1), 2, "0"), F.lit("/2022")).alias("expires"),
        F.lpad(_s(key % 1000), 3, "0").alias("cvv"),
        F.when(key % 3 != 0, "yes").otherwise("no").alias("has_chip"),
        _s(key % 3 + 1).alias("num_cards_issued"),
        F.when(key % 8 == 0, "").otherwise(_dollars("s_acctbal")).alias("credit_limit"),
        F.concat(F.lpad(_s(key % 12 + 1), 2, "0"), F.lit("/2002")).alias("acct_open_date"),
        _s(key % 20 + 2000).alias("year_pin_last_changed"),
        F.lit("No").alias("card_on_dark_web"),
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        _s(key).alias("id"),
        _s(key % 70 + 18).alias("current_age"),
        _s(key % 10 + 60).alias("retirement_age"),
        _s(key % 60 + 1940).alias("birth_year"),
        _s(key % 12 + 1).alias("birth_month"),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.concat(F.lit("  "), F.col("c_name")).alias("address"),
        _s(key % 90).alias("latitude"),
        F.concat(F.lit("-"), _s(key % 180), F.lit(".25")).alias("longitude"),
        F.when(key % 10 == 0, "N/A").otherwise(_dollars("c_acctbal")).alias("per_capita_income"),
        _dollars(F.col("c_acctbal") * 10).alias("yearly_income"),
        _dollars("c_acctbal").alias("total_debt"),
        _s(key % 550 + 300).alias("credit_score"),
        _s(key % 5 + 1).alias("num_credit_cards"),
    )


def mcc_object(spark: SparkSession, sf: str) -> DataFrame:
    """The category file: one JSON object whose keys are codes. There are as
    many keys as part sizes, fifty."""
    pair = F.struct(
        _s("p_size").alias("key"), F.concat(F.lit(" size "), _s("p_size")).alias("value")
    )
    sizes = table(spark, sf, "part").select(pair.alias("e")).distinct()
    return sizes.agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value"))

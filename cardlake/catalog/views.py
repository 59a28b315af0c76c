"""Card data over the test tables.

The driver's tables are an order schema; these views read them as bronze card
data: line items are transactions, customers users, suppliers cards, part sizes
merchant categories, events job logs and files. Only expressions over the given
tables, so the work grows with them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.plans import gold, silver, warehouse
from cardlake.session import checkpoint_dir
from cardlake.sources import writers

RUN_ID = "run-1"
CALENDAR = ("1995-01-01", "2001-06-30")
# What the measures, aggregates and controls read of the warehouse fact. Ids, texts and
# hashes are most of a row's bytes, and no measure asks for them.
MEASURED = [
    "date_key", "user_key", "card_key", "mcc_key", "txn_date", "txn_month", "amount", "currency",
    "is_success", "is_chip_used", "merchant_id", "gold_load_ts",
]
# What the reconciliation reads of the gold fact.
RECONCILED = ["transaction_id", "txn_month", "amount"]
# Latest version of a transaction among equal ingestion times.
TXN_TIES = ["merchant_id", "card_id", "abs(amount)"]
LOAD_TS = "2001-07-01 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _technical(entity: str, ts: Column) -> dict[str, Column]:
    return {
        "source_file": F.lit(f"landing/{entity.lower()}"),
        "ingestion_date": F.to_date(ts),
        "ingestion_ts": ts,
        "entity": F.lit(entity),
    }


def bronze_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line item. Ids repeat, so de-duplication has work to do."""
    line = table(spark, sf, "lineitem")
    failed = (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 45)
    returned = F.col("l_returnflag") == "R"
    # What is made of a line alone is made before the joins, so these deal fewer columns.
    usage = F.when(F.col("l_linenumber") == 7, 0).when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
    lines = line.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate",
        F.when(returned, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("amount"),
        usage.otherwise(3).alias("usage"),
        F.when(failed, 1).alias("errors"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_brand", "p_type")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    numbered = sold.withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber")).drop("l_orderkey", "o_orderkey", "l_linenumber")
    df = numbered.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    ts = F.col("l_shipdate").cast("timestamp")
    names = F.when(F.col("usage") == 1, "CHIP TRANSACTION").when(F.col("usage") == 2, "ONLINE TRANSACTION")
    return df.select(
        "id",
        ts.alias("date"),
        F.col("o_custkey").alias("client_id"),
        F.col("l_suppkey").alias("card_id"),
        "amount",
        names.when(F.col("usage") == 3, "SWIPE TRANSACTION").alias("use_chip"),
        F.col("l_partkey").alias("merchant_id"),
        F.upper("p_brand").alias("merchant_city"),
        F.upper("p_type").alias("merchant_state"),
        F.lpad((F.col("l_partkey") % 100000).cast("string"), 5, "0").alias("zip"),
        F.col("p_size").alias("mcc"),
        "errors",
        *[c.alias(n) for n, c in _technical("TRANSACTION", ts).items()],
    )


def bronze_users(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")

    def spread(low: int, n: int) -> Column:
        return (key % n + low).cast("int")

    return table(spark, sf, "customer").select(
        key.alias("id"),
        spread(18, 70).alias("current_age"),
        spread(60, 10).alias("retirement_age"),
        spread(1940, 60).alias("birth_year"),
        spread(1, 12).alias("birth_month"),
        F.when(key % 2 == 0, "female").otherwise("male").alias("gender"),
        F.col("c_name").alias("address"),
        (key % 180 - 90).cast("double").alias("latitude"),
        (key % 360 - 180).cast("double").alias("longitude"),
        F.abs("c_acctbal").alias("per_capita_income"),
        F.col("c_acctbal").alias("yearly_income"),
        F.col("c_acctbal").alias("total_debt"),
        spread(300, 550).alias("credit_score"),
        spread(1, 5).alias("num_credit_cards"),
        *[c.alias(n) for n, c in _technical("USER", _ts(LOAD_TS)).items()],
    )


def bronze_cards(spark: SparkSession, sf: str) -> DataFrame:
    key, text = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    brands = F.array(*[F.lit(b) for b in ("Visa", "Mastercard", "Amex", "Discover")])
    month = F.lpad((key % 12 + 1).cast("string"), 2, "0")
    return table(spark, sf, "supplier").select(
        key.alias("id"),
        F.when(key % 10 != 3, key).alias("client_id"),
        F.element_at(brands, (F.col("s_nationkey") % 4 + 1).cast("int")).alias("card_brand"),
        F.when(key % 2 == 0, " debit").otherwise("credit ").alias("card_type"),
        F.concat(F.lit("4"), F.lpad(text, 15, "0")).alias("card_number"),
        F.concat(month, F.when(key % 3 == 0, F.lit("/2022")).otherwise(F.lit("/23"))).alias("expires"),
        F.lpad((key % 1000).cast("string"), 3, "0").alias("cvv"),
        F.when(key % 3 != 0, "Yes").otherwise("n").alias("has_chip"),
        (key % 3 + 1).cast("int").alias("num_cards_issued"),
        F.col("s_acctbal").alias("credit_limit"),
        F.concat(month, F.lit("/"), (key % 20 + 2000).cast("string")).alias("acct_open_date"),
        (key % 20 + 2000).cast("int").alias("year_pin_last_changed"),
        F.when(key % 20 == 1, "YES").otherwise("NO").alias("card_on_dark_web"),
        *[c.alias(n) for n, c in _technical("CARD", _ts(LOAD_TS)).items()],
    )


def bronze_mcc(spark: SparkSession, sf: str) -> DataFrame:
    """A category per part size, once per part: many duplicates, one code each."""
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        size.alias("mcc"),
        F.concat(F.lit(" SIZE "), size.cast("string")).alias("mcc_description"),
        *[c.alias(n) for n, c in _technical("MCC", _ts(LOAD_TS)).items()],
    )


def bronze_fx(spark: SparkSession, sf: str) -> DataFrame:
    """Rates quoted by order: the currency from its customer, the day from its
    date, so most (currency, day) pairs have several quotes of different age."""
    code = F.format_string("c%02d", F.col("o_custkey") % 25)
    quoted = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=F.lit(0), secs=F.col("o_orderkey") % 86400)
    return table(spark, sf, "orders").select(
        code.alias("currency"),
        F.lit(" eur").alias("base_currency"),
        F.concat(F.lit("Currency "), code).alias("currency_name"),
        (F.col("o_totalprice") / 1000).alias("rate_vs_usd"),
        F.to_date("o_orderdate").alias("date"),
        *[c.alias(n) for n, c in _technical("FX", quoted).items()],
    )


# --- silver and gold over the views -----------------------------------------


def silver_transactions(spark: SparkSession, sf: str, hashed: bool = True) -> DataFrame:
    return silver.silver_transactions(bronze_transactions(spark, sf), tie_break=TXN_TIES, hashed=hashed)


def silver_users(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_users(bronze_users(spark, sf))


def silver_cards(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_cards(bronze_cards(spark, sf))


def silver_mcc(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_mcc(bronze_mcc(spark, sf))


def silver_fx(spark: SparkSession, sf: str) -> DataFrame:
    ties = ["rate"]
    return silver.silver_fx(bronze_fx(spark, sf), tie_break=ties)


def gold_users(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_user(silver_users(spark, sf), RUN_ID, _ts(LOAD_TS))


def gold_mcc(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_mcc(silver_mcc(spark, sf), RUN_ID, _ts(LOAD_TS))


def gold_cards(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return gold.dim_card(silver_cards(spark, sf), known_users(gold_users(spark, sf)), RUN_ID, _ts(LOAD_TS))


# Conformance sees dimensions with gaps, so that facts and cards have orphans.
def known_users(users: DataFrame) -> DataFrame:
    return users.where(F.col("client_id") % 50 != 0)


def known_mcc(mcc: DataFrame) -> DataFrame:
    return mcc.where(F.col("mcc_code").cast("int") % 13 != 0)


def fact_dims(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Users, cards and categories that the fact must conform to."""
    users, cards, mcc = (stored_gold(spark, sf, n) for n in ("users", "cards", "mcc"))
    return [known_users(users), cards, known_mcc(mcc)]


def gold_dates(spark: SparkSession) -> DataFrame:
    return gold.dim_date(spark, *CALENDAR, RUN_ID, _ts(LOAD_TS))


def gold_fact(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(fact, events) from the raw lines. The load time follows the
    transaction, so freshness differs by month."""
    return gold.fact_transactions(
        silver_transactions(spark, sf, hashed=False),
        *fact_dims(spark, sf),
        gold_dates(spark),
        RUN_ID,
        F.col("txn_ts"),
        TXN_TIES,
    )


def warehouse_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Warehouse fact from the raw lines."""
    return warehouse.wh_fact(gold_fact(spark, sf)[0], stored_dims(spark, sf))


# --- stored tables ----------------------------------------------------------

# Gold and warehouse are tables that later steps read, so a session writes each
# of them once per data set, to the shared checkpoint folder.
_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf: str, name: str, make, partition_by=()) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        path = f"{checkpoint_dir(spark)}/views/{key[0]}/{hashlib.md5(sf.encode()).hexdigest()}/{name}"
        writers.overwrite(make(), path, partition_by)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def stored_gold(spark: SparkSession, sf: str, name: str) -> DataFrame:
    makers = {
        "users": lambda: gold_users(spark, sf),
        "cards": lambda: gold_cards(spark, sf)[0],
        "mcc": lambda: gold_mcc(spark, sf),
    }
    return _stored(spark, sf, f"gold_{name}", makers[name])


def stored_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Id, month and amount of each row of the gold fact, for the reconciliation, which
    reads them twice. Written as they come: no row is dealt by month."""
    return _stored(spark, sf, "gold_amounts", lambda: gold_fact(spark, sf)[0].select(*RECONCILED))


def stored_dims(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    sources = {
        "dim_user": lambda: stored_gold(spark, sf, "users"),
        "dim_card": lambda: stored_gold(spark, sf, "cards"),
        "dim_mcc": lambda: stored_gold(spark, sf, "mcc"),
        "dim_date": lambda: gold_dates(spark),
    }
    return {
        name: _stored(spark, sf, name, lambda n=name, s=source: warehouse.wh_dim(s(), n))
        for name, source in sources.items()
    }


def measured_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The warehouse fact, where sixth lines have no known outcome."""
    sixth = F.col("transaction_id").endswith("6")
    return warehouse_fact(spark, sf).withColumn("is_success", F.when(~sixth, F.col("is_success")))


def stored_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of the fact that are measured, by month. They come straight from
    the raw lines: no wide table is written on the way."""

    def make() -> DataFrame:
        return measured_fact(spark, sf).select(*MEASURED)

    return _stored(spark, sf, "fact_transactions", make, ("txn_month",))


def stored_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Month and id of each row of the fact, for controls that read them several times."""
    return _stored(spark, sf, "fact_ids", lambda: measured_fact(spark, sf).select("txn_month", "transaction_id"))

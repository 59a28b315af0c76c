"""Silver: one clean row per natural key.

Each builder is bronze frame in, silver frame out: structure check, casts,
latest row per key, record hash, canonical columns. The hash is taken after
de-duplication, so dropped rows are never hashed and the shuffle does not carry
the digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.functions.hashing import add_record_hash
from cardlake.operators import quality as Q
from cardlake.operators.dedup import dedup_latest
from cardlake.operators.projection import add_tech_columns
from cardlake.plans import contracts as K
from cardlake.plans.bronze import BATCH, ENTITIES
from cardlake.session import shuffles_freed
from cardlake.sources import versions, writers

# The business columns behind each record hash, in hash order.
HASH_COLUMNS = {
    "silver_transactions": [
        "transaction_id", "txn_ts", "txn_date", "txn_month", "client_id", "card_id", "merchant_id",
        "mcc_code", "amount", "use_chip", "merchant_city", "merchant_state", "zip", "error_code",
        "is_success",
    ],
    "silver_users": [
        "client_id", "current_age", "retirement_age", "birth_year", "birth_month", "gender",
        "address", "latitude", "longitude", "per_capita_income", "yearly_income", "total_debt",
        "credit_score", "num_credit_cards",
    ],
    "silver_cards": [
        "card_id", "client_id", "card_brand", "card_type", "card_number", "expires_raw",
        "expires_month", "cvv", "has_chip", "num_cards_issued", "credit_limit", "acct_open_date",
        "year_pin_last_changed", "card_on_dark_web",
    ],
    "silver_fx_rates": ["currency", "base_currency", "fx_date", "rate"],
    "silver_mcc": ["mcc_code", "mcc_description"],
}


def _require(df: DataFrame, entity: str, exact: bool) -> DataFrame:
    expected = ENTITIES[entity].contract
    df = df.drop(BATCH)
    Q.require_columns(df, expected.names, expected.table)
    return Q.forbid_extra_columns(df, expected.names, expected.table) if exact else df


def _finish(
    df: DataFrame, c: K.Contract, order: str, tie_break: Sequence[str | Column] | None,
    derived: dict[str, Column] | None = None, hashed_rows: bool = True,
) -> DataFrame:
    """Latest rows with their hash. ``derived`` columns are made of the others, for the
    ranking and once more behind it, so the shuffle carries those that rank alone."""
    df = add_tech_columns(df).withColumns(derived or {})
    hashed = HASH_COLUMNS[c.table]
    ties = [F.xxhash64(*hashed, "source_file")] if tie_break is None else tie_break
    latest = dedup_latest(df, c.keys, order, ties)
    latest = latest.withColumns(derived or {})
    if not hashed_rows:
        return latest.select(*[n for n in c.names if n != "record_hash"])
    return add_record_hash(latest, hashed).select(*c.names)


def silver_transactions(
    bronze: DataFrame,
    errors_mode: str = "numeric",
    order: str = "ingestion_ts",
    tie_break: Sequence[str | Column] | None = None,
    hashed: bool = True,
) -> DataFrame:
    """Without ``hashed`` the record hash is left out: whoever shuffles the rows once more
    takes it behind that shuffle (``gold.fact_transactions``)."""
    df = _require(bronze, "TRANSACTION", exact=True)
    error = C.error_code("errors", errors_mode)
    ts = F.col("date").cast("timestamp")
    df = df.select(
        F.col("id").cast("bigint").alias("transaction_id"),
        ts.alias("txn_ts"),
        F.col("client_id").cast("bigint").alias("client_id"),
        F.col("card_id").cast("bigint").alias("card_id"),
        F.col("merchant_id").cast("bigint").alias("merchant_id"),
        C.mcc_code("mcc").alias("mcc_code"),
        C.to_decimal("amount").alias("amount"),
        "use_chip",
        "merchant_city",
        "merchant_state",
        F.col("zip").cast("string").alias("zip"),
        error.alias("error_code"),
        "source_file",
        "ingestion_date",
        "ingestion_ts",
    )
    day = F.to_date("txn_ts")
    derived = {"txn_date": day, "txn_month": C.month_start(day), "is_success": F.col("error_code") == 0}
    return _finish(df, K.SILVER_TRANSACTIONS, order, tie_break, derived, hashed)


def silver_users(
    bronze: DataFrame, order: str = "ingestion_ts", tie_break: Sequence[str | Column] | None = None
) -> DataFrame:
    df = _require(bronze, "USER", exact=True).withColumnRenamed("id", "client_id")
    df = df.withColumns(
        {
            "client_id": F.col("client_id").cast("bigint"),
            "gender": C.clean_text("gender"),
            "address": C.clean_text("address"),
            "latitude": C.to_decimal("latitude", 9, 6),
            "longitude": C.to_decimal("longitude", 9, 6),
            **{c: C.to_decimal(c) for c in ("per_capita_income", "yearly_income", "total_debt")},
        }
    )
    return _finish(df, K.SILVER_USERS, order, tie_break)


def silver_cards(
    bronze: DataFrame, order: str = "ingestion_ts", tie_break: Sequence[str | Column] | None = None
) -> DataFrame:
    df = _require(bronze, "CARD", exact=True)
    df = df.withColumnsRenamed({"id": "card_id", "expires": "expires_raw"}).withColumns(
        {
            "card_id": F.col("card_id").cast("bigint"),
            "client_id": F.col("client_id").cast("bigint"),
            "card_brand": C.clean_text("card_brand"),
            "card_type": C.clean_text("card_type"),
            "has_chip": C.bool_yn("has_chip"),
            "card_on_dark_web": C.bool_yn("card_on_dark_web"),
            "credit_limit": C.to_decimal("credit_limit"),
            "acct_open_date": C.date_multi("acct_open_date"),
            "expires_month": C.expiry_month("expires_raw"),
        }
    )
    return _finish(df, K.SILVER_CARDS, order, tie_break)


def silver_mcc(
    bronze: DataFrame, order: str = "ingestion_ts", tie_break: Sequence[str | Column] | None = None
) -> DataFrame:
    df = Q.require_columns(
        bronze, ["mcc", "mcc_description", "source_file", "ingestion_ts", "ingestion_date"], "bronze_mcc_raw"
    )
    df = df.withColumns({"mcc_code": C.mcc_code("mcc"), "mcc_description": F.trim("mcc_description")})
    return _finish(df, K.SILVER_MCC, order, tie_break)


def silver_fx(
    bronze: DataFrame, order: str = "ingestion_ts", tie_break: Sequence[str | Column] | None = None
) -> DataFrame:
    df = _require(bronze, "FX", exact=False)
    df = df.withColumnsRenamed({"date": "fx_date", "rate_vs_usd": "rate"}).withColumns(
        {
            "currency": C.currency_code("currency"),
            "base_currency": C.currency_code("base_currency"),
            "fx_date": F.to_date("fx_date"),
            "fx_month": C.month_start(F.to_date("fx_date")),
            "rate": C.to_decimal("rate", 18, 8),
        }
    )
    return _finish(df, K.SILVER_FX, order, tie_break)


# --- checks of each table ---------------------------------------------------


def fx_checks(expected_base: str = "EUR") -> list[Q.Check]:
    return [
        Q.equals("base_currency", expected_base, f"base_currency_is_{expected_base}"),
        *Q.not_null(["base_currency", "currency", "fx_date"], "natural_keys_not_null"),
        *Q.partition_ok(["fx_month"], K.SILVER_FX.max_partitions),
    ]


def user_checks() -> list[Q.Check]:
    return Q.not_null(["client_id"])


def card_checks() -> list[Q.Check]:
    return Q.not_null(["card_id", "client_id"])


def mcc_checks() -> list[Q.Check]:
    return [
        *Q.not_null(["mcc_code"]),
        Q.matches("mcc_code", "^[0-9]{4}$", "mcc_code_is_4_digits"),
    ]


def transaction_checks() -> list[Q.Check]:
    return [
        *Q.not_null(["transaction_id", "txn_ts", "txn_month", "amount", "mcc_code"]),
        *Q.not_null(["client_id", "card_id", "merchant_id"], "required_business_keys_not_null"),
        *Q.not_null(["error_code"]),
        *Q.partition_ok(["txn_month"], K.SILVER_TRANSACTIONS.max_partitions),
    ]


_BUILDERS = {
    "MCC": (silver_mcc, K.SILVER_MCC, mcc_checks),
    "USER": (silver_users, K.SILVER_USERS, user_checks),
    "CARD": (silver_cards, K.SILVER_CARDS, card_checks),
    "FX": (silver_fx, K.SILVER_FX, fx_checks),
    "TRANSACTION": (silver_transactions, K.SILVER_TRANSACTIONS, transaction_checks),
}


def build_silver(
    bronze: DataFrame,
    entity: str,
    path: str,
    run_id: str,
    incremental: bool = False,
    checks: Sequence[Q.Check] | None = None,
    **options,
) -> dict:
    """Load one silver table and return its counts.

    A full load replaces the table. An incremental load keeps the latest row of
    each natural key, in whatever partition its older version stands, rewrites
    the partitions concerned and never the rest. Rows are dealt by key alone and
    written as they lie, so a task has a file for each partition it has rows of.
    """
    make, c, default_checks = _BUILDERS[entity.strip().upper()]
    checks = default_checks() if checks is None else checks
    spark = bronze.sparkSession
    arrived = Observation(f"{c.table}-in-{run_id}")
    fresh = make(bronze.observe(arrived, F.count(F.lit(1)).alias("row_in")), **options)
    zone_key = c.keys[0] if c.partition_by else None
    if not (incremental and writers.table_exists(spark, path)):
        counts = writers.publish(fresh, path, c.table, c.partition_by, checks, zone_key=zone_key, gather=False)
        kept = counts["row_out"]
    else:
        fresh, seen = writers.stage(
            fresh, f"{c.table}-fresh", run_id, c.partition_by, {"kept": F.count(F.lit(1))}
        )
        kept, base = seen["kept"], versions.current(spark, path)
        touched = key_partitions(spark, path, base, c, fresh) if c.partition_by else None
        merged = newest_rows(versions.read(spark, path, c.schema, touched, base), fresh, c.keys)
        counts = writers.publish(merged, path, c.table, c.partition_by, checks, whole=False, touched=touched or (), base=base, zone_key=zone_key, gather=False)
    row_in = arrived.get["row_in"]
    return {"row_in": row_in, "dedup_dropped": row_in - kept, **counts}


def key_partitions(spark: SparkSession, path: str, at: versions.Version, c: K.Contract, fresh: DataFrame) -> list[str]:
    """Names of the partitions that fresh rows go to, or that hold their keys now.

    A corrected row may change its month. Each partition's range of keys is part
    of the table's version, so only partitions whose range has a fresh key are
    asked: of these, a semi join reads the key column. Ids that grow with time
    lead to few partitions, ids without any order to all of them.
    """
    column, key = c.partition_by[0], c.keys[0]
    asked = versions.holding(spark, at, fresh.select(key), key)
    going = fresh.select(F.col(column).cast("string").alias("p"))
    if asked:
        held = versions.read(spark, path, c.schema, asked, at).select(*dict.fromkeys([*c.keys, column]))
        found = held.join(fresh.select(*c.keys).distinct(), list(c.keys), "left_semi")
        going = going.union(found.select(F.col(column).cast("string")))
    # Partition values are limited by contract.
    with shuffles_freed(spark):
        return sorted({versions.part_name(column, r.p) for r in going.distinct().collect()})


def newest_rows(target: DataFrame, fresh: DataFrame, keys: Sequence[str], order: str = "ingestion_ts") -> DataFrame:
    """One row per key: the latest of both sides, the fresh one if they are equally old."""
    both = target.withColumn("__fresh", F.lit(0)).unionByName(fresh.withColumn("__fresh", F.lit(1)))
    if "record_hash" not in both.columns:
        return dedup_latest(both, keys, order, ["__fresh"]).drop("__fresh")
    # Hashes are dealt as bytes, half as long as their digits.
    latest = dedup_latest(both.withColumn("record_hash", F.unhex("record_hash")), keys, order, ["__fresh"])
    return latest.withColumn("record_hash", F.lower(F.hex("record_hash"))).drop("__fresh")

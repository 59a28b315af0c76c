"""Warehouse: surrogate keys, upserted star, daily and monthly aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.functions.hashing import bit, warehouse_hash
from cardlake.operators.projection import month_scope
from cardlake.operators.upsert import (
    ACTION,
    DELETED,
    INSERTED,
    UNCHANGED,
    action_metrics,
    assign_surrogate,
    merge_rows,
    merged_table,
)
from cardlake.plans import contracts as K
from cardlake.plans.silver import key_partitions
from cardlake.sources import versions, writers

# Fixed values.
CURRENCY = "USD"
AGGREGATE_MEASURES = [
    "txn_count_total",
    "txn_count_success",
    "txn_count_failed",
    "txn_count_unknown",
    "amount_sum_total",
    "amount_sum_success",
    "amount_sum_failed",
    "amount_sum_unknown",
    "amount_abs_sum_total",
    "amount_avg_success",
    "amount_min",
    "amount_max",
    "txn_count_chip_used",
    "amount_sum_chip_used",
]
DAILY_KEYS = ["date_key", "user_key", "card_key", "mcc_key", "currency", "txn_date", "txn_month"]
MONTHLY_KEYS = ["txn_month", "user_key", "card_key", "mcc_key", "currency"]


# --- dimensions -------------------------------------------------------------


def card_source(gold: DataFrame) -> DataFrame:
    return gold.select(
        C.varchar("card_id", 64).alias("card_id"),
        C.varchar("client_id", 64).alias("client_id"),
        C.varchar("card_brand", 50).alias("card_brand"),
        C.varchar("card_type", 50).alias("card_type"),
        "has_chip",
        "credit_limit",
        "num_cards_issued",
        "card_on_dark_web",
        C.varchar("record_hash", 64).alias("record_hash"),
    )


def user_source(gold: DataFrame) -> DataFrame:
    return gold.select(
        C.varchar("client_id", 64).alias("client_id"),
        "current_age",
        "yearly_income",
        "total_debt",
        "credit_score",
        C.varchar("address", 500).alias("address"),
        C.varchar("record_hash", 64).alias("record_hash"),
    )


def mcc_source(gold: DataFrame) -> DataFrame:
    return gold.select(
        F.col("mcc_code").try_cast("int").alias("mcc_code"),
        C.varchar("mcc_description", 200).alias("mcc_description"),
        F.lit(None).cast("string").alias("mcc_category"),
        C.varchar("record_hash", 64).alias("record_hash"),
    )


def date_source(gold: DataFrame) -> DataFrame:
    df = gold.select(
        "date_id",
        F.col("date_value").alias("full_date"),
        F.col("year_number").alias("year"),
        F.col("quarter_number").alias("quarter"),
        F.col("month_number").alias("month"),
        F.col("week_of_year").alias("week"),
        F.col("day_of_week_iso").alias("day_of_week"),
        "is_weekend",
        (~F.col("is_weekend")).alias("is_business_day"),
    )
    parts = ["date_id", F.date_format("full_date", "yyyy-MM-dd"), "year", "quarter", "month", "week",
             "day_of_week", bit("is_weekend")]
    return df.withColumn("record_hash", warehouse_hash(parts))


# table -> (contract, source projection, columns never changed by an update)
_DIMENSIONS = {
    "dim_card": (K.WH_DIM_CARD, card_source, ("card_key",)),
    "dim_user": (K.WH_DIM_USER, user_source, ("user_key",)),
    "dim_mcc": (K.WH_DIM_MCC, mcc_source, ("mcc_key", "mcc_category")),
    "dim_date": (K.WH_DIM_DATE, date_source, ("date_key",)),
}


def dim_rows(gold: DataFrame, table: str, target: DataFrame | None = None, projected: bool = False) -> DataFrame:
    """The refreshed dimension with the action taken on each row.

    New members get the next surrogate keys, changed ones (by hash) are
    overwritten in place, the rest stay. A row without a natural key is no
    member: it would match nothing and come in anew with every load. ``gold`` may
    be ``projected`` to the source's columns already.
    """
    c, project, keep = _DIMENSIONS[table]
    if target is None:
        target = K.empty_table(gold.sparkSession, c)
    key, natural = c.names[0], c.keys[0]
    members = (gold if projected else project(gold)).where(F.col(natural).isNotNull())
    source = assign_surrogate(target, members, natural, key)
    return merge_rows(target.select(*c.names), source.select(*c.names), [natural], "record_hash", keep)


def wh_dim(gold: DataFrame, table: str, target: DataFrame | None = None) -> DataFrame:
    return K.project_to_contract(merged_table(dim_rows(gold, table, target)), _DIMENSIONS[table][0])


def dim_month(dates: DataFrame) -> DataFrame:
    """One row per month of the calendar."""
    first = F.make_date("year", "month", F.lit(1))
    months = dates.select(
        F.col("year_number").alias("year"), F.col("month_number").alias("month")
    ).distinct()
    return months.select(
        first.alias("month_start"),
        "year",
        "month",
        (F.col("year") * 100 + F.col("month")).alias("yyyymm"),
        C.month_label(first).alias("month_label"),
    )


def month_rows(dates: DataFrame, target: DataFrame) -> DataFrame:
    """dim_month refreshed: missing months inserted, differing ones updated."""
    names = K.WH_DIM_MONTH.names
    return merge_rows(
        target.select(*names), dim_month(dates), ["month_start"], compare_cols=names[1:]
    )


# --- fact -------------------------------------------------------------------


def _typed_member(dim: DataFrame, key: str, natural: str, fact: DataFrame, name: str) -> DataFrame:
    """Surrogate keys by natural key in the fact's type. Only members whose text is
    just how that type prints: others equal no key of the fact as text either."""
    typed = F.col(natural).try_cast(fact.schema[natural].dataType)
    return dim.where(typed.cast("string") == F.col(natural)).select(key, typed.alias(name))


def wh_fact(gold: DataFrame, dims: dict[str, DataFrame], month: str | None = None) -> DataFrame:
    """Gold fact rows with surrogate keys; rows without all four drop out.

    No dimension carries a hint: below the size threshold Spark broadcasts it,
    otherwise it joins by shuffle and splits skewed partitions at run time.
    ``rows_without_key`` counts what drops out.

    User and card are matched in the type that the fact has them in. So a fact
    that was dealt by client to conform it is not dealt again here.
    """
    f = month_scope(gold, month)
    dates = dims["dim_date"].select("date_key", "date_id")
    mcc = dims["dim_mcc"].select("mcc_key", F.col("mcc_code").alias("__mcc"))
    users = _typed_member(dims["dim_user"], "user_key", "client_id", f, "__client")
    cards = _typed_member(dims["dim_card"], "card_key", "card_id", f, "__card")
    joined = (
        f.join(dates, C.date_id("txn_date") == F.col("date_id"))
        .join(mcc, F.col("mcc_code").try_cast("int") == F.col("__mcc"))
        .join(users, F.col("client_id") == F.col("__client"))
        .join(cards, F.col("card_id") == F.col("__card"))
    )
    return joined.select(
        C.varchar("transaction_id", 64).alias("transaction_id"),
        "date_key",
        "user_key",
        "card_key",
        "mcc_key",
        "txn_date",
        "txn_month",
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        F.lit(CURRENCY).alias("currency"),
        "is_success",
        C.varchar("error_code", 50).alias("error_code"),
        "is_chip_used",
        "merchant_id",
        F.lit(None).cast("string").alias("merchant_name"),
        C.varchar("merchant_city", 100).alias("merchant_city"),
        C.varchar("merchant_state", 50).alias("merchant_state"),
        C.varchar("zip", 20).alias("merchant_zip"),
        C.varchar("record_hash", 64).alias("record_hash"),
        "gold_load_ts",
    )


def rows_without_key(gold: DataFrame, dims: dict[str, DataFrame], month: str | None = None) -> DataFrame:
    """Gold rows per dimension that lack a member there: dimension, row_count.

    Rows are counted per natural key before the join. A NULL key has no member.
    """
    keys = {
        "dim_date": (C.date_id("txn_date"), "date_id"), "dim_mcc": (F.col("mcc_code").try_cast("int"), "mcc_code"),
        "dim_user": (F.col("client_id"), "client_id"), "dim_card": (F.col("card_id"), "card_id"),
    }
    own = [F.struct(F.lit(d).alias("dimension"), k.cast("string").alias("member")) for d, (k, _) in keys.items()]
    each = month_scope(gold, month).select(F.inline(F.array(*own)))
    counted = each.groupBy("dimension", "member").agg(F.count(F.lit(1)).alias("n"))
    known = [dims[d].select(F.lit(d).alias("__d"), F.col(c).cast("string").alias("__m")) for d, (_, c) in keys.items()]
    members = known[0].unionByName(known[1]).unionByName(known[2]).unionByName(known[3])
    same = (F.col("dimension") == F.col("__d")) & (F.col("member") == F.col("__m"))
    lacking = F.coalesce(F.sum(F.when(F.col("__d").isNull(), F.col("n"))), F.lit(0)).cast("bigint")
    return counted.join(members, same, "left").groupBy("dimension").agg(lacking.alias("row_count"))


# --- aggregates -------------------------------------------------------------


def _money_sum(amount: Column) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(18,2)")


def measure_columns() -> dict[str, Column]:
    """The fourteen measures. An unknown outcome is NULL, a missing amount adds
    nothing; the average, minimum and maximum ignore missing amounts."""
    ok, amount, chip = F.col("is_success"), F.col("amount"), F.col("is_chip_used")
    won = F.when(ok, amount)
    return {
        "txn_count_total": F.count(F.lit(1)),
        "txn_count_success": F.count_if(ok),
        "txn_count_failed": F.count_if(~ok),
        "txn_count_unknown": F.count_if(ok.isNull()),
        "amount_sum_total": _money_sum(amount),
        "amount_sum_success": _money_sum(won),
        "amount_sum_failed": _money_sum(F.when(~ok, amount)),
        "amount_sum_unknown": _money_sum(F.when(ok.isNull(), amount)),
        "amount_abs_sum_total": _money_sum(F.abs(amount)),
        "amount_avg_success": (F.sum(won) / F.nullif(F.count(won), F.lit(0))).cast("decimal(18,2)"),
        "amount_min": F.min(amount).cast("decimal(18,2)"),
        "amount_max": F.max(amount).cast("decimal(18,2)"),
        "txn_count_chip_used": F.count_if(chip),
        "amount_sum_chip_used": _money_sum(F.when(chip, amount)),
    }


def aggregate_fact(fact: DataFrame, keys: Sequence[str], run_id: str | None = None) -> DataFrame:
    """Measures per key with the latest load time and a hash of the measures.

    Partial sums are taken before the shuffle, so a hot key costs one row per
    task; the hash is computed once per group, after the sums.
    """
    measured = fact.groupBy(*keys).agg(
        *[c.alias(n) for n, c in measure_columns().items()],
        F.max("gold_load_ts").alias("gold_load_ts_max"),
    )
    return measured.withColumns(
        {
            "aggregate_hash": warehouse_hash(AGGREGATE_MEASURES),
            "run_id_last": F.lit(run_id).cast("string"),
        }
    )


def fact_daily(fact: DataFrame, run_id: str | None = None) -> DataFrame:
    return aggregate_fact(fact, DAILY_KEYS, run_id)


def fact_monthly(fact: DataFrame, run_id: str | None = None) -> DataFrame:
    return aggregate_fact(fact, MONTHLY_KEYS, run_id)


def group_counts(aggregate: DataFrame) -> DataFrame:
    """Groups per month: the source rows an aggregate load reports."""
    return aggregate.groupBy("txn_month").agg(F.count(F.lit(1)).alias("group_count"))


# --- loads ------------------------------------------------------------------

_SLICES = {
    "fact_transactions": (K.WH_FACT, "record_hash"),
    "fact_transactions_daily": (K.WH_FACT_DAILY, "aggregate_hash"),
    "fact_transactions_monthly": (K.WH_FACT_MONTHLY, "aggregate_hash"),
}


def refresh_slice(
    source: DataFrame, table: str, path: str, run_id: str, delete_missing: bool = False
) -> dict:
    """Upsert ``source`` into the months it touches, other months untouched.

    A row whose month has changed leaves the month it stood in. With
    ``delete_missing``, rows that the source lacks go from the source's own
    months only. The source is evaluated once. The merged months are written
    once, with their counts, and committed if anything has changed; running it
    again from the result changes nothing.
    """
    c, hash_col = _SLICES[table]
    spark, base = source.sparkSession, versions.current(source.sparkSession, path)
    zone = (c.partition_by[0], c.keys[0])
    if not base.parts:
        # Nothing to merge with: the rows are written as they come.
        rows = K.project_to_contract(source, c).withColumn(ACTION, F.lit(INSERTED))
        counts = _publish_merged(rows, path, base, c, partition_by=c.partition_by, whole=False, zone=zone)
        return {"rows_source": counts["rows_inserted"], **counts}
    fresh, seen = writers.stage(
        K.project_to_contract(source, c), f"{table}-source", run_id, c.partition_by,
        {"rows_source": F.count(F.lit(1))},
    )
    touched = key_partitions(spark, path, base, c, fresh)
    target = versions.read(spark, path, c.schema, touched, base).select(*c.names)
    rows = merge_rows(target, fresh, c.keys, hash_col)
    if delete_missing:
        own = fresh.select("txn_month").distinct().withColumn("__own", F.lit(True))
        gone = (F.col(ACTION) == UNCHANGED) & F.col("__own") & F.col("__absent")
        there = fresh.select(*c.keys).distinct().withColumn("__there", F.lit(True))
        rows = rows.join(own, "txn_month", "left").join(there, list(c.keys), "left").withColumn("__absent", F.col("__there").isNull())
        rows = rows.withColumn(ACTION, F.when(gone, DELETED).otherwise(F.col(ACTION))).select(*c.names, ACTION)
    counts = _publish_merged(rows, path, base, c, partition_by=c.partition_by, whole=False, emptied=touched, zone=zone)
    return {**seen, **counts}


def _publish_merged(
    rows: DataFrame, path: str, base: versions.Version, c: K.Contract, partition_by: Sequence[str] = (),
    whole: bool = True, emptied: Sequence[str] = (), zone: tuple[str, str] | None = None,
) -> dict:
    """Write merged rows once, as they lie, with their counts; commit them unless nothing has changed."""
    spark = rows.sparkSession
    kept = F.col(ACTION) != DELETED
    load, counts = versions.write(rows, path, partition_by, action_metrics(), keep=kept, gather=False)
    if counts["rows_inserted"] or counts["rows_updated"] or counts["rows_deleted"]:
        known = versions.zones(versions.load_rows(spark, path, load, c.schema), *zone) if zone else None
        versions.publish_load(spark, path, base, load, whole, emptied, alone=True, zones=known)
    else:
        versions.discard(spark, path, load)
    return counts


def refresh_dimension(gold: DataFrame, table: str, path: str, run_id: str) -> dict:
    """Upsert one dimension.

    The source is projected once, into a staging table: missing keys, numbering
    and merging read that. ``rows_without_key`` counts source rows that have no
    natural key.
    """
    c, project, _ = _DIMENSIONS[table]
    spark, base = gold.sparkSession, versions.current(gold.sparkSession, path)
    nameless = F.count_if(F.col(c.keys[0]).isNull())
    source, seen = writers.stage(project(gold), f"{table}-source", run_id, (), {"rows_without_key": nameless})
    rows = dim_rows(source, table, versions.read(spark, path, c.schema, version=base), projected=True)
    return {**_publish_merged(rows, path, base, c), **seen}


def refresh_months(dates: DataFrame, path: str, run_id: str) -> dict:
    c, spark = K.WH_DIM_MONTH, dates.sparkSession
    base = versions.current(spark, path)
    return _publish_merged(month_rows(dates, versions.read(spark, path, c.schema, version=base)), path, base, c)

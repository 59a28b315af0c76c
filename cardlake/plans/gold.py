"""Gold: the star schema, with orphan rows split off into anomaly events."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.functions.hashing import record_hash
from cardlake.operators import quality as Q
from cardlake.operators.conform import (
    FAILED_RULE,
    Rule,
    anomaly_kpis,
    conforming,
    orphan_events,
    orphan_keys,
    tag_orphans,
)
from cardlake.operators.dedup import dedup_latest
from cardlake.operators.projection import add_gold_audit, require_text
from cardlake.plans import contracts as K
from cardlake.plans.silver import HASH_COLUMNS
from cardlake.sources import versions, writers
from cardlake.sources.readers import date_spine

#: The folder level that keeps rows that conform apart from those that do not.
PASSED = "__passed"
# The calendar's span when none is given.
DEFAULT_START, DEFAULT_END = "2015-01-01", "2035-12-31"


def calendar(days: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    """dim_date over a frame with one ``date_value`` per row."""
    attributes = C.calendar_columns(F.col("date_value"))
    dated = days.select(*[c.alias(name) for name, c in attributes.items()])
    return K.project_to_contract(add_gold_audit(dated, run_id, now), K.GOLD_DIM_DATE)


def dim_date(
    spark: SparkSession,
    start: str = DEFAULT_START,
    end: str = DEFAULT_END,
    run_id: str = "adhoc",
    now: Column | None = None,
) -> DataFrame:
    return calendar(date_spine(spark, start, end), run_id, now)


def date_checks(start: str = DEFAULT_START, end: str = DEFAULT_END) -> list[Q.Check]:
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    return [*Q.contract_checks(K.GOLD_DIM_DATE), Q.row_count_is(days)]


def date_summary(dim: DataFrame) -> DataFrame:
    """First and last day, rows, and the range of ISO weekdays."""
    return dim.agg(
        F.min("date_value").alias("min_date"),
        F.max("date_value").alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.min("day_of_week_iso").alias("min_iso_dow"),
        F.max("day_of_week_iso").alias("max_iso_dow"),
    )


def edge_days(dim: DataFrame, n: int = 10, last: bool = False) -> DataFrame:
    """The first or last days of a calendar."""
    return dim.orderBy(F.desc("date_value") if last else F.asc("date_value")).limit(n)


def _dimension(
    silver: DataFrame, source: K.Contract, gold: K.Contract, run_id: str, now, tie_break
) -> DataFrame:
    Q.require_columns(silver, source.names, source.table)
    latest = dedup_latest(silver.select(*source.names), source.keys, source.order_by, tie_break)
    return K.project_to_contract(add_gold_audit(latest, run_id, now), gold)


def dim_user(silver: DataFrame, run_id: str, now: Column | None = None, tie_break=None) -> DataFrame:
    return _dimension(silver, K.SILVER_USERS, K.GOLD_DIM_USER, run_id, now, tie_break)


def dim_mcc(silver: DataFrame, run_id: str, now: Column | None = None, tie_break=None) -> DataFrame:
    return _dimension(silver, K.SILVER_MCC, K.GOLD_DIM_MCC, run_id, now, tie_break)


def mcc_checks() -> list[Q.Check]:
    return [Q.not_blank("mcc_code"), *Q.contract_checks(K.GOLD_DIM_MCC)]


def card_rules(users: DataFrame) -> list[Rule]:
    return [
        Rule("client_id", users, "client_id", "GOLD.CARD.CONF.001", "ORPHAN_DIM_USER", "HIGH",
             ("card_id", "client_id"), unique=True),
    ]


def tagged_cards(silver: DataFrame, users: DataFrame, tie_break=None) -> DataFrame:
    """Latest cards with their failed rule; a card without a client passes."""
    c = K.SILVER_CARDS
    Q.require_columns(silver, c.names, c.table)
    latest = dedup_latest(silver.select(*c.names), c.keys, c.order_by, tie_break)
    return tag_orphans(latest, card_rules(users), keep_null_key=True)


def dim_card(
    silver: DataFrame, users: DataFrame, run_id: str, now: Column | None = None, tie_break=None
) -> tuple[DataFrame, DataFrame]:
    """(gold cards, orphan events)."""
    tagged = tagged_cards(silver, users, tie_break)
    events = orphan_events(tagged, card_rules(users), run_id, "dim_card", "silver_cards", now)
    good = add_gold_audit(conforming(tagged), run_id, now)
    return K.project_to_contract(good, K.GOLD_DIM_CARD), events


def fact_rules(users: DataFrame, cards: DataFrame, mcc: DataFrame, dates: DataFrame) -> list[Rule]:
    """The chain user, card, mcc, date over gold dimensions, whose contracts keep
    user and card ids unique. Category codes have four characters and a
    calendar has days: those two key sets are bounded by their domain."""
    return [
        Rule("client_id", users, "client_id", "GOLD.TXN.CONF.001", "ORPHAN_DIM_USER", "HIGH",
             ("transaction_id", "client_id"), unique=True),
        Rule("card_id", cards, "card_id", "GOLD.TXN.CONF.002", "ORPHAN_DIM_CARD", "HIGH",
             ("transaction_id", "card_id"), unique=True),
        Rule("mcc_code", mcc, "mcc_code", "GOLD.TXN.CONF.003", "ORPHAN_DIM_MCC", "MEDIUM",
             ("transaction_id", "mcc_code"), bounded=True),
        Rule("txn_date", dates.select(F.col("date_value").alias("txn_date")), "txn_date",
             "GOLD.TXN.CONF.004", "ORPHAN_DIM_DATE", "HIGH",
             ("transaction_id", "txn_date"), bounded=True),
    ]


def deduped_fact(silver: DataFrame, tie_break=None, unique_input: bool = False) -> DataFrame:
    """Latest transactions with the chip flag, before conformance.

    The silver table holds one row per transaction already. ``unique_input``
    trusts that and leaves the fact unshuffled.
    """
    latest = _silver_columns(silver)
    if not unique_input:
        latest = dedup_latest(latest, K.SILVER_TRANSACTIONS.keys, K.SILVER_TRANSACTIONS.order_by, tie_break)
    return _fact_columns(latest)


def _silver_columns(silver: DataFrame) -> DataFrame:
    """The contract's columns; the record hash may be left to ``_fact_columns``."""
    c = K.SILVER_TRANSACTIONS
    names = [n for n in c.names if n != "record_hash" or n in silver.columns]
    return Q.require_columns(silver, names, c.table).select(*names)


def _fact_columns(latest: DataFrame) -> DataFrame:
    """Silver rows with what gold makes of them, and with their hash if they have none yet."""
    own = {} if "record_hash" in latest.columns else {"record_hash": record_hash(HASH_COLUMNS["silver_transactions"])}
    return latest.withColumns(
        {
            **own,
            "use_chip": F.trim("use_chip"),
            "is_chip_used": C.is_chip_used("use_chip"),
            "error_code": F.coalesce("error_code", F.lit(0)),
        }
    )


def fact_transactions(
    silver: DataFrame,
    users: DataFrame,
    cards: DataFrame,
    mcc: DataFrame,
    dates: DataFrame,
    run_id: str,
    now: Column | None = None,
    tie_break=None,
) -> tuple[DataFrame, DataFrame]:
    """(gold fact, orphan events), lazily.

    Rows are joined as they come from silver. What gold adds to them, and the
    hash if silver left it out, follows the joins: those may shuffle.
    """
    c, rules = K.SILVER_TRANSACTIONS, fact_rules(users, cards, mcc, dates)
    latest = dedup_latest(_silver_columns(silver), c.keys, c.order_by, tie_break)
    tagged = tag_orphans(latest, rules)
    events = orphan_events(tagged, rules, run_id, "fact_transactions", "silver_transactions", now)
    good = add_gold_audit(_fact_columns(conforming(tagged)), run_id, now)
    return K.project_to_contract(good, K.GOLD_FACT), events


# --- loads ------------------------------------------------------------------


def staged_orphan_keys(silver: DataFrame, rules: list[Rule], run_id: str) -> dict[str, DataFrame]:
    """Orphan keys of the dimensions that may be too big to broadcast, stored.

    They are found on distinct keys. With the stored size known, Spark
    broadcasts a list that is small and shuffles one that is not, so the fact
    is normally not shuffled for conformance at all.
    """
    own = [r for r in rules if not r.bounded]
    types = {r.fact_key: silver.schema[r.fact_key].dataType for r in own}
    pairs = [
        F.struct(F.lit(i).alias("rule"), *[(F.col(k) if k == r.fact_key else F.lit(None).cast(t)).alias(k) for k, t in types.items()])
        for i, r in enumerate(own)
    ]
    # The keys of all rules come from one pass over the rows.
    found, _ = writers.stage(silver.select(F.inline(F.array(*pairs))).distinct(), "fact-keys", run_id)
    return {
        r.rule_id: writers.stage(orphan_keys(found.where(F.col("rule") == i), r), f"orphans-{r.rule_id}", run_id)[0]
        for i, r in enumerate(own)
    }


def build_dimension(df: DataFrame, c: K.Contract, path: str, run_id: str, checks=None) -> dict:
    """Replace one gold dimension after its contract holds."""
    checks = Q.contract_checks(c) if checks is None else checks
    return writers.publish(K.project_to_contract(df, c), path, c.table, (), checks)


def build_cards(
    silver: DataFrame, users: DataFrame, path: str, events_path: str, kpi_path: str, run_id: str
) -> dict:
    rules = card_rules(users)
    arrived = Observation(f"{K.GOLD_DIM_CARD.table}-in-{run_id}")

    def tag(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
        return tagged_cards(df.observe(arrived, F.count(F.lit(1)).alias("row_in")), users), lambda: arrived.get["row_in"]

    return _build_split(
        silver, tag, rules, K.GOLD_DIM_CARD, "dim_card",
        "silver_cards", path, events_path, kpi_path, run_id,
    )


def build_fact(
    silver: DataFrame,
    users: DataFrame,
    cards: DataFrame,
    mcc: DataFrame,
    dates: DataFrame,
    path: str,
    events_path: str,
    kpi_path: str,
    run_id: str,
    unique_input: bool = False,
) -> dict:
    """Load the gold fact, its anomaly events and their KPIs.

    With few orphans and few repeated ids the fact is not shuffled at all: ids that
    repeat are found on the ids alone, and only their rows are ranked. Rows are
    then written as they lie, each task's months apart. ``unique_input`` trusts
    that no id repeats.
    """
    c, rules = K.SILVER_TRANSACTIONS, fact_rules(users, cards, mcc, dates)

    def tag(df: DataFrame) -> tuple[DataFrame, Callable[[], int] | None]:
        sets, rows, counted = staged_orphan_keys(df, rules, run_id), _silver_columns(df), None
        if not unique_input:
            repeats, n = staged_repeats(df, c.keys, run_id)
            rows, counted = latest_of_repeats(rows, repeats, c.keys, c.order_by), lambda: n
        return tag_orphans(_fact_columns(rows), rules, orphan_sets=sets), counted

    return _build_split(
        silver, tag, rules, K.GOLD_FACT, "fact_transactions", "silver_transactions",
        path, events_path, kpi_path, run_id, gather=False,
    )


def staged_repeats(df: DataFrame, keys: Sequence[str], run_id: str) -> tuple[DataFrame, int]:
    """Keys that more than one row has, stored, and the number of all rows."""
    counted = Observation(f"repeats-{run_id}-{uuid.uuid4().hex}")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).observe(counted, F.coalesce(F.sum("__n"), F.lit(0)).alias("n"))
    repeats, _ = writers.stage(per_key.where(F.col("__n") > 1).select(*keys), f"repeats-{'-'.join(keys)}", run_id)
    return repeats, versions.seen(counted, df, {"n": F.count(F.lit(1))})["n"]


def latest_of_repeats(df: DataFrame, repeats: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``dedup_latest``, in which rows whose key is not among ``repeats`` pass as they are."""
    other = repeats.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    same = C.all_of([F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    once, several = df.join(other, same, "left_anti"), df.join(other, same, "left_semi")
    return once.unionByName(dedup_latest(several, keys, order))


def _build_split(
    silver, tag, rules, c: K.Contract, entity: str, source_table: str,
    path: str, events_path: str, kpi_path: str, run_id: str, gather: bool = True,
) -> dict:
    """Write the tagged rows once, those that pass and those that fail apart, with
    all counts and checks observed on that write. Passing ones are committed as
    the table, failing ones become anomaly events.

    Uniqueness needs no pass of its own: the rows are ranked per key just before.
    ``tag`` gives the tagged rows, and what tells the number of rows that came in,
    unless that is the number of the tagged ones.
    """
    spark, base = silver.sparkSession, versions.current(silver.sparkSession, path)
    run_id = require_text(run_id, "run_id")
    rows, counted = tag(silver)
    tagged = add_gold_audit(rows, run_id)
    shaped = tagged.select(
        *[F.col(k.name).cast(K.spark_type(k.type)).alias(k.name) for k in c.columns], FAILED_RULE
    ).withColumn(PASSED, F.col(FAILED_RULE).isNull())
    passed = F.col(PASSED)
    checks = Q.contract_checks(c, with_unique=False)
    broken = {k.name: F.count_if(passed & k.violation) for k in checks if k.violation is not None}
    load, seen = versions.write(
        shaped, path, [PASSED, *c.partition_by], {"deduped": F.count(F.lit(1)), "rejected": F.count_if(~passed), **broken}, gather=gather,
    )
    written = versions.folders(spark, path, load)
    top = f"{PASSED}=true"
    good = {p[len(top) + 1 :]: [f] for p, f in written.items() if p.startswith(top)}
    try:
        failures = {k: seen[k] for k in broken if seen[k]}
        if failures:
            raise Q.QualityError(c.table, failures)
        rows = versions.files(spark, path, [f for some in good.values() for f in some], c.schema)
        Q.assert_passed(Q.run_checks(rows, [k for k in checks if k.max_distinct is not None]), c.table)
    except Q.QualityError:
        versions.discard(spark, path, load)
        raise
    versions.commit(spark, path, base, good, whole=True)
    # Each run and entity has a partition of its own: a run repeated replaces its events.
    own = ["gold_run_id", "entity"]
    if seen["rejected"]:
        failed = versions.files(spark, path, [f for p, f in written.items() if not p.startswith(top)], shaped.drop(PASSED).schema)
        events = orphan_events(failed, rules, run_id, entity, source_table)
        writers.overwrite_partitions(events, events_path, own, cluster=False)
        stored = spark.read.schema(events.schema).parquet(events_path)
        stored = stored.where((F.col("gold_run_id") == run_id) & (F.col("entity") == entity))
        writers.overwrite_partitions(anomaly_kpis(stored, run_id, entity), kpi_path, own, cluster=False)
    else:
        for table in (events_path, kpi_path):
            writers.remove_folder(spark, f"{table}/gold_run_id={run_id}/entity={entity}")
    row_in = counted() if counted else seen["deduped"]
    return {
        "row_in": row_in,
        "dedup_dropped": row_in - seen["deduped"],
        "row_rejected": seen["rejected"],
        "anom_count": seen["rejected"],
        "row_out": seen["deduped"] - seen["rejected"],
        "partition_count": len(good) if c.partition_by else 0,
    }

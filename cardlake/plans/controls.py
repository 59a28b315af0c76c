"""Controls over the warehouse: duplicates, orphans, blank hashes,
reconciliation, and the publish gates. Every control returns rows of
``wh_dq_check_result``; all months come from one pass, one month from one
partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.operators.projection import month_scope
from cardlake.plans import contracts as K

DIM_KEYS = {"dim_card": "card_key", "dim_date": "date_key", "dim_mcc": "mcc_key", "dim_user": "user_key"}
# What each check counts, for whoever reads its row.
MESSAGES = {
    "duplicates_transaction_id": "ids that more than one fact row carries",
    "empty_record_hash": "fact rows whose hash is blank",
    **{f"orphans_{key}": f"fact rows whose {key} has no member in {dim}" for dim, key in DIM_KEYS.items()},
}
MAX_AGE_HOURS = 24


@dataclass(frozen=True)
class Run:
    """What a control stamps on its rows; the clock is a parameter."""

    run_id: str
    now: Column
    exec_date: Column | None = None


def _results(df: DataFrame, code: Column | str, run: Run, message: Column) -> DataFrame:
    """Check rows from (txn_month, issue_count) rows."""
    code = F.lit(code) if isinstance(code, str) else code
    day = F.to_date(run.now) if run.exec_date is None else run.exec_date
    return df.select(
        F.lit(run.run_id).alias("run_id"),
        code.alias("check_code"),
        run.now.alias("exec_ts"),
        day.alias("exec_date"),
        "txn_month",
        F.when(F.col("issue_count") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.col("issue_count").cast("bigint").alias("issue_count"),
        F.substring(message, 1, 2000).alias("message"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def ctl_duplicates(
    fact: DataFrame, run: Run, month: str | None = None, per_month: bool = True
) -> DataFrame:
    """Transaction ids held by more than one row: per month, or over all rows.

    The count over all rows has no month. It also sees an id that stands once
    in each of two months.
    """
    scoped = month_scope(fact, month)
    keys = ["txn_month", "transaction_id"] if per_month else ["transaction_id"]
    ids = scoped.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.count_if(F.col("n") > 1).alias("issue_count")
    if per_month:
        found = ids.groupBy("txn_month").agg(repeated)
    else:
        found = ids.agg(repeated).withColumn("txn_month", F.lit(month).cast("date"))
    code = "duplicates_transaction_id"
    return _results(found, code, run, F.lit(MESSAGES[code]))


def ctl_empty_hash(fact: DataFrame, run: Run, month: str | None = None) -> DataFrame:
    found = month_scope(fact, month).groupBy("txn_month").agg(
        F.count_if(C.is_blank("record_hash")).alias("issue_count")
    )
    return _results(found, "empty_record_hash", run, F.lit(MESSAGES["empty_record_hash"]))


def ctl_orphans(
    fact: DataFrame, dims: dict[str, DataFrame], run: Run, month: str | None = None
) -> DataFrame:
    """Fact rows whose surrogate key its dimension lacks, per month and dimension.

    One pass over the fact: each row gives its four keys, which are counted per
    (month, dimension, key) before they are shuffled, so a hot card or user is
    one row for each task. What is joined is the distinct keys of a month.
    """
    keys = [F.struct(F.lit(f"orphans_{k}").alias("code"), F.col(k).alias("key")) for k in DIM_KEYS.values()]
    each = month_scope(fact, month).select("txn_month", F.inline(F.array(*keys)))
    counted = each.groupBy("txn_month", "code", "key").agg(F.count(F.lit(1)).alias("n"))
    members = _union([
        dims[dim].select(F.lit(f"orphans_{k}").alias("__code"), F.col(k).alias("__known")) for dim, k in DIM_KEYS.items()
    ])
    same = (F.col("code") == F.col("__code")) & (F.col("key") == F.col("__known"))
    lacking = F.sum(F.when(F.col("__known").isNull(), F.col("n")).otherwise(0)).alias("issue_count")
    found = counted.join(members, same, "left").groupBy("txn_month", "code").agg(lacking)
    messages = F.create_map(*[F.lit(x) for k in DIM_KEYS.values() for x in (f"orphans_{k}", MESSAGES[f"orphans_{k}"])])
    return _results(found, F.col("code"), run, F.element_at(messages, F.col("code")))


# --- reconciliation ---------------------------------------------------------


def recon(
    gold: DataFrame,
    wh: DataFrame,
    now: Column,
    metrics: tuple[str, ...] = ("counts", "amounts"),
    tolerance: float = 0.0,
    month: str | None = None,
) -> DataFrame:
    """ctrl_reconciliation rows: both sides per month, a missing month is zero."""
    wide = "decimal(38,6)"
    measures = {
        "counts": F.count(F.lit(1)).cast(wide),
        "amounts": F.coalesce(F.sum("amount"), F.lit(0)).cast(wide),
    }

    def side(df: DataFrame, name: str) -> DataFrame:
        values = [measures[m].alias(f"{name}_{m}") for m in metrics]
        return month_scope(df, month).groupBy("txn_month").agg(*values)

    both = side(gold, "gold").join(side(wh, "wh"), "txn_month", "full_outer")
    zero = F.lit(0).cast(wide)
    entries = [
        F.struct(
            F.lit(f"recon_{m}_gold_vs_dwh").alias("metric_name"),
            F.coalesce(f"gold_{m}", zero).alias("gold_value"),
            F.coalesce(f"wh_{m}", zero).alias("wh_value"),
        )
        for m in metrics
    ]
    delta = (F.col("gold_value") - F.col("wh_value")).cast(wide)
    limit = F.lit(str(tolerance)).cast(wide)
    rows = both.select("txn_month", F.inline(F.array(*entries)))
    return rows.select(
        now.alias("check_ts"),
        "txn_month",
        "metric_name",
        "gold_value",
        "wh_value",
        delta.alias("delta_value"),
        limit.alias("tolerance_abs"),
        F.when(F.abs(delta) <= limit, "PASS").otherwise("FAIL").alias("status"),
        F.concat(
            F.lit("Gold="), F.col("gold_value").cast("string"),
            F.lit("; Dwh="), F.col("wh_value").cast("string"),
        ).alias("details"),
    )


def recon_results(recon_rows: DataFrame, run: Run) -> DataFrame:
    """Reconciliation as check rows: one issue where the sides differ."""
    found = recon_rows.withColumn("issue_count", F.when(F.col("status") == "PASS", 0).otherwise(1))
    return _results(found, F.col("metric_name"), run, F.col("details"))


# --- publish gates ----------------------------------------------------------


def gate_present(monthly: DataFrame, run: Run, months: DataFrame | None = None) -> DataFrame:
    """Whether a month has monthly aggregates. ``months`` lists the months that
    should have them; without it only months that do can be reported."""
    found = monthly.groupBy("txn_month").agg(F.count(F.lit(1)).alias("n"))
    if months is not None:
        wanted = months.select("txn_month").distinct()
        found = wanted.join(found, "txn_month", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    found = found.withColumn("issue_count", F.when(F.col("n") > 0, 0).otherwise(1))
    message = F.concat(F.lit("Rows in fact_transactions_monthly = "), F.col("n").cast("string"))
    return _results(found, "pub_agg_monthly_present", run, message)


def gate_fresh(
    monthly: DataFrame, run: Run, max_hours: int = MAX_AGE_HOURS, months: DataFrame | None = None
) -> DataFrame:
    """Whether a month's latest load is at most ``max_hours`` before the run.
    A stale month gets a FAIL row, so the decision below can see it."""
    found = monthly.groupBy("txn_month").agg(F.max("gold_load_ts_max").alias("latest"))
    if months is not None:
        found = months.select("txn_month").distinct().join(found, "txn_month", "left")
    oldest = run.now - F.make_dt_interval(hours=F.lit(max_hours))
    fresh = F.coalesce(F.col("latest") >= oldest, F.lit(False))
    found = found.withColumn("issue_count", F.when(fresh, 0).otherwise(1))
    stamp = F.coalesce(F.date_format("latest", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))
    return _results(found, "pub_agg_freshness", run, F.concat(F.lit("Max gold_load_ts_max = "), stamp))


def publish_decision(results: DataFrame, now: Column) -> DataFrame:
    """ctrl_publish_status: a month is published only if none of its checks failed.

    A failed check without a month holds for all months and blocks each of
    them. The reason lists failed check codes, of which there are as many as
    controls.
    """
    failed = F.collect_set(F.when(F.col("status") == "FAIL", F.col("check_code")))
    everywhere = results.where(F.col("txn_month").isNull()).agg(failed).scalar()
    monthly = results.where(F.col("txn_month").isNotNull()).groupBy("txn_month").agg(failed.alias("codes"))
    reason = F.array_join(F.sort_array(F.array_union("codes", everywhere)), ",")
    decided = monthly.select("txn_month", reason.alias("reason"))
    return decided.select(
        now.alias("publish_ts"),
        "txn_month",
        F.when(F.col("reason") == "", "PUBLISHED").otherwise("BLOCKED").alias("status"),
        "reason",
    )


class PublishBlocked(RuntimeError):
    pass


def assert_publishable(decision: DataFrame, month: str) -> None:
    """Raise unless ``month`` is published; reads that month's one row."""
    row = month_scope(decision, month).first()
    if row is None or row["status"] != "PUBLISHED":
        raise PublishBlocked(f"{month}: {row['reason'] if row else 'no check results'}")


def ctrl_rows(results: DataFrame, c: K.Contract) -> DataFrame:
    """Check rows in the shape of ctrl_duplicates / ctrl_conformance."""
    return K.project_to_contract(
        results.where(F.col("txn_month").isNotNull()).select(
            F.col("exec_ts").alias("check_ts"),
            "txn_month",
            F.col("check_code").alias("metric_name"),
            F.col("issue_count").alias("metric_value"),
            "status",
            F.col("message").alias("details"),
        ),
        c,
    )


def run_controls(
    gold: DataFrame,
    fact: DataFrame,
    monthly: DataFrame,
    dims: dict[str, DataFrame],
    run: Run,
    month: str | None = None,
) -> DataFrame:
    """All control and gate rows of a run."""
    scope = month_scope(gold, month)
    return _union(
        [
            ctl_duplicates(fact, run, month),
            *([ctl_duplicates(fact, run, per_month=False)] if month is None else []),
            ctl_empty_hash(fact, run, month),
            ctl_orphans(fact, dims, run, month),
            recon_results(recon(gold, fact, run.now, month=month), run),
            gate_present(month_scope(monthly, month), run, scope),
            gate_fresh(month_scope(monthly, month), run, months=scope),
        ]
    )

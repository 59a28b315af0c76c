"""Operations measures over runs, job logs, check results and aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.plans.runlog import latest_jobs

# Thresholds of the health displays.
MONTHLY_FRESH_DAYS = 31
LONG_RUN_MINUTES = 60


def dq_health(dq: DataFrame) -> DataFrame:
    fails = F.count_if(F.col("status") == "FAIL")
    return dq.agg(
        fails.alias("dq_fail_count"),
        F.when(fails > 0, "FAILED").otherwise("PASSED").alias("dq_overall_status"),
    )


def job_counts(log: DataFrame, raw: bool = False, tie_break: str = "message") -> DataFrame:
    """Jobs executed and failed. A job logs a start and an end row; ``raw``
    counts log rows, otherwise each job of a run counts once."""
    rows = log if raw else latest_jobs(log, tie_break)
    return rows.agg(
        F.count(F.lit(1)).alias("jobs_executed"),
        F.count_if(F.col("status") == "FAILED").alias("jobs_failed"),
    )


def health(log: DataFrame, dq: DataFrame, raw: bool = False, tie_break: str = "message") -> DataFrame:
    """Checks and jobs in one row with the critical gate and its severity code."""
    both = _one_row(dq_health(dq), job_counts(log, raw, tie_break))
    critical = (F.col("dq_fail_count") > 0) | (F.col("jobs_failed") > 0)
    return both.withColumns(
        {
            "critical_gate": F.when(critical, "CRITICAL").otherwise("OK"),
            "severity_code": F.when(critical, 3).otherwise(1),
        }
    )


def _one_row(*singles: DataFrame) -> DataFrame:
    """Single-row frames side by side: stacked with NULLs, then reduced."""
    names = [c for s in singles for c in s.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), singles)
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def freshness(daily: DataFrame, monthly: DataFrame, as_of: Column) -> DataFrame:
    """Last day and month present and their age in days at ``as_of``."""
    last = _one_row(
        daily.agg(F.max("txn_date").alias("daily_last_date")),
        monthly.agg(F.max("txn_month").alias("monthly_last_month")),
    )
    age = F.datediff(as_of, F.col("monthly_last_month"))
    current = F.coalesce(F.col("monthly_last_month") == C.month_start(as_of), F.lit(False))
    return last.withColumns(
        {
            "daily_freshness_days": F.datediff(as_of, F.col("daily_last_date")),
            "monthly_last_label": C.month_label("monthly_last_month"),
            "monthly_freshness_days": age,
            "monthly_is_fresh": age <= MONTHLY_FRESH_DAYS,
            "monthly_current_present": current.cast("int"),
            "monthly_current_label": C.month_label(as_of),
        }
    )


def run_window(runs: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    if start:
        runs = runs.where(F.col("exec_date") >= F.lit(start).cast("date"))
    if end:
        runs = runs.where(F.col("exec_date") <= F.lit(end).cast("date"))
    return runs


def run_history(runs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Runs, outcomes, durations and volumes; filter by ``run_window`` first."""
    minutes = F.col("duration_sec") / F.lit(60.0)
    measured = runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs_total"),
        F.count_if(F.col("run_status") == "SUCCESS").alias("runs_success"),
        F.count_if(F.col("run_status") == "FAILED").alias("runs_failed"),
        F.sum("duration_sec").alias("__seconds"),
        F.count("duration_sec").alias("__timed"),
        F.max(minutes).alias("duration_min_max"),
        F.coalesce(F.sum(F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_deleted")), F.lit(0)).alias("rows_processed"),
        F.coalesce(F.sum("rows_source"), F.lit(0)).alias("rows_source"),
        F.sum("dq_fail_count").alias("__dq_fails"),
    )
    failed = (F.col("runs_failed") > 0) | (F.coalesce("__dq_fails", F.lit(0)) > 0)
    total_minutes = F.col("__seconds") / F.lit(60.0)
    return measured.select(
        *by,
        "runs_total",
        "runs_success",
        "runs_failed",
        C.safe_divide(F.col("runs_success"), F.col("runs_total"), None).alias("success_rate"),
        total_minutes.alias("duration_min"),
        C.safe_divide(total_minutes, F.col("__timed"), None).alias("duration_min_avg"),
        "duration_min_max",
        F.coalesce(F.col("duration_min_max") > LONG_RUN_MINUTES, F.lit(False)).alias("has_long_run"),
        "rows_processed",
        "rows_source",
        failed.cast("int").alias("critical_failed"),
    )


def latest_run(runs: DataFrame, by_start: bool = False) -> DataFrame:
    """Latest and last successful run. As written the latest run is the highest
    id in text order; ``by_start`` takes the one that started last."""
    ok = F.col("run_status") == "SUCCESS"
    order = F.struct("exec_ts_start", "run_id") if by_start else F.col("run_id")
    row = F.struct(order.alias("by"), "run_id", "run_status", "exec_ts_end")
    picked = runs.agg(
        F.max(row).alias("last"), F.max(F.when(ok, row)).alias("good"),
        F.max(F.when(ok, F.col("exec_ts_end"))).alias("last_success_end_ts"),
    )
    return picked.select(
        F.col("last.run_id").alias("latest_run_id"),
        F.col("last.run_status").alias("latest_run_status"),
        F.col("good.run_id").alias("last_success_run_id"),
        "last_success_end_ts",
    )

"""Job, step and run logs, and the rollup of all runs at once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.operators.dedup import dedup_latest
from cardlake.plans import contracts as K
from cardlake.sources.writers import append_rows

# Fixed values.
ROLLUP_JOB = "wh_run_upsert"
IN_PROGRESS = ("STARTED", "RUNNING")
MESSAGE_LENGTH = 2000

_ENDED = "coalesce(exec_ts_end, exec_ts_start)"


def latest_jobs(log: DataFrame, tie_break: str = "message") -> DataFrame:
    """The last row per run and job of an append-only log."""
    return dedup_latest(log, ["run_id", "job_id"], [_ENDED, "exec_ts_start"], [tie_break])


def latest_checks(dq: DataFrame, tie_break: str = "message") -> DataFrame:
    return dedup_latest(dq, ["run_id", "check_code"], "exec_ts", [tie_break])


def _newest(order: list[str], value: dict[str, str], when: Column | None = None) -> Column:
    """The value of the row that is last by ``order``, as one aggregate.

    A maximum over (order, value) structs is combined map-side, so a run or job
    that owns a third of the log sends one row per task.
    """
    row = F.struct(
        F.struct(*[F.expr(o).alias(f"o{i}") for i, o in enumerate(order)]).alias("by"),
        F.struct(*[F.expr(e).alias(n) for n, e in value.items()]).alias("row"),
    )
    return F.max(row if when is None else F.when(when, row))


def run_rollup(
    log: DataFrame,
    dq: DataFrame,
    registry: DataFrame,
    now: Column | None = None,
    exclude_job: str = ROLLUP_JOB,
    exec_date: str | None = None,
    log_tie: str = "message",
    dq_tie: str = "message",
) -> DataFrame:
    """wh_run: one row per run, for every run in the log.

    The log is reduced to one row per (run, job) in a single aggregation that
    also picks the newest messages, then to one row per run.
    """
    now = F.current_timestamp() if now is None else now
    order = [_ENDED, "exec_ts_start", log_tie]
    message_order = [_ENDED, log_tie]
    message = {"message": f"substring(message, 1, {MESSAGE_LENGTH})"}
    spoken = ~C.is_blank("message")
    fields = ["exec_date", "txn_month", "exec_ts_start", "exec_ts_end", "status", "rows_source",
              "rows_inserted", "rows_updated", "rows_deleted"]
    jobs = (
        log.where(F.col("job_id") != exclude_job)
        .groupBy("run_id", "job_id")
        .agg(
            _newest(order, {f: f for f in fields}).alias("last"),
            _newest(message_order, message, spoken & (F.col("status") == "FAILED")).alias("failed_message"),
            _newest(message_order, message, spoken).alias("any_message"),
        )
        .select("run_id", "job_id", "last.row.*", "failed_message", "any_message")
        .join(
            registry.select(F.col("job_code").alias("job_id"), "is_critical"), "job_id", "left"
        )
    )
    failed = F.col("status") == "FAILED"
    total = {c: F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in fields[5:]}
    runs = jobs.groupBy("run_id").agg(
        F.max("exec_date").alias("exec_date"),
        F.min("exec_ts_start").alias("exec_ts_start"),
        F.max("exec_ts_end").alias("exec_ts_end"),
        F.max("txn_month").alias("txn_month"),
        F.count(F.lit(1)).alias("jobs_total"),
        F.count_if(failed).alias("jobs_failed"),
        F.count_if(F.col("status") == "SUCCESS").alias("jobs_success"),
        F.count_if(F.col("status").isin(*IN_PROGRESS) | F.col("exec_ts_end").isNull()).alias("jobs_started"),
        F.count_if(failed & F.coalesce("is_critical", F.lit(False))).alias("critical_failed"),
        *total.values(),
        F.max("failed_message").alias("failed_message"),
        F.max("any_message").alias("any_message"),
    )
    checks = dq_rollup(dq, dq_tie)
    joined = runs.join(checks, "run_id", "left")
    bad = (F.col("jobs_failed") > 0) | (F.col("critical_failed") > 0) | F.coalesce(
        F.col("dq_status") == "FAIL", F.lit(False)
    )
    return K.project_to_contract(
        joined.withColumns(
            {
                "exec_date": F.coalesce("exec_date", F.lit(exec_date).cast("date")),
                "run_status": F.when(F.col("jobs_started") > 0, "RUNNING").when(bad, "FAILED").otherwise("SUCCESS"),
                "duration_sec": C.seconds_between("exec_ts_start", F.coalesce(F.col("exec_ts_end"), now)),
                "dq_fail_count": F.coalesce("dq_fail_count", F.lit(0)),
                "dq_issue_count": F.coalesce("dq_issue_count", F.lit(0)),
                "last_message": F.coalesce(
                    F.col("failed_message.row.message"),
                    F.col("dq_message"),
                    F.col("any_message.row.message"),
                ),
            }
        ),
        K.WH_RUN,
    )


def dq_rollup(dq: DataFrame, tie_break: str = "message") -> DataFrame:
    """Per run: failed checks, issues, worst status and the newest failure message."""
    message = {"message": f"substring(message, 1, {MESSAGE_LENGTH})"}
    failing = (F.col("status") == "FAIL") & ~C.is_blank("message")
    checks = (
        dq.groupBy("run_id", "check_code")
        .agg(
            _newest(["exec_ts", tie_break], {"status": "status", "issue_count": "issue_count"}).alias("last"),
            _newest(["exec_ts", tie_break], message, failing).alias("failed"),
        )
        .select("run_id", "last.row.*", "failed")
    )

    def any_is(status: str) -> Column:
        return F.count_if(F.col("status") == status) > 0

    return checks.groupBy("run_id").agg(
        F.count_if(F.col("status") == "FAIL").alias("dq_fail_count"),
        F.sum(F.coalesce("issue_count", F.lit(0))).alias("dq_issue_count"),
        F.when(any_is("FAIL"), "FAIL").when(any_is("PASS"), "PASS").when(any_is("INFO"), "INFO").alias("dq_status"),
        F.max("failed")["row"]["message"].alias("dq_message"),
    )


# --- step logs --------------------------------------------------------------


def step_status(steps: DataFrame, run_col: str = "gold_run_id", tie_break: str = "step_seq") -> DataFrame:
    """Outcome of a layer's run: FAILED if a critical step failed, PARTIAL if
    another did, SUCCESS otherwise. Counts the last row of each step."""
    order = ["coalesce(end_ts, start_ts)", "start_ts"]
    last = dedup_latest(steps, [run_col, "entity_code"], order, [tie_break])
    failed = F.col("status") == "FAILED"
    return last.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("steps_total"),
        F.count_if(F.col("status") == "SUCCESS").alias("steps_success"),
        F.count_if(failed).alias("steps_failed"),
        F.when(F.count_if(failed & F.coalesce("critical", F.lit(False))) > 0, "FAILED")
        .when(F.count_if(failed) > 0, "PARTIAL")
        .otherwise("SUCCESS")
        .alias("status"),
    )


def step_row(
    run_id: str,
    entity: str,
    started: datetime,
    ended: datetime | None,
    status: str,
    metrics: dict | None = None,
    **other,
) -> dict:
    """One step-log row; counts come from the metrics a load returns."""
    known = {"row_in", "row_out", "row_rejected", "partition_count", "dedup_dropped", "anom_count"}
    row = {
        "gold_run_id": run_id,
        "run_id": run_id,
        "entity_code": entity,
        "start_ts": started,
        "end_ts": ended,
        "duration_ms": None if ended is None else int((ended - started).total_seconds() * 1000),
        "status": status,
        **{k: v for k, v in (metrics or {}).items() if k in known},
    }
    error = other.pop("error", None)
    if error is not None:
        row["error_message"] = str(error)[:4000]
    return {**row, **other}


@contextmanager
def logged_job(
    spark: SparkSession,
    log_path: str,
    run_id: str,
    job_id: str,
    exec_date: date,
    txn_month: date | None = None,
    message: str = "",
) -> Iterator[dict]:
    """STARTED before the block, SUCCESS or FAILED after it.

    The block fills the yielded dict with ``rows_source``, ``rows_inserted``
    and so on; a failure is logged with its message and raised again.
    """
    base = {"run_id": run_id, "job_id": job_id, "exec_date": exec_date, "txn_month": txn_month,
            "exec_ts_start": datetime.now(timezone.utc)}
    schema = K.WH_JOB_LOG.schema
    append_rows(spark, log_path, [{**base, "status": "STARTED", "message": message}], schema)
    counts: dict = {}

    def finish(status: str, text: str) -> None:
        row = {**base, **counts, "exec_ts_end": datetime.now(timezone.utc), "status": status,
               "message": text[:MESSAGE_LENGTH]}
        append_rows(spark, log_path, [row], schema)

    try:
        yield counts
    except Exception as error:
        finish("FAILED", str(error))
        raise
    finish("SUCCESS", f"{message} completed")

"""Step payloads held as JSON text: required fields and the one common shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields a silver step must report.
REQUIRED_FIELDS = (
    "contract_version",
    "layer",
    "run_id",
    "entity_code",
    "load_mode",
    "status",
    "metrics.row_out",
    "table.target_table",
    "timing.started_utc",
    "timing.ended_utc",
    "timing.duration_ms",
)


def json_path(payload: Column | str, path: str) -> Column:
    """The value at a dot path, NULL where any part of the path is missing."""
    return F.get_json_object(_col(payload), path if path.startswith("$") else f"$.{path}")


def json_paths_missing(payload: Column | str, paths: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """The required paths a payload lacks, in the order given."""
    absent = [F.when(json_path(payload, p).isNull(), F.lit(p)) for p in paths]
    return F.filter(F.array(*absent), lambda p: p.isNotNull())


def check_payloads(
    steps: DataFrame, paths: Sequence[str] = REQUIRED_FIELDS, payload: str = "payload_json"
) -> DataFrame:
    """Each step with the fields its payload lacks and PASS or FAIL."""
    missing = json_paths_missing(payload, paths)
    return steps.withColumn("missing_fields", F.array_join(missing, ",")).withColumn(
        "payload_status", F.when(F.col("missing_fields") == "", "PASS").otherwise("FAIL")
    )


_LEGACY = """
    run_id STRING, entity_code STRING, load_mode STRING, as_of_date STRING, status STRING,
    row_in BIGINT, row_out BIGINT, partition_count INT, dedup_dropped BIGINT,
    target_table STRING, partition_cols ARRAY<STRING>
"""


def normalize_payload(
    payload: Column | str, now: Column, run_id: Column | None = None, entity: Column | None = None
) -> Column:
    """Payload in the nested form.

    A payload that already has ``metrics`` and ``table`` is returned as it is;
    a flat one, with its counts at the root, is wrapped.
    """
    payload = _col(payload)
    flat = F.from_json(payload, _LEGACY)
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    wrapped = F.to_json(
        F.struct(
            F.lit("0.x-legacy").alias("contract_version"),
            F.lit("silver").alias("layer"),
            _or(flat["run_id"], run_id).alias("run_id"),
            _or(flat["entity_code"], entity).alias("entity_code"),
            flat["load_mode"].alias("load_mode"),
            flat["as_of_date"].alias("as_of_date"),
            F.coalesce(flat["status"], F.lit("SUCCESS")).alias("status"),
            F.struct(
                flat["row_in"].alias("row_in"),
                flat["row_out"].alias("row_out"),
                F.coalesce(flat["partition_count"], F.lit(0)).alias("partition_count"),
                F.coalesce(flat["dedup_dropped"], F.lit(0)).alias("dedup_dropped"),
            ).alias("metrics"),
            F.struct(
                flat["target_table"].alias("target_table"),
                F.coalesce(flat["partition_cols"], F.array().cast("array<string>")).alias("partition_cols"),
            ).alias("table"),
            F.struct(
                stamp.alias("started_utc"), stamp.alias("ended_utc"), F.lit(0).alias("duration_ms")
            ).alias("timing"),
        )
    )
    nested = json_path(payload, "metrics").isNotNull() & json_path(payload, "table").isNotNull()
    return F.when(nested, payload).otherwise(wrapped)


def _or(c: Column, fallback: Column | None) -> Column:
    return c if fallback is None else F.coalesce(c, fallback)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c

"""Technical columns and scope filters."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_tech_columns(
    df: DataFrame,
    source_file_col: str = "source_file",
    ingestion_ts_col: str = "ingestion_ts",
    ingestion_date_col: str = "ingestion_date",
    default_source_file: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """``source_file``, ``ingestion_ts`` and ``ingestion_date``: taken from the
    named columns where they exist, filled with a default where they do not."""
    found = {
        source_file_col: "source_file",
        ingestion_ts_col: "ingestion_ts",
        ingestion_date_col: "ingestion_date",
    }
    df = df.withColumnsRenamed({k: v for k, v in found.items() if k in df.columns and k != v})
    if "source_file" not in df.columns:
        df = df.withColumn("source_file", F.lit(default_source_file).cast("string"))
    if "ingestion_ts" not in df.columns:
        df = df.withColumn("ingestion_ts", F.current_timestamp() if now is None else now)
    if "ingestion_date" not in df.columns:
        df = df.withColumn("ingestion_date", F.to_date("ingestion_ts"))
    return df


def add_gold_audit(df: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    return df.withColumns(
        {
            "gold_run_id": F.lit(require_text(run_id, "run_id")),
            "gold_load_ts": F.current_timestamp() if now is None else now,
        }
    )


def require_text(value: str | None, name: str) -> str:
    if value is None or not str(value).strip():
        raise ValueError(f"{name} must not be blank")
    return str(value).strip()


# The column an incremental run filters by.
_AS_OF_COLUMN = {
    "TRANSACTION": "date",
    "FX": "date",
    "USER": "ingestion_date",
    "CARD": "ingestion_date",
}


def filter_as_of(
    df: DataFrame,
    entity: str,
    as_of: str | None,
    mode: str = "incremental",
    since: str | None = None,
) -> DataFrame:
    """Rows of one day for an incremental run; everything otherwise.

    The transaction filter is a range on the timestamp itself rather than
    ``to_date(date) = day``, so it reaches the Parquet scan. ``since`` also
    drops rows ingested before a moment.
    """
    if (mode or "").strip().lower() != "incremental":
        return df
    column = _AS_OF_COLUMN.get(entity.strip().upper())
    if column and (as_of or "").strip():
        day = date.fromisoformat(as_of.strip())
        if entity.strip().upper() == "TRANSACTION":
            start = F.lit(day.isoformat()).cast("timestamp")
            end = F.lit((day + timedelta(days=1)).isoformat()).cast("timestamp")
            df = df.where((F.col(column) >= start) & (F.col(column) < end))
        else:
            df = df.where(F.col(column) == F.lit(day))
    if since:
        df = df.where(F.col("ingestion_ts") >= F.lit(since).cast("timestamp"))
    return df


def month_scope(df: DataFrame, month: str | None, column: str = "txn_month") -> DataFrame:
    """One month, as a literal filter on the partition column; all months if None."""
    return df if month is None else df.where(F.col(column) == F.lit(date.fromisoformat(month)))

"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Column | Sequence[str | Column] = "ingestion_ts",
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The row with the highest ``order`` per key; NULL orders come last.

    Strings are SQL expressions. ``tie_break`` makes the order total, so the result does not depend on how
    rows happen to be partitioned; by default it is ``record_hash`` if present.

    The filter on rank 1 lets Spark keep only each task's own best row per key
    before the shuffle, so a key that owns a third of the table sends one row
    per task and not its whole group.
    """
    first = [order] if isinstance(order, (str, Column)) else list(order)
    if tie_break is None:
        tie_break = ["record_hash"] if "record_hash" in df.columns else []
    ranking = [(F.expr(c) if isinstance(c, str) else c).desc_nulls_last() for c in [*first, *tie_break]]
    w = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")

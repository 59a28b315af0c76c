"""Upserts and surrogate keys for tables without a native MERGE.

The merge is a full outer join of the target slice and the source on the key,
evaluated once. Keys are unique on both sides, so no key is hotter than two
rows; a slice is normally one month, pruned by partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions import columns as C
from cardlake.functions.hashing import packed, unpacked

ACTION = "__action"
INSERTED, UPDATED, UNCHANGED, DELETED = "inserted", "updated", "unchanged", "deleted"


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hash_col: str | None = None,
    keep_cols: Sequence[str] = (),
    compare_cols: Sequence[str] = (),
    delete_missing: bool = False,
) -> DataFrame:
    """The merged rows in the target's columns, each with its action.

    A matched row is replaced if ``hash_col`` differs (NULL counts as blank),
    or if one of ``compare_cols`` differs, or always if neither is given.
    ``keep_cols`` keep the target's value on update. Target rows the source
    lacks stay, or are marked deleted.
    """
    # Keys are dealt once, beside the other columns; hashes in half their length.
    text = hash_col and hash_col not in keys and all(isinstance(df.schema[hash_col].dataType, T.StringType) for df in (target, source))
    short = [hash_col] if text else []
    others = [packed(c).alias(c) if c in short else F.col(c) for c in target.columns if c not in keys] or [F.lit(True)]
    t = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys], F.struct(*others).alias("t"))
    s = source.select(*[F.col(k).alias(f"__s_{k}") for k in keys], F.struct(*others).alias("s"))

    def of(side: str, c: str) -> Column:
        value = F.col(f"__{side}_{c}" if c in keys else f"{side}.{c}")
        return unpacked(value) if c in short else value

    joined = t.join(s, C.all_of([F.col(f"__t_{k}") == F.col(f"__s_{k}") for k in keys]), "full_outer")
    if hash_col:
        blank = F.lit("")
        changed = F.coalesce(of("t", hash_col), blank) != F.coalesce(of("s", hash_col), blank)
    elif compare_cols:
        changed = C.any_of([C.differs(of("t", c), of("s", c)) for c in compare_cols])
    else:
        changed = F.lit(True)
    only_target = F.col("s").isNull()
    action = (
        F.when(only_target, DELETED if delete_missing else UNCHANGED)
        .when(F.col("t").isNull(), INSERTED)
        .when(changed, UPDATED)
        .otherwise(UNCHANGED)
    )
    from_source = F.col(ACTION).isin(INSERTED, UPDATED)
    columns = []
    for c in target.columns:
        taken = F.col(ACTION) == INSERTED if c in keep_cols else from_source
        value = F.when(taken, of("s", c)).otherwise(of("t", c))
        columns.append(value.alias(c))
    return joined.withColumn(ACTION, action).select(*columns, ACTION)


def action_metrics() -> dict[str, Column]:
    """Row counts by action, fit for ``agg`` and for ``observe`` on the write."""
    return {
        f"rows_{a}": F.count_if(F.col(ACTION) == a) for a in (INSERTED, UPDATED, UNCHANGED, DELETED)
    }


def merged_table(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(ACTION) != DELETED).drop(ACTION)


def merge_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(*[m.alias(k) for k, m in action_metrics().items()])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hash_col: str | None = None,
    keep_cols: Sequence[str] = (),
    compare_cols: Sequence[str] = (),
    delete_missing: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(merged table, one row of counts). A job that wants both from a single
    evaluation writes ``merge_rows`` with ``action_metrics`` observed."""
    rows = merge_rows(target, source, keys, hash_col, keep_cols, compare_cols, delete_missing)
    return merged_table(rows), merge_stats(rows)


def number_rows(df: DataFrame, key: str, name: str, existing: DataFrame | None = None) -> DataFrame:
    """Distinct, gap-free numbers for rows with a unique ``key``, after the
    highest ``name`` in ``existing``.

    Numbering everything in one ordered window would pull the table into one
    task. Rows are instead spread over 4,096 buckets by the hash of their key;
    each bucket is numbered on its own and shifted by the rows of the buckets
    before it. Only those 4,096 counts are ever in one place. The number of a
    row depends on the set of keys alone, not on partitioning.
    """
    bucketed = df.withColumn("__bucket", F.substring(F.md5(F.col(key).cast("string")), 1, 3))
    sizes = bucketed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    if existing is not None:
        base = existing.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint").alias("__n"))
        sizes = sizes.unionByName(base.withColumn("__bucket", F.lit("")))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    within = Window.partitionBy("__bucket").orderBy(F.col(key).cast("string"))
    return (
        bucketed.withColumn("__row", F.row_number().over(within))
        .join(F.broadcast(shifts), "__bucket")
        .withColumn(name, (F.col("__shift") + F.col("__row")).cast("bigint"))
        .select(*df.columns, name)
    )


def assign_surrogate(dim: DataFrame, source: DataFrame, natural_key: str, key_col: str) -> DataFrame:
    """``source`` with ``key_col``: numbered for keys new to ``dim``, NULL for
    the others, which keep the key they have."""
    fresh = source.select(natural_key).join(dim.select(natural_key), natural_key, "left_anti")
    numbered = number_rows(fresh, natural_key, key_col, dim)
    return source.join(numbered, natural_key, "left")

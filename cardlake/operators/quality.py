"""Data checks. All row-level checks of a table share one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions import columns as C
from cardlake.plans.contracts import Contract, spark_type, type_family

RESULT = "check STRING, issue_count BIGINT, status STRING"


class QualityError(ValueError):
    def __init__(self, table: str, issues: dict):
        self.issues = dict(issues)
        super().__init__(f"{table}: failed checks {self.issues}")


@dataclass(frozen=True)
class Check:
    """A named check.

    ``violation`` marks offending rows; the other fields describe checks that
    are not about single rows.
    """

    name: str
    violation: Column | None = None
    unique_key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    max_distinct: int | None = None
    expected_rows: int | None = None


def not_null(cols: Sequence[str] | str, name: str | None = None) -> list[Check]:
    """One check per column, or one check named ``name`` over all of them."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if name:
        return [Check(name, C.any_of([F.col(c).isNull() for c in cols]))]
    return [Check(f"{c}_not_null", F.col(c).isNull()) for c in cols]


def not_blank(column: str, name: str | None = None) -> Check:
    return Check(name or f"{column}_not_blank", C.is_blank(column))


def matches(column: str, pattern: str, name: str | None = None) -> Check:
    bad = F.col(column).isNull() | ~F.col(column).rlike(pattern)
    return Check(name or f"{column}_matches", bad)


def equals(column: str, value, name: str | None = None) -> Check:
    return Check(name or f"{column}_is_{value}", C.differs(F.col(column), F.lit(value)))


def unique(keys: Sequence[str], name: str | None = None) -> Check:
    return Check(name or f"{'_'.join(keys)}_unique", unique_key=tuple(keys))


def partition_ok(
    cols: Sequence[str], max_distinct: int | None = 300, allow_nulls: bool = False
) -> list[Check]:
    """No NULL in the partition columns and no more partitions than allowed."""
    checks = [] if allow_nulls else [
        Check(f"{c}_partition_not_null", F.col(c).isNull()) for c in cols
    ]
    if max_distinct is not None:
        checks.append(
            Check("partition_count_in_limit", partition_by=tuple(cols), max_distinct=max_distinct)
        )
    return checks


def row_count_is(n: int, name: str = "row_count") -> Check:
    return Check(name, expected_rows=n)


def row_metrics(checks: Sequence[Check]) -> dict[str, Column]:
    """Aggregates counting the violations, fit for ``agg`` and for ``observe``."""
    out = {}
    for c in checks:
        if c.violation is not None:
            out[c.name] = F.count_if(F.coalesce(c.violation, F.lit(False)))
        elif c.expected_rows is not None:
            out[c.name] = F.abs(F.count(F.lit(1)) - F.lit(c.expected_rows))
    return out


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row (check, issue_count, status) per check.

    Row checks and the partition limit come from one pass: counts are taken per
    partition value first and summed after, so the number of partitions is the
    number of rows in between and no distinct set is held anywhere. A unique
    check needs its own aggregation on its key.
    """
    counted = row_metrics(checks)
    limits = [c for c in checks if c.max_distinct is not None]
    parts = []
    if counted or limits:
        keys = list(dict.fromkeys(k for c in limits for k in c.partition_by))
        plain = {c.name for c in checks if c.violation is not None}
        rows_checks = {c.name: c.expected_rows for c in checks if c.expected_rows is not None}
        first = [counted[n].alias(n) for n in plain] + [F.count(F.lit(1)).alias("__rows")]
        level = df.groupBy(*keys).agg(*first)
        final = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in plain]
        for n, expected in rows_checks.items():
            final.append(F.abs(F.coalesce(F.sum("__rows"), F.lit(0)) - F.lit(expected)).alias(n))
        for c in limits:
            known = C.all_of([F.col(k).isNotNull() for k in c.partition_by])
            n = F.count_if(known) if len(limits) == 1 else F.countDistinct(F.when(known, F.struct(*c.partition_by)))
            final.append(F.when(n > c.max_distinct, n - c.max_distinct).otherwise(0).alias(c.name))
        one = level.agg(*final)
        names = [c.name for c in checks if c.violation is not None or c.expected_rows is not None or c.max_distinct is not None]
        entries = [F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").cast("bigint").alias("issue_count")) for n in names]
        parts.append(one.select(F.inline(F.array(*entries))))
    for c in checks:
        if c.unique_key:
            dup = duplicate_keys(df, c.unique_key)
            parts.append(dup.agg(F.count(F.lit(1)).alias("issue_count")).select(F.lit(c.name).alias("check"), "issue_count"))
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT)
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result.withColumn("status", F.when(F.col("issue_count") == 0, "PASS").otherwise("FAIL"))


def assert_passed(results: DataFrame, table: str = "table") -> None:
    """Raise if any check failed. Only failed checks reach the driver."""
    failed = results.where("status = 'FAIL'").collect()
    if failed:
        raise QualityError(table, {r["check"]: r["issue_count"] for r in failed})


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    if not keys:
        raise ValueError("duplicate check needs key columns")
    scoped = df if where is None else df.where(where)
    return scoped.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


# --- structure: no data is read ---------------------------------------------


def require_columns(df: DataFrame, cols: Sequence[str], context: str = "") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"[{context}] missing columns: {missing}")
    return df


def forbid_extra_columns(df: DataFrame, cols: Sequence[str], context: str = "") -> DataFrame:
    extra = sorted(set(df.columns) - set(cols))
    if extra:
        raise ValueError(f"[{context}] unexpected columns: {extra}")
    return df


def require_types(
    df: DataFrame, expected: dict[str, T.DataType], context: str = "", ignore_precision: bool = False
) -> DataFrame:
    """Column types must agree; decimals with their precision unless told otherwise."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = []
    for name, kind in expected.items():
        have = actual.get(name)
        if ignore_precision and have is not None:
            same = type_family(have.simpleString()) == type_family(kind.simpleString())
        else:
            same = have == kind
        if not same:
            wrong.append((name, have.simpleString() if have else "MISSING", kind.simpleString()))
    if wrong:
        raise ValueError(f"[{context}] type mismatches (column, actual, expected): {wrong}")
    return df


def require_date_partitions(df: DataFrame, cols: Sequence[str], context: str = "") -> DataFrame:
    require_columns(df, cols, context)
    return require_types(df, {c: T.DateType() for c in cols}, context)


def contract_checks(c: Contract, with_unique: bool = True) -> list[Check]:
    """Constraints of a contract as checks: NOT NULL, partitions, unique keys."""
    checks = not_null(c.not_null)
    if c.partition_by:
        checks += partition_ok(c.partition_by, c.max_partitions)
    if with_unique:
        checks += [unique(u) for u in c.unique]
    return checks


def check_contract(df: DataFrame, c: Contract, with_unique: bool = True) -> DataFrame:
    """Structure at once (raises), data constraints as check rows."""
    require_columns(df, c.names, c.table)
    forbid_extra_columns(df, c.names, c.table)
    require_types(df, {k.name: spark_type(k.type) for k in c.columns}, c.table)
    return run_checks(df, contract_checks(c, with_unique))

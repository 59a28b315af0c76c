"""Conformance of a fact to its dimensions.

Rules form a chain: a row is reported under the first rule it fails. One pass
left-joins the de-duplicated key set of every dimension with a marker and reads
the failing rule off the markers, so the fact is scanned and carried once.

Joins and size. No join carries a hint: Spark broadcasts a key set only below
its measured size threshold and otherwise runs a shuffled join. Key sets that a
domain bounds (codes of four digits, days of a calendar) are marked ``bounded``:
for them a search for orphan keys ahead of the join gains nothing. Adaptive
execution splits a skewed partition of such a join only if both inputs come
straight from a shuffle; an aggregate in between would hide it. Dimensions
whose contract already makes the key ``unique`` are therefore joined as they
are, without another distinct. For tables of that size
``orphan_keys`` gives a shorter way: the keys missing in a dimension are found
on the distinct keys alone, and only they are joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.functions.hashing import key_hash, natural_keys_json
from cardlake.operators.projection import require_text

FAILED_RULE = "__failed_rule"


@dataclass(frozen=True)
class Rule:
    """Every ``fact_key`` must occur as ``dim_key`` in ``dim``.

    Set ``unique`` only where a contract keeps ``dim_key`` unique: repeated
    keys would repeat fact rows.
    """

    fact_key: str
    dim: DataFrame
    dim_key: str
    rule_id: str
    anom_type: str
    severity: str = "HIGH"
    event_keys: tuple[str, ...] = ()
    bounded: bool = False
    unique: bool = False

    @property
    def detail(self) -> str:
        return f"Orphan detected: {self.fact_key} not found in dim ({self.dim_key})."


def _key_set(fact: DataFrame, rule: Rule, name: str) -> DataFrame:
    kind = fact.schema[rule.fact_key].dataType
    keys = rule.dim.select(F.col(rule.dim_key).cast(kind).alias(name)).where(F.col(name).isNotNull())
    return keys if rule.unique else keys.dropDuplicates()


def orphan_keys(fact: DataFrame, rule: Rule) -> DataFrame:
    """Distinct fact keys the dimension does not hold (NULL is not listed).

    The distinct runs map-side first, so a hot key is one row per task before
    anything is shuffled.
    """
    present = fact.select(rule.fact_key).where(F.col(rule.fact_key).isNotNull()).dropDuplicates()
    known = _key_set(fact, rule, "__known")
    return present.join(known, F.col(rule.fact_key) == F.col("__known"), "left_anti")


def tag_orphans(
    fact: DataFrame,
    rules: Sequence[Rule],
    keep_null_key: bool = False,
    orphan_sets: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """``fact`` with the position of the first rule each row fails, NULL if none.

    A NULL key fails its rule unless ``keep_null_key``. ``orphan_sets`` maps a
    rule id to its stored ``orphan_keys``; such a rule joins those few keys
    instead of the dimension.
    """
    tagged, failures = fact, []
    for i, rule in enumerate(rules):
        key, mark, known = F.col(rule.fact_key), f"__mark{i}", f"__key{i}"
        orphans = (orphan_sets or {}).get(rule.rule_id)
        if orphans is None:
            side = _key_set(fact, rule, known).withColumn(mark, F.lit(True))
            failed = F.col(mark).isNull()
        else:
            side = orphans.select(F.col(rule.fact_key).alias(known)).withColumn(mark, F.lit(True))
            failed = F.col(mark).isNotNull() | key.isNull()
        tagged = tagged.join(side, key == F.col(known), "left")
        if keep_null_key:
            failed = failed & key.isNotNull()
        failures.append(F.when(failed, F.lit(i)))
    return tagged.select(*fact.columns, F.coalesce(*failures).alias(FAILED_RULE))


def conforming(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(FAILED_RULE).isNull()).drop(FAILED_RULE)


def orphan_events(
    tagged: DataFrame,
    rules: Sequence[Rule],
    run_id: str,
    entity: str,
    source_table: str,
    now: Column | None = None,
) -> DataFrame:
    """One event per rejected row."""
    now = F.current_timestamp() if now is None else now
    described = [
        F.when(
            F.col(FAILED_RULE) == i,
            F.struct(
                F.lit(r.anom_type).alias("anom_type"),
                F.lit(r.severity).alias("severity"),
                F.lit(r.rule_id).alias("rule_id"),
                key_hash(r.event_keys or (r.fact_key,)).alias("key_hash"),
                natural_keys_json(r.event_keys or (r.fact_key,)).alias("natural_keys"),
                F.lit(r.detail).alias("detail"),
            ),
        )
        for i, r in enumerate(rules)
    ]
    rejected = tagged.where(F.col(FAILED_RULE).isNotNull())
    return rejected.select(F.coalesce(*described).alias("e"), now.alias("__now")).select(
        F.lit(require_text(run_id, "run_id")).alias("gold_run_id"),
        F.col("__now").alias("event_ts"),
        F.lit(require_text(entity, "entity")).alias("entity"),
        F.lit("CONFORMANCE").alias("anom_domain"),
        "e.anom_type",
        "e.severity",
        "e.rule_id",
        "e.key_hash",
        "e.natural_keys",
        F.lit(source_table).alias("source_table"),
        "e.detail",
        F.col("__now").alias("gold_load_ts"),
    )


def conform_split(
    fact: DataFrame,
    rules: Sequence[Rule],
    run_id: str,
    entity: str,
    source_table: str,
    keep_null_key: bool = False,
    now: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(conforming rows, orphan events).

    Both come from one lazy plan; a job that writes both should stage the
    tagged rows first (see ``gold.build_fact``).
    """
    tagged = tag_orphans(fact, rules, keep_null_key)
    return conforming(tagged), orphan_events(tagged, rules, run_id, entity, source_table, now)


def orphan_report(fact: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows failing each rule on its own, none rejected: (rule_id, issue_count).

    The fact is counted per key before the join, so the join sees one row per
    distinct key however often a key occurs.
    """
    parts = []
    for rule in rules:
        counted = fact.groupBy(rule.fact_key).agg(F.count(F.lit(1)).alias("n"))
        known = _key_set(fact, rule, "__known")
        missing = counted.join(known, F.col(rule.fact_key) == F.col("__known"), "left_anti")
        parts.append(
            missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("issue_count")).select(
                F.lit(rule.rule_id).alias("rule_id"),
                F.lit(rule.anom_type).alias("anom_type"),
                F.lit(rule.severity).alias("severity"),
                "issue_count",
            )
        )
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


_KPI_GROUP = ["anom_domain", "anom_type", "severity", "rule_id"]


def anomaly_kpis(
    events: DataFrame, run_id: str, entity: str, sample_limit: int = 10, now: Column | None = None
) -> DataFrame:
    """Events counted per rule, with up to ``sample_limit`` natural keys each.

    Samples are the first keys in text order. They are cut by rank before they
    are collected, so a rule with billions of events collects ten strings.
    """
    now = F.current_timestamp() if now is None else now
    counts = events.groupBy(*_KPI_GROUP).agg(F.count(F.lit(1)).alias("row_count"))
    first = Window.partitionBy(*_KPI_GROUP).orderBy("natural_keys")
    samples = (
        events.select(*_KPI_GROUP, "natural_keys")
        .withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") <= sample_limit)
        .groupBy(*_KPI_GROUP)
        .agg(F.to_json(F.sort_array(F.collect_list("natural_keys"))).alias("sample_keys"))
    )
    return counts.join(samples, _KPI_GROUP).select(
        F.lit(require_text(run_id, "run_id")).alias("gold_run_id"),
        now.alias("kpi_ts"),
        F.lit(require_text(entity, "entity")).alias("entity"),
        *_KPI_GROUP,
        "row_count",
        "sample_keys",
        now.alias("gold_load_ts"),
    )


def anomaly_count(events: DataFrame, run_id: str, entity: str) -> DataFrame:
    """Events of one run and entity, as one row."""
    return events.where((F.col("gold_run_id") == run_id) & (F.col("entity") == entity)).agg(
        F.count(F.lit(1)).alias("anom_count")
    )

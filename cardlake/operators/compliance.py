"""Declared schemas against live tables, and values against declared types."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.plans import contracts as K

_COLUMNS = "table_name string, name string, position int, type string"


def schema_rows(spark: SparkSession, schemas: Mapping[str, Iterable[tuple[str, str]]]) -> DataFrame:
    """One row per column of each schema: (table, name, position, type family)."""
    rows = [
        (table, name, i, K.type_family(kind))
        for table, columns in schemas.items()
        for i, (name, kind) in enumerate(columns)
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def compare_columns(expected: DataFrame, live: DataFrame, strict_order: bool = True) -> DataFrame:
    """Per table: columns missing, extra and of another type, and whether the
    ordered lists of names differ. A full outer join of the two column lists."""
    e = expected.select("table_name", "name", F.col("position").alias("e_pos"), F.col("type").alias("e_type"))
    a = live.select("table_name", "name", F.col("position").alias("a_pos"), F.col("type").alias("a_type"))
    both = e.join(a, ["table_name", "name"], "full_outer")

    def ordered(when: Column, position: str, value: Column) -> Column:
        kept = F.sort_array(F.collect_list(F.when(when, F.struct(F.col(position).alias("p"), value.alias("v")))))
        return F.transform(kept, lambda x: x["v"])

    missing, extra = F.col("a_pos").isNull(), F.col("e_pos").isNull()
    mismatch = F.struct(
        F.col("name").alias("column"), F.col("e_type").alias("expected"), F.col("a_type").alias("actual")
    )
    wrong = F.collect_list(F.when(~missing & ~extra & (F.col("e_type") != F.col("a_type")), mismatch))
    lists = both.groupBy("table_name").agg(
        ordered(missing, "e_pos", F.col("name")).alias("missing"),
        ordered(extra, "a_pos", F.col("name")).alias("extra"),
        F.sort_array(wrong).alias("wrong"),
        ordered(~extra, "e_pos", F.col("name")).alias("expected_order"),
        ordered(~missing, "a_pos", F.col("name")).alias("actual_order"),
    )
    disorder = F.lit(strict_order) & (F.col("expected_order") != F.col("actual_order"))
    bad = (F.size("missing") > 0) | (F.size("extra") > 0) | (F.size("wrong") > 0) | disorder
    return lists.select(
        "table_name",
        F.when(bad, "FAIL").otherwise("PASS").alias("compliance_status"),
        F.to_json("missing").alias("missing_columns"),
        F.to_json("extra").alias("extra_columns"),
        F.to_json("wrong").alias("type_mismatches"),
        disorder.cast("string").alias("order_mismatch"),
        F.when(disorder, F.to_json(F.struct("expected_order", "actual_order"))).alias("order_details"),
    )


def column_differences(expected: DataFrame, live: DataFrame) -> DataFrame:
    """One row per column of either side: OK, MISSING, EXTRA or TYPE."""
    e = expected.select("table_name", "name", F.col("type").alias("expected_type"))
    a = live.select("table_name", "name", F.col("type").alias("actual_type"))
    verdict = (
        F.when(F.col("actual_type").isNull(), "MISSING")
        .when(F.col("expected_type").isNull(), "EXTRA")
        .when(F.col("expected_type") != F.col("actual_type"), "TYPE")
        .otherwise("OK")
    )
    return e.join(a, ["table_name", "name"], "full_outer").withColumn("verdict", verdict)


def schema_compliance(
    spark: SparkSession,
    contracts: Iterable[K.Contract],
    resolve: Callable[[str], DataFrame] | None = None,
    strict_order: bool = True,
    fail_on_missing_table: bool = False,
    run_ts: str = "",
) -> DataFrame:
    """One row per contract: PASS, FAIL or MISSING_TABLE with the differences.

    Nullability and decimal precision are not compared.
    """
    contracts = list(contracts)
    resolve = resolve or spark.table
    live = {}
    for c in contracts:
        try:
            live[c.table] = [(f.name, f.dataType.simpleString()) for f in resolve(c.table).schema.fields]
        except (AnalysisException, KeyError):
            continue
    declared = {c.table: [(k.name, k.type) for k in c.columns] for c in contracts if c.table in live}
    registry = spark.createDataFrame(
        [(c.layer, c.entity, c.table, c.source, c.status) for c in contracts],
        "layer string, entity string, table_name string, registry_path string, registry_status string",
    )
    found = compare_columns(schema_rows(spark, declared), schema_rows(spark, live), strict_order)
    absent = "FAIL" if fail_on_missing_table else "MISSING_TABLE"
    defaults = {
        "compliance_status": absent,
        "missing_columns": "[]",
        "extra_columns": "[]",
        "type_mismatches": "[]",
        "order_mismatch": "false",
    }
    rows = registry.join(found, "table_name", "left").withColumn("run_ts_utc", F.lit(run_ts))
    return K.project_to_contract(rows.fillna(defaults), K.SCHEMA_COMPLIANCE)


def compliance_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("compliance_status").agg(F.count(F.lit(1)).alias("tables")).orderBy(
        F.desc("tables")
    )


def compliance_listing(results: DataFrame) -> DataFrame:
    return results.orderBy(F.desc("compliance_status"), "entity")


def value_drift(raw: DataFrame, spec: dict) -> DataFrame:
    """Per column of a bronze spec: values present, and values its reader turns
    into NULL. One aggregation over the raw text, then one row per column."""
    aggregates, entries = [], []
    for i, (name, entry) in enumerate(spec.items()):
        source, read = entry if isinstance(entry, tuple) else (name, entry)
        text = F.col(source)
        present = text.isNotNull() & (F.trim(text.cast("string")) != "")
        aggregates += [
            F.count_if(present).alias(f"p{i}"),
            F.count_if(present & read(text).isNull()).alias(f"d{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"p{i}").alias("present_count"),
                F.col(f"d{i}").alias("drift_count"),
            )
        )
    return raw.agg(*aggregates).select(F.inline(F.array(*entries)))

"""Shapes of physical plans, and results under skew and without broadcasts."""

import pytest
from conftest import SF, rows
from oracle import connect, differences
from pyspark.sql import functions as F

from cardlake.catalog import views as V
from cardlake.catalog.queries import ORACLE, QUERIES
from cardlake.operators.projection import filter_as_of, month_scope
from cardlake.plans import controls, gold, measures, warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are for tables beyond the broadcast threshold."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(names[0])
    for n in names:
        spark.conf.set(n, "-1")
    yield
    spark.conf.set(names[0], before)
    spark.conf.unset(names[1])


def test_month_scope_prunes_partitions(spark, sf):
    text = plan(month_scope(V.stored_fact(spark, sf), "1998-03-01").select("amount"))
    assert "PartitionFilters: [isnotnull(txn_month" in text and "(txn_month" in text
    assert "ReadSchema: struct<amount:decimal(18,2)>" in text


def test_as_of_filter_reaches_the_scan(spark, sf, path):
    V.bronze_transactions(spark, sf).write.parquet(path("b"))
    df = filter_as_of(spark.read.parquet(path("b")), "TRANSACTION", "1998-03-01")
    assert "GreaterThanOrEqual(date,1998-03-01" in plan(df) and "LessThan(date,1998-03-02" in plan(df)


def test_fact_is_scanned_once_and_no_side_is_broadcast_by_hint(spark, sf, no_broadcast, path):
    V.silver_transactions(spark, sf).write.parquet(path("s"))
    silver = spark.read.parquet(path("s"))
    good, _ = gold.fact_transactions(
        silver, *[V.stored_gold(spark, sf, n) for n in ("users", "cards", "mcc")], V.gold_dates(spark),
        "r", F.col("txn_ts"), V.TXN_TIES,
    )
    text = plan(good)
    assert text.count(path("s")) == 1
    assert text.count("SortMergeJoin") == 4 and "BroadcastHashJoin" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_controls_count_before_they_join(spark, sf, no_broadcast):
    df = controls.ctl_orphans(
        V.stored_fact(spark, sf), V.stored_dims(spark, sf), controls.Run("r", F.lit("2020-01-01").cast("timestamp")), "1998-03-01"
    )
    text = plan(df)
    for part in text.split("SortMergeJoin")[1:]:
        assert "HashAggregate" in part


def test_no_python_and_no_cross_join_in_any_query(spark, sf):
    for name, make in QUERIES.items():
        if name.startswith(("stream_", "ingest_", "silver_incremental", "gold_fact_loaded", "dimension_without")):
            continue
        text = plan(make(spark, sf))
        for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)


@pytest.mark.parametrize(
    "name",
    ["gold_fact_transactions", "anomaly_events", "wh_fact_transactions", "ctl_orphans", "kpi_by_brand", "kpi_cube_brand_month", "spend_by_mcc"],
)
def test_results_without_broadcast(spark, no_broadcast, name):
    con = connect(SF)
    assert differences(QUERIES[name](spark, SF), ORACLE[name], con) == []


def test_hot_keys(spark, no_broadcast):
    """One card, user and merchant own a third of all rows; small skew limits
    make the run-time splitting work on test data."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    sf = "/root/testdata/sf0.01"
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.col("transaction_id") % 3 == 0
        silver = V.silver_transactions(spark, sf).withColumns(
            {
                "card_id": F.when(hot, 5).otherwise(F.col("card_id")),
                "client_id": F.when(hot, 7).otherwise(F.col("client_id")),
                "merchant_id": F.when(hot, 1).otherwise(F.col("merchant_id")),
            }
        )
        users, cards, mcc = [V.stored_gold(spark, sf, n) for n in ("users", "cards", "mcc")]
        good, events = gold.fact_transactions(
            silver, users, cards, mcc, V.gold_dates(spark), "r", F.col("txn_ts"), V.TXN_TIES
        )
        known = {n: {r[0] for r in df.collect()} for n, df in (
            ("u", users.select("client_id")), ("c", cards.select("card_id")), ("m", mcc.select("mcc_code")),
            ("d", V.gold_dates(spark).select("date_value")),
        )}
        expected = {r["transaction_id"]: r for r in silver.collect()}
        kept = {
            k for k, r in expected.items()
            if r["client_id"] in known["u"] and r["card_id"] in known["c"] and r["mcc_code"] in known["m"] and r["txn_date"] in known["d"]
        }
        got = good.select("transaction_id", F.sha2("record_hash", 256).alias("h"), "merchant_city", "zip")
        assert {r[0] for r in got.collect()} == kept
        assert "SortMergeJoin(skew=true)" in plan(got)
        assert events.count() == len(expected) - len(kept)
        fact = warehouse.wh_fact(good, V.stored_dims(spark, sf))
        top = measures.top1_share(fact, "merchant_id").first()
        amounts = {}
        for k in kept:
            amounts[expected[k]["merchant_id"]] = amounts.get(expected[k]["merchant_id"], 0) + expected[k]["amount"]
        assert top["top1_amount"] == max(amounts.values()) and top["total_amount"] == sum(amounts.values())
        by_brand = rows(measures.business_measures(fact, V.stored_dims(spark, sf), ["card_brand"]), "txn_count_total")
        assert sum(r[0] for r in by_brand) == len(kept)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

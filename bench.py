"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed ``BENCH_RUNS`` times (median).
A query runs from its input tables to a full result (noop sink), with nothing
cached between runs. Input tables of the warehouse queries are written once
beforehand, as tables are in use.

``contrast`` times the same results by plans of the step-by-step kind: a count
after every step, a semi and an anti join per dimension, one scan per check.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cardlake.catalog import landing as L  # noqa: E402
from cardlake.catalog import queries as Q  # noqa: E402
from cardlake.catalog import views as V  # noqa: E402
from cardlake.operators import quality  # noqa: E402
from cardlake.plans import gold, ingest, measures, runlog, silver, warehouse  # noqa: E402
from cardlake.session import get_spark  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def prepare(spark, work: str) -> dict:
    """Bronze and gold as tables, the way the steps below find them."""
    L.transactions(spark, SF_DIR).write.option("header", True).csv(f"{work}/in")
    V.bronze_transactions(spark, SF_DIR).write.parquet(f"{work}/bronze")
    bronze = spark.read.parquet(f"{work}/bronze")
    silver.silver_transactions(bronze, tie_break=V.TXN_TIES).write.parquet(f"{work}/silver")
    fact, dims = V.stored_fact(spark, SF_DIR), V.stored_dims(spark, SF_DIR)
    gold_dims = V.fact_dims(spark, SF_DIR)
    dates = V._stored(spark, SF_DIR, "gold_dates", lambda: V.gold_dates(spark))
    return {"bronze": bronze, "silver": spark.read.parquet(f"{work}/silver"), "fact": fact, "dims": dims,
            "gold_dims": [*gold_dims, dates], "log": Q.job_log(spark, SF_DIR), "dq": Q.dq_log(spark, SF_DIR),
            "registry": Q.registry(spark, SF_DIR)}


def headline(t: dict) -> dict:
    """Name -> action of this library's plans."""

    def silver_transactions():
        """Load with all checks: one pass, counts observed on the write."""
        from pyspark.sql import Observation

        seen = Observation()
        checks = quality.row_metrics(silver.transaction_checks())
        df = silver.silver_transactions(t["bronze"], tie_break=V.TXN_TIES)
        sink(df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in checks.items()]))
        return seen.get

    def gold_fact():
        good, events = gold.fact_transactions(t["silver"], *t["gold_dims"], V.RUN_ID, F.col("txn_ts"), V.TXN_TIES)
        sink(good)

    def gold_events():
        sink(gold.fact_transactions(t["silver"], *t["gold_dims"], V.RUN_ID, F.col("txn_ts"), V.TXN_TIES)[1])

    return {
        "silver_transactions": silver_transactions,
        "gold_fact": gold_fact,
        "gold_events": gold_events,
        "fact_daily": lambda: sink(warehouse.fact_daily(t["fact"])),
        "fact_monthly": lambda: sink(warehouse.fact_monthly(t["fact"])),
        "run_rollup": lambda: sink(
            runlog.run_rollup(t["log"], t["dq"], t["registry"], Q.now(), log_tie="event_id", dq_tie="event_id")
        ),
        "top1_share": lambda: sink(measures.top1_share(t["fact"], "merchant_id")),
        "kpi_by_brand": lambda: sink(measures.business_measures(t["fact"], t["dims"], ["card_brand"])),
        "kpi_cube": lambda: sink(measures.business_measures(t["fact"], t["dims"], ["card_brand", "txn_month"], "cube")),
        "spend_by_mcc": lambda: sink(measures.spend_by(t["fact"], t["dims"], ["mcc_code"])),
    }


def loads(spark, t: dict, work: str) -> dict:
    """The loads as a user runs them, each into a table of its own."""

    def fresh() -> str:
        return f"{work}/load-{uuid.uuid4().hex}"

    def ingest_files():
        home = fresh()
        ingest.ingest(spark, "TRANSACTION", f"{work}/in", f"{home}/bronze", f"{home}/manifest", f"{home}/log", "2001-07-01", uuid.uuid4().hex)

    def build_fact():
        home = fresh()
        gold.build_fact(t["silver"], *t["gold_dims"], f"{home}/fact", f"{home}/events", f"{home}/kpis", uuid.uuid4().hex)

    stored = fresh()
    warehouse.refresh_slice(t["fact"], "fact_transactions", stored, uuid.uuid4().hex)
    month = t["fact"].where(F.col("txn_month") == "1998-02-01").withColumn("record_hash", F.reverse("record_hash"))
    return {
        "ingest": ingest_files,
        "build_silver": lambda: silver.build_silver(t["bronze"], "TRANSACTION", fresh(), uuid.uuid4().hex, tie_break=V.TXN_TIES),
        "build_fact": build_fact,
        "refresh_slice": lambda: warehouse.refresh_slice(
            month.withColumn("record_hash", F.concat("record_hash", F.lit(uuid.uuid4().hex))), "fact_transactions", stored, uuid.uuid4().hex),
    }


def contrast(t: dict) -> dict:
    """The same results step by step."""

    def silver_transactions():
        t["bronze"].count()
        df = silver.silver_transactions(t["bronze"], tie_break=V.TXN_TIES)
        df.count()
        for c in ("transaction_id", "txn_ts", "txn_month", "amount", "mcc_code", "client_id", "card_id", "merchant_id", "error_code"):
            df.where(F.col(c).isNull()).limit(1).count()
        df.select(F.count_if(F.col("txn_month").isNull())).collect()
        df.select("txn_month").distinct().count()
        sink(df)

    def gold_fact():
        df = gold.deduped_fact(t["silver"], V.TXN_TIES)
        df.count()
        df.groupBy("transaction_id").count().where("count > 1").limit(1).count()
        events = []
        for rule in gold.fact_rules(*t["gold_dims"]):
            keys = rule.dim.select(rule.dim_key).dropDuplicates()
            events.append(df.join(keys, rule.fact_key, "left_anti").select("transaction_id"))
            df = df.join(keys, rule.fact_key, "left_semi")
        for e in events:
            e.count()
        df.count()
        sink(df)

    def fact_daily():
        warehouse.fact_daily(t["fact"]).count()
        sink(warehouse.fact_daily(t["fact"]))
        sink(warehouse.fact_daily(t["fact"]))

    def fact_monthly():
        warehouse.fact_monthly(t["fact"]).count()
        sink(warehouse.fact_monthly(t["fact"]))
        sink(warehouse.fact_monthly(t["fact"]))

    def top1_share():
        total = t["fact"].agg(F.sum("amount")).first()[0]
        top = t["fact"].groupBy("merchant_id").agg(F.sum("amount").alias("a")).orderBy(F.desc("a")).first()
        return top["a"] / total

    return {"silver_transactions": silver_transactions, "gold_fact": gold_fact, "fact_daily": fact_daily,
            "fact_monthly": fact_monthly, "top1_share": top1_share}


def timed(actions: dict, runs: int) -> dict:
    out = {}
    for name, action in actions.items():
        action()
        spent = []
        for _ in range(runs):
            start = time.perf_counter()
            action()
            spent.append(time.perf_counter() - start)
        out[name] = round(statistics.median(spent), 3)
    return out


def main() -> None:
    work = tempfile.mkdtemp(prefix="cardlake-bench-")
    spark = get_spark(
        "cardlake-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{work}/checkpoint",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = prepare(spark, work)
    ours = timed(headline(tables), RUNS)
    stepwise = timed(contrast(tables), 1) if os.environ.get("BENCH_CONTRAST", "1") == "1" else {}
    whole = timed(loads(spark, tables, work), 1) if os.environ.get("BENCH_LOADS", "1") == "1" else {}
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(ours.values()), 3), "unit": "sec",
        "queries": ours, "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": int(CPUS), "runs": RUNS, "contrast": stepwise, "loads": whole,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""What the shuffles of large tables carry, and how long their files stay."""

import os
import re
import threading
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import no_broadcast, plan  # noqa: F401

from cardlake.catalog import views as V
from cardlake.catalog.queries import QUERIES
from cardlake.functions.hashing import packed, unpacked
from cardlake.operators.dedup import dedup_latest
from cardlake.operators.upsert import merge_rows
from cardlake.plans import gold, measures, silver, warehouse
from cardlake.session import CLEANUP_CONF, shuffles_freed
from cardlake.sources import versions, writers


def test_stored_fact_has_the_measured_columns_alone(spark, sf):
    assert sorted(V.stored_fact(spark, sf).columns) == sorted(V.MEASURED)


def test_reconciliation_stores_what_it_reads_alone(spark, sf, monkeypatch):
    written, overwrite = [], writers.overwrite
    monkeypatch.setattr(V, "_STORED", {})
    monkeypatch.setattr(writers, "overwrite", lambda df, *a, **k: written.append((df.columns, a[1:])) or overwrite(df, *a, **k))
    fact = V.gold_fact(spark, sf)[0].select(*V.RECONCILED)
    counts = QUERIES["recon_counts"](spark, sf).select("txn_month", F.col("gold_value").cast("long"))
    assert rows(counts) == rows(fact.groupBy("txn_month").count())
    assert [w for w in written if "amount" in w[0]] == [(V.RECONCILED, ((),))]


def test_conformed_fact_is_dealt_by_client_once(spark, sf, no_broadcast):  # noqa: F811
    text = plan(V.warehouse_fact(spark, sf))
    dealt = re.findall(r"Exchange hashpartitioning\((?:cast\()?client_id#\d+L?", text)
    facts = [part for part in text.split("\n") if "hashpartitioning" in part and re.search(r"cast\((client|card)_id#\d+L? as string\)", part)]
    assert dealt and not facts


def test_members_match_only_as_they_print(spark):
    """A text that merely casts to the fact's number is another member."""
    dim = spark.createDataFrame([(1, "7"), (2, "07"), (3, "x"), (4, None), (5, " 8"), (6, "-9")], "user_key long, client_id string")
    fact = spark.createDataFrame([(7,), (8,), (-9,), (None,)], "client_id long")
    typed = warehouse._typed_member(dim, "user_key", "client_id", fact, "k")
    assert rows(fact.join(typed, F.col("client_id") == F.col("k")).select("client_id", "user_key")) == [(-9, 6), (7, 1)]
    as_text = fact.withColumn("client_id", F.lit("07"))
    typed = warehouse._typed_member(dim, "user_key", "client_id", as_text, "k")
    assert rows(as_text.join(typed, F.col("client_id") == F.col("k")).select("user_key").distinct()) == [(2,)]


def test_distinct_members_are_dealt_as_numbers_and_once_before_the_subtotals(spark, sf):
    text = plan(measures._distinct_counts(V.stored_fact(spark, sf), V.stored_dims(spark, sf), ["card_brand", "txn_month"], "cube"))
    assert "_count_distinct AS kind" not in text and "as string) AS member" not in text
    dealt = [line for line in text.split("\n") if "hashpartitioning" in line and "member#" in line]
    assert len(dealt) == 2


def test_hash_is_made_behind_the_joins_that_conform_the_fact(spark, sf, no_broadcast):  # noqa: F811
    text = plan(V.warehouse_fact(spark, sf))
    dealt = [m.start() for m in re.finditer(r"Exchange hashpartitioning\(client_id#", text)]
    facts = [at for at in dealt if "transaction_id#" in text[at : at + 400]]
    assert facts and text.rindex("sha2(") < max(facts)


def test_latest_rows_deal_no_derived_columns(spark, sf):
    text = plan(V.silver_transactions(spark, sf))
    below = text[text.index("Exchange hashpartitioning(transaction_id#") :]
    assert "trunc" not in below and "is_success" not in below


def test_keys_of_all_rules_come_from_one_pass(spark, sf, path, monkeypatch):
    staged = []
    stage = writers.stage
    monkeypatch.setattr(writers, "stage", lambda df, name, *rest: staged.append((name, plan(df))) or stage(df, name, *rest))
    rows_in = V.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("client_id"), F.col("l_suppkey").alias("card_id"), F.lit("x").alias("mcc_code"), F.to_date("l_shipdate").alias("txn_date"))
    gold.staged_orphan_keys(rows_in, gold.fact_rules(*V.fact_dims(spark, sf), V.gold_dates(spark)), "one-pass")
    assert sum("lineitem.parquet" in text for _, text in staged) == 1


def test_rows_of_unrepeated_ids_are_not_ranked(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d"), (None, 3, "e"), (3, None, "f"), (3, 1, "g")], "k long, at long, record_hash string")
    repeats, n = gold.staged_repeats(df, ["k"], "repeats")
    got = gold.latest_of_repeats(df, repeats, ["k"], "at")
    assert n == 7 and rows(repeats) == rows(spark.createDataFrame([(1,), (3,), (None,)], "k long"))
    assert rows(got) == rows(dedup_latest(df, ["k"], "at"))
    none, n = gold.staged_repeats(df.where("false"), ["k"], "no-repeats")
    assert (n, none.count()) == (0, 0)


def test_fact_load_deals_no_whole_rows(spark, sf, path, monkeypatch):
    silver = writers.stage(V.silver_transactions(spark, sf), "silver", "no-deal")[0]
    written = []
    write = versions.write
    monkeypatch.setattr(versions, "write", lambda df, *a, **k: written.append((plan(df), k)) or write(df, *a, **k))
    counts = gold.build_fact(silver, *V.fact_dims(spark, sf), V.gold_dates(spark), path("f"), path("e"), path("k"), "no-deal")
    assert counts["row_in"] == silver.count() and counts["dedup_dropped"] == 0
    assert written[0][1]["gather"] is False


def test_first_slice_is_neither_staged_nor_merged(spark, sf, path, monkeypatch):
    fact, written = V.warehouse_fact(spark, sf), []
    write = versions.write
    monkeypatch.setattr(versions, "write", lambda df, *a, **k: written.append(plan(df)) or write(df, *a, **k))
    monkeypatch.setattr(writers, "stage", lambda *a, **k: 1 / 0)
    counts = warehouse.refresh_slice(fact, "fact_transactions", path("slice"), "first")
    n = fact.count()
    assert counts == {"rows_source": n, "rows_inserted": n, "rows_updated": 0, "rows_unchanged": 0, "rows_deleted": 0}
    assert "FullOuter" not in written[0] and versions.read(spark, path("slice"), fact.schema).count() == n


def test_merge_deals_keys_once(spark):
    df = spark.createDataFrame([(1, "a", 2)], "k long, record_hash string, v int")
    merged = merge_rows(df, df, ["k"], "record_hash")
    assert "struct(k" not in plan(merged) and rows(merged) == [(1, "a", 2, "unchanged")]


def test_silver_loads_deal_rows_by_key_alone_and_hashes_as_bytes(spark, sf, path, monkeypatch):
    bronze, written = V.bronze_transactions(spark, sf), []
    write = versions.write
    monkeypatch.setattr(versions, "write", lambda df, *a, **k: written.append((plan(df), k["gather"])) or write(df, *a, **k))
    for n, rows_in in enumerate([bronze, bronze.where("id % 10 = 1")]):
        silver.build_silver(rows_in, "TRANSACTION", path("silver"), f"deal-{n}", incremental=True, tie_break=V.TXN_TIES)
    assert [gather for _, gather in written] == [False, False] and "unhex(" in written[1][0]
    expected = V.silver_transactions(spark, sf).select("transaction_id", "record_hash")
    assert rows(writers.read(spark, path("silver"), expected.schema)) == rows(expected)


def shuffle_files(spark) -> set[str]:
    homes = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for home in homes for _, _, names in os.walk(home.getPath()) for f in names if f.startswith("shuffle_")}


@pytest.mark.parametrize("write", [
    lambda df, to: versions.write(df, to, ["m"]),
    lambda df, to: writers.overwrite(df, to, ["m"]),
    lambda df, to: writers.stage(df, "freed", to.rsplit("/", 1)[1]),
])
def test_shuffle_files_go_with_the_write_that_made_them(spark, path, write):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("m")).count()
    before = shuffle_files(spark)
    write(df, path("freed"))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(CLEANUP_CONF) == "false" and df.count() == 7


def test_setting_comes_back_when_the_last_of_several_loads_has_ended(spark):
    inside, leave = threading.Event(), threading.Event()

    def load():
        with shuffles_freed(spark):
            inside.set()
            leave.wait(20)

    other = threading.Thread(target=load)
    with shuffles_freed(spark):
        other.start()
        assert inside.wait(20)
    assert spark.conf.get(CLEANUP_CONF) == "true"
    leave.set()
    other.join()
    assert spark.conf.get(CLEANUP_CONF) == "false"


def test_slices_are_written_as_they_lie(spark, sf, path, monkeypatch):
    fact, gathered, write = V.warehouse_fact(spark, sf), [], versions.write
    monkeypatch.setattr(versions, "write", lambda *a, **k: gathered.append(k["gather"]) or write(*a, **k))
    for n in (0, 1):
        later = fact.where("transaction_id % 10 = 5").withColumn("txn_month", F.add_months("txn_month", 1))
        warehouse.refresh_slice(later.withColumn("record_hash", F.lit("new")) if n else fact, "fact_transactions", path("slice"), f"lie-{n}")
    got = versions.read(spark, path("slice"), fact.schema).select("transaction_id", "txn_month")
    moved = F.col("transaction_id") % 10 == 5
    expected = fact.select("transaction_id", F.when(moved, F.add_months("txn_month", 1)).otherwise(F.col("txn_month")))
    assert gathered == [False, False] and rows(got) == rows(expected)


def test_hashes_are_packed_without_loss(spark):
    texts = ["", "old", "0a", "0A", "abc", "12", "  ", "é", "f" * 64, "F" * 64, "0x1f", None]
    df = spark.createDataFrame([(t,) for t in texts], "h string").select("h", packed("h").alias("p"))
    assert [r for r in df.select("h", unpacked(F.col("p")).alias("back")).collect() if r.h != r.back] == []
    assert [len(r.n) for r in df.where(F.length("h") == 64).select(F.col("p.digits").alias("n")).collect() if r.n] == [32]


def test_merge_deals_hashes_as_bytes(spark):
    kind = "k long, record_hash string, v int"
    old = spark.createDataFrame([(1, "aa", 1), (2, "old", 2), (3, None, 3), (4, "", 4), (5, "AB", 5), (None, "cc", 6), (8, "dd", 8)], kind)
    new = spark.createDataFrame([(1, "aa", 10), (2, "bb", 20), (3, "", 30), (4, None, 40), (5, "ab", 50), (7, "é", 70), (None, "cc", 60)], kind)
    merged = merge_rows(old, new, ["k"], "record_hash")
    below = plan(merged)[plan(merged).index("SortMergeJoin") :] if "SortMergeJoin" in plan(merged) else plan(merged)
    assert "unhex(" in below
    assert rows(merged) == sorted([
        (1, "aa", 1, "unchanged"), (2, "bb", 20, "updated"), (3, None, 3, "unchanged"), (4, "", 4, "unchanged"), (5, "ab", 50, "updated"),
        (7, "é", 70, "inserted"), (8, "dd", 8, "unchanged"), (None, "cc", 6, "unchanged"), (None, "cc", 60, "inserted"),
    ], key=lambda r: tuple((v is None, str(v)) for v in r))
    numbers = spark.createDataFrame([(1, 7, 1)], "k long, record_hash long, v int")
    assert rows(merge_rows(numbers, numbers, ["k"], "record_hash")) == [(1, 7, 1, "unchanged")]

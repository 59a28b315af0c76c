"""Publication by pointer, leases, and loads that meet."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cardlake.plans import contracts as K
from cardlake.plans import ingest
from cardlake.sources import lease, numbered, readers, versions, writers


def frame(spark, *made):
    return spark.createDataFrame([(k, date(2020, m, 1)) for k, m in made], "k string, m date")


def load(spark, path, base, *made, whole=False, **options):
    """Write and commit rows as a load that was made from ``base``."""
    own, _ = versions.write(frame(spark, *made), path, ["m"])
    return versions.publish_load(spark, path, base, own, whole, **options)


def test_a_number_is_written_once(spark, path):
    folder = path("n")
    assert numbered.newest(spark, folder) == (0, {})
    assert numbered.put(spark, folder, 1, {"a": "é"}) and not numbered.put(spark, folder, 1, {"a": "x"})
    assert numbered.newest(spark, folder) == (1, {"a": "é"})
    assert all(not n.startswith(".") for n in numbered.names(spark, folder) if n.endswith(".json"))


def test_readers_see_whole_versions(spark, path):
    """Rows are written once; a reader in the middle of a load sees the old table, and keeps it."""
    t = path("t")
    writers.publish(frame(spark, ("a", 1), ("b", 2)), t, "t", ["m"])
    old, base = writers.read(spark, t), versions.current(spark, t)
    own, seen = versions.write(frame(spark, ("c", 2), ("d", 3)), t, ["m"], {"n": F.count(F.lit(1))})
    assert seen == {"n": 2}
    files = set(versions.load_rows(spark, t, own, old.schema).inputFiles())
    assert rows(writers.read(spark, t), "k") == [("a",), ("b",)]  # written, not committed
    versions.publish_load(spark, t, base, own, emptied=["m=2020-01-01"])
    new = writers.read(spark, t)
    assert rows(new, "k", "m") == [("c", date(2020, 2, 1)), ("d", date(2020, 3, 1))]
    assert set(new.inputFiles()) == files  # the very files that the load wrote
    assert rows(old, "k") == [("a",), ("b",)]
    assert writers.table_exists(spark, t) and not writers.table_exists(spark, path("none"))


def test_a_cut_off_or_refused_load_leaves_the_table(spark, path):
    t = path("t")
    writers.publish(frame(spark, ("a", 1)), t, "t", ["m"])
    versions.write(frame(spark, ("x", 1)), t, ["m"])  # and no commit
    boom = F.raise_error(F.lit("cut off")).cast("string")
    with pytest.raises(Exception, match="cut off"):
        writers.publish(frame(spark, ("y", 1)).withColumn("k", boom), t, "t", ["m"])
    assert rows(writers.read(spark, t), "k") == [("a",)]
    with pytest.raises(Exception):
        spark.read.parquet(t).count()  # versions are not mixed by a plain read
    gone = versions.vacuum(spark, t, older_than_s=-60)
    assert gone and rows(writers.read(spark, t), "k") == [("a",)]
    assert versions.vacuum(spark, t, older_than_s=3600) == []


def test_commits_that_meet(spark, path):
    t = path("t")
    first = load(spark, t, versions.current(spark, t), ("a", 1), ("b", 2), whole=True)
    load(spark, t, first, ("c", 1))
    load(spark, t, first, ("d", 2))  # another partition: on top of the other
    assert rows(writers.read(spark, t), "k") == [("c",), ("d",)]
    with pytest.raises(versions.Conflict):
        load(spark, t, first, ("e", 1))
    with pytest.raises(versions.Conflict):
        load(spark, t, first, ("e", 3), whole=True)
    with pytest.raises(versions.Conflict):
        load(spark, t, first, ("e", 3), alone=True)
    versions.commit(spark, t, versions.current(spark, t), {}, fence=("X", 2))
    with pytest.raises(versions.Conflict):
        load(spark, t, versions.current(spark, t), ("e", 3), fence=("X", 1))
    assert rows(writers.read(spark, t), "k") == [("c",), ("d",)]


def test_null_partitions_empty_tables_and_plain_ones(spark, path):
    t, schema = path("t"), "k string, m string"
    df = spark.createDataFrame([("a", None), ("b", "x")], schema)
    writers.publish(df, t, "t", ["m"], zone_key="k")
    assert rows(writers.read(spark, t, df.schema)) == rows(df)
    at = versions.current(spark, t)
    assert versions.holding(spark, at, df.where("k = 'a'"), "k") == [versions.part_name("m", None)]
    df.write.parquet(path("plain"))
    writers.publish(spark.read.parquet(path("plain")).where("k > 'b'"), t, "t", ["m"])
    assert writers.read(spark, t, df.schema).count() == 0
    with pytest.raises(ValueError):
        writers.read(spark, t)
    assert writers.read(spark, path("plain")).count() == 2
    with pytest.raises(ValueError):
        writers.publish(df, path("plain"), "t", ["m"], whole=False)


def test_keys_lead_to_the_partitions_whose_range_has_them(spark, path):
    """A load of new ids reads keys of few partitions; ids of any text are found all the same."""
    from cardlake.plans.silver import key_partitions

    t, c = path("t"), K.WH_FACT
    made = []
    for m in range(1, 11):
        for i in range(m * 9, m * 9 + 9):
            r = dict.fromkeys(c.names)
            r.update(transaction_id=str(i), txn_month=date(2020, m, 1), amount=Decimal(1))
            made.append(r)
    stored = readers.rows_to_table(spark, made, c.schema)
    writers.publish(stored, t, "t", c.partition_by, zone_key="transaction_id")
    at = versions.current(spark, t)
    assert at.zones["txn_month=2020-10-01"] == [[2, "90"], [2, "98"]]

    def asked(*ids, month=12):
        fresh = [{**dict.fromkeys(c.names), "transaction_id": i, "txn_month": date(2020, month, 1)} for i in ids]
        fresh = readers.rows_to_table(spark, fresh, c.schema)
        return versions.holding(spark, at, fresh, "transaction_id"), key_partitions(spark, t, at, c, fresh)

    assert asked("99", "100", "1000") == ([], ["txn_month=2020-12-01"])
    few, touched = asked("10", "120")
    assert few == ["txn_month=2020-01-01"] and touched == ["txn_month=2020-01-01", "txn_month=2020-12-01"]
    read = versions.read(spark, t, c.schema, few, at)
    assert {f.split("txn_month=")[1][:10] for f in read.inputFiles()} == {"2020-01-01"}
    assert asked("17x")[0] == [] and asked(None) == ([], ["txn_month=2020-12-01"])
    assert len(asked(*map(str, range(9, 99)))[1]) == 11


def test_leases(spark, path):
    a, b = (lease.Lease(spark, path("l"), o, 10) for o in "ab")
    a.claim(now=100)
    with pytest.raises(lease.Held):
        b.claim(now=105)
    a.renew(now=108)
    with pytest.raises(lease.Held):
        b.claim(now=112)
    b.claim(now=119)  # a is dead
    assert b.number > a.number
    with pytest.raises(lease.Held):
        a.renew(now=120)
    a.release()  # changes nothing for b
    with pytest.raises(lease.Held):
        a.claim(now=121)
    b.release()
    with lease.held(spark, path("l"), "c"):
        with pytest.raises(lease.Held), lease.held(spark, path("l"), "d"):
            pass
    with lease.held(spark, path("l"), "e"):
        pass
    assert len(numbered.numbers(spark, path("l"))) <= 3


def fx_folders(tmp_path, *codes):
    for code in codes:
        (tmp_path / code).mkdir()
        (tmp_path / code / "x.csv").write_text(f"currency,date\n{code},2020-01-01\n")


def test_a_second_load_leaves_the_rows_of_a_running_one(spark, path, tmp_path, monkeypatch):
    fx_folders(tmp_path, "usd", "gbp")
    args = (path("t"), path("m"), path("l"), "2020-01-02")
    real, tried = ingest.record_files, []

    def record(*a):
        if not tried:  # the first load has written its rows and not its manifest
            tried.append(1)
            with pytest.raises(lease.Held):
                ingest.ingest(spark, "FX", str(tmp_path / "gbp"), *args, "second")
        real(*a)

    monkeypatch.setattr(ingest, "record_files", record)
    ingest.ingest(spark, "FX", str(tmp_path / "usd"), *args, "first")
    ingest.ingest(spark, "FX", str(tmp_path / "gbp"), *args, "second")
    assert tried and rows(spark.read.parquet(path("t")), "currency") == [("GBP",), ("USD",)]
    assert writers.read(spark, path("m")).count() == 2


def test_a_dead_load_is_taken_over_and_shut_out(spark, path, tmp_path, monkeypatch):
    fx_folders(tmp_path, "usd", "gbp")
    args = (path("t"), path("m"), path("l"), "2020-01-02")
    real, woken = ingest.record_files, []

    def record(*a):
        if not woken:  # hangs until its lease has ended and another load is done
            woken.append(1)
            monkeypatch.setattr(lease.time, "time", lambda: real_time() + 7200)
            ingest.ingest(spark, "FX", str(tmp_path / "gbp"), *args, "second")
        real(*a)

    real_time = lease.time.time
    monkeypatch.setattr(ingest, "record_files", record)
    with pytest.raises((lease.Held, versions.Conflict)):
        ingest.ingest(spark, "FX", str(tmp_path / "usd"), *args, "first")
    assert rows(spark.read.parquet(path("t")), "currency") == [("GBP",)]  # the first one's rows were undone
    monkeypatch.setattr(ingest, "record_files", real)
    ingest.ingest(spark, "FX", str(tmp_path / "usd"), *args, "third")
    assert rows(spark.read.parquet(path("t")), "currency") == [("GBP",), ("USD",)]
    assert writers.read(spark, path("m")).count() == 2


def test_a_catalog_table_moves_to_its_new_rows(spark, path):
    one, two = (spark.createDataFrame([(k, 1)], "k string, n int") for k in "ab")
    writers.create_if_missing(spark, "t_moved", one.schema)
    writers.rebuild_table(one, "t_moved")
    running = spark.table("t_moved")
    assert running.collect()[0].k == "a"
    writers.rebuild_table(two.unionByName(spark.table("t_moved")), "t_moved")  # may read what it replaces
    assert rows(spark.table("t_moved"), "k") == [("a",), ("b",)]
    spark.sql("DROP TABLE t_moved")

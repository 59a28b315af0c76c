from datetime import date
from hashlib import sha256

import pytest
from conftest import rows

from cardlake.operators.dedup import dedup_latest
from cardlake.plans import ingest
from cardlake.plans.bronze import BATCH
from cardlake.sources import versions, writers
from cardlake.streaming.files import merge_latest, read_latest, stream_ingest, stream_latest

HEAD = "currency,base_currency,currency_name,exchange_rate,date\n"


def test_stream_ingest_takes_each_file_once(spark, path, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(HEAD + "usd,EUR,Dollar,1.1,2020-01-01\n")
    (folder / "b.csv").write_text(HEAD + "gbp,EUR,Pound,0.9,2020-01-01,too,long\n")

    def run():
        stream_ingest(spark, "fx", str(folder), path("t"), path("m"), path("c"), "2020-01-02").awaitTermination()

    run()
    assert rows(spark.read.parquet(path("t")), "currency") == [("USD",)]
    assert rows(writers.read(spark, path("m")), "source_name", "last_status") == [("a.csv", "SUCCESS"), ("b.csv", "FAILED")]
    run()
    (folder / "c.csv").write_text(HEAD + "chf,EUR,Franc,1.0,2020-01-03\n")
    run()
    got = spark.read.parquet(path("t"))
    assert rows(got, "currency") == [("CHF",), ("USD",)] and BATCH in got.columns
    assert writers.read(spark, path("m")).count() == 3


def test_stream_latest_equals_batch(spark, path):
    """Several micro-batches, late rows among them, give the batch result."""
    df = spark.createDataFrame(
        [(i % 7, date(2020, 1, 1 + (i * 5) % 28), i) for i in range(60)], "k int, d date, v int"
    ).repartition(6)
    df.write.parquet(path("in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path("in"))
    stream_latest(stream, path("out"), ["k"], "d", ["v"], path("c"), "sl", buckets=3).awaitTermination()
    latest = (df.schema, ["k"], "d", ["v"])
    got = read_latest(spark, path("out"), *latest)
    assert rows(got, "k", "d", "v") == rows(dedup_latest(df, ["k"], "d", ["v"]), "k", "d", "v")
    merge_latest(df, path("out"), ["k"], "d", ["v"], "again", buckets=3)
    assert read_latest(spark, path("out"), *latest).count() == 7
    with pytest.raises(ValueError):
        merge_latest(df, path("out"), ["k"], "d", ["v"], "more", buckets=6)


def test_a_batch_adds_to_its_buckets_and_full_ones_are_compacted(spark, path):
    schema = "k int, d int, v string"
    latest = (["k"], "d", ["v"])

    def merge(rows_, tag):
        merge_latest(spark.createDataFrame(rows_, schema), path("t"), *latest, tag, buckets=4, deltas=3)
        return versions.current(spark, path("t"))

    def stored():
        return rows(read_latest(spark, path("t"), spark.createDataFrame([], schema).schema, *latest), "k", "d", "v")

    many = [(k, 0, "".join(sha256(f"{k}-{i}".encode()).hexdigest() for i in range(8))) for k in range(400)]
    first = merge(many, "0")
    assert len(first.parts) == 4 and all(len(f) == 1 for f in first.parts.values())
    second = merge([(7, 1, "b")], "1")
    assert len(second.changed_since(first)) == 1  # one key leaves the other buckets' files alone
    bucket = second.changed_since(first).pop()
    assert second.parts[bucket][0] == first.parts[bucket][0]
    again = merge([(7, 1, "b")], "1")  # a repeated batch stands in for itself
    assert len(again.parts[bucket]) == 2
    for n in (2, 3, 4):
        last = merge([(7, n, "c")], str(n))
    assert len(last.parts[bucket]) == 3 and first.parts[bucket][0] in last.parts[bucket]  # small loads merged, the large one untouched
    assert stored() == sorted([r for r in many if r[0] != 7] + [(7, 4, "c")], key=lambda r: tuple(str(v) for v in r))
    assert merge([], "5") == last or versions.current(spark, path("t")).parts == last.parts


def test_two_streams_and_a_batch_share_a_table(spark, path, tmp_path):
    """Columns go by each file's own header, whatever their order; nobody replaces another's rows."""
    for i, code in enumerate(("usd", "gbp", "chf")):
        (tmp_path / f"in{i}").mkdir()
        (tmp_path / f"in{i}" / "x.csv").write_text(f"date,currency,exchange_rate,base_currency,currency_name\n2020-01-0{i + 1},{code},1.5,EUR,C\n")
    (tmp_path / "in0" / "y.csv").write_text(HEAD + "jpy,EUR,Yen,100,2020-01-05\nbad,line\n")
    for i in (0, 1):
        stream_ingest(spark, "FX", str(tmp_path / f"in{i}"), path("t"), path("m"), path(f"c{i}"), "2020-02-01").awaitTermination()
    ingest.ingest(spark, "FX", str(tmp_path / "in2"), path("t"), path("m"), path("l"), "2020-02-01", "r1")
    got = spark.read.parquet(path("t"))
    assert rows(got, "currency", "base_currency", "date") == [
        ("CHF", "EUR", date(2020, 1, 3)), ("GBP", "EUR", date(2020, 1, 2)), ("JPY", "EUR", date(2020, 1, 5)), ("USD", "EUR", date(2020, 1, 1))]
    assert rows(writers.read(spark, path("m")), "source_name", "last_status") == [
        ("x.csv", "SUCCESS"), ("x.csv", "SUCCESS"), ("x.csv", "SUCCESS"), ("y.csv", "PARTIAL")]
    assert rows(spark.read.parquet(ingest.rejects_path(path("t"))), "line") == [("bad,line",)]

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardlake.operators import compliance, quality
from cardlake.operators import upsert as U
from cardlake.operators.conform import (
    FAILED_RULE,
    Rule,
    anomaly_kpis,
    conform_split,
    orphan_keys,
    orphan_report,
    tag_orphans,
)
from cardlake.operators.dedup import dedup_latest
from cardlake.operators.projection import add_tech_columns, filter_as_of, month_scope
from cardlake.plans import contracts as K
from cardlake.plans.bronze import ENTITIES

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


# --- dedup ------------------------------------------------------------------


def test_dedup_ties_and_nulls(spark):
    t = datetime(2020, 1, 1)
    df = spark.createDataFrame(
        [(1, t, "a"), (1, t, "b"), (2, None, "c"), (2, t, "d"), (3, None, "e"), (None, t, "f"), (None, t, "g")],
        "k int, ingestion_ts timestamp, record_hash string",
    )
    assert rows(dedup_latest(df, ["k"]), "k", "record_hash") == [(1, "b"), (2, "d"), (3, "e"), (None, "g")]


def test_dedup_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("k"), (F.col("id") % 3).alias("o"), "id")
    one = dedup_latest(df.repartition(1), ["k"], "o", ["id"])
    many = dedup_latest(df.repartition(9), ["k"], "o", ["id"])
    assert one.exceptAll(many).count() == 0 and one.count() == 50


def test_hot_key_is_cut_before_the_shuffle(spark):
    """One key holding half the rows sends one row per task, not its group."""
    df = spark.range(0, 20000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = dedup_latest(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


# --- upsert -----------------------------------------------------------------

SCHEMA = "k int, v int, h string, first int"


def test_upsert_actions(spark):
    target = spark.createDataFrame([(1, 10, "a", 1), (2, 20, "b", 1), (3, 30, None, 1)], SCHEMA)
    source = spark.createDataFrame([(2, 21, "c", 2), (3, 30, "", 2), (4, 40, "d", 2)], SCHEMA)
    merged, stats = U.upsert(target, source, ["k"], "h", keep_cols=["first"])
    assert rows(merged, "k", "v", "first") == [(1, 10, 1), (2, 21, 1), (3, 30, 1), (4, 40, 2)]
    assert stats.first().asDict() == {"rows_inserted": 1, "rows_updated": 1, "rows_unchanged": 2, "rows_deleted": 0}
    merged, stats = U.upsert(target, source, ["k"], "h", delete_missing=True)
    assert [r[0] for r in rows(merged, "k")] == [2, 3, 4]
    assert stats.first()["rows_deleted"] == 1


def test_upsert_without_hash_updates_all(spark):
    target = spark.createDataFrame([(1, 10, "a", 1)], SCHEMA)
    source = spark.createDataFrame([(1, 11, "a", 2)], SCHEMA)
    assert rows(U.upsert(target, source, ["k"])[0], "v") == [(11,)]


def test_null_keys_never_match(spark):
    df = spark.createDataFrame([(None, 1, "a", 1)], SCHEMA)
    merged, stats = U.upsert(df, df, ["k"], "h")
    assert merged.count() == 2 and stats.first()["rows_inserted"] == 1


@SLOW
@given(st.dictionaries(st.integers(0, 30), st.integers(0, 3)), st.dictionaries(st.integers(0, 30), st.integers(0, 3)))
def test_upsert_is_idempotent_and_equals_a_dict_update(spark, old, new):
    def frame(d):
        return spark.createDataFrame([(k, v, str(v), 0) for k, v in d.items()], SCHEMA)

    once, stats = U.upsert(frame(old), frame(new), ["k"], "h")
    assert dict((r[0], r[1]) for r in once.collect()) == {**old, **new}
    got = stats.first().asDict()
    assert got["rows_inserted"] == len(new.keys() - old.keys())
    assert got["rows_updated"] == sum(1 for k in new.keys() & old.keys() if old[k] != new[k])
    _, again = U.upsert(once, frame(new), ["k"], "h")
    assert again.first()["rows_inserted"] == again.first()["rows_updated"] == 0


def test_surrogates_are_dense_stable_and_kept(spark):
    keys = spark.range(500).select(F.col("id").cast("string").alias("nk"))
    first = U.number_rows(keys, "nk", "sk")
    assert sorted(r[0] for r in first.select("sk").collect()) == list(range(1, 501))
    again = U.number_rows(keys.repartition(13), "nk", "sk")
    assert first.exceptAll(again).count() == 0
    more = spark.range(700).select(F.col("id").cast("string").alias("nk"))
    added = U.assign_surrogate(first, more, "nk", "sk")
    assert added.where("sk is null").count() == 500
    fresh = sorted(r[0] for r in added.where("sk is not null").select("sk").collect())
    assert fresh == list(range(501, 701))


# --- conformance ------------------------------------------------------------


@pytest.fixture
def facts(spark):
    fact = spark.createDataFrame(
        [(1, 1, "a"), (2, 9, "a"), (3, 1, "z"), (4, 9, "z"), (5, None, "a"), (6, 2, None)], "id int, u int, m string"
    )
    users = spark.createDataFrame([(1,), (2,), (2,), (None,)], "u int")
    codes = spark.createDataFrame([("a",)], "m string")
    rules = [
        Rule("u", users, "u", "R1", "NO_USER", event_keys=("id", "u")),
        Rule("m", codes, "m", "R2", "NO_CODE", "MEDIUM", ("id", "m"), bounded=True),
    ]
    return fact, rules


def test_first_failing_rule_only(spark, facts):
    fact, rules = facts
    good, events = conform_split(fact, rules, "run", "e", "src")
    assert rows(good, "id") == [(1,)]
    assert rows(events, "rule_id", "natural_keys") == [
        ("R1", '{"id":2,"u":9}'), ("R1", '{"id":4,"u":9}'), ("R1", '{"id":5}'),
        ("R2", '{"id":3,"m":"z"}'), ("R2", '{"id":6}'),
    ]
    assert good.count() + events.count() == fact.count()
    assert events.columns == K.ANOMALY_EVENT.names


def test_null_key_may_be_kept(spark, facts):
    fact, rules = facts
    good = tag_orphans(fact, rules[:1], keep_null_key=True).where(f"{FAILED_RULE} is null")
    assert rows(good, "id") == [(1,), (3,), (5,), (6,)]


def test_orphan_sets_give_the_same_tags(spark, facts):
    fact, rules = facts
    sets = {r.rule_id: orphan_keys(fact, r) for r in rules}
    assert rows(sets["R1"]) == [(9,)]
    assert rows(tag_orphans(fact, rules, orphan_sets=sets)) == rows(tag_orphans(fact, rules))


def test_orphan_report_counts_rules_apart(spark, facts):
    fact, rules = facts
    report = dict(rows(orphan_report(fact, rules), "rule_id", "issue_count"))
    assert report == {"R1": 3, "R2": 3}


def test_kpi_samples_are_bounded(spark):
    events = spark.range(1000).select(
        F.lit("C").alias("anom_domain"), F.lit("T").alias("anom_type"), F.lit("HIGH").alias("severity"),
        F.lit("R1").alias("rule_id"), F.format_string("%04d", "id").alias("natural_keys"),
    )
    row = anomaly_kpis(events, "run", "e", sample_limit=3).first()
    assert row["row_count"] == 1000 and row["sample_keys"] == '["0000","0001","0002"]'
    with pytest.raises(ValueError):
        anomaly_kpis(events, " ", "e")


# --- checks -----------------------------------------------------------------


def test_run_checks(spark):
    df = spark.createDataFrame(
        [(1, "0742", date(2020, 1, 1)), (1, "74", date(2020, 2, 1)), (None, None, None)], "k int, c string, m date"
    )
    checks = [
        *quality.not_null(["k", "c"]), quality.matches("c", "^[0-9]{4}$", "digits"), quality.equals("k", 1, "k_is_1"),
        quality.unique(["k"]), *quality.partition_ok(["m"], max_distinct=1), quality.row_count_is(5),
        quality.not_blank("c", "c_blank"),
    ]
    got = {r["check"]: (r["issue_count"], r["status"]) for r in quality.run_checks(df, checks).collect()}
    assert got == {
        "k_not_null": (1, "FAIL"), "c_not_null": (1, "FAIL"), "digits": (2, "FAIL"), "k_is_1": (1, "FAIL"),
        "k_unique": (1, "FAIL"), "m_partition_not_null": (1, "FAIL"), "partition_count_in_limit": (1, "FAIL"),
        "row_count": (2, "FAIL"), "c_blank": (1, "FAIL"),
    }
    with pytest.raises(quality.QualityError) as error:
        quality.assert_passed(quality.run_checks(df, checks), "t")
    assert error.value.issues["digits"] == 2
    quality.assert_passed(quality.run_checks(df.limit(0), checks[:4]), "t")
    assert quality.run_checks(df, []).count() == 0


def test_structure_checks(spark):
    df = spark.createDataFrame([(1, Decimal("1.00"))], "a int, b decimal(18,2)")
    with pytest.raises(ValueError):
        quality.require_columns(df, ["a", "c"])
    with pytest.raises(ValueError):
        quality.forbid_extra_columns(df, ["a"])
    other = {"b": K.spark_type("DECIMAL(9,6)")}
    with pytest.raises(ValueError):
        quality.require_types(df, other)
    quality.require_types(df, other, ignore_precision=True)
    with pytest.raises(ValueError):
        quality.require_date_partitions(df, ["a"])
    with pytest.raises(ValueError):
        quality.duplicate_keys(df, [])


def test_contracts():
    assert K.GOLD_FACT.names[-2:] == ["gold_run_id", "gold_load_ts"] and len(K.GOLD_FACT.names) == 22
    assert K.GOLD_DIM_CARD.names[:2] == ["card_id", "client_id"] and len(K.GOLD_DIM_CARD.names) == 20
    assert len(ENTITIES) == 12 and len(ENTITIES["FUNDAMENTALS"].contract.names) == 83
    assert K.type_family("decimal(10,2)") == "DECIMAL" and K.type_family("long") == "BIGINT"
    assert K.spark_type("varchar(20)").simpleString() == "string"
    for bad in ("BLOB", "DECIMAL"):
        with pytest.raises(ValueError):
            K.spark_type(bad)
    with pytest.raises(ValueError):
        K.contract("t", "")
    assert K.contract("t", "a INT\nb INT", unique=["a", "b"]).unique == (("a", "b"),)
    assert K.contract("t", "a INT\nb INT", unique=[["a"], ["b"]]).unique == (("a",), ("b",))


def test_schema_compliance(spark):
    live = {
        "same": "a int, b string", "gone": None, "less": "a int", "more": "a int, b string, c int",
        "type": "a bigint, b string", "order": "b string, a int",
    }
    declared = [K.contract(t, "a INT\nb STRING", layer="BRONZE", entity=t) for t in live]

    def resolve(name):
        if live[name] is None:
            raise KeyError(name)
        return spark.createDataFrame([], live[name])

    got = {r["table_name"]: r for r in compliance.schema_compliance(spark, declared, resolve).collect()}
    assert {k: r["compliance_status"] for k, r in got.items()} == {
        "same": "PASS", "gone": "MISSING_TABLE", "less": "FAIL", "more": "FAIL", "type": "FAIL", "order": "FAIL",
    }
    assert got["less"]["missing_columns"] == '["b"]' and got["more"]["extra_columns"] == '["c"]'
    assert got["type"]["type_mismatches"] == '[{"column":"a","expected":"INT","actual":"BIGINT"}]'
    assert got["order"]["order_mismatch"] == "true" and '"actual_order":["b","a"]' in got["order"]["order_details"]
    loose = compliance.schema_compliance(spark, declared, resolve, strict_order=False, fail_on_missing_table=True)
    status = dict(rows(loose, "table_name", "compliance_status"))
    assert status["order"] == "PASS" and status["gone"] == "FAIL"
    assert dict(rows(compliance.compliance_summary(loose))) == {"FAIL": 4, "PASS": 2}


def test_stale_registry_must_fail(spark):
    """A registry that still declares the transaction ids as INT and the amount
    as text does not describe the table the loader writes."""
    stale = """id INT\ndate TIMESTAMP\nclient_id INT\ncard_id INT\namount STRING\nuse_chip STRING\nmerchant_id INT
        merchant_city STRING\nmerchant_state STRING\nzip DOUBLE\nmcc INT\nerrors STRING"""
    c = K.contract("bronze_transactions_raw", stale, technical=K.BRONZE_TECHNICAL, layer="BRONZE", entity="TRANSACTION")
    live = spark.createDataFrame([], ENTITIES["TRANSACTION"].contract.schema)
    row = compliance.schema_compliance(spark, [c], lambda _: live).first()
    assert row["compliance_status"] == "FAIL" and row["type_mismatches"].count('"column"') == 7


def test_tech_columns(spark):
    df = spark.createDataFrame([("f", datetime(2020, 1, 2, 3))], "path string, loaded timestamp")
    got = add_tech_columns(df, "path", "loaded").first()
    assert got["source_file"] == "f" and got["ingestion_date"] == date(2020, 1, 2)
    bare = add_tech_columns(spark.createDataFrame([(1,)], "a int"), default_source_file="d", now=F.lit("2021-01-01").cast("timestamp"))
    assert bare.first()["source_file"] == "d" and bare.first()["ingestion_date"] == date(2021, 1, 1)


def test_as_of_filter(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1), date(2020, 1, 1)), (datetime(2020, 1, 1, 23, 59), date(2020, 1, 2)), (datetime(2020, 1, 2), date(2020, 1, 2))],
        "date timestamp, ingestion_date date",
    )
    assert filter_as_of(df, "transaction", "2020-01-01").count() == 2
    assert filter_as_of(df, "user", "2020-01-02").count() == 2
    assert filter_as_of(df, "mcc", "2020-01-01").count() == 3
    assert filter_as_of(df, "transaction", "2020-01-01", mode="full").count() == 3
    assert filter_as_of(df, "transaction", " ").count() == 3
    assert month_scope(df.withColumn("txn_month", F.lit(date(2020, 1, 1))), "2020-01-01").count() == 3

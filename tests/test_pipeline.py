"""Files to bronze to silver to gold to warehouse to gate, twice."""

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.operators.quality import QualityError, assert_passed, run_checks
from cardlake.plans import contracts as K
from cardlake.plans import controls, gold, ingest, measures, runlog, silver, warehouse
from cardlake.plans.bronze import ENTITIES
from cardlake.sources import readers, versions, writers
from cardlake.sources.readers import rows_to_table

TXN = "id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors"
FILES = {
    "TRANSACTION": {
        "t1.csv": TXN + """
1,2020-01-05 10:00:00,10,100,$-77.00,Chip Transaction,7,Paris,fr,75001.0,742,
2,2020-01-06 10:00:00,10,100,"$14,500.00",Online Transaction,7,Paris,fr,75001.0,5411,
3,2020-02-06 10:00:00,11,101,$3.00,,8,Rome,it,,5411,5
4,2020-02-07 10:00:00,99,100,$4.00,Swipe,8,Rome,it,,5411,
""",
        "t2.csv": TXN + """
5,2020-02-08 10:00:00,11,999,$5.00,Swipe,8,Rome,it,,5411,
6,2020-02-09 10:00:00,11,101,$6.00,Swipe,8,Rome,it,,9999,
7,2041-02-09 10:00:00,11,101,$7.00,Swipe,8,Rome,it,,5411,
1,2020-01-05 10:00:00,10,100,$-77.00,Chip Transaction,7,Paris,fr,75001.0,742,
""",
    },
    "USER": {
        "u.csv": """id,current_age,retirement_age,birth_year,birth_month,gender,address,latitude,longitude,per_capita_income,yearly_income,total_debt,credit_score,num_credit_cards
10,30,65,1990,1,Male, 1 Main St ,48.85,2.35,$100,$200,$50,700,2
11,40,65,1980,2,Female,2 Main St,41.9,12.5,$100,N/A,$50,710,1
""",
    },
    "CARD": {
        "c.csv": """id,client_id,card_brand,card_type,card_number,expires,cvv,has_chip,num_cards_issued,credit_limit,acct_open_date,year_pin_last_changed,card_on_dark_web
100,10,Visa,Debit,4000,12/2022,123,YES,1,$24295,09/2002,2008,No
101,11,Amex,Credit,4001,1/22,456,maybe,2,$100,01/31/2020,2010,yes
102,77,Visa,Debit,4002,,789,no,1,,,,
""",
    },
    "MCC": {"m.json": '{\n "742": " Vets ",\n "5411": "Grocery"\n}'},
}


@pytest.fixture
def landing(tmp_path):
    for entity, files in FILES.items():
        (tmp_path / "landing" / entity).mkdir(parents=True)
        for name, text in files.items():
            (tmp_path / "landing" / entity / name).write_text(text)
    return lambda e: str(tmp_path / "landing" / e)


def load_all(spark, landing, path, run, day="2020-03-01"):
    out = {}
    for entity in FILES:
        out[entity] = ingest.ingest(
            spark, entity, landing(entity), path(f"bronze/{entity}"), path("manifest"), path("log"), day, f"{run}-{entity}"
        )
    return out


def bronze(spark, path, entity):
    c = ENTITIES[entity].contract
    return spark.read.schema(c.schema).parquet(path(f"bronze/{entity}")).select(*c.names)


def silver_paths(spark, path, run, incremental=False):
    out = {}
    for entity, c in (("MCC", K.SILVER_MCC), ("USER", K.SILVER_USERS), ("CARD", K.SILVER_CARDS), ("TRANSACTION", K.SILVER_TRANSACTIONS)):
        out[entity] = silver.build_silver(bronze(spark, path, entity), entity, path(c.table), f"{run}-{entity}", incremental)
    return out


def read(spark, path, c):
    return writers.read(spark, path(c.table), c.schema).select(*c.names)


def warehouse_refresh(spark, path, run):
    names = {"dim_user": K.GOLD_DIM_USER, "dim_card": K.GOLD_DIM_CARD, "dim_mcc": K.GOLD_DIM_MCC, "dim_date": K.GOLD_DIM_DATE}
    counts = {t: warehouse.refresh_dimension(read(spark, path, c), t, path(t), f"{run}-{t}") for t, c in names.items()}
    counts["dim_month"] = warehouse.refresh_months(read(spark, path, K.GOLD_DIM_DATE), path("dim_month"), run)
    dims = {t: writers.read(spark, path(t)) for t in names}
    fact = warehouse.wh_fact(read(spark, path, K.GOLD_FACT), dims)
    counts["fact"] = warehouse.refresh_slice(fact, "fact_transactions", path("fact_transactions"), f"{run}-f")
    stored = writers.read(spark, path("fact_transactions"), K.WH_FACT.schema)
    for t, make in (("fact_transactions_daily", warehouse.fact_daily), ("fact_transactions_monthly", warehouse.fact_monthly)):
        counts[t] = warehouse.refresh_slice(make(stored, run), t, path(t), f"{run}-{t}")
    return counts, dims, stored


def test_end_to_end(spark, landing, path):
    # bronze
    first = load_all(spark, landing, path, "r1")
    assert first["TRANSACTION"] == {"total_source_files": 2, "total_candidate_files": 2, "processed_files": 2, "failed_files": 0, "rows_loaded": 8, "rows_rejected": 0}
    again = load_all(spark, landing, path, "r2")
    assert all(v["total_candidate_files"] == 0 for v in again.values())
    log = rows(spark.read.parquet(path("log")).where("entity = 'TRANSACTION'"), "status", "processed_files")
    assert log == [("NO_DATA", 0), ("SUCCESS", 2)]
    assert bronze(spark, path, "TRANSACTION").count() == 8
    assert rows(bronze(spark, path, "MCC"), "mcc", "mcc_description") == [(5411, "Grocery"), (742, "Vets")]
    assert bronze(spark, path, "TRANSACTION").select("source_file").distinct().count() == 2

    # silver
    counts = silver_paths(spark, path, "s1")
    assert counts["TRANSACTION"] == {"row_in": 8, "dedup_dropped": 1, "row_out": 7, "partition_count": 3}
    txn = {r["transaction_id"]: r for r in read(spark, path, K.SILVER_TRANSACTIONS).collect()}
    assert txn[1]["amount"] == Decimal("-77.00") and txn[1]["mcc_code"] == "0742" and txn[1]["zip"] == "75001.0"
    assert txn[2]["amount"] == Decimal("14500.00") and txn[3]["error_code"] == 5 and not txn[3]["is_success"]
    cards = {r["card_id"]: r for r in read(spark, path, K.SILVER_CARDS).collect()}
    assert cards[100]["expires_month"] == date(2022, 12, 1) and cards[100]["acct_open_date"] == date(2002, 9, 1)
    assert cards[101]["has_chip"] is None and cards[101]["expires_month"] is None and cards[101]["card_on_dark_web"]

    # an incremental load of the same rows changes nothing
    before = rows(read(spark, path, K.SILVER_TRANSACTIONS))
    assert silver_paths(spark, path, "s2", incremental=True)["TRANSACTION"]["row_out"] == 7
    assert rows(read(spark, path, K.SILVER_TRANSACTIONS)) == before

    # gold
    users, mcc = read(spark, path, K.SILVER_USERS), read(spark, path, K.SILVER_MCC)
    gold.build_dimension(gold.dim_user(users, "g1"), K.GOLD_DIM_USER, path("gold_dim_user"), "g1u")
    gold.build_dimension(gold.dim_mcc(mcc, "g1"), K.GOLD_DIM_MCC, path("gold_dim_mcc"), "g1m", gold.mcc_checks())
    dates = gold.dim_date(spark, run_id="g1")
    gold.build_dimension(dates, K.GOLD_DIM_DATE, path("gold_dim_date"), "g1d", gold.date_checks())
    events, kpis = path("gold_anomaly_event"), path("gold_anomaly_kpi")
    got = gold.build_cards(read(spark, path, K.SILVER_CARDS), read(spark, path, K.GOLD_DIM_USER), path("gold_dim_card"), events, kpis, "g1")
    assert got["row_out"] == 2 and got["row_rejected"] == 1
    got = gold.build_fact(
        read(spark, path, K.SILVER_TRANSACTIONS), read(spark, path, K.GOLD_DIM_USER), read(spark, path, K.GOLD_DIM_CARD),
        read(spark, path, K.GOLD_DIM_MCC), read(spark, path, K.GOLD_DIM_DATE), path("gold_fact_transactions"), events, kpis, "g1",
    )
    assert got == {"row_in": 7, "dedup_dropped": 0, "row_rejected": 4, "anom_count": 4, "row_out": 3, "partition_count": 2}
    assert rows(spark.read.parquet(kpis), "rule_id", "row_count") == [
        ("GOLD.CARD.CONF.001", 1), *[(f"GOLD.TXN.CONF.00{i}", 1) for i in (1, 2, 3, 4)],
    ]
    gold.build_fact(
        read(spark, path, K.SILVER_TRANSACTIONS), read(spark, path, K.GOLD_DIM_USER), read(spark, path, K.GOLD_DIM_CARD),
        read(spark, path, K.GOLD_DIM_MCC), read(spark, path, K.GOLD_DIM_DATE), path("gold_fact_transactions"), events, kpis, "g1",
    )
    assert spark.read.parquet(events).count() == 5 and spark.read.parquet(kpis).count() == 5
    fact = {r["transaction_id"]: r for r in read(spark, path, K.GOLD_FACT).collect()}
    assert (fact[1]["is_chip_used"], fact[2]["is_chip_used"], fact[3]["is_chip_used"]) == (True, False, None)

    # warehouse, twice
    counts, dims, stored = warehouse_refresh(spark, path, "w1")
    assert counts["fact"]["rows_inserted"] == 3 and counts["dim_month"]["rows_inserted"] == 21 * 12
    keys = rows(stored, "transaction_id", "card_key", "user_key", "mcc_key", "date_key")
    counts, dims, stored = warehouse_refresh(spark, path, "w2")
    for name, c in counts.items():
        assert c["rows_inserted"] == c["rows_updated"] == c["rows_deleted"] == 0, name
    assert rows(stored, "transaction_id", "card_key", "user_key", "mcc_key", "date_key") == keys

    # totals agree at every grain
    monthly = writers.read(spark, path("fact_transactions_monthly"), K.WH_FACT_MONTHLY.schema)
    daily = writers.read(spark, path("fact_transactions_daily"), K.WH_FACT_DAILY.schema)
    total = stored.agg(F.sum("amount")).first()[0]
    assert monthly.agg(F.sum("amount_sum_total")).first()[0] == daily.agg(F.sum("amount_sum_total")).first()[0] == total

    # controls and gate
    gold_fact = read(spark, path, K.GOLD_FACT)
    run = controls.Run("w2", F.current_timestamp())
    results = controls.run_controls(gold_fact, stored, monthly, dims, run)
    assert results.columns == K.WH_DQ_RESULT.names and results.count() == 2 * 10 + 1
    decision = controls.publish_decision(results, run.now)
    assert rows(decision, "status") == [("PUBLISHED",), ("PUBLISHED",)]
    controls.assert_publishable(decision, "2020-01-01")
    late = controls.Run("w3", F.current_timestamp() + F.make_dt_interval(hours=F.lit(25)))
    stale = controls.publish_decision(controls.run_controls(gold_fact, stored, monthly, dims, late, "2020-01-01"), late.now)
    assert rows(stale, "txn_month", "status", "reason") == [(date(2020, 1, 1), "BLOCKED", "pub_agg_freshness")]
    with pytest.raises(controls.PublishBlocked):
        controls.assert_publishable(stale, "2020-01-01")
    assert controls.ctrl_rows(results, K.CTRL_CONFORMANCE).columns == K.CTRL_CONFORMANCE.names

    # measures
    by_brand = {r["card_brand"]: r for r in measures.business_measures(stored, dims, ["card_brand"]).collect()}
    assert by_brand["VISA"]["txn_count_total"] == 2 and by_brand["VISA"]["chip_adoption_rate"] == 0.5
    assert by_brand["AMEX"]["darkweb_cards"] == 1 and by_brand["AMEX"]["failure_rate"] == 1.0
    detail = measures.transaction_detail(stored, dims, "2020-01-01", "2020-01-31", "VISA", "2")
    assert rows(detail, "transaction_id", "amount") == [("2", Decimal("14500.00"))]


def test_changed_row_touches_only_its_month(spark, path):
    schema = K.WH_FACT.schema

    def fact(amounts):
        out = []
        for key, (month, amount) in amounts.items():
            r = dict.fromkeys(K.WH_FACT.names)
            r.update(transaction_id=key, txn_month=month, txn_date=month, amount=Decimal(amount), record_hash=str(amount), currency="USD")
            out.append(r)
        return readers.rows_to_table(spark, out, schema)

    jan, feb = date(2020, 1, 1), date(2020, 2, 1)
    target = path("f")
    warehouse.refresh_slice(fact({"1": (jan, 1), "2": (feb, 2)}), "fact_transactions", target, "a")
    before = versions.current(spark, target)
    got = warehouse.refresh_slice(fact({"1": (jan, 5), "3": (jan, 3)}), "fact_transactions", target, "b")
    assert (got["rows_inserted"], got["rows_updated"], got["rows_unchanged"]) == (1, 1, 0)
    after = versions.current(spark, target)
    assert after.changed_since(before) == {"txn_month=2020-01-01"} and set(after.parts) == {"txn_month=2020-01-01", "txn_month=2020-02-01"}
    now = writers.read(spark, target, schema)
    assert rows(now, "transaction_id", "amount") == [("1", Decimal(5)), ("2", Decimal(2)), ("3", Decimal(3))]
    warehouse.refresh_slice(fact({"1": (jan, 5), "3": (jan, 3)}), "fact_transactions", target, "b2")
    assert versions.current(spark, target) == after
    got = warehouse.refresh_slice(fact({"3": (jan, 3)}), "fact_transactions", target, "c", delete_missing=True)
    assert got["rows_deleted"] == 1 and rows(writers.read(spark, target), "transaction_id") == [("2",), ("3",)]


def test_failed_check_leaves_the_table(spark, path):
    bad = [("1", date(2020, 1, 1)), (None, date(2020, 1, 1))]
    df = spark.createDataFrame(bad, "k string, m date")
    from cardlake.operators import quality as Q

    writers.publish(df.limit(1), path("t"), "t", ["m"], Q.not_null(["k"]))
    with pytest.raises(QualityError):
        writers.publish(df, path("t"), "t", ["m"], Q.not_null(["k"]))
    with pytest.raises(QualityError):
        writers.publish(df.withColumn("k", F.lit("x")), path("t"), "t", ["m"], [Q.unique(["k"])])
    assert rows(writers.read(spark, path("t")), "k") == [("1",)]


def test_silver_rejects_cards_without_client(spark):
    names = ENTITIES["CARD"].contract
    row = dict.fromkeys(names.names)
    row.update(id=1, source_file="f", entity="CARD", ingestion_ts=datetime(2020, 1, 1), ingestion_date=date(2020, 1, 1))
    df = readers.rows_to_table(spark, [row], names.schema)
    with pytest.raises(QualityError):
        assert_passed(run_checks(silver.silver_cards(df), silver.card_checks()))
    users = spark.createDataFrame([(5,)], "client_id bigint")
    assert gold.dim_card(silver.silver_cards(df), users, "g")[0].count() == 1
    with pytest.raises(ValueError):
        silver.silver_cards(df.withColumn("extra", F.lit(1)))


def test_ingest_isolates_bad_files(spark, path, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = "currency,base_currency,currency_name,exchange_rate,date\n"
    (folder / "a.csv").write_text(head + "usd,EUR,Dollar,1.1,2020-01-01\n")
    (folder / "b.csv").write_text(head + "gbp,EUR,Pound,0.9,2020-01-01,extra,extra\nchf,EUR,Franc,1.0,2020-01-01\n")
    (folder / "c d.csv").write_text("other,header\n1,2\n")
    args = (spark, "FX", str(folder), path("fx"), path("m"), path("l"))
    got = ingest.ingest(*args, "2020-01-02", "i1")
    assert (got["processed_files"], got["failed_files"], got["rows_loaded"], got["rows_rejected"]) == (1, 1, 2, 1)
    assert rows(spark.read.parquet(path("fx")), "currency") == [("CHF",), ("USD",)]
    assert rows(spark.read.parquet(ingest.rejects_path(path("fx"))), "line") == [("gbp,EUR,Pound,0.9,2020-01-01,extra,extra",)]
    first = {r["source_name"]: r for r in writers.read(spark, path("m")).collect()}
    assert [first[n]["last_status"] for n in ("a.csv", "b.csv", "c d.csv")] == ["SUCCESS", "PARTIAL", "FAILED"]
    assert rows(spark.read.parquet(path("l")), "status") == [("PARTIAL",)]
    (folder / "c d.csv").write_text("date,currency\n2020-01-01,gbp\n")
    got = ingest.ingest(*args, "2020-01-03", "i2")
    assert (got["total_candidate_files"], got["processed_files"], got["failed_files"]) == (1, 1, 0)
    assert rows(spark.read.parquet(path("fx")), "currency", "base_currency") == [("CHF", "EUR"), ("GBP", None), ("USD", "EUR")]
    second = {r["source_name"]: r for r in writers.read(spark, path("m")).collect()}
    assert second["c d.csv"]["first_ingested_datetime"] == first["c d.csv"]["first_ingested_datetime"]
    assert second["c d.csv"]["exec_date"] == date(2020, 1, 3) and second["a.csv"]["exec_date"] == date(2020, 1, 2)
    empty = tmp_path / "none"
    empty.mkdir()
    assert ingest.ingest(spark, "FX", str(empty), path("fx"), path("m"), path("l"), "2020-01-04", "i3")["total_source_files"] == 0
    assert rows(spark.read.parquet(path("l")), "status") == [("NO_DATA",), ("PARTIAL",), ("SUCCESS",)]


def test_a_cut_off_load_is_undone_and_entities_keep_apart(spark, path, tmp_path):
    for n in ("fx", "partner"):
        (tmp_path / n).mkdir()
        (tmp_path / n / "a.csv").write_text("currency,date\nusd,2020-01-01\n")
    files = [str(tmp_path / "fx" / "a.csv")]
    ingest.begin_batch(spark, "FX", "cut-0", "2020-01-02", files, path("m"))
    ingest.load_files(spark, "FX", files, path("fx-t"), "2020-01-02", "cut-0")  # and no manifest
    for name, run in (("FX", "r1"), ("PARTNER", "r2"), ("FX", "r3")):
        ingest.ingest(spark, name, str(tmp_path / name.lower()), path(f"{name.lower()}-t"), path("m"), path("l"), "2020-01-02", run)
    assert spark.read.parquet(path("fx-t")).count() == spark.read.parquet(path("partner-t")).count() == 1
    assert rows(writers.read(spark, path("m")), "entity") == [("FX",), ("PARTNER",)]


def test_unknown_entities_go_by_their_own_headers(spark, path, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "in" / "b.csv").write_text("y,x,z\n20,10,30\n")
    ingest.ingest(spark, "PARTNER", str(tmp_path / "in"), path("p"), path("m"), path("l"), "2020-01-02", "u1")
    assert rows(spark.read.parquet(path("p")), "x", "y", "z") == [("1", "2", None), ("10", "20", "30")]


def test_incremental_silver_moves_months_and_keeps_the_newest(spark, path):
    def bronze_of(*txns):
        c = ENTITIES["TRANSACTION"].contract
        made = [{"id": i, "date": d, "client_id": 1, "card_id": 1, "amount": a, "merchant_id": 1, "mcc": 1, "ingestion_ts": t} for i, d, a, t in txns]
        return K.project_to_contract(rows_to_table(spark, made, T.StructType([T.StructField(n, T.StringType()) for n in made[0]])).select(
            "*", *[F.lit(None).alias(n) for n in c.names if n not in made[0]]), c)

    args = (path("silver"),)
    silver.build_silver(bronze_of((1, "2020-01-31 10:00:00", 5.0, "2020-02-01 00:00:00"), (2, "2020-02-01 10:00:00", 7.0, "2020-02-02 00:00:00")), "TRANSACTION", *args, "s1")
    late = bronze_of((1, "2020-02-01 10:00:00", 6.0, "2020-02-03 00:00:00"), (2, "2020-02-01 10:00:00", 1.0, "2020-01-15 00:00:00"))
    for run in ("s2", "s3"):
        silver.build_silver(late, "TRANSACTION", *args, run, incremental=True)
        got = writers.read(spark, path("silver"), K.SILVER_TRANSACTIONS.schema)
        assert rows(got, "transaction_id", "txn_month", "amount") == [(1, date(2020, 2, 1), Decimal("6.00")), (2, date(2020, 2, 1), Decimal("7.00"))]


def test_unknown_entity_and_full_mode(spark, path, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "x.csv").write_text("My Col,b\n1,2\n")
    args = (spark, "PARTNER", str(folder), path("p"), path("m"), path("l"))
    ingest.ingest(*args, "2020-01-02", "f1")
    assert ingest.ingest(*args, "2020-01-02", "f2", mode="FULL")["processed_files"] == 1
    df = spark.read.parquet(path("p"))
    assert df.columns[:2] == ["My Col", "b"] and df.count() == 2 and df.first()["entity"] == "PARTNER"


def test_headers_make_one_scan_a_width(spark, path, tmp_path, monkeypatch):
    """Files of many headers are scanned once and written once; only a line that does not fit makes a second pass."""
    import gzip
    import itertools

    (tmp_path / "in").mkdir()
    columns = ["currency", "base_currency", "date"]
    for i, order in enumerate(itertools.permutations(columns)):
        row = {"currency": f"c{i}", "base_currency": '"a,b"', "date": "2020-01-01"}
        text = "\n" * (i == 0) + ",".join(order) + "\n" + ",".join(row[c] for c in order) + "\n"
        if i == 1:
            (tmp_path / "in" / "z.csv.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (tmp_path / "in" / f"{i} +ü.csv").write_text(text)
    (tmp_path / "in" / "wide.csv").write_text("date,currency,more,exchange_rate\n2020-01-02,w,x,1.5\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    files = [str(p) for p in sorted((tmp_path / "in").iterdir())]
    headers, unreadable = ingest._headers(spark, files)
    assert len(headers) == 7 and not unreadable
    landing = readers.read_by_headers(spark, headers, columns)
    assert landing._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2  # widths 3 and 4
    got = ingest.load_files(spark, "FX", files, path("t"), "2020-01-02", "b")
    assert sorted((s, n, bad) for _, s, n, bad in got) == [("SUCCESS", 0, 0)] + [("SUCCESS", 1, 0)] * 7
    stored = rows(spark.read.parquet(path("t")), "currency", "base_currency", "rate_vs_usd")
    assert stored == [(f"C{i}", "A,B", None) for i in range(6)] + [("W", None, 1.5)] or [r[0] for r in stored] == [f"C{i}" for i in range(6)] + ["W"]
    with pytest.raises(Exception):
        ingest._headers(spark, [str(tmp_path / "none" / f"{i}.csv") for i in range(ingest.UNREADABLE + 1)])


def test_sketches_and_exact_counts(spark):
    fact = spark.range(5000).select(
        F.col("id").alias("card_key"), (F.col("id") % 700).alias("user_key"), F.when(F.col("id") % 3 > 0, F.col("id") % 900).alias("merchant_id"),
        (F.col("id") % 2).alias("k"), F.lit(None).cast("string").alias("a"))
    for by, mode in ((["k"], "group"), (["k", "a"], "cube"), (["k", "a"], "rollup")):
        exact = measures._distinct_counts(fact, {}, by, mode)
        plain = measures._grouped(fact, by, mode).agg(
            *[F.countDistinct(c).alias(n) for n, c in measures._DISTINCT.items()], *measures._level(by, mode, "__level"))
        assert rows(exact, *plain.columns) == rows(plain)
        near = measures.counts_from_sketches(measures.distinct_sketches(fact, ["k", "a"]), {}, by, mode)
        for a, b in zip(rows(exact, *plain.columns), rows(near, *plain.columns)):
            assert all(abs(x - y) <= 4 * measures.SKETCH_ERROR * x + 1 for x, y in zip(a[len(by):], b[len(by):]))


def test_file_listings(spark):
    good = '{"childItems":[{"name":"a.csv","type":"File","size":3},{"type":"File"}]}'
    assert rows(readers.files_from_json(spark, good, "src/"), "file_path", "file_size") == [("src/a.csv", 3)]
    assert rows(readers.files_from_json(spark, '[{"name":"b"}]', "src/"), "file_path") == [("src/b",)]
    for nothing in ("[]", "not json", '{"other":1}'):
        assert readers.files_from_json(spark, nothing, "src/").count() == 0
    files = readers.files_from_json(spark, '[{"name":"b"}]', "src/")
    paths = readers.add_lineage_paths(files, "landing/", "archive/", "2020-01-01").first()
    assert paths["landing_path"] == "landing/2020-01-01/b" and paths["archive_path"] == "archive/2020-01-01/b"


@pytest.mark.parametrize(
    "counts, status",
    [((0, 0, 0), "NO_DATA"), ((3, 3, 0), "SUCCESS"), ((3, 0, 2), "FAILED"), ((3, 1, 2), "PARTIAL"), ((3, 2, 0), "PARTIAL")],
)
def test_run_status(spark, counts, status):
    df = spark.createDataFrame([counts], "c int, p int, f int")
    assert df.select(ingest.run_status(F.col("c"), F.col("p"), F.col("f"))).first()[0] == status


def test_recon(spark):
    jan, feb, mar = date(2020, 1, 1), date(2020, 2, 1), date(2020, 3, 1)
    g = spark.createDataFrame([(jan, Decimal("1.00")), (feb, Decimal("2.00")), (mar, Decimal("1.00"))], "txn_month date, amount decimal(18,2)")
    w = spark.createDataFrame([(jan, Decimal("1.00")), (feb, Decimal("2.01"))], "txn_month date, amount decimal(18,2)")
    now = F.lit("2020-04-01").cast("timestamp")
    got = {(r["txn_month"].month, r["metric_name"].split("_")[1]): r for r in controls.recon(g, w, now).collect()}
    assert got[1, "amounts"]["status"] == got[2, "counts"]["status"] == "PASS"
    assert got[2, "amounts"]["status"] == "FAIL" and got[2, "amounts"]["delta_value"] == Decimal("-0.01")
    assert got[3, "amounts"]["status"] == got[3, "counts"]["status"] == "FAIL"
    assert controls.recon(g, w, now, ("amounts",), tolerance=0.01, month="2020-02-01").first()["status"] == "PASS"
    result = controls.recon_results(controls.recon(g, w, now), controls.Run("r", now))
    assert result.where("status = 'FAIL'").count() == 3


def test_duplicates_and_missing_month(spark):
    jan = date(2020, 1, 1)
    fact = spark.createDataFrame([("1", jan), ("1", jan), ("1", date(2020, 2, 1)), ("2", jan)], "transaction_id string, txn_month date")
    run = controls.Run("r", F.lit("2020-04-01").cast("timestamp"))
    assert rows(controls.ctl_duplicates(fact, run), "txn_month", "issue_count") == [(jan, 1), (date(2020, 2, 1), 0)]
    assert rows(controls.ctl_duplicates(fact, run, per_month=False), "issue_count", "status") == [(1, "FAIL")]
    monthly = spark.createDataFrame([(jan, datetime(2020, 3, 31, 12))], "txn_month date, gold_load_ts_max timestamp")
    gates = controls.gate_present(monthly, run, fact).unionByName(controls.gate_fresh(monthly, run, months=fact))
    assert rows(controls.publish_decision(gates, run.now), "txn_month", "status", "reason") == [
        (jan, "PUBLISHED", ""), (date(2020, 2, 1), "BLOCKED", "pub_agg_freshness,pub_agg_monthly_present"),
    ]


def test_run_rollup_cases(spark):
    t = datetime(2020, 1, 1, 10)

    def log(run, job, status, end=None, message="m", start=t):
        return {"run_id": run, "job_id": job, "exec_ts_start": start, "exec_ts_end": end, "status": status, "message": message, "rows_source": 2}

    end = t + timedelta(seconds=90)
    entries = [
        log("open", "a", "STARTED"),
        log("done", "a", "STARTED"), log("done", "a", "SUCCESS", end, "fine"), log("done", runlog.ROLLUP_JOB, "FAILED", end),
        log("broken", "a", "STARTED"), log("broken", "a", "FAILED", end, "boom"), log("broken", "b", "SUCCESS", end + timedelta(1), "later"),
        log("dqfail", "a", "SUCCESS", end, " "), log("dqinfo", "a", "SUCCESS", end, "ok"),
    ]
    checks = [
        {"run_id": "dqfail", "check_code": "c", "exec_ts": t, "status": "PASS", "issue_count": 0, "message": "old"},
        {"run_id": "dqfail", "check_code": "c", "exec_ts": end, "status": "FAIL", "issue_count": 7, "message": "seven"},
        {"run_id": "dqinfo", "check_code": "c", "exec_ts": t, "status": "INFO", "issue_count": None, "message": None},
    ]
    registry = spark.createDataFrame([("a", True)], "job_code string, is_critical boolean")
    got = {
        r["run_id"]: r for r in runlog.run_rollup(
            readers.rows_to_table(spark, entries, K.WH_JOB_LOG.schema), readers.rows_to_table(spark, checks, K.WH_DQ_RESULT.schema),
            registry, F.lit("2020-01-01 10:05:00").cast("timestamp"), exec_date="2020-01-01",
        ).collect()
    }
    assert {k: r["run_status"] for k, r in got.items()} == {
        "open": "RUNNING", "done": "SUCCESS", "broken": "FAILED", "dqfail": "FAILED", "dqinfo": "SUCCESS",
    }
    assert got["open"]["duration_sec"] == 300 and got["done"]["duration_sec"] == 90 and got["done"]["jobs_total"] == 1
    assert got["broken"]["critical_failed"] == 1 and got["broken"]["last_message"] == "boom" and got["broken"]["rows_source"] == 4
    assert got["dqfail"]["last_message"] == "seven" and got["dqfail"]["dq_issue_count"] == 7
    assert got["dqinfo"]["dq_status"] == "INFO" and got["done"]["dq_status"] is None and got["done"]["exec_date"] == date(2020, 1, 1)


def test_logged_job(spark, path):
    with runlog.logged_job(spark, path("log"), "r", "ok", date(2020, 1, 1), message="load") as counts:
        counts["rows_source"] = 3
    with pytest.raises(ZeroDivisionError):
        with runlog.logged_job(spark, path("log"), "r", "bad", date(2020, 1, 1)):
            1 / 0
    log = spark.read.parquet(path("log"))
    assert rows(log, "job_id", "status", "rows_source") == [
        ("bad", "FAILED", None), ("bad", "STARTED", None), ("ok", "STARTED", None), ("ok", "SUCCESS", 3)]
    step = runlog.step_row("g", "dim_user", datetime.now(timezone.utc), datetime.now(timezone.utc), "SUCCESS", {"row_out": 2, "x": 1}, critical=True)
    writers.append_rows(spark, path("steps"), [step], K.GOLD_STEP_LOG.schema)
    assert runlog.step_status(spark.read.parquet(path("steps"))).first()["status"] == "SUCCESS"


def test_rebuild_catalog_table(spark):
    writers.create_if_missing(spark, "t_dim_month", K.WH_DIM_MONTH.schema)
    writers.create_if_missing(spark, "t_dim_month", K.WH_DIM_MONTH.schema)
    dates = gold.dim_date(spark, "2020-01-01", "2020-02-29")
    for _ in range(2):
        writers.rebuild_table(warehouse.dim_month(dates), "t_dim_month")
    assert rows(readers.read_table(spark, "t_dim_month"), "month_label") == [("2020-01",), ("2020-02",)]
    spark.sql("drop table t_dim_month")


def test_month_label_and_modes(spark):
    one = spark.range(1)
    assert one.select(measures.month_label(2001, 1)).first()[0] == "Jan 2001"
    assert one.select(measures.month_label()).first()[0] == "All months"
    with pytest.raises(ValueError):
        measures.business_measures(one, {"dim_card": one}, ["nothing"])

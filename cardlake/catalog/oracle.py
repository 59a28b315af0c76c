"""DuckDB text of the card views, and assembly of complete oracle queries."""

from __future__ import annotations

import re

from cardlake.catalog.views import CALENDAR, LOAD_TS
from cardlake.plans.silver import HASH_COLUMNS


def record_hash(table: str, **formats: str) -> str:
    """sha256 over the record-hash columns of a silver table."""
    parts = []
    for c in HASH_COLUMNS[table]:
        text = formats.get(c, f"CAST({c} AS VARCHAR)")
        parts.append(f"coalesce({text}, '∅')")
    return f"sha256(concat_ws('||', {', '.join(parts)}))"


def bucketed_number(key: str) -> str:
    """Surrogate key: rank by hash bucket, then by key."""
    return f"row_number() OVER (ORDER BY substr(md5(CAST({key} AS VARCHAR)), 1, 3), CAST({key} AS VARCHAR))"


def cents_average(total: str, n: str) -> str:
    """Average of two-decimal amounts, rounded half away from zero, exactly."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    rounded = f"(2 * abs({cents}) + {n}) // (2 * {n})"
    return (
        f"CASE WHEN {n} > 0 THEN CAST(CAST(CASE WHEN {total} < 0 THEN -1 ELSE 1 END * ({rounded}) AS DECIMAL(30,0))"
        f" * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END"
    )


_TXN_HASH = record_hash("silver_transactions", txn_ts="strftime(txn_ts, '%Y-%m-%d %H:%M:%S')")
_MONEY = "CAST(coalesce(sum({0}), 0) AS DECIMAL(18,2))"


def money_sum(expr: str) -> str:
    return _MONEY.format(expr)


_WON = "CASE WHEN is_success THEN amount END"
AGGREGATE = f"""
    count(*) AS txn_count_total,
    count(*) FILTER (WHERE is_success) AS txn_count_success,
    count(*) FILTER (WHERE NOT is_success) AS txn_count_failed,
    count(*) FILTER (WHERE is_success IS NULL) AS txn_count_unknown,
    {money_sum('amount')} AS amount_sum_total,
    {money_sum(_WON)} AS amount_sum_success,
    {money_sum('CASE WHEN NOT is_success THEN amount END')} AS amount_sum_failed,
    {money_sum('CASE WHEN is_success IS NULL THEN amount END')} AS amount_sum_unknown,
    {money_sum('abs(amount)')} AS amount_abs_sum_total,
    {cents_average(f'sum({_WON})', f'count({_WON})')} AS amount_avg_success,
    min(amount) AS amount_min,
    max(amount) AS amount_max,
    count(*) FILTER (WHERE is_chip_used) AS txn_count_chip_used,
    {money_sum('CASE WHEN is_chip_used THEN amount END')} AS amount_sum_chip_used,
    max(txn_date) AS gold_load_ts_max
"""

VIEWS = {
    "txn_raw": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_shipdate AS date, o_custkey AS client_id,
               l_suppkey AS card_id, l_partkey AS merchant_id,
               CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount,
               CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'A' THEN 'CHIP TRANSACTION'
                    WHEN l_returnflag = 'N' THEN 'ONLINE TRANSACTION' ELSE 'SWIPE TRANSACTION' END AS use_chip,
               upper(p_brand) AS merchant_city, upper(p_type) AS merchant_state,
               lpad(CAST(l_partkey % 100000 AS VARCHAR), 5, '0') AS zip, p_size AS mcc,
               CASE WHEN l_linestatus = 'F' AND l_quantity > 45 THEN 1 END AS errors
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "txn_plain": """
        SELECT id AS transaction_id, date AS txn_ts, CAST(date AS DATE) AS txn_date,
               CAST(date_trunc('month', date) AS DATE) AS txn_month, client_id, card_id, merchant_id,
               lpad(CAST(mcc AS VARCHAR), 4, '0') AS mcc_code, CAST(amount AS DECIMAL(18,2)) AS amount,
               use_chip, merchant_city, merchant_state, zip,
               CAST(coalesce(errors, 0) AS INTEGER) AS error_code, coalesce(errors, 0) = 0 AS is_success
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC, merchant_id DESC,
                                           card_id DESC, abs(amount) DESC) AS rn FROM txn_raw)
        WHERE rn = 1""",
    "silver_txn": f"SELECT *, {_TXN_HASH} AS record_hash FROM txn_plain",
    "users_plain": """
        SELECT c_custkey AS client_id, CAST(c_custkey % 70 + 18 AS INTEGER) AS current_age,
               CAST(c_custkey % 10 + 60 AS INTEGER) AS retirement_age,
               CAST(c_custkey % 60 + 1940 AS INTEGER) AS birth_year,
               CAST(c_custkey % 12 + 1 AS INTEGER) AS birth_month,
               CASE WHEN c_custkey % 2 = 0 THEN 'FEMALE' ELSE 'MALE' END AS gender,
               upper(trim(c_name)) AS address,
               CAST(c_custkey % 180 - 90 AS DECIMAL(9,6)) AS latitude,
               CAST(c_custkey % 360 - 180 AS DECIMAL(9,6)) AS longitude,
               CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS per_capita_income,
               CAST(c_acctbal AS DECIMAL(18,2)) AS yearly_income,
               CAST(c_acctbal AS DECIMAL(18,2)) AS total_debt,
               CAST(c_custkey % 550 + 300 AS INTEGER) AS credit_score,
               CAST(c_custkey % 5 + 1 AS INTEGER) AS num_credit_cards
        FROM customer""",
    "users": f"SELECT *, {record_hash('silver_users')} AS record_hash FROM users_plain",
    "cards_plain": """
        SELECT s_suppkey AS card_id, CASE WHEN s_suppkey % 10 <> 3 THEN s_suppkey END AS client_id,
               CASE s_nationkey % 4 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTERCARD' WHEN 2 THEN 'AMEX'
                    ELSE 'DISCOVER' END AS card_brand,
               CASE WHEN s_suppkey % 2 = 0 THEN 'DEBIT' ELSE 'CREDIT' END AS card_type,
               concat('4', lpad(CAST(s_suppkey AS VARCHAR), 15, '0')) AS card_number,
               concat(lpad(CAST(s_suppkey % 12 + 1 AS VARCHAR), 2, '0'),
                      CASE WHEN s_suppkey % 3 = 0 THEN '/2022' ELSE '/23' END) AS expires_raw,
               make_date(CASE WHEN s_suppkey % 3 = 0 THEN 2022 ELSE 2023 END, s_suppkey % 12 + 1, 1) AS expires_month,
               lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') AS cvv,
               s_suppkey % 3 <> 0 AS has_chip, CAST(s_suppkey % 3 + 1 AS INTEGER) AS num_cards_issued,
               CAST(s_acctbal AS DECIMAL(18,2)) AS credit_limit,
               make_date(s_suppkey % 20 + 2000, s_suppkey % 12 + 1, 1) AS acct_open_date,
               CAST(s_suppkey % 20 + 2000 AS INTEGER) AS year_pin_last_changed,
               s_suppkey % 20 = 1 AS card_on_dark_web
        FROM supplier""",
    "silver_card": f"SELECT *, {record_hash('silver_cards')} AS record_hash FROM cards_plain",
    "known_users": "SELECT * FROM users WHERE client_id % 50 <> 0",
    "known_mcc": "SELECT * FROM mcc WHERE CAST(mcc_code AS INTEGER) % 13 <> 0",
    "cards": "SELECT * FROM silver_card WHERE client_id IS NULL OR client_id IN (SELECT client_id FROM known_users)",
    "mcc_plain": """
        SELECT DISTINCT lpad(CAST(p_size AS VARCHAR), 4, '0') AS mcc_code,
               concat('SIZE ', p_size) AS mcc_description
        FROM part""",
    "mcc": f"SELECT *, {record_hash('silver_mcc')} AS record_hash FROM mcc_plain",
    "fx_plain": """
        SELECT currency, base_currency, currency_name, fx_date,
               CAST(date_trunc('month', fx_date) AS DATE) AS fx_month, rate, quoted
        FROM (SELECT *, row_number() OVER (PARTITION BY base_currency, currency, fx_date
                                           ORDER BY quoted DESC, rate DESC) AS rn
              FROM (SELECT printf('C%02d', o_custkey % 25) AS currency, 'EUR' AS base_currency,
                           printf('Currency c%02d', o_custkey % 25) AS currency_name,
                           CAST(o_orderdate AS DATE) AS fx_date,
                           CAST(o_totalprice / 1000 AS DECIMAL(18,8)) AS rate,
                           o_orderdate + to_seconds(o_orderkey % 86400) AS quoted FROM orders))
        WHERE rn = 1""",
    "fx": f"SELECT *, {record_hash('silver_fx_rates')} AS record_hash FROM fx_plain",
    "days": f"""
        SELECT CAST(d AS DATE) AS date_value
        FROM generate_series(TIMESTAMP '{CALENDAR[0]}', TIMESTAMP '{CALENDAR[1]}', INTERVAL 1 DAY) AS g(d)""",
    "tagged": """
        SELECT *, CASE WHEN client_id IS NULL OR client_id NOT IN (SELECT client_id FROM known_users) THEN 1
                       WHEN card_id IS NULL OR card_id NOT IN (SELECT card_id FROM cards) THEN 2
                       WHEN mcc_code IS NULL OR mcc_code NOT IN (SELECT mcc_code FROM known_mcc) THEN 3
                       WHEN txn_date IS NULL OR txn_date NOT IN (SELECT date_value FROM days) THEN 4 END AS failed
        FROM silver_txn""",
    "fact": "SELECT *, contains(use_chip, 'CHIP') AS is_chip_used FROM tagged WHERE failed IS NULL",
    "events_out": """
        SELECT 'CONFORMANCE' AS anom_domain,
               CASE failed WHEN 1 THEN 'ORPHAN_DIM_USER' WHEN 2 THEN 'ORPHAN_DIM_CARD'
                           WHEN 3 THEN 'ORPHAN_DIM_MCC' ELSE 'ORPHAN_DIM_DATE' END AS anom_type,
               CASE failed WHEN 3 THEN 'MEDIUM' ELSE 'HIGH' END AS severity,
               concat('GOLD.TXN.CONF.00', failed) AS rule_id,
               sha256(concat_ws('||', CAST(transaction_id AS VARCHAR), CASE failed
                   WHEN 1 THEN CAST(client_id AS VARCHAR) WHEN 2 THEN CAST(card_id AS VARCHAR)
                   WHEN 3 THEN mcc_code ELSE CAST(txn_date AS VARCHAR) END)) AS key_hash,
               CASE failed
                   WHEN 1 THEN concat('{"transaction_id":', transaction_id, ',"client_id":', client_id, '}')
                   WHEN 2 THEN concat('{"transaction_id":', transaction_id, ',"card_id":', card_id, '}')
                   WHEN 3 THEN concat('{"transaction_id":', transaction_id, ',"mcc_code":"', mcc_code, '"}')
                   ELSE concat('{"transaction_id":', transaction_id, ',"txn_date":"', txn_date, '"}')
               END AS natural_keys,
               concat('Orphan detected: ', CASE failed WHEN 1 THEN 'client_id not found in dim (client_id).'
                   WHEN 2 THEN 'card_id not found in dim (card_id).'
                   WHEN 3 THEN 'mcc_code not found in dim (mcc_code).'
                   ELSE 'txn_date not found in dim (txn_date).' END) AS detail
        FROM tagged WHERE failed IS NOT NULL""",
    "wh_user": f"""
        SELECT {bucketed_number('client_id')} AS user_key, CAST(client_id AS VARCHAR) AS client_id, current_age,
               yearly_income, total_debt, credit_score, address, record_hash FROM users""",
    "wh_card": f"""
        SELECT {bucketed_number('card_id')} AS card_key, CAST(card_id AS VARCHAR) AS card_id,
               CAST(client_id AS VARCHAR) AS client_id, card_brand, card_type, has_chip, credit_limit,
               num_cards_issued, card_on_dark_web, record_hash FROM cards""",
    "wh_mcc": f"""
        SELECT {bucketed_number('CAST(mcc_code AS INTEGER)')} AS mcc_key, CAST(mcc_code AS INTEGER) AS mcc_code,
               mcc_description, CAST(NULL AS VARCHAR) AS mcc_category, record_hash FROM mcc""",
    "wh_date": """
        SELECT row_number() OVER (ORDER BY substr(md5(CAST(date_id AS VARCHAR)), 1, 3), CAST(date_id AS VARCHAR)) AS date_key,
               *, upper(sha256(concat_ws('|', CAST(date_id AS VARCHAR), CAST(full_date AS VARCHAR), CAST(year AS VARCHAR),
                   CAST(quarter AS VARCHAR), CAST(month AS VARCHAR), CAST(week AS VARCHAR), CAST(day_of_week AS VARCHAR),
                   CASE WHEN is_weekend THEN '1' ELSE '0' END))) AS record_hash
        FROM (SELECT CAST(strftime(date_value, '%Y%m%d') AS INTEGER) AS date_id, date_value AS full_date,
                     CAST(year(date_value) AS INTEGER) AS year, CAST(quarter(date_value) AS INTEGER) AS quarter,
                     CAST(month(date_value) AS INTEGER) AS month, CAST(week(date_value) AS INTEGER) AS week,
                     CAST(isodow(date_value) AS INTEGER) AS day_of_week, isodow(date_value) >= 6 AS is_weekend,
                     isodow(date_value) < 6 AS is_business_day FROM days)""",
    "wh_fact_known": """
        SELECT CAST(f.transaction_id AS VARCHAR) AS transaction_id, d.date_key, u.user_key, c.card_key, m.mcc_key,
               f.txn_date, f.txn_month, f.amount, 'USD' AS currency, f.is_success,
               CAST(f.error_code AS VARCHAR) AS error_code, f.is_chip_used, f.merchant_id,
               CAST(NULL AS VARCHAR) AS merchant_name, f.merchant_city, f.merchant_state,
               f.zip AS merchant_zip, f.record_hash
        FROM fact f JOIN wh_date d ON d.full_date = f.txn_date
        JOIN wh_user u ON u.client_id = CAST(f.client_id AS VARCHAR)
        JOIN wh_card c ON c.card_id = CAST(f.card_id AS VARCHAR)
        JOIN wh_mcc m ON m.mcc_code = CAST(f.mcc_code AS INTEGER)""",
    "wh_fact": """
        SELECT * REPLACE (CASE WHEN transaction_id LIKE '%6' THEN NULL ELSE is_success END AS is_success)
        FROM wh_fact_known""",
    "daily": f"""
        SELECT date_key, user_key, card_key, mcc_key, currency, txn_date, txn_month, {AGGREGATE}
        FROM wh_fact GROUP BY ALL""",
    "monthly": f"""
        SELECT txn_month, user_key, card_key, mcc_key, currency, {AGGREGATE} FROM wh_fact
        GROUP BY txn_month, user_key, card_key, mcc_key, currency""",
    "job_log": """
        SELECT event_id, CAST(event_id // 6 AS VARCHAR) AS run_id, concat('job_', event_id % 3) AS job_id,
               ts AS exec_ts_start,
               CASE WHEN event_type <> 'signup' THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS exec_ts_end,
               CAST(ts AS DATE) AS exec_date, CAST(date_trunc('month', ts) AS DATE) AS txn_month,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'STARTED' ELSE 'SUCCESS' END AS status,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_source,
               CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS rows_inserted,
               CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted,
               CASE WHEN event_id % 5 = 0 THEN ' ' ELSE concat(event_type, ' ', event_id) END AS message
        FROM events""",
    "dq_log": """
        SELECT event_id, CAST(event_id // 6 AS VARCHAR) AS run_id, concat('chk_', event_id % 2) AS check_code,
               ts AS exec_ts, CASE WHEN k < 5 THEN 'FAIL' WHEN k < 80 THEN 'PASS' ELSE 'INFO' END AS status,
               k % 4 AS issue_count, concat('check ', event_id) AS message
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "jobs_last": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, job_id
            ORDER BY coalesce(exec_ts_end, exec_ts_start) DESC, exec_ts_start DESC, event_id DESC) AS rn FROM job_log)
        WHERE rn = 1""",
    "dq_last": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, check_code
            ORDER BY exec_ts DESC, event_id DESC) AS rn FROM dq_log) WHERE rn = 1""",
    "runs": """
        SELECT j.run_id, j.exec_date, j.exec_ts_start, j.exec_ts_end, j.txn_month,
               CASE WHEN jobs_started > 0 THEN 'RUNNING'
                    WHEN jobs_failed > 0 OR critical_failed > 0 OR coalesce(dq_status, '') = 'FAIL' THEN 'FAILED'
                    ELSE 'SUCCESS' END AS run_status,
               CAST(floor(epoch(coalesce(exec_ts_end, TIMESTAMP '2024-12-31'))) - floor(epoch(exec_ts_start)) AS BIGINT) AS duration_sec,
               CAST(jobs_total AS INTEGER) AS jobs_total, CAST(jobs_failed AS INTEGER) AS jobs_failed,
               CAST(jobs_success AS INTEGER) AS jobs_success, CAST(jobs_started AS INTEGER) AS jobs_started,
               CAST(critical_failed AS INTEGER) AS critical_failed,
               rows_source, rows_inserted, rows_updated, rows_deleted, dq_status,
               CAST(coalesce(dq_fail_count, 0) AS INTEGER) AS dq_fail_count,
               CAST(coalesce(dq_issue_count, 0) AS BIGINT) AS dq_issue_count,
               coalesce(failed_message, dq_message, any_message) AS last_message
        FROM (SELECT run_id, max(exec_date) AS exec_date, min(exec_ts_start) AS exec_ts_start,
                     max(exec_ts_end) AS exec_ts_end, max(txn_month) AS txn_month, count(*) AS jobs_total,
                     count(*) FILTER (WHERE status = 'FAILED') AS jobs_failed,
                     count(*) FILTER (WHERE status = 'SUCCESS') AS jobs_success,
                     count(*) FILTER (WHERE status = 'STARTED' OR exec_ts_end IS NULL) AS jobs_started,
                     count(*) FILTER (WHERE status = 'FAILED' AND job_id = 'job_0') AS critical_failed,
                     CAST(sum(rows_source) AS BIGINT) AS rows_source, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
                     CAST(sum(rows_updated) AS BIGINT) AS rows_updated, CAST(sum(rows_deleted) AS BIGINT) AS rows_deleted
              FROM jobs_last GROUP BY run_id) j
        LEFT JOIN (SELECT run_id, count(*) FILTER (WHERE status = 'FAIL') AS dq_fail_count, sum(issue_count) AS dq_issue_count,
                     CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL'
                          WHEN count(*) FILTER (WHERE status = 'PASS') > 0 THEN 'PASS' ELSE 'INFO' END AS dq_status
                   FROM dq_last GROUP BY run_id) q ON q.run_id = j.run_id
        LEFT JOIN (SELECT run_id, arg_max(message, (exec_ts, event_id)) AS dq_message
                   FROM dq_log WHERE status = 'FAIL' GROUP BY run_id) qm ON qm.run_id = j.run_id
        LEFT JOIN (SELECT run_id,
                     arg_max(message, (coalesce(exec_ts_end, exec_ts_start), event_id)) FILTER (WHERE status = 'FAILED') AS failed_message,
                     arg_max(message, (coalesce(exec_ts_end, exec_ts_start), event_id)) AS any_message
                   FROM job_log WHERE trim(message) <> '' GROUP BY run_id) m ON m.run_id = j.run_id""",
}

_WORD = re.compile(r"[a-z_]+")


def _views_in(text: str) -> list[str]:
    words = set(_WORD.findall(text))
    return [v for v in VIEWS if v in words]


def with_views(body: str) -> str:
    """``body`` behind the CTEs it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str, inside: str | None = None) -> None:
        for v in _views_in(text):
            if v != inside and v not in needed:
                visit(VIEWS[v], v)
                needed.append(v)

    visit(body)
    if not needed:
        return body.strip()
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in needed) + "\n" + body.strip()


LOAD_DATE = LOAD_TS[:10]

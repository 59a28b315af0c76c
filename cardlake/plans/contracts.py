"""Table contracts: columns in order, types, nullability, keys and partitions.

A contract is plain data. It gives the ``StructType`` to read or create a
table, the projection that brings a frame into shape, and the constraints the
check runner turns into aggregates.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names contracts may use, and the family each belongs to.
_SIMPLE_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "TEXT": T.StringType(),
    "CHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "BIGINT": T.LongType(),
    "LONG": T.LongType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "TINYINT": T.ByteType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "DATETIME": T.TimestampType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "REAL": T.FloatType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}
_FAMILIES = {
    "TEXT": "STRING",
    "CHAR": "STRING",
    "VARCHAR": "STRING",
    "LONG": "BIGINT",
    "INTEGER": "INT",
    "FLOAT": "DOUBLE",
    "BOOL": "BOOLEAN",
}
_SIZED = re.compile(r"^(DECIMAL|CHAR|VARCHAR)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)$")


def spark_type(name: str | None) -> T.DataType:
    """Spark type for a contract type name; an unknown name is an error."""
    text = (name or "STRING").strip().upper()
    if text in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[text]
    sized = _SIZED.match(text)
    if sized and sized[1] == "DECIMAL" and sized[3]:
        return T.DecimalType(int(sized[2]), int(sized[3]))
    if sized and sized[1] != "DECIMAL":
        return T.StringType()
    raise ValueError(f"unsupported contract type {name!r}")


def type_family(name: str | None) -> str:
    """Type name with aliases folded and precision left out, for comparing schemas."""
    if name is None:
        return "UNKNOWN"
    text = name.strip().upper()
    if text.startswith("DECIMAL"):
        return "DECIMAL"
    return _FAMILIES.get(text, text)


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class Contract:
    table: str
    columns: tuple[Column, ...]
    layer: str = ""
    entity: str = ""
    keys: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    partition_by: tuple[str, ...] = ()
    order_by: str | None = None
    max_partitions: int | None = 300
    status: str = "APPROVED"
    source: str = ""

    def __post_init__(self) -> None:
        if not self.columns:
            raise ValueError(f"contract {self.table} has no columns")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    @property
    def schema(self) -> T.StructType:
        """Schema for reading and creating; Parquet columns are always nullable."""
        return T.StructType([T.StructField(c.name, spark_type(c.type), True) for c in self.columns])


def contract(table: str, columns: str, *, technical: str = "", unique=None, **options) -> Contract:
    """Contract from one ``name TYPE [NOT NULL]`` line per column.

    ``unique`` may be one list of column names or a list of such lists.
    """
    parsed = []
    for line in (columns + "\n" + technical).splitlines():
        words = line.split(None, 1)
        if not words:
            continue
        kind = words[1].strip()
        nullable = not kind.upper().endswith("NOT NULL")
        kind = kind if nullable else kind[: -len("NOT NULL")].strip()
        spark_type(kind)
        parsed.append(Column(words[0], kind, nullable))
    if unique is None:
        unique = [options["keys"]] if options.get("keys") else []
    elif unique and isinstance(unique[0], str):
        unique = [unique]
    if not all(isinstance(u, (list, tuple)) and u for u in unique):
        raise ValueError(f"unique constraint of {table} must list column names")
    return Contract(table, tuple(parsed), unique=tuple(tuple(u) for u in unique), **options)


def project_to_contract(df: DataFrame, c: Contract) -> DataFrame:
    """The contract's columns, in order, cast to the contract's types."""
    return df.select(*[F.col(k.name).cast(spark_type(k.type)).alias(k.name) for k in c.columns])


def empty_table(spark, c: Contract) -> DataFrame:
    return spark.createDataFrame([], c.schema)


# --- fixed values: column lists ---------------------------------------------

BRONZE_TECHNICAL = """
    source_file STRING NOT NULL
    ingestion_date DATE NOT NULL
    ingestion_ts TIMESTAMP NOT NULL
    entity STRING NOT NULL
"""

_SILVER_TECHNICAL = """
    source_file STRING
    ingestion_date DATE NOT NULL
    ingestion_ts TIMESTAMP NOT NULL
    record_hash STRING NOT NULL
"""

_GOLD_TECHNICAL = """
    source_file STRING NOT NULL
    ingestion_date DATE NOT NULL
    ingestion_ts TIMESTAMP NOT NULL
    record_hash STRING NOT NULL
    gold_run_id STRING NOT NULL
    gold_load_ts TIMESTAMP NOT NULL
"""

SILVER_FX = contract(
    "silver_fx_rates",
    """
    base_currency STRING NOT NULL
    currency STRING NOT NULL
    currency_name STRING
    fx_date DATE NOT NULL
    fx_month DATE NOT NULL
    rate DECIMAL(18,8)
    """,
    technical=_SILVER_TECHNICAL,
    layer="SILVER",
    entity="FX",
    keys=("base_currency", "currency", "fx_date"),
    partition_by=("fx_month",),
    order_by="ingestion_ts",
)

SILVER_USERS = contract(
    "silver_users",
    """
    client_id BIGINT NOT NULL
    current_age INT
    retirement_age INT
    birth_year INT
    birth_month INT
    gender STRING
    address STRING
    latitude DECIMAL(9,6)
    longitude DECIMAL(9,6)
    per_capita_income DECIMAL(18,2)
    yearly_income DECIMAL(18,2)
    total_debt DECIMAL(18,2)
    credit_score INT
    num_credit_cards INT
    """,
    technical=_SILVER_TECHNICAL,
    layer="SILVER",
    entity="USER",
    keys=("client_id",),
    order_by="ingestion_ts",
)

SILVER_CARDS = contract(
    "silver_cards",
    """
    card_id BIGINT NOT NULL
    client_id BIGINT
    card_brand STRING
    card_type STRING
    card_number STRING
    expires_raw STRING
    expires_month DATE
    cvv STRING
    has_chip BOOLEAN
    num_cards_issued INT
    credit_limit DECIMAL(18,2)
    acct_open_date DATE
    year_pin_last_changed INT
    card_on_dark_web BOOLEAN
    """,
    technical=_SILVER_TECHNICAL,
    layer="SILVER",
    entity="CARD",
    keys=("card_id",),
    order_by="ingestion_ts",
)

SILVER_MCC = contract(
    "silver_mcc",
    """
    mcc_code STRING NOT NULL
    mcc_description STRING
    """,
    technical=_SILVER_TECHNICAL,
    layer="SILVER",
    entity="MCC",
    keys=("mcc_code",),
    order_by="ingestion_ts",
)

SILVER_TRANSACTIONS = contract(
    "silver_transactions",
    """
    transaction_id BIGINT NOT NULL
    txn_ts TIMESTAMP NOT NULL
    txn_date DATE NOT NULL
    txn_month DATE NOT NULL
    client_id BIGINT NOT NULL
    card_id BIGINT NOT NULL
    merchant_id BIGINT NOT NULL
    mcc_code STRING NOT NULL
    amount DECIMAL(18,2) NOT NULL
    use_chip STRING
    merchant_city STRING
    merchant_state STRING
    zip STRING
    error_code INT NOT NULL
    is_success BOOLEAN NOT NULL
    """,
    technical=_SILVER_TECHNICAL,
    layer="SILVER",
    entity="TRANSACTION",
    keys=("transaction_id",),
    partition_by=("txn_month",),
    order_by="ingestion_ts",
)


def _gold_of(silver: Contract, table: str, extra: str = "") -> Contract:
    """Gold dimension or fact: the silver columns, what gold derives, audit columns."""
    business = silver.columns[: -len(_SILVER_TECHNICAL.split("\n")[1:-1])]
    audit = contract("_", extra + _GOLD_TECHNICAL).columns
    return replace(silver, table=table, layer="GOLD", columns=business + audit)


GOLD_DIM_USER = _gold_of(SILVER_USERS, "gold_dim_user")
GOLD_DIM_CARD = _gold_of(SILVER_CARDS, "gold_dim_card")
GOLD_DIM_MCC = _gold_of(SILVER_MCC, "gold_dim_mcc")

GOLD_FACT = replace(
    _gold_of(SILVER_TRANSACTIONS, "gold_fact_transactions"),
    columns=contract(
        "_",
        """
        transaction_id BIGINT NOT NULL
        txn_ts TIMESTAMP NOT NULL
        txn_date DATE NOT NULL
        txn_month DATE NOT NULL
        client_id BIGINT NOT NULL
        card_id BIGINT NOT NULL
        merchant_id BIGINT NOT NULL
        mcc_code STRING NOT NULL
        amount DECIMAL(18,2) NOT NULL
        use_chip STRING
        merchant_city STRING
        merchant_state STRING
        zip STRING
        error_code INT NOT NULL
        is_success BOOLEAN NOT NULL
        is_chip_used BOOLEAN
        record_hash STRING NOT NULL
        source_file STRING NOT NULL
        ingestion_date DATE NOT NULL
        ingestion_ts TIMESTAMP NOT NULL
        gold_run_id STRING NOT NULL
        gold_load_ts TIMESTAMP NOT NULL
        """,
    ).columns,
)

GOLD_DIM_DATE = contract(
    "gold_dim_date",
    """
    date_id INT NOT NULL
    date_value DATE NOT NULL
    day_of_month INT
    day_of_week_iso INT
    day_name STRING
    week_of_year INT
    month_number INT
    month_name STRING
    quarter_number INT
    year_number INT
    is_weekend BOOLEAN
    gold_run_id STRING NOT NULL
    gold_load_ts TIMESTAMP NOT NULL
    """,
    layer="GOLD",
    entity="DATE",
    keys=("date_id",),
    unique=[["date_id"], ["date_value"]],
)

ANOMALY_EVENT = contract(
    "gold_anomaly_event",
    """
    gold_run_id STRING NOT NULL
    event_ts TIMESTAMP NOT NULL
    entity STRING NOT NULL
    anom_domain STRING NOT NULL
    anom_type STRING NOT NULL
    severity STRING NOT NULL
    rule_id STRING NOT NULL
    key_hash STRING NOT NULL
    natural_keys STRING NOT NULL
    source_table STRING NOT NULL
    detail STRING
    gold_load_ts TIMESTAMP NOT NULL
    """,
    layer="GOLD",
)

ANOMALY_KPI = contract(
    "gold_anomaly_kpi",
    """
    gold_run_id STRING NOT NULL
    kpi_ts TIMESTAMP NOT NULL
    entity STRING NOT NULL
    anom_domain STRING NOT NULL
    anom_type STRING NOT NULL
    severity STRING NOT NULL
    rule_id STRING NOT NULL
    row_count BIGINT NOT NULL
    sample_keys STRING
    gold_load_ts TIMESTAMP NOT NULL
    """,
    layer="GOLD",
)

WH_DIM_CARD = contract(
    "dim_card",
    """
    card_key BIGINT NOT NULL
    card_id VARCHAR(64) NOT NULL
    client_id VARCHAR(64)
    card_brand VARCHAR(50)
    card_type VARCHAR(50)
    has_chip BOOLEAN
    credit_limit DECIMAL(18,2)
    num_cards_issued INT
    card_on_dark_web BOOLEAN
    record_hash VARCHAR(64)
    """,
    layer="WAREHOUSE",
    keys=("card_id",),
)

WH_DIM_USER = contract(
    "dim_user",
    """
    user_key BIGINT NOT NULL
    client_id VARCHAR(64) NOT NULL
    current_age INT
    yearly_income DECIMAL(18,2)
    total_debt DECIMAL(18,2)
    credit_score INT
    address VARCHAR(500)
    record_hash VARCHAR(64)
    """,
    layer="WAREHOUSE",
    keys=("client_id",),
)

WH_DIM_MCC = contract(
    "dim_mcc",
    """
    mcc_key BIGINT NOT NULL
    mcc_code INT NOT NULL
    mcc_description VARCHAR(200)
    mcc_category VARCHAR(100)
    record_hash VARCHAR(64)
    """,
    layer="WAREHOUSE",
    keys=("mcc_code",),
)

WH_DIM_DATE = contract(
    "dim_date",
    """
    date_key BIGINT NOT NULL
    date_id INT NOT NULL
    full_date DATE NOT NULL
    year INT
    quarter INT
    month INT
    week INT
    day_of_week INT
    is_weekend BOOLEAN
    is_business_day BOOLEAN
    record_hash VARCHAR(64)
    """,
    layer="WAREHOUSE",
    keys=("date_id",),
)

WH_DIM_MONTH = contract(
    "dim_month",
    """
    month_start DATE NOT NULL
    year INT NOT NULL
    month INT NOT NULL
    yyyymm INT NOT NULL
    month_label VARCHAR(7) NOT NULL
    """,
    layer="WAREHOUSE",
    keys=("month_start",),
)

WH_FACT = contract(
    "fact_transactions",
    """
    transaction_id VARCHAR(64) NOT NULL
    date_key BIGINT NOT NULL
    user_key BIGINT NOT NULL
    card_key BIGINT NOT NULL
    mcc_key BIGINT NOT NULL
    txn_date DATE NOT NULL
    txn_month DATE NOT NULL
    amount DECIMAL(18,2)
    currency VARCHAR(10)
    is_success BOOLEAN
    error_code VARCHAR(50)
    is_chip_used BOOLEAN
    merchant_id BIGINT
    merchant_name VARCHAR(200)
    merchant_city VARCHAR(100)
    merchant_state VARCHAR(50)
    merchant_zip VARCHAR(20)
    record_hash VARCHAR(64) NOT NULL
    gold_load_ts TIMESTAMP
    """,
    layer="WAREHOUSE",
    keys=("transaction_id",),
    partition_by=("txn_month",),
)

_AGGREGATE_MEASURES = """
    txn_count_total BIGINT NOT NULL
    txn_count_success BIGINT NOT NULL
    txn_count_failed BIGINT NOT NULL
    txn_count_unknown BIGINT NOT NULL
    amount_sum_total DECIMAL(18,2) NOT NULL
    amount_sum_success DECIMAL(18,2) NOT NULL
    amount_sum_failed DECIMAL(18,2) NOT NULL
    amount_sum_unknown DECIMAL(18,2) NOT NULL
    amount_abs_sum_total DECIMAL(18,2) NOT NULL
    amount_avg_success DECIMAL(18,2)
    amount_min DECIMAL(18,2)
    amount_max DECIMAL(18,2)
    txn_count_chip_used BIGINT NOT NULL
    amount_sum_chip_used DECIMAL(18,2) NOT NULL
    gold_load_ts_max TIMESTAMP
    aggregate_hash VARCHAR(64) NOT NULL
    run_id_last VARCHAR(64)
"""

WH_FACT_DAILY = contract(
    "fact_transactions_daily",
    """
    date_key BIGINT NOT NULL
    user_key BIGINT NOT NULL
    card_key BIGINT NOT NULL
    mcc_key BIGINT NOT NULL
    currency VARCHAR(10) NOT NULL
    txn_date DATE NOT NULL
    txn_month DATE NOT NULL
    """,
    technical=_AGGREGATE_MEASURES,
    layer="WAREHOUSE",
    keys=("date_key", "user_key", "card_key", "mcc_key", "currency"),
    partition_by=("txn_month",),
)

WH_FACT_MONTHLY = contract(
    "fact_transactions_monthly",
    """
    txn_month DATE NOT NULL
    user_key BIGINT NOT NULL
    card_key BIGINT NOT NULL
    mcc_key BIGINT NOT NULL
    currency VARCHAR(10) NOT NULL
    """,
    technical=_AGGREGATE_MEASURES,
    layer="WAREHOUSE",
    keys=("txn_month", "user_key", "card_key", "mcc_key", "currency"),
    partition_by=("txn_month",),
)

WH_CTL_JOB = contract(
    "wh_ctl_job",
    """
    job_group VARCHAR(50) NOT NULL
    job_order INT NOT NULL
    job_code VARCHAR(100) NOT NULL
    sp_schema VARCHAR(50) NOT NULL
    sp_name VARCHAR(128) NOT NULL
    enabled BOOLEAN NOT NULL
    is_critical BOOLEAN NOT NULL
    needs_txn_month BOOLEAN NOT NULL
    needs_exec_date BOOLEAN NOT NULL
    notes VARCHAR(500)
    """,
    layer="WAREHOUSE",
)

WH_DQ_RESULT = contract(
    "wh_dq_check_result",
    """
    run_id VARCHAR(64) NOT NULL
    check_code VARCHAR(100) NOT NULL
    exec_ts TIMESTAMP NOT NULL
    exec_date DATE
    txn_month DATE
    status VARCHAR(16) NOT NULL
    issue_count BIGINT
    message VARCHAR(2000)
    """,
    layer="WAREHOUSE",
)

WH_JOB_LOG = contract(
    "wh_job_run_log",
    """
    run_id VARCHAR(64) NOT NULL
    job_id VARCHAR(128) NOT NULL
    exec_ts_start TIMESTAMP NOT NULL
    exec_ts_end TIMESTAMP
    exec_date DATE
    txn_month DATE
    status VARCHAR(16) NOT NULL
    rows_inserted BIGINT
    rows_updated BIGINT
    rows_deleted BIGINT
    rows_source BIGINT
    message VARCHAR(2000)
    """,
    layer="WAREHOUSE",
)

WH_RUN = contract(
    "wh_run",
    """
    run_id VARCHAR(64) NOT NULL
    exec_date DATE
    exec_ts_start TIMESTAMP
    exec_ts_end TIMESTAMP
    txn_month DATE
    run_status VARCHAR(16) NOT NULL
    duration_sec BIGINT
    jobs_total INT
    jobs_failed INT
    jobs_success INT
    jobs_started INT
    critical_failed INT
    rows_source BIGINT
    rows_inserted BIGINT
    rows_updated BIGINT
    rows_deleted BIGINT
    dq_status VARCHAR(16)
    dq_fail_count INT
    dq_issue_count BIGINT
    last_message VARCHAR(2000)
    """,
    layer="WAREHOUSE",
    keys=("run_id",),
)

_CTRL_METRIC = """
    check_ts TIMESTAMP NOT NULL
    txn_month DATE NOT NULL
    metric_name VARCHAR(128) NOT NULL
    metric_value BIGINT NOT NULL
    status VARCHAR(16) NOT NULL
    details VARCHAR(2000)
"""
CTRL_CONFORMANCE = contract("ctrl_conformance", _CTRL_METRIC, layer="WAREHOUSE")
CTRL_DUPLICATES = contract("ctrl_duplicates", _CTRL_METRIC, layer="WAREHOUSE")
CTRL_RECONCILIATION = contract(
    "ctrl_reconciliation",
    """
    check_ts TIMESTAMP NOT NULL
    txn_month DATE NOT NULL
    metric_name VARCHAR(128) NOT NULL
    gold_value DECIMAL(38,6)
    wh_value DECIMAL(38,6)
    delta_value DECIMAL(38,6)
    tolerance_abs DECIMAL(38,6)
    status VARCHAR(16) NOT NULL
    details VARCHAR(2000)
    """,
    layer="WAREHOUSE",
)
CTRL_PUBLISH = contract(
    "ctrl_publish_status",
    """
    publish_ts TIMESTAMP NOT NULL
    txn_month DATE NOT NULL
    status VARCHAR(16) NOT NULL
    reason VARCHAR(2000)
    """,
    layer="WAREHOUSE",
)

SILVER_STEP_LOG = contract(
    "silver_log_steps",
    """
    run_id STRING
    entity_code STRING
    notebook_name STRING
    start_ts TIMESTAMP
    end_ts TIMESTAMP
    status STRING
    row_in BIGINT
    row_out BIGINT
    partition_count INT
    dedup_dropped BIGINT
    error_message STRING
    payload_json STRING
    """,
)
GOLD_STEP_LOG = contract(
    "gold_log_steps",
    """
    gold_run_id STRING
    step_seq INT
    entity_code STRING
    notebook_name STRING
    start_ts TIMESTAMP
    end_ts TIMESTAMP
    duration_ms BIGINT
    status STRING
    critical BOOLEAN
    row_in BIGINT
    row_out BIGINT
    row_rejected BIGINT
    partition_count INT
    dedup_dropped BIGINT
    anom_count BIGINT
    error_message STRING
    payload_json STRING
    """,
)
GOLD_RUN_LOG = contract(
    "gold_log_runs",
    """
    gold_run_id STRING
    pipeline_name STRING
    layer STRING
    start_ts TIMESTAMP
    end_ts TIMESTAMP
    duration_ms BIGINT
    status STRING
    triggered_by STRING
    environment STRING
    params_json STRING
    error_message STRING
    """,
)

INGESTION_MANIFEST = contract(
    "tech_ingestion_manifest",
    """
    entity STRING NOT NULL
    file_path STRING NOT NULL
    source_name STRING
    file_size BIGINT
    modified_datetime TIMESTAMP
    first_ingested_datetime TIMESTAMP
    last_ingested_datetime TIMESTAMP
    last_status STRING
    exec_date DATE
    ingestion_mode STRING
    total_source_files INT
    total_candidate_files INT
    """,
    keys=("entity", "file_path"),
)
INGESTION_LOG = contract(
    "tech_ingestion_log",
    """
    exec_date DATE NOT NULL
    entity STRING NOT NULL
    ingestion_mode STRING
    total_source_files INT
    total_candidate_files INT
    processed_files INT
    failed_files INT
    status STRING
    log_timestamp TIMESTAMP
    """,
)
SCHEMA_COMPLIANCE = contract(
    "tech_schema_compliance",
    """
    run_ts_utc STRING NOT NULL
    layer STRING NOT NULL
    entity STRING NOT NULL
    table_name STRING NOT NULL
    registry_path STRING NOT NULL
    registry_status STRING
    compliance_status STRING NOT NULL
    missing_columns STRING
    extra_columns STRING
    type_mismatches STRING
    order_mismatch STRING
    order_details STRING
    """,
)

SILVER_CONTRACTS = {
    c.table: c for c in (SILVER_MCC, SILVER_USERS, SILVER_CARDS, SILVER_FX, SILVER_TRANSACTIONS)
}
GOLD_CONTRACTS = {
    c.table: c for c in (GOLD_DIM_DATE, GOLD_DIM_MCC, GOLD_DIM_USER, GOLD_DIM_CARD, GOLD_FACT)
}
WAREHOUSE_CONTRACTS = {
    c.table: c
    for c in (
        WH_DIM_DATE,
        WH_DIM_MONTH,
        WH_DIM_USER,
        WH_DIM_CARD,
        WH_DIM_MCC,
        WH_FACT,
        WH_FACT_DAILY,
        WH_FACT_MONTHLY,
    )
}

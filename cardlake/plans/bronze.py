"""Bronze: landing text to typed columns, one declarative spec per entity.

A spec maps each output column to the function that reads it from the source
column of the same name, or to ``(source column, function)``. One ``select``
applies it, so any number of files of an entity load in a single narrow job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions import columns as C
from cardlake.functions.naming import column_name
from cardlake.plans.contracts import BRONZE_TECHNICAL, Contract, contract

Reader = Callable[[Column], Column]


def _text(c: Column) -> Column:
    return c.cast("string")


def _trimmed(c: Column) -> Column:
    return F.trim(c.cast("string"))


def _day(c: Column) -> Column:
    return F.try_to_date(c.cast("string"))


def _iso_day(c: Column) -> Column:
    return F.try_to_date(c.cast("string"), "yyyy-MM-dd")


def _instant(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def _money(c: Column) -> Column:
    return C.money(c)


def _signed_money(c: Column) -> Column:
    return C.money(c, signed=True)


_INT, _LONG, _DOUBLE, _UPPER = C.to_int, C.to_long, C.to_double, C.clean_text

# The measures of a company's financial statement, in table order.
FUNDAMENTAL_MEASURES = """
    accounts_payable
    accounts_receivable
    add_l_income_expense_items
    after_tax_roe
    capital_expenditures
    capital_surplus
    cash_ratio
    cash_and_cash_equivalents
    changes_in_inventories
    common_stocks
    cost_of_revenue
    current_ratio
    deferred_asset_charges
    deferred_liability_charges
    depreciation
    earnings_before_interest_and_tax
    earnings_before_tax
    effect_of_exchange_rate
    equity_earnings_loss_unconsolidated_subsidiary
    fixed_assets
    goodwill
    gross_margin
    gross_profit
    income_tax
    intangible_assets
    interest_expense
    inventory
    investments
    liabilities
    long_term_debt
    long_term_investments
    minority_interest
    misc_stocks
    net_borrowings
    net_cash_flow
    net_cash_flow_operating
    net_cash_flows_financing
    net_cash_flows_investing
    net_income
    net_income_adjustments
    net_income_applicable_to_common_shareholders
    net_income_cont_operations
    net_receivables
    non_recurring_items
    operating_income
    operating_margin
    other_assets
    other_current_assets
    other_current_liabilities
    other_equity
    other_financing_activities
    other_investing_activities
    other_liabilities
    other_operating_activities
    other_operating_items
    pre_tax_margin
    pre_tax_roe
    profit_margin
    quick_ratio
    research_and_development
    retained_earnings
    sale_and_purchase_of_stock
    sales_general_and_admin
    short_term_debt_current_portion_of_long_term_debt
    short_term_investments
    total_assets
    total_current_assets
    total_current_liabilities
    total_equity
    total_liabilities
    total_liabilities_and_equity
    total_revenue
    treasury_stock
    for_year
    earnings_per_share
    estimated_shares_outstanding
""".split()

_FX = {
    "currency": lambda c: F.upper(c),
    "base_currency": _text,
    "currency_name": _text,
    "rate_vs_usd": ("exchange_rate", _DOUBLE),
    "date": _day,
}
_CUSTOMER = {
    "row_number": _INT,
    "customer_id": _LONG,
    "surname": _UPPER,
    "credit_score": _INT,
    "geography": _UPPER,
    "gender": _UPPER,
    "age": _INT,
    "tenure": _INT,
    "balance": _DOUBLE,
    "num_of_products": _INT,
    "has_cr_card": _INT,
    "is_active_member": _INT,
    "estimated_salary": _DOUBLE,
    "exited": _INT,
}
_SECURITIES = {
    "ticker_symbol": lambda c: F.upper(c),
    "security": _text,
    "sec_filings": _text,
    "gics_sector": _text,
    "gics_sub_industry": _text,
    "address_of_headquarters": _text,
    "date_first_added": _day,
    "cik": _text,
}
_FUNDAMENTALS = {
    "unnamed_0": _LONG,
    "ticker_symbol": _text,
    "period_ending": _day,
    **{name: _DOUBLE for name in FUNDAMENTAL_MEASURES},
}
_PRICES = {
    "date": _instant,
    "symbol": _text,
    "open": _DOUBLE,
    "close": _DOUBLE,
    "low": _DOUBLE,
    "high": _DOUBLE,
    "volume": _DOUBLE,
}
_OHLCV = {
    "ticker": _UPPER,
    "date": _iso_day,
    "open": _DOUBLE,
    "high": _DOUBLE,
    "low": _DOUBLE,
    "close": _DOUBLE,
    "volume": _LONG,
    "open_int": _LONG,
}
_CARD = {
    "id": _LONG,
    "client_id": _LONG,
    "card_brand": _UPPER,
    "card_type": _UPPER,
    "card_number": _text,
    "expires": _text,
    "cvv": _text,
    "has_chip": _UPPER,
    "num_cards_issued": _INT,
    "credit_limit": _money,
    "acct_open_date": _text,
    "year_pin_last_changed": _INT,
    "card_on_dark_web": _UPPER,
}
_USER = {
    "id": _LONG,
    "current_age": _INT,
    "retirement_age": _INT,
    "birth_year": _INT,
    "birth_month": _INT,
    "gender": _UPPER,
    "address": _trimmed,
    "latitude": _DOUBLE,
    "longitude": _DOUBLE,
    "per_capita_income": _money,
    "yearly_income": _money,
    "total_debt": _money,
    "credit_score": _INT,
    "num_credit_cards": _INT,
}
_TRANSACTION = {
    "id": _LONG,
    "date": _instant,
    "client_id": _LONG,
    "card_id": _LONG,
    "amount": _signed_money,
    "use_chip": _UPPER,
    "merchant_id": _LONG,
    "merchant_city": _UPPER,
    "merchant_state": _UPPER,
    "zip": _trimmed,
    "mcc": _INT,
    "errors": _INT,
}
_MCC = {"mcc": _INT, "mcc_description": _trimmed}

_TYPE_OF = {
    _INT: "INT",
    _LONG: "BIGINT",
    _DOUBLE: "DOUBLE",
    _money: "DOUBLE",
    _signed_money: "DOUBLE",
    _day: "DATE",
    _iso_day: "DATE",
    _instant: "TIMESTAMP",
}


@dataclass(frozen=True)
class Entity:
    name: str
    table: str
    spec: dict
    keys: tuple[str, ...]

    def reader(self, column: str) -> tuple[str, Reader]:
        entry = self.spec[column]
        return entry if isinstance(entry, tuple) else (column, entry)

    @property
    def contract(self) -> Contract:
        lines = [f"{name} {_TYPE_OF.get(self.reader(name)[1], 'STRING')}" for name in self.spec]
        return contract(
            self.table,
            "\n".join(lines),
            technical=BRONZE_TECHNICAL,
            layer="BRONZE",
            entity=self.name,
            keys=self.keys,
            unique=[],
            partition_by=("ingestion_date",),
        )

    @property
    def landing_schema(self) -> T.StructType:
        """All columns as text: no inference pass, and the same types for every file."""
        return T.StructType([T.StructField(self.reader(n)[0], T.StringType()) for n in self.spec])


ENTITIES = {
    e.name: e
    for e in (
        Entity("FX", "bronze_fx_raw", _FX, ("currency", "date")),
        Entity("CUSTOMER", "bronze_customers_raw", _CUSTOMER, ("customer_id",)),
        Entity("SECURITIES", "bronze_securities_raw", _SECURITIES, ("ticker_symbol",)),
        Entity("FUNDAMENTALS", "bronze_fundamentals_raw", _FUNDAMENTALS, ("ticker_symbol", "period_ending")),
        Entity("STOCK", "bronze_stock_raw", _OHLCV, ("ticker", "date")),
        Entity("ETF", "bronze_etf_raw", _OHLCV, ("ticker", "date")),
        Entity("PRICES", "bronze_prices_raw", _PRICES, ("symbol", "date")),
        Entity("PRICES_SPLIT_ADJUSTED", "bronze_prices_split_adjusted_raw", _PRICES, ("symbol", "date")),
        Entity("CARD", "bronze_card_raw", _CARD, ("id",)),
        Entity("USER", "bronze_user_raw", _USER, ("id",)),
        Entity("MCC", "bronze_mcc_raw", _MCC, ("mcc",)),
        Entity("TRANSACTION", "bronze_transactions_raw", _TRANSACTION, ("id",)),
    )
}


def bronze_table(entity: str) -> str:
    """Target table; an entity without a spec has one of its own."""
    name = entity.strip().upper()
    return ENTITIES[name].table if name in ENTITIES else f"bronze_{name.lower()}_raw"


def apply_spec(df: DataFrame, spec: dict) -> DataFrame:
    exprs = []
    for name, entry in spec.items():
        source, read = entry if isinstance(entry, tuple) else (name, entry)
        exprs.append(read(F.col(source)).alias(name))
    return df.select(*exprs)


def add_ingest_columns(
    df: DataFrame, exec_date: str, entity: str, now: Column | None = None
) -> DataFrame:
    """Run date, load time and entity of a frame that already names its file."""
    return df.withColumns(
        {
            "ingestion_date": F.try_to_date(F.lit(exec_date), "yyyy-MM-dd"),
            "ingestion_ts": F.current_timestamp() if now is None else now,
            "entity": F.lit(entity.strip().upper()),
        }
    )


#: Partition column of stored bronze tables: the load that wrote a row. No business column.
BATCH = "ingestion_batch"


def to_bronze(
    raw: DataFrame,
    entity: str,
    exec_date: str,
    now: Column | None = None,
    source_file: Column | None = None,
) -> DataFrame:
    """Landing rows of one entity as bronze rows.

    The file path of each row comes from the scan, so one read may span many
    files; ``source_file`` replaces it for frames that are not file scans.
    Columns named ``__...`` may feed it and are not loaded. An entity without a
    spec passes through with its columns untouched.
    """
    name = entity.strip().upper()
    path = F.col("_metadata.file_path") if source_file is None else source_file
    fields = [c for c in raw.columns if not c.startswith("__")]
    if name in ENTITIES:
        named = raw.select(
            *[F.col(f"`{c}`").alias(column_name(c)) for c in fields], path.alias("source_file")
        )
        core = apply_spec(named, {**ENTITIES[name].spec, "source_file": _text})
    else:
        core = raw.select(*[F.col(f"`{c}`") for c in fields], path.alias("source_file"))
    return add_ingest_columns(core, exec_date, name, now)


def pairs_from_object(df: DataFrame, value: str, key_name: str, value_name: str) -> DataFrame:
    """One row per key of a flat JSON object held as text."""
    entries = F.from_json(F.col(value), "map<string,string>")
    others = [c for c in df.columns if c != value]
    return df.select(*others, F.explode(entries).alias(key_name, value_name))

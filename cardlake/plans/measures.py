"""Business measures over the star, under any grouping.

A measure in a report is an aggregate within a filter context. Here the filter
context is the frame passed in and the slicers are ``by``; ``mode`` adds the
subtotals of a rollup or a cube.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions import columns as C

DIM_KEYS = {"dim_card": "card_key", "dim_mcc": "mcc_key", "dim_user": "user_key", "dim_date": "date_key"}


def dim_of(attribute: str, dims: dict[str, DataFrame]) -> str:
    for name in DIM_KEYS:
        if name in dims and attribute in dims[name].columns:
            return name
    raise ValueError(f"no dimension has {attribute!r}")


def star(fact: DataFrame, dims: dict[str, DataFrame], attributes: Sequence[str]) -> DataFrame:
    """Fact with the given attributes; only the dimensions they need are joined,
    and of those only the columns asked for."""
    wanted: dict[str, list[str]] = {}
    for a in attributes:
        if a not in fact.columns:
            wanted.setdefault(dim_of(a, dims), []).append(a)
    for name, columns in wanted.items():
        fact = fact.join(dims[name].select(DIM_KEYS[name], *columns), DIM_KEYS[name])
    return fact


def _grouped(df: DataFrame, by: Sequence[str], mode: str):
    if mode not in ("group", "rollup", "cube"):
        raise ValueError(f"mode must be group, rollup or cube, not {mode!r}")
    if not by or mode == "group":
        return df.groupBy(*by)
    return df.rollup(*by) if mode == "rollup" else df.cube(*by)


def _amount(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("decimal(18,2)")


def base_measures() -> dict[str, Column]:
    """Additive parts: each can be merged again by ``_MERGE``."""
    ok, chip, amount = F.col("is_success"), F.col("is_chip_used"), F.col("amount")
    return {
        "amount_abs_sum_total": F.sum(F.abs(amount)),
        "amount_max": F.max(amount),
        "amount_min": F.min(amount),
        "amount_sum_failed": F.sum(F.when(~ok, amount)),
        "amount_sum_success": F.sum(F.when(ok, amount)),
        "amount_sum_total": F.sum(amount),
        "txn_count_failed": F.count_if(~ok),
        "txn_count_success": F.count_if(ok),
        "txn_count_total": F.count(F.lit(1)),
        "txn_count_chip_used": F.count_if(chip),
        "txn_count_chip_not_used": F.count_if(~chip),
        "last_txn_date": F.max("txn_date"),
    }


_MERGE = {"amount_max": F.max, "amount_min": F.min, "last_txn_date": F.max}
_DISTINCT = {
    "card_count_distinct": "card_key",
    "user_count_distinct": "user_key",
    "merchant_count_distinct": "merchant_id",
}


def _fact_keys(fact: DataFrame, dims: dict[str, DataFrame], by: Sequence[str]) -> list[str]:
    """Columns of the fact that determine ``by``."""
    return list(dict.fromkeys(b if b in fact.columns else DIM_KEYS[dim_of(b, dims)] for b in by))


def _level(by: Sequence[str], mode: str, name: str = "level") -> list[Column]:
    return [F.grouping_id().alias(name)] if by and mode != "group" else []


def _totals(fact: DataFrame, dims: dict[str, DataFrame], by: list[str], mode: str, extra) -> DataFrame:
    """Base measures: summed per surrogate key, then joined, then merged.

    The join and the subtotals see one row per key and not per transaction.
    """
    base = base_measures()
    partial = fact.groupBy(*_fact_keys(fact, dims, by)).agg(*[c.alias(n) for n, c in base.items()])
    merged = [_MERGE.get(n, F.sum)(n).alias(n) for n in base]
    totals = _grouped(star(partial, dims, by), by, mode).agg(*merged, *_level(by, mode), *extra)
    money = {
        n: F.coalesce(n, F.lit(0)).cast("decimal(18,2)") for n in base if n.startswith("amount_")
    }
    counts = {n: F.coalesce(n, F.lit(0)) for n in base if n.startswith("txn_count_")}
    return totals.withColumns({**money, **counts})


def _groups(by: list[str], mode: str) -> list[list[str]]:
    """The groupings of a mode, each a list of attributes."""
    if mode == "rollup":
        return [by[:n] for n in range(len(by), -1, -1)]
    if mode == "cube":
        return [[b for i, b in enumerate(by) if not n >> (len(by) - 1 - i) & 1] for n in range(1 << len(by))]
    return [by]


def _distinct_counts(fact: DataFrame, dims: dict[str, DataFrame], by: list[str], mode: str) -> DataFrame:
    """All distinct members per group, from one scan of the fact.

    Each row gives a pair (kind, member) for each kind of member, the kind as a
    small number and members that all are whole numbers as such. Tasks reduce
    their rows to the distinct (attributes, pair), so what is shuffled and what
    the subtotals multiply are few pairs and not transactions. Keys with the
    same attributes meet in the count, which needs no distinct pairs before it.
    """
    whole = all(isinstance(fact.schema[c].dataType, T.IntegralType) for c in _DISTINCT.values())
    pairs = [F.struct(F.lit(i).alias("kind"), F.col(c).cast("bigint" if whole else "string").alias("member")) for i, c in enumerate(_DISTINCT.values())]
    keys = _fact_keys(fact, dims, by)
    rows = fact.select(*keys, F.inline(F.array(*pairs))).where("member is not null").distinct()
    pairs = star(rows, dims, by).select(*by, "kind", "member")
    sets = [[*g, "kind"] for g in _groups(by, mode)]
    # ``kind`` is in every grouping: the grouping id without its last bit is that of the attributes.
    level = [F.shiftright(F.grouping_id(), 1).alias("__level")] if by and mode != "group" else []
    counted = pairs.groupingSets(sets, *by, "kind").agg(F.countDistinct("member").alias("n"), *level)
    names = [*by, *["__level"] * len(level)]
    return counted.groupBy(*names).agg(*[F.coalesce(F.max(F.when(F.col("kind") == i, F.col("n"))), F.lit(0)).alias(k) for i, k in enumerate(_DISTINCT)])


# --- sketches ---------------------------------------------------------------

#: Registers of a sketch as a power of two; the relative standard error is 1.04 over their number's root.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / (1 << SKETCH_BITS) ** 0.5


def distinct_sketches(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with a sketch of the distinct members of each kind.

    Stored beside a daily or monthly aggregate, sketches answer distinct counts
    under any coarser grouping without the fact.
    """
    return fact.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS)).alias(f"{n}_sketch") for n, c in _DISTINCT.items()])


def counts_from_sketches(sketches: DataFrame, dims: dict[str, DataFrame], by: Sequence[str] = (), mode: str = "group") -> DataFrame:
    """Estimated distinct members per group, by union of stored sketches."""
    by = list(by)
    level = _level(by, mode, "__level")
    merged = [F.round(F.hll_sketch_estimate(F.hll_union_agg(f"{n}_sketch"))).cast("long").alias(n) for n in _DISTINCT]
    return _grouped(star(sketches, dims, by), by, mode).agg(*merged, *level)


def ratio_measures() -> dict[str, Column]:
    total = F.col("txn_count_total")
    return {
        "chip_adoption_rate": C.safe_divide(F.col("txn_count_chip_used"), total),
        "failure_rate": C.safe_divide(F.col("txn_count_failed"), total),
        "success_rate": C.safe_divide(F.col("txn_count_success"), total),
        "avg_ticket_success": C.safe_divide(F.col("amount_sum_success"), F.col("txn_count_success")),
    }


def business_measures(
    fact: DataFrame,
    dims: dict[str, DataFrame],
    by: Sequence[str] = (),
    mode: str = "group",
    approximate: bool = False,
) -> DataFrame:
    """Every business measure per ``by``; with rollup or cube also ``level``,
    the grouping id that tells subtotals from NULL attributes.

    The fact is scanned twice: for what adds up, and for distinct members. With
    ``approximate`` these are estimated from sketches.

    Dark-web cards are counted on the card dimension: only card attributes
    among ``by`` limit them, neither facts nor dates do.
    """
    by = list(by)
    card_by = [b for b in by if b not in fact.columns and dim_of(b, dims) == "dim_card"]
    flags = [F.grouping(b).alias(f"__g_{b}") for b in card_by] if mode != "group" else []
    measured = _totals(fact, dims, by, mode, flags)
    if approximate:
        counted = counts_from_sketches(distinct_sketches(fact, _fact_keys(fact, dims, by)), dims, by, mode)
    else:
        counted = _distinct_counts(fact, dims, by, mode)
    if by:
        counted = counted.withColumnsRenamed({b: f"__c_{b}" for b in by})
        match = [F.col(b).eqNullSafe(F.col(f"__c_{b}")) for b in by]
        if mode != "group":
            match.append(F.col("level") == F.col("__level"))
        measured = measured.join(counted, C.all_of(match), "left")
    else:
        measured = measured.withColumn("__c", counted.select(F.struct(*_DISTINCT)).scalar())
        measured = measured.withColumns({name: F.col(f"__c.{name}") for name in _DISTINCT})
    measured = measured.withColumns({name: F.coalesce(name, F.lit(0)) for name in _DISTINCT})
    flagged = dims["dim_card"].where(F.col("card_on_dark_web"))
    if card_by:
        inner = [F.grouping(b).alias(f"__d_g_{b}") for b in card_by] if flags else []
        dark = _grouped(flagged, card_by, "cube" if flags else "group").agg(
            F.count(F.lit(1)).alias("darkweb_cards"), *inner
        )
        dark = dark.withColumnsRenamed({b: f"__d_{b}" for b in card_by})
        match = [F.col(b).eqNullSafe(F.col(f"__d_{b}")) for b in card_by]
        match += [F.col(f"__g_{b}") == F.col(f"__d_g_{b}") for b in card_by] if flags else []
        measured = measured.join(dark, C.all_of(match), "left")
        dark_count = F.coalesce("darkweb_cards", F.lit(0))
    else:
        dark_count = flagged.agg(F.count(F.lit(1))).scalar()
    level = ["level"] if by and mode != "group" else []
    measured = measured.select(
        *by, *level, *base_measures(), *_DISTINCT, dark_count.alias("darkweb_cards")
    )
    return measured.withColumns(
        {
            **ratio_measures(),
            "darkweb_card_rate": C.safe_divide(F.col("darkweb_cards"), F.col("card_count_distinct")),
        }
    )


def overview(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return business_measures(fact, dims)


def month_label(year: int | None = None, month: int | None = None) -> Column:
    """``Jan 2001`` for one selected month, ``All months`` otherwise."""
    if year is None or month is None:
        return F.lit("All months")
    return F.date_format(F.lit(date(year, month, 1)), "MMM yyyy")


def spend_by(fact: DataFrame, dims: dict[str, DataFrame], by: Sequence[str]) -> DataFrame:
    """Spend, transactions and failures per dimension attributes.

    The fact is summed per surrogate key first, so the dimension joins one row
    per key and the attribute is carried by sums, not by transactions.
    """
    name = dim_of(by[0], dims)
    key = DIM_KEYS[name]
    per_key = fact.groupBy(key).agg(
        F.sum("amount").alias("spend"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("is_success")).alias("failed"),
    )
    joined = per_key.join(dims[name].select(key, *by), key)
    return joined.groupBy(*by).agg(
        F.coalesce(F.sum("spend"), F.lit(0)).cast("decimal(18,2)").alias("amount_sum_total"),
        F.sum("n").alias("txn_count_total"),
        F.sum("failed").alias("txn_count_failed"),
    )


def topn(
    fact: DataFrame,
    dims: dict[str, DataFrame],
    by: Sequence[str],
    n: int,
    measure: str = "amount_sum_total",
) -> DataFrame:
    """The ``n`` best groups by a measure of ``spend_by``; ties by attribute."""
    return spend_by(fact, dims, by).orderBy(F.desc(measure), *by).limit(n)


def top1_share(fact: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of the biggest ``key`` in the total amount, from one aggregation:
    sums per key give both the maximum and the total."""
    per_key = fact.groupBy(*by, key).agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("amt"))
    both = per_key.groupBy(*by).agg(
        F.max("amt").cast("decimal(18,2)").alias("top1_amount"),
        F.coalesce(F.sum("amt"), F.lit(0)).cast("decimal(18,2)").alias("total_amount"),
    )
    return both.withColumn("top1_share", C.safe_divide(F.col("top1_amount"), F.col("total_amount")))


def share(fact: DataFrame, column: str) -> DataFrame:
    """Transactions per known value of ``column`` and their share of all known."""
    known = fact.where(F.col(column).isNotNull())
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("txn_count"))
    total = counts.agg(F.sum("txn_count")).scalar()
    return counts.withColumn("share", C.safe_divide(F.col("txn_count"), total))


_GRAINS = {"day": "txn_date", "month": "txn_month"}


def trend(fact: DataFrame, grain: str = "day") -> DataFrame:
    """Transactions, spend, failures and failure rate over time."""
    column = _GRAINS[grain]
    return fact.groupBy(column).agg(
        F.count(F.lit(1)).alias("txn_count_total"),
        _amount(F.col("amount")).alias("amount_sum_total"),
        F.count_if(~F.col("is_success")).alias("txn_count_failed"),
    ).withColumn("failure_rate", C.safe_divide(F.col("txn_count_failed"), F.col("txn_count_total")))


def darkweb_by(dims: dict[str, DataFrame], by: Sequence[str]) -> DataFrame:
    """Cards of the dimension and those found on the dark web."""
    return dims["dim_card"].groupBy(*by).agg(
        F.count(F.lit(1)).alias("cards_total"),
        F.count_if("card_on_dark_web").alias("darkweb_cards"),
    )


def transaction_detail(
    fact: DataFrame,
    dims: dict[str, DataFrame],
    start: str | None = None,
    end: str | None = None,
    card_brand: str | None = None,
    transaction_id: str | None = None,
) -> DataFrame:
    """Drill-down to single transactions. Date bounds also bound the month
    partitions; the card dimension is joined only to filter by brand."""
    if start:
        first = date.fromisoformat(start)
        fact = fact.where((F.col("txn_date") >= F.lit(first)) & (F.col("txn_month") >= F.lit(first.replace(day=1))))
    if end:
        last = date.fromisoformat(end)
        fact = fact.where((F.col("txn_date") <= F.lit(last)) & (F.col("txn_month") <= F.lit(last)))
    if transaction_id:
        fact = fact.where(F.col("transaction_id") == transaction_id)
    if card_brand:
        cards = dims["dim_card"].where(F.col("card_brand") == card_brand).select("card_key")
        fact = fact.join(cards, "card_key", "left_semi")
    return fact.select(
        "txn_date", "transaction_id", "amount", "currency", "is_chip_used",
        "merchant_state", "merchant_city", "merchant_name",
    )

"""Scalar expressions. Every one is made of built-in functions, so it stays in
whole-stage codegen. Raw text is converted with the ``try_`` family: a value
that does not parse becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted boolean spellings and date layouts.
TRUE_VALUES = ("Y", "YES", "TRUE", "1")
FALSE_VALUES = ("N", "NO", "FALSE", "0")
OPEN_DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "dd.MM.yyyy", "MM/yyyy")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -------------------------------------------------------------------


def clean_text(c: Column | str) -> Column:
    """Trimmed, upper case."""
    return F.upper(F.trim(col(c)))


currency_code = clean_text


def is_blank(c: Column | str) -> Column:
    return col(c).isNull() | (F.trim(col(c)) == "")


def varchar(c: Column | str, n: int) -> Column:
    """Text cut to ``n`` characters, as a VARCHAR(n) column stores it."""
    return F.substring(col(c).cast("string"), 1, n)


def mcc_code(c: Column | str) -> Column:
    """Merchant category as four characters; longer codes are cut."""
    return F.lpad(col(c).cast("string"), 4, "0")


def is_mcc_code(c: Column | str) -> Column:
    return col(c).rlike("^[0-9]{4}$")


def ticker_from_path(c: Column | str) -> Column:
    """Ticker out of a market-data file name such as ``.../aapl.us.txt``."""
    return F.regexp_extract(col(c), r"([^/]+)\.us\.txt$", 1)


# --- numbers ----------------------------------------------------------------


def to_int(c: Column | str, dtype: str = "int") -> Column:
    """Whole number from text; ``5812.0`` counts as 5812, other text as NULL.

    By way of a decimal, which keeps all digits of a long id. Text that cannot be
    one, without a digit or with a letter other than e, is not tried: each failed
    try costs an exception inside the cast.
    """
    c = col(c)
    text = c.cast("string")
    likely = text.rlike(r"\p{Nd}") & ~text.rlike("[A-DF-Za-df-z]") | text.isin("true", "false")
    return F.when(likely, F.coalesce(c.try_cast(dtype), c.try_cast("decimal(38,10)").try_cast(dtype)))


def to_long(c: Column | str) -> Column:
    return to_int(c, "bigint")


def to_double(c: Column | str) -> Column:
    return col(c).try_cast("double")


def to_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return col(c).try_cast(f"decimal({precision},{scale})")


def money(c: Column | str, signed: bool = False) -> Column:
    """Amount without currency sign and separators; the minus survives if signed."""
    junk = r"[^0-9.\-]" if signed else r"[^0-9.]"
    return F.nullif(F.regexp_replace(col(c), junk, ""), F.lit("")).try_cast("double")


def safe_divide(a: Column, b: Column, default: float | None = 0.0) -> Column:
    """a / b as double, ``default`` where b is zero or NULL."""
    quotient = a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))
    return quotient if default is None else F.coalesce(quotient, F.lit(float(default)))


# --- booleans ---------------------------------------------------------------


def bool_yn(
    c: Column | str,
    true_values: Iterable[str] = TRUE_VALUES,
    false_values: Iterable[str] = FALSE_VALUES,
) -> Column:
    """Three-valued flag: anything outside both lists is NULL."""
    text = clean_text(col(c).cast("string"))
    return F.when(text.isin(*[v.upper() for v in true_values]), True).when(
        text.isin(*[v.upper() for v in false_values]), False
    )


def is_chip_used(c: Column | str) -> Column:
    """Whether the usage text names the chip; NULL stays unknown."""
    return F.upper(F.trim(col(c))).contains("CHIP")


# --- errors -----------------------------------------------------------------


def error_code(c: Column | str, errors_mode: str = "numeric") -> Column:
    """Error code with 0 for success.

    ``numeric`` reads text that is not a number as 0. ``text`` keeps such a
    message visible as -1, so the transaction does not count as a success.
    """
    c = col(c).cast("string")
    number = to_int(c)
    if errors_mode == "numeric":
        return F.coalesce(number, F.lit(0))
    if errors_mode == "text":
        return F.when(is_blank(c), 0).otherwise(F.coalesce(number, F.lit(-1)))
    raise ValueError(f"errors_mode must be 'numeric' or 'text', not {errors_mode!r}")


# --- dates ------------------------------------------------------------------


def date_multi(c: Column | str, formats: Iterable[str] = OPEN_DATE_FORMATS) -> Column:
    """Date by the first layout that fits."""
    text = col(c).cast("string")
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def expiry_month(c: Column | str) -> Column:
    """First day of the month in ``MM/yyyy`` or ``MM/yy`` text."""
    month = F.substring(col(c), 1, 2)
    four, two = F.substring(col(c), -4, 4), F.substring(col(c), -2, 2)
    return F.coalesce(
        F.try_to_date(F.concat(month, F.lit("/"), four), "MM/yyyy"),
        F.try_to_date(F.concat(month, F.lit("/20"), two), "MM/yyyy"),
    )


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c), "month")


def date_id(c: Column | str) -> Column:
    """yyyyMMdd as an integer, by arithmetic rather than text formatting."""
    c = col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def iso_weekday(c: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(col(c)) + 1


def yyyymm(c: Column | str) -> Column:
    return F.year(col(c)) * 100 + F.month(col(c))


def month_label(c: Column | str, layout: str = "yyyy-MM") -> Column:
    return F.date_format(col(c), layout)


def calendar_columns(c: Column | str) -> dict[str, Column]:
    """The calendar attributes of one date."""
    c = col(c)
    return {
        "date_id": date_id(c),
        "date_value": c,
        "day_of_month": F.dayofmonth(c),
        "day_of_week_iso": iso_weekday(c),
        "day_name": F.date_format(c, "EEEE"),
        "week_of_year": F.weekofyear(c),
        "month_number": F.month(c),
        "month_name": F.date_format(c, "MMMM"),
        "quarter_number": F.quarter(c),
        "year_number": F.year(c),
        "is_weekend": iso_weekday(c) >= 6,
    }


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, by the second boundaries crossed."""
    return F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))


# --- predicates -------------------------------------------------------------


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)

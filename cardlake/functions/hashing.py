"""Row fingerprints. Two text forms exist and must not be mixed:

* record and key hashes: ``||`` between values, the empty-set sign for NULL,
  lower-case hex;
* warehouse hashes: ``|`` between values, nothing for NULL, flags as 1/0,
  upper-case hex.

Timestamps take part in the session time zone, which the library pins to UTC.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the two hash forms.
RECORD_SEPARATOR = "||"
RECORD_NULL = "∅"
WAREHOUSE_SEPARATOR = "|"


def record_hash(cols: Sequence[Column | str]) -> Column:
    parts = [F.coalesce(_col(c).cast("string"), F.lit(RECORD_NULL)) for c in cols]
    return F.sha2(F.concat_ws(RECORD_SEPARATOR, *parts), 256)


key_hash = record_hash


def warehouse_hash(cols: Sequence[Column | str]) -> Column:
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.upper(F.sha2(F.concat_ws(WAREHOUSE_SEPARATOR, *parts), 256))


def bit(c: Column | str) -> Column:
    """A flag as 1 or 0, the way a BIT column prints."""
    return _col(c).cast("int")


def natural_keys_json(cols: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def packed(c: Column | str) -> Column:
    """A hash in half its length, for shuffles: lower-case hex as the bytes it stands for,
    any other text as it is. ``unpacked`` gives back the very same text."""
    text = _col(c)
    digits = F.unhex(text)
    same = F.lower(F.hex(digits)) == text
    return F.struct(F.when(same, digits).alias("digits"), F.when(~F.coalesce(same, F.lit(False)), text).alias("text"))


def unpacked(c: Column) -> Column:
    return F.coalesce(F.lower(F.hex(c["digits"])), c["text"])


def add_record_hash(df: DataFrame, cols: Sequence[str], name: str = "record_hash") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for {name}: {missing}")
    return df.withColumn(name, record_hash(cols))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c

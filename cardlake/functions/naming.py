"""Column names in snake_case."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])")
# Spelled-out signs, and the name of a header cell left empty.
_SIGNS = {"%": "pct", "&": "and"}
_UNNAMED = {"_c0": "unnamed_0"}


def to_snake(name: str) -> str:
    """``CustomerId`` -> ``customer_id``, ``% Change`` -> ``pct_change``,
    ``2nd Value`` -> ``c_2nd_value``."""
    lowered = _HUMP.sub("_", name).lower()
    for sign, word in _SIGNS.items():
        lowered = lowered.replace(sign, word)
    snake = "_".join(re.findall(r"[0-9a-z]+", lowered))
    return f"c_{snake}" if snake[:1].isdigit() else snake


def column_name(header: str) -> str:
    """The table column for a header cell."""
    return _UNNAMED.get(header) or to_snake(header)


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[column_name(c) for c in df.columns])

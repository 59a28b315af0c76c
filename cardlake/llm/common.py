"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.session import checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Characters that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *paths]))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each behind as many underscores as it takes to be no column's."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_column(fn: Callable[[list[str]], list[dict]], kind: T.StructType) -> Callable[[Column], Column]:
    """A column function: texts in, one struct each out, in Arrow batches."""
    arrow = pa.struct([pa.field(f.name, _ARROW[f.dataType.simpleString()]) for f in kind.fields])

    @F.arrow_udf(returnType=kind)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(fn(texts.to_pylist()), type=arrow)

    return run


_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "double": pa.float64(),
}

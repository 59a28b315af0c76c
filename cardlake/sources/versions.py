"""Tables published without copying.

A load writes its rows once, into a folder of its own below the table; a commit
then writes the next numbered pointer, which says for each partition what
folders hold its rows. Until then readers see the table as it was, and a frame
that was read before a commit keeps the files it was read from. A load that is
cut off has committed nothing; ``vacuum`` removes what it and old versions left.

Two loads may commit one after the other if they change different partitions;
if one has changed what the other read, the later commit raises ``Conflict``
and is run again. Folders begin with an underscore, so that reading the path
as a plain Parquet table fails instead of mixing versions.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.session import shuffles_freed
from cardlake.sources import numbered

POINTERS, LOADS, LOAD = "_versions", "_loads", "__load"
#: Hashes in hex are most of a row's bytes; this halves them.
CODEC = "zstd"
EMPTY_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another load has changed what this one was made from."""


class Version(NamedTuple):
    """What a pointer says. ``zones`` holds the least and greatest key of each partition, where known."""

    number: int
    parts: dict[str, list[str]]
    zones: dict[str, list]
    fences: dict[str, int]

    def changed_since(self, other: "Version") -> set[str]:
        return {p for p in {*self.parts, *other.parts} if self.parts.get(p) != other.parts.get(p)}


def current(spark: SparkSession, path: str) -> Version:
    number, said = numbered.newest(spark, f"{path}/{POINTERS}")
    return Version(number, said.get("parts", {}), said.get("zones", {}), said.get("fences", {}))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(numbered.numbers(spark, f"{path}/{POINTERS}"))


def part_name(column: str, value: object) -> str:
    """The name of a partition, as Spark names its folder."""
    return f"{column}={EMPTY_VALUE if value is None or value == '' else value}"


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    parts: Sequence[str] | None = None,
    version: Version | None = None,
) -> DataFrame:
    """The table as its last commit left it, or only the named partitions of it."""
    at = current(spark, path) if version is None else version
    chosen = at.parts if parts is None else {p: at.parts[p] for p in parts if p in at.parts}
    return files(spark, path, sorted({f for some in chosen.values() for f in some}), schema)


def load_rows(spark: SparkSession, path: str, load: str, schema: T.StructType) -> DataFrame:
    """The rows that a load has written, published or not."""
    return files(spark, path, sorted(folders(spark, path, load).values()), schema)


def files(spark: SparkSession, path: str, found: Sequence[str], schema: T.StructType | None) -> DataFrame:
    """The rows in some folders of loads."""
    if not found:
        if schema is None:
            raise ValueError(f"{path} has no rows and so no schema of its own")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", f"{path}/{LOADS}")
    rows = (reader.schema(schema) if schema else reader).parquet(*[f"{path}/{LOADS}/{f}" for f in found])
    return rows.select(*(schema.fieldNames() if schema else [c for c in rows.columns if c != LOAD]))


def write(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), metrics: dict[str, Column] | None = None,
    load: str | None = None, keep: Column | None = None, gather: bool = True,
) -> tuple[str, dict]:
    """Write rows into a load's own folder; (load, metrics of the rows on their way).

    ``keep`` picks the rows that are written; metrics count all. A repeated load
    replaces what it wrote before. ``gather`` deals the rows by partition first; without
    it no row is shuffled, and each task writes a file for each partition it has rows of.
    """
    load = load or uuid.uuid4().hex
    observed, rows = None, df
    if metrics:
        observed = Observation(f"load-{load}-{uuid.uuid4().hex}")
        df = rows.observe(observed, *[m.alias(k) for k, m in metrics.items()])
    kept = df if keep is None else df.where(keep)
    clustered = kept.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by and gather else kept
    with shuffles_freed(df.sparkSession):
        clustered.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(f"{path}/{LOADS}/{LOAD}={load}")
    return load, seen(observed, rows, metrics) if observed else {}


def seen(observed: Observation, df: DataFrame, metrics: dict[str, Column]) -> dict:
    """What a write has observed. A plan that turns out empty may be dropped with its observation: then the metrics are taken apart."""
    try:
        return observed.get
    except Py4JJavaError:
        return df.agg(*[m.alias(k) for k, m in metrics.items()]).first().asDict()


def folders(spark: SparkSession, path: str, load: str) -> dict[str, str]:
    """The partitions that a load has written, with their folders; one without a name if it has none."""
    top = f"{LOAD}={load}"

    def below(folder: str) -> list[str]:
        inner = [n for n in numbered.names(spark, f"{path}/{LOADS}/{folder}") if "=" in n and not n.endswith(".parquet")]
        return [x for n in inner for x in below(f"{folder}/{n}")] if inner else [folder]

    found = {f[len(top) + 1 :]: f for f in below(top)}
    if "" in found and not any(n.endswith(".parquet") for n in numbered.names(spark, f"{path}/{LOADS}/{top}")):
        return {}
    return found


def commit(
    spark: SparkSession,
    path: str,
    base: Version,
    changes: dict[str, list[str]],
    whole: bool = False,
    alone: bool = False,
    zones: dict[str, list] | None = None,
    fence: tuple[str, int] | None = None,
) -> Version:
    """Publish: give each partition of ``changes`` its folders (none: it goes).

    ``base`` is the version that the load was made from. With ``whole`` the
    changes are the whole table. ``alone`` lets no other commit come between,
    even of other partitions: their rows might have the same keys. A ``fence`` (name, number) shuts out whoever
    commits later with a lower number under that name.
    """
    while True:
        now = current(spark, path)
        if fence and now.fences.get(fence[0], 0) > fence[1]:
            raise Conflict(f"{path}: {fence[0]} has been taken over")
        if now.number != base.number and (whole or alone or now.changed_since(base) & changes.keys()):
            raise Conflict(f"{path}: version {now.number} has changed what this load was made from")
        parts = {p: f for p, f in {**({} if whole else now.parts), **changes}.items() if f}
        known = {**now.zones, **dict.fromkeys(changes), **(zones or {})}
        fences = {**now.fences, fence[0]: fence[1]} if fence else now.fences
        said = {"parts": parts, "zones": {p: z for p, z in known.items() if z and p in parts}, "fences": fences}
        if numbered.put(spark, f"{path}/{POINTERS}", now.number + 1, said):
            return Version(now.number + 1, parts, said["zones"], fences)


def publish_load(
    spark: SparkSession, path: str, base: Version, load: str, whole: bool = False, emptied: Sequence[str] = (), **options,
) -> Version:
    """Commit a load: its partitions hold its rows alone, ``emptied`` ones go."""
    written = folders(spark, path, load)
    changes = {p: [] for p in emptied} | {p: [f] for p, f in written.items()}
    return commit(spark, path, base, changes, whole, **options)


def folder_size(spark: SparkSession, path: str, folder: str) -> int:
    """Bytes in a load's folder."""
    at, fs = numbered.file_system(spark, f"{path}/{LOADS}/{folder}")
    return fs.getContentSummary(at).getLength()


def discard(spark: SparkSession, path: str, load: str) -> None:
    """Remove what a load wrote that is not going to be published."""
    at, fs = numbered.file_system(spark, f"{path}/{LOADS}/{LOAD}={load}")
    fs.delete(at, True)


def vacuum(spark: SparkSession, path: str, keep: int = 2, older_than_s: float = 86_400, now: float | None = None) -> list[str]:
    """Remove all but the last ``keep`` pointers, and loads that none of these names.

    Loads younger than ``older_than_s`` stay: one may still be running, or
    have readers. Returns the folders removed.
    """
    pointers = f"{path}/{POINTERS}"
    found = numbered.numbers(spark, pointers)
    for number in found[:-keep]:
        at, fs = numbered.file_system(spark, f"{pointers}/{numbered.file_name(number)}")
        fs.delete(at, False)
    used = {f.split("/")[0] for n in found[-keep:] for some in numbered.get(spark, pointers, n)["parts"].values() for f in some}
    at, fs = numbered.file_system(spark, f"{path}/{LOADS}")
    limit = ((time.time() if now is None else now) - older_than_s) * 1000
    gone = []
    for status in fs.listStatus(at) if fs.exists(at) else []:
        name = status.getPath().getName()
        if name not in used and status.getModificationTime() < limit:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


# --- zones ------------------------------------------------------------------


def _ordered(key: str) -> list[Column]:
    """Keys by length, then by text: the order of numbers for ids without leading zeros."""
    return [F.length(F.col(key).cast("string")), F.col(key).cast("string")]


def zones(rows: DataFrame, column: str, key: str) -> dict[str, list]:
    """The least and greatest key of each partition of a written load: one row a partition."""
    place = F.struct(*_ordered(key))
    found = rows.where(F.col(key).isNotNull()).groupBy(F.col(column).cast("string").alias("p")).agg(
        F.min(place).alias("low"), F.max(place).alias("high")).collect()
    return {part_name(column, r.p): [[*r.low], [*r.high]] for r in found}


def holding(spark: SparkSession, at: Version, keys: DataFrame, key: str) -> list[str]:
    """Partitions that may hold one of the keys: those whose zone has one, and those without a zone."""
    zone = [F.struct(F.lit(p).alias("p"), _literal(lo).alias("lo"), _literal(hi).alias("hi")) for p, (lo, hi) in at.zones.items()]
    other = {p for p in at.parts if p not in at.zones}
    if not zone:
        return sorted(other)
    # As many zones as the table has partitions, limited by contract.
    asked = keys.where(F.col(key).isNotNull()).select(F.struct(*_ordered(key)).alias("k"), F.array(*zone).alias("zones"))
    met = asked.select(F.explode(F.filter("zones", lambda z: (z.lo <= F.col("k")) & (z.hi >= F.col("k")))).alias("z"))
    return sorted({*other, *[r.p for r in met.select("z.p").distinct().collect()]})


def _literal(place: list) -> Column:
    return F.struct(F.lit(place[0]), F.lit(place[1]))

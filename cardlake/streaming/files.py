"""Incremental file ingest and latest-row upsert as streams.

"Only files not seen before" is what a file stream's checkpoint keeps, so the
loop over files and its manifest lookup become ``availableNow`` triggers. Both
sinks can be replayed: a repeated micro-batch replaces what it wrote.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardlake.operators.dedup import dedup_latest
from cardlake.plans.ingest import OUTCOME, begin_batch, lease_folder, load_files, manifest_rows, record_files, take_over
from cardlake.sources import lease, versions, writers

BUCKET = "key_bucket"
#: Loads that a bucket may have before its small ones are merged.
DELTAS = 8


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The files of a folder as a stream of paths, sizes and times; their content is never read."""
    found = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                          T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    return (
        spark.readStream.format("binaryFile").schema(found)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_datetime"))
    )


def stream_ingest(
    spark: SparkSession,
    entity: str,
    source_path: str,
    table_path: str,
    manifest_path: str,
    checkpoint: str,
    exec_date: str,
    files_per_batch: int = 1000,
    wait: float = 3600.0,
) -> StreamingQuery:
    """Load every new file of an entity and record it in the manifest.

    The stream finds the files; they are then loaded as a batch run loads them,
    by their own headers, into the same layout. A micro-batch has a partition of
    its own, named after the stream and its number, so a repeated one replaces
    its rows and two streams into one table keep apart. A micro-batch holds the
    entity's lease while it loads, and waits up to ``wait`` seconds for it.
    """
    name = entity.strip().upper()
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        tag = f"{stream}-{batch_id}"
        files, _ = writers.stage(batch, f"{name}-stream-files", tag)
        paths = [r["file_path"] for r in files.select("file_path").collect()]  # files_per_batch at most
        if not paths:
            return
        with lease.held(session, lease_folder(manifest_path, name), tag, wait=wait) as own:
            take_over(session, name, table_path, manifest_path, own)
            begin_batch(session, name, tag, exec_date, paths, manifest_path)
            done = session.createDataFrame(load_files(session, name, paths, table_path, exec_date, tag), OUTCOME)
            status = files.join(done, "file_path").select(
                F.lit(name).alias("entity"), "file_path", F.element_at(F.split("file_path", "/"), -1).alias("source_name"),
                "file_size", "modified_datetime", "status",
            )
            record_files(session, name, manifest_path, manifest_rows(status, exec_date, "STREAM"), own)

    return (
        file_stream(spark, source_path, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_latest(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: str | Sequence[str],
    tie_break: Sequence[str],
    tag: str,
    buckets: int = 64,
    deltas: int = DELTAS,
) -> None:
    """Add a batch to the log of versions of the table at ``path``; ``read_latest`` gives the latest row per key.

    The table is partitioned by a bucket of the key, so all versions of a key
    meet in one partition whatever month they carry. A batch adds its own
    latest rows to the buckets it touches and leaves all other files alone.
    A bucket with more than ``deltas`` loads is compacted: its small loads are
    merged, and a larger one joins them only once they have grown to its size,
    so a row is rewritten a logarithmic number of times. A repeated batch
    replaces what it added; its rows are no newer than themselves.
    """
    session = batch.sparkSession
    keyed = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    _require_buckets(session, path, buckets)
    name = hashlib.md5(tag.encode()).hexdigest()
    load, _ = versions.write(dedup_latest(keyed, keys, order, tie_break), path, [BUCKET], load=f"{name}-{uuid.uuid4().hex}")
    now = _add(session, path, versions.folders(session, path, load), f"{versions.LOAD}={name}")
    full = {p: f for p, f in now.parts.items() if len(f) > deltas}
    if full:
        compact(session, path, batch.schema, keys, order, tie_break, full, now)


def _add(spark: SparkSession, path: str, written: dict[str, str], same: str) -> versions.Version:
    """Commit a load's folders behind those that its buckets have, in place of an earlier load of the same batch."""
    while True:
        base = versions.current(spark, path)
        others = {p: [f for f in base.parts.get(p, []) if not f.startswith(same)] for p in {*base.parts, *written}}
        changes = {p: [*f, *[written[p]] * (p in written)] for p, f in others.items() if p in written or f != base.parts[p]}
        try:
            return versions.commit(spark, path, base, changes)
        except versions.Conflict:
            continue


def compact(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: str | Sequence[str],
    tie_break: Sequence[str], full: dict[str, list[str]], base: versions.Version,
) -> bool:
    """Merge the small loads of full buckets into one load; False if someone else has changed them meanwhile."""
    chosen = {p: _small(spark, path, some) for p, some in full.items()}
    rows = versions.files(spark, path, sorted({f for some in chosen.values() for f in some}), _stored(schema))
    load, _ = versions.write(dedup_latest(rows, keys, order, tie_break), path, [BUCKET])
    written = versions.folders(spark, path, load)
    changes = {p: [*[f for f in full[p] if f not in some], written[p]] for p, some in chosen.items()}
    try:
        versions.commit(spark, path, base, changes)
        return True
    except versions.Conflict:
        versions.discard(spark, path, load)
        return False


def _small(spark: SparkSession, path: str, folders: Sequence[str]) -> list[str]:
    """The smallest loads of a bucket, and each next larger one that is no larger than those before together."""
    sizes = sorted((versions.folder_size(spark, path, f), f) for f in folders)
    chosen, total = [], 0
    for size, folder in sizes:
        if len(chosen) > 1 and size > total:
            break
        chosen.append(folder)
        total += size
    return chosen


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: str | Sequence[str], tie_break: Sequence[str],
) -> DataFrame:
    """The latest row of each key, of all loads that the table has."""
    stored = versions.read(spark, path, _stored(schema))
    return dedup_latest(stored, keys, order, tie_break).select(*schema.fieldNames())


def _require_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """The table's number of buckets is fixed by its first batch: another one would put a key into two."""
    note = f"{path.rstrip('/')}_buckets"
    if writers.table_exists(spark, note):
        stored = spark.read.parquet(note).first()[0]
        if stored != buckets:
            raise ValueError(f"{path} has {stored} buckets, not {buckets}")
    else:
        writers.overwrite(spark.createDataFrame([(buckets,)], "buckets int"), note)


def stream_latest(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    order: str | Sequence[str],
    tie_break: Sequence[str],
    checkpoint: str,
    tag: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = 64,
) -> StreamingQuery:
    """Stream into a table of versions; ``read_latest`` gives the latest row per key."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch if transform is None else transform(batch)
        merge_latest(rows, path, keys, order, tie_break, f"{tag}-{batch_id}", buckets)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

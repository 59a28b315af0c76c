"""Writing Parquet tables.

A published table is never overwritten: a load writes its rows once, into a
folder of its own, is checked there and then committed by a pointer (see
``versions``). Staging tables in the shared checkpoint folder cut the lineage of
what several steps read, so a lost executor replays a scan and not the whole
plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from cardlake.operators.quality import Check, QualityError, assert_passed, row_metrics, run_checks
from cardlake.session import checkpoint_dir, shuffles_freed
from cardlake.sources import versions
from cardlake.sources.readers import rows_to_table


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster: bool = True
) -> None:
    """Replace the whole table. ``df`` must not read from ``path``."""
    _replace(df, path, partition_by, cluster, "static")


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], cluster: bool = True
) -> None:
    """Replace only the partitions that occur in ``df``."""
    _replace(df, path, partition_by, cluster, "dynamic")


def _replace(df: DataFrame, path: str, partition_by: Sequence[str], cluster: bool, mode: str) -> None:
    rows = clustered(df, partition_by) if cluster else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", versions.CODEC)
    with shuffles_freed(df.sparkSession):
        writer.partitionBy(*partition_by).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the table's own file system, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one table partition brought together before a partitioned write.

    A rebalance, not a plain repartition: adaptive execution splits a month
    that is too big for one task and merges months that are too small, so a
    hot month neither runs in one task nor leaves thousands of small files.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def table_exists(spark: SparkSession, path: str) -> bool:
    if versions.exists(spark, path):
        return True
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table by its path: the last version of a published one, or plain Parquet files."""
    if versions.exists(spark, path):
        return versions.read(spark, path, schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or no rows of the right shape before its first load."""
    if table_exists(spark, path):
        return read(spark, path, schema)
    return spark.createDataFrame([], schema)


def create_if_missing(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """An empty Parquet table in the catalog, unless one is there."""
    if spark.catalog.tableExists(table):
        return
    empty = spark.createDataFrame([], schema).write.format("parquet").mode("ignore")
    (empty.partitionBy(*partition_by) if partition_by else empty).saveAsTable(table)


def rebuild_table(df: DataFrame, table: str) -> None:
    """Replace all rows of a catalog table, keeping its definition.

    The rows are written once, beside the old ones; then the table's location
    moves there, in one catalog step. A query that has begun keeps the old files,
    a job that is cut off leaves the table as it was, and ``df`` may read from
    the table. Old folders stay until the folder's retention rule removes them.
    """
    spark = df.sparkSession
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    home = about["Location"].rstrip("/")
    home = home.rpartition("/_v-")[0] or home
    columns = spark.table(table).schema
    part = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    fresh = f"{home}/_v-{uuid.uuid4().hex}"
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in columns])
    clustered(rows, part).write.partitionBy(*part).parquet(fresh)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(table)


def append_rows(spark: SparkSession, path: str, rows: Sequence[dict], schema: T.StructType) -> None:
    """Log rows, all of one run in one write; fields a row lacks are NULL."""
    rows_to_table(spark, rows, schema).coalesce(1).write.mode("append").parquet(path)


def stage(
    df: DataFrame,
    name: str,
    run_id: str,
    partition_by: Sequence[str] = (),
    metrics: dict[str, Column] | None = None,
) -> tuple[DataFrame, dict]:
    """Write ``df`` to a staging table and read it back, with metrics of the write.

    The counts come from the write itself (``observe``), not from another pass.
    Read back from files, the frame also has a known size, by which Spark
    decides whether a join may broadcast it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/staging/{run_id}/{name}"
    schema = df.schema
    observation, rows = None, df
    if metrics:
        observation = Observation(f"{name}-{run_id}")
        df = df.observe(observation, *[m.alias(k) for k, m in metrics.items()])
    overwrite(df, path, partition_by, cluster=False)
    staged = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return staged, versions.seen(observation, rows, metrics) if observation else {}


def publish(
    df: DataFrame,
    path: str,
    name: str,
    partition_by: Sequence[str] = (),
    checks: Sequence[Check] = (),
    metrics: dict[str, Column] | None = None,
    whole: bool = True,
    touched: Sequence[str] = (),
    base: versions.Version | None = None,
    zone_key: str | None = None,
    gather: bool = True,
) -> dict:
    """Write rows once, check them, then commit them as the table or as their partitions.

    ``touched`` names partitions the rows were taken from: those that no row
    is left for go. ``base`` is the version that the rows were made from.
    ``zone_key`` is a key whose range is kept for each partition. ``gather``: see
    ``versions.write``.

    Row checks ride on the write, so a load is one pass over its input.
    Partition limits and unique keys are checked on the written files. A failed
    check raises and leaves the table as it was.
    """
    spark = df.sparkSession
    if base is None:
        base = versions.current(spark, path)
    if not (whole or base.number) and table_exists(spark, path):
        raise ValueError(f"{path} is not a published table: load it whole first")
    prefix = "check:"
    probes = {prefix + k: m for k, m in row_metrics(checks).items()}
    load, seen = versions.write(df, path, partition_by, {"row_out": F.count(F.lit(1)), **probes, **(metrics or {})}, gather=gather)
    written = versions.load_rows(spark, path, load, df.schema)
    try:
        broken = {k[len(prefix):]: v for k, v in seen.items() if k.startswith(prefix) and v}
        if broken:
            raise QualityError(name, broken)
        others = [c for c in checks if c.unique_key or c.max_distinct is not None]
        if others:
            assert_passed(run_checks(written, others), name)
    except QualityError:
        versions.discard(spark, path, load)
        raise
    known = versions.zones(written, partition_by[0], zone_key) if zone_key and partition_by else None
    versions.publish_load(spark, path, base, load, whole, touched, alone=not whole, zones=known)
    result = {k: v for k, v in seen.items() if not k.startswith(prefix)}
    result["partition_count"] = len(versions.folders(spark, path, load)) if partition_by else 0
    return result

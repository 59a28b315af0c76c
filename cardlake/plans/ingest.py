"""Which files to load, and the record of what was loaded."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.functions.naming import column_name
from cardlake.operators.upsert import merge_rows, merged_table
from cardlake.plans import contracts as K
from cardlake.plans.bronze import BATCH, ENTITIES, pairs_from_object, to_bronze
from cardlake.session import checkpoint_dir
from cardlake.sources import lease, numbered, readers, versions, writers


def candidate_files(
    files: DataFrame,
    manifest: DataFrame | None,
    entity: str,
    mode: str = "INCR",
    retry_failed: bool = True,
) -> DataFrame:
    """Files to load: all of them, or those the manifest does not hold.

    With ``retry_failed`` a file whose last load failed is a candidate again.
    """
    if (mode or "INCR").upper() == "FULL" or manifest is None:
        return files
    done = manifest.where(F.col("entity") == entity)
    if retry_failed:
        done = done.where(C.differs(F.col("last_status"), F.lit("FAILED")))
    return files.join(done.select("file_path"), "file_path", "left_anti").select(*files.columns)


def manifest_rows(
    file_status: DataFrame,
    exec_date: str,
    mode: str = "INCR",
    now: Column | None = None,
    total_source_files: int | None = None,
    total_candidate_files: int | None = None,
) -> DataFrame:
    """Manifest rows from (entity, file_path, source_name, file_size,
    modified_datetime, status) rows. A size that is not a number becomes -1, a
    blank status UNKNOWN; rows without entity or path are left out."""
    now = F.current_timestamp() if now is None else now

    def count(n: int | None) -> Column:
        return F.lit(-1 if n is None else n)

    usable = ~(C.is_blank("entity") | C.is_blank("file_path"))
    return K.project_to_contract(
        file_status.where(usable).select(
            "entity",
            "file_path",
            "source_name",
            F.coalesce(C.to_long(F.col("file_size").cast("string")), F.lit(-1)).alias("file_size"),
            F.col("modified_datetime").try_cast("timestamp").alias("modified_datetime"),
            now.alias("first_ingested_datetime"),
            now.alias("last_ingested_datetime"),
            F.when(C.is_blank("status"), "UNKNOWN").otherwise(F.col("status")).alias("last_status"),
            F.try_to_date(F.lit(exec_date)).alias("exec_date"),
            F.lit(mode or "UNKNOWN").alias("ingestion_mode"),
            count(total_source_files).alias("total_source_files"),
            count(total_candidate_files).alias("total_candidate_files"),
        ),
        K.INGESTION_MANIFEST,
    )


def update_manifest(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """Manifest merged with new rows; the first ingestion time is kept."""
    names = K.INGESTION_MANIFEST.names
    merged = merge_rows(
        manifest.select(*names), rows, ["entity", "file_path"], keep_cols=["first_ingested_datetime"]
    )
    return merged_table(merged)


def run_status(candidates: Column, processed: Column, failed: Column) -> Column:
    """NO_DATA, SUCCESS, FAILED or PARTIAL from the counts of a run."""
    return (
        F.when(candidates == 0, "NO_DATA")
        .when((failed == 0) & (processed == candidates), "SUCCESS")
        .when((processed == 0) & (failed > 0), "FAILED")
        .otherwise("PARTIAL")
    )


def ingestion_log(
    file_status: DataFrame,
    now: Column | None = None,
    by: Sequence[str] = ("exec_date", "entity", "ingestion_mode"),
) -> DataFrame:
    """Run-level log: one row per run from the status of its files.

    A file without a status was listed but is not a candidate of the run.
    """
    now = F.current_timestamp() if now is None else now
    done, broken = F.col("status") == "SUCCESS", F.col("status") == "FAILED"
    counted = file_status.groupBy(*by).agg(
        F.count(F.lit(1)).cast("int").alias("total_source_files"),
        F.count("status").cast("int").alias("total_candidate_files"),
        F.count_if(done).cast("int").alias("processed_files"),
        F.count_if(broken).cast("int").alias("failed_files"),
    )
    status = run_status(F.col("total_candidate_files"), F.col("processed_files"), F.col("failed_files"))
    return counted.select(
        *by,
        "total_source_files",
        "total_candidate_files",
        "processed_files",
        "failed_files",
        status.alias("status"),
        now.alias("log_timestamp"),
    )


def daily_ingestion(manifest: DataFrame, since: str | None = None) -> DataFrame:
    """Files per entity and day with counts by status; ``since`` bounds the window."""
    scoped = manifest if since is None else manifest.where(F.col("exec_date") >= F.lit(since).cast("date"))

    def of(status: str) -> Column:
        return F.count_if(F.col("last_status") == status)

    return scoped.groupBy("entity", "exec_date").agg(
        F.count(F.lit(1)).alias("files_total"),
        of("SUCCESS").alias("files_success"),
        of("FAILED").alias("files_failed"),
        of("PARTIAL").alias("files_partial"),
    )


def failed_files(manifest: DataFrame) -> DataFrame:
    return manifest.where("last_status = 'FAILED'").select(
        "entity", "file_path", "exec_date", "last_ingested_datetime"
    )


# --- loading ----------------------------------------------------------------

OUTCOME = "file_path string, status string, rows_loaded long, rows_rejected long"
BEGUN = "entity string, batch string, ingestion_date string, file_path string, begun timestamp"
#: Files that cannot be read at all; more of them look like an outage, not like bad files.
UNREADABLE = 10
#: Headers that the driver reads at the same time.
PEEKS = 16


def rejects_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}_rejects"


def ingest(
    spark: SparkSession,
    entity: str,
    source_path: str,
    table_path: str,
    manifest_path: str,
    log_path: str,
    exec_date: str,
    run_id: str,
    mode: str = "INCR",
    batch_files: int = 10_000,
    wait: float = 0.0,
    lease_seconds: float = lease.SECONDS,
    overlap: timedelta | None = None,
) -> dict:
    """Load the new files of an entity, then record each file and the run.

    Files go through in batches of about ``batch_files``, so the driver holds
    the paths of one batch however many there are; each batch is one job.

    One load of an entity runs at a time: it holds the entity's lease, renewed
    with each batch, and another one waits up to ``wait`` seconds or raises
    ``lease.Held``. If its owner dies, the lease ends after ``lease_seconds``; the
    next load takes over, removes what was written but never recorded, and
    shuts the old owner out of the manifest.

    With ``overlap`` only files changed since the latest recorded file, less the
    overlap, are listed, and those whose load has failed; files that arrive
    with an older time are then not seen.
    """
    with lease.held(spark, lease_folder(manifest_path, entity), run_id, lease_seconds, wait) as own:
        return _ingest(spark, entity, source_path, table_path, manifest_path, log_path, exec_date, run_id, mode, batch_files, own, overlap)


def listed_files(spark: SparkSession, source_path: str, manifest: DataFrame, overlap: timedelta | None = None) -> DataFrame:
    """Files of the source: all, or those from the manifest's latest time less ``overlap`` on, and failed ones."""
    mark = manifest.agg(F.max("modified_datetime").cast("double")).first()[0] if overlap is not None else None
    if mark is None:
        return readers.list_files(spark, source_path)
    found = readers.list_files(spark, source_path, after=datetime.fromtimestamp(mark, timezone.utc) - overlap)
    failed = manifest.where("last_status = 'FAILED'").select(*found.columns)
    return found.unionByName(failed.join(found.select("file_path"), "file_path", "left_anti").select(*found.columns))


def lease_folder(manifest_path: str, entity: str) -> str:
    return f"{manifest_path.rstrip('/')}_leases/{entity.strip().upper()}"


def take_over(spark: SparkSession, entity: str, table_path: str, manifest_path: str, own: lease.Lease) -> DataFrame:
    """The entity's manifest, once earlier owners are shut out of it and their unfinished batches are removed."""
    versions.commit(spark, manifest_path, versions.current(spark, manifest_path), {}, fence=(entity, own.number))
    manifest = _manifest(spark, manifest_path, entity)
    undo_unfinished(spark, entity, table_path, manifest, manifest_path)
    return manifest


def _manifest(spark: SparkSession, manifest_path: str, entity: str) -> DataFrame:
    part = versions.part_name("entity", entity)
    return versions.read(spark, manifest_path, K.INGESTION_MANIFEST.schema, [part]).where(F.col("entity") == entity)


def record_files(spark: SparkSession, entity: str, manifest_path: str, rows: DataFrame, own: lease.Lease) -> None:
    """Merge rows into the entity's partition of the manifest and commit it under the lease.

    Entities have partitions of their own, so loads of two of them do not meet.
    """
    base, part = versions.current(spark, manifest_path), versions.part_name("entity", entity)
    stored = versions.read(spark, manifest_path, K.INGESTION_MANIFEST.schema, [part], base)
    merged = update_manifest(stored.where(F.col("entity") == entity), rows)
    load, _ = versions.write(merged, manifest_path, ["entity"])
    own.renew()
    versions.publish_load(spark, manifest_path, base, load, fence=(entity, own.number))


def _ingest(
    spark: SparkSession, entity: str, source_path: str, table_path: str, manifest_path: str, log_path: str,
    exec_date: str, run_id: str, mode: str, batch_files: int, own: lease.Lease, overlap: timedelta | None,
) -> dict:
    manifest = take_over(spark, entity, table_path, manifest_path, own)
    files, _ = writers.stage(listed_files(spark, source_path, manifest, overlap if mode != "FULL" else None), f"{entity}-files", run_id)
    wanted, seen = writers.stage(
        candidate_files(files, manifest, entity, mode), f"{entity}-candidates", run_id, (),
        {"n": F.count(F.lit(1))},
    )
    batches = max(1, -(-seen["n"] // batch_files))
    outcomes = f"{checkpoint_dir(spark)}/staging/{run_id}/{entity}-outcomes"
    writers.overwrite(spark.createDataFrame([], OUTCOME), outcomes)
    for b in range(batches):
        part = wanted.where(F.pmod(F.xxhash64("file_path"), F.lit(batches)) == b).select("file_path")
        paths = [r["file_path"] for r in part.collect()]
        if paths:
            own.renew()
            batch = f"{run_id}-{b}"
            begin_batch(spark, entity, batch, exec_date, paths, manifest_path)
            done = load_files(spark, entity, paths, table_path, exec_date, batch)
            writers.append(spark.createDataFrame(done, OUTCOME), outcomes)
    status = spark.read.schema(OUTCOME).parquet(outcomes)
    listed = files.join(status, "file_path", "left").withColumns(
        {
            "entity": F.lit(entity),
            "exec_date": F.lit(exec_date).cast("date"),
            "ingestion_mode": F.lit(mode),
        }
    )
    total = files.count()
    rows = manifest_rows(
        listed.where("status is not null"), exec_date, mode,
        total_source_files=total, total_candidate_files=seen["n"],
    )
    if seen["n"]:
        record_files(spark, entity, manifest_path, rows, own)
    log, _ = writers.stage(
        K.project_to_contract(ingestion_log(listed), K.INGESTION_LOG), f"{entity}-log", run_id
    )
    row = log.first() or {"processed_files": 0, "failed_files": 0}
    if total:
        writers.append(log, log_path)
    else:
        nothing = dict.fromkeys(
            ("total_source_files", "total_candidate_files", "processed_files", "failed_files"), 0
        )
        empty = {**nothing, "exec_date": date.fromisoformat(exec_date), "entity": entity,
                 "ingestion_mode": mode, "status": "NO_DATA", "log_timestamp": datetime.now(timezone.utc)}
        writers.append_rows(spark, log_path, [empty], K.INGESTION_LOG.schema)
    loaded = status.agg(F.coalesce(F.sum("rows_loaded"), F.lit(0)), F.coalesce(F.sum("rows_rejected"), F.lit(0))).first()
    return {
        "total_source_files": total,
        "total_candidate_files": seen["n"],
        "processed_files": row["processed_files"],
        "failed_files": row["failed_files"],
        "rows_loaded": loaded[0],
        "rows_rejected": loaded[1],
    }


def begin_batch(spark: SparkSession, entity: str, batch: str, exec_date: str, paths: Sequence[str], manifest_path: str) -> None:
    """Note which files a batch is about to load."""
    rows = spark.createDataFrame([(entity, batch, exec_date, p) for p in paths], "entity string, batch string, ingestion_date string, file_path string")
    writers.append(rows.withColumn("begun", F.current_timestamp()), f"{manifest_path}_begun")


def undo_unfinished(spark: SparkSession, entity: str, table_path: str, manifest: DataFrame, manifest_path: str) -> None:
    """Remove the rows of batches whose files the manifest does not confirm."""
    begun = writers.read_or_empty(spark, f"{manifest_path}_begun", readers.ddl(BEGUN)).where(F.col("entity") == entity)
    known = manifest.select("file_path", "last_ingested_datetime")
    confirmed = begun.join(known, "file_path").where("last_ingested_datetime >= begun").select("batch")
    left = begun.join(confirmed, "batch", "left_anti").select("ingestion_date", "batch").distinct()
    for row in left.collect():
        folder = f"ingestion_date={row.ingestion_date}/{BATCH}={row.batch}"
        for path in (table_path, rejects_path(table_path)):
            writers.remove_folder(spark, f"{path.rstrip('/')}/{folder}")


def load_files(
    spark: SparkSession, entity: str, paths: Sequence[str], table_path: str, exec_date: str, batch: str
) -> list[tuple]:
    """Write the files' rows to a bronze partition of the batch's own.

    Columns go by each file's own header, which is read from the file's first
    bytes; the files are then scanned once, and their rows written once. Lines
    that do not fit are seen on that pass: only if there are any, a second one
    writes them, with their file, to the rejects table beside the bronze table;
    the other lines of the file load. Returns (path, status, rows loaded, rows
    rejected): FAILED if no line fits or the header has none of the entity's
    columns, PARTIAL if some lines do not fit, SUCCESS otherwise. Loading a batch
    again replaces what it wrote.
    """
    name = entity.strip().upper()
    headers, unreadable = ({}, []) if name == "MCC" else _headers(spark, list(paths))
    for header in [h for h in headers if not _fits(name, h)]:
        unreadable += headers.pop(header)
    if name == "MCC":
        landing = readers.read_whole(spark, paths).select("*", F.col("_metadata.file_path").alias("__file"))
        line, broken = F.col("value"), F.col("value").isNull() | F.from_json("value", readers.OBJECT).isNull()
    else:
        landing = readers.read_by_headers(spark, headers, [column_name(c) for c in _wanted(name)] or None)
        # A field of the line is asked for, too: a scan cannot give lines that do not fit alone.
        line, broken = F.col(readers.CORRUPT), F.col(readers.CORRUPT).isNotNull() & F.coalesce(F.length("__first") >= 0, F.lit(True))
    bad = {"bad": F.count_if(broken)}
    watched = Observation(f"landing-{name}-{batch}-{uuid.uuid4().hex}")
    good = landing.observe(watched, *[m.alias(k) for k, m in bad.items()]).where(~broken)
    if name == "MCC":
        good = pairs_from_object(good, "value", "mcc", "mcc_description")
    bronze = to_bronze(good.drop(readers.CORRUPT), name, exec_date, source_file=F.col("__file"))
    part, own = ["ingestion_date", BATCH], f"ingestion_date={exec_date}/{BATCH}={batch}"
    for table in (table_path, rejects_path(table_path)):
        writers.remove_folder(spark, f"{table.rstrip('/')}/{own}")
    writers.overwrite_partitions(bronze.withColumn(BATCH, F.lit(batch)), table_path, part, cluster=False)
    rejected: dict[str, int] = {}
    if versions.seen(watched, landing, bad)["bad"]:
        rejects = landing.where(broken).select(
            F.col("__file").alias("source_file"), line.alias("line"), F.lit(exec_date).cast("date").alias("ingestion_date"), F.lit(batch).alias(BATCH)
        )
        writers.overwrite_partitions(rejects, rejects_path(table_path), part, cluster=False)
        rejected = _written(spark, rejects_path(table_path), own)
    loaded, out = _written(spark, table_path, own), []
    for p in paths:
        n, bad = loaded.get(_local(p), 0), rejected.get(_local(p), 0)
        status = "FAILED" if p in unreadable or bad and not n else "PARTIAL" if bad else "SUCCESS"
        out.append((p, status, n, bad))
    return out


def _written(spark: SparkSession, table_path: str, folder: str) -> dict[str, int]:
    """Rows that a batch has written, by file: reads one column of its own folder, gives one row a file."""
    path = f"{table_path.rstrip('/')}/{folder}"
    if not numbered.names(spark, path):
        return {}
    rows = spark.read.schema("source_file string").parquet(path).groupBy("source_file").count().collect()
    return {_local(unquote(r.source_file)): r["count"] for r in rows}


def _headers(spark: SparkSession, paths: list[str]) -> tuple[dict[str, list[str]], list[str]]:
    """(header line -> its files, files that cannot be read). Files without any line are in neither."""
    by_header: dict[str, list[str]] = {}
    unreadable: list[str] = []

    def peek(path: str) -> str | None | Py4JJavaError:
        try:
            return readers.first_line(spark, path)
        except Py4JJavaError as error:
            return error

    with ThreadPoolExecutor(PEEKS) as pool:
        for path, said in zip(paths, pool.map(peek, paths)):
            if isinstance(said, Py4JJavaError):
                unreadable.append(path)
                if len(unreadable) > UNREADABLE:
                    raise said
            elif said is not None:
                by_header.setdefault(said, []).append(path)
    return by_header, unreadable


def _wanted(name: str) -> list[str]:
    return ENTITIES[name].landing_schema.fieldNames() if name in ENTITIES else []


def _fits(name: str, header: str) -> bool:
    """Whether a header has a column of the entity; any header fits an unknown one."""
    wanted = {column_name(c) for c in _wanted(name)}
    return not wanted or bool(wanted & {column_name(c) for c in readers.header_names(header)})


def _local(uri: str) -> str:
    """Path without scheme, however many slashes follow the scheme."""
    return "/" + re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", uri).lstrip("/")

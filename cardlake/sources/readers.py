"""Reading landing files, listings and generated rows."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions.naming import column_name

CORRUPT = "_corrupt_record"


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV files with a header row, every column as text.

    With a schema nothing is inferred: its names are those of the files' header,
    in its order, so files of different headers are read apart. Without one the
    header of the first file gives the names; values stay text.
    ``keep_corrupt`` adds a column holding lines that do not fit the schema, so
    one bad line does not fail the run.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        if keep_corrupt:
            schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
            # Of lines cut to some columns a scan would not see that they do not fit.
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
        reader = reader.schema(schema)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line with text of a file, read from its first bytes and no further."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(
            stream if codec is None else codec.createInputStream(stream), "UTF-8"))
        while (line := lines.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        stream.close()


#: A scheme and the slashes behind it, of which scans and listings write different numbers.
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*"


def file_key(spark: SparkSession, path: str) -> str:
    """A path as a scan names it in ``_metadata.file_path``, without its scheme."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub(SCHEME, "/", fs.makeQualified(at).toUri().toString())


def read_by_headers(spark: SparkSession, headers: dict[str, list[str]], names: Sequence[str] | None = None) -> DataFrame:
    """CSV files of many headers as one frame of text columns, with ``__file``, the lines that do not fit, and each line's ``__first`` field.

    ``headers`` gives the files of each header line. Files whose headers have
    the same number of columns are one scan, whatever the order of the columns:
    each file's columns are then picked by its own header's places, from a table
    of as many rows as there are files. ``names`` are the columns wanted, by
    their normal names; a file without one of them has NULL. Without ``names``
    all columns of all headers come out, by their own names.
    """
    known = {h: header_names(h) for h in headers}
    wanted = list(names) if names is not None else list(dict.fromkeys(n for h in sorted(known) for n in known[h]))
    key = column_name if names is not None else str
    widths: dict[int, list[str]] = {}
    for header in sorted(headers):
        widths.setdefault(len(known[header]), []).append(header)
    frames = []
    for width, some in sorted(widths.items()):
        generic = text_schema([f"__c{i}" for i in range(width)])
        raw = read_csv(spark, [f for h in some for f in headers[h]], generic, keep_corrupt=True)
        raw = raw.select("*", F.col("_metadata.file_path").alias("__file"))
        place = {h: {key(n): i for i, n in reversed(list(enumerate(known[h])))} for h in some}
        picks = {h: [place[h].get(key(w), -1) for w in wanted] for h in some}
        if len({tuple(p) for p in picks.values()}) == 1:
            at = picks[some[0]]
            columns = [(F.col(f"__c{i}") if i >= 0 else F.lit(None).cast("string")).alias(w) for w, i in zip(wanted, at)]
        else:
            rows = [(file_key(spark, f), picks[h]) for h in some for f in headers[h]]
            places = spark.createDataFrame(rows, "__key string, __at array<int>")
            raw = raw.withColumn("__key", F.regexp_replace("__file", SCHEME, "/")).join(F.broadcast(places), "__key").withColumn("__all", F.array(*generic.fieldNames()))
            columns = [F.when(F.col("__at")[k] >= 0, F.get("__all", F.col("__at")[k])).alias(w) for k, w in enumerate(wanted)]
        frames.append(raw.select(*columns, CORRUPT, "__file", F.col("__c0").alias("__first")))
    out = frames[0] if frames else spark.createDataFrame([], text_schema([*wanted, CORRUPT, "__file", "__first"]))
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def header_names(line: str) -> list[str]:
    """Column names of a header line; blank and repeated ones get a number."""
    names = [n.lstrip("\ufeff") for n in next(csv.reader([line]), [])]
    seen = Counter(n.lower() for n in names)
    return [f"_c{i}" if not n.strip() else f"{n}{i}" if seen[n.lower()] > 1 else n for i, n in enumerate(names)]


def ddl(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


OBJECT = "map<string,string>"


def read_whole(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files as one text value each."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)


def read_json_object(
    spark: SparkSession, paths: str | Sequence[str], key: str = "key", value: str = "value"
) -> DataFrame:
    """Files holding one flat JSON object each, as (key, value) rows.

    The object is read as a map, not as a row with one column per key, so the
    plan does not widen with the number of keys.
    """
    return read_whole(spark, paths).select(
        F.explode(F.from_json("value", OBJECT)).alias(key, value),
        F.col("_metadata.file_path").alias("file_path"),
    )


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet table by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def list_files(spark: SparkSession, path: str, pattern: str | None = None, after: datetime | None = None) -> DataFrame:
    """Files below ``path`` as rows; their content column is pruned, never read.

    ``after`` leaves out files last changed before that time (UTC) when they are listed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if after is not None:
        reader = reader.option("modifiedAfter", after.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    return reader.load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("source_name"),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_datetime"),
    )


def files_from_json(spark: SparkSession, listing: str, source_path: str) -> DataFrame:
    """Files out of a listing in JSON text: a list, or an object holding one
    under ``childItems``, ``value`` or ``items``. Text that is neither gives no rows."""
    item = "array<struct<name:string,size:bigint,lastModified:string>>"
    text = spark.createDataFrame([(listing,)], "listing string")
    is_list = F.trim("listing").startswith("[")
    found = F.coalesce(
        F.when(is_list, F.from_json("listing", item)),
        *[
            F.from_json(F.get_json_object("listing", f"$.{key}"), item)
            for key in ("childItems", "value", "items")
        ],
    )
    return (
        text.select(F.explode(found).alias("f"))
        .where("f.name is not null")
        .select(
            F.col("f.name").alias("source_name"),
            F.concat(F.lit(source_path), F.col("f.name")).alias("file_path"),
            F.col("f.size").alias("file_size"),
            F.try_to_timestamp(F.col("f.lastModified")).alias("modified_datetime"),
        )
    )


def add_lineage_paths(
    files: DataFrame, landing: str, archive: str, exec_date: str, name: str = "source_name"
) -> DataFrame:
    """Landing and archive location of each file, dated by the run."""
    return files.withColumns(
        {
            "landing_path": F.concat(F.lit(f"{landing}{exec_date}/"), F.col(name)),
            "archive_path": F.concat(F.lit(f"{archive}{exec_date}/"), F.col(name)),
        }
    )


def date_spine(spark: SparkSession, start: str, end: str, name: str = "date_value") -> DataFrame:
    """Every day from start to end, both included."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    return spine_between(bounds, F.col("lo"), F.col("hi"), name)


def spine_over(df: DataFrame, day: Column, name: str = "date_value") -> DataFrame:
    """Every day between the first and the last date found in ``df``."""
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return spine_between(bounds, F.col("lo"), F.col("hi"), name)


def spine_between(bounds: DataFrame, lo: Column, hi: Column, name: str) -> DataFrame:
    days = F.sequence(lo, hi, F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))


def rows_to_table(spark: SparkSession, rows: Sequence, schema: T.StructType) -> DataFrame:
    """Literal rows under a fixed schema; a field missing from a dict is NULL."""
    names = schema.fieldNames()
    return spark.createDataFrame(
        [tuple(r.get(n) for n in names) if isinstance(r, dict) else tuple(r) for r in rows], schema
    )

"""Operator 2: repeated runs of lines, later copies deleted.

The lines of all documents, in order of doc_id and place, form one sequence of
line ids. Prefix doubling names each place by the run of 1, 2, 4, ... lines that
starts there. A name is the earliest place with the same run, so places of one
name are the suffix array's interval with that common prefix, and the name
says where its first copy stands. Places whose run is unique drop out of the
next round, so the rounds shrink to what is repeated.

A run counts from ``min_words`` words on. Its shortest windows of so many words,
taken forward from each line and backward from each line, cover exactly the
maximal repeated runs; a window of m lines is named by the two runs of 2^k lines
that begin and end it. A window that has an earlier copy is deleted, so the
first copy of everything stays. Copies may overlap.

Text: null has no lines and stays null; lines are split at line feeds; a text
whose lines all go becomes empty. Documents are never dropped. Order of equal
ids is that of a text hash; null ids come first; rows with the same id and text
are one document, and each of them is cleaned alike. Extra columns pass
through; an input column named like an output column is replaced. An empty
table gives an empty table. No list is longer than one document's lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.common import documents, importable, stage, unused

MIN_WORDS = 50
_LINE = pa.schema([("key", pa.int64()), ("line", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("ahead", pa.int32()), ("behind", pa.int32())])
_EDITED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("removed", T.StringType())])
_EDITED_ARROW = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("removed", pa.string())])


def windows(counts: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest window of ``least`` words that starts, and that ends, at each line; 0 if none."""
    n, total = len(counts), np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(n)
    end = np.searchsorted(total, total[:-1] + least)
    ahead = np.where(end <= n, end - at, 0)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    behind = np.where(start >= 0, at + 1 - start, 0)
    return ahead, behind


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """g (place in the whole sequence), doc_id, key, line, h1, h2, ahead, behind."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, (key, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                lines = text.split("\n")
                ahead, behind = windows([len(x.encode().split()) for x in lines], max(least, 1))
                hashed = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in lines), "<i8").reshape(-1, 2)
                own = ids.take(pa.array(np.full(len(lines), i)))
                columns = [np.full(len(lines), key), np.arange(len(lines), dtype=np.int32), hashed[:, 0], hashed[:, 1], ahead.astype(np.int32), behind.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([own, *[pa.array(c, type=f.type) for c, f in zip(columns, _LINE)]], names=["doc_id", *_LINE.names])

    kind = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T._parse_datatype_string("key long, line int, h1 long, h2 long, ahead int, behind int").fields])
    # Stored before it is dealt: finding the ranges reads it too, and would split all texts twice.
    found = stage(docs.select("doc_id", "key", "text").mapInArrow(split, kind), "split-lines")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.repartitionByRange(n, "doc_id", "key").sortWithinPartitions("doc_id", "key", "line")
    return stage(ordered.withColumn("g", F.monotonically_increasing_id()), "lines")


def _next_names(names: DataFrame, size: int) -> DataFrame:
    """Names of runs of twice the size, where they are repeated. Runs never leave their document: see ``tail``."""
    later = names.select((F.col("g") - size).alias("g"), F.col("name").alias("then"))
    pairs = names.where(F.col("tail") >= 2 * size).join(later, "g")
    first = pairs.groupBy("name", "then").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return pairs.join(first, ["name", "then"]).select("g", "tail", F.col("first").alias("name"))


def repeated_windows(lines: DataFrame) -> DataFrame:
    """start, m: the windows of the lines table that have an earlier copy."""
    last = lines.groupBy("doc_id", "key").agg(F.max("g").alias("end"))
    first = lines.groupBy("h1", "h2").agg(F.min("g").alias("name"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    alive = stage(lines.join(first, ["h1", "h2"]).select("g", "name", "doc_id", "key", "line", "ahead", "behind"), "repeated-lines")
    ends = last.withColumnsRenamed({"doc_id": "_d", "key": "_k"})
    tails = alive.join(ends, alive.doc_id.eqNullSafe(ends._d) & (alive.key == ends._k)).select("g", "name", (F.col("end") - F.col("g") + 1).alias("tail"))
    names = stage(tails, "run-names")
    both = alive.where("ahead > 0").select(F.col("g").alias("start"), F.col("ahead").alias("m")).union(
        alive.where("behind > 0").select((F.col("g") - F.col("behind") + 1).alias("start"), F.col("behind").alias("m"))).distinct()
    ends_alive = names.select("g")
    both = both.join(ends_alive.withColumnRenamed("g", "start"), "start")
    both = stage(both.withColumn("g", F.col("start") + F.col("m") - 1).join(ends_alive, "g").drop("g"), "windows")
    longest = both.agg(F.max("m")).first()[0] or 0
    found, size = [], 1
    while size <= longest:
        here = both.where(F.col("m").between(size, 2 * size - 1)).withColumn("g", F.col("start") + F.col("m") - size)
        heads = names.select(F.col("g").alias("start"), F.col("name").alias("head"))
        named = here.join(heads, "start").join(names.select("g", F.col("name").alias("foot")), "g")
        group = named.groupBy("m", "head", "foot").agg(F.min("start").alias("first"))
        found.append(named.join(group, ["m", "head", "foot"]).where("start > first").select("start", "m"))
        size *= 2
        if size <= longest:
            names = stage(_next_names(names, size // 2), "run-names")
    if not found:
        return both.select("start", "m")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


@F.arrow_udf(returnType=_EDITED)
def _edit(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, lines in zip(texts.to_pylist(), gone.to_pylist()):
        if text is None:
            out.append({"text": None, "n_lines": 0, "removed": ""})
            continue
        split, lines = text.split("\n"), sorted(lines or ())
        cut = set(lines)
        spans = []
        for i in lines:
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        left = "\n".join(x for i, x in enumerate(split) if i not in cut)
        out.append({"text": left, "n_lines": len(split), "removed": ",".join(f"{a}:{b}" for a, b in spans)})
    return pa.array(out, type=_EDITED_ARROW)


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Replace the text by what stays; add ``n_lines``, ``n_removed`` and ``removed`` (spans of deleted lines, end exclusive)."""
    importable(df.sparkSession)
    key, d, k, missing, edited = unused(df, "_key", "_d", "_k", "_gone", "_e")
    keyed = df.withColumn(key, F.xxhash64(text))
    docs = keyed.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(key).alias("key"), F.col(text).alias("text"))
    twice = docs.groupBy("doc_id", "key").count().where("count > 1").limit(1).count()
    lines = _lines(docs.dropDuplicates(["doc_id", "key"]) if twice else docs, min_words)
    covered = repeated_windows(lines).select(F.explode(F.sequence(F.col("start"), F.col("start") + F.col("m") - 1)).alias("g")).distinct()
    gone = covered.join(lines, "g").groupBy(F.col("doc_id").alias(d), F.col("key").alias(k)).agg(F.collect_list("line").alias(missing))
    joined = keyed.join(gone, keyed[doc_id].eqNullSafe(gone[d]) & (keyed[key] == gone[k]), "left")
    done = joined.withColumn(edited, _edit(F.col(text), F.col(missing)))
    removed = F.coalesce(F.size(missing), F.lit(0)).cast("long")
    result = F.col(edited)
    return done.withColumns({text: result.text, "n_lines": result.n_lines, "n_removed": F.when(F.col(missing).isNull(), F.lit(0).cast("long")).otherwise(removed),
                             "removed": result.removed}).drop(edited, key, d, k, missing)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", "removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))

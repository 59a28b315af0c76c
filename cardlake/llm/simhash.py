"""Operator 10: SimHash near-duplicates by segment bit counts.

A fingerprint becomes 32 bit counts, one for each segment of two bits. No bit
change moves these counts by more than one, so their Manhattan distance is at
most the number of differing bits. Fingerprints within three bits are within
one step in at least one half of the counts: each half is a grid of its own,
a fingerprint is put into its cell and into the cells one step below it, and
fingerprints that meet in a cell are compared bit by bit.

Equal fingerprints are one row from the start. A cell gives a tree of links,
not its pairs: whatever is linked is taken out of further comparison, so a
dense cell costs about its size. A crowded cell is cut into blocks and each
two blocks meet in a task of their own.

Text: null counts as empty; a text without words has fingerprint zero and is
linked like any other; fewer words than a shingle make one shingle. A null id
is never a component's id unless all ids of the component are null. Repeated
rows and ids stay, each with its component. ``near_duplicates`` gives ids,
fingerprints and components only; ``one_of_each`` keeps whole rows, extra columns
included. An empty table gives an empty table. Long texts are hashed whole, in
slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.common import arrow_column, documents, importable, stage, text_of, unused
from cardlake.llm.components import components

SHINGLE, SEED, BITS = 3, 42, 3
#: Fingerprints of one cell that one task compares.
BLOCK = 1 << 17
#: Groups up to this size are compared pair by pair, all groups of a batch at once.
SMALL = 8
_SLICE = 1 << 16
_FP = T.StructType([T.StructField("fp", T.LongType())])


def fingerprint(text: str, words_each: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a text."""
    words = text.encode().lower().split()  # of bytes: lowers A-Z and splits at the six ASCII blanks only
    if not words:
        return 0
    if len(words) < words_each:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(words_each)))))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(shingles), _SLICE):
        hashed = b"".join(map(xxhash.xxh64_digest, shingles[i : i + _SLICE], repeat(SEED)))
        ones += np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big", signed=True)


def with_fingerprint(df: DataFrame, text: str = "text", column: str = "fp") -> DataFrame:
    importable(df.sparkSession)

    def run(texts: list[str]) -> list[dict]:
        return [{"fp": fingerprint(t)} for t in texts]

    return df.withColumn(column, arrow_column(run, _FP)(text_of(text)).fp)


def bit_counts(half: Column) -> Column:
    """16 fields of two bits: the number of ones in each two-bit segment of 32 bits."""
    return half - F.shiftrightunsigned(half, 1).bitwiseAND(F.lit(0x55555555))


def _steps_down(cell: Column) -> Column:
    """The cells one step below in one segment. A cell: which half, then its 16 counts."""
    steps = []
    for shift in range(0, 32, 2):
        count = F.shiftrightunsigned(cell, shift).bitwiseAND(F.lit(3))
        steps.append(F.when(count > 0, cell - F.lit(1 << shift)))
    return F.array_compact(F.array(*steps))


def _homes(fps: DataFrame) -> DataFrame:
    low = bit_counts(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    high = bit_counts(F.shiftrightunsigned("fp", 32)).bitwiseOR(F.lit(1 << 32))
    return fps.select("fp", F.explode(F.array(low, high)).alias("cell"))


def _blocks(placed: DataFrame, homes: DataFrame, block: int) -> DataFrame:
    """Give the rows of crowded cells to pairs of blocks; other cells are one block."""
    crowded = stage(homes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block), "crowded-cells")
    if not crowded.limit(1).count():
        return placed.select("cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    reach = crowded.select("n", F.explode(F.concat(F.array("cell"), _steps_down(F.col("cell")))).alias("cell"))
    parts = reach.groupBy("cell").agg(F.ceil(F.sum("n") / block).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    meets = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    spread = placed.join(parts, "cell", "left").withColumns({"own": F.coalesce(own, F.lit(0)), "other": F.explode(meets)})
    return spread.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits. Of signed numbers numpy would count the bits of the absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _tree(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within the given bits, at most one a fingerprint."""
    waiting, a, b = np.unique(fps), [], []
    while len(waiting) > 1:
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            x = front.pop()
            near = _distance(waiting, x) <= bits
            if near.any():
                found = waiting[near]
                a.append(np.full(len(found), x))
                b.append(found)
                front += list(found)
                waiting = waiting[~near]
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _links_of(key: np.ndarray, fp: np.ndarray, bits: int) -> list[np.ndarray]:
    """Links within groups; the rows of a group stand together."""
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(fp)])
    group = np.repeat(np.arange(len(starts)), sizes)
    small = sizes <= SMALL
    left, right = [], []
    for d in range(1, SMALL):
        near = (group[d:] == group[:-d]) & small[group[d:]] & (_distance(fp[d:], fp[:-d]) <= bits)
        left.append(fp[:-d][near])
        right.append(fp[d:][near])
    for s, n in zip(starts[~small], sizes[~small]):
        a, b = _tree(fp[s : s + n], bits)
        left.append(a)
        right.append(b)
    return [np.concatenate(left), np.concatenate(right)]


def links(fps: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Links a, b that connect all values of ``fp`` (each given once) within ``bits`` (three at most) bits."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves find up to three differing bits")
    importable(fps.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            key, fp = np.r_[key, np.stack(columns[:3], axis=1)], np.r_[fp, columns[3]]
            same = (key == key[-1]).all(axis=1)
            whole = len(fp) - int(np.argmin(same[::-1])) if not same.all() else 0
            if whole:
                yield pa.record_batch(_links_of(key[:whole], fp[:whole], bits), names=["a", "b"])
                key, fp = key[whole:], fp[whole:]
        if len(fp):
            yield pa.record_batch(_links_of(key, fp, bits), names=["a", "b"])

    homes = _homes(fps.select("fp"))
    placed = homes.select("fp", F.explode(F.concat(F.array("cell"), _steps_down(F.col("cell")))).alias("cell"))
    dealt = _blocks(placed, homes, block).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return dealt.mapInArrow(find, "a long, b long")


def _with_components(docs: DataFrame, bits: int) -> DataFrame:
    """Add root (a fingerprint of the component) and component_id to a stored table of doc_id, fp and more."""
    firsts = stage(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    linked = components(links(firsts, bits)).withColumnRenamed("node", "fp")
    linked = linked.union(linked.select("root", "root").distinct())
    member = linked.join(firsts, "fp")
    lowest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    component = member.join(lowest, "root").select("fp", "root", "component_id")
    alone = F.col("root").isNull()
    of_value = firsts.join(component, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(alone, F.col("first")).otherwise(F.col("component_id")).alias("component_id"))
    return docs.join(of_value, "fp")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row."""
    named = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    docs = stage(with_fingerprint(named).select("doc_id", "fp"), "fingerprints")
    found = _with_components(docs, bits)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of the smallest doc_id of each component, whole.

    Of rows with that id, one stays: the first by a hash of the row.
    """
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    named = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), row.alias("row"))
    docs = stage(with_fingerprint(named).select("doc_id", "fp", "row"), "fingerprints")
    kept = _with_components(docs, bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    one = kept.groupBy("root", F.col("component_id").alias("_id")).agg(F.min("row").alias("_row"))
    [name] = unused(df, "_hash")
    rows = df.withColumn(name, row)
    same = rows.join(one, rows[doc_id].eqNullSafe(one._id) & (rows[name] == one._row), "left_semi").drop(name)
    twice = docs.groupBy("doc_id", "row").count().where("count > 1").limit(1).count()
    return same.dropDuplicates() if twice else same


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))

"""Operator 11: MinHash near-duplicates with odd sketches.

A document's set holds its distinct word shingles, as 64-bit hashes. Documents
with equal sets are one class from the start. ``BANDS * ROWS`` MinHash samples
of a class give band keys, by which classes meet in buckets. A class that meets
another one also gets an odd sketch: ``SAMPLES`` samples folded into a bitmap of
``ODD_BITS`` parities. The set bits of the XOR of two sketches estimate their
similarity; pairs beyond ``odd_limit`` bits are dropped, all others are
confirmed on their whole sets.

A bucket never gives all its pairs at once. First each class meets the head of
a bucket that it shares most bands with, so a large group of near copies is
linked at linear cost and its buckets are done. In a bucket that still holds
two components, each class then proposes its nearest classes of other
components, in rounds, until no pair is left that is neither confirmed, refuted,
nor within a component. A pair counts in the first band that it shares alone.
Crowded buckets are cut into blocks, each two of which meet in a task of their
own. So every pair that
shares a band and passes its sketch is settled, and the components are exact
but for pairs that share no band (1.3e-7 of those at the threshold, far fewer
above it) or that the sketch estimates far too low (``RISK``).

Null text counts as empty; a document without words has an empty set and is
linked with nothing. Fewer words than a shingle make one shingle. A null id is
never a component's id unless all ids of the component are null. Repeated rows
and ids stay, each with its component; rows whose id equals the component's are
all kept. Long texts are hashed whole. An empty table gives an empty table.
Only the columns named below come out, whatever else the input holds.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.common import WORD, arrow_column, documents, importable, stage, text_of, unused
from cardlake.llm.components import components

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 40, 5
SAMPLES, ODD_BITS = 4096, 8192
#: Chance that the sketch drops a pair whose similarity is right at the threshold.
RISK = 1e-7
#: Classes of one bucket in a block, and pairs of one class that share a copy of its set.
BLOCK, SALT = 1 << 13, 1 << 10
#: Pairs that a class proposes in the first round; a later one takes all if no more than so many a class are left.
MOST, REST = 8, 256
_CELLS = 1 << 15
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SIGNED = T.StructType([
    T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])
_SHINGLES = T.StructType([
    T.StructField("shingles", T.ArrayType(T.LongType())), T.StructField("odd", T.ArrayType(T.LongType())), T.StructField("marks", T.ArrayType(T.IntegerType())),
])
#: Bits of the map by which rows that cannot be a class's first are left out before a shuffle: 16 MB at most.
MAP_BITS = 1 << 27


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of an ordered pair of them."""
    x = (a ^ (a >> np.uint64(32))) * _M1 + b
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, words_each: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes."""
    words = text.encode().lower().split()  # of bytes: lowers A-Z and splits at the six ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    each = min(words_each, len(words))
    out = hashed[: len(words) - each + 1]
    for k in range(1, each):
        out = _mix(out, hashed[k : len(words) - each + 1 + k])
    return np.unique(_mix(out, np.full(1, each, np.uint64)))


@functools.cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11)
    return draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, n, np.uint64)


def samples(shingles: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """The smallest value of each of ``n`` hash functions over the set."""
    times, plus = _functions(n)
    least, step = np.full(n, np.iinfo(np.uint64).max), max(1, _CELLS // n)
    for i in range(0, len(shingles), step):
        values = shingles[i : i + step, None] * times
        values += plus
        np.minimum(least, values.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key a band; keys of different bands differ."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = _mix(key, row)
    return key.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The parity bitmap of all samples, each taken with its number."""
    place = _mix(least, np.arange(len(least), dtype=np.uint64)) % np.uint64(ODD_BITS)
    odd = np.bincount(place.astype(np.int64), minlength=ODD_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def estimate(differing: float, n_samples: int = SAMPLES, bits: int = ODD_BITS) -> float:
    """Similarity from the set bits of the XOR of two sketches."""
    share = 2 * differing / bits
    return -1.0 if share >= 1 else 1 + bits / (4 * n_samples) * float(np.log(1 - share))


@functools.cache
def odd_limit(percent: int = PERCENT, n_samples: int = SAMPLES, bits: int = ODD_BITS, risk: float = RISK) -> int:
    """XOR bits that a pair at the threshold exceeds with at most the given chance.

    A sample that differs turns two bits. The chances of each number of odd
    bits follow turn by turn; samples differ with the threshold's distance.
    """
    odd = np.zeros(bits + 1)
    odd[0], miss = 1.0, 1 - percent / 100
    up = 1 - np.arange(bits + 1) / bits
    for _ in range(n_samples):
        turned = odd
        for _ in range(2):
            turned = np.r_[0, (turned * up)[:-1]] + np.r_[(turned * (1 - up))[1:], 0]
        odd = miss * turned + (1 - miss) * odd
    beyond = 1 - np.cumsum(odd)
    return int(np.argmax(beyond <= risk))


# --- candidates in a bucket -------------------------------------------------


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=-1, dtype=np.int64)


def _alike(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be as similar as asked for."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _nearest(band: int, cls: np.ndarray, root: np.ndarray, n: np.ndarray, odd: np.ndarray, marks: np.ndarray, most: int, percent: int) -> list[np.ndarray]:
    """For each row of a bucket its nearest later rows of other components, and how many more there are."""
    a, b, more = [], [], []
    for i in range(len(cls) - 1):
        ahead = i + 1 + np.flatnonzero((root[i + 1 :] != root[i]) & _alike(n[i + 1 :], n[i], percent))
        ahead = ahead[(marks[ahead] == marks[i]).argmax(axis=1) == band]
        far = _far(odd[ahead], odd[i])
        near = np.flatnonzero(far <= odd_limit(percent))
        chosen = near if len(near) <= most else near[np.lexsort((cls[ahead[near]], far[near]))[:most]]
        if len(chosen):
            a.append(np.full(len(chosen), cls[i]))
            b.append(cls[ahead[chosen]])
            more.append(np.full(len(chosen), len(near) - len(chosen)))
    return [np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b, more)]


def _proposals(key: np.ndarray, row: np.ndarray, odd: np.ndarray, marks: np.ndarray, most: int, percent: int) -> pa.RecordBatch:
    """Open pairs of whole buckets; the rows of one stand together."""
    band, cls, root, n = row.T
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
    out: list[list[np.ndarray]] = [[], [], [], []]
    for s, e in zip(starts, np.r_[starts[1:], len(key)]):
        found = _nearest(band[s], cls[s:e], root[s:e], n[s:e], odd[s:e], marks[s:e], most, percent)
        for to, values in zip(out, [*found, np.full(len(found[0]), key[s, 0])]):
            to.append(values)
    a, b, more, bucket = (np.concatenate(x) for x in out)
    return pa.record_batch([np.minimum(a, b), np.maximum(a, b), more, bucket], names=["a", "b", "more", "key"])


def _propose(crowd: DataFrame, most: int, percent: int) -> DataFrame:
    """Pairs a, b of open buckets (columns key, i, j, band, cls, root, n, odd, marks), with the number left for later and the bucket."""
    words = ODD_BITS // 64

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row = np.zeros((0, 3), np.int64), np.zeros((0, 4), np.int64)
        odd, marks = np.zeros((0, words), np.int64), np.zeros((0, BANDS), np.int32)
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(7)]
            key, row = np.r_[key, np.stack(columns[:3], axis=1)], np.r_[row, np.stack(columns[3:], axis=1)]
            odd = np.r_[odd, batch.column(7).flatten().to_numpy(zero_copy_only=False).reshape(-1, words)]
            marks = np.r_[marks, batch.column(8).flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)]
            same = (key == key[-1]).all(axis=1)
            whole = len(key) - int(np.argmin(same[::-1])) if not same.all() else 0
            if whole:
                yield _proposals(key[:whole], row[:whole], odd[:whole], marks[:whole], most, percent)
                key, row, odd, marks = key[whole:], row[whole:], odd[whole:], marks[whole:]
        if len(key):
            yield _proposals(key, row, odd, marks, most, percent)

    place = ["key", "i", "j"]
    dealt = crowd.select(*place, "band", "cls", "root", "n", "odd", "marks").repartition(*place).sortWithinPartitions(*place)
    return dealt.mapInArrow(find, "a long, b long, more long, key long")


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Deal the rows of crowded buckets to pairs of blocks."""
    parts = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("cls"), parts).cast("int")
    spread = rows.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), parts - 1))})
    return spread.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})


# --- pairs and components ---------------------------------------------------


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose sets are as similar as asked for; a set that many pairs ask for is copied."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT).alias("parts"))
    salted = pairs.join(parts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")))
    heads = sets.hint("merge").join(parts, sets.cls == parts.a).select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"),
        F.col("n").alias("n_a"), F.col("odd").alias("odd_a"), F.col("shingles").alias("in_a"))
    # One plan at every size: neither sets nor pairs are bounded.
    both = salted.join(sets.hint("merge"), salted.b == sets.cls).join(heads.hint("merge"), ["a", "salt"])
    far = sum((F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("odd_a")[i])) for i in range(ODD_BITS // 64)), F.lit(0))
    shared = F.size(F.array_intersect("shingles", "in_a"))
    size_fits = 100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")
    near = both.where(size_fits & (far <= odd_limit(percent)))
    return near.where(100 * shared >= percent * (F.col("n") + F.col("n_a") - shared)).select("a", "b")


def _signed(df: DataFrame, doc_id: str, text: str, words_each: int) -> DataFrame:
    """doc_id, two hashes of the text, and set size, set digest and band keys."""

    def sign(texts: list[str]) -> list[dict]:
        out = []
        for t in texts:
            own = shingle_set(t, words_each)
            keys = band_keys(samples(own)) if len(own) else []
            out.append({"n_shingles": len(own), "digest": xxhash.xxh3_128_digest(own.tobytes()), "bands": keys})
        return out

    named = _named(df, doc_id, text).withColumn("s", arrow_column(sign, _SIGNED)(F.col("text")))
    return named.select("doc_id", "k1", "k2", "s.*")


def _named(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = df.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return whole.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(11), "text")})


def _sets(df: DataFrame, classes: DataFrame, mates: DataFrame, doc_id: str, text: str, words_each: int) -> DataFrame:
    """cls, n, whole shingle set, odd sketch and marks (the upper halves of the band keys) of each class that meets another.

    The text of a class is that of its first row. A bitmap of hashed first rows,
    of bounded size, keeps most other rows out of the shuffle.
    """
    firsts = stage(classes.select("cls", "n", "first_row.*").join(mates.select("cls").distinct(), "cls"), "first-rows")
    place = F.pmod(F.xxhash64("doc_id", "k1"), F.lit(MAP_BITS))
    at = {"word": F.floor(place / 64).cast("int"), "bit": (place % 64).cast("int")}
    bits = firsts.withColumns(at).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    rows = _named(df, doc_id, text).withColumns(at).join(F.broadcast(bits), "word").where("shiftright(bits, bit) & 1 = 1")
    same = rows.doc_id.eqNullSafe(firsts.doc_id) & (rows.k1 == firsts.k1) & (rows.k2 == firsts.k2)
    found = rows.join(firsts.hint("merge"), same).select("cls", "n", "text").dropDuplicates(["cls"])

    def sets(texts: list[str]) -> list[dict]:
        out = []
        for own in (shingle_set(t, words_each) for t in texts):
            marks = (band_keys(samples(own)) >> 32).astype(np.int32)
            out.append({"shingles": own.view(np.int64), "odd": odd_sketch(samples(own, SAMPLES)), "marks": marks})
        return out

    return found.withColumn("s", arrow_column(sets, _SHINGLES)(F.col("text"))).select("cls", "n", "s.odd", "s.marks", "s.shingles")


def _followed(links: DataFrame) -> DataFrame:
    """node, root of links a, b in which each b occurs once and a is less than b: pointers, followed by doubling."""
    at = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    while True:
        next_ = at.select(F.col("node").alias("root"), F.col("root").alias("far"))
        at = stage(at.join(next_, "root", "left").select("node", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "pointers")
        if not at.where("moved").limit(1).count():
            return at.select("node", "root")
        at = at.select("node", "root")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after more links: components of the roots that these connect, then of all nodes."""
    def root_of(end: str) -> DataFrame:
        return roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))

    ends = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
    more = components(ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    moved = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("far")), "root", "left")
    return stage(moved.select("node", F.coalesce("far", "root").alias("root")).union(more), "roots")


def class_roots(df: DataFrame, classes: DataFrame, doc_id: str, text: str, words_each: int, percent: int, block: int, most: int = MOST) -> DataFrame | None:
    """The component (node, root) of each class that is linked to another; None if no two share a band."""
    # Smaller sets can only equal a similar set, and equal sets are one class.
    least = percent // (100 - percent) if percent < 100 else 1 << 62
    places = classes.where(F.col("n") >= least).select(F.posexplode("bands").alias("band", "key"), "cls")
    buckets = places.groupBy("key").agg(F.min("cls").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    mates = stage(places.join(buckets, "key"), "bucket-mates")
    if not mates.limit(1).count():
        return None
    sets = stage(_sets(df, classes, mates, doc_id, text, words_each), "shingle-sets")
    shared = mates.where("head <> cls").groupBy("cls", "head").agg(F.count(F.lit(1)).alias("bands"))
    best = shared.groupBy("cls").agg(F.max(F.struct("bands", (-F.col("head")).alias("minus"))).alias("best"))
    tried = stage(best.select((-F.col("best.minus")).alias("a"), F.col("cls").alias("b")), "first-pairs")
    roots, asked = _followed(_confirm(tried, sets, percent)), mates
    while True:
        rooted = asked.join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
        state = rooted.select("key", "band", "cls", "size", "root")
        still = state.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
        crowd = _blocks(state.join(still, "key").join(sets.select("cls", "n", "odd", "marks"), "cls"), block)
        proposed = stage(_propose(crowd, most, percent), "proposed")
        fresh = stage(proposed.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "fresh-pairs")
        found = stage(_confirm(fresh, sets, percent), "confirmed")
        if found.limit(1).count():
            roots = _joined(roots, found)
        left, rows = proposed.where("more > 0").agg(F.coalesce(F.sum("more"), F.lit(0)), F.count(F.lit(1))).first()
        if not left:
            return roots
        asked = mates.join(proposed.where("more > 0").select("key").distinct(), "key", "left_semi")
        tried, most = tried.union(fresh), most * 8 if left > REST * rows else 1 << 62


def _rooted(df: DataFrame, doc_id: str, text: str, words_each: int, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """All rows signed, and digest, first id and root of each class."""
    if not 50 <= percent <= 100:
        raise ValueError("bands are made for similarities of 50 per cent and more")
    importable(df.sparkSession)
    rows = stage(_signed(df, doc_id, text, words_each), "signed")
    grouped = rows.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "k1", "k2")).alias("first_row"),
        F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = stage(grouped.withColumn("cls", F.monotonically_increasing_id()), "classes")
    roots = class_roots(df, classes, doc_id, text, words_each, percent, block)
    firsts = classes.select("digest", "cls", "first")
    if roots is None:
        return rows, firsts.select("digest", "first", F.col("cls").alias("root"))
    placed = firsts.join(roots, F.col("cls") == F.col("node"), "left")
    return rows, placed.select("digest", "first", F.coalesce("root", "cls").alias("root"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words_each: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row; linked from ``percent`` per cent of Jaccard similarity on."""
    rows, placed = _rooted(df, doc_id, text, words_each, percent, block)
    lowest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = placed.join(lowest, "root").select("digest", "component_id")
    linked = rows.where("n_shingles > 0").join(placed, "digest").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words_each: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """The row of the smallest doc_id of each component (null last), whole; rows without words all stay.

    Of rows with that id, one stays: the first by a hash of the text, then of the row.
    """
    signed, placed = _rooted(df, doc_id, text, words_each, percent, block)
    rows = signed.where("n_shingles > 0").select("doc_id", "k1", "k2", "digest").join(placed.select("digest", "root"), "digest")
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("best"))
    differs = ~(F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("k1") == F.col("best.k1")) & (F.col("k2") == F.col("best.k2")))
    gone = stage(rows.join(best, "root").where(differs).select("doc_id", "k1", "k2").distinct(), "near-copies")
    one, two, order = unused(df, "_k1", "_k2", "_order")
    keyed = df.withColumns({one: F.xxhash64(text_of(text)), two: F.xxhash64(F.lit(11), text_of(text))})
    same = keyed[doc_id].eqNullSafe(gone.doc_id) & (keyed[one] == gone.k1) & (keyed[two] == gone.k2)
    kept = keyed.join(gone, same, "left_anti")
    if signed.where("n_shingles > 0").groupBy("doc_id", "k1", "k2").count().where("count > 1").limit(1).count():
        alike = Window.partitionBy(doc_id, one, two).orderBy(F.xxhash64(*[F.col(c) for c in df.columns]))
        numbered = kept.withColumn(order, F.row_number().over(alike))
        kept = numbered.where((F.col(order) == 1) | ~text_of(text).rlike(WORD)).drop(order)
    return kept.drop(one, two)


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words_each=2)

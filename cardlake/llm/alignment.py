"""Operator 12: alignment of two tokenizers by the byte offsets where both end a token.

Texts are encoded by both vocabularies where they lie. The shorter list of
token ends gallops through the longer one: steps grow by doubling until they
pass the next ends of the shorter list, which are then found by binary search
inside the step. Common ends cut the tokens into groups; ranks of the ends give
each group's token ranges. Texts of a batch are aligned as one, as each ends
with a common end. Within a group every A token is linked to every B token.

Each text's distinct id pairs are stored with the times they are linked. A
pair's count, the documents that hold it, is summed per task and then by a
shuffle on the pair. To bring the counts back, the pairs of highest count, at
most ``FREQUENT`` of them, go to all tasks; what a text has beyond these joins
by a shuffle on the pair. A pair outside the table is in few documents, one
inside is never shuffled by document, so no key is hot. Nothing is dropped.

Null and empty texts, and texts of which either vocabulary does not give back
the bytes, have no tokens: counts of zero and an empty digest. Repeated rows are
documents of their own; ids may repeat or be null. Long texts are encoded whole.
An empty table gives an empty table. Only the columns named below come out.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardlake.llm.bpe import BYTE_BPE, byte_bpe
from cardlake.llm.common import documents, importable, stage, text_of

PIECES = "piece_bpe_32k.model"
#: Pairs whose counts are sent to all tasks: 17 bytes each.
FREQUENT = 1 << 20
#: Ends that one galloping step looks up together.
STRIDE = 64
#: Characters of texts that are aligned together; a longer text is aligned alone.
BATCH = 1 << 19
#: Links of a group above which its distinct ids are paired, not its tokens.
WIDE = 1 << 10
#: Pairs that a task adds up before it sends them on.
HELD = 1 << 22
_CODE = 1 << 32

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
_ALIGNED = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                      ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])


class Vocabularies:
    """Both vocabularies, the bytes of their tokens, and the letters of their ids."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.library = byte_bpe(path_a), Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self.a.bytes_of
        self.bytes_b = [self._bytes(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = max(self.bytes_a) + 1, len(self.bytes_b)
        self.long_a = np.zeros(self.size_a, np.int64)
        for i, token in self.bytes_a.items():
            self.long_a[i] = len(token)
        self.long_b = np.array([len(token) for token in self.bytes_b], np.int64)
        # Each id before: another A id, the group's first B id, another B id, the next group.
        numbers = [np.array([f"{i}{mark}" for i in range(n)], object) for mark, n in ((",", self.size_a), ("|", self.size_a), (",", self.size_b), (";", self.size_b))]
        self.letters = np.concatenate(numbers)

    def _bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def ids_a(self, text: str) -> np.ndarray:
        """Ids of the text; strings of special tokens are plain text."""
        if any(s in text for s in self.a.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)
        return np.frombuffer(self.a.encode(text), "<u4").astype(np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, or none if either does not give back the bytes of the text behind a space."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        want, a, b = f" {text}".encode(), self.ids_a(f" {text}"), self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return none, none
        return a, np.array(b, np.int64)


@functools.cache
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the values that both hold; each list ascends without repeats."""
    if len(a) > len(b):
        return common_ends(b, a)[::-1]
    places, at = [], 0
    for i in range(0, len(a), STRIDE):
        keys, step = a[i : i + STRIDE], STRIDE
        while at + step < len(b) and b[at + step] < keys[-1]:
            step *= 2
        places.append(at + np.searchsorted(b[at : at + step + 1], keys))
        at = int(places[-1][-1])
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    found = np.flatnonzero((place < len(b)) & (b[np.minimum(place, len(b) - 1)] == a)) if len(b) else np.zeros(0, np.int64)
    return found, place[found]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    shift = np.cumsum(sizes) - sizes
    return np.repeat(starts - shift, sizes) + np.arange(int(sizes.sum()))


def _pair_counts(group_ends_a: np.ndarray, group_ends_b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all links: group, pair (A id times 2^32 plus B id), and times; wide groups come pair by pair."""
    first_a, first_b = np.r_[0, group_ends_a[:-1]], np.r_[0, group_ends_b[:-1]]
    p, q = group_ends_a - first_a, group_ends_b - first_b
    plain = np.flatnonzero(p * q <= WIDE)
    at_a, group = _ranges(first_a[plain], p[plain]), np.repeat(plain, p[plain])
    each = q[group]
    pair = np.repeat(ids_a[at_a], each) * _CODE + ids_b[_ranges(first_b[group], each)]
    groups, pairs, times = [np.repeat(group, each)], [pair], [np.ones(len(pair), np.int64)]
    for g in np.flatnonzero(p * q > WIDE):
        x, n_x = np.unique(ids_a[first_a[g] : group_ends_a[g]], return_counts=True)
        y, n_y = np.unique(ids_b[first_b[g] : group_ends_b[g]], return_counts=True)
        pairs.append((x[:, None] * _CODE + y[None]).ravel())
        times.append((n_x[:, None] * n_y[None]).ravel())
        groups.append(np.full(len(pairs[-1]), g))
    return np.concatenate(groups), np.concatenate(pairs), np.concatenate(times)


def align(texts: list[str], both: Vocabularies) -> list[dict]:
    """One row a text: counts, digest, and its distinct pairs with their times."""
    ids = [both.encode(t) for t in texts]
    n_a, n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
    a, b = (np.concatenate([x[k] for x in ids] or [np.zeros(0, np.int64)]) for k in (0, 1))
    end_a, end_b = common_ends(np.cumsum(both.long_a[a]), np.cumsum(both.long_b[b]))
    upto_a, upto_b = end_a + 1, end_b + 1
    to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
    # Groups of each text: its last token of A is the last of a group.
    to_group = np.searchsorted(upto_a, to_a, "right")
    n_groups = np.diff(np.r_[0, to_group])
    p, q = np.diff(np.r_[0, upto_a]), np.diff(np.r_[0, upto_b])
    links = np.r_[0, np.cumsum(p * q)]
    n_links = links[to_group] - links[to_group - n_groups]

    group, pair, times = _pair_counts(upto_a, upto_b, a, b)
    text = np.searchsorted(to_group, group, "right")
    order = np.lexsort((pair, text))
    text, pair, times = text[order], pair[order], times[order]
    new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])]) if len(pair) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, new) if len(new) else times
    pair, to_pair = pair[new], np.searchsorted(text[new], np.arange(len(texts)), "right")
    n_pairs = np.diff(np.r_[0, to_pair])

    # The letters of the groups: A tokens of a group, then its B tokens.
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[end_a], last_b[end_b] = True, True
    name_a = a + last_a * both.size_a
    name_b = b + last_b * both.size_b + 2 * both.size_a
    side = np.r_[2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1]
    letters = both.letters[np.r_[name_a, name_b][np.argsort(side, kind="stable")]].tolist()
    out = []
    for i in range(len(texts)):
        whole = slice(to_a[i] - n_a[i] + to_b[i] - n_b[i], to_a[i] + to_b[i])
        own = slice(to_pair[i] - n_pairs[i], to_pair[i])
        out.append({
            "n_a": n_a[i], "n_b": n_b[i], "n_groups": n_groups[i], "n_links": n_links[i],
            "groups_sha256": hashlib.sha256("".join(letters[whole])[:-1].encode()).hexdigest() if n_a[i] else "",
            "pairs": pair[own].astype("<i8").tobytes(), "times": times[own].astype("<i8").tobytes(),
        })
    return out


def aligned(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct pairs and their times (8-byte integers)."""
    importable(df.sparkSession)
    path_a, path_b = path_a or public_tokenizers.path(BYTE_BPE), path_b or public_tokenizers.path(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(path_a, path_b)
        for batch in batches:
            sizes = np.cumsum([len(t) for t in batch.column(1).to_pylist()])
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH, "right")))
                part = batch.slice(at, upto - at)
                made = align(part.column(1).to_pylist(), both)
                yield pa.RecordBatch.from_pylist([{"doc_id": i, **m} for i, m in zip(part.column(0).to_pylist(), made)], schema=_ALIGNED)
                at = upto

    named = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return named.mapInArrow(run, ALIGNED)


def pair_counts(docs: DataFrame) -> DataFrame:
    """a, b, n_docs, best: the documents that hold each pair, and whether no pair of its A id is in more."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def summed() -> pa.RecordBatch:
            pair, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pair >> 32, pair & (_CODE - 1), count.astype(np.int64)], names=["a", "b", "n"])

        for batch in batches:
            held.append(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8"))
            n += len(held[-1])
            if n >= HELD:
                yield summed()
                held, n = [], 0
        if n:
            yield summed()

    counts = docs.select("pairs").mapInArrow(add, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n_docs"))
    counts = stage(counts, "pair-counts")
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
    return counts.join(top, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> pd.DataFrame:
    """Pairs from the lowest count on that leaves at most ``most`` of them, by powers of two; sorted by pair."""
    power = F.floor(F.log2("n_docs")).cast("int")
    left, least = most, 64
    for p, n in counts.groupBy(power.alias("p")).count().orderBy(F.desc("p")).collect():  # 64 rows at most
        if n > left:
            break
        left, least = left - n, p
    found = counts.where(power >= least).select((F.col("a") * _CODE + F.col("b")).alias("pair"), "n_docs", "best")
    return found.toPandas().sort_values("pair", ignore_index=True)


def alignment(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document.

    n_best: links whose pair's count is the highest of its A id; count_sum: the
    counts of all links, added up.
    """
    spark = df.sparkSession
    docs = stage(aligned(df, doc_id, text, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stage(pair_counts(docs), "pair-table")
    top = _frequent(counts, frequent)
    sent = spark.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "n_docs", "best")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_docs, best = sent.value
        for batch in batches:
            pairs, times = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i8") for c in (1, 2))
            upto = np.cumsum([len(p) // 8 for p in batch.column(1).to_pylist()])
            at = np.searchsorted(known, pairs)
            at[at == len(known)] = 0
            found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            value = np.r_[0, np.cumsum(times * np.where(found, n_docs[at], 0) if len(known) else 0 * times)]
            best_ = np.r_[0, np.cumsum(times * (found & best[at]) if len(known) else 0 * times)]
            start = np.r_[0, upto[:-1]].astype(np.int64)
            lacks = ~found
            rest = [np.flatnonzero(lacks[s:e]) + s for s, e in zip(start, upto)]
            yield pa.record_batch([
                batch.column(0), pa.array(best_[upto] - best_[start]), pa.array(value[upto] - value[start]),
                pa.array([pairs[r] for r in rest], pa.list_(pa.int64())), pa.array([times[r] for r in rest], pa.list_(pa.int64())),
            ], names=["row", "n_best", "count_sum", "pairs", "times"])

    kind = "row long, n_best long, count_sum long, pairs array<long>, times array<long>"
    looked = stage(docs.select("row", "pairs", "times").mapInArrow(look_up, kind), "looked-up")
    rest = looked.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    pair = F.col("p.pairs")
    rest = rest.select("row", F.shiftright(pair, 32).alias("a"), pair.bitwiseAND(F.lit(_CODE - 1)).alias("b"), F.col("p.times").alias("times"))
    late = rest.join(counts, ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("late_best"), F.sum(F.col("times") * F.col("n_docs")).alias("late_sum"))
    sums = looked.select("row", "n_best", "count_sum").join(late, "row", "left").select(
        "row", (F.col("n_best") + F.coalesce("late_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("late_sum", F.lit(0))).alias("count_sum"))
    return docs.join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(documents(spark, sf_dir))

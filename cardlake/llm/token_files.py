"""Operator 9: token-id files in Simple-8b words.

Documents are dealt by ranges of doc_id, one range a shard, sorted, encoded and
packed; a file row holds some documents' ids as 64-bit words with the word
offset of each block of 1,024 ids. The rows are stored as Parquet, which every
shared file system takes. Reading gives back each document's ids, or their
place and checksum. Only the totals of the shards are summed over shards.

Null text counts as empty: its ids are the end id alone. A null doc_id sorts
first. Rows with the same doc_id are ordered by a hash of the text, then by the
text; repeated rows stay, one after the other. Extra columns are not written. An empty table gives files
without rows. A long document is one row, however long.
"""

from __future__ import annotations

import functools
import json
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from cardlake.llm.bpe import LETTERS, UNUSUAL
from cardlake.llm.common import checkpoint_dir, documents, importable, text_of
from cardlake.llm.simple8b import pack, unpack

WORD_BPE = "word_bpe_49k.json"
END_ID = 2
#: A file row is closed at the first document end after so many ids.
ROW_IDS = 1 << 19
#: Characters of texts that are encoded together, and bytes of known words after which a worker forgets them.
TOGETHER, HELD_BYTES = 1 << 22, 1 << 28
#: Places of the table of pairs, more than twice as many as there are merges, and a factor that spreads pairs over them.
_PLACES, _SPREAD = 1 << 18, 0x9E3779B97F4A7C15
#: Bytes of pieces that are merged together, by upper ends.
_WIDTHS = (0, 4, 8, 12, 16, 24, 40)

FILE = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("row", T.IntegerType()), T.StructField("first", T.LongType()),
    T.StructField("n_ids", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("block_words", T.ArrayType(T.LongType())), T.StructField("words", T.BinaryType()),
])
_FILE = pa.schema([("shard", pa.int32()), ("row", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                   ("lengths", pa.list_(pa.int64())), ("block_words", pa.list_(pa.int64())), ("words", pa.binary())])
_READ = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


class WordBpe:
    """A vocabulary with word ends whose pieces never reach over white space.

    New words are merged together: in each step every piece gives up its first
    pair of lowest rank, as the library does piece by piece.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Fixed value: the vocabulary file's own pattern.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.letters = {b: LETTERS[b] for b in range(256)}
        self.words: dict[str, bytes] = {}
        self.held = 0
        model, ids = json.loads(self.library.to_str())["model"], self.library.get_vocab(with_added_tokens=False)
        self.byte_ids = np.array([[ids[LETTERS[b]], ids[LETTERS[b] + model["end_of_word_suffix"]]] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged = np.array([*(ids[a + b] for a, b in pairs), 0], np.int64)
        self.none = len(pairs)
        # An open table of pairs: a pair is in the first place from its own on that is not taken by another.
        self.codes, self.ranks = np.full(_PLACES, -1, np.int64), np.full(_PLACES, self.none, np.int64)
        for rank, (a, b) in enumerate(pairs):
            code = ids[a] << 20 | ids[b]
            at = (code * _SPREAD & 0xFFFFFFFFFFFFFFFF) >> 46
            while self.codes[at] >= 0:
                at = (at + 1) % _PLACES
            self.codes[at], self.ranks[at] = code, rank

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``none`` if it is never merged or a side is missing (-1)."""
        code = left << 20 | right
        at = (code.astype(np.uint64) * np.uint64(_SPREAD) >> np.uint64(46)).astype(np.int64)
        open_ = np.flatnonzero((self.codes[at] != code) & (self.codes[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % _PLACES
            held = self.codes[at[open_]]
            open_ = open_[(held != code[open_]) & (held >= 0)]
        return np.where(self.codes[at] == code, self.ranks[at], self.none) if len(at) else at

    def _merge(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of ids, -1 behind their ends, after all merges."""
        done, rows, width = symbols.copy(), np.arange(len(symbols)), np.arange(symbols.shape[1])
        pad = np.full((len(symbols), 1), -1, np.int64)
        symbols = np.c_[symbols, pad]
        rank = np.c_[self._rank(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(done.shape), np.full(pad.shape, self.none)]
        while True:
            at = rank.argmin(axis=1)
            lowest = rank[np.arange(len(rank)), at]
            more = lowest < self.none
            done[rows[~more]] = symbols[~more, :-1]
            if not more.any():
                return done
            rows, symbols, rank, at, lowest = rows[more], symbols[more], rank[more], at[more], lowest[more]
            line = np.arange(len(rows))
            symbols[line, at] = self.merged[lowest]
            shift = np.c_[width + (width > at[:, None]), np.full((len(rows), 1), len(width))]
            symbols = np.take_along_axis(symbols, shift, axis=1)
            # Where the pair was, its ranks are gone; those around the new id are looked up.
            drop = np.c_[width + (width >= at[:, None]), np.full((len(rows), 1), len(width))]
            rank = np.take_along_axis(rank, drop, axis=1)
            rank[line, at] = self._rank(symbols[line, at], symbols[line, at + 1])
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self._rank(symbols[left, at[left] - 1], symbols[left, at[left]])

    def _learn(self, new: list[str]) -> None:
        """Ids of words not seen before; long pieces go to the library one by one."""
        whole = [w for w in new if w.isalpha()]
        parts = {w: self._pieces(w) for w in new if not w.isalpha()}
        names = list({*whole, *(p for some in parts.values() for p in some)})
        letters = [p.encode() for p in names]
        sizes = np.fromiter(map(len, letters), np.int64, len(letters))
        starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(letters), np.uint8)
        found: dict[str, bytes] = {}
        for low, high in zip(_WIDTHS, _WIDTHS[1:]):
            own = np.flatnonzero((sizes > low) & (sizes <= high))
            if not len(own):
                continue
            size, width = sizes[own, None], np.arange(high)
            raw = flat[np.minimum(starts[own, None] + width, len(flat) - 1)]
            symbols = np.where(width < size, self.byte_ids[raw, (width == size - 1).astype(np.int64)], -1)
            merged = self._merge(symbols)
            kept = merged >= 0
            ids, upto = merged[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(axis=1) * 4).tolist()
            found.update(zip(map(names.__getitem__, own.tolist()), map(ids.__getitem__, map(slice, [0, *upto], upto))))
        for i in np.flatnonzero(sizes > _WIDTHS[-1]).tolist():
            long = self.library.model.tokenize(letters[i].decode("latin-1").translate(self.letters))
            found[names[i]] = array("I", [t.id for t in long]).tobytes()
        self.words.update((w, found[w]) for w in whole)
        self.words.update((w, b"".join(map(found.__getitem__, some))) for w, some in parts.items())
        self.held += 250 * len(new) + 5 * int(sizes.sum())

    def _pieces(self, word: str) -> list[str]:
        if word[-1] in ".," and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.pattern.findall(word)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        odd = [UNUSUAL.search(t) or "<|" in t and any(s in t for s in self.special) for t in texts]
        split = [[] if strange else t.lower().split() for t, strange in zip(texts, odd)]
        if self.held > HELD_BYTES:
            self.words.clear()
            self.held = 0
        self._learn([w for w in set().union(*split) if w not in self.words])
        get = self.words.__getitem__
        out = []
        for t, words, strange in zip(texts, split, odd):
            ids = array("I", self.library.encode(t, add_special_tokens=False).ids).tobytes() if strange else b"".join(map(get, words))
            out.append(ids)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@functools.cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def _portions(names: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    """A batch in portions of about ``TOGETHER`` characters."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= TOGETHER or i == len(texts) - 1:
            yield names[start : i + 1], texts[start : i + 1]
            start, held = i + 1, 0


def write_token_files(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
                      vocabulary: str | None = None, shards: int | None = None) -> None:
    """Write the ids of all documents below ``path``, in ascending doc_id order."""
    spark = df.sparkSession
    importable(spark)
    vocabulary = vocabulary or public_tokenizers.path(WORD_BPE)
    end = array("I", [end_id]).tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, shard, row, first = word_bpe(vocabulary), TaskContext.get().partitionId(), 0, 0
        names, parts, held = [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4").astype(np.uint64)
            words, before = pack(ids)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "row": row, "first": first, "n_ids": len(ids), "doc_ids": names,
                "lengths": [len(p) // 4 for p in parts], "block_words": before.tolist(), "words": words.astype("<u8").tobytes(),
            }], schema=_FILE)

        for batch in batches:
            for some in _portions(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for name, ids in zip(some[0], bpe.encode_all(some[1])):
                    names.append(name)
                    parts.append(ids + end)
                    held += len(parts[-1]) // 4
                    if held >= ROW_IDS:
                        yield close()
                        row, first, names, parts, held = row + 1, first + held, [], [], 0
        if names:
            yield close()

    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    place = ["doc_id", F.xxhash64("text")]
    dealt = texts.repartitionByRange(n, *place).sortWithinPartitions(*place, "text")
    dealt.mapInArrow(rows, FILE).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 and, if asked for, its ids."""
    importable(spark)

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(np.frombuffer(r["words"], "<u8"), np.array(r["block_words"], np.int64), r["n_ids"]).astype("<u4")
                ends = np.cumsum(r["lengths"])
                out = []
                for name, end, n in zip(r["doc_ids"], ends.tolist(), r["lengths"]):
                    own = ids[end - n : end].tobytes()
                    out.append({"shard": r["shard"], "doc_id": name, "at": r["first"] + end - n, "n_tokens": n,
                                "ids_crc32": zlib.crc32(own), "ids": own if with_ids else None})
                yield pa.RecordBatch.from_pylist(out, schema=_READ)

    stored = spark.read.schema(FILE).parquet(path)
    kind = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long, ids binary"
    found = stored.mapInArrow(docs, kind)
    # One row a shard: as many as the files have range partitions.
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    placed = found.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("at"))
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/token-files-{uuid.uuid4().hex}"
    write_token_files(documents(spark, sf_dir), path)
    return read_token_files(spark, path)

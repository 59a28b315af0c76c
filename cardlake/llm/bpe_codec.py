"""Operator 5: BPE encoding and decoding, long texts by tree concatenation.

Texts of up to ``leaf_chars`` characters are encoded in one go. Longer ones are
cut into leaves that tasks encode in parallel; neighbouring halves are then
joined level by level. A join encodes a window of pieces around the border
anew and widens it until its first and last pieces are those of the two sides.
A piece that reaches over the border (text without any split) is joined the
same way on its tokens. Pieces and token pairs depend on nothing further away,
so the result is the encoding of the whole text.

Null text counts as empty: no ids, decoded text empty. Rows are independent:
repeated rows, null or repeated ids and extra columns pass through; an input
column named like an output column is replaced. An empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.bpe import BYTE_BPE, ByteBpe, in_use
from cardlake.llm.common import arrow_column, documents, importable, stage, text_of, unused

LEAF_CHARS = 1 << 16
#: Pieces on each side that a window starts with; a special token cut in two spans no more.
WINDOW = 4

_IDS = T.StructType([T.StructField("ids", T.BinaryType())])
_LEAF = T.StructType([T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("ids", T.BinaryType())])
_DIGEST = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
_CODED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType()), *_DIGEST.fields])
_TEXT = T.StructType([T.StructField("text", T.StringType())])


class Node:
    """Part of a text: its pieces and the ids of each."""

    def __init__(self, pieces: list[str], ids: list[list[int]]):
        self.pieces, self.ids = pieces, ids

    @classmethod
    def of(cls, bpe: ByteBpe, text: str) -> Node:
        pieces = [p for s, special in bpe.sections(text) for p in ([s] if special else bpe.pieces(s))]
        return cls(pieces, [array("I", bpe.encode(p)).tolist() for p in pieces])

    @classmethod
    def unpack(cls, text: str, sizes: list[int], counts: list[int], ids: bytes) -> Node:
        flat, pieces, out, at, n = array("I", ids).tolist(), [], [], 0, 0
        for size, count in zip(sizes, counts):
            pieces.append(text[at : at + size])
            out.append(flat[n : n + count])
            at, n = at + size, n + count
        return cls(pieces, out)

    def pack(self) -> dict:
        return {"sizes": [len(p) for p in self.pieces], "counts": [len(i) for i in self.ids],
                "ids": array("I", [x for i in self.ids for x in i]).tobytes()}


def join(bpe: ByteBpe, a: Node, b: Node) -> Node:
    """The node of both texts together."""
    k = WINDOW
    while True:
        left, right = a.pieces[-k:], b.pieces[:k]
        window = [p for s, special in bpe.sections("".join(left + right)) for p in ([s] if special else bpe.pieces(s))]
        agree_left = k >= len(a.pieces) or window[:2] == left[:2]
        agree_right = k >= len(b.pieces) or window[-2:] == right[-2:]
        if agree_left and agree_right:
            break
        k *= 2
    over = a.pieces[-1] + b.pieces[0]
    ids = [bpe.join(a.ids[-1], b.ids[0]) if p == over and p not in bpe.special else array("I", bpe.encode(p)).tolist() for p in window]
    return Node(a.pieces[: len(a.pieces) - len(left)] + window + b.pieces[len(right) :],
                a.ids[: len(a.ids) - len(left)] + ids + b.ids[len(right) :])


def encode(df: DataFrame, text: str = "text", leaf_chars: int = LEAF_CHARS, vocabulary: str | None = None) -> DataFrame:
    """Add ``ids``: the token ids as little-endian unsigned 32-bit integers."""
    importable(df.sparkSession)
    path = vocabulary or public_tokenizers.path(BYTE_BPE)

    def whole(texts: list[str]) -> list[dict]:
        with in_use(path) as bpe:
            return [{"ids": bpe.encode(t)} for t in texts]

    is_long = F.length(text_of(text)) > leaf_chars
    short = df.where(~is_long).withColumn("ids", arrow_column(whole, _IDS)(text_of(text)).ids)
    return short.unionByName(_encode_long(df.where(is_long), text, leaf_chars, path))


def _encode_long(df: DataFrame, text: str, leaf_chars: int, path: str) -> DataFrame:
    def leaves(texts: list[str]) -> list[dict]:
        with in_use(path) as bpe:
            return [Node.of(bpe, t).pack() for t in texts]

    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        """Two neighbouring nodes of one text, or the last one alone."""
        rows = rows.sort_values("leaf")
        first = rows.iloc[0]
        if len(rows) == 1:
            return pd.DataFrame([{**first.to_dict(), "leaf": first.leaf // 2}])
        a, b = (Node.unpack(r.part, r.sizes, r.counts, r.ids) for r in rows.itertuples())
        with in_use(path) as bpe:
            whole = join(bpe, a, b)
        return pd.DataFrame([{"_row": first._row, "leaf": first.leaf // 2, "part": first.part + rows.iloc[1].part, **whole.pack()}])

    # Rows get a number of their own; the written table fixes it.
    [row] = unused(df, "_row")
    rows = stage(df.drop("ids").withColumn(row, F.monotonically_increasing_id()), "long-texts")
    size = F.length(text)
    longest = rows.agg(F.max(size)).first()[0] or 0
    parts = rows.select(
        F.col(row).alias("_row"), F.posexplode(F.transform(F.sequence(F.lit(0), ((size - 1) / leaf_chars).cast("int")),
                                         lambda i: F.substring(F.col(text), i * leaf_chars + 1, F.lit(leaf_chars)))).alias("leaf", "part"),
    ).repartition("_row", "leaf")
    nodes = parts.withColumn("_n", arrow_column(leaves, _LEAF)(F.col("part"))).select("_row", "leaf", "part", "_n.*")
    nodes = stage(nodes, "leaves") if longest else nodes
    left = -(-longest // leaf_chars)
    while left > 1:
        nodes = nodes.groupBy("_row", F.floor(F.col("leaf") / 2).alias("_pair")).applyInPandas(lambda r: pair(r), nodes.schema)
        left = -(-left // 2)
    return rows.join(nodes.select(F.col("_row").alias(row), "ids"), row, "left").drop(row).withColumn("ids", F.coalesce("ids", F.lit(b"")))


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """Add the text of the ids; bytes that are no UTF-8 become replacement characters. Null ids give an empty text."""
    importable(df.sparkSession)
    path = vocabulary or public_tokenizers.path(BYTE_BPE)

    def run(values: list[bytes]) -> list[dict]:
        with in_use(path) as bpe:
            return [{"text": bpe.decode(v)} for v in values]

    return df.withColumn(text, arrow_column(run, _TEXT)(F.coalesce(F.col(ids), F.lit(b""))).text)


def with_digests(df: DataFrame, text: str = "text", leaf_chars: int = LEAF_CHARS, vocabulary: str | None = None) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoding and decoding."""
    return _coded(df, text, leaf_chars, vocabulary, _DIGEST)


def with_decoded(df: DataFrame, text: str = "text", leaf_chars: int = LEAF_CHARS, vocabulary: str | None = None) -> DataFrame:
    """Add ``ids``, the ``decoded`` text and what ``with_digests`` adds."""
    return _coded(df, text, leaf_chars, vocabulary, _CODED)


def _coded(df: DataFrame, text: str, leaf_chars: int, vocabulary: str | None, kind: T.StructType) -> DataFrame:
    path = vocabulary or public_tokenizers.path(BYTE_BPE)

    def coded(bpe: ByteBpe, ids: bytes) -> dict:
        decoded = bpe.decode(ids)
        of = {"ids": ids, "decoded": decoded, "n_tokens": len(ids) // 4, "ids_sha256": hashlib.sha256(ids).hexdigest(),
              "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest()}
        return {name: of[name] for name in kind.names}

    def of_texts(texts: list[str]) -> list[dict]:
        with in_use(path) as bpe:
            return [coded(bpe, bpe.encode(t)) for t in texts]

    def of_ids(values: list[bytes]) -> list[dict]:
        with in_use(path) as bpe:
            return [coded(bpe, v) for v in values]

    importable(df.sparkSession)
    is_long = F.length(text_of(text)) > leaf_chars
    # One Python worker a task: ids of short texts are not sent back to be read again.
    [d] = unused(df, "_d")
    short = df.where(~is_long).withColumn(d, arrow_column(of_texts, kind)(text_of(text)))
    encoded = stage(_encode_long(df.where(is_long), text, leaf_chars, path), "long-ids")
    long = encoded.withColumn(d, arrow_column(of_ids, kind)(F.col("ids"))).drop("ids")
    done = short.drop("ids").unionByName(long)
    return done.withColumns({f.name: F.col(d)[f.name] for f in kind.fields}).drop(d)


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return with_digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")

"""Operator 1: exact token counts at every prefix, by dynamic programming.

A piece's prefix counts are found once: the last token of a prefix is the one
whose pair with the last token before it is stable, and its count is one more.
Budget and truncation questions read these counts; only the few characters
around a cut are looked at again, never the whole text.

Null text counts as empty (0 bytes, 0 tokens, cut 0). Rows are independent:
repeated rows, null or repeated ids and extra columns pass through; an input
column named like an output column is replaced. An empty table gives an empty
table. Very long texts are handled whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.bpe import BYTE_BPE, Prefixes, byte_bpe
from cardlake.llm.common import arrow_column, documents, importable, text_of, unused

LIMIT = 1024
_COUNTS = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("cut_chars", T.LongType())])
_EVERY = T.StructType([T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))])


def token_counts(df: DataFrame, text: str = "text", limit: int = LIMIT, vocabulary: str | None = None) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens``, ``over_limit`` and ``cut_chars``.

    ``cut_chars``: characters of the longest prefix whose own encoding has at
    most ``limit`` tokens; the whole text where it is within the limit.
    """
    importable(df.sparkSession)
    path = vocabulary or public_tokenizers.path(BYTE_BPE)

    def count(texts: list[str]) -> list[dict]:
        bpe, out = byte_bpe(path), []
        for t in texts:
            n = bpe.count(t)
            out.append({"n_bytes": len(t.encode()), "n_tokens": n, "cut_chars": len(t) if n <= limit else Prefixes(bpe, t).cut(limit)})
        return out

    [name] = unused(df, "_counts")
    counted = df.withColumn(name, arrow_column(count, _COUNTS)(text_of(text)))
    found = F.col(name)
    return counted.withColumns({
        "n_bytes": found.n_bytes, "n_tokens": found.n_tokens,
        "over_limit": found.n_tokens > limit, "cut_chars": found.cut_chars,
    }).drop(name)


def prefix_tokens(df: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Add ``prefix_tokens``: the token count of each prefix by characters, the empty one first."""
    importable(df.sparkSession)
    path = vocabulary or public_tokenizers.path(BYTE_BPE)

    def count(texts: list[str]) -> list[dict]:
        bpe = byte_bpe(path)
        return [{"prefix_tokens": Prefixes(bpe, t).every()} for t in texts]

    return df.withColumn("prefix_tokens", arrow_column(count, _EVERY)(text_of(text)).prefix_tokens)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars")

"""Training-data pipeline: documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents, and work on every row that came in.

1. quality rules: documents that a rule rejects go.
2. line dedup: later copies of repeated line runs of 50 words or more go from
   the texts; the documents stay, with their character counts made anew.
3. near-dedup: of each group of linked documents the one with the smallest
   doc_id stays (null last; of equal ids, one by the rest of the row). Links are
   five-word shingle sets with a similarity of 0.8 or more, found by MinHash, as
   most such pairs differ in more than three bits of 64; then, of what stays,
   SimHash fingerprints that differ in three bits or fewer.
4. benchmark decontamination: documents that hold a test item go.
5. BPE encoding and decoding: token ids and their count, the text decoded from
   them, and digests of both, for what is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm import bpe_codec, decontaminate, line_dedup, minhash, quality, simhash
from cardlake.llm.common import checkpoint_dir, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(minhash.one_of_each(docs)).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_items(docs, decontaminate.benchmark(spark, sf_dir)).select(docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (little-endian unsigned 32-bit), n_tokens, ids_sha256, decoded, decoded_sha256."""
    coded = bpe_codec.with_decoded(docs)
    return coded.select("doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Shared-run deletion, connected components and BPE have no plain SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Operator 8: test items inside documents, by MinHash containment search.

Items are put into size classes by the number of their distinct five-word
shingles. A document that holds at least ``least`` of an item's shingles must
hold one of its few smallest by hash, so each item is searched by that sketch
alone; the class says how long the sketch is and how large a document must be.
What a sketch finds is verified by counting shared shingles as text.

Words are runs of letters, marks and digits in lower case. Null text counts as
empty. Fewer words than five make one shingle, so a short item is found only in
a document that consists of the same words. Items or documents without words
are never found. Documents with the same id and text give the same rows once;
null ids are kept. Repeated items are searched apart if their ids differ.
Extra columns are left alone. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.common import documents, stage, text_of
from cardlake.llm.quality import let

SHINGLE, LEAST = 5, 0.8
#: Tables of up to so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def _shingles(text: Column, make) -> Column:
    """One value for each shingle; words missing from a short text are null in its only one."""
    def all_of(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0)))
        found = F.transform(places, lambda i: make(*[F.get(w, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(w) > 0, found)

    return let(words_of(text), all_of)


def hashed_shingles(text: Column) -> Column:
    return _shingles(text, F.xxhash64)


def text_shingles(text: Column) -> Column:
    return F.array_distinct(_shingles(text, lambda *w: F.concat_ws(" ", *w)))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A hint to broadcast a stored table, if it has few rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def sketches(items: DataFrame, least: float) -> DataFrame:
    """hash, smallest: the sketch hashes and the fewest shingles of a document that can hold such an item."""
    h = F.array_sort(F.array_distinct(hashed_shingles(F.col("text"))))
    sized = items.select("item_id", h.alias("h")).where(F.size("h") > 0)
    size_class = F.floor(F.log2(F.size("h"))).cast("int")
    most, fewest = F.pow(F.lit(2), size_class + 1) - 1, F.pow(F.lit(2), size_class)
    length = F.floor(most * (1 - least) + 1e-9).cast("int") + 1
    cut = sized.select(F.ceil(fewest * least - 1e-9).alias("smallest"), F.explode(F.slice("h", F.lit(1), length)).alias("hash"))
    return cut.groupBy("hash").agg(F.min("smallest").alias("smallest"))


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """doc_id, key (text hash), item_id, n_shared, n_shingles, containment of each item found."""
    items = items.select("item_id", text_of().alias("text")).distinct()
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("key"), text_of(text).alias("text"))
    sketch = stage(sketches(items, least), "sketches")
    hashed = texts.select("doc_id", "key", hashed_shingles(F.col("text")).alias("h"))
    each = hashed.select("doc_id", "key", F.size("h").alias("n"), F.explode("h").alias("hash"))
    hits = each.join(small(sketch), "hash").where("n >= smallest").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("hits"))
    candidates = stage(hits.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k")), "candidates")
    found = small(candidates)
    held = texts.join(found, texts.doc_id.eqNullSafe(found._d) & (texts.key == found._k)).drop("_d", "_k")
    words = held.select("doc_id", "key", F.explode(text_shingles(F.col("text"))).alias("shingle"))
    own = items.select("item_id", text_shingles(F.col("text")).alias("s")).where(F.size("s") > 0)
    wanted = stage(own.select("item_id", F.size("s").cast("long").alias("n_shingles"), F.explode("s").alias("shingle")), "item-shingles")
    # Rows repeated with id and text meet here; equal shingles of one document count once.
    shared = words.join(small(wanted), "shingle").groupBy("doc_id", "key", "item_id", "n_shingles").agg(F.count_distinct("shingle").alias("n_shared"))
    return shared.withColumn("containment", F.col("n_shared") / F.col("n_shingles")).where(F.col("n_shared") >= F.col("n_shingles") * least - 1e-9)


def without_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """The documents that hold no test item."""
    hits = stage(contained(docs, items, doc_id, text, least).select(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).distinct(), "contaminated")
    found = small(hits)
    return docs.join(found, docs[doc_id].eqNullSafe(found._d) & (F.xxhash64(text_of(text)) == found._k), "left_anti")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained(documents(spark, sf_dir), benchmark(spark, sf_dir))
    return found.select("doc_id", F.col("item_id").cast(T.LongType()), "n_shared", "n_shingles", "containment")


ORACLE = r"""
WITH w AS (SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS t FROM documents UNION ALL SELECT 'i', item_id, coalesce(text, '') FROM benchmark),
s AS (SELECT kind, id, list_filter(regexp_split_to_array(lower(t), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM w),
g AS (SELECT DISTINCT kind, id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM s WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM g WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, n.n AS n_shingles, count(*) / n.n AS containment
FROM g d JOIN g i ON d.s = i.s JOIN n ON n.id = i.id WHERE d.kind = 'd' AND i.kind = 'i'
GROUP BY d.id, i.id, n.n HAVING count(*) >= 0.8 * n.n
"""

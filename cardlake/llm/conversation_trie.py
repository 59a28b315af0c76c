"""Operator 13: the prefix trie of conversations, summed by parallel tree contraction.

Turns are reduced to two hashes and a byte count when they are read. Numbers
within a conversation come from a range sort and the counts of earlier ranges,
and a prefix is named by its length and the XOR of its turns' hashes, each taken
with its place; both split over tasks, so one conversation may hold most rows.
A node is a group of equal prefixes, counted before it is shuffled.

Subtree sums come in rounds of joins on the tree of live nodes. Rake: leaves
give their sums to their parents and go. Compress: of each chain of nodes with
one child, those go that win against their neighbours (by a bit of their depth,
then by a hash: half of a plain chain each round); the child takes over what lay
between. So rounds grow with the logarithm of the nodes, however deep the tree.
Each node that goes notes on which node its sum still depends; at the end these
notes are followed by doubling, and every node has its total.

Rows go by turn, null first; rows with the same turn go by a hash of role and
text. Null role or text counts as empty. Rows without a conversation id belong
to no conversation and are left out. Repeated rows are turns of their own. An
empty table has the root alone, without members. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake.llm.common import importable, stage

#: Turns of a conversation whose prefixes one task names.
BLOCK = 1024
#: The contract of the query: conversations share the first turns of the next lower id divisible by this ...
FAMILY = 5
#: ... fewer than so many of them.
HEADS = 9


# --- conversations ----------------------------------------------------------


def numbered(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, k (from 1), t1, t2 (hashes of role and text), n_bytes: the turns of each conversation in order."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    turns = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(*said).alias("t1"),
        F.xxhash64(F.lit(13), *said).alias("t2"), F.octet_length(said[1]).cast("long").alias("n_bytes"))
    turns = stage(turns.withColumn("u", F.monotonically_increasing_id()), "turns")
    order = ["conv_id", "turn", "t1", "t2", "u"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stage(dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ordered-turns")
    runs = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    # One row a conversation and range: at most as many for one conversation as there are ranges.
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    runs = runs.select("conv_id", "part", (F.lit(1) + before - F.col("first")).alias("shift"))
    return dealt.join(runs, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("k"), "t1", "t2", "n_bytes")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn (conv_id, k, t1, t2, n_bytes) with x1, x2, the name of the prefix that it ends, and p1, p2, the one before."""
    h = {c: F.xxhash64(F.col(c), F.col("k")) for c in ("t1", "t2")}
    salted = turns.select("conv_id", "k", "n_bytes", *[v.alias(c) for c, v in h.items()], F.floor((F.col("k") - 1) / BLOCK).alias("block"))
    blocks = salted.groupBy("conv_id", "block").agg(F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"))
    upto = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"b{i}").over(upto), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    inside = Window.partitionBy("conv_id", "block").orderBy("k")
    named = salted.join(blocks, ["conv_id", "block"])
    named = named.withColumns({f"x{i}": F.col(f"b{i}").bitwiseXOR(F.bit_xor(f"t{i}").over(inside)) for i in (1, 2)})
    return named.select("conv_id", "k", "n_bytes", "x1", "x2", *[F.col(f"x{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2)])


def trie_nodes(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes: node, parent (null: root), depth, conv_id (smallest member), n_convs, n_bytes of the last text, x1, x2.

    ``steps`` are rows of ``prefixes``; ``convs`` holds each conv_id once, those without turns too.
    """
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("conv_id").alias("n_convs")).select(
        F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("x1", "x2")],
        *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")], "conv_id", "n_convs", F.lit(0).cast("long").alias("n_bytes"))
    below = steps.groupBy(F.col("k").alias("depth"), "x1", "x2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("n_bytes").alias("n_bytes"))
    nodes = stage(root.unionByName(below).withColumn("node", F.monotonically_increasing_id()), "trie-nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("node").alias("parent"))
    return stage(nodes.join(up, ["depth", "p1", "p2"], "left").select("node", "parent", "depth", "conv_id", "n_convs", "n_bytes", "x1", "x2"), "trie")


# --- tree contraction -------------------------------------------------------


def _winners(chain: DataFrame, turn: int) -> DataFrame:
    """Of nodes with one child (node, parent, depth) a set without neighbours: those that lose to none."""
    bit = F.shiftright("depth", min(turn, 62)).bitwiseAND(F.lit(1))
    weight = F.struct(bit, F.xxhash64("node", F.lit(turn)), F.col("node"))
    rank = chain.select("node", "parent", weight.alias("w"))
    above = rank.select(F.col("node").alias("top"), F.col("w").alias("w_top"))
    met = rank.join(above, F.col("parent") == F.col("top"))
    losers = met.select(F.when(F.col("w") < F.col("w_top"), F.col("node")).otherwise(F.col("top")).alias("node"))
    return chain.join(losers.distinct(), "node", "left_anti").select("node")


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """node and, under their own names, the values summed over each node's subtree.

    ``tree``: node, parent (null for roots), depth, and the values (long). Every
    parent is a node; there are no cycles.
    """
    zero = F.lit(0).cast("long")

    def summed(fn) -> list[Column]:
        return [fn(v).alias(v) for v in values]

    live = stage(tree.select("node", "parent", F.col("depth").cast("long").alias("depth"), *values, *[zero.alias(f"edge_{v}") for v in values]), "tree-live")
    notes, turn = [], 0
    while live.limit(1).count():
        inner = live.where("parent is not null").select(F.col("parent").alias("node")).distinct()
        leaves = live.join(inner, "node", "left_anti")
        notes.append(stage(leaves.select("node", F.lit(None).cast("long").alias("to"), *values), "tree-notes"))
        marked = live.join(notes[-1].select("node", F.lit(True).alias("leaf")), "node", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False)))
        # What leaves give their parent, and the one child of a node that has one left.
        below = marked.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            F.count_if(~F.col("leaf")).alias("children"), F.min(F.when(~F.col("leaf"), F.col("node"))).alias("child"),
            *[F.coalesce(F.sum(F.when(F.col("leaf"), F.col(v) + F.col(f"edge_{v}"))), zero).alias(f"got_{v}") for v in values])
        rest = live.join(below, "node").select(
            "node", "parent", "depth", "children", "child", *summed(lambda v: F.col(v) + F.col(f"got_{v}")), *[f"edge_{v}" for v in values])
        rest = stage(rest, "tree-raked")
        chain = rest.where("children = 1 and parent is not null").select("node", "parent", "depth")
        out = rest.join(_winners(chain, turn), "node").select(
            F.col("node").alias("gone"), F.col("parent").alias("over"), F.col("child").alias("node"),
            *[F.col(v).alias(f"own_{v}") for v in values], *[F.col(f"edge_{v}").alias(f"up_{v}") for v in values])
        out = stage(out, "tree-spliced")
        joined = rest.join(out, "node", "left")
        lower = joined.where("gone is not null")
        notes.append(stage(lower.select(F.col("gone").alias("node"), F.col("node").alias("to"), *summed(lambda v: F.col(f"own_{v}") + F.col(f"edge_{v}"))), "tree-notes"))
        spliced = F.col("gone").isNotNull()
        left = joined.select(
            "node", F.when(spliced, F.col("over")).otherwise(F.col("parent")).alias("parent"), "depth", *values,
            *[F.when(spliced, F.col(f"edge_{v}") + F.col(f"own_{v}") + F.col(f"up_{v}")).otherwise(F.col(f"edge_{v}")).alias(f"edge_{v}") for v in values])
        live = stage(left.join(out.select(F.col("gone").alias("node")), "node", "left_anti"), "tree-live")
        turn += 1
    return _followed(notes, values)


def _followed(notes: list[DataFrame], values: list[str]) -> DataFrame:
    """Add up the notes (node, to, values) along ``to``, by doubling."""
    done, open_ = None, None
    for note in notes:
        done = note if done is None else done.union(note)
    done = stage(done, "tree-sums") if done is not None else None
    while done is not None and done.where("to is not null").limit(1).count():
        next_ = done.select(F.col("node").alias("to"), F.col("to").alias("next"), *[F.col(v).alias(f"more_{v}") for v in values])
        open_ = done.where("to is not null").join(next_, "to")
        doubled = open_.select("node", F.col("next").alias("to"), *[(F.col(v) + F.col(f"more_{v}")).alias(v) for v in values])
        done = stage(done.where("to is null").unionByName(doubled), "tree-sums")
    return done.select("node", *values)


# --- the trie ---------------------------------------------------------------


def trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of numbered turns: its nodes with all totals, and the last node of each conversation.

    Nodes: node, parent, depth, conv_id (smallest member), parent_conv_id,
    n_convs, n_children, n_leaves (childless nodes below or here) and
    saved_tokens (bytes that sharing the nodes of the subtree saves). Ends:
    conv_id, depth, x1, x2 of its whole prefix.
    """
    steps = stage(prefixes(turns), "prefixes")
    nodes = trie_nodes(steps, convs)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    full = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    full = stage(full, "trie-full")
    leaf = (F.col("n_children") == 0).cast("long")
    saved = F.when(F.col("n_convs") > 0, F.col("n_convs") - 1).otherwise(0) * F.col("n_bytes")
    sums = subtree_sums(full.select("node", "parent", "depth", leaf.alias("n_leaves"), saved.alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    totals = full.join(sums, "node").join(parents, "parent", "left")
    last = steps.groupBy("conv_id").agg(F.max(F.struct("k", "x1", "x2")).alias("last"))
    zero = F.lit(0).cast("long")
    ends = convs.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("last.k", zero).alias("depth"), F.coalesce("last.x1", zero).alias("x1"), F.coalesce("last.x2", zero).alias("x2"))
    return totals, ends


def conversation_trie(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens of each node of the conversations' trie."""
    turns = stage(numbered(df, conv_id, turn, role, text), "numbered-turns")
    nodes, _ = trie(turns, turns.select("conv_id").distinct())
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


# --- the query --------------------------------------------------------------


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query's conversations from numbered turns: rebuilt turns, and every conv_id."""
    sizes = stage(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversation-sizes")
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), heads.alias("h"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stage(convs.select("conv_id", "base", "h", "taken"), "conversations")
    shared = turns.where(F.col("k") < HEADS).select(F.col("conv_id").alias("base"), "k", "t1", "t2", "n_bytes")
    first = shared.join(convs, "base").where("k <= h").select("conv_id", "k", "t1", "t2", "n_bytes")
    own = turns.join(convs, "conv_id").where("k > h").select("conv_id", (F.col("taken") + F.col("k") - F.col("h")).alias("k"), "t1", "t2", "n_bytes")
    return first.union(own), convs.select("conv_id")


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, x1, x2 and ends_sha256: a digest of the ids of the conversations that end at a node, in order.

    A digest is made id by id, so the ids of one node pass through one task;
    they are sorted on disk and never held.
    """
    importable(ends.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, made, digest = None, [], None
        for batch in batches:
            for *place, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if place != at:
                    if at is not None:
                        made.append((*at, digest.hexdigest()))
                    at, digest = place, hashlib.sha256(str(conv_id).encode())
                else:
                    digest.update(f",{conv_id}".encode())
            if made:
                yield pa.record_batch(list(zip(*made)), names=["depth", "x1", "x2", "ends_sha256"])
                made = []
        if at is not None:
            yield pa.record_batch([[v] for v in (*at, digest.hexdigest())], names=["depth", "x1", "x2", "ends_sha256"])

    place = ["depth", "x1", "x2"]
    dealt = ends.select(*place, "conv_id").repartition(*place).sortWithinPartitions(*place, "conv_id")
    return dealt.mapInArrow(digests, "depth long, x1 long, x2 long, ends_sha256 string")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(numbered(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "numbered-turns")
    made, convs = rebuilt(turns)
    nodes, ends = trie(made, convs)
    full = nodes.join(end_digests(ends), ["depth", "x1", "x2"], "left")
    digest = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest.alias("ends_sha256"))

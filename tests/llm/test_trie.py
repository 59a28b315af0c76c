"""Operator 13 against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import SF

from cardlake.llm import conversation_trie as trie
from cardlake.llm.conversation_trie import op13_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, node long, parent long, k long, part int"


def nodes(convs):
    """All columns of the query for conversations given as tuples of (role, text)."""
    members, below = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                below[turns[: d - 1]].add(turns[:d])
    leaves, saved = {}, {}
    for at in sorted(members, key=len, reverse=True):
        leaves[at] = sum(leaves[x] for x in below[at]) or 1
        own = (len(members[at]) - 1) * len(at[-1][1].encode()) if at else 0
        saved[at] = own + sum(saved[x] for x in below[at])
    out = []
    for at, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(at))))
        up = min(members[at[:-1]]) if at else None
        out.append((min(ids), len(at), up, len(ids), len(below[at]), leaves[at], saved[at], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: tuple(said for _, said in sorted(v, key=lambda x: x[0])) for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, ())[:h] + turns[h:]
    return out


def test_op13_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = op13_conversation_trie(spark, SF)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == nodes(rebuilt(ordered(map(tuple, rows))))


def test_trie_of_hard_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 7)
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", None, ""]), r.choice(["a", "é", "", None])) for c in range(20) for t in range(r.randint(1, 5))]
    rows += [(100, None, "user", "first"), (100, 0, "user", "a"), (101, None, None, None)]
    rows += [(c, t, "user", f"long {t}") for c in (200, 201) for t in range(30)] + [(201, 30, "user", "x" * 100000)]
    r.shuffle(rows)
    table = spark.createDataFrame([(*x, 7, 7, 7, 7) for x in [*rows, (None, 1, "user", "no id")]], SCHEMA)
    got = trie.conversation_trie(table)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((x[:-1] for x in nodes(ordered(rows))), key=str)


def test_turns_with_one_number_keep_one_order(spark):
    rows = [(c, 1, "user", t) for c in (1, 2) for t in ("x", "y", "x", "z")]
    tables = [spark.createDataFrame([(*x, 1, 1, 1, 1) for x in p], SCHEMA).repartition(3) for p in (rows, rows[::-1])]
    a, b = (sorted(map(tuple, trie.conversation_trie(t).collect()), key=str) for t in tables)
    assert a == b and len(a) == 5 and all(x[3] == 2 for x in a)


def test_empty_table_has_a_root(spark):
    got = trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect()
    assert [tuple(x) for x in got] == [(None, 0, None, 0, 0, 1, 0)]


@pytest.mark.parametrize("shape", ["path", "random", "caterpillar"])
def test_contraction_sums_every_subtree(spark, shape, monkeypatch):
    n, r, rounds = 34, random.Random(6), []
    up = {"path": lambda i: i - 1, "random": lambda i: r.randrange(i), "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2)}[shape]
    parent = {0: None} | {i: up(i) for i in range(1, n)}
    depth = {0: 0}
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    want = {i: [1, i] for i in range(n)}
    for i in range(n - 1, 0, -1):
        for k in (0, 1):
            want[parent[i]][k] += want[i][k]
    real = trie._winners
    monkeypatch.setattr(trie, "_winners", lambda chain, turn: rounds.append(turn) or real(chain, turn))
    tree = spark.createDataFrame([(i, parent[i], depth[i], 1, i) for i in range(n)], "node long, parent long, depth long, n long, s long")
    got = {x.node: [x.n, x.s] for x in trie.subtree_sums(tree, ["n", "s"]).collect()}
    assert got == want and len(rounds) <= 9

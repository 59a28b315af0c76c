"""Operator 11 against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from conftest import SF
from llm.helpers import HARD, table, words

from cardlake.llm import minhash
from cardlake.llm.minhash import op11_minhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, each):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + each]) for i in range(len(w) - each + 1)) if len(w) >= each else frozenset([tuple(w)] if w else [])


def brute(texts, each, percent=80):
    """(n_shingles, component_id) by id, comparing all pairs that share a shingle."""
    sets, root, holders = {i: shingles(t, each) for i, t in texts.items()}, {i: i for i in texts}, defaultdict(list)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in texts}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_op11_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op11_minhash(spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    want = brute(texts, 2)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and any(not r.kept for r in rows)


@pytest.fixture(scope="module")
def crowd():
    """Chains of near copies, boilerplate just below the threshold, short sets at it, copies."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    texts, now = [], list(base)
    for _ in range(40):
        now[r.randrange(60)] = f"v{r.randrange(9999)}"
        texts.append(" ".join(now))
    texts += [" ".join(base[:48] + [f"x{k}_{i}" for i in range(14)]) for k in range(30)]
    texts += ["a b c d", "a b c d e", "a b c d e f", "A B C D", "q", "Q", "q q"]
    texts += [" ".join(base)] * 25 + ["", None, "  "]
    return dict(enumerate(texts))


@pytest.mark.parametrize("block", [8, 1 << 13])
def test_crowded_buckets_in_blocks_and_rounds(spark, crowd, block):
    got = minhash.near_duplicates(table(spark, list(crowd.values())), words_each=2, block=block)
    assert found(got) == brute(crowd, 2)


def test_rounds_settle_all_pairs_of_a_bucket(spark, crowd, monkeypatch):
    monkeypatch.setattr(minhash.class_roots, "__defaults__", (1,))
    assert found(minhash.near_duplicates(table(spark, list(crowd.values())), words_each=2)) == brute(crowd, 2)


def test_hard_rows(spark):
    long = " ".join(f"n{i % 7001}" for i in range(30000))
    texts = [*HARD, long, long + " z", "tie a b c d e f", "TIE a b c d e f"]
    got = found(minhash.near_duplicates(table(spark, texts), words_each=5))
    assert got == brute(dict(enumerate(texts)), 5)
    ids = [None, None, 3, 3, None]
    rows = minhash.near_duplicates(table(spark, ["a b c d e f", "a b c d e f", "a b c d e f", "other", None], ids)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in rows) == [
        ("3", 1, "3", True), ("3", 2, "3", True), ("None", 0, "None", True), ("None", 2, "3", False), ("None", 2, "3", False)]
    only = minhash.near_duplicates(table(spark, ["same words here"] * 2, [None, None])).collect()
    assert [(r.component_id, r.kept) for r in only] == [(None, True)] * 2
    assert minhash.near_duplicates(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        minhash.near_duplicates(table(spark, []), percent=40)


def test_one_of_each_keeps_whole_rows(spark, crowd):
    df = table(spark, list(crowd.values()))
    got = minhash.one_of_each(df, words_each=2)
    want = {i for i, (n, root) in ((k, (v[0], v[1])) for k, v in brute(crowd, 2).items()) if n == 0 or root == i}
    assert got.columns == df.columns and {r.doc_id for r in got.collect()} == want
    assert sorted(map(str, got.collect())) == sorted(map(str, df.where(F.col("doc_id").isin(list(want))).collect()))
    texts = ["a b c d e f", "a b c d e f", "a b c d e f", "a b c d e f", "", "", None]
    rows = minhash.one_of_each(table(spark, texts, [None, 3, 3, 4, 5, 5, None])).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows if r.text) == [("3", "a b c d e f")] and len(rows) == 4
    assert minhash.one_of_each(table(spark, [])).count() == 0


def test_odd_sketches_estimate_similarity():
    r = np.random.default_rng(2)
    limit = minhash.odd_limit()
    for share in (0.8, 0.9, 0.97):
        off = []
        for _ in range(60):
            both, apart = int(800 * share), 800 - int(800 * share)
            pool = r.integers(0, 1 << 63, both + apart, np.uint64)
            a, b = pool[: both + apart // 2], np.r_[pool[:both], pool[both + apart // 2 :]]
            x, y = (minhash.odd_sketch(minhash.samples(np.unique(s), minhash.SAMPLES)) for s in (a, b))
            far = int(minhash._far(x, y))
            assert far <= limit
            off.append(minhash.estimate(far) - share)
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.02
    assert minhash.estimate(0) == 1 and minhash.odd_limit(percent=90) < limit

"""Operators 2, 8 and 10 and the pipeline against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash
from conftest import SF, rows as sorted_rows
from llm.helpers import HARD, table, words
from llm.test_minhash import brute

import corpus_pipeline
from cardlake.llm import decontaminate, line_dedup, simhash
from cardlake.llm.components import components
from cardlake.llm.line_dedup import op2_line_dedup
from cardlake.llm.simhash import op10_simhash


def stored(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# --- line dedup -------------------------------------------------------------


def cleaned(texts, least):
    """Texts by id after deleting every repeated run that has an earlier copy, by comparing all places."""
    seq = [(i, line) for i in sorted(texts, key=lambda i: (i is not None, i)) for line in (texts[i] or "").split("\n")]
    places, gone = defaultdict(list), set()
    for g, (i, line) in enumerate(seq):
        best = 0
        for j in places[line]:
            n = 0
            while g + n < len(seq) and seq[g + n][0] == i and seq[j + n] == (seq[j][0], seq[g + n][1]):
                n += 1
            best = max(best, n)
        places[line].append(g)
        if best and sum(len(words(x)) for _, x in seq[g : g + best]) >= least:
            gone |= set(range(g, g + best))
    kept = defaultdict(list)
    for g, (i, line) in enumerate(seq):
        if g not in gone:
            kept[i].append(line)
    return {i: None if texts[i] is None else "\n".join(kept[i]) for i in texts}


@pytest.mark.parametrize("least,seed", [(1, 1), (4, 2), (9, 3)])
def test_line_runs_equal_brute_force(spark, least, seed):
    r = random.Random(seed)
    lines = ["", "a", "b b", "c c c", "d d d d", "e", "f f f f f f f f f f"]
    texts = {i: "\n".join(r.choices(lines, k=r.randint(1, 14))) for i in range(25)}
    texts |= {25: texts[3], 26: None, 27: "", 28: "z\n" * 40}
    df = table(spark, list(texts.values()), list(texts))
    got = line_dedup.dedup_lines(df, min_words=least)
    assert got.columns == [*df.columns, "n_lines", "n_removed", "removed"]
    assert {r.doc_id: r.text for r in got.collect()} == cleaned(texts, least)


def test_line_dedup_of_hard_rows(spark):
    long = "\n".join(f"line {i % 900} has five words" for i in range(1800))
    same = [*HARD, long, long]
    got = line_dedup.dedup_lines(table(spark, same, [None, None, *range(len(same) - 2)]), min_words=5).collect()
    assert len(got) == len(same)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    first, second = by_id[len(same) - 4], by_id[len(same) - 3]
    assert (first.n_removed, first.removed, second.text) == (900, "900:1800", "")
    twice = table(spark, ["x y z w v", "x y z w v"], [1, 1])
    assert [r.text for r in line_dedup.dedup_lines(twice, min_words=5).collect()] == ["x y z w v"] * 2
    assert line_dedup.dedup_lines(table(spark, []), min_words=5).count() == 0


def test_op2_equals_brute_force(spark):
    texts = stored(spark)
    want = cleaned(texts, line_dedup.MIN_WORDS)
    got = {r.doc_id: r for r in op2_line_dedup(spark, SF).collect()}
    assert set(got) == set(texts) and any(r.n_removed for r in got.values())
    for i, r in got.items():
        assert r.text_sha256 == hashlib.sha256((want[i] or "").encode()).hexdigest()


# --- SimHash ----------------------------------------------------------------


def fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values):
    """Smallest index within reach of each value at three bits or fewer."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def test_op10_equals_brute_force(spark):
    texts = stored(spark)
    ids = sorted(texts)
    values = [fingerprint(texts[i]) for i in ids]
    want = {i: (f"{v:016x}", ids[r]) for i, v, r in zip(ids, values, roots(values))}
    got = op10_simhash(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(ids)


@pytest.mark.parametrize("block", [1 << 17, 8])
def test_links_connect_what_brute_force_connects(spark, block):
    r = random.Random(7)
    values = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(40):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):  # dense groups
            values.add(x)
            for b in r.sample(range(64), r.randint(1, 4)):
                x ^= 1 << b
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r.node: r.root for r in components(simhash.links(df, block=block)).collect()}
    want = roots(values)
    same = defaultdict(set)
    for v, root in zip(signed, want):
        same[root].add(v)
    for group in same.values():
        assert {found.get(v, v) for v in group} == {min(group)}


def test_simhash_of_hard_rows(spark):
    ids = [None, None, *range(len(HARD) - 2)]
    got = simhash.near_duplicates(table(spark, HARD, ids)).collect()
    assert len(got) == len(HARD)
    empty = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert empty == {0} and sum(r.fingerprint == "0" * 16 for r in got) == sum(not words(t) for t in HARD)
    assert simhash.near_duplicates(table(spark, [])).count() == 0
    kept = simhash.one_of_each(table(spark, [*HARD, *HARD], [*ids, *ids]))
    assert kept.count() == len({r.fingerprint for r in got}) and kept.columns == table(spark, []).columns


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (None, 3), (100, 99)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 100: 99}
    assert components(edges.limit(0)).count() == 0


# --- decontamination --------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_containment_equals_brute_force(spark):
    r = random.Random(2)
    vocabulary = ["ab", "cd", "ef", "gh", "ij", "kl"]
    items = [" ".join(r.choices(vocabulary, k=n)) for n in (1, 3, 5, 6, 9, 17, 30, 30, 60)] + ["", None, "!!"]
    docs = [None, "", "ab", *[" ".join(r.choices(vocabulary, k=r.randint(1, 400))) for _ in range(30)]]
    for item in items[3:9]:
        w = item.split()
        for drop in (0, 1, 3):
            docs.append("Start here. " + " ".join(w[: len(w) - drop]).upper() + ", and on. " * 50)
    docs += [items[1], items[1] + "!"]
    df, wanted = table(spark, docs), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in decontaminate.contained(df, wanted).collect()}
    want = {}
    for i, d in enumerate(docs):
        for j, t in enumerate(items):
            n, have = len(shingles(t)), len(shingles(t) & shingles(d))
            if n and have >= 0.8 * n - 1e-9:
                want[i, j] = (have, n)
    assert got == want and len(want) > 15
    left = decontaminate.without_items(df, wanted)
    assert {r.doc_id for r in left.collect()} == set(range(len(docs))) - {i for i, _ in want}
    assert left.columns == df.columns


def test_containment_with_null_ids_repeated_rows_and_empty_tables(spark):
    item = "one two three four five six seven"
    df = table(spark, [item, item, item, "other words", None], [None, None, 3, 3, None])
    wanted = spark.createDataFrame([(1, item), (1, item), (2, item)], "item_id long, text string")
    got = decontaminate.contained(df, wanted)
    assert sorted_rows(got, "doc_id", "item_id") == [(3, 1), (3, 2), (None, 1), (None, 2)]
    assert decontaminate.without_items(df, wanted).count() == 2
    assert decontaminate.contained(df.limit(0), wanted).count() == 0
    assert decontaminate.without_items(df, wanted.limit(0)).count() == 5


# --- pipeline ---------------------------------------------------------------


def test_stages_on_hard_rows(spark, path):
    docs = spark.createDataFrame(
        [(i, t, "en", "s", 0) for i, t in enumerate(HARD)] + [(None, None, None, None, None)] * 2, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, SF)
            assert name == "bpe_encoding" or out.columns == docs.columns
            assert out.count() <= given.count()


def test_pipeline_equals_its_stages_by_brute_force(spark):
    from tokenizers import Tokenizer

    import public_tokenizers
    from cardlake.llm.bpe import BYTE_BPE

    texts = {r.doc_id: r.text for r in stored_rows(spark) if good(r.text)}
    texts = cleaned(texts, line_dedup.MIN_WORDS)
    near = brute(texts, 5)
    texts = {i: t for i, t in texts.items() if not near[i][0] or near[i][1] == i}
    ids = sorted(texts)
    root = roots([fingerprint(texts[i]) for i in ids])
    texts = {i: texts[i] for k, i in enumerate(ids) if root[k] == k}
    items = [shingles(r.text) for r in decontaminate.benchmark(spark, SF).collect()]
    texts = {i: t for i, t in texts.items() if not any(s and len(s & shingles(t)) >= 0.8 * len(s) for s in items)}
    library = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_last_stage_decodes_its_ids(spark):
    from array import array

    from tokenizers import Tokenizer

    import public_tokenizers
    from cardlake.llm.bpe import BYTE_BPE

    library = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    long = "two words of many 漢字 \n" * 4000  # longer than a leaf
    texts = {**stored(spark), -1: long, -2: None}
    got = corpus_pipeline.bpe_encoding(spark, table(spark, list(texts.values()), list(texts)), SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert array("I", r.ids).tolist() == ids and r.n_tokens == len(ids) and r.decoded == decoded, r.doc_id
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() and r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def stored_rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def good(text):
    from llm.test_rules import plain_measures

    m = plain_measures(text)
    return not (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] or 10 * m["n_symbols"] > m["n_words"]
                or 2 * m["n_dup_lines"] > m["n_lines"] or not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"])

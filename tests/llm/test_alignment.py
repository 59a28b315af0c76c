"""Operator 12 against the two libraries and brute force."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF
from llm.helpers import HARD, table
from tokenizers import Tokenizer

from cardlake.llm import alignment
from cardlake.llm.alignment import op12_alignment
from cardlake.llm.bpe import LETTERS


def brute(texts):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    back = {c: b for b, c in enumerate(LETTERS)}

    def bytes_b(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()

    groups, held = [], Counter()
    for t in texts:
        a, b = (lib.encode(" " + t, add_special_tokens=False).ids, pieces.encode(t)) if t else ([], [])
        in_a, in_b = [bytes(back[c] for c in lib.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
        own = []
        if t and b"".join(in_a) == b"".join(in_b) == (" " + t).encode():
            end_a, end_b = list(accumulate(map(len, in_a))), list(accumulate(map(len, in_b)))
            last = 0
            for end in sorted({*end_a} & {*end_b}):
                own.append(([i for i, e in zip(a, end_a) if last < e <= end], [i for i, e in zip(b, end_b) if last < e <= end]))
                last = end
        groups.append(own)
        held.update({(x, y) for g in own for x in g[0] for y in g[1]})
    top = {}
    for (x, _), n in held.items():
        top[x] = max(n, top.get(x, 0))
    out = []
    for own in groups:
        links = [(x, y) for g in own for x in g[0] for y in g[1]]
        letters = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in own)
        out.append((sum(len(g[0]) for g in own), sum(len(g[1]) for g in own), len(own), len(links), sum(held[p] == top[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(letters.encode()).hexdigest() if own else ""))
    return out


def test_op12_equals_the_libraries(spark):
    stored = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = op12_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted((r.doc_id, *x) for r, x in zip(stored, brute([r.text for r in stored])))


MORE = ["▁ in a text", "<s> and </s> <unk>", "<0x41>", "null \x00 byte", "Ａ １ ﬁ ﻿", " " * 3000, "\n" * 700, "漢字" * 400, "🙂" * 300]


@pytest.mark.parametrize("frequent", [1 << 20, 40, 0])
def test_hard_texts_with_few_and_many_pairs_sent(spark, frequent, monkeypatch):
    monkeypatch.setattr(alignment, "HELD", 100)
    monkeypatch.setattr(alignment, "BATCH", 300)
    texts = [*HARD, *MORE]
    got = alignment.alignment(table(spark, texts), frequent=frequent).collect()
    assert sorted(map(tuple, got)) == [(i, *x) for i, x in enumerate(brute(texts))]


def test_wide_groups_count_as_their_tokens(monkeypatch):
    a, b = np.array([5, 5, 6, 7], np.int64), np.array([1, 2, 2, 9], np.int64)
    ends = np.array([3, 4]), np.array([3, 4])
    plain = alignment._pair_counts(*ends, a, b)
    monkeypatch.setattr(alignment, "WIDE", 1)
    wide = alignment._pair_counts(*ends, a, b)

    def summed(x):
        c = Counter()
        for g, p, n in zip(*(v.tolist() for v in x)):
            c[g, p] += n
        return c

    assert summed(plain) == summed(wide) and sum(summed(wide).values()) == 10


def test_repeated_null_and_no_rows(spark):
    rows = alignment.alignment(table(spark, ["a b", "a b", None], [None, None, 1])).collect()
    assert sorted((str(r.doc_id), r.n_links > 0) for r in rows) == [("1", False), ("None", True), ("None", True)]
    assert alignment.alignment(table(spark, [])).count() == 0


def test_galloping_finds_what_both_lists_hold():
    r = random.Random(7)
    for n, m in ((0, 5), (5, 0), (1, 900), (300, 290), (70, 5000), (2000, 64)):
        a, b = (np.array(sorted(r.sample(range(6000), k)), np.int64) for k in (n, m))
        x, y = alignment.common_ends(a, b)
        assert a[x].tolist() == b[y].tolist() == sorted({*a.tolist()} & {*b.tolist()})

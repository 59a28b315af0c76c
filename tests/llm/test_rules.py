"""Operators 3, 4, 6 and 7 against plain forms."""

import hashlib
import re
import textwrap
from collections import Counter

import pytest
from conftest import SF
from llm.helpers import HARD, table, words
from oracle import connect, differences

from cardlake.llm import licenses, pii, quality, sharding
from cardlake.llm.pii import op7_pii
from cardlake.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    assert differences(QUERIES[name](spark, SF), ORACLE[name], connect(SF)) == []


# --- quality ----------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    return {
        "n_words": len(w), "n_lines": len(lines), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len({i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}),
    }


def test_measures_of_hard_rows(spark):
    texts = [*HARD, "a b c a b c", "a a a a", "a a a", "x y z\n x y z\nx y z", "# a | b <c> 100% $5 &"]
    df = table(spark, texts)
    got = quality.with_quality(df)
    assert got.columns == [*df.columns, *quality.MEASURES, "base_failed", "kept"]
    for r in got.collect():
        want = plain_measures(texts[r.doc_id])
        assert {k: r[k] for k in quality.MEASURES} == {k: want[k] for k in quality.MEASURES}, texts[r.doc_id]
    assert quality.with_quality(df.limit(0)).count() == 0 and quality.keep_good(df.limit(0)).count() == 0


def test_order_follows_gain_and_changes_no_verdict(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    ticks = iter(range(1000))
    order = quality.order_rules(df, clock=lambda: float(next(ticks)))  # all rules cost the same
    want = quality.with_quality(df).where("kept").select("doc_id").collect()
    assert {r.name for r in order} == {r.name for r in quality.RULES} and order[0].name != "word_length"
    kept = quality.keep_good(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in want) and kept.columns == df.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0")
    assert kept.join(labels, "doc_id").count() == 0


# --- personal data ----------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, match):
    d = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in match.split(".")),
            "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def test_spans_of_hard_rows(spark):
    texts = [
        *HARD, "a@b.c_d@e.f x@y, q@r.s-t.uv.", "é漢🙂 me@x.io 🙂 you@y.io", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.02.3.000255", "1.2.3",
        "4111 1111 1111 1111 or 4111-1111-1111-1112, 4111111111111111 5", "+1 (555) 123-4567. +12 (((( +1 2", "@" * 50 + "a@" * 50 + "b.c", "a" * 3000, "1 " * 3000,
        "+1" + "-" * 3000, " ".join(f"u{i}@h{i}.org" for i in range(300)), "iban GB82 WEST 1234 5698 7654 32 not GB82 WEST 1234 5698 7654 33", "ssn 219-09-9999", "ref 219-09-9999",
    ]
    got = {r.doc_id: r.pii for r in pii.with_pii(table(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert [(s.kind, s.start, s.end) for s in got[i] if s.kind in PLAIN] == base_spans(text), text
    n = len(texts)
    assert [(s.kind, s.start, s.end) for s in got[n - 3] if s.kind == "iban"] == [("iban", 5, 32)]
    assert [s.kind for s in got[n - 2]] == ["ssn"] and got[n - 1] == []
    assert pii.with_pii(table(spark, [])).count() == 0


def test_context_raises_the_score(spark):
    a, b = (r.pii[0].score for r in pii.with_pii(table(spark, ["my phone: +1 555 123 4567", "so +1 555 123 4567"])).orderBy("doc_id").collect())
    assert a > b


def test_op7_equals_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op7_pii(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]


# --- sharding ---------------------------------------------------------------


def test_lookup_by_turns_is_even_and_keeps_places():
    names = tuple(f"s{i}" for i in range(10))
    owner = sharding.lookup(names, 1009)
    share = Counter(owner)
    assert set(share) == set(range(10)) and max(share.values()) - min(share.values()) <= 1
    fewer = sharding.lookup(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 9)
    assert moved < 0.25 * 1009
    for i, name in enumerate(names):  # a shard's first choice is free for whoever comes first in turn
        first = sharding._number(f"offset:{name}") % 1009
        rivals = [j for j in range(i) if sharding._number(f"offset:{names[j]}") % 1009 == first]
        assert rivals or owner[first] == i
    with pytest.raises(ValueError):
        sharding.lookup(names, 1000)


def test_shards_of_hard_rows(spark):
    df = table(spark, HARD, [None, None, *[5] * (len(HARD) - 2)])
    got = sharding.with_shard(df).collect()
    assert len(got) == len(HARD) and len({(r.doc_id, r.slot, r.shard) for r in got}) == 2
    assert all(sharding.lookup()[r.slot] == r.shard for r in got)
    assert sharding.with_shard(df.limit(0)).count() == 0
    plan = sharding.with_shard(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


# --- licenses ---------------------------------------------------------------


def test_each_template_is_found_in_noise(spark):
    noise = "word after word of prose\n" * 6
    texts = [noise + t + "\n" + noise for _, t in licenses.TEMPLATES] + [noise + "licensed to nobody under no version", None, "", *HARD]
    got = licenses.scan(table(spark, texts)).collect()
    by_doc = {r.doc_id: {x.license for x in got if x.doc_id == r.doc_id} for r in got}
    for i, (name, _) in enumerate(licenses.TEMPLATES):
        assert name in by_doc[i], (name, by_doc.get(i))
    assert set(by_doc) == set(range(len(licenses.TEMPLATES)))
    assert licenses.scan(table(spark, [])).count() == 0


def test_wording_decides(spark):
    gpl = next(t for n, t in licenses.TEMPLATES if n == "GPL-3.0")
    assert licenses.difference(gpl, gpl) == (0, 0)
    assert licenses.difference(gpl, gpl.replace("version 3", "version 2")) is None
    assert licenses.difference(gpl, "x " * 20 + gpl.upper() + " y" * 20) == (0, 0)
    by_nc = next(t for n, t in licenses.TEMPLATES if n == "CC-BY-NC-4.0")
    assert licenses.difference(by_nc, "Licensed under CC BY-SA 4.0.") is None


@pytest.mark.parametrize("text, want", [
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
    ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    ("This work is licensed under the GNU Library General Public License, version 3.", []),
    ("This work is licensed under the GNU General Public License (GPL), version 3.", ["GPL-3.0"]),
    ("This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License.", ["CC-BY-NC-4.0"]),
    ("Licensed under CC BY ND SA 4.0", []), ("Licensed under CC BY-NC-ND 4.0.", ["CC-BY-NC-ND-4.0"]),
    ("It is not released under the MIT License.", []), ("It isn't licensed under the Apache License, Version 2.0.", []),
    ("This is not free. Released under the MIT License.", ["MIT"]),
    (next(t for n, t in licenses.TEMPLATES if n == "0BSD").rstrip(".") + " provided that you pay.", []),
])
def test_words_put_in_and_denials_decide(text, want):
    assert [n for _, _, block in licenses.blocks(text) for _, _, n, *_ in licenses.notices(block)] == want


def test_each_template_is_its_own_license_alone():
    """The longest wording wins over the shorter ones inside it, and ranking by compression loses none."""
    for name, notice in licenses.TEMPLATES:
        for text in (notice, f"before it\n{notice}\nbehind it"):
            assert [n for _, _, n, *_ in licenses.notices(text)] == [name]


def test_ranking_loses_no_notice_of_the_table(spark, monkeypatch):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    blocks = [b for t in texts for _, _, b in licenses.blocks(t)]
    ranked = [sorted(n[:3] for n in licenses.notices(b)) for b in blocks]
    monkeypatch.setattr(licenses, "ranked", lambda block: sorted(((len(t), i) for i, (_, t) in enumerate(licenses.TEMPLATES)), reverse=True))
    assert ranked == [sorted(n[:3] for n in licenses.notices(b)) for b in blocks] and any(ranked)


def test_op4_equals_a_search_for_the_notices(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = Counter((i, n) for i, t in texts.items() for n, notice in licenses.TEMPLATES if notice in t)
    got = {(r.doc_id, r.license) for r in QUERIES["op4_license_scans"](spark, SF).collect()}
    assert got == set(want) and got


def test_line_wraps_cut_no_notice(spark):
    before, after = "Copyright 2020 Some Person and others", "A paragraph of this text that goes on and on.\n\n" * 12
    texts, want = [], set()
    for name, notice in licenses.TEMPLATES:
        for width in (30, 50, 70, 75, 80):
            for mark in ("", "# "):
                lines = textwrap.wrap(notice, width, break_on_hyphens=False, break_long_words=False)
                start = after.count("\n") + 3
                want.add((len(texts), start, start + len(lines), name))
                texts.append("\n".join([after, before, "", *(mark + x for x in lines), "", after]))
    got = licenses.scan(table(spark, texts)).collect()
    assert {(r.doc_id, r.first_line, r.last_line, r.license) for r in got} == want and all(r.saved_bytes > 0 for r in got)


def test_a_block_may_hold_any_number_of_notices(spark):
    notices = [t for _, t in licenses.TEMPLATES]
    names = Counter(n for n, _ in licenses.TEMPLATES)
    prose = "word after word of prose that no license has, and under it the next one of many in this long line, " * 40
    short = [t for t in notices if len(t) < 90]
    texts = ["\n".join(notices), "\n".join(notices[::-1]), " ".join(notices), "\n".join(short), f"{prose}{' '.join(short)} {prose}", "\n".join(short[:1] * 5)]
    got = licenses.scan(table(spark, texts)).collect()
    some = Counter(n for n, t in licenses.TEMPLATES if t in short)
    for i, want in enumerate([names, names, names, some, some, Counter({"Apache-2.0": 5})]):
        assert Counter(r.license for r in got if r.doc_id == i) == want, i
    assert all(r.saved_bytes > 0 for r in got)

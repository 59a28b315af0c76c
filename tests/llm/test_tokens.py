"""Operators 1, 5 and 9 against the library itself."""

import hashlib
import random
import time
import weakref
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import SF
from llm.helpers import HARD, table
from tokenizers import Tokenizer

from cardlake.llm import bpe, bpe_codec, token_files
from cardlake.llm.bpe import BYTE_BPE, Prefixes, byte_bpe
from cardlake.llm.bpe_codec import op5_bpe_codec
from cardlake.llm.simple8b import LARGEST, pack, unpack
from cardlake.llm.token_counts import op1_token_counts, prefix_tokens, token_counts
from cardlake.llm.token_files import op9_token_files, word_bpe

PATH, WORDS = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(token_files.WORD_BPE)
PARTS = list("abcdefgh'''  \n\n\t  　éßĐİ漢字🙂1½3.,!<|>") + [
    "'re", "'ll", "<|endoftext|>", "  ", "   ", "the", "ing", " \n", "\r\n", "\xa0", "aaaa", "Ω", "́", "-" * 30, "\x85", "<|endo", "ftext|>"]


def mixed(n, size, seed=3):
    r = random.Random(seed)
    return ["".join(r.choices(PARTS, k=r.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_prefix_counts_and_cuts_are_exact(library):
    bpe = byte_bpe(PATH)
    for text in mixed(300, 40):
        counts = [len(ids_of(library, text[:k])) for k in range(len(text) + 1)]
        found = Prefixes(bpe, text)
        assert found.every() == counts, text
        for budget in (0, 1, 3, 7):
            assert found.cut(budget) == max(k for k, n in enumerate(counts) if n <= budget)


def test_cut_inside_a_long_unsplit_text(library):
    text = "".join(random.Random(1).choices(["a", "b", "the", "tion", "er", "漢"], k=2000))
    cut = Prefixes(byte_bpe(PATH), text).cut(500)
    assert len(ids_of(library, text[:cut])) <= 500 < len(ids_of(library, text[: cut + 1]))


def test_token_counts_of_hard_rows(spark, library):
    df = table(spark, HARD)
    got = token_counts(df, limit=50).collect()
    assert got[0].__fields__[: len(df.columns)] == df.columns
    for r in got:
        n = len(ids_of(library, HARD[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((HARD[r.doc_id] or "").encode()), n > 50)
    assert token_counts(df.limit(0)).count() == 0
    assert prefix_tokens(df).where("doc_id = 5").first().prefix_tokens == [0, 1]


def test_op1_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op1_token_counts(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        n = len(ids_of(library, texts[r.doc_id]))
        assert (r.n_tokens, r.over_limit) == (n, n > 1024)


@pytest.mark.parametrize("leaf", [5, 40])
def test_tree_concatenation_equals_the_library(spark, library, leaf):
    texts = [*HARD[:10], *HARD[12:], *mixed(25, 60), "acgt" * 60]
    got = bpe_codec.encode(table(spark, texts, [7] * len(texts)), leaf_chars=leaf).collect()
    assert sorted(array("I", bytes(r.ids)).tolist() for r in got) == sorted(ids_of(library, t) for t in texts)


def test_joins_of_every_cut(library):
    bpe = byte_bpe(PATH)
    for text in [*mixed(60, 30, 9), "acgt" * 300, "a<|endoftext|>b  c"]:
        for at in range(1, len(text), max(1, len(text) // 25)):
            whole = bpe_codec.join(bpe, bpe_codec.Node.of(bpe, text[:at]), bpe_codec.Node.of(bpe, text[at:]))
            assert [i for ids in whole.ids for i in ids] == ids_of(library, text), (text, at)


def test_op5_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op5_bpe_codec(spark, SF).collect():
        ids = ids_of(library, texts[r.doc_id])
        text = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_decode_of_parts_of_characters(spark, library):
    ids = [i for t in ("漢", "🙂é") for i in ids_of(library, t)][:-1]
    df = spark.createDataFrame([(array("I", ids).tobytes(),), (None,)], "ids binary")
    assert [r.decoded for r in bpe_codec.decode(df).collect()] == [library.decode(ids, skip_special_tokens=False), ""]


def test_simple8b_round_trip():
    g = np.random.default_rng(1)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        for top in (1, 2, 16, 300, 50_000, 1 << 32, LARGEST):
            values = g.integers(0, top, n, dtype=np.uint64)
            values[g.random(n) < 0.5] = 0
            words, before = pack(values)
            assert (unpack(words, before, n) == values).all()
    with pytest.raises(ValueError):
        pack(np.array([LARGEST + 1], np.uint64))


def test_word_ids_equal_the_library():
    library, own = Tokenizer.from_file(WORDS), word_bpe(WORDS)
    for text in [*(t or "" for t in HARD), *mixed(800, 40, 4)]:
        assert array("I", own.encode(text)).tolist() == ids_of(library, text), text


def files(texts, ids, library):
    """doc_id, start, n_tokens, crc32 the plain way."""
    at = 0
    signed = {t: int.from_bytes(xxhash.xxh64_digest((t or "").encode(), 42), "big", signed=True) for t in texts}
    for doc_id, text in sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, signed[x[1]], x[1] or "")):
        out = [*ids_of(library, text), 2]
        yield doc_id, at, len(out), zlib.crc32(array("I", out).tobytes())
        at += len(out)


@pytest.mark.parametrize("ids", [None, "ties"])
def test_token_files_of_hard_rows(spark, path, ids):
    library, n = Tokenizer.from_file(WORDS), len(HARD)
    ids = list(range(n)) if ids is None else [None, *([4] * 3), *range(n - 4)]
    token_files.write_token_files(table(spark, HARD, ids), path("files"), shards=3)
    got = token_files.read_token_files(spark, path("files"), with_ids=True)
    assert sorted(map(str, (tuple(r)[:4] for r in got.collect()))) == sorted(map(str, files(HARD, ids, library)))
    assert sum(r.n_tokens for r in got.collect()) == sum(x[2] for x in files(HARD, ids, library))
    starts = sorted((r.start, r.n_tokens) for r in got.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    library, own = Tokenizer.from_file(WORDS), token_files.WordBpe(WORDS)
    monkeypatch.setattr(token_files, "HELD_BYTES", 2000)
    long = "x" * 39 + " " + "y" * 41 + " " + "é" * 30 + " don't o'clock's 3.14,"
    for _ in range(3):
        texts = [*mixed(60, 30, 5), long, "", "<|endoftext|>"]
        assert [array("I", i).tolist() for i in own.encode_all(texts)] == [ids_of(library, t) for t in texts]


def test_token_files_of_an_empty_table(spark, path):
    token_files.write_token_files(table(spark, []), path("files"))
    assert token_files.read_token_files(spark, path("files")).count() == 0


def test_op9_equals_the_library(spark):
    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = op9_token_files(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == list(files([d.text for d in docs], [d.doc_id for d in docs], library))


def test_idle_worker_lets_its_words_go(monkeypatch):
    monkeypatch.setattr(bpe, "IDLE_S", 0.2)
    with bpe.in_use(PATH) as used:
        ids = used.encode("some words")
        held = weakref.ref(used)
    with bpe.in_use(PATH) as again:  # the next batch comes soon
        assert again is used
    del used, again
    end = time.monotonic() + 10
    while held() is not None and time.monotonic() < end:
        time.sleep(0.05)
    assert held() is None
    with bpe.in_use(PATH) as anew:
        assert anew.encode("some words") == ids

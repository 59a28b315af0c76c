"""Hard rows that every operator must take, and plain forms of what they compute."""

from __future__ import annotations

import re

INSIDE = ("_slot", "_owner", "_gone", "_row", "_hash", "_m", "_counts", "_d", "_key", "_e", "_k", "_k1", "_k2", "_order", "_id")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, hash string, item_id long, " + ", ".join(f"{c} long" for c in INSIDE)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(texts, ids=None):
    """Rows with columns whose names operators use inside."""
    return [(i if ids is None else ids[i], t, "en", None, None if t is None else len(t), "k", "h", 1, *range(len(INSIDE))) for i, t in enumerate(texts)]


def table(spark, texts, ids=None):
    return spark.createDataFrame(rows(texts, ids), SCHEMA)


def words(text):
    return WORD.findall(text or "")


HARD = [
    None, "", " ", "\n", "\n\n\t ", "a", "A b", "one two three", "ein Wort zu viel " * 40, "ß é 漢字 🙂 ́x", "x" * 5000,
    "acgt" * 3000, "the same text again", "the same text again", "<|endoftext|> in a text <|endoftext|>", "'re 'S I'll  two  spaces ",
    "1 234 567\t8\r\n9\x0b10\x0c11\xa012 1",
]

"""Operator 6: quality rules as a short-circuit cascade.

Each rule is timed on a bounded sample and its rejections are counted there;
the rules then run in order of rejections per second, and a document that one
rule rejects is not looked at by the next. The order never changes a verdict.

Null text counts as empty: no words, so it fails the base rule. Rows are
independent: repeated rows, null or repeated ids and extra columns pass
through; an input column named like an output column is replaced. An empty
table gives an empty table. Texts are measured whole, however long.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import documents, stage, text_of, unused

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: Rows, and characters of a text at most, of the sample that orders the rules.
SAMPLE_ROWS, SAMPLE_CHARS = 400, 1 << 15


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it several times, only when it is asked for."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS[1:], " " * 5), " "), "")


def lines_of(text: Column) -> Column:
    """The lines with a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, BLANKS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def n_dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words: Column) -> Column:
    """Words in three-word windows that the text holds twice or more.

    Windows are compared by their 64-bit hashes within one text. Positions are
    sorted by hash only where some window is repeated.
    """
    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda seen, p: F.struct(p.alias("last"), (seen.n + F.least(F.lit(WINDOW), p - seen.last)).alias("n"))
        return F.aggregate(at, start, step, lambda seen: seen.n)

    def repeated(pairs: Column) -> Column:
        equal = lambda i, x: F.coalesce(F.get(pairs, i).h == x.h, F.lit(False))
        found = F.filter(pairs, lambda x, i: equal(i - 1, x) | equal(i + 1, x))
        return covered(F.sort_array(F.transform(found, lambda x: x.i)))

    def count(w: Column) -> Column:
        last = F.size(w) - WINDOW
        windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        by_hash = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        unless_plain = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(by_hash(h), repeated)).otherwise(F.lit(0).cast("long"))
        return F.when(last >= 1, let(windows, unless_plain)).otherwise(F.lit(0).cast("long"))

    return let(words, count)


@dataclass(frozen=True)
class Rule:
    """A name, the measures it reads, and what it rejects in their terms."""

    name: str
    rejects: Callable[[dict[str, Column]], Column]
    base: bool = False


#: Base rules are fixed; the others leave out symbol noise, lists of the same lines, and words of odd lengths.
RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50, True),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"], True),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """All measures as expressions; none is computed before it is used."""
    return {
        "n_words": F.size(words).cast("long"), "n_lines": F.size(lines).cast("long"), "word_chars": word_chars(text),
        "n_symbols": n_symbols(text), "n_dup_lines": n_dup_lines(lines), "n_repeat_words": n_repeat_words(words),
    }


def order_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", rows: int = SAMPLE_ROWS, clock: Callable[[], float] = time.perf_counter) -> list[Rule]:
    """The rules by rejections per second on a sample of bounded size; ties keep their order."""
    short = df.select(text_of(text).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    taken = short.limit(rows).collect()
    if not taken:
        return list(rules)
    sample = stage(df.sparkSession.createDataFrame(taken, "text string"), "rule-sample")
    t = F.col("text")
    found = measures(t, words_of(t), lines_of(t))
    gain = {}
    for rule in rules:
        count = sample.agg(F.count_if(rule.rejects(found)))
        count.collect()  # compiles
        start = clock()
        rejected = count.first()[0]
        gain[rule.name] = rejected / max(clock() - start, 1e-6)
    return sorted(rules, key=lambda r: -gain[r.name])


def _verdict(order: list[Rule], found: dict[str, Column]) -> Column:
    """True if no rule rejects; CASE stops at the first that does."""
    verdict = F.when(order[0].rejects(found), False)
    for rule in order[1:]:
        verdict = verdict.when(rule.rejects(found), False)
    return verdict.otherwise(True)


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that every rule accepts. Measures are computed as far as the cascade asks for them."""
    t = text_of(text)
    order = order_rules(df, rules, text)
    kept = let(words_of(t), lambda w: _verdict(order, measures(t, w, lines_of(t))))
    return df.where(kept)


def with_quality(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add all measures, ``base_failed`` and ``kept``."""
    t = text_of(text)
    order = order_rules(df, rules, text)
    found = measures(t, words_of(t), lines_of(t))
    [name] = unused(df, "_m")
    measured = df.withColumn(name, let(words_of(t), lambda w: let(lines_of(t), lambda ls: F.struct(
        *[c.alias(n) for n, c in measures(t, w, ls).items()]))))
    found = {n: F.col(name)[n] for n in found}
    base = [r.rejects(found) for r in rules if r.base]
    failed = base[0]
    for b in base[1:]:
        failed = failed | b
    out = {n: found[n] for n in MEASURES} | {"base_failed": failed, "kept": _verdict(order, found)}
    return measured.withColumns(out).drop(name)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return with_quality(docs).select("doc_id", *MEASURES, "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
s AS (SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT doc_id, unnest([i, i+1, i+2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM s) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM r GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
  len(lines) AS n_lines FROM w LEFT JOIN c ON w.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM m
"""

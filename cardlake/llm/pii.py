"""Operator 7: personal data by pattern, checksum and context.

Each kind has a pattern that proposes spans and a check that confirms them
(digit counts, octet ranges, Luhn, mod-97). Words near a span raise its score; a
kind whose check proves little is reported only with such a word. Patterns are
written so that matching never goes back over a text: they give the same spans
as their plain forms, in time linear in the text.

Spans count code points, end exclusive, from the start of the whole text; each
kind's are leftmost and do not overlap; those of different kinds may. Null text
counts as empty: no spans. Rows are independent: repeated rows, null or
repeated ids and extra columns pass through; an input column named like an
output column is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import documents, text_of
from cardlake.llm.quality import let

#: Characters on each side of a span that are searched for context words.
CONTEXT_CHARS = 40
LEAST_SCORE = 0.5
_STEP = 64


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _octets(match: Column) -> Column:
    return match.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, leave 1."""
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, rest * 10 + (c - 48)).otherwise(rest * 100 + (c - 55)) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


@dataclass(frozen=True)
class Kind:
    """How spans of a kind are proposed, confirmed and scored."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    hint: str  # a text without it has no span
    base: bool = False


_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), 0.8, "e-?mail|contact|write", "@", True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets, 0.6, "ip|address|host|server", ".", True),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", lambda m: F.length(_digits(m)).between(16, 19) & luhn(_digits(m)), 0.8, "card|visa|master|credit|debit|payment", "", True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(8, 15), 0.6, "phone|tel|call|mobile|fax", "+", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])",
         lambda m: F.length(F.translate(m, " ", "")).between(15, 34) & mod97(F.translate(m, " ", "")), 0.8, "iban|account|bank", ""),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, "ssn|social security", "-"),
)
BASE = [k.name for k in KINDS if k.base]


def _spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind: array of kind, start, end, score."""
    def between(matches: Column, gaps: Column) -> Column:
        n = F.size(matches)
        each = F.zip_with(matches, F.slice(gaps, F.lit(1), n), lambda m, g: F.length(m) + F.length(g))
        return let(each, lambda sizes: let(_ends_before(sizes), lambda before: F.transform(F.sequence(F.lit(0), n - 1), lambda i: one(matches, gaps, sizes, before, i))))

    def _ends_before(sizes: Column) -> Column:
        """Characters before each step of matches."""
        steps = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _STEP).cast("int"))
        sums = F.transform(steps, lambda s: total(F.slice(sizes, s * _STEP + 1, F.lit(_STEP))))
        return F.aggregate(sums, F.array(F.lit(0)), lambda seen, x: F.array_append(seen, F.element_at(seen, -1) + x))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def one(matches: Column, gaps: Column, sizes: Column, before: Column, i: Column) -> Column:
        step = F.floor(i / _STEP).cast("int")
        end = F.get(before, step) + total(F.slice(sizes, step * _STEP + 1, i % _STEP + 1))
        m = F.get(matches, i)
        near = F.lower(F.concat(F.substring(F.get(gaps, i), -CONTEXT_CHARS, CONTEXT_CHARS), F.lit(" "), F.substring(F.get(gaps, i + 1), 1, CONTEXT_CHARS)))
        score = F.lit(kind.score) + F.when(near.rlike(rf"\b(?:{kind.context})"), F.lit(0.2)).otherwise(F.lit(0.0))
        return F.when(kind.valid(m), F.struct(F.lit(kind.name).alias("kind"), (end - F.length(m)).cast("long").alias("start"), end.cast("long").alias("end"), score.alias("score")))

    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda ms: F.when(F.size(ms) > 0, let(
        F.split(text, kind.pattern, -1), lambda gaps: F.filter(between(ms, gaps), lambda s: s.isNotNull() & (F.lit(kind.base) | (s.score >= LEAST_SCORE))))).otherwise(empty))
    hinted = F.contains(text, F.lit(kind.hint)) if kind.hint else text.rlike("[0-9]")
    return F.when(hinted, found).otherwise(empty)


def with_pii(df: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Add ``pii``: all confirmed spans, by kind as listed, then start."""
    t = text_of(text)
    return df.withColumn("pii", F.concat(*[_spans(t, k) for k in kinds]))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def _number(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s.kind == kind))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_pii(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [_number(k).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter("pii", lambda s: s.kind.isin(BASE))
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans"))

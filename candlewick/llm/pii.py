"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score (DataFrame functions only).

Positions come without Python: the text is split at the pattern, and the lengths of the gaps and of the matches add up to the
start of each match. Context is the end of the gap before and the beginning of the gap after a match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import let

WINDOW = 40  # characters of context on either side
BONUS = 0.3


@dataclass(frozen=True)
class Kind:
    """``pattern`` is a Java pattern that takes time in proportion to the text: runs are entered at their first character
    (or where the last match ended) and never given back."""

    name: str
    hint: str  # a text without a match of this cheap pattern is not searched
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    against: str = "(?!)"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _byte_parts(hit: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(hit, "\\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(999)) <= 255))


def _luhn(digits: Column) -> Column:
    """From the right, every second digit counts twice, with its own digits added up; the sum ends in 0."""

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, -i, F.lit(1))) - 48
        return total + F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _card(hit: Column) -> Column:
    return let(_digits(hit), lambda d: F.length(d).between(12, 19) & _luhn(F.when(F.length(d) <= 19, d).otherwise(F.lit("1"))))


def _mod97(hit: Column) -> Column:
    """Country and check digits moved to the end, letters as 10 .. 35: the number leaves 1 modulo 97."""

    def step(rest: Column, c: Column) -> Column:
        v = F.ascii(c)
        return F.when(v < 58, (rest * 10 + v - 48) % 97).otherwise((rest * 100 + v - 55) % 97)

    turned = let(F.replace(hit, F.lit(" "), F.lit("")), lambda s: F.concat(F.substring(s, 5, 100), F.substring(s, 1, 4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


#: Spans of these stay whatever their score.
BASE = (
    Kind("email", "@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda h: F.lit(True), 0.9, "mail|contact|write|address|kontakt|correo|courriel"),
    Kind("ip", "[0-9]\\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _byte_parts, 0.6, "\\bip\\b|host|server|address|login|client", "version|section|release"),
    Kind("card", "[0-9]{2}|[0-9][ -][0-9]", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.6, "card|visa|master|credit|debit|karte|tarjeta|carte", "order|isbn|serial|invoice"),
    Kind("phone", "\\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", lambda h: F.length(_digits(h)).between(9, 15), 0.7, "call|phone|tel|mobile|fax|anruf|llam|appel"),
)
#: Added by the method; kept from a score of ``threshold`` on.
ADDED = (
    Kind("iban", "[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _mod97, 0.8, "iban|bank|account|konto|cuenta|compte"),
    Kind("ssn", "[0-9]-[0-9]", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", lambda h: F.lit(True), 0.4, "ssn|social|security|tax", "order|part|serial"),
)

_SPAN = "array<struct<kind_no:int,kind:string,start:bigint,end:bigint,hit:string,score:double>>"


def _spans(text: Column, number: int, kind: Kind) -> Column:
    """Confirmed spans of one kind."""
    none = F.array().cast(_SPAN)

    def found(parts: Column) -> Column:
        gaps, hits = parts["gaps"], parts["hits"]
        rows = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), F.slice(gaps, 2, F.size(hits)).alias("next"))
        state = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

        def add(acc: Column, r: Column) -> Column:
            start = acc["at"] + F.length(r["gap"])
            end = start + F.length(r["hit"])
            near = F.lower(F.concat(F.right(r["gap"], F.lit(WINDOW)), F.lit(" "), F.left(r["next"], F.lit(WINDOW))))
            score = F.lit(kind.score) + F.when(near.rlike(kind.context), BONUS).otherwise(0.0) - F.when(near.rlike(kind.against), BONUS).otherwise(0.0)
            span = F.struct(F.lit(number).alias("kind_no"), F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), r["hit"].alias("hit"), F.least(F.lit(1.0), score).alias("score"))
            return F.struct(end.alias("at"), F.when(kind.valid(r["hit"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).cast(_SPAN).alias("spans"))

        return F.aggregate(rows, state, add)["spans"]

    parts = F.struct(F.split(text, kind.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hits"))
    hinted = text.contains(kind.hint) if kind.hint == "@" else text.rlike(kind.hint)
    return F.when(hinted, let(parts, found)).otherwise(none)


def find_pii(df: DataFrame, doc: str = "doc_id", text: str = "text", threshold: float = 0.6) -> DataFrame:
    """``doc_id, spans``: kind, start, end (code points, end exclusive), hit and score of every span, by start and kind.

    Kinds of ``BASE`` are leftmost, non-overlapping matches that pass their check (a failing match is dropped, not retried) and
    always stay; those of ``ADDED`` need a score of ``threshold``. Spans of different kinds may overlap. Null and empty texts
    have no spans; every row counts by itself, so repeated rows and null ids stay; an empty table gives an empty result.
    """
    docs = df.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kinds = [(i, k) for i, k in enumerate((*BASE, *ADDED))]
    docs = docs.select("doc_id", *[_spans(F.col("text"), i, k).alias(f"_k{i}") for i, k in kinds])
    every = F.flatten(F.array(*[F.col(f"_k{i}") if i < len(BASE) else F.filter(f"_k{i}", lambda s: s["score"] >= threshold) for i, _ in kinds]))
    ordered = F.array_sort(every, lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int")).otherwise(a["kind_no"] - b["kind_no"]))
    return docs.select("doc_id", F.transform(ordered, lambda s: F.struct(*[s[f].alias(f) for f in ("kind", "start", "end", "hit", "score")])).alias("spans"))

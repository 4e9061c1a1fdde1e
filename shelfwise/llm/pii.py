"""Operator 13: personal data by patterns, checksums and context words.

Patterns propose spans, validators confirm them (octets of an address, Luhn for cards,
mod 97 for account numbers), and words near a span raise or lower its score:

    score = what the pattern is worth + 0.3 if a validator confirms it
            + 0.3 if a word of its kind stands near - 0.3 if a word of other numbers does

Spans of the base kinds (email, ip, card, phone) that pass their own rule are always
reported, whatever their score. The others (account numbers, cards of 13 digits, telephone
numbers without a plus sign, social security numbers) are reported at `ACCEPTED` or more,
and only where they overlap no span before them.

Every pattern is linear in the text: mail addresses are found from their @ backwards, and a
run of digits is tried from its start only, so that one run of a million digits or letters
costs no more than prose. The job is one narrow pass over whole texts.

Cases: null and empty texts have no spans; offsets are code points, the end exclusive; equal
texts have equal spans; repeated rows and ids are rows of their own; spans with the same
start are ordered by kind, then end; an empty table gives an empty table; other columns go
along, and a column named like the output is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import text_of

#: Kinds in the order in which spans with the same start are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
#: The score from which a span outside the base is reported.
ACCEPTED = 0.8
#: Characters before and after a span in which context words count.
BEFORE, AFTER = 48, 24

#: What a pattern alone is worth.
WORTH = {"email": 0.9, "ip": 0.6, "card": 0.3, "phone": 0.5, "iban": 0.55, "ssn": 0.5}

_CONTEXT = {
    kind: re.compile(rf"(?<![^\W\d_])(?:{words})", re.IGNORECASE)
    for kind, words in {
        "email": "e-?mail|mail|contact|write to|kontakt|courriel|correo",
        "ip": "ip|address|host|server|login|adresse",
        "card": "card|credit|debit|visa|master|amex|payment|karte|carte|tarjeta",
        "phone": "phone|telephone|tel|call|mobile|cell|fax|telefon|téléphone|handy|portable|teléfono|móvil",
        "iban": "iban|account|bank|konto|compte|cuenta|transfer",
        "ssn": "ssn|social security|social-security|taxpayer",
    }.items()
}
#: Words before numbers that are no personal data.
_OTHER = re.compile(
    r"(?<![^\W\d_])(?:order|invoice|version|isbn|sku|part|serial|ticket|article|item|page|release)(?![^\W\d_])", re.IGNORECASE)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![\w.+/-])(?:\([0-9]{2,5}\)[ -]?)?[0-9]{2,5}(?:[ ./-][0-9]{2,5}){1,5}(?![\w/-])(?!\.[0-9])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_ANY = re.compile("[0-9@]").search

#: Characters of an account number by country, fixed values of the public registry.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23,
    "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15,
    "PL": 28, "PT": 25, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26, "UA": 29,
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    text: str
    score: float
    confirmed: bool
    base: bool


def luhn(digits: str) -> bool:
    """The card check: every second digit from the right doubled, digit sums to a multiple of ten."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The account check: country and check digits moved to the end, letters as 10 to 35, one modulo 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses, leftmost first and not overlapping, found from each @ sign."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in text.split("."))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _account(text: str) -> str | None:
    """The account number at the start of a run of groups, cut to its country's length."""
    kept = [i for i, c in enumerate(text) if c not in " -"]
    n = IBAN_LENGTH.get(text[:2])
    return text[:kept[n - 1] + 1] if n and len(kept) >= n and not text[kept[n - 1] + 1:kept[n - 1] + 2].isalnum() else None


def base_spans(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, confirmed by a validator) of the base kinds that pass their rule."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end, False
    for m in _IP.finditer(text):
        if _octets(m[0]):
            yield "ip", *m.span(), True
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield "card", *m.span(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span(), False


def added_candidates(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """The same for the spans that need a score."""
    for m in _IBAN.finditer(text):
        if (found := _account(m[0])) and mod97(re.sub("[ -]", "", found)):
            yield "iban", m.start(), m.start() + len(found), True
    for m in _SSN.finditer(text):
        yield "ssn", *m.span(), False
    for m in _CARD.finditer(text):
        if len(digits := _digits(m[0])) == 13 and luhn(digits):
            yield "card", *m.span(), True
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 12:
            yield "phone", *m.span(), False


def score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    """What the pattern, the validator and the words near the span are worth together."""
    before, after = text[max(0, start - BEFORE):start], text[end:end + AFTER]
    near = _CONTEXT[kind].search(before) or _CONTEXT[kind].search(after)
    value = WORTH[kind] + 0.3 * confirmed + 0.3 * bool(near) - 0.3 * bool(_OTHER.search(before))
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str) -> list[Span]:
    """All spans of one text, by start, kind and end."""
    if not _ANY(text):
        return []
    found = [
        Span(kind, a, b, text[a:b], score(text, kind, a, b, ok), ok, True) for kind, a, b, ok in base_spans(text)]
    added = [
        Span(kind, a, b, text[a:b], value, ok, False) for kind, a, b, ok in added_candidates(text)
        if (value := score(text, kind, a, b, ok)) >= ACCEPTED]
    if added:
        # Both lists by start; an added span goes in where nothing taken before it or in the base reaches into it.
        taken = sorted((s.start, s.end) for s in found)
        reach, i, ends = 0, 0, []
        for a, b in taken:
            reach = max(reach, b)
            ends.append(reach)
        last = 0
        for s in sorted(added, key=lambda s: (s.start, KINDS.index(s.kind))):
            while i < len(taken) and taken[i][0] < s.end:
                i += 1
            if (i == 0 or ends[i - 1] <= s.start) and last <= s.start:
                found.append(s)
                last = s.end
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


SPANS = "array<struct<kind:string,start:int,end:int,text:string,score:double,confirmed:boolean,base:boolean>>"


def spans_of(text: Column) -> Column:
    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[s._asdict() for s in find(t)] for t in texts], dtype=object)

    return spans(text)


def find_personal_data(docs: DataFrame, text: str = "text", out: str = "personal") -> DataFrame:
    """Add `out`, the spans of each text: kind, start, end, text, score, whether a validator
    confirmed it, and whether it is one of the base kinds' own."""
    return docs.withColumn(out, spans_of(text_of(text)))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, items in zip(texts, found):
            at, parts = 0, []
            for s in items:
                if s["start"] >= at:
                    parts += [t[at:s["start"]], f"<{s['kind']}>"]
                at = max(at, s["end"])
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    return mask(F.coalesce(text, F.lit("")), spans)


def listed(spans: Column) -> Column:
    """`kind:start:end` of the spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digest(found: DataFrame, spans: str = "personal") -> list[Column]:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    base = F.filter(spans, lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return [*counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col(spans)).alias("spans")]

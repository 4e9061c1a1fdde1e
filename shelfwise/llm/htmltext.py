"""Operator 6: main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative; a linear
scan finds the contiguous stretch with the largest sum, which is the content region. The
weights come from labelled pages, those that mark their main part with an `article` or
`main` element: the log odds of each tag name inside and outside the label, and one scale
for all tags, the one with which the scan finds the labelled parts best. Elements that are never content, by their name or class (scripts,
forms, menus, notices, adverts, comments), count nothing in the scan and are left out; the
words of the region that remain are put together as blocks.

Cases: null or empty html gives empty text; a page without tags is all content; unclosed
comments, scripts and styles end with the page, other unclosed tags hold nothing; the work
grows with the page in proportion; of equal stretches the first wins; without
labelled pages `PRIOR` holds; repeated rows and extra columns stay, a column named like an
output is replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import few_by_hash

#: Elements whose content is raw text; where they are not closed, only the first two go on to the end of the page.
RAW = frozenset("script style noscript template svg iframe textarea select".split())
ENDLESS = frozenset(("script", "style"))
#: Elements and names of classes, ids or roles that are not content wherever they stand.
BOILERPLATE = frozenset("nav header footer aside form dialog menu button head title".split()) | RAW
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|comments?|comment(?:list|form|box|area)|disqus|respond|replies|"
    r"cookies?|consent|notice|sidebar|menu|nav\w*|breadcrumbs?|share|newsletter|subscribe|popup|modal|footer)(?:$|[\s_-])"
    # These two also name parts of articles (related work, social history), so they count alone
    # or before a word for a list of links.
    r"|(?:^|\s)(?:[\w-]+[_-])?(?:related|social)(?:[_-]?(?:posts?|articles?|stories|links?|content|items?|news|pages?|media|"
    r"shar(?:e|ing)|icons?|buttons?|bar|box|widget|list))?(?:$|\s)", re.I)
#: Elements inside a line of text; all others divide blocks.
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Weight of a tag where nothing was learned.
PRIOR = -2.0
SCALES = (0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, text): kind `text`, `open` or `close`. Raw elements are one `open` token."""
    out: list[tuple[str, str, str]] = []
    at = 0
    unclosed: set[str] = set()
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            if m[0][0] != "<" or m[0] == "<":
                out.append(("text", "", m[0]))
            continue
        name = name.lower()
        if m[1]:
            out.append(("close", name, ""))
        else:
            out.append(("open", name, m[3]))
            if name in RAW and name not in unclosed and not m[3].endswith("/"):
                end = _END[name].search(page, at)
                if end:
                    at = end.end()
                elif name in ENDLESS:
                    at = len(page)
                else:
                    unclosed.add(name)
    return out


@dataclass(frozen=True)
class Weights:
    word: float
    tags: dict[str, float]
    other: float  # a tag not seen in labelled pages
    boilerplate: float  # one of `BOILERPLATE` not seen there
    scale: float


def score(kind: str, name: str, text: str, w: Weights) -> float:
    if kind == "text":
        return w.word * len(text.split())
    return w.scale * w.tags.get(name, w.boilerplate if name in BOILERPLATE else w.other)


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """First and last index + 1 of the contiguous stretch with the largest sum."""
    best, span, run, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, span = run, (start, i + 1)
    return span


def labelled_span(found: list[tuple[str, str, str]]) -> tuple[int, int] | None:
    """What the first `article` or `main` element holds."""
    for i, (kind, name, _) in enumerate(found):
        if kind == "open" and name in ("article", "main"):
            ends = [j for j in range(i, len(found)) if found[j][0] == "close" and found[j][1] == name]
            return (i + 1, ends[-1]) if ends else (i + 1, len(found))
    return None


def fit(pages: list[str]) -> Weights:
    """Weights from labelled pages; pages without a label are passed over."""
    cut = [(t, s) for t in map(tokens, pages) if (s := labelled_span(t))]
    inside, outside, words = Counter(), Counter(), [1, 1]
    for found, (a, b) in cut:
        for i, (kind, name, text) in enumerate(found):
            within = a <= i < b
            if kind == "text":
                words[within] += len(text.split())
            else:
                (inside if within else outside)[name] += 1
    if not cut:
        return Weights(1.0, {}, PRIOR / 4, 4 * PRIOR, 1.0)
    # Log odds against the whole sample, add-half smoothed; tags never score positive.
    weights = {t: min(-0.1, _odds(inside[t] + 0.5, outside[t] + 0.5)) for t in inside | outside}
    base = Weights(1.0, weights, PRIOR / 4, min(weights.values()), 1.0)

    def missed(scale: float) -> int:
        """Words wrongly in or out of the region over the sample."""
        w, wrong = Weights(base.word, base.tags, base.other, base.boilerplate, scale), 0
        for found, (a, b) in cut:
            x, y = best_stretch([score(*t, w) for t in found])
            wrong += sum(len(t[2].split()) for i, t in enumerate(found) if t[0] == "text" and (a <= i < b) != (x <= i < y))
        return wrong

    scale = min(SCALES, key=missed)
    return Weights(base.word, base.tags, base.other, base.boilerplate, scale)


def _odds(a: float, b: float) -> float:
    from math import log

    return log(a / b)


def ends_of(found: list[tuple[str, str, str]]) -> dict[int, int]:
    """Where each element that is closed ends, matched by name, in one pass."""
    ends: dict[int, int] = {}
    open_: dict[str, list[int]] = {}
    for i, (kind, name, _) in enumerate(found):
        if kind == "open":
            open_.setdefault(name, []).append(i)
        elif kind == "close" and open_.get(name):
            ends[open_[name].pop()] = i
    return ends


def left_out(found: list[tuple[str, str, str]]) -> list[bool]:
    """Which tokens belong to elements that are never content. An element counts only if it
    is closed; a header inside the article is the article's own."""
    out = [False] * len(found)
    ends = ends_of(found)
    article, i = 0, 0
    while i < len(found):
        kind, name, text = found[i]
        article += (kind == "open") - (kind == "close") if name in ("article", "main") else 0
        if kind != "open" or name in VOID:
            i += 1
            continue
        if name in RAW:
            out[i] = True
            i += 1
            continue
        end = i
        if i in ends:
            names = " ".join(next(filter(None, m.groups()), "") for m in _ATTRIBUTE.finditer(text)) if text else ""
            if name in BOILERPLATE and not (name == "header" and article > 0) or names and _NAMES.search(names):
                end = ends[i]
                out[i:end + 1] = [True] * (end + 1 - i)
        i = end + 1
    return out


def main_text(page: str, w: Weights) -> str:
    """The blocks of the best stretch in page order, joined by one space."""
    found = tokens(page)
    out = left_out(found)
    # What is never content neither makes a stretch better nor breaks it.
    a, b = best_stretch([0.0 if o else score(*t, w) for t, o in zip(found, out)])
    parts = []
    for (kind, name, text), o in zip(found[a:b], out[a:b]):
        if kind == "text" and not o:
            parts.append(text)
        elif kind != "text" and name not in INLINE:
            parts.append("\n")
    return " ".join(html.unescape("".join(parts)).split())


def extract(pages: DataFrame, weights: Weights, column: str = "html") -> DataFrame:
    """Add `text` and `n_chars` (code points)."""

    @F.pandas_udf("string")
    def texts(raw: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, weights) for page in raw], dtype=object)

    return pages.withColumn("text", texts(F.coalesce(F.col(column), F.lit("")))).withColumn(
        "n_chars", F.length("text").cast("long"))


def labelled_sample(pages: DataFrame, rows: int = 400, longest: int = 200_000, column: str = "html") -> list[str]:
    """At most `rows` pages that mark their main part, chosen by hash; longer pages than
    `longest` characters are not learned from. Bounds what the driver gets."""
    marked = pages.filter(F.col(column).rlike(r"(?i)<(article|main)[\s>]") & (F.length(column) <= longest))
    return [r[column] for r in few_by_hash(marked.select(column), rows, column).collect()]

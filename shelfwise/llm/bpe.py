"""Operator 1: token counts by heap-and-linked-list byte-pair merging.

The text is split into pieces as the vocabulary's pre-tokenizer does. Inside a piece the
bytes are symbols in a linked list; a heap holds the ranks of adjacent pairs, the lowest
rank is popped, its two symbols become one, and the two new pairs are pushed. The count is
the number of initial symbols less the merges, so no identifiers are emitted. A long piece
costs n log n. Counts of pieces are kept per Python worker, up to `CACHED` of them.

Cases: null or empty text counts 0; special strings of the vocabulary count one token each,
as its library does by default; equal texts have equal counts; an empty table gives an
empty table; other columns are left alone and a column named like an output is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import text_of

#: Pieces whose count a worker keeps, and the longest piece kept.
CACHED = 500_000
KEPT_CHARS = 48

# White space, letters and numbers among the first 256 characters, and all white space.
_LATIN = (r"\t\n\x0b\x0c\r \x85\xa0", "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe")
_WHITE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"


def _class(kind: str) -> str:
    """The characters of a Unicode main category as the inside of a character class."""
    spans: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == kind:
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


@cache
def piece_pattern(latin: bool) -> re.Pattern:
    """The byte-level pre-tokenizer's pattern: letters, contractions, numbers, others and
    white space; `latin` for texts of the first 256 characters only, which is faster."""
    white, letter, number = _LATIN if latin else (_WHITE, _class("L"), _class("N"))
    return re.compile(
        f" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^{white}{letter}{number}]+"
        f"|[{white}]+(?![^{white}])|[{white}]+"
    )


_beyond_latin = re.compile("[^\x00-\xff]").search


def pieces(text: str) -> list[str]:
    """The pre-tokenizer's pieces of a text."""
    return piece_pattern(_beyond_latin(text) is None).findall(text)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PieceCounts(dict):
    """Tokens of a piece, merged when it is first asked for."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.first = [vocab[s] for s in byte_symbols()]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a] << 16 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        if max(vocab.values()) >= 1 << 16:
            raise ValueError("the vocabulary has more than 65,536 tokens")

    def __missing__(self, piece: str) -> int:
        n = self.merged(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = n
        return n

    def merged(self, piece: str) -> int:
        ids = [self.first[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = len(ids)
        rank_of, made, push, pop = self.ranks.get, self.made, heapq.heappush, heapq.heappop
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The rank of the pair that starts at each symbol; a popped rank that differs is stale.
        pair = [rank_of(a << 16 | b, -1) for a, b in zip(ids, ids[1:])] + [-1]
        heap = [r * n + i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        merges = 0
        while heap:
            r, i = divmod(pop(heap), n)
            if pair[i] != r:
                continue
            j = after[i]
            ids[i] = made[r]
            pair[j] = -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair[i] = r = rank_of(ids[i] << 16 | ids[k], -1)
                if r >= 0:
                    push(heap, r * n + i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                pair[h] = r = rank_of(ids[h] << 16 | ids[i], -1)
                if r >= 0:
                    push(heap, r * n + h)
        return n - merges

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return sum(map(self.__getitem__, pieces(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self[p] for part in parts for p in pieces(part))


@cache
def counts_of(path: str) -> PieceCounts:
    """One table per worker and vocabulary."""
    return PieceCounts(path)


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of a text column under the byte-level vocabulary file at `path`."""

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        count = counts_of(path).count
        return pd.Series([count(t) for t in texts], dtype="int64")

    return tokens(text)


def count_tokens(docs: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """Add `n_bytes`, `n_tokens` and `over_limit` (more tokens than `limit`)."""
    return (
        docs.withColumn("n_bytes", F.octet_length(text_of(text)).cast("long"))
        .withColumn("n_tokens", token_count(text_of(text), path))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )

"""Operator 2: SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the numbers of set bits of the
segments (0 to 2 each) are a point in a grid. The Manhattan distance of two points is at
most the Hamming distance of the fingerprints. A range join over the grid finds all points
within the radius: two points within distance r differ on at most r axes, so of `GROUPS`
groups of axes at least GROUPS - r agree, and each choice of so many groups is one grid of
cells (`cells`). In a cell the Manhattan bound is checked first, then the exact distance.

Equal fingerprints are one row from the start. In a cell only a spanning star of each
linked set is emitted, never all pairs, by a search that compares a fingerprint with those
not reached yet; cells with more than `CROWDED` fingerprints are first split by exact bits
(`_by_blocks`), which is exact as well. A crowded cell of one table goes to one task, and
its rows are 8 bytes each; the tables of one group of copies spread over the tasks.

Cases: null or empty text has fingerprint 0 and is linked like any other; equal texts share
a fingerprint; repeated rows and null ids stay, a component's id is its smallest id that is
not null; an empty table gives an empty result; extra columns stay, and a column named like
an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hex64, stored, text_of, with_row
from shelfwise.llm.components import components

RADIUS = 4
GROUPS = 7
SHINGLE = 4
SEED = 42
#: Cells up to this size are compared pairwise, larger ones searched, crowded ones split.
SMALL = 16
CROWDED = 50_000
_LOW = 0x5555555555555555


def fingerprint_of(text: str, words: int = SHINGLE, seed: int = SEED) -> int:
    """The majority of each bit over the XXH64 of the text's word shingles."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    a, b = starts[:n].tolist(), ends[-n:].tolist()
    h = np.array([digest(joined[i:j], seed) for i, j in zip(a, b)], dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        votes += np.unpackbits(h[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: str = "text") -> Column:
    @F.pandas_udf("long")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")

    return made(text_of(text))


def _signed(m: int) -> int:
    return m - ((m >> 63) << 64)


def cells(groups: int = GROUPS, radius: int = RADIUS) -> list[int]:
    """The bits of the packed embedding that each grid table looks at."""
    cuts = [32 * i // groups for i in range(groups + 1)]
    bits = [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(cuts, cuts[1:])]
    return [_signed(sum(bits[c] for c in chosen)) for chosen in combinations(range(groups), groups - radius)]


def embedding(fp: Column) -> Column:
    """Popcounts of the 32 segments, two bits each in one long."""
    low = F.lit(_LOW).cast("long")
    # Added without carries: no segment counts above 2.
    a, b = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    both = F.shiftleft(a.bitwiseAND(b), 1)
    return both.bitwiseOR(a.bitwiseXOR(b))


def _popcounts(x: np.ndarray) -> np.ndarray:
    return (x & np.uint64(_LOW)) + (x >> np.uint64(1) & np.uint64(_LOW))


def _manhattan(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sum over the segments of |p - q|, with segments as two-bit fields up to 2: fields
    that differ by 1 and by 2 are told apart by their bits (0 and 2 are 00 and 10)."""
    low = np.uint64(_LOW)
    x = p ^ q
    odd = x & low  # one of both is 1: they differ by 1
    even = x >> np.uint64(1) & low & ~odd  # 0 and 2
    return np.bitwise_count(odd) + 2 * np.bitwise_count(even)


def _linked(one: np.uint64, many: np.ndarray, radius: int) -> np.ndarray:
    near = _manhattan(_popcounts(one), _popcounts(many)) <= radius
    near[near] = np.bitwise_count(many[near] ^ one) <= radius
    return near


def _stars(x: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(members, smallest member) of the linked sets of distinct fingerprints `x`."""
    open_ = np.sort(x)
    while len(open_):
        reached, queue = [open_[:1]], [open_[0]]
        open_ = open_[1:]
        while queue and len(open_):
            near = _linked(queue.pop(), open_, radius)
            if near.any():
                found = open_[near]
                reached.append(found)
                queue.extend(found)
                open_ = open_[~near]
        members = np.concatenate(reached)
        if len(members) > 1:
            yield members[1:], np.full(len(members) - 1, members.min())


def _by_blocks(x: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a crowded cell: two fingerprints within the radius agree in at least four
    of eight bytes, so each choice of four bytes sorts them into small runs."""
    for chosen in combinations(range(radius + 4), 4):
        width = 64 // (radius + 4)
        mask = np.uint64(sum(((1 << width) - 1) << width * c for c in chosen))
        key = x & mask
        order = np.argsort(key, kind="stable")
        bounds = np.flatnonzero(np.diff(key[order])) + 1
        for run in np.split(order, bounds):
            if len(run) > 1:
                yield from _stars(x[run], radius)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning stars of the cells; rows come sorted by table and cell."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def search(table: np.ndarray, cell: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        x = fp.view(np.uint64)
        new = np.flatnonzero((np.diff(cell) != 0) | (np.diff(table) != 0)) + 1
        starts = np.concatenate([[0], new])
        sizes = np.diff(np.concatenate([starts, [len(x)]]))
        run = np.repeat(np.arange(len(starts)), sizes)
        small = sizes[run] <= SMALL
        a, b = [], []
        for gap in range(1, SMALL):
            i = np.flatnonzero((run[:-gap] == run[gap:]) & small[:-gap]) if gap < len(x) else np.empty(0, int)
            if not len(i):
                break
            near = _manhattan(_popcounts(x[i]), _popcounts(x[i + gap])) <= RADIUS
            near[near] = np.bitwise_count(x[i[near]] ^ x[i[near] + gap]) <= RADIUS
            a.append(x[i[near]])
            b.append(x[i[near] + gap])
        for k in np.flatnonzero(sizes > SMALL):
            members = x[starts[k]:starts[k] + sizes[k]]
            for m, root in (_by_blocks if len(members) > CROWDED else _stars)(members, RADIUS):
                a.append(m)
                b.append(root)
        if a and sum(map(len, a)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], ["a", "b"])

    for batch in batches:
        columns = tuple(np.asarray(batch.column(i)) for i in range(3))
        if not len(batch):
            continue
        held.append(columns)
        table, cell, _ = columns
        # The last cell of a batch may go on in the next.
        last = np.flatnonzero((table != table[-1]) | (cell != cell[-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            held[-1] = tuple(c[:cut] for c in columns)
            yield from search(*map(np.concatenate, zip(*held)))
            held = [tuple(c[cut:] for c in columns)]
    if held:
        yield from search(*map(np.concatenate, zip(*held)))


def link(fingerprints: DataFrame) -> DataFrame:
    """Links (`a`, `b`) that connect all distinct values of `fingerprint` within the radius."""
    tables = [F.struct(F.lit(t).alias("table"), F.col("_p").bitwiseAND(F.lit(m).cast("long")).alias("cell"))
              for t, m in enumerate(cells())]
    placed = fingerprints.withColumn("_p", embedding(F.col("fingerprint"))).select(F.inline(F.array(*tables)), "fingerprint")
    return placed.repartition("table", "cell").sortWithinPartitions("table", "cell").mapInArrow(_links, "a long, b long")


def grouped(keyed: DataFrame, key: str, text: str) -> DataFrame:
    """For documents with a row key `_row`: `_row`, `_id`, `_fp`, `component_id`, stored."""
    narrow = stored(keyed.select("_row", F.col(key).alias("_id"), fingerprint(text).alias("_fp")), "fingerprints")
    own = narrow.groupBy("_fp").agg(F.min("_id").alias("_least"))
    roots = components(link(own.select(F.col("_fp").alias("fingerprint"))))
    rooted = own.join(roots, own["_fp"] == roots["node"], "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(least, "_root").select("_fp", "_root", "component_id")
    return stored(narrow.join(named, "_fp"), "near-groups")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add `fingerprint` (16 hex digits) and `component_id`, the smallest id that is reached."""
    keyed = with_row(docs.drop("fingerprint", "component_id"))
    found = grouped(keyed, key, text).select("_row", hex64(F.col("_fp")).alias("fingerprint"), "component_id")
    return keyed.join(found, "_row").drop("_row")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each component; of equal ids the first row."""
    keyed = with_row(docs)
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row"))["_row"]
    kept = grouped(keyed, key, text).groupBy("_root").agg(first.alias("_row")).select("_row")
    return keyed.join(kept, "_row", "left_semi").drop("_row")

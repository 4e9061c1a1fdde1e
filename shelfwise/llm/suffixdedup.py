"""Operator 10: repeated passages by bucket-pointer refinement over suffix positions.

Every byte that a string of `length` bytes covers which also starts anywhere else is
removed, in the same document or in another. Suffixes need to be told apart only up to
that length, and most need not be sorted at all:

1. Initial buckets: every window of `length` bytes has one anchor, the q-gram in it whose
   hash is smallest (the last of equals). Equal windows have equal anchors at the same
   offset, so the windows of an anchor, neighbours all, form a block, and only blocks whose
   q-gram occurs twice go on. These are the q-gram buckets.
2. A block carries two bucket pointers: its core, the string common to all its windows, and
   its whole span. If the span's bucket has two members, all windows of the block are
   repeated and the block is settled. If all members of the core's bucket are settled, no
   one needs its windows again. Otherwise the bucket is mixed.
3. Blocks of mixed buckets are cut into smaller blocks at offsets counted from the anchor,
   whose buckets refine the ones before, down to single windows, where core and span are
   the same string (`LEVELS`).

Strings are named by 64-bit hashes of their bytes and length. Buckets are counted by
aggregations with a map side, then joined back; a bucket with very many members is a skewed
join that Spark can split. Texts are shuffled once; later rounds carry only documents that
have mixed blocks. Equal texts are one witness with a weight.

Cases: null text is empty; texts shorter than `length` lose nothing; long texts are treated
as any other; repeated rows are different documents with equal texts; an empty table gives
an empty result; extra columns go along. Bytes are removed
even inside a character; what is left is cut text, in which `remove` drops broken ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import stored, text_of, with_row

LENGTH = 200
GRAM = 32
#: Windows in a block after each refinement.
LEVELS = (16, 4, 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


@cache
def _bytes_table() -> np.ndarray:
    """A fixed 64-bit number for each byte."""
    return np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], dtype=np.uint64)


_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2 ** 64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(1 << 16, 2 * n) + 1
        _powers[:] = []
        for b in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            _powers.append(np.cumprod(p, dtype=np.uint64))
    return _powers[0], _powers[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Text:
    """Hashes of all substrings of one text from prefix sums."""

    def __init__(self, raw: bytes):
        self.n = len(raw)
        power, self.inverse = _power(self.n)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(_bytes_table()[np.frombuffer(raw, dtype=np.uint8)] * power[:self.n], out=self.sums[1:])

    def names(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """64-bit names of the strings [start, end) together with `salt`."""
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        extra = (np.asarray(end - start, dtype=np.uint64) << np.uint64(32)) + np.asarray(salt, dtype=np.uint64)
        return _mix(_mix(h) + extra * np.uint64(0xA0761D6478BD642F)).view(np.int64)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors and the first and last start of their windows."""
        none = np.empty(0, dtype=np.int64)
        windows = self.n - LENGTH + 1
        if windows <= 0:
            return none, none, none
        h = _mix((self.sums[GRAM:] - self.sums[:-GRAM]) * self.inverse[:self.n - GRAM + 1])
        width = LENGTH - GRAM + 1
        last = np.uint64(0xFFFFFFFF)
        # The hash's upper half orders q-grams, then the later position.
        key = (h & ~last) | (last - np.arange(len(h), dtype=np.uint64))
        padded = np.full(-(-len(key) // width) * width, np.uint64(_MASK))
        padded[:len(key)] = key
        rows = padded.reshape(-1, width)
        upto = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(after[:windows], upto[width - 1:width - 1 + windows])
        anchor = (last - (least & last)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        return anchor[first], first, np.concatenate([first[1:], [windows]]) - 1


def _pack(anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A block in one long: anchor, its distance from the first window, number of windows - 1."""
    return anchor << 16 | (anchor - lo) << 8 | (hi - lo)


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    anchor = at >> 16
    lo = anchor - (at >> 8 & 0xFF)
    return anchor, lo, lo + (at & 0xFF)


def _span_names(text: Text, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Names of whole spans, told apart by their place around the anchor."""
    return text.names(lo, hi + LENGTH, ((anchor - lo) << 8 | (hi - lo)) + 1)


def _refine(text: Text, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut blocks into blocks of `size` windows: cores, spans, packed blocks."""
    anchor, lo, hi = _unpack(at)
    near, far = (anchor - hi) // size, (anchor - lo) // size  # offsets from the anchor, in blocks
    count = far - near + 1
    which = np.repeat(np.arange(len(at)), count)
    step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + near[which]
    a = anchor[which]
    nominal_hi, nominal_lo = a - step * size, a - step * size - size + 1
    lo, hi = np.maximum(lo[which], nominal_lo), np.minimum(hi[which], nominal_hi)
    core = text.names(nominal_hi, nominal_lo + LENGTH)
    span = core if size == 1 else _span_names(text, a, lo, hi)
    return core, span, _pack(a, lo, hi)


_ITEM = "core long, span long, _row long, at long, weight int"
_ITEM_ARROW = pa.schema([("core", pa.int64()), ("span", pa.int64()), ("_row", pa.int64()), ("at", pa.int64()), ("weight", pa.int32())])


def _item_batches(made: Iterator[tuple[int, int, tuple[np.ndarray, np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    """(row, weight, (cores, spans, blocks)) as Arrow batches of bounded size."""
    parts: list[tuple] = []
    size = 0

    def close() -> pa.RecordBatch:
        core, span, at = (np.concatenate([p[2][k] for p in parts]) for k in range(3))
        n = [len(p[2][0]) for p in parts]
        row, weight = np.repeat([p[0] for p in parts], n), np.repeat([p[1] for p in parts], n)
        return pa.RecordBatch.from_arrays(
            [pa.array(core), pa.array(span), pa.array(row, pa.int64()), pa.array(at), pa.array(weight.astype(np.int32))], schema=_ITEM_ARROW)

    for p in made:
        if len(p[2][0]):
            parts.append(p)
            size += len(p[2][0])
        if size >= 50_000:
            yield close()
            parts, size = [], 0
    if parts:
        yield close()


def _first_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the anchors' q-grams."""
    for batch in batches:
        made = [np.empty(0, np.int64)]
        for raw in batch.column(0):
            text = Text(raw.as_buffer().to_pybytes())
            anchor, _, _ = text.blocks()
            made.append(text.names(anchor, anchor + GRAM))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(made))], ["core"])


def _first_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = Text(raw.as_buffer().to_pybytes())
                anchor, lo, hi = text.blocks()
                yield row, 1, (text.names(anchor, anchor + GRAM), _span_names(text, anchor, lo, hi), _pack(anchor, lo, hi))

    return _item_batches(made())


def _refined_items(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for batch in batches:
                rows, weights = batch.column("_row").to_pylist(), batch.column("weight").to_pylist()
                for i, (row, weight) in enumerate(zip(rows, weights)):
                    at = np.sort(np.asarray(batch.column("open")[i].values, dtype=np.int64))
                    yield row, weight, _refine(Text(batch.column("raw")[i].as_py()), at, size)

        return _item_batches(made())

    return run


def _by_row(items: DataFrame) -> DataFrame:
    """Per document its blocks whose core is repeated: the settled ones (`cover`, the span is
    repeated) and those to refine (`open`, some member of the core's bucket is not settled).

    A span with one member needs no join to find that member: it comes along with the count.
    So the only join is by core, and what goes to a document goes there once.
    """
    spans = items.groupBy("core", "span").agg(F.sum("weight").alias("members"), F.min(F.struct("_row", "at")).alias("one"))
    cores = spans.groupBy("core").agg(F.sum("members").alias("all"), F.min("members").alias("fewest")).filter(F.col("all") > 1)
    cores = cores.select("core", (F.col("fewest") < 2).alias("mixed"))
    single = spans.filter(F.col("members") < 2).select("one._row", "one.at", F.lit(None).cast("boolean").alias("mixed"))
    kept = items.select("core", "_row", "at").join(cores, "core").select("_row", "at", "mixed")
    lists = kept.unionByName(single).groupBy("_row").agg(
        F.collect_list(F.when(F.col("mixed").isNotNull(), F.col("at"))).alias("known"),
        F.collect_list(F.when(F.col("mixed").isNull(), F.col("at"))).alias("single"),
        F.collect_list(F.when(F.col("mixed"), F.col("at"))).alias("open"))
    return lists.filter(F.size("known") > 0).select("_row", F.array_except("known", "single").alias("cover"), "open")


def _spans(raw_len: int, cover: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs of the settled blocks."""
    at = np.concatenate(cover) if cover else np.empty(0, np.int64)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    _, lo, hi = _unpack(at)
    mark = np.zeros(raw_len + 1, dtype=np.int64)
    np.add.at(mark, lo, 1)
    np.add.at(mark, hi + LENGTH, -1)
    inside = np.concatenate([[0], (np.cumsum(mark) > 0).astype(np.int8), [0]])
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_LONGS = pa.list_(pa.int64())
_DONE = {
    "_row": (T.LongType(), pa.int64()), "done": (T.BooleanType(), pa.bool_()), "n_bytes": (T.LongType(), pa.int64()),
    "n_removed": (T.LongType(), pa.int64()), "n_spans": (T.LongType(), pa.int64()), "kept_sha256": (T.StringType(), pa.string()),
    "raw": (T.BinaryType(), pa.binary()), "weight": (T.IntegerType(), pa.int32()),
    "cover": (T.ArrayType(T.LongType()), _LONGS), "open": (T.ArrayType(T.LongType()), _LONGS),
}


def _finish(state: DataFrame, last: bool, with_text: bool) -> DataFrame:
    """Cut texts that have no blocks to refine, hand on the others; `keep` goes along."""

    def result(r: dict) -> dict:
        raw, n = r["raw"], len(r["raw"])
        if r["weight"] > 1 and n >= LENGTH:  # the text occurs twice as a whole
            start, end = np.array([0]), np.array([n])
        else:
            start, end = _spans(n, [np.array(r["cover"] or [], dtype=np.int64)])
        bounds = [0, *np.stack([start, end], axis=1).ravel().tolist(), n]
        kept = b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2])) if len(start) else raw
        return {
            "_row": r["_row"], "done": True, "n_bytes": n, "n_removed": n - len(kept), "n_spans": len(start),
            "kept_sha256": hashlib.sha256(kept).hexdigest(), "raw": kept.decode("utf-8", "ignore").encode() if with_text else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, len(whole), 500):
                batch = whole.slice(first, 500)
                keep, made, of = batch.column("keep"), [], []
                for i, r in enumerate(batch.drop_columns(["keep"]).to_pylist()):
                    copied = r["weight"] > 1 and len(r["raw"]) >= LENGTH
                    pending = not last and r["first"] and bool(r["open"])
                    if copied or not pending:
                        made.append(result(r))
                        of.append(i)
                    if pending:  # also a text that is copied: others need it as a witness
                        made.append({"_row": r["_row"], "done": False} | {k: r[k] for k in ("raw", "weight", "cover", "open")})
                        of.append(i)
                columns = [pa.array([m.get(n) for m in made], t) for n, (_, t) in _DONE.items()]
                yield pa.RecordBatch.from_arrays([*columns, keep.take(pa.array(of, pa.int64()))], [*_DONE, "keep"])

    fields = [T.StructField(n, k) for n, (k, _) in _DONE.items()]
    return state.mapInArrow(run, T.StructType([*fields, state.schema["keep"]]))


def _cut(docs: DataFrame, text: str, with_text: bool) -> DataFrame:
    """`n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, if asked for `raw`, and `keep`, a
    struct of the document's columns other than the text (and whether that is null)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    keyed = with_row(docs.select(
        text_of(text).cast("binary").alias("raw"), F.struct(*others, F.col(text).isNull().alias("_null")).alias("keep")))
    raw = keyed.select("_row", "raw")
    cores = raw.select("raw").mapInArrow(_first_cores, "core long")
    repeated = cores.groupBy("core").count().filter("count > 1").select("core")
    # Equal texts: the first row stands for all, the others are not looked at again.
    copies = raw.groupBy(F.md5("raw").alias("digest")).agg(F.min("_row").alias("_row"), F.count("*").alias("copies"))
    copies = copies.select("_row", F.least("copies", F.lit(2)).cast("int").alias("copies"))
    firsts = stored(copies, "first-texts")
    blocks = stored(
        raw.mapInArrow(_first_items, _ITEM).join(repeated, "core").drop("weight")
        .join(firsts.withColumnRenamed("copies", "weight"), "_row"), "blocks")
    lists = stored(_by_row(blocks), "lists")
    state = keyed.join(lists, "_row", "left").join(firsts, "_row", "left").select(
        "_row", "raw", "keep", F.coalesce("copies", F.lit(2)).alias("weight"), F.col("copies").isNotNull().alias("first"), "cover", "open")
    results = stored(_finish(state, False, with_text), "cut")
    pending = results.filter("NOT done").select("_row", "raw", "weight", "cover", "open", "keep")
    texts = pending.select("_row", "raw", "weight", "keep")
    covers = [pending.select("_row", "cover")]
    now = pending
    for size in LEVELS:
        # Read twice, so kept on the executors' disks; a lost one is made again.
        items = now.select("_row", "raw", "weight", "open").mapInArrow(_refined_items(size), _ITEM).persist(StorageLevel.DISK_ONLY)
        marked = stored(_by_row(items), f"blocks-{size}")
        items.unpersist()
        covers.append(marked.select("_row", "cover"))
        now = texts.join(marked.filter(F.size("open") > 0).select("_row", "open"), "_row")
    union = covers[0]
    for c in covers[1:]:
        union = union.unionByName(c)
    final = union.groupBy("_row").agg(F.flatten(F.collect_list("cover")).alias("cover"))
    # A copied text is removed whole already.
    whole = (F.col("weight") > 1) & (F.octet_length("raw") >= LENGTH)
    rest = texts.filter(~whole).join(final, "_row").select(
        "_row", "raw", "keep", "weight", F.lit(True).alias("first"), "cover", F.array().cast("array<long>").alias("open"))
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "keep", *(["raw"] if with_text else [])]
    return results.filter("done").select(columns).unionByName(_finish(rest, True, with_text).select(columns))


def repeated_bytes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every document's columns but the text, with `n_bytes`, `n_removed`, `n_spans` and
    `kept_sha256`."""
    outputs = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    rows = _cut(docs.drop(*outputs), text, with_text=False)
    return rows.select("keep.*", *outputs).drop("_null")


def remove(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by what is left of it; null stays null. Bytes of characters that
    were cut in two are dropped."""
    rows = _cut(docs, text, with_text=True)
    return rows.select(F.when(~F.col("keep._null"), F.col("raw").cast("string")).alias(text), "keep.*").select(
        *[f"`{c}`" for c in docs.columns])

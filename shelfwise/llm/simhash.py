"""Operator 4: SimHash document fingerprints, with DataFrame functions only.

Terms are pairs of adjacent words. A term's 64 hash bits vote, each with the term's weight
(its number of characters, at most `HEAVIEST`, so pairs of short common words count less);
a fingerprint bit is set where the votes for it are more than half of all weight.

Votes are added in lanes: a long holds four 16-bit counters, so sixteen sums give the votes
of all 64 bits in one generated aggregation. Terms of a document are exploded and summed
within the task that made them; a long document is cut into runs of `RUN` terms, which
keeps the lanes from overflowing.

`near` finds all pairs of fingerprints within a Hamming radius of two tables by permuted
blocks: of `blocks` blocks of bits, at least blocks - radius are equal in such a pair, so
each choice of that many blocks is a table whose keys are joined and then verified.

Cases: null text is empty; a text without words has fingerprint 0; equal texts have equal
fingerprints; repeated rows are separate; null ids are one group; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import BLANK, hex64, text_of, with_row

HEAVIEST = 15
#: Terms summed in one lane: RUN * HEAVIEST stays below 2 ** 15, as the last lane has the sign.
RUN = 2048
LANES = 16
_SPREAD = 1 | 1 << 15 | 1 << 30 | 1 << 45
_LANE_BITS = 1 | 1 << 16 | 1 << 32 | 1 << 48


def words(text: Column) -> Column:
    """The words of a text; none is an empty array."""
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _spread(hash_: Column, lane: int) -> Column:
    """Bits 4 * lane .. 4 * lane + 3 of a hash, one in each 16-bit counter of a long."""
    four = F.shiftrightunsigned(hash_, 4 * lane).bitwiseAND(F.lit(15).cast("long"))
    return (four * F.lit(_SPREAD)).bitwiseAND(F.lit(_LANE_BITS))


def fingerprints(texts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """`keys` (unique together) and `fingerprint` (long) of each text."""
    w = words(F.col(text))
    pairs = F.arrays_zip(w.alias("a"), F.slice(w, F.lit(2), F.greatest(F.size(w), F.lit(1))).alias("b"))
    terms = texts.select(*keys, F.posexplode_outer(pairs).alias("_term", "_pair"))
    a, b = F.col("_pair.a"), F.col("_pair.b")
    weight = F.least(F.coalesce(F.length(a), F.lit(0)) + F.coalesce(F.length(b), F.lit(0)), F.lit(HEAVIEST)).cast("long")
    voted = terms.select(
        *keys, F.floor(F.coalesce("_term", F.lit(0)) / RUN).alias("_run"), F.xxhash64(a, b).alias("_h"), weight.alias("_w"))
    lanes = [F.sum(_spread(F.col("_h"), i) * F.col("_w")).alias(f"_v{i}") for i in range(LANES)]
    runs = voted.groupBy(*keys, "_run").agg(*lanes, F.sum("_w").alias("_all"))
    counters = {
        4 * i + j: F.shiftrightunsigned(f"_v{i}", 16 * j).bitwiseAND(F.lit(0xFFFF).cast("long")) for i in range(LANES) for j in range(4)}
    votes = runs.groupBy(*keys).agg(*[F.sum(counters[k]).alias(f"_b{k}") for k in range(64)], F.sum("_all").alias("_all"))
    bits = [F.shiftleft((F.col(f"_b{k}") * 2 > F.col("_all")).cast("long"), k) for k in range(64)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return votes.select(*keys, total.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)).cast("double") / 64.0


def _masks(radius: int, blocks: int) -> list[int]:
    """The bits of each choice of blocks - radius blocks, as signed longs."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    bits = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    sums = [sum(bits[c] for c in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    return [m - ((m >> 63) << 64) for m in sums]


def near(queries: DataFrame, table: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """Pairs (`query`, `fingerprint`, `distance`) of distinct values of column `fingerprint`
    of the two tables within `radius` bits. Each pair comes from the first block table in
    which it is equal."""
    masks = _masks(radius, blocks)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        keys = [F.struct(F.lit(t).alias("table"), F.col(name).bitwiseAND(F.lit(m).cast("long")).alias("key"))
                for t, m in enumerate(masks)]
        return df.select(F.col("fingerprint").alias(name)).distinct().select(name, F.inline(F.array(*keys)))

    q, f = keyed(queries, "query").alias("q"), keyed(table, "fingerprint").alias("f")
    differ = F.col("query").bitwiseXOR(F.col("fingerprint"))
    first = F.lit(None).cast("int")
    for t, m in reversed(list(enumerate(masks))):
        first = F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, t).otherwise(first)
    same = (F.col("q.table") == F.col("f.table")) & (F.col("q.key") == F.col("f.key"))
    met = q.join(f, same & (F.bit_count(differ) <= radius) & (first == F.col("q.table")))
    return met.select("query", "fingerprint", F.bit_count(differ).alias("distance"))


def with_next(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Each document with the text of the next one in descending id order, after the last
    the first: columns `_slice`, `_at`, `doc_id`, `text`, `next_text`, `guest`.

    The ids are cut at quantiles into slices, one window partition each. The first row of
    the slice below (of the first slice, after the last) is a guest at the end of a slice,
    so nothing is looked up across slices. Only `slices` numbers (four times the shuffle
    partitions, 200 at least) come to the driver, and as many rows are broadcast.
    """
    slices = slices or max(200, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = with_row(docs.select("doc_id", text_of().alias("text")))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_row")]
    ids = keyed.select("_row", "doc_id")
    shares = [i / slices for i in range(1, slices)]
    cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 100 * slices).alias("q")).first()["q"] or []))
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    # Slices count up from the largest ids; null ids come last.
    number = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(
        F.size(F.filter(bounds, lambda c: c >= F.col("doc_id"))))
    first = ids.withColumn("_slice", number).groupBy("_slice").agg(
        F.min(F.struct((-F.coalesce("doc_id", F.lit(0))).alias("down"), F.col("_row"))).alias("first"))
    whole = Window.partitionBy().orderBy("_slice")
    before = F.coalesce(F.lag("_slice").over(whole), F.max("_slice").over(Window.partitionBy()))
    guests = first.select(F.col("first._row").alias("_row"), before.alias("_host"))  # a row a slice
    joined = keyed.withColumn("_slice", number).join(F.broadcast(guests), "_row", "left")
    places = F.array_compact(F.array(
        F.struct(F.col("_slice").alias("_slice"), F.lit(False).alias("guest")),
        F.when(F.col("_host").isNotNull(), F.struct(F.col("_host").alias("_slice"), F.lit(True).alias("guest")))))
    placed = joined.select("_row", "doc_id", "text", F.inline(places))
    inside = Window.partitionBy("_slice").orderBy("guest", *order)
    return placed.select(
        "_slice", F.row_number().over(inside).alias("_at"), "doc_id", "text", "guest", F.lead("text").over(inside).alias("next_text"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document's text.

    The edited text has the last third of the code points replaced by the first as many of
    the next document.
    """
    rows = with_next(docs)
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - third),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))
    facts = rows.select(
        "_slice", "_at", "doc_id", "guest", F.length("text").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.col("text").alias("text")),
            F.struct(F.lit(1).alias("side"), edited.alias("text")))).alias("_e"))
    keys = ["_slice", "_at", "doc_id", "guest", "n_chars", "edited_sha256", "side"]
    each = fingerprints(facts.filter(~(F.col("guest") & (F.col("_e.side") == 1))).select("*", "_e.side", "_e.text"), keys)
    whole = each.groupBy("_slice", "_at", "doc_id", "guest", "n_chars").agg(
        F.max(F.when(F.col("side") == 1, F.col("edited_sha256"))).alias("edited_sha256"),
        F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    after = F.lead("fingerprint").over(Window.partitionBy("_slice").orderBy("_at"))
    return whole.withColumn("next_fingerprint", after).filter(~F.col("guest")).drop("guest", "_slice", "_at")


def digest(found: DataFrame, *more: Column) -> DataFrame:
    """Hex fingerprints and likenesses of `edited_fingerprints`, and more columns."""
    return found.select(
        "doc_id", "n_chars", "edited_sha256", hex64(F.col("fingerprint")).alias("fingerprint"),
        hex64(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), *more)

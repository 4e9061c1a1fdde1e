"""Operator 3: mixing sources to target weights by cube-method balanced sampling.

A source's target is its weight's share of the mix, at most `most` times its size; the
excess is shared again by weight. Each document then has the expected number of copies
target / source size. The whole part is taken for certain; the fraction is the document's
inclusion probability. The flight phase of the cube method moves these probabilities
through the null space of two constraints of each source, document total and word total,
until a small landing problem is left of a group: first in groups of some `GROUP` documents
of a source, then among what is left in groups of these groups, at last by source. A few
documents of all sizes stay out of the flight; the landing tries all roundings of these and
of the last two of a source and takes the one whose word total is nearest its target, the
document total being right within one.

Groups and draws come from a hash of the document's columns, and each group is sorted by
it, so the mix depends on the rows alone, not on files, partitions or order; equal rows are
interchangeable. A source is split into groups however large it is; what is left after each
flight is at most 14 rows a group, and one row per source goes to one place.

Cases: null text has size 0; null source is a source of its own, last in order; documents
of size 0 are never in the mix's words and take 0; repeated rows are separate documents;
sources of size 0 have target 0; an empty table gives an empty result; extra columns stay,
those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, stored, text_of, with_row

#: Nearer to 0 or 1 than this is decided.
EPS = 1e-9
#: Documents of a group in the first flight, about; and groups that fly together in the next.
GROUP = 4_000
TOGETHER = 1024
#: Documents of a group, evenly spread over the order of sizes, that stay out of its flight
#: and land together with the two that a flight leaves.
LANDING = 12


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], total: float, most: float) -> DataFrame:
    """Targets of sources: rows (source, source_size) get `target`.

    `weights` repeat over the sources in code-point order, null last. A source is capped
    at `most` times its size; with sources in order of cap by weight, the capped ones are
    the first k, and the others share what is left in proportion to their weights. One row
    per source, so one sort in one place is bounded by the number of sources.
    """
    everything = Window.partitionBy()
    ordered = sizes.select(
        "source", "source_size",
        F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())).alias("_at"),
        F.sum("source_size").over(everything).alias("_all"),
    )
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("_at") - 1, F.lit(len(weights))).cast("int") + 1)
    capped = ordered.withColumn("_w", w).withColumn("_cap", F.col("source_size") * float(most))
    by_ratio = everything.orderBy(F.col("_cap") / F.col("_w"), "_at")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    mix = F.col("_all") * float(total)
    level = (mix - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) / F.sum("_w").over(after)
    # The level rises while the source's cap is below it; the first source that is not
    # capped fixes it for all that follow.
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fixed = F.first(F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.col("_level")), ignorenulls=True).over(whole)
    return (
        capped.withColumn("_level", level).withColumn("_fixed", fixed)
        .withColumn("target", F.when(F.col("_cap") <= F.coalesce("_fixed", F.lit(float("inf"))) * F.col("_w"), F.col("_cap"))
                    .otherwise(F.col("_fixed") * F.col("_w")))
        .select("source", "source_size", "target")
    )


def fly(chance: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Flight of one group: returns chances of which at most `LANDING` + 2 are undecided.

    Keeps the sum of chances and the sum of chance times size. Three undecided units have
    one direction that changes neither sum; a step along it, one way or the other with the
    chance that keeps expectations, decides at least one of them.
    """
    p = chance.astype(float)
    # A step uses the draw of the document that has just entered, so each draw is used once;
    # equal sizes are ordered by the draw's lower bits, which do not tell its size.
    order = np.lexsort((draw * (1 << 20) % 1, -size))
    order = order[(p[order] > EPS) & (p[order] < 1 - EPS)]
    held: list[int] = []
    for i in np.delete(order, np.linspace(0, len(order) - 1, LANDING).astype(int) if len(order) > LANDING else slice(None)):
        held.append(int(i))
        if len(held) < 3:
            continue
        a, b, c = held
        v = np.array([size[b] - size[c], size[c] - size[a], size[a] - size[b]], dtype=float)
        if not v.any():
            v = np.array([1.0, -1.0, 0.0])
        x = p[held]
        with np.errstate(divide="ignore"):
            up = np.where(v > 0, (1 - x) / v, np.where(v < 0, -x / v, np.inf)).min()
            down = np.where(v > 0, x / v, np.where(v < 0, (x - 1) / v, np.inf)).min()
        step = up if draw[i] * (up + down) < down else -down
        p[held] = np.clip(x + step * v, 0.0, 1.0)
        held = [k for k in held if EPS < p[k] < 1 - EPS]
    return np.where(p >= 1 - EPS, 1.0, np.where(p <= EPS, 0.0, p))


def _fly_group(group: pd.DataFrame) -> pd.DataFrame:
    """The flight of one group, in the order of its draws."""
    group = group.sort_values(["_u", "size"], ignore_index=True)
    return group.assign(_p=fly(group["_p"].to_numpy(), group["size"].to_numpy(), group["_u"].to_numpy()))


def _land(group: pd.DataFrame) -> pd.DataFrame:
    """Fly what is left of a source, then round the last ones."""
    group = _fly_group(group)
    size, p = group["size"].to_numpy(), group["_p"].to_numpy().copy()
    rest = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    ways = np.arange(1 << len(rest))[:, None] >> np.arange(len(rest)) & 1
    off = np.abs(ways @ size[rest] - (p[rest] * size[rest]).sum())
    uneven = np.abs(ways.sum(axis=1) - p[rest].sum()) >= 1
    p[rest] = ways[np.lexsort((off, uneven))[0]]
    return group.assign(_p=p)


def _hashed(docs: DataFrame) -> Column:
    """A hash of all columns but those that have none."""
    no_hash = ("map", "variant")
    return F.xxhash64(F.lit(7), *[F.col(f"`{c}`") for c, t in docs.dtypes if not any(k in t for k in no_hash)])


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add `size`, `source_size`, `target`, `copies` and `taken` to every document."""
    plain = docs.drop("size", "source_size", "target", "copies", "taken", "_row")
    keyed = with_row(plain)
    rows = stored(keyed.select("_row", "source", word_count().alias("size"), _hashed(plain).alias("_hash")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    bits = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("_n") / float(GROUP)))).cast("int")
    sizes = stored(sizes.withColumn("_bits", bits), "mix-sources")  # one row per source
    goal = targets(sizes, weights, total, most).join(sizes.select(F.col("source").alias("_s"), "_bits"), F.col("source").eqNullSafe(F.col("_s")))
    u = (F.shiftrightunsigned("_hash", 11)).cast("double") / float(1 << 53)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    with_goal = rows.alias("r").join(goal.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source"))).select(
        "_row", "r.source", "size", "source_size", "target", u.alias("_u"), share.alias("_share"),
        # The group is the hash's lower bits, as the draw is its upper ones.
        F.expr("_hash & (shiftleft(1L, _bits) - 1)").alias("_g"))
    now = with_goal.select(
        "_row", "source", "size", "source_size", "target", "_u", "_g", F.floor("_share").cast("long").alias("_whole"),
        F.when(F.col("size") > 0, F.col("_share") - F.floor("_share")).otherwise(0.0).alias("_p"))
    kind = now.schema.simpleString()[len("struct<"):-1].replace(":", " ").replace(",", ", ")
    undecided = (F.col("_p") > EPS) & (F.col("_p") < 1 - EPS)
    decided = []
    groups = 1 << (sizes.agg(F.max("_bits")).first()[0] or 0)
    while groups > 1:
        flown = stored(now.filter(undecided).groupBy("source", "_g").applyInPandas(_fly_group, kind), "mix-flight")
        decided += [now.filter(~undecided), flown.filter(~undecided)]
        groups = -(-groups // TOGETHER)
        now = flown.filter(undecided).withColumn("_g", F.pmod("_g", F.lit(groups)))
    decided += [now.filter(~undecided), now.filter(undecided).groupBy("source").applyInPandas(_land, kind)]
    taken = reduce(DataFrame.unionByName, decided).select(
        "_row", "size", "source_size", "target", (F.col("_whole") + F.rint("_p").cast("long")).alias("copies"))
    return keyed.join(taken, "_row").drop("_row").withColumn("taken", F.col("size") * F.col("copies"))


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    return mixed.filter(F.col("copies") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_copy")

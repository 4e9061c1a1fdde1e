"""Global order at scale: running totals, positions, tiles, ranks and exact quantiles.

A window without partition keys sends every row to one task. Here the rows are range
partitioned by the wanted order, pinned with a reliable checkpoint, summed inside each
slice, and shifted by the totals of the slices before it. The only table that is summed
in one place has one row per slice, so its size is the number of shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import pinned

_SLICE = "_slice"


def sliced(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range partition by `order` and record the slice number of each row."""
    return pinned(df.repartitionByRange(*order).withColumn(_SLICE, F.spark_partition_id()))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; keys come from the left side."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    sums: Mapping[str, Column],
    order: Sequence[Column],
    group: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums over `order`, within `group` when given.

    Each sum `n` comes with the total of its group as `all_n`. `order` must be unique
    within the group; equal rows would be summed in any order.
    """
    cut = sliced(df, [*[F.col(g) for g in group], *order])
    keys = [*group, _SLICE]
    per_slice = cut.groupBy(*keys).agg(*[F.sum(c).alias(f"_in_{n}") for n, c in sums.items()])
    whole = Window.partitionBy(*group)
    before = whole.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *keys,
        *[F.coalesce(F.sum(f"_in_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_in_{n}").over(whole).alias(f"all_{n}") for n in sums],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = cut.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])
    return (
        join_on(local, offsets, keys)
        .withColumns({n: F.col(n) + F.col(f"_before_{n}") for n in sums})
        .drop(_SLICE, *[f"_before_{n}" for n in sums])
    )


def shared_totals(
    df: DataFrame, sums: Mapping[str, Column], value: str, descending: bool = True
) -> DataFrame:
    """Running sums, with their totals, where rows of equal `value` share the sum (a RANGE frame).

    Summed per distinct value first, so a value held by many rows stays one row.
    """
    df = pinned(df)
    per_value = df.groupBy(value).agg(*[F.sum(c).alias(f"_at_{n}") for n, c in sums.items()])
    order = F.col(value).desc() if descending else F.col(value).asc()
    totals = running_totals(per_value, {n: F.col(f"_at_{n}") for n in sums}, [order])
    return join_on(df, totals.drop(*[f"_at_{n}" for n in sums]), [value])


def with_rank(df: DataFrame, value: str, name: str, descending: bool = True) -> DataFrame:
    """RANK() over the whole table: one more than the number of rows ahead."""
    df = pinned(df)
    per_value = df.groupBy(value).agg(F.count("*").alias("_n"))
    order = F.col(value).desc() if descending else F.col(value).asc()
    ahead = running_totals(per_value, {"_upto": F.col("_n")}, [order]).select(
        value, (F.col("_upto") - F.col("_n") + 1).cast("int").alias(name)
    )
    return join_on(df, ahead, [value])


def tile_of(position: Column, total: Column, tiles: int) -> Column:
    """NTILE: tile (from 1) of a 1-based position among `total` rows."""
    size, extra = F.floor(total / tiles), total % tiles
    big = extra * (size + 1)
    return (
        F.when(position <= big, F.floor((position - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor((position - 1 - big) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def with_tiles(df: DataFrame, name: str, tiles: int, order: Sequence[Column]) -> DataFrame:
    """NTILE(tiles) over the whole table. `order` must be unique."""
    placed = running_totals(df, {"_pos": F.lit(1).cast("bigint")}, order)
    tile = tile_of(F.col("_pos"), F.col("all__pos"), tiles)
    return placed.withColumn(name, tile).drop("_pos", "all__pos")


def with_scores(df: DataFrame, key: str, values: Mapping[str, Column], tiles: int) -> DataFrame:
    """NTILE(tiles) of several values at once, each ascending with ties in order of `key`.

    `key` is unique. The values are melted to (name, value, key), placed within their name in
    one pass over one range partitioning, and joined back once.
    """
    df = pinned(df)
    entries = [F.struct(F.lit(n).alias("_name"), v.cast("double").alias("_value")) for n, v in values.items()]
    melted = df.select(key, F.explode(F.array(*entries)).alias("_e")).select(key, "_e._name", "_e._value")
    placed = running_totals(
        melted, {"_pos": F.lit(1).cast("bigint")}, [F.col("_value").asc(), F.col(key).asc()], ["_name"])
    tile = tile_of(F.col("_pos"), F.col("all__pos"), tiles)
    scores = placed.groupBy(key).agg(*[F.max(F.when(F.col("_name") == n, tile)).alias(n) for n in values])
    return join_on(df, scores, [key])


def quantiles(
    df: DataFrame, value: str, points: Mapping[str, float], group: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact interpolated quantiles, one row per group.

    Works on counts per distinct value, so neither a large group nor the whole table
    has to fit in one buffer. With `weight`, a row stands for that many equal values.
    """
    n = F.sum(weight) if weight else F.count("*")
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(n.alias("_n"))
    placed = running_totals(counted, {"_upto": F.col("_n")}, [F.col(value).asc()], group)
    picks = []
    for name, p in points.items():
        at = p * (F.col("all__upto") - 1)
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("_upto") > k) & (F.col("_upto") - F.col("_n") <= k)
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{side}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_{name}_part"))
    found = placed.groupBy(*group).agg(*picks)
    return found.select(
        *group,
        *[
            (
                F.col(f"_{n}_lo")
                + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_part")
            ).alias(n)
            for n in points
        ],
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The first row of each key under `order`, ties broken by the remaining columns.

    A limit per group: each task keeps one row per key before the shuffle, so of a key with
    many copies one row per task is left to be compared.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    wanted = [F.col(c) if isinstance(c, str) else c for c in order]
    place = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*wanted, *rest)
    return df.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") == 1).drop("_place")

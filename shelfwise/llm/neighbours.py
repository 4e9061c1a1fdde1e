"""Operator 7: near-duplicate embeddings by NN-descent.

Vectors of one label (and length) form one graph. Lists of nearest neighbours start from
random-projection leaves and are refined by local joins: whoever shares a neighbour is
compared. A list whose entries all reach the threshold is saturated and gets twice the
room in the next round. Rounds go on until few lists change. Links are the list entries at
or above the threshold.

Where lists were saturated, the linked set is what they are enlarged to in the end: its
members are compared block by block with each other, and only their numbers of links are
kept, so no set's pairs are written out. Equal vectors are one node with a count.

`audit` compares bounded samples of vectors, of large sets and of the others apart, with
all others and gives the lower mean recall of a linked vector; below `wanted` the graph is
descended again from the links found so far, other leaves and longer lists. A graph that
stays below is an error.

Comparisons run in blocks of `BLOCK` rows inside tasks; a leaf or neighbourhood of any size
is a sequence of blocks, so no group has to fit into memory.

Cases: vectors that are null, zero, or hold null or non-finite components, and vectors
without a label, link with nothing: they have no links and are their own component. Null
ids stay null and count as links of others. Repeated rows count each. An empty table gives
an empty result; extra columns stay, a column named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import few_by_hash, stored, with_row
from shelfwise.llm.components import components

BLOCK = 64
#: Pairs that one row gets from one block.
OFFERS = 4


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.93
    neighbours: int = 10
    trees: int = 4  # at least; `trees_of` adds more for deep leaves
    growths: int = 3  # doublings of a saturated list; its set is counted exactly
    changed: float = 0.01  # share of lists that may still change in the last round
    rounds: int = 30  # by then an error
    leaf: int = 48
    audited: int = 400
    wanted: float = 0.95
    tries: int = 4


def depth_of(largest: int, leaf: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1.0, largest / leaf)))))


def trees_of(settings: Settings, depth: int, split: float = 0.12, missed: float = 0.05) -> int:
    """So many that a pair which each plane splits with chance `split` shares no leaf with
    chance `missed` at most."""
    together = (1 - split) ** depth
    return max(settings.trees, int(np.ceil(np.log(missed) / np.log1p(-together))) if together < 1 else 1)


_NODE = "_row long, label string, vec binary"


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a usable vector, as unit vectors of doubles; equal input, equal bytes."""
    for batch in batches:
        rows, labels, vecs = [], [], []
        for row, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if label is None or not v.is_valid or v.values.null_count or not len(v.values):
                continue
            x = np.asarray(v.values, dtype=np.float64)
            with np.errstate(all="ignore"):
                x = x / np.abs(x).max() if np.isfinite(x).all() and x.any() else None
            if x is None or not np.isfinite(x).all():
                continue
            rows.append(row)
            labels.append(f"{label}/{len(x)}")
            vecs.append((x / np.sqrt(x @ x) + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(labels, pa.string()), pa.array(vecs, pa.binary())], ["_row", "label", "vec"])


def _matrix(column: pa.Array | list) -> np.ndarray:
    parts = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(parts), dtype=np.float64).reshape(len(parts), -1)


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sim", pa.float64())])


def _offers(groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows sorted by their first `groups` columns (then `_row`, `vec`, `floor`): in each
    block of a group, each row's best others above its floor."""

    def block(ids: np.ndarray, x: np.ndarray, floor: np.ndarray):
        sim = x @ x.T
        sim[ids[:, None] == ids[None, :]] = -2.0
        k = min(OFFERS, len(ids) - 1)
        best = np.argpartition(-sim, k - 1, axis=1)[:, :k] if k < len(ids) - 1 else np.argsort(-sim, axis=1)[:, :k]
        value = np.take_along_axis(sim, best, axis=1)
        i, j = np.nonzero(value > np.maximum(floor, -1.5)[:, None])
        return ids[i], ids[best[i, j]], value[i, j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        size = 0
        key, ids, vecs, floors = None, [], [], []

        def close() -> None:
            nonlocal size
            if len(ids) > 1:
                made.append(block(np.array(ids), _matrix(vecs), np.array(floors)))
                size += len(made[-1][0])
            ids.clear(), vecs.clear(), floors.clear()

        def out() -> pa.RecordBatch:
            nonlocal size
            rows = [pa.array(np.concatenate(c)) for c in zip(*made)]
            made.clear()
            size = 0
            return pa.RecordBatch.from_arrays(rows, schema=_PAIRS)

        for batch in batches:
            for *group, row, vec, floor in zip(*(c.to_pylist() for c in batch.columns[:groups + 3])):
                if group != key or len(ids) >= BLOCK:
                    close()
                    key = group
                ids.append(row)
                vecs.append(vec)
                floors.append(floor)
            if size > 100_000:
                yield out()
        close()
        if size:
            yield out()

    return run


def _best(pairs: DataFrame, room: DataFrame) -> DataFrame:
    """The list of each node: its best distinct neighbours, as many as it has room for."""
    distinct = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.col("sim").desc(), "b"))
    ranked = distinct.withColumn("_rank", rank)
    return ranked.join(room, ranked["a"] == room["_row"]).filter(F.col("_rank") <= F.col("room")).select("a", "b", "sim")


def _planes(nodes: DataFrame, count: int, seed: int) -> dict[int, list[tuple[np.ndarray, float]]]:
    """Planes midway between two sampled vectors, by vector length; at most 2 * count
    vectors of a length come to the driver, for at most 16 lengths."""
    size = F.octet_length("vec")
    rank = F.row_number().over(Window.partitionBy(size).orderBy(F.xxhash64(F.lit(seed), "_row")))
    few = nodes.select(size.alias("n"), "vec", rank.alias("_rank")).filter(F.col("_rank") <= 2 * count)
    by: dict[int, list[np.ndarray]] = {}
    for r in few.orderBy("n", "_rank").limit(32 * count).collect():
        by.setdefault(r["n"] // 8, []).append(np.frombuffer(bytes(r["vec"]), np.float64))
    out = {}
    for d, v in by.items():
        planes = []
        for i in range(count):
            a, b = v[2 * i % len(v)], v[(2 * i + 1) % len(v)]
            planes.append((a - b, float((a - b) @ (a + b) / 2)))
        out[d] = planes
    return out


def _leaves(nodes: DataFrame, settings: Settings, largest: int, seed: int) -> DataFrame:
    """Each node in one leaf of each tree, with a place in it: `leaf`, `place`, `_row`, `vec`."""
    depth = depth_of(largest, settings.leaf)
    trees = trees_of(settings, depth)
    planes = nodes.sparkSession.sparkContext.broadcast(_planes(nodes, trees * (depth + 1), seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(v) // 8 for v in batch.column("vec").to_pylist()])
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                x = _matrix(part.column("vec"))
                labels = part.column("label").to_pylist()
                for t in range(trees):
                    own = planes.value.get(int(d), [])[t * (depth + 1):(t + 1) * (depth + 1)]
                    if own:
                        side = np.stack([x @ n - c for n, c in own], axis=1)
                    else:
                        side = np.zeros((len(x), depth + 1))
                    bits = (side[:, :depth] > 0) @ (1 << np.arange(depth)) if depth else np.zeros(len(x), int)
                    leaf = [f"{label}/{t}/{b}" for label, b in zip(labels, bits)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leaf), pa.array(side[:, depth]), part.column("_row"), part.column("vec")], ["leaf", "place", "_row", "vec"])

    return nodes.mapInArrow(run, "leaf string, place double, _row long, vec binary")


def descend(nodes: DataFrame, settings: Settings, seed: int = 1, known: DataFrame | None = None) -> DataFrame:
    """Neighbour lists (`a`, `b`, `sim`) of the nodes, and `room`, the list's size. `known`:
    lists of an earlier descent, whose entries are kept and whose room does not shrink."""
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    placed = _leaves(nodes, settings, largest, seed)
    first = placed.withColumn("floor", F.lit(-1.0)).select("leaf", "_row", "vec", "floor", "place")
    pairs = (
        first.repartition("leaf").sortWithinPartitions("leaf", "place", "_row")
        .mapInArrow(_offers(1), "a long, b long, sim double")
    )
    room = nodes.select("_row", F.lit(settings.neighbours).alias("room"))
    if known is not None:
        pairs = pairs.unionByName(known.select("a", "b", "sim"))
        had = known.groupBy("a").agg(F.max("room").alias("had"))
        room = stored(nodes.join(had, nodes["_row"] == had["a"], "left").select(
            "_row", F.greatest(F.lit(settings.neighbours), "had").alias("room")), "room")
    most = settings.neighbours << settings.growths
    few = settings.changed * nodes.count()
    lists = stored(_best(pairs, room), "lists")
    for step in range(settings.rounds):
        state = lists.groupBy("a").agg(F.count("*").alias("n"), F.min("sim").alias("least"))
        held = nodes.join(room, "_row").join(state, nodes["_row"] == state["a"], "left").select(nodes["_row"], "vec", "room", "n", "least")
        full = F.coalesce(F.col("n") >= F.col("room"), F.lit(False))
        grown = full & (F.col("least") >= settings.threshold)
        floors = held.select(
            "_row", "vec", F.when(grown, settings.threshold - 1e-12).when(full, F.col("least")).otherwise(-1.0).alias("floor"))
        more = F.greatest("room", F.least(F.col("room") * 2, F.lit(most)))
        room = stored(held.select(
            "_row", F.when(grown, more).otherwise(F.col("room")).alias("room"), (grown & (F.col("room") >= most)).alias("done")), "room")
        both = lists.select(F.col("a").alias("hub"), F.col("b").alias("_row")).unionByName(
            lists.select(F.col("b").alias("hub"), F.col("a").alias("_row"))).distinct()
        joined = both.join(floors, "_row").select("hub", "_row", "vec", "floor", F.xxhash64(F.lit(step), "hub", "_row").alias("place"))
        offers = joined.repartition("hub").sortWithinPartitions("hub", "place").mapInArrow(_offers(1), "a long, b long, sim double")
        before, lists = lists, stored(_best(lists.unionByName(offers), room), "lists")
        # A list that is at its largest and saturated belongs to a set that is counted.
        new = lists.join(before, ["a", "b"], "left_anti").join(room.filter("not done"), F.col("a") == F.col("_row"), "left_semi")
        if new.select("a").distinct().count() <= few:
            break
    else:
        raise RuntimeError(f"the neighbour lists still changed after {settings.rounds} rounds")
    return lists.join(room, lists["a"] == room["_row"]).select("a", "b", "sim", "room")


def _counted(members: DataFrame, threshold: float) -> DataFrame:
    """Links of each member of large sets (`set`, `_row`, `vec`, `copies`, `n`), by comparing
    blocks with blocks: `_row`, `links` to other nodes, counted in vectors."""
    blocks = F.ceil(F.col("n") / 256).cast("int")
    own = F.pmod(F.xxhash64("_row"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    met = members.withColumn("own", own).withColumn("other", other).select(
        F.concat_ws("/", "set", F.least("own", "other"), F.greatest("own", "other")).alias("pair"),
        (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right"), "_row", "vec", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts(rows: list) -> pa.RecordBatch:
            left, right = [r for r in rows if r[1]], [r for r in rows if r[2]]
            same = rows[0][1] and rows[0][2]
            ids, n = [], []
            if left and right:
                near = _matrix([r[4] for r in left]) @ _matrix([r[4] for r in right]).T >= threshold
                near &= np.array([r[3] for r in left])[:, None] != np.array([r[3] for r in right])[None, :]
                ids, n = [r[3] for r in left], (near @ np.array([r[5] for r in right])).tolist()
                if not same:
                    ids, n = ids + [r[3] for r in right], n + (np.array([r[5] for r in left]) @ near).tolist()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], ["_row", "links"])

        held: list = []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if held and r[0] != held[0][0]:
                    yield counts(held)
                    held = []
                held.append(r)
        if held:
            yield counts(held)

    each = met.repartition("pair").sortWithinPartitions("pair").mapInArrow(run, "_row long, links long")
    return each.groupBy("_row").agg(F.sum("links").alias("links"))


def audit(nodes: DataFrame, found: DataFrame, settings: Settings) -> float:
    """The lower of two recalls, each the mean over a bounded sample of nodes with a true
    link against all nodes: of large sets, and of all others. `found`: `_row`, `links`
    (vectors linked with the node, its own copies aside) and `large`."""
    of = found.filter("large").select("_row")
    few = [r for how in ("left_semi", "left_anti")
           for r in few_by_hash(nodes.join(of, "_row", how), settings.audited, "_row").collect()]
    if not few:
        return 1.0
    by: dict[str, tuple[list[int], list[bytes]]] = {}
    for r in few:
        ids, vecs = by.setdefault(r["label"], ([], []))
        ids.append(r["_row"])
        vecs.append(bytes(r["vec"]))
    shared = nodes.sparkSession.sparkContext.broadcast(by)  # 2 * `audited` vectors
    threshold = settings.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {k: (np.array(i), _matrix(v)) for k, (i, v) in shared.value.items()}
        total: dict[int, int] = {}
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), dtype=object)
            rows, copies = np.asarray(batch.column("_row")), np.asarray(batch.column("copies"))
            for label in set(labels.tolist()) & asked.keys():
                at = np.flatnonzero(labels == label)
                ids, q = asked[label]
                near = q @ _matrix([batch.column("vec")[int(i)].as_py() for i in at]).T >= threshold
                near &= ids[:, None] != rows[at][None, :]
                for i, n in zip(ids.tolist(), (near @ copies[at]).tolist()):
                    total[i] = total.get(i, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["_row", "truth"])

    truth = nodes.mapInArrow(run, "_row long, truth long").groupBy("_row").agg(F.sum("truth").alias("truth"))
    share = F.least(F.lit(1.0), F.coalesce("links", F.lit(0)) / F.col("truth"))
    each = truth.filter("truth > 0").join(found, "_row", "left").groupBy("large").agg(F.avg(share).alias("recall")).collect()
    return min([r["recall"] for r in each], default=1.0)


def near_duplicates(
    table: DataFrame, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, float]:
    """`table` with `n_links`, `component_id` and `kept`, and the recall that was measured."""
    keyed = with_row(table.drop("n_links", "component_id", "kept"))
    valid = keyed.select("_row", F.col(label).cast("string").alias("label"), F.col(vector)).mapInArrow(_valid, _NODE)
    member = stored(valid.withColumn("_name", F.md5("vec")), "vectors")
    same = member.groupBy("label", "_name").agg(F.min("_row").alias("node"), F.count("*").alias("copies"))
    of = stored(member.select("_row", "label", "_name").join(same, ["label", "_name"]).select("_row", "node", "copies"), "nodes")
    nodes = stored(member.join(of.filter("_row = node").select("_row", "copies"), "_row").select("_row", "label", "vec", "copies"), "node-vectors")
    lists = None
    for attempt in range(settings.tries):
        more = replace(settings, neighbours=settings.neighbours << attempt, trees=settings.trees << attempt)
        lists = stored(descend(nodes.select("_row", "label", "vec"), more, attempt + 1, lists), "graph")
        close = lists.filter(F.col("sim") >= settings.threshold)
        pairs = close.select("a", "b").unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        sets = stored(components(pairs), "sets")
        root = nodes.select("_row", "copies", "vec").join(sets, nodes["_row"] == sets["node"], "left").select(
            "_row", "copies", "vec", F.coalesce("root", "_row").alias("set"))
        saturated = close.groupBy("a").count().filter(F.col("count") >= more.neighbours).select(F.col("a").alias("_row"))
        crowded = root.join(saturated, "_row", "left_semi").select("set").distinct()
        sizes = root.groupBy("set").agg(F.count("*").alias("n"))
        large = root.join(crowded, "set", "left_semi").join(sizes, "set")
        plain = pairs.join(nodes.select(F.col("_row").alias("b"), "copies"), "b").groupBy(F.col("a").alias("_row")).agg(F.sum("copies").alias("links"))
        exact = _counted(large, settings.threshold).withColumnRenamed("links", "exact")
        found = stored(
            root.select("_row", "set").join(plain, "_row", "left").join(exact, "_row", "left")
            .select("_row", "set", F.coalesce("exact", "links", F.lit(0)).alias("links"), F.col("exact").isNotNull().alias("large")), "links")
        recall = audit(nodes, found, settings)
        if recall >= settings.wanted:
            break
    else:
        raise RuntimeError(f"recall {recall:.3f} after {settings.tries} descents, {settings.wanted} wanted")
    ids = of.join(found.select(F.col("_row").alias("node"), "set", "links"), "node").join(
        keyed.select("_row", F.col(key).alias("_id")), "_row")
    least = ids.groupBy("set").agg(F.min("_id").alias("component_id"))
    each = ids.join(least, "set").select("_row", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    result = (
        keyed.join(each, "_row", "left").drop("_row")
        .withColumns({"n_links": F.coalesce("n_links", F.lit(0)), "component_id": F.coalesce("component_id", key)})
        .withColumn("kept", F.col("component_id").eqNullSafe(F.col(key)))
    )
    return result, recall

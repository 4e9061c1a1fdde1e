"""NN-descent against all pairs."""

import random

import cases
import numpy as np
import pytest

from shelfwise.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    """Links and components by all pairs; unusable vectors link with nothing."""
    n = len(rows)
    ok = [r[2] is not None and r[1] is not None and None not in r[1] and len(r[1]) > 0 and np.isfinite(r[1]).all() and any(r[1]) for r in rows]
    unit = [np.array(r[1], np.float32).astype(float) / np.linalg.norm(np.array(r[1], np.float32).astype(float)) if o else None for r, o in zip(rows, ok)]
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least: dict = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return [(r[0], links[i], least.get(find(i))) for i, r in enumerate(rows)]


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    centre = rng.normal(size=16)
    for i in range(n):
        kind = rng.random()
        if kind < 0.25:
            v = centre + rng.normal(size=16) * 0.08  # a crowded set
        elif kind < 0.5 and rows:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=16) * 0.05 * (rng.random() < 0.7)
        else:
            v = rng.normal(size=16)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    return rows


def test_against_all_pairs(spark):
    rows = vectors(1, 500)
    bad = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0] * 8]
    rows += [(1000 + i, v, 0) for i, v in enumerate(bad)] + [(1100, rows[0][1], None), (1101, rows[0][1], None)]
    rows += [(None, rows[3][1], rows[3][2]), (4, rows[4][1], rows[4][2])]
    table = cases.with_clashes(spark.createDataFrame(rows, SCHEMA), "n_links", "node")
    found, recall = neighbours.near_duplicates(table, neighbours.Settings(threshold=0.93, audited=100))
    got = found.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(brute(rows, 0.93), key=key)
    have = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=key)
    assert len(have) == len(want) and recall >= 0.95
    assert sum(h[1] for h in have) >= 0.98 * sum(w[1] for w in want)
    assert all(h[0] == w[0] and h[1] <= w[1] for h, w in zip(have, want))
    # An unusable vector without an id has no component.
    assert sum(h[2] == w[2] for h, w in zip(have, want)) >= 0.98 * len(want)
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in got if r["vec_id"] is not None)


@pytest.mark.parametrize("copies", [1, 30])
def test_equal_vectors(spark, copies):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(copies)] + [(99, [3.0, -2.0, 1.0], 1)]
    random.Random(1).shuffle(rows)
    found, _ = neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
    assert got == {i: (copies - 1, 0, i == 0) for i in range(copies)} | {99: (0, 99, True)}


def test_empty(spark):
    found, recall = neighbours.near_duplicates(cases.empty(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)))
    assert found.count() == 0 and recall == 1.0


def nodes_of(spark, rows):
    return spark.createDataFrame([(i, "1", np.array(v, float).tobytes(), 1) for i, v in rows], "_row long, label string, vec binary, copies long")


def test_recall_of_small_groups_is_not_hidden_by_a_large_set(spark):
    rng = np.random.default_rng(3)
    unit = lambda v: v / np.linalg.norm(v)
    hot = [unit(np.eye(16)[0] + rng.normal(size=16) * 0.01) for _ in range(60)]
    small = [unit(c + rng.normal(size=16) * 0.01) for c in rng.normal(size=(10, 16)) * 4 for _ in range(2)]
    nodes = nodes_of(spark, enumerate(hot + small))
    # Everything of the large set was found, nothing of the pairs.
    found = spark.createDataFrame([(i, 59 if i < 60 else 0, i < 60) for i in range(80)], "_row long, links long, large boolean")
    assert neighbours.audit(nodes, found, neighbours.Settings()) == 0.0


def test_low_recall_is_an_error(spark, monkeypatch):
    table = spark.createDataFrame(vectors(2, 60), SCHEMA)
    monkeypatch.setattr(neighbours, "audit", lambda *a: 0.5)
    with pytest.raises(RuntimeError, match="recall 0.500"):
        neighbours.near_duplicates(table, neighbours.Settings(tries=2))


def test_trees_follow_the_depth():
    settings = neighbours.Settings()
    for n in (10**3, 10**6, 10**9):
        depth = neighbours.depth_of(n, settings.leaf)
        assert (1 - 0.88**depth) ** neighbours.trees_of(settings, depth) <= 0.05

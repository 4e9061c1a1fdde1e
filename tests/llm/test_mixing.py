"""Targets against the resharing loop; word and document totals near them."""

import random
import re

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mixing


def reshared(sizes, weights, total, most):
    """Share by weight, cap, share the excess again until nothing is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped: dict = {}
    while True:
        rest = total * sum(sizes.values()) - sum(capped.values())
        free = [s for s in names if s not in capped]
        target = {s: rest * w[s] / sum(w[f] for f in free) for s in free}
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 10, 100, 5000]) for s in ["b", "a", "Z", "é", "z", "aa", None][: 4 + seed]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, (3, 1, 2), 1.5, 2.0).collect()}
    want = reshared(sizes, (3, 1, 2), 1.5, 2.0)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s]), s


def test_flight_keeps_totals():
    rng = np.random.default_rng(3)
    p, size, draw = rng.random(400), rng.integers(1, 5000, 400), rng.random(400)
    out = mixing.fly(p, size, draw)
    assert ((out > mixing.EPS) & (out < 1 - mixing.EPS)).sum() <= mixing.LANDING + 2
    assert out.sum() == pytest.approx(p.sum()) and (out * size).sum() == pytest.approx((p * size).sum())


def test_flight_keeps_expectations():
    rng = np.random.default_rng(4)
    p, size = rng.random(40), rng.integers(1, 50, 40)
    mean = np.mean([mixing.fly(p, size, rng.random(40)) for _ in range(600)], axis=0)
    assert np.abs(mean - p).max() < 0.12


def test_mix_is_near_its_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.choice([3, 40, 400])), "en", "s0" if rng.random() < 0.4 else f"s{rng.randint(1, 5)}", 1) for i in range(900)]
    docs = cases.with_clashes(spark.createDataFrame(rows, cases.DOCS).repartition(5, "doc_id"), "size", "taken")
    mixed = mixing.mix(docs).toPandas()
    assert len(mixed) == 900 and (mixed["taken"] <= 2 * mixed["size"]).all()
    for _, g in mixed.groupby("source"):
        assert g["size"].sum() == g["source_size"].iloc[0]
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 0.01 * g["target"].iloc[0]
        share = g["target"].iloc[0] / g["source_size"].iloc[0]
        assert abs(g["copies"].sum() - share * len(g)) <= 4
    assert mixed["target"].groupby(mixed["source"]).first().sum() == pytest.approx(1.5 * mixed["size"].sum())


def test_cases(spark):
    docs = cases.documents(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == 9
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
    again = mixing.mix(docs)
    key = lambda r: (r["doc_id"] or 0, r["size"], r["copies"])
    assert sorted(map(key, again.collect())) == sorted(map(key, rows))
    repeated = mixing.repeat_rows(again)
    assert repeated.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(cases.empty(docs)).count() == 0
    nothing = docs.withColumn("text", F.lit(None).cast("string"))
    assert {r["taken"] for r in mixing.mix(nothing).collect()} == {0}


@pytest.mark.parametrize("group", [mixing.GROUP, 40])
def test_mix_depends_on_the_rows_alone(spark, tmp_path, monkeypatch, group):
    """The same copies from three layouts of files and from a rerun, with one flight and with several."""
    monkeypatch.setattr(mixing, "GROUP", group)
    monkeypatch.setattr(mixing, "TOGETHER", 3)
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.choice([0, 3, 40, 400])), "en", "s0" if rng.random() < 0.5 else rng.choice(["s1", "s2", None]), 1)
            for i in range(600)]
    rows += rows[:50] + [(None, None, None, None, None)] * 3
    found = []
    for i, n in enumerate((1, 7, 3)):
        path = str(tmp_path / str(i))
        rng.shuffle(rows)
        spark.createDataFrame(rows, cases.DOCS).repartition(n).write.parquet(path)
        mixed = mixing.mix(spark.read.parquet(path))
        for _ in range(2 if i == 0 else 1):
            found.append(sorted((str(r["doc_id"]), r["source"] or "", r["size"], r["copies"]) for r in mixed.collect()))
    assert all(f == found[0] for f in found)
    for source in {r[3] for r in rows}:
        mine = mixed.filter(F.col("source").eqNullSafe(F.lit(source))).toPandas()
        if mine["target"].iloc[0]:
            assert abs(mine["taken"].sum() - mine["target"].iloc[0]) <= 0.02 * mine["target"].iloc[0]

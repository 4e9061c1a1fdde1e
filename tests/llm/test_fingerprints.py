"""Both SimHash operators against brute force."""

import hashlib
import random
import re

import cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfwise.llm import neardup, simhash
from shelfwise.llm.components import components


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, radius=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups: dict = {}
    for i in range(len(prints)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [least[find(i)] for i in range(len(prints))]


def flipped(rng, x, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        x ^= 1 << b
    return x


def clustered(seed, n):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(max(2, n // 12))]
    return [flipped(rng, rng.choice(centres), 7) for _ in range(n)]


@pytest.mark.parametrize("text", ["", None, "  \t", "one", "A b C", "Ä ä É", "a b c d", "The cat sat on the mat again and again " * 9, "x\x1cy z\xa0w"])
def test_fingerprint(text):
    assert neardup.fingerprint_of(text or "") & (1 << 64) - 1 == brute_fingerprint(text)


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, 5000, dtype=np.uint64), rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    b[:2000] = a[:2000] ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    m = neardup._manhattan(neardup._popcounts(a), neardup._popcounts(b))
    seg = lambda x: np.stack([np.bitwise_count(x >> np.uint64(2 * i) & np.uint64(3)).astype(int) for i in range(32)])
    assert (m == np.abs(seg(a) - seg(b)).sum(axis=0)).all() and (m <= np.bitwise_count(a ^ b)).all()


def signed(x):
    return x - ((x >> 63) << 64)


@pytest.mark.parametrize("small,crowded", [(16, 50_000), (2, 50_000), (2, 3)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, small, crowded):
    prints = [*set(clustered(7, 500)), 0]
    ids = list(range(len(prints)))
    want = brute_components(ids, prints)
    columns = simple_search(prints, small, crowded, monkeypatch)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in columns:
        assert (a ^ b).bit_count() <= 64
        root[max(find(a), find(b))] = min(find(a), find(b))
    groups: dict = {}
    for i, p in enumerate(prints):
        groups.setdefault(find(p), []).append(i)
    assert sorted(map(tuple, groups.values())) == sorted(
        tuple(i for i in ids if want[i] == w) for w in set(want))


def simple_search(prints, small, crowded, monkeypatch):
    """The task's search run in this process over all grid tables."""
    import pyarrow as pa

    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "CROWDED", crowded)
    x = np.array(prints, dtype=np.uint64)
    p = neardup._popcounts(x).view(np.int64)
    rows = sorted((t, int(c), int(f)) for t, m in enumerate(neardup.cells()) for c, f in zip(p & np.int64(m), x.view(np.int64)))
    table, cell, fp = map(np.array, zip(*rows))
    cuts = [0, 5, 700, len(rows) // 2, len(rows)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[a:b]) for c in (table.astype(np.int32), cell, fp)], ["table", "cell", "fingerprint"])
               for a, b in zip(cuts, cuts[1:])]
    return [(int(a), int(b)) for out in neardup._links(iter(batches))
            for a, b in zip(np.asarray(out.column(0)).view(np.uint64), np.asarray(out.column(1)).view(np.uint64))]


def test_embedding_in_spark_equals_numpy(spark):
    values = [signed(x) for x in clustered(3, 40)]
    rows = spark.createDataFrame([(v,) for v in values], "fp long").select("fp", neardup.embedding(F.col("fp")).alias("p")).collect()
    for r in rows:
        assert int(neardup._popcounts(np.array([r["fp"]]).view(np.uint64)).view(np.int64)[0]) == r["p"]


def test_near_duplicates_of_texts(spark):
    rng = random.Random(11)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randint(0, 99)) for _ in range(400)) for _ in range(5)]
    extra = []
    for i in range(60):
        w = rng.choice(base).split()
        if rng.random() < 0.7:
            w[rng.randrange(400)] = "changed"
        extra.append((100 + i, " ".join(w), "en", "s", 1))
    docs = cases.with_clashes(cases.documents(spark, extra), "fingerprint", "component_id")
    rows = neardup.near_duplicates(docs).collect()
    prints = [brute_fingerprint(r["text"]) for r in rows]
    assert [r["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in rows] == brute_components([r["doc_id"] for r in rows], prints)
    kept = neardup.keep_one(docs).collect()
    assert len(kept) == len({(r["component_id"], None if r["component_id"] else r["fingerprint"]) for r in rows})
    assert neardup.near_duplicates(cases.empty(docs)).count() == 0 == neardup.keep_one(cases.empty(docs)).count()


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)}


def native_fingerprint(text):
    """The vote of operator 4, term by term; XXH64 of a pair chains the seed."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    votes, total = [0] * 64, 0
    for a, b in zip(words, [*words[1:], None]):
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        if b is not None:
            h = xxhash.xxh64_intdigest(b.encode(), h)
        w = min(len(a) + len(b or ""), simhash.HEAVIEST)
        total += w
        for k in range(64):
            votes[k] += w * (h >> k & 1)
    return sum(1 << k for k in range(64) if 2 * votes[k] > total)


def test_native_fingerprints_and_edits(spark, tmp_path):
    docs = cases.documents(spark, [(50 + i, f"text {i} " * (i % 7) + "é🙂" * i, None, None, 0) for i in range(30)])
    docs = cases.with_clashes(docs.filter("doc_id IS NULL OR doc_id != 4"), "fingerprint", "_at")
    docs.write.parquet(str(tmp_path / "d"))
    rows = simhash.digest(simhash.edited_fingerprints(spark.read.parquet(str(tmp_path / "d")))).collect()
    order = sorted(docs.collect(), key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0)))
    texts = [r["text"] or "" for r in order]
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(order)
    for r, text, after in zip(order, texts, [*texts[1:], texts[0]]):
        n = len(text) // 3
        edited = text[:len(text) - n] + after[:n]
        g = got[r["doc_id"]]
        f, e, x = map(native_fingerprint, (text, edited, after))
        assert g["n_chars"] == len(text) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (g["fingerprint"], g["edited_fingerprint"]) == (f"{f:016x}", f"{e:016x}")
        assert g["near_edited"] == 1 - (f ^ e).bit_count() / 64 and g["near_next"] == 1 - (f ^ x).bit_count() / 64
    assert simhash.edited_fingerprints(cases.empty(docs)).count() == 0


def test_long_texts_do_not_overflow_the_lanes(spark):
    text = " ".join(f"averylongword{i % 50}" for i in range(3 * simhash.RUN + 5))
    got = simhash.fingerprints(spark.createDataFrame([(1, text)], "k long, text string"), ["k"]).first()["fingerprint"]
    assert got & (1 << 64) - 1 == native_fingerprint(text)


def test_block_tables_find_all(spark):
    prints = [*set(map(signed, clustered(5, 300)))]
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    pairs = simhash.near(df.limit(60), df, radius=3, blocks=5).collect()
    asked = {r["fingerprint"] for r in df.limit(60).collect()}
    want = {(a, b) for a in asked for b in prints if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert len(pairs) == len(want) and {(r["query"], r["fingerprint"]) for r in pairs} == want


def test_native_plan_has_no_python(spark):
    plan = simhash.edited_fingerprints(cases.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

"""Token counts and packing against the tokenizers library."""

import random

import cases
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(1)
    made = ["".join(rng.choice("ab 'stre\n\t1é一½!ll \x1c🙂Ⅷ١\x85　") for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    return ["", "a" * 5000, "ab " * 300, "don't 'sx ''s", "<|endoftext|>hi<|endoftext|>", " ", "\n\n x", *made]


def test_counts_and_ids_equal_the_library(library):
    count, encode = bpe.counts_of(PATH).count, packing.encoder(PATH).encode
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert count(text) == len(ids), text
        assert np.frombuffer(encode(text), "<u4").tolist() == ids, text


def test_caches_are_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED", 5)
    counts = bpe.PieceCounts(PATH)
    text = " ".join(f"piece{i}" for i in range(50))
    assert counts.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(counts) <= 5


def test_counted_table(spark, library):
    docs = cases.with_clashes(cases.documents(spark), "n_tokens", "_row")
    rows = bpe.count_tokens(docs, PATH, limit=5).collect()
    assert len(rows) == 9
    for r in rows:
        text = r["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 5)
    assert bpe.count_tokens(cases.empty(docs), PATH, 5).count() == 0


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(16, 3, 16), packing.Limits(32, 4, 10)])
def test_pieces_respect_all_limits(limits):
    rng = random.Random(2)
    tokens = [rng.choice([1, 2, 5, 9, 31, 32, 33, 100]) for _ in range(300)]
    loss = [rng.randint(0, n) for n in tokens]
    taken = {i: 0 for i in range(300)}
    sequences: dict[int, list] = {}
    for i, start, n, q, offset in packing.pack(tokens, loss, limits):
        assert start == taken[i] and n > 0
        taken[i] += n
        bearing = max(0, start + n - max(start, tokens[i] - loss[i]))
        sequences.setdefault(q, []).append((offset, n, bearing))
    assert taken == dict(enumerate(tokens))
    for parts in sequences.values():
        assert sum(p[1] for p in parts) <= limits.tokens
        assert sum(p[2] for p in parts) <= limits.loss and len(parts) <= limits.segments
        assert [p[0] for p in parts] == list(np.cumsum([0, *[p[1] for p in parts]])[:-1])


def test_sequences_are_full_but_the_last():
    sizes = [37] * 500
    total: dict[int, int] = {}
    for _, _, n, q, _ in packing.pack(sizes, sizes, packing.Limits(256, 64, 256)):
        total[q] = total.get(q, 0) + n
    assert sorted(total.values())[1:] == [256] * (len(total) - 1)


@pytest.mark.parametrize("size", [1, 2, 4, 9])
def test_short_documents_fill_their_sequences(size):
    """With as many segments as tokens; with fewer, that limit binds and nothing else is lost."""
    def fill(limits):
        used: dict[int, int] = {}
        for _, _, n, q, _ in packing.pack([size] * 3000, [size] * 3000, limits):
            used[q] = used.get(q, 0) + n
        return sorted(used.values())[1:]

    assert set(fill(packing.Limits(segments=1024))) == {1024}
    assert set(fill(packing.Limits(segments=100))) == {min(1024, 100 * size)}


def test_packed_table_round_trip(spark, library):
    docs = cases.with_clashes(cases.documents(spark), "ids", "start")
    pieces = packing.pack_documents(docs, PATH, packing.Limits(64, 64, 64)).collect()
    by_sequence: dict[int, list] = {}
    by_doc: dict = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["ids"], p["doc_tokens"]))
    for parts in by_sequence.values():
        parts.sort()
        assert sum(n for _, n in parts) <= 64 and [o for o, _ in parts] == list(np.cumsum([0, *[n for _, n in parts]])[:-1])
    for r in docs.filter("doc_id != 4").collect():
        ids = b"".join(x for _, x, _ in sorted(by_doc[r["doc_id"]]))
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
    assert packing.pack_documents(cases.empty(docs), PATH).count() == 0
    again = packing.pack_documents(docs, PATH, packing.Limits(64, 64, 64))
    assert again.select(F.sum(F.crc32("ids"))).first() == packing.pack_documents(docs, PATH, packing.Limits(64, 64, 64)).select(F.sum(F.crc32("ids"))).first()

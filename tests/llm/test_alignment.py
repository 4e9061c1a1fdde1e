"""Alignment of two tokenizers against a plain version on whole texts with the two libraries."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import cases
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfwise.llm import alignment
from shelfwise.llm.bpe import byte_symbols

FIRST, SECOND = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def plain():
    """(n_a, n_b, groups, links) of a text, read from the contract."""
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    as_byte = {s: b for b, s in enumerate(byte_symbols())}

    def second_bytes(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def run(text):
        if not text:
            return 0, 0, "", []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        parts = [bytes(as_byte[c] for c in first.id_to_token(i)) for i in a], [second_bytes(i) for i in b]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return 0, 0, "", []
        ends = [list(accumulate(map(len, p))) for p in parts]
        groups, links, before = [], [], 0
        for end in ends[0]:
            if end in ends[1]:
                of = [[i for i, e in zip(ids, es) if before < e <= end] for ids, es in zip((a, b), ends)]
                groups.append("|".join(",".join(map(str, ids)) for ids in of))
                links.append((of[0][-1], of[1][-1]))
                before = end
        return len(a), len(b), ";".join(groups), links

    return run


@pytest.fixture(scope="module")
def worker():
    return alignment.Aligner(FIRST, SECOND)


def odd_texts():
    rng = random.Random(3)
    made = ["".join(rng.choice("ab 'stre\n\t1é一½!ll \x1c🙂Ⅷ١\x85　▁​\xa0") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    return ["", " ", "  ", " \n ", "a" * 1500, "ab " * 200, "x  y ", "<|endoftext|>hi<s> </s><0x41> <unk>", "x▁y", "\x00a b", *made]


def same(got, want):
    n_a, n_b, groups, links = want
    *plain, distinct, numbers = got
    counts = Counter(a << 32 | b for a, b in links)
    assert dict(zip(map(int, distinct), map(int, numbers))) == counts
    return plain == [n_a, n_b, len(links), hashlib.sha256(groups.encode()).hexdigest() if groups else ""]


def test_texts_equal_the_plain_version(plain, worker):
    for text in odd_texts():
        assert same(worker.text(text), plain(text)), text


def test_models_that_normalize_are_checked_byte_for_byte(plain):
    careful = alignment.Aligner(FIRST, SECOND)
    careful.plain = False
    for text in odd_texts()[:300]:
        assert same(careful.text(text), plain(text)), text


def test_long_white_space(worker):
    n_a, n_b, n, *_ = worker.text(" " * 200_000 + "x y")
    assert n_a == 200_002 and 0 < n <= min(n_a, n_b)


def test_other_encoder_gives_the_same_ids():
    quick, table = alignment._byte_level(FIRST)
    filed = alignment._filed(FIRST)
    for text in odd_texts():
        assert list(quick(text)) == filed(text) and b"".join(table[i] for i in quick(text)) == text.encode()


@pytest.mark.parametrize("few", [alignment.FEW, 10])
def test_counts_over_the_table(spark, plain, monkeypatch, few):
    """With the sums broadcast, and with links split and joined by a shuffle."""
    monkeypatch.setattr(alignment, "FEW", few)
    extra = [(20 + i, "the cat and the dog the end " * (i % 3 + 1), "en", "c", 1) for i in range(12)] + [(50, "x▁y", "en", "c", 3)]
    docs = cases.with_clashes(cases.documents(spark, extra), "links", "n_a", "_row", "count")
    got = sorted(map(tuple, alignment.align(docs, FIRST, SECOND).collect()), key=str)
    rows = [(r["doc_id"], plain(r["text"])) for r in docs.collect()]
    counts = Counter(link for _, (*_, links) in rows for link in links)
    most: dict = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    want = [
        (d, n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for d, (n_a, n_b, groups, links) in rows]
    assert got == sorted(want, key=str)
    assert alignment.align(cases.empty(docs), FIRST, SECOND).count() == 0

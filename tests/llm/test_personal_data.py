"""Personal data against plain regular expressions, checksums, scores, odd rows."""

import hashlib
import random
import re
import time

import cases
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(twice)) % 10 == 0


def plain(text):
    """The base spans as the contract says them."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def base(text):
    return [(s.kind, s.start, s.end) for s in pii.find(text) if s.base]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@-+0127 9()%é\n", max_size=60))
def test_base_equals_the_plain_patterns(text):
    assert base(text) == plain(text)


def test_base_on_longer_mixtures():
    rng = random.Random(9)
    parts = ["a@b.c", "x.y+z@mail.example.org", "10.0.0.255", "1.2.3.256", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (415) 555-0100",
             "+49 30", " ", ", ", ".", "@", "7", "1.2.3.4.5", "a@b@c.de", "🙂", "é", "-", "+", "000000255.1.1.1", "30569309025904", "word"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert base(text) == plain(text), text


def test_very_long_runs_are_linear():
    start = time.time()
    for unit in ("a", "1", "1.", "a@", "a.b@", "+1", "1 ", "1-", " ", "+1(", "A1", "AB12 "):
        pii.find(unit * 200_000)
    assert time.time() - start < 60


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")


def kinds(text):
    return [(s.kind, s.text, s.base) for s in pii.find(text)]


def test_spans_added_by_checksum_and_context():
    iban = "DE89 3704 0044 0532 0130 00"
    assert kinds(f"Pay to {iban} NOW please") == [("iban", iban, False)]
    assert kinds("Pay to DE89 3704 0044 0532 0130 01 now") == []
    assert kinds("My SSN is 536-90-4399.") == [("ssn", "536-90-4399", False)]
    assert kinds("Part 536-90-4399.") == [] and kinds("SSN 000-90-4399") == []
    assert kinds("call me at 415-555-0100 today") == [("phone", "415-555-0100", False)]
    assert kinds("see pages 415-555-0100 today") == [] and kinds("phone order 415-555-0100") == []
    assert kinds("credit card 4222222222222") == [("card", "4222222222222", False)] and kinds("4222222222222") == []


def test_context_moves_the_score_of_base_spans_which_stay():
    score = lambda t: pii.find(t)[0].score
    assert score("credit card 4111111111111111") > score("4111111111111111") > score("invoice 4111111111111111")
    assert all(s.base for s in pii.find("invoice 4111111111111111"))


def test_added_spans_do_not_overlap():
    spans = pii.find("phone +1 415-555-0100 or tel 4222222222222 card 4222222222222 tel 415-555-0100")
    assert all(a.end <= b.start for a, b in zip(spans, spans[1:]))
    assert [s.kind for s in pii.find("Phone: " + "415-555-0100, " * 40)].count("phone") == 3


def test_table(spark):
    extra = [(20, "Écrire à x@y.fr, +33 1 23 45 67 89", "fr", "a", 1), (21, "ip 10.0.0.1 and 10.0.0.1", "en", "a", 1)]
    docs = cases.with_clashes(cases.documents(spark, extra), "personal", "spans", "n_ip")
    rows = pii.find_personal_data(docs)
    got = rows.select("doc_id", "text", *pii.digest(rows)).collect()
    assert len(got) == 11
    for r in got:
        want = plain(r["text"] or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and r["spans"] == listed
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in want) for k in pii.BASE]
    masked = {r[0]: r[1] for r in rows.select("doc_id", pii.redacted(rows["text"], rows["personal"])).collect()}
    assert masked[20] == "Écrire à <email>, <phone>" and masked[2] == ""
    empty = pii.find_personal_data(cases.empty(docs))
    assert empty.select(*pii.digest(empty)).count() == 0


def test_query_equals_the_plain_patterns(spark, data):
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op13_personal_data(spark, data).collect()
    assert len(got) == len(texts)
    for r in got:
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))

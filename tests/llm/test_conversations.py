"""Conversation repair against a search over all edits, and the damage against its rule."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import conversations as c

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        kept = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows, most_inserts=3):
    """The cheapest edits of rows (role, text), of equals the least: (cost, letters, repaired)."""
    found = faults(rows)
    best = None
    for inserts in range(most_inserts + 1):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
            slots = []
            for i in range(len(rows) + 1):
                slots += [None] * places.count(i)
                if i < len(rows):
                    slots.append(i)
            choices = [[("I", "user"), ("I", "assistant")] if i is None
                       else [("D", None)] if found[i] in ("blank", "duplicate")
                       else [("D", None), ("K", rows[i][0]), ("R", "user"), ("R", "assistant")] for i in slots]
            for edits in itertools.product(*choices):
                said = [(role, "" if i is None else rows[i][1]) for (_, role), i in zip(edits, slots) if role is not None]
                if not re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in said)):
                    continue
                cost = sum({"K": 0, "R": 1, "D": 2, "I": 5}[e] for e, _ in edits)
                cost += sum(5 for (e, _), i in zip(edits, slots) if i is not None and e != "D" and found[i] == "truncated")
                key = cost, "".join(e for e, _ in edits)
                if best is None or key < best[:2]:
                    best = *key, said
    return best


def repaired(rows):
    out, letters = [], []

    def emit(edit, row, role, text):
        letters.append(edit)
        if role is not None:
            out.append((role, text))

    search = c.Repair(emit)
    for row, fault in zip(rows, faults(rows)):
        search.step(row, fault)
        assert len(search.alive) <= 4
    cost = search.close()
    return cost, "".join(letters), out


TEXTS = ("Yes.", "No", "", "Go!", " ")
ROLES = ("user", "assistant", "system", "tool", "u", " ", "")


def test_search_equals_all_edits():
    rng = random.Random(5)
    for _ in range(250):
        rows = [(rng.choice(ROLES[:3] if rng.random() < 0.7 else ROLES), rng.choice(TEXTS) + rng.choice(["", "", "x."]))
                for _ in range(rng.randint(0, 4))]
        assert repaired(rows) == brute(rows, 2), rows


def test_search_equals_the_plain_table():
    """Longer conversations, against a table of the least (cost, letters) of every state and row."""
    rng = random.Random(6)
    for _ in range(300):
        roles = rng.choice([ROLES[:2], ROLES[:3], ROLES, ("tool",), ("tool", "assistant")])
        rows = [(rng.choice(roles), rng.choice(("Yes.", "No", f"{i}.", f"{i}?", f"{i}", ""))) for i in range(rng.randint(5, 60))]
        table = {0: (0, "")}

        def insert(table):
            for _ in range(3):
                for state, (cost, s) in list(table.items()):
                    to = c._NEXT[state]
                    table[to] = min(table.get(to, (10**9, "")), (cost + 5, s + "I"))

        for (role, _), fault in zip(rows, faults(rows)):
            insert(table)
            new: dict = {}

            def put(state, value):
                new[state] = min(new.get(state, (10**9, "")), value)

            for state, (cost, s) in table.items():
                put(state, (cost + 2, s + "D"))
                if fault not in ("blank", "duplicate"):
                    more = 5 * (fault == "truncated")
                    put(c._NEXT[state], (cost + more + 1, s + "R"))
                    if (state, role[:1]) in c._KEPT:
                        put(c._KEPT[state, role[:1]], (cost + more, s + "K"))
            table = new
        insert(table)
        assert repaired(rows)[:2] == min(table[s] for s in (0, 3) if s in table), rows


def test_memory_of_a_long_conversation_is_bounded():
    """Rows are let go: at most a few are held of 20,000 well-formed and damaged ones."""
    held = 0

    class Row(tuple):
        def __new__(cls, *a):
            nonlocal held
            held += 1
            return super().__new__(cls, *a)

        def __del__(self):
            nonlocal held
            held -= 1

    search, rng, most = c.Repair(lambda *_: None), random.Random(7), 0
    for i in range(20_000):
        fault = rng.choice(["", "", "", "truncated", "blank", "duplicate"])
        search.step(Row((("user", "assistant")[i % 2] if rng.random() < 0.9 else "system", f"{i}.")), fault)
        most = max(most, held)
    search.close()
    assert most < 60


def test_survivors_that_never_meet_are_still_compared():
    """Only re-roled rows: the search cannot decide for long, and is linear all the same."""
    rows = [("tool", f"{i}.") for i in range(3001)]
    cost, letters, _ = repaired(rows)
    assert (cost, letters) == (3002, "D" + "R" * 3000)


def test_damage_follows_the_hash(spark):
    rows = [(i, t, r, "One. Two! Three?") for i in range(60) for t, r in enumerate(("user", "assistant"))]
    rows += [(None, 1, None, None), (7, None, "user", None), (None, None, "assistant", "x.")]
    df = spark.createDataFrame(rows, ROWS)
    got = c.damage(df).collect()
    assert len(got) == len(rows)
    for (conv, turn, role, text), r in zip(rows, got):
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        want = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text), "user" if kind == 4 else role, {0: 0, 3: 2}.get(kind, 1)
        assert (r["text"], r["role"], r["copies"]) == want


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(8)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn - 1]), rng.choice(["user", "assistant", "system", None]),
                         rng.choice(["Yes.", "No", "", None, f"{turn}!"])))
    rows.append((99, 3, "user", "word " * 30_000))
    return spark.createDataFrame(rows, ROWS).withColumn("copies", F.lit("clash")).withColumn("_seen", F.lit("clash"))


@pytest.mark.parametrize("make", [c.damage, c.undamaged])
def test_tables_equal_the_search_of_each_conversation(spark, odd, make):
    rows = make(odd)
    convs: dict = {}
    for r in rows.collect():
        convs.setdefault(r["conv_id"], []).extend([(r["turn"], r["role"], r["text"])] * r["copies"])
    got = {r["conv_id"]: r for r in c.audit(rows).collect()}
    said: dict = {}
    for r in c.repair(rows).collect():
        said.setdefault(r["conv_id"], {})[r["position"]] = (r["role"], r["text"])
    assert set(got) == set(convs)
    for conv, items in convs.items():
        items.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        texts = [(role, text) for _, role, text in items]
        cost, letters, out = repaired(texts)
        turns = {t for t, *_ in items if t is not None}
        initials = [r[:1] for r, _ in texts]
        r = got[conv]
        assert (r["cost"], r["audit"]) == (cost, letters)
        assert r["repaired_sha256"] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
        assert [v for _, v in sorted(said.get(conv, {}).items())] == out
        assert r["gaps"] == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        assert r["illegal"] == sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        assert [r["blank"], r["duplicate"], r["truncated"]] == [faults(texts).count(f) for f in ("blank", "duplicate", "truncated")]


def test_empty_table(spark, odd):
    assert c.audit(c.damage(odd.limit(0))).count() == 0 and c.repair(c.damage(odd.limit(0))).count() == 0


def test_texts_are_shuffled_once(odd):
    plan = c.audit(c.damage(odd))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1

"""Operator 12: repair of conversations by a Viterbi search with coalescing survivors.

A conversation's rows are read in order of their turns. Each may be kept, get another role
or be deleted, and empty turns may be inserted; the cheapest edits are sought after which
the role initials are `(s?(ua)+)?`. The search has four states: nothing yet, after s, after
u, after a. After every row each state keeps one survivor: the cheapest edits that lead to
it, of equals those whose letters come first in ASCII order.

The survivors are leaves of a tree of back pointers with reference counts. A survivor that
another one beats whatever follows is dropped (`BEATS`). A node that loses its last
reference goes, with all above it that it alone had held. Once all survivors descend from
one child of the root, its edit is final: it is emitted, and its row is let go. What is kept
in memory are the rows since the survivors last shared an ancestor, usually one or two.
Ties compare whole unresolved suffixes. As all survivors have consumed the same rows and
none of their edit strings is a prefix of another, the order of two strings never changes
once they differ, so the result of that comparison is carried along as the survivor's rank
and extended by each row's edits.

In Spark: rows are shuffled once by conversation; repeated turns are found by a window over
(conversation, role, digest of the text), which that shuffle serves; then each partition is
sorted by conversation and turn and read as a stream, in which a conversation is never held
as a whole. A conversation of any length takes one task, because its digest is one SHA-256
over its rows in order, but that task's memory does not grow with it beyond one letter a row.

Cases: null ids form one conversation; null turns come first and count for no gap; null
roles and texts are one space; rows with the same turn are ordered by role and text;
a conversation none of whose rows is left has zeros and empty results; an empty table gives
an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.common import with_row

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
#: What a truncated row costs if it stays.
TRUNCATED = 5

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant turn is put at the end.
_NEXT = (USER, USER, ASSISTANT, USER)
_SPOKEN = ("user", "user", "assistant", "user")
#: The state after a kept row, by state and initial; other rows cannot be kept.
_KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Inserts that complete a conversation from each state.
_CLOSE = ("", "II", "I", "")
#: BEATS[y][x]: what it costs state y at most to match whatever state x does next. Nothing
#: and assistant both end a conversation and take a user turn next; only the first takes a
#: system turn, which the other would delete.
BEATS = (
    (0, 0, 5, 0),
    (12, 0, 5, 10),
    (7, 5, 0, 5),
    (2, 0, 5, 0),
)

_STOP = frozenset(".!?")


def last_mark(text: str) -> str:
    """The last character that is no white space, or nothing."""
    kept = text.rstrip(" \t\n\x0b\x0c\r")
    return kept[-1:]


class Node:
    """One edit in the tree of back pointers."""

    __slots__ = ("edit", "row", "parent", "kids", "held")

    def __init__(self, edit: str, row, parent):
        self.edit, self.row, self.parent = edit, row, parent
        self.kids: list[Node] = []
        self.held = 0
        if parent is not None:
            parent.kids.append(self)


class Survivor(NamedTuple):
    cost: int
    node: Node


class Repair:
    """The search over one conversation; edits are handed to `emit(edit, row, role, text)`."""

    def __init__(self, emit: Callable[[str, object, str | None, str | None], None]):
        self.emit = emit
        self.root = Node("", None, None)
        self.root.held = 1
        #: State and survivor, in ASCII order of the edits so far.
        self.alive: list[tuple[int, Survivor]] = [(NOTHING, Survivor(0, self.root))]
        self.state = NOTHING  # after the edits emitted
        self.unresolved_most = 0

    def _options(self, initial: str, fault: str) -> Iterator[tuple[int, int, int, str]]:
        """(state after, cost, rank of the survivor it extends, edits added)."""
        for rank, (state, survivor) in enumerate(self.alive):
            cost, added = survivor.cost, ""
            for _ in range(3):  # more than two inserts in a row only repeat a state
                yield state, cost + COST[DELETE], rank, added + DELETE
                if fault not in ("blank", "duplicate"):
                    stays = cost + (TRUNCATED if fault == "truncated" else 0)
                    kept = _KEPT.get((state, initial))
                    if kept is not None:
                        yield kept, stays, rank, added + KEEP
                    yield _NEXT[state], stays + COST[REROLE], rank, added + REROLE
                state, cost, added = _NEXT[state], cost + COST[INSERT], added + INSERT

    def _release(self, node: Node) -> None:
        node.held -= 1
        while node is not self.root and not node.held and not node.kids:
            node.parent.kids.remove(node)
            node = node.parent

    def _grow(self, best: list[tuple[int, int, int, str]], row) -> None:
        """Replace the survivors by (state, cost, rank, edits) in order of their strings."""
        before = self.alive
        self.alive = []
        for state, cost, rank, edits in best:
            node = before[rank][1].node
            for edit in edits:
                node = Node(edit, None if edit in (INSERT, DELETE) else row, node)
            node.held += 1
            self.alive.append((state, Survivor(cost, node)))
        for _, survivor in before:
            self._release(survivor.node)
        self._coalesce()

    def step(self, row: tuple[str, str], fault: str) -> None:
        """Take the next row (role, text) with its first fault."""
        best: dict[int, tuple[int, int, str]] = {}
        for state, cost, rank, edits in self._options(row[0][:1], fault):
            if state not in best or (cost, rank, edits) < best[state]:
                best[state] = (cost, rank, edits)
        found = sorted(((rank, edits, state, cost) for state, (cost, rank, edits) in best.items()))
        kept = [
            (x, cost, rank, edits) for i, (rank, edits, x, cost) in enumerate(found)
            if not any(
                cost > other + BEATS[y][x] or (cost == other and not BEATS[y][x] and j < i)
                for j, (_, _, y, other) in enumerate(found) if j != i)]
        self._grow(kept, row)

    def _coalesce(self) -> None:
        root = self.root
        while len(root.kids) == 1 and not self._is_survivor(root):
            root = root.kids[0]
            root.parent = None
            self._say(root)
        self.root = root

    def _is_survivor(self, node: Node) -> bool:
        return any(s.node is node for _, s in self.alive)

    def _say(self, node: Node) -> None:
        role = text = None
        if node.edit != DELETE:
            role, text = _SPOKEN[self.state], ""
            if node.row is not None:
                text = node.row[1]
            if node.edit == KEEP:
                role = node.row[0]
                self.state = _KEPT[self.state, role[:1]]
            else:
                self.state = _NEXT[self.state]
        self.emit(node.edit, node.row, role, text)
        node.row = None

    def close(self) -> int:
        """Emit what is left and return the cost."""
        cost, rank, state, edits = min(
            (s.cost + COST[INSERT] * len(_CLOSE[state]), rank, state, _CLOSE[state])
            for rank, (state, s) in enumerate(self.alive))
        self._grow([(ASSISTANT if edits else state, cost, rank, edits)], None)
        return cost


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with roles and texts damaged by the hash of id and turn, and `copies`: 0 for a
    row that is dropped, 2 for one that is repeated; the row itself stays, once."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _in_order(rows: DataFrame) -> DataFrame:
    """Each conversation's rows next to each other, in order, with `_seen`: its role and text came before."""
    keyed = with_row(rows).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.col("copies").cast("int").alias("copies"), "_row")
    place = [F.col("turn").asc_nulls_first(), F.col("_row")]
    same = Window.partitionBy("conv_id", "role", "_text", F.col("copies") > 0).orderBy(*place)
    return (
        keyed.withColumn("_text", F.md5(F.col("text").cast("binary")))
        .repartition("conv_id")
        .withColumn("_seen", F.row_number().over(same) > 1)
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "_row")
        .select("conv_id", "turn", "role", "text", "copies", "_seen"))


class Facts:
    """What is counted over a conversation's rows."""

    def __init__(self):
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.initial: str | None = None

    def take(self, turn: int | None, role: str, text: str, seen: bool) -> str:
        """Count a row and return its first fault."""
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        mark = last_mark(text)
        fault = "blank" if not mark else "duplicate" if seen else "" if mark in _STOP else "truncated"
        if fault:
            self.faults[fault] += 1
        return fault

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def _repaired(batches: Iterator[pa.RecordBatch], start: Callable, finish: Callable) -> Iterator:
    """Run the search over a stream of ordered rows. `start(conv_id)` gives what takes the
    edits; what `finish(conv_id, facts, cost)` gives at the end of each conversation is
    yielded, and None after every few rows, so that a caller can hand on what it holds."""
    current: object = object()
    search = facts = None
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            for conv, turn, role, text, copies, seen in zip(*(c.to_pylist() for c in part.columns)):
                if search is None or conv != current:
                    if search is not None:
                        yield finish(current, facts, search.close())
                    current, facts, search = conv, Facts(), Repair(start(conv))
                for copy in range(copies):
                    search.step((role, text), facts.take(turn, role, text, seen or copy > 0))
            yield None
    if search is not None:
        yield finish(current, facts, search.close())


#: Conversations and characters of audits after which a batch of results is handed back.
_ROWS, _CHARS = 2000, 4_000_000


def audit(rows: DataFrame) -> DataFrame:
    """One row per conversation: counts, the cost and letters of the cheapest edits, and the
    hash of the repaired rows. `rows` has conv_id, turn, role, text and `copies`."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters: list[str] = []
        hash_ = hashlib.sha256()
        first = True

        def start(conv):
            nonlocal hash_, first
            letters.clear()
            hash_, first = hashlib.sha256(), True

            def emit(edit, row, role, text):
                nonlocal first
                letters.append(edit)
                if role is not None:
                    hash_.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False

            return emit

        def finish(conv, facts, cost):
            return (conv, facts.gaps(), *facts.faults.values(), facts.illegal, cost, "".join(letters), hash_.hexdigest())

        held: list[tuple] = []
        chars = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held))
            types = [id_type, *[pa.int64()] * len(names), pa.string(), pa.string()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", *names, "audit", "repaired_sha256"])
            held.clear()
            return batch

        id_type = pa.int64()

        def typed(stream):
            nonlocal id_type
            for b in stream:
                id_type = b.schema.field(0).type
                yield b

        for result in _repaired(typed(batches), start, finish):
            if result is None:
                continue
            held.append(result)
            chars += len(result[-2])
            if len(held) >= _ROWS or chars >= _CHARS:
                yield flush()
                chars = 0
        if held:
            yield flush()

    return _in_order(rows).mapInArrow(
        run, f"conv_id {kind}, {', '.join(f'{n} long' for n in names)}, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position (from 0), the edit that made it, role and text."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        id_type = pa.int64()

        def start(conv):
            position = 0

            def emit(edit, row, role, text):
                nonlocal position
                if role is not None:
                    held.append((conv, position, edit, role, text))
                    position += 1

            return emit

        def flush() -> pa.RecordBatch:
            types = [id_type, pa.int64(), *[pa.string()] * 3]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held), types)], ["conv_id", "position", "edit", "role", "text"])
            held.clear()
            return batch

        def typed(stream):
            nonlocal id_type
            for b in stream:
                id_type = b.schema.field(0).type
                yield b

        for _ in _repaired(typed(batches), start, lambda *_: None):
            if len(held) >= 256:
                yield flush()
        if held:
            yield flush()

    return _in_order(rows).mapInArrow(run, f"conv_id {kind}, position long, edit string, role string, text string")


def undamaged(conversations: DataFrame) -> DataFrame:
    """Rows as they are, for `audit` and `repair`: nulls are one space, each row once."""
    blank: Callable[[str], Column] = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    return conversations.select("conv_id", "turn", blank("role"), blank("text"), F.lit(1).alias("copies"))

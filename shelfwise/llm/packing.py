"""Operator 9: vector bin packing with the dot-product heuristic.

Examples are placed into sequences under simultaneous limits on tokens, segments and
loss-bearing tokens. Each input partition packs its own documents in blocks, so the job
is one narrow pass without a shuffle: a sequence is some thousand bytes, a block some
thousand documents, and what is lost by not packing across blocks is one partly filled
sequence per block. Inside a block, an open sequence repeatedly takes the example whose
demand vector has the largest dot product with the capacity left, among those that fit;
when none fits, the largest one is cut to fill what is left. Examples longer than a
sequence first give away full sequences.

Loss-bearing tokens are the last `loss` tokens of an example (prompt first, answer last);
of documents all tokens bear loss.

Cases: null or empty text is the separator alone; repeated rows are packed each for
itself; an empty table gives no pieces; other columns are ignored. Rerun on the same files
and settings, the result is the same. Ties go to the example that comes first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bpe import KEPT_CHARS, byte_symbols, pieces
from shelfwise.llm.common import text_of


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 128
    loss: int = 1024


#: A block is closed at so many documents or tokens.
BLOCK_DOCS = 1024
BLOCK_TOKENS = 4_000_000
#: Pieces whose ids a worker keeps.
CACHED = 120_000


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, by the `tokenizers`
    library. The pre-tokenizer's pieces are encoded independently of each other, so pieces
    met before are looked up and only new ones go to the library's model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.as_symbols = dict(enumerate(byte_symbols()))
        added = self.library.get_added_tokens_decoder()
        self.special = {t.content: int(i).to_bytes(4, "little") for i, t in added.items()}
        words = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(words)})").split if words else lambda t: [t]
        self.has = re.compile("|".join(words)).search if words else lambda t: None
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if not self.has(text):
            return pieces(text)
        return [p for part in self.split(text) for p in ([part] if part in self.special else pieces(part))]

    def new(self, piece: str) -> bytes:
        if piece in self.special:
            return self.special[piece]
        symbols = piece.encode().decode("latin-1").translate(self.as_symbols)
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(symbols)])
        if len(piece) <= KEPT_CHARS:
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        known, new = self.known.get, self.new
        return b"".join([known(p) or new(p) for p in self.pieces(text)])


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(tokens: list[int], loss: list[int], limits: Limits) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (example, start, length, sequence, offset) of one block of examples."""
    total = np.array(tokens, dtype=np.int64)
    free_until = total - np.array(loss, dtype=np.int64)  # tokens before this one bear no loss
    start = np.zeros(len(total), dtype=np.int64)
    bound = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
    sequence = -1

    def longest(i: int, room: int, loss_room: int) -> int:
        """Tokens of the rest of example i that fit."""
        free = max(0, int(free_until[i] - start[i]))
        return min(int(total[i] - start[i]), room, free + loss_room)

    for i in range(len(total)):  # full sequences of long examples
        while (n := longest(i, limits.tokens, limits.loss)) < total[i] - start[i] or n == limits.tokens:
            sequence += 1
            yield i, int(start[i]), n, sequence, 0
            start[i] += n
    live = np.flatnonzero(start < total)
    while len(live):
        sequence += 1
        offset, left = 0, bound.copy()
        while left[1] >= 1 and left[0] > 0 and len(live):
            rest = total[live] - start[live]
            bearing = np.minimum(rest, total[live] - np.maximum(free_until[live], start[live]))
            fits = (rest <= left[0]) & (bearing <= left[2])
            share = left / bound / bound
            score = np.where(fits, rest * share[0] + share[1] + bearing * share[2], -1.0)
            at = int(score.argmax())
            if not fits[at]:
                at = int(rest.argmax())
            i = int(live[at])
            n = longest(i, int(left[0]), int(left[2]))
            if n <= 0:
                break
            borne = max(0, int(start[i]) + n - max(int(free_until[i]), int(start[i])))
            yield i, int(start[i]), n, sequence, offset
            start[i] += n
            offset += n
            left -= (n, 1, borne)
            if start[i] >= total[i]:
                live = np.delete(live, at)


def pack_documents(
    docs: DataFrame, path: str, limits: Limits = Limits(), separator: int = 0, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Pieces of the tokenised documents: `doc_id`, `start`, `length`, `ids` (little-endian
    unsigned 32-bit), `doc_tokens`, `sequence_id`, `offset`. `separator` ends each document."""
    end = int(separator).to_bytes(4, "little")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        base, used = TaskContext.get().partitionId() << 33, 0
        keys: list = []
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal used
            n = [len(x) // 4 for x in held]
            placed = list(pack(n, n, limits))
            rows = {
                key: [keys[i] for i, *_ in placed],
                "start": [s for _, s, *_ in placed],
                "length": [m for _, _, m, *_ in placed],
                "ids": [held[i][4 * s:4 * (s + m)] for i, s, m, *_ in placed],
                "doc_tokens": [n[i] for i, *_ in placed],
                "sequence_id": [base + used + q for *_, q, _ in placed],
                "offset": [o for *_, o in placed],
            }
            used += 1 + max((q for *_, q, _ in placed), default=-1)
            types = [pa.int64() if kind == "bigint" else pa.array(keys).type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            keys.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

        size = 0
        for batch in batches:
            for at in range(0, len(batch), 128):
                part = batch.slice(at, 128)
                for k, ids in zip(part.column(0).to_pylist(), map(encode, part.column(1).to_pylist())):
                    keys.append(k)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if len(held) >= BLOCK_DOCS or size >= BLOCK_TOKENS:
                        yield close()
                        size = 0
        if held:
            yield close()

    return docs.select(F.col(key), text_of(text).alias("text")).mapInArrow(
        run, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )

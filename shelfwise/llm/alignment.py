"""Operator 11: alignment of two tokenizers by common ends.

The ends of each tokenizer's tokens, counted in bytes of the same text, go into a
dictionary from end to index. The keys common to both dictionaries, a hash-set
intersection, are sorted; they slice both id lists into groups. A group's last tokens end
together, so each slice expands to one link.

Counting links over all texts takes two steps in Spark. Each text gives its distinct links
with their number, which are summed by link with a map side. The texts' links are then
joined with these sums and the best sum of each second id, and added up per text. A frequent
link is one row per text. Up to `FEW` distinct links, which are counted first, the sums are
broadcast; more are shuffled, and every link is then split over `SALTS` parts.

Cases: a null or empty text, and one that the second tokenizer does not give back byte for
byte (it holds U+2581), has no tokens: zeros and an empty hash; special strings are plain
text; repeated rows count each for itself; equal texts have equal results; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bpe import byte_symbols
from shelfwise.llm.common import stored, text_of, with_row

#: Distinct links, of some 30 bytes each, whose sums are broadcast.
FEW = 500_000
#: Parts of a link where the sums are joined by a shuffle.
SALTS = 16
#: Texts or characters after which a batch is handed back.
_TEXTS, _CHARS = 500, 1_000_000

_SPACE = "▁"
_LONG_WHITE = re.compile(r"\s{1000}").search
_NOTHING = 0, 0, 0, "", (), ()


def common_ends(first_ends: list[int], second_ends: list[int]) -> list[np.ndarray]:
    """For each common end, in order, how many tokens of either list end there or before."""
    at = [dict(zip(ends, count(1))) for ends in (first_ends, second_ends)]
    common = sorted(at[0].keys() & at[1].keys())
    return [np.fromiter(map(d.__getitem__, common), np.int64, len(common)) for d in at]


class Aligner:
    """Both tokenizers of a worker, and the bytes and names of each of their tokens."""

    def __init__(self, first_path: str, second_path: str):
        import sentencepiece

        self.encode, self.first_bytes = _byte_level(first_path)
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=second_path)
        self.second_bytes = [
            bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(map(lib.id_to_piece, range(lib.get_piece_size())))]
        self.lengths = [np.array([len(b) for b in table]) for table in (self.first_bytes, self.second_bytes)]
        self.n = max(map(len, self.lengths))
        # An id as written inside a list, at the end of a first list, at the end of a group.
        self.names = np.array([f"{i}{after}" for after in ",|;" for i in range(self.n)], dtype="S")
        # Without a normalizer the second tokenizer changes nothing but its own sign for a space.
        self.plain = _normalizer(second_path) == "identity" and lib.is_byte(lib.piece_to_id("<0x00>"))

    def text(self, text: str) -> tuple[int, int, int, str, Sequence[int], Sequence[int]]:
        """Tokens of both, groups, the hash of the groups, the distinct links and their numbers."""
        if not text:
            return _NOTHING
        if self.plain and _SPACE in text:
            return _NOTHING
        a, b = np.asarray(self.encode(" " + text), np.int64), np.array(self.library.encode(text))
        if not self.plain and not self.exact(text, a, b):
            return _NOTHING
        m, n = common_ends(*(np.cumsum(size[ids]).tolist() for size, ids in zip(self.lengths, (a, b))))
        # Names in the order in which they are written: each group's first ids, then its second ids.
        name = np.empty(len(a) + len(b), np.int64)
        for ids, upto, other, last in ((a, m, np.append(0, n), self.n), (b, n, m, 2 * self.n)):
            ends = np.zeros(len(ids), np.int64)
            ends[upto - 1] = 1
            group = np.cumsum(ends) - ends
            name[np.arange(len(ids)) + other[group]] = ids + ends * last
        written = self.names[name].tobytes().replace(b"\0", b"")[:-1]
        links, counts = np.unique(a[m - 1] << 32 | b[n - 1], return_counts=True)
        return len(a), len(b), len(m), hashlib.sha256(written).hexdigest(), links, counts

    def exact(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether both tokenizers give back the text with a space before it."""
        tables = (self.first_bytes, a), (self.second_bytes, b)
        return all(b"".join(map(t.__getitem__, ids.tolist())) == f" {text}".encode() for t, ids in tables)


def _normalizer(path: str) -> str:
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return model.normalizer_spec.name


def _byte_level(path: str) -> tuple[Callable[[str], Sequence[int]], list[bytes]]:
    """A byte-level vocabulary's encoder, special strings as plain text, and its tokens' bytes.

    Where the ids are the order of the merges, as usual, they are ranks, for which there is
    a faster library than that of the file; it is told the same vocabulary and pattern.
    """
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    as_byte = {s: b for b, s in enumerate(byte_symbols())}
    table = [b""] * (max(vocab.values()) + 1)
    for name, i in vocab.items():
        if all(c in as_byte for c in name):
            table[i] = bytes(as_byte[c] for c in name)
    return _ranked(path, table) or _filed(path), table


def _filed(path: str) -> Callable[[str], Sequence[int]]:
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids


def _ranked(path: str, table: list[bytes]) -> Callable[[str], Sequence[int]] | None:
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    vocab = spec["model"]["vocab"]
    made = [vocab[a + b] for a, b in merges]
    if spec.get("normalizer") or made != list(range(256, 256 + len(made))) or spec["pre_tokenizer"]["type"] != "ByteLevel":
        return None
    special = {t["id"] for t in spec.get("added_tokens", [])}
    ranks = {t: i for i, t in enumerate(table) if t and i not in special}
    library = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = cache(_filed)
    quick = lambda text: library.encode_to_numpy(text, disallowed_special=())
    # The faster library's pattern matching does not bear very long white space.
    return lambda text: whole(path)(text) if _LONG_WHITE(text) else quick(text)


@cache
def aligner(first_path: str, second_path: str) -> Aligner:
    return Aligner(first_path, second_path)


def aligned(docs: DataFrame, first_path: str, second_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document `key`, `_row` (unique), n_a, n_b, n_groups, groups_sha256, and `links`:
    its distinct links as (first id << 32 | second id, number)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, _row long, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "links array<struct<link:long,n:long>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(first_path, second_path).text
        held: list[tuple] = []
        size = 0

        def flush(id_type: pa.DataType, row_type: pa.DataType) -> pa.RecordBatch:
            nonlocal size
            *plain, links, counts = zip(*held)
            types = [id_type, row_type, *[pa.int64()] * 3, pa.string()]
            flat = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([np.asarray(x, np.int64) for x in part])) for part in (links, counts)], ["link", "n"])
            offsets = pa.array(accumulate(map(len, links), initial=0), pa.int32())
            columns = [pa.array(c, t) for c, t in zip(plain, types)]
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(offsets, flat)], [key, "_row", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

        for batch in batches:
            types = batch.schema.field(0).type, batch.schema.field(1).type
            for at in range(0, len(batch), 64):
                for k, row, t in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    held.append((k, row, *work(t)))
                    size += len(t)
                    if len(held) >= _TEXTS or size >= _CHARS:
                        yield flush(*types)
            if held:
                yield flush(*types)

    rows = with_row(docs.select(F.col(key), text_of(text).alias("text"))).select(key, "_row", "text")
    return rows.mapInArrow(run, schema)


def counted(found: DataFrame) -> DataFrame:
    """All links of `aligned` rows: link, `count`, and whether it is the best of its second id."""
    sums = found.select(F.explode("links").alias("x")).groupBy("x.link").agg(F.sum("x.n").alias("count"))
    sums = stored(sums, "link-counts")
    second = F.col("link").bitwiseAND((1 << 32) - 1)
    best = sums.groupBy(second.alias("_second")).agg(F.max("count").alias("_most"))
    rows = sums.withColumn("_second", second).join(best, "_second")
    return rows.select("link", "count", (F.col("count") == F.col("_most")).alias("best"))


def align(docs: DataFrame, first_path: str, second_path: str, key: str = "doc_id") -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = stored(aligned(docs, first_path, second_path, key=key), "aligned")
    sums = stored(counted(found), "links-counted")
    links = found.select("_row", F.explode("links").alias("x")).select("_row", "x.link", "x.n")
    if sums.count() <= FEW:
        joined = links.join(F.broadcast(sums), "link")
    else:
        salted = links.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int"))
        joined = salted.join(sums.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS))))), ["link", "_salt"])
    per_text = (
        joined.groupBy("_row").agg(
            F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("count")).alias("count_sum")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (
        found.drop("links").join(per_text, "_row", "left")
        .select(key, "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256"))

"""Operator 5: language identification by nearest centroid.

A text's letters are cut into byte n-grams (1 to 3, words apart), hashed into `BUCKETS`
counts, weighted by TF-IDF and normalised. Each language has several centroids, found by
spherical k-means over a bounded sample of distinct labelled texts (`per_language`, chosen by
a hash of the text, so that reruns agree). The prediction is the language of the centroid with the
largest cosine; a text whose cosine is below that language's bound is rejected. A bound holds
for a language and a class of length (the power of two of the text's distinct n-grams, as
short texts lie farther): `slack` times a low quantile of the cosines of sampled texts to
centroids of their language that were found without them.

Cases: text that is null or has no letter is `und`, score 0 and rejected; with nothing to
learn from, every text is; null languages are not learned; ties go to the language first in
order; repeated rows and extra columns stay, columns named like an output are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import text_of

BUCKETS = 4096
UNKNOWN = "und"
#: Texts turned into vectors at a time.
CHUNK = 256
#: Classes of length: 2**b distinct n-grams and more.
CLASSES = 13

_not_letters = re.compile(r"[\W\d_]+")


def words_of(text: str) -> str:
    """The letters of a text, with one space where others stood."""
    words = _not_letters.sub(" ", text).strip()
    if words and not words.replace(" ", "").isalpha():
        # Numerals that are no decimal digits, such as one half or Roman eight, are no letters.
        words = " ".join("".join(c if c.isalpha() else " " for c in words).split())
    return words


def grams(text: str) -> np.ndarray | None:
    """Counts of hashed n-grams; None without a letter."""
    words = words_of(text)
    if not words:
        return None
    b = np.frombuffer(f" {words.lower()} ".encode(), dtype=np.uint8).astype(np.uint32)
    two = b[:-1] << 8 | b[1:]
    three = two[:-1] << 8 | b[2:]
    # The n-gram's bytes and length as a number, spread over the buckets by a product.
    keys = np.concatenate([b | 1 << 24, two | 2 << 24, three | 3 << 24])
    return np.bincount((keys * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF rows, and which texts have letters."""
    counts = [grams(t) for t in texts]
    known = np.array([c is not None for c in counts], dtype=bool)
    x = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for i, c in enumerate(counts):
        if c is not None:
            x[i] = c
    x = np.log1p(x) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1), known


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    bounds: np.ndarray  # of each centroid and class of length

    @property
    def reject_below(self) -> float:
        """The least bound."""
        return float(self.bounds.min()) if self.bounds.size else 0.0


def length_class(x: np.ndarray) -> np.ndarray:
    """The class of each row by its distinct n-grams."""
    return np.log2(np.maximum((x > 0).sum(axis=1), 1)).astype(int)


def clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from rows that are far from each other."""
    start = [0]
    for _ in range(1, min(k, len(x))):
        start.append(int((x @ x[start].T).max(axis=1).argmin()))
    c = x[start]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = c / np.linalg.norm(c, axis=1, keepdims=True)
    return c


def held_out(x: np.ndarray, k: int, folds: int = 3) -> np.ndarray:
    """The cosine of each row to centroids of the rows of other folds; NaN for too few rows."""
    out = np.full(len(x), np.nan)
    if len(x) >= 2 * folds:
        own = np.arange(len(x)) % folds
        for f in range(folds):
            out[own == f] = (x[own == f] @ clusters(x[own != f], k).T).max(axis=1)
    return out


def bounds_of(cosines: list[np.ndarray], classes: list[np.ndarray], slack: float, quantile: float, least: int = 5) -> np.ndarray:
    """Bounds of each language and class of length. A class with fewer than `least` texts of
    a language takes all languages' texts; one with too few of these as well the class
    before, and before the first known class the bound falls with the root of the length."""
    def low(c: np.ndarray, k: np.ndarray, b: int) -> float:
        c = c[(k == b) & ~np.isnan(c)]
        return slack * float(np.quantile(c, quantile)) if len(c) >= least else np.nan

    every = np.concatenate(cosines), np.concatenate(classes)
    pooled = [low(*every, b) for b in range(CLASSES)]
    own = np.array([[v if not np.isnan(v := low(c, k, b)) else pooled[b] for b in range(CLASSES)] for c, k in zip(cosines, classes)])
    for row in own:
        known = np.flatnonzero(~np.isnan(row))
        if not len(known):  # nothing to go by: far below any text that shares its words
            row[:] = 0.25 * slack
            continue
        for b in range(known[0] - 1, -1, -1):
            row[b] = row[b + 1] / np.sqrt(2)
        for b in range(known[0] + 1, CLASSES):
            row[b] = row[b - 1] if np.isnan(row[b]) else row[b]
    return own


def fit(
    labelled: DataFrame, per_language: int = 300, k: int = 3, slack: float = 0.6, most_languages: int = 500,
    quantile: float = 0.05,
) -> Model:
    """Learn from columns `text` and `lang`. The driver gets one row per language and the
    counts of at most `per_language` texts of each, one language at a time."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("text").alias("_hash"))
    # About how many distinct texts: copies of one text take one place of the sample.
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("_hash").alias("count")).orderBy("lang").limit(most_languages + 1).collect()
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not sizes:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.ones(BUCKETS, np.float32), np.zeros((0, CLASSES)))
    # Twice the wanted share passes the hash, then the first by hash are kept.
    u = F.shiftrightunsigned("_hash", 11).cast("double") / float(1 << 53)
    share = F.create_map([F.lit(v) for r in sizes for v in (r["lang"], min(1.0, 2.0 * per_language / r["count"] + 50 / r["count"]))])
    few = rows.filter(u < share[F.col("lang")]).dropDuplicates(["lang", "_hash"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "text"))
    few = few.withColumn("_rank", rank).filter(F.col("_rank") <= per_language)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            made = [grams(t) for t in d["text"]]
            keep = [i for i, c in enumerate(made) if c is not None]
            sparse = [np.flatnonzero(made[i]) for i in keep]
            yield pd.DataFrame({
                "lang": d["lang"].iloc[keep].to_numpy(), "hash": d["_hash"].iloc[keep].to_numpy(),
                "at": [s.astype("<u2").tobytes() for s in sparse],
                "n": [made[i][s].astype("<u4").tobytes() for i, s in zip(keep, sparse)],
            })

    sample = few.mapInPandas(count, "lang string, hash long, at binary, n binary").toPandas()
    sample = sample.sort_values(["lang", "hash", "at"], ignore_index=True)
    if not len(sample):
        return Model([], np.zeros((0, BUCKETS), np.float32), np.ones(BUCKETS, np.float32), np.zeros((0, CLASSES)))
    x = np.zeros((len(sample), BUCKETS), dtype=np.float32)
    for i, (at, n) in enumerate(zip(sample["at"], sample["n"])):
        x[i, np.frombuffer(at, "<u2")] = np.frombuffer(n, "<u4")
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    x = np.log1p(x) * idf
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    names, found, sizes, cosines, classes = [], [], [], [], []
    for lang, at in sorted(sample.groupby("lang", sort=True).indices.items()):
        c = clusters(x[at], k)
        names += [lang] * len(c)
        found.append(c)
        sizes.append(len(c))
        cosines.append(held_out(x[at], k))
        classes.append(length_class(x[at]))
    bounds = np.repeat(bounds_of(cosines, classes, slack, quantile), sizes, axis=0)
    return Model(names, np.concatenate(found), idf, bounds)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `lang_pred`, `score` (cosine) and `rejected`."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # languages x k centroids: bounded by `fit`

    @F.pandas_udf("lang string, score double, rejected boolean")
    def nearest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in texts:
            parts = []
            for at in range(0, len(batch), CHUNK):
                x, known = vectors(batch.iloc[at:at + CHUNK].tolist(), m.idf)
                if len(m.languages):
                    cosine = x @ m.centroids.T
                    best = cosine.argmax(axis=1)
                    score = np.clip(cosine[np.arange(len(x)), best], 0, 1).astype(float)
                    bound = m.bounds[best, length_class(x)]
                else:
                    best, known = np.zeros(len(x), int), np.zeros(len(x), bool)
                    score, bound = np.zeros(len(x)), np.zeros(len(x))
                lang = [m.languages[j] if ok else UNKNOWN for j, ok in zip(best, known)]
                parts.append(pd.DataFrame({
                    "lang": lang, "score": np.where(known, score, 0.0), "rejected": ~known | (score < bound)}))
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang": [], "score": [], "rejected": []})

    # A filter on the result must not make Spark find it once for itself and once for the rows
    # that stay: twice the work, and twice the Python workers in memory.
    nearest = nearest.asNondeterministic()
    return (
        docs.withColumn("_found", nearest(text_of(text)))
        .withColumns({"lang_pred": F.col("_found.lang"), "score": F.col("_found.score"), "rejected": F.col("_found.rejected")})
        .drop("_found")
    )


def fold(key: str = "doc_id", folds: int = 5) -> Column:
    """The fold of a row: crc32 of its id as text."""
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds))

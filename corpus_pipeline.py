"""The corpus pipeline: documents to training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each stage's
result as Parquet into the shared folder and reads it again as the next one's documents.
All stages but the last return the columns of `documents`; a stage that changes a text
updates its `n_chars`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import langid, mixing, neardup, packing, suffixdedup
from shelfwise.llm.common import read, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents whose language is rejected go; the others get the language found.

    Null, empty and letterless texts are in no language and go too; repeated rows are judged
    alike; without a labelled document all go.
    """
    known = langid.identify(docs, langid.fit(docs))
    return known.filter(~F.col("rejected")).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each group stays, the one with the smallest id.

    Null and empty texts are one group, with fingerprint zero; of repeated rows one stays.
    """
    return neardup.keep_one(docs).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: repeated passages are cut out; documents of which nothing is left stay, empty."""
    left = suffixdedup.remove(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: each document as often as the mix takes it.

    Documents without words are never taken; a null source is a source; of equal rows any are
    taken, as they are interchangeable; the mix depends on the rows alone, so reruns agree.
    """
    return mixing.repeat_rows(mixing.mix(docs)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: pieces of sequences.

    A null or empty text is its separator; copies that the mix took are packed each for itself.
    """
    limits = packing.Limits(segments=packing.Limits.tokens)
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), limits, separator=0)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("passages", passages),
    ("mix", mix),
    ("pack", pack),
]

#: No stage can be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

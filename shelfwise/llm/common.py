"""What the operators of this subpackage share: tables, words, row keys, stored steps."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import shared_dir

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which executors and driver share.

    Where the session has none, a purely local one gets a folder of its own (tests); on a
    cluster that is an error.
    """
    return shared_dir(spark).rstrip("/")


#: Bytes of a batch of rows that goes to a Python worker while a step is stored.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches for Python workers are cut by bytes, as texts may be long; the session's own
    bound holds again afterwards, and holds throughout where it is smaller."""
    before = spark.conf.get(_BATCH, None)
    if before is not None and before.rstrip("b").isdigit() and int(before.rstrip("b")) <= BATCH_BYTES:
        yield
        return
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back: cuts the lineage,
    keeps the rows fixed, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    tidy(spark)
    return spark.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps that are done. It does so when the
    driver's garbage is collected, which on its own may come after the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def pinned(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder; Spark removes it when it is unused."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def with_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """Add a key that is unique even where ids repeat or are null. It numbers the rows of
    each input partition, so `df` must be read from files or stored, not shuffled."""
    return df.withColumn(name, F.monotonically_increasing_id())


def hex64(column: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def few_by_hash(df: DataFrame, rows: int, *columns: str, seed: int = 17) -> DataFrame:
    """At most `rows` rows, those with the smallest hash of `columns`. A first cut by the
    hash keeps the rows that tasks offer to the driver near that number at any size."""
    n = df.count()
    hash_ = F.xxhash64(F.lit(seed), *columns)
    u = F.shiftrightunsigned(hash_, 11).cast("double") / float(1 << 53)
    share = min(1.0, (1.5 * rows + 100) / n) if n else 1.0
    return df.filter(u < share).orderBy(hash_, *columns).limit(rows)

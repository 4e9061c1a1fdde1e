"""Drop-folder ingestion, idempotent inserts and running totals.

A table fed by a stream is a folder with one `batch=<id>` folder per micro-batch, each
written in overwrite mode. A batch that is replayed after a failure replaces its own rows,
so every row counts once.

Beside the rows lies an index of their keys, `_keys/day=<date>/batch=<id>`, in a folder that
readers of the table pass over. A batch lists and opens the index of its own days only, so
inserting costs what a batch and its days hold, however much was stored before. Where
batches span years, an index by month has fewer folders (`grain`); its day is the first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from shelfwise.operators import clean
from shelfwise.operators.facts import STATE_KEYS, STATE_SUMS, merge_states
from shelfwise.operators.ordered import first_per_key, join_on
from shelfwise.session import pinned
from shelfwise.sources.files import rename
from shelfwise.sources.schemas import RAW_SALES, SALES_NAMES


def drop_folder(
    spark: SparkSession, folder: str, archive: str | None = None, schema: StructType = RAW_SALES,
    fmt: str = "csv", files_per_batch: int = 1000, pattern: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream; read files move to `archive`.

    Files of a batch are archived while a later batch runs.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.options(header=True, multiLine=True, escape='"')
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return reader.load(folder)


def drain(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Process everything that has arrived, then stop; the checkpoint remembers where."""
    return (
        stream.writeStream.foreachBatch(handle).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def earlier_batches(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    """Rows of batches before this one, None when nothing has been written yet."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as problem:
        # No folder, or one in which the first batch did not finish; all else is an error.
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return stored.filter(F.col("batch") < batch)


_INDEX = "_keys"


def _index_day(time: str, grain: str) -> Column:
    if grain not in ("day", "month"):
        raise ValueError(f"no index by {grain}")
    return F.trunc(time, "month") if grain == "month" else F.to_date(time)


def _index_rows(rows: DataFrame, keys: Sequence[str], time: str, batch, grain: str = "day") -> DataFrame:
    return rows.select(*keys, _index_day(time, grain).alias("day"), batch.cast("long").alias("batch"))


def _write_index(rows: DataFrame, path: str) -> None:
    """One folder per day and batch; those of a replayed batch are replaced."""
    rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "day", "batch").parquet(f"{path}/{_INDEX}")


def _folders(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Those of the folders that exist."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in names:
        folder = jvm.org.apache.hadoop.fs.Path(name)
        if folder.getFileSystem(conf).exists(folder):
            found.append(name)
    return found


def known_keys(
    spark: SparkSession, path: str, keys: Sequence[str], days: Sequence, batch: int, schema: StructType
) -> DataFrame | None:
    """Keys that batches before this one stored on `days` (a null day holds rows without a
    time), from the index of these days alone; None where there are none."""
    names = [f"{path}/{_INDEX}/day={'__HIVE_DEFAULT_PARTITION__' if d is None else d.isoformat()}" for d in days]
    found = _folders(spark, names)
    if not found:
        return None
    index = spark.read.schema(schema).option("basePath", f"{path}/{_INDEX}").parquet(*found)
    return index.filter(F.col("batch") < batch).select(*keys)


def build_index(spark: SparkSession, path: str, keys: Sequence[str], time: str, grain: str = "day") -> None:
    """The index of a table that was written without one."""
    _write_index(_index_rows(spark.read.parquet(path), keys, time, F.col("batch"), grain), path)


def insert_batch(
    path: str, keys: Sequence[str], time: str | None = None, grain: str = "day"
) -> Callable[[DataFrame, int], None]:
    """L2: write the rows of a batch whose key is new, once per key; null keys equal null.

    With `time`, one of the keys, only the key index of the batch's days is read, and the
    batch's new keys are added to it; without, all earlier batches are read.
    """
    def handle(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        # Written, not cached: a cached plan keeps every piece of its shuffle as a task of each later pass.
        fresh = pinned(first_per_key(rows, keys, []))
        if time:
            if not _folders(spark, [f"{path}/{_INDEX}"]) and earlier_batches(spark, path, batch) is not None:
                build_index(spark, path, keys, time, grain)
            days = [r[0] for r in fresh.select(_index_day(time, grain)).distinct().collect()]  # the calendar bounds them
            schema = _index_rows(fresh, keys, time, F.lit(batch), grain).schema
            known = known_keys(spark, path, keys, days, batch, schema)
        else:
            known = earlier_batches(spark, path, batch)
        new = fresh if known is None else join_on(fresh, known.select(*keys), keys, "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        if time:
            stored = spark.read.schema(new.schema).parquet(f"{path}/batch={batch}")
            _write_index(_index_rows(stored, keys, time, F.lit(batch), grain), path)

    return handle


def ingest_sales(
    spark: SparkSession, folder: str, target: str, checkpoint: str, archive: str | None = None,
    files_per_batch: int = 1000, sep: str = ">>", pattern: str | None = None, grain: str = "day",
) -> StreamingQuery:
    """L1, L2: raw sales files cleaned and inserted once, file by file or many at a time."""
    raw = drop_folder(spark, folder, archive, files_per_batch=files_per_batch, pattern=pattern)
    insert = insert_batch(target, clean.LINE_KEY, "thoi_gian", grain)

    def handle(rows: DataFrame, batch: int) -> None:
        insert(clean.clean_sales(rename(rows, SALES_NAMES), sep), batch)

    return drain(raw, checkpoint, handle)


def dedupe_stream(stream: DataFrame, time: str, keys: Sequence[str], delay: str = "1 day") -> DataFrame:
    """L2: duplicates within `delay` dropped in the stream, with bounded state."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_totals_stream(stream: DataFrame, time: str, keys: Sequence[str], delay: str = "1 day") -> DataFrame:
    """L3: running totals per day as a streaming aggregate, for update mode."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day").alias("day"), *keys)
        .agg(*[F.sum(c).alias(c) for c in STATE_SUMS[:3]], F.count("*").alias("so_giao_dich"))
        .withColumn("ngay", F.to_date("day.start")).drop("day")
    )


def add_states(path: str) -> Callable[[DataFrame, int], None]:
    """The sums of a batch of lines written as its own mergeable state."""
    def handle(rows: DataFrame, batch: int) -> None:
        state = rows.groupBy(*STATE_KEYS).agg(
            *[F.sum(c).alias(c) for c in STATE_SUMS[:3]], F.count("*").alias("so_giao_dich")
        )
        state.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return handle


def current_states(spark: SparkSession, path: str) -> DataFrame:
    """L3: the states of all batches merged."""
    return merge_states(spark.read.parquet(path).drop("batch"))

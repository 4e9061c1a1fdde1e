"""Session helpers: shared folder, checkpoints and the reporting date."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Session settings the operators count on. All are decided on measured sizes or make
# estimates more careful, so they hold from one node to a large cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # Split a hot join key even where that costs another shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet is several times larger in memory than on disk; a table is broadcast by
    # estimate only when it is small even so.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    # Skip the sort of a sort-merge join where every partition was measured to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Shuffles are cut finely and adaptive execution joins the pieces up to this size, so that
    # more rows make more tasks, not larger ones: compressed rows take many times it in memory.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply `SETTINGS` to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local master without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: fixes the rows and cuts the lineage, surviving executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def day(value: Column | dt.date | str) -> Column:
    """A date column from a column, a date or ISO text."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def latest_day(df: DataFrame, column: str) -> Column:
    """Newest date in `column` as a scalar subquery, so nothing is collected."""
    return df.agg(F.max(column).cast("date").alias("d")).scalar()

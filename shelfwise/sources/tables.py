"""JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """A10: append in batches of 10,000 at READ_COMMITTED."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=10_000, isolationLevel="READ_COMMITTED", **options)
        .mode("append")
        .save()
    )


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str | None = None,
    lower: int | None = None, upper: int | None = None, parts: int | None = None, **options,
) -> DataFrame:
    """A table, read in `parts` ranges of a numeric column when one is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if column:
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
        )
    return reader.load()

"""Data checks and monitoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.session import day


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """K1: failing rows per rule; a repeated value counts once per repetition."""
    parts = []
    if not_null:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        pairs = [F.struct(F.lit(f"not_null:{c}").alias("rule"), F.col(c).alias("failures")) for c in not_null]
        parts.append(row.select(F.inline(F.array(*pairs))))
    for c in unique:
        repeats = df.filter(F.col(c).isNotNull()).groupBy(c).agg((F.count("*") - 1).alias("extra"))
        parts.append(repeats.agg(
            F.lit(f"unique:{c}").alias("rule"), F.coalesce(F.sum("extra"), F.lit(0)).alias("failures")
        ))
    return _stack(parts)


def positive_value(column: str) -> Column:
    """K2: fails below zero."""
    return F.col(column) < 0


def profit_margin_range(column: str) -> Column:
    """K2: fails outside -1..1."""
    return (F.col(column) < -1) | (F.col(column) > 1)


def not_future_date(column: str, as_of) -> Column:
    """K2: fails after `as_of`."""
    return F.col(column) > day(as_of)


def transaction_consistency(gross: str, discount: str, net: str) -> Column:
    """K2: fails where gross less discount is not net, beyond a cent."""
    return F.abs(F.col(gross) - F.col(discount) - F.col(net)) > 0.01


def failing_rows(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """K2: rows that fail, once per failed test, to be stored as a table."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests.items()]))
    return df.withColumn("rule", F.explode(hits))


def table_profile(df: DataFrame, name: str, date_column: str, branch_column: str) -> DataFrame:
    """K3: rows, date range, days and branches."""
    return df.agg(
        F.lit(name).alias("table_name"), F.count("*").alias("rows"),
        F.min(date_column).alias("first_day"), F.max(date_column).alias("last_day"),
        F.countDistinct(date_column).alias("days"),
        F.countDistinct(branch_column).alias("branches"),
    )


def reconcile(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """K4: rows per table on both sides and the percentage that arrived."""
    def counts(side: Mapping[str, DataFrame], column: str) -> DataFrame:
        return _stack([
            df.agg(F.lit(n).alias("table_name"), F.count("*").alias(column)) for n, df in side.items()
        ])

    both = counts(source, "source_rows").join(counts(target, "target_rows"), "table_name", "full")
    return both.na.fill(0).withColumn(
        "sync_pct", F.when(F.col("source_rows") > 0, F.col("target_rows") / F.col("source_rows") * 100)
    )


def forecast_profile(forecasts: DataFrame) -> DataFrame:
    """K5: rows, dates, products and units per model."""
    return forecasts.groupBy("model").agg(
        F.count("*").alias("rows"), F.min("forecast_date").alias("first_day"),
        F.max("forecast_date").alias("last_day"), F.countDistinct("ma_hang").alias("products"),
        F.sum("predicted_quantity").alias("total_quantity"),
        F.avg("predicted_quantity").alias("avg_quantity"),
    )


def continuity(df: DataFrame, column: str, sparse: float = 0.5) -> DataFrame:
    """K6: expected and actual days, missing share, history level and sparse days."""
    per_day = df.groupBy(column).agg(F.count("*").alias("n")).withColumn(
        "mean", F.avg("n").over(Window.partitionBy())  # one row per day
    )
    stats = per_day.agg(
        F.min(column).alias("first_day"), F.max(column).alias("last_day"),
        F.count("*").alias("actual_days"), F.avg("n").alias("avg_rows_per_day"),
        F.count_if(F.col("n") < F.col("mean") * sparse).alias("sparse_days"),
    )
    expected = F.datediff("last_day", "first_day") + 1
    missing = expected - F.col("actual_days")
    days = F.col("actual_days")
    return stats.select(
        "first_day", "last_day", expected.cast("bigint").alias("expected_days"), "actual_days",
        missing.cast("bigint").alias("missing_days"),
        (missing / expected * 100).alias("missing_pct"),
        "avg_rows_per_day",
        "sparse_days",
        F.when(days < 14, "too short").when(days < 30, "short").otherwise("enough").alias("history_level"),
        (missing / expected > 0.2).alias("too_many_missing"),
    )


def lag_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K7: rows with a non-zero value per lag column."""
    row = df.agg(
        F.count("*").alias("_all"), *[F.count_if(F.coalesce(F.col(c), F.lit(0.0)) != 0).alias(c) for c in columns]
    )
    pairs = [
        F.struct(
            F.lit(c).alias("feature"), F.col(c).alias("non_zero"),
            F.try_divide(F.col(c) * 100.0, F.col("_all")).alias("coverage_pct"),
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*pairs)))


def with_alert_level(quality: DataFrame) -> DataFrame:
    """K8: level from `cold_start_count, missing_data_pct, zero_predictions, data_age_days`."""
    return quality.withColumn("alert_level", rules.alert_level(
        F.col("cold_start_count"), F.col("missing_data_pct"), F.col("zero_predictions"), F.col("data_age_days")
    ))


def price_coverage(products: DataFrame, details: DataFrame) -> DataFrame:
    """Share of products and of lines with a price."""
    def share(df: DataFrame, price: str, scope: str) -> DataFrame:
        priced = F.coalesce(F.col(price) > 0, F.lit(False))
        return df.agg(
            F.lit(scope).alias("scope"), F.count("*").alias("rows"), F.count_if(priced).alias("priced"),
            F.try_divide(F.count_if(priced) * 100.0, F.count("*")).alias("coverage_pct"),
        )

    return share(products, "gia_ban_mac_dinh", "products").unionByName(share(details, "don_gia", "lines"))


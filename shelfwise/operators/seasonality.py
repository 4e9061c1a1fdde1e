"""Peak windows and seasonal factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import dates
from shelfwise.operators.facts import last_days
from shelfwise.session import day, pinned


def peak_windows(peaks: DataFrame, as_of, days: int = 365) -> DataFrame:
    """H5: each peak's window for every year whose windows can meet the look-back."""
    today = day(as_of)
    first = F.year(F.date_sub(today, days)) - 1
    when = F.make_date("peak_year", "month", "day")
    return (
        peaks.withColumn("peak_year", F.explode(F.sequence(first, F.year(today) + 1)))
        .withColumn("peak_date", when)
        .withColumns({
            "impact_start_date": F.date_sub("peak_date", F.col("impact_days")),
            "impact_end_date": F.date_add("peak_date", F.col("impact_days")),
        })
    )


def peak_dates(windows: DataFrame) -> DataFrame:
    """One row per peak window and day, so the range join becomes an equi join.

    Its size is fixed by the peak table: peaks x years x at most 29 days.
    """
    span = F.sequence("impact_start_date", "impact_end_date")
    return windows.select(
        F.explode(span).alias("transaction_date"),
        "peak_year", "peak_reason", "peak_level", "impact_days", "peak_date",
    )


def sales_in_peaks(facts: DataFrame, windows: DataFrame) -> DataFrame:
    """Fact rows inside peak windows; a row may meet several peaks."""
    return facts.join(peak_dates(windows), "transaction_date")


def per_day(facts: DataFrame, as_of, days: int = 365) -> DataFrame:
    """Sums per day of the look-back: all that means over fact rows need, at most `days` + 1 rows."""
    return last_days(facts, as_of, days).groupBy("transaction_date").agg(
        F.sum("gross_revenue").alias("revenue"), F.sum("quantity_sold").alias("quantity"),
        F.count("*").alias("rows"),
    )


def _means():
    return [
        (F.sum("revenue") / F.sum("rows")).alias("mean_revenue"),
        (F.sum("quantity") / F.sum("rows")).alias("mean_quantity"),
        F.countDistinct("transaction_date").alias("num_days"),
    ]


def seasonal_baseline(daily: DataFrame) -> DataFrame:
    """Mean revenue and quantity of fact rows by month and day type, from `per_day`."""
    d = F.col("transaction_date")
    return (
        daily.groupBy(F.month(d).alias("month"), dates.day_type(d).alias("day_type"))
        .agg(*_means())
        .withColumnsRenamed({"mean_revenue": "avg_daily_revenue", "mean_quantity": "avg_daily_quantity"})
    )


def peak_actuals(daily: DataFrame, windows: DataFrame) -> DataFrame:
    """The same means inside peak windows, with the more frequent day type.

    Day types are counted in fact rows; a tie goes to the name that sorts first.
    """
    inside = sales_in_peaks(daily, windows)
    weekend = F.when(dates.is_weekend(F.col("transaction_date")), F.col("rows")).otherwise(0)
    return (
        inside.groupBy(F.month("transaction_date").alias("month"), "peak_reason", "peak_level", "impact_days")
        .agg(*_means(), F.sum(weekend).alias("weekend_rows"), F.sum("rows").alias("all_rows"))
        .select(
            "month", "peak_reason", "peak_level", "impact_days",
            F.col("mean_revenue").alias("actual_avg_revenue"),
            F.col("mean_quantity").alias("actual_avg_quantity"),
            F.col("num_days").alias("num_peak_days"),
            F.when(F.col("weekend_rows") * 2 > F.col("all_rows"), "weekend")
            .otherwise("weekday").alias("dominant_day_type"),
        )
    )


def _factor(*pairs):
    known = F.lit(True)
    total = F.lit(0.0)
    for actual, base in pairs:
        known = known & (F.col(base) > 0)
        total = total + F.col(actual) / F.nullif(F.col(base), F.lit(0.0))
    return F.when(known, F.bround(total / len(pairs), 2)).otherwise(1.0)


def seasonal_factors(facts: DataFrame, peaks: DataFrame, as_of, days: int = 365) -> DataFrame:
    """Factors of peak means over the baseline of month and day type."""
    daily = pinned(per_day(facts, as_of, days))
    base = seasonal_baseline(daily).drop("num_days")
    actual = peak_actuals(daily, peak_windows(peaks, as_of, days))
    revenue = ("actual_avg_revenue", "avg_daily_revenue")
    quantity = ("actual_avg_quantity", "avg_daily_quantity")
    same = [F.col("month") == F.col("b_month"), F.col("dominant_day_type") == F.col("day_type")]
    return actual.join(base.withColumnRenamed("month", "b_month"), same, "left").select(
        "month", "peak_reason", "peak_level", "impact_days", "actual_avg_revenue",
        F.col("avg_daily_revenue").alias("baseline_revenue"),
        _factor(revenue).alias("revenue_factor"),
        _factor(quantity).alias("quantity_factor"),
        _factor(revenue, quantity).alias("seasonal_factor"),
        "num_peak_days",
        F.col("day_type").alias("baseline_day_type"),
        F.when(F.col("peak_level") > 0, 1).otherwise(0).alias("is_peak_day"),
    )


FACTOR_COLUMNS = (
    "is_peak_day", "peak_reason", "peak_level", "seasonal_factor", "revenue_factor", "quantity_factor"
)


def latest_factors(factors: DataFrame, time: str | None = None) -> DataFrame:
    """One row per month: newest calculation, then highest level, factor and reason."""
    order = ([time] if time else []) + ["peak_level", "seasonal_factor", "peak_reason"]
    row = F.struct(*[F.col(c) for c in FACTOR_COLUMNS])
    best = F.max_by(row, F.struct(*[F.col(c) for c in order]))
    return factors.groupBy("month").agg(best.alias("f")).select("month", "f.*")


def with_seasonal(df: DataFrame, factors: DataFrame, column: str = "ngay") -> DataFrame:
    """H7: month factors attached, 0 and 1.0 where a month has none.

    Reduced to one row for each of the twelve months, so the factors are broadcast.
    """
    defaults = {
        "is_peak_day": 0, "peak_reason": "", "peak_level": 0,
        "seasonal_factor": 1.0, "revenue_factor": 1.0, "quantity_factor": 1.0,
    }
    named = latest_factors(factors.filter(F.col("month").between(1, 12))).withColumnRenamed("month", "_month")
    return (
        df.join(F.broadcast(named), F.month(column) == F.col("_month"), "left")
        .drop("_month")
        .na.fill(defaults)
    )

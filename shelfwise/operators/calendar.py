"""Date spine, date dimension and calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import dates
from shelfwise.session import pinned


def date_spine(bounds: DataFrame, name: str = "date_day") -> DataFrame:
    """Every day from `start` to `end` of a one-row table."""
    return bounds.select(F.explode(F.sequence("start", "end")).alias(name))


def bounds_of(df: DataFrame, column: str) -> DataFrame:
    """First and last day of a date column as `start` and `end`."""
    return df.agg(F.min(column).alias("start"), F.max(column).alias("end"))


def dim_date(spine: DataFrame, column: str = "date_day") -> DataFrame:
    """H1: the date dimension."""
    d = F.col(column)
    names = F.array(*[F.lit(n) for n in dates.DAY_NAMES])
    return spine.select(
        dates.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.concat(F.lit("Năm "), F.year(d)).alias("year_name"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit("-"), F.year(d)).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MM/yyyy").alias("month_name"),
        dates.week_sunday(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dates.iso_dow(d).alias("day_of_week"),
        F.element_at(names, dates.iso_dow(d)).alias("day_name"),
        dates.is_weekend(d).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_first_day_of_month"),
        (d == F.last_day(d)).alias("is_last_day_of_month"),
        F.when(F.month(d) >= 4, F.year(d)).otherwise(F.year(d) - 1).alias("fiscal_year"),
    )


def calendar_columns(d: Column) -> dict[str, Column]:
    """H3, H4: calendar features of a date."""
    return {
        "day_of_week": dates.iso_dow(d),
        "day_of_month": F.dayofmonth(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": dates.is_weekend(d).cast("int"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
        "is_holiday": dates.is_holiday(d).cast("int"),
    }


def with_calendar(df: DataFrame, column: str = "ngay") -> DataFrame:
    """H3: calendar features beside the date."""
    return df.withColumns(calendar_columns(F.col(column)))


def missing_dates(df: DataFrame, column: str) -> DataFrame:
    """Days between the first and last date that have no row."""
    seen = pinned(df.select(F.col(column).alias("missing_date")).distinct())
    spine = date_spine(bounds_of(seen, "missing_date"), "missing_date")
    return spine.join(seen, "missing_date", "left_anti")

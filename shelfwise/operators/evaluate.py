"""Forecast evaluation without a model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.operators.ordered import quantiles
from shelfwise.session import day, pinned


def metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """MdAPE and MAPE over positive actuals, MAE, RMSE and WMAPE, errors as fractions."""
    error = F.col(yhat) - F.col(y)
    pairs = pinned(df.select(
        F.col(y).alias("y"), error.alias("e"), F.when(F.col(y) > 0, F.abs(error) / F.col(y)).alias("ape")
    ))
    middle = quantiles(pairs, "ape", {"m": 0.5}).agg(F.max("m")).scalar()
    return pairs.agg(
        F.avg(F.abs("e")).alias("mae"),
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        F.avg("ape").alias("mape"),
        F.try_divide(F.sum(F.abs("e")), F.sum("y")).alias("wmape"),
        F.count("*").alias("num_records"),
    ).withColumn("mdape", middle)


def matched(forecasts: DataFrame, actual: DataFrame, start=None, end=None) -> DataFrame:
    """C17: forecasts joined to what was sold on the day, within one window for both."""
    sold = actual.select(
        F.col("transaction_date").alias("forecast_date"), F.col("product_code").alias("ma_hang"), "actual_quantity"
    )
    def inside(df: DataFrame) -> DataFrame:
        d = F.col("forecast_date")
        kept = df if start is None else df.filter(d >= day(start))
        return kept if end is None else kept.filter(d <= day(end))

    pairs = inside(forecasts).join(inside(sold), ["forecast_date", "ma_hang"])
    error = F.col("predicted_quantity") - F.col("actual_quantity")
    return pairs.withColumns({
        "error": error, "abs_error": F.abs(error),
        "abs_pct_error": F.abs(F.try_divide(error, F.col("actual_quantity"))),
    })


def accuracy(pairs: DataFrame) -> DataFrame:
    """Error metrics with totals, bias and counts."""
    fixed = pinned(pairs)
    made, sold = F.sum("predicted_quantity"), F.sum("actual_quantity")
    totals = fixed.agg(F.struct(
        made.alias("total_forecast"), sold.alias("total_actual"), (made - sold).alias("overall_bias"),
        F.countDistinct("ma_hang").alias("num_products"),
    )).scalar()
    names = ("total_forecast", "total_actual", "overall_bias", "num_products")
    return metrics(fixed, "actual_quantity", "predicted_quantity").withColumns({n: totals[n] for n in names})


def top_errors(pairs: DataFrame, n: int = 10) -> DataFrame:
    """the largest absolute errors."""
    return pairs.select(
        "forecast_date", "ma_hang", "predicted_quantity", "actual_quantity", "error", "abs_pct_error", "abs_error"
    ).orderBy(F.desc("abs_error"), "forecast_date", "ma_hang").limit(n).drop("abs_error")


def actual_baseline(actual: DataFrame) -> DataFrame:
    """What is known without old forecasts."""
    actual = pinned(actual)
    per_day = actual.groupBy("transaction_date").agg(F.sum("actual_quantity").alias("q"))
    spread = per_day.agg(F.struct(F.avg("q").alias("m"), F.stddev_samp("q").alias("s"))).scalar()
    return actual.agg(
        F.sum("actual_quantity").alias("actual_total_quantity"),
        F.countDistinct("product_code").alias("num_products"),
        F.min("transaction_date").alias("first_day"), F.max("transaction_date").alias("last_day"),
    ).withColumns({"actual_avg_daily": spread["m"], "actual_std_daily": spread["s"]})


def top_actual_products(actual: DataFrame, n: int = 10) -> DataFrame:
    """the best selling products."""
    return actual.groupBy("product_code").agg(F.sum("actual_quantity").alias("actual_quantity")).orderBy(
        F.desc("actual_quantity"), "product_code"
    ).limit(n)


def top_forecasts(forecasts: DataFrame, n: int = 5) -> DataFrame:
    """products with the largest forecast."""
    return forecasts.groupBy("ma_hang").agg(
        F.round(F.sum("predicted_quantity"), 6).alias("total_quantity")
    ).orderBy(F.desc("total_quantity"), "ma_hang").limit(n)


def compare_models(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Both forecasts per category over the union of categories, missing ones 0.

    Without a product-level forecast the difference is unknown and counts as significant,
    unless both are 0.
    """
    a = products.groupBy("nhom_hang_cap_1").agg(
        F.sum("predicted_quantity").alias("model1_quantity"), F.countDistinct("ma_hang").alias("num_products")
    )
    b = categories.groupBy("nhom_hang_cap_1").agg(F.sum("predicted_quantity").alias("model2_quantity"))
    both = a.join(b, "nhom_hang_cap_1", "full").na.fill(0)
    one, two = F.col("model1_quantity"), F.col("model2_quantity")
    diff = F.when(one > 0, (two - one) / one * 100).when(two == 0, 0.0)
    return both.withColumn("difference_pct", diff).withColumn(
        "status",
        rules.at_most(F.abs("difference_pct"), [(10, "Consistent"), (25, "Warning")], "Significant"),
    )


def comparison_summary(comparison: DataFrame) -> DataFrame:
    """Totals, deviation, consistency score and what to do."""
    one, two = F.sum("model1_quantity"), F.sum("model2_quantity")
    score = F.try_divide(F.count_if(F.col("status") == "Consistent") * 100.0, F.count("*"))
    return comparison.agg(
        one.alias("total_model1"), two.alias("total_model2"),
        (F.abs(two - one) / F.nullif(one, F.lit(0.0)) * 100).alias("overall_deviation_pct"),
        score.alias("consistency_score"),
    ).withColumn("recommendation", rules.bands(F.col("consistency_score"), [
        (80, "High consistency"), (60, "Moderate consistency - review significant differences"),
    ], "Low consistency - investigate data quality"))


def fold_bounds(df: DataFrame, n: int = 5, column: str = "ngay") -> DataFrame:
    """M8: expanding folds by date: train up to a day, test on the days after it.

    One row per fold. A history with fewer than `n` + 1 days cannot hold `n` folds, which is
    an error when the result is read.
    """
    days = df.groupBy(column).agg(F.count("*").alias("n"))
    placed = Window.orderBy(column)  # one row per day
    numbered = days.select(
        column, "n", F.row_number().over(placed).alias("i"), F.count("*").over(Window.partitionBy()).alias("total"),
    )
    enough = F.col("total") > n
    folds = F.when(enough, F.lit(n).cast("bigint")).otherwise(
        F.raise_error(F.format_string("%d days cannot hold %d folds", "total", F.lit(n))).cast("bigint"))
    size = F.floor(F.col("total") / (n + 1))
    split = numbered.withColumns({"folds": folds, "size": size}).withColumn(
        "fold", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("folds")))
    )
    train_to = F.col("total") - (F.col("folds") - F.col("fold") + 1) * F.col("size")
    part = split.withColumn("train_to", train_to)
    train = F.col("i") <= F.col("train_to")
    test = (F.col("i") > F.col("train_to")) & (F.col("i") <= F.col("train_to") + F.col("size"))
    d = F.col(column)
    return part.groupBy("fold").agg(
        F.min(F.when(train, d)).alias("train_start"), F.max(F.when(train, d)).alias("train_end"),
        F.min(F.when(test, d)).alias("test_start"), F.max(F.when(test, d)).alias("test_end"),
        F.sum(F.when(train, F.col("n")).otherwise(0)).alias("train_rows"),
        F.sum(F.when(test, F.col("n")).otherwise(0)).alias("test_rows"),
    )


def time_folds(df: DataFrame, n: int = 5, column: str = "ngay") -> list[tuple[DataFrame, DataFrame]]:
    """M8: the train and test part of each fold. Only the few fold dates reach the driver."""
    bounds = fold_bounds(df, n, column).orderBy("fold").collect()
    d = F.col(column)
    return [
        (df.filter(d <= F.lit(b.train_end)), df.filter((d >= F.lit(b.test_start)) & (d <= F.lit(b.test_end))))
        for b in bounds
    ]


def holdout_day(df: DataFrame, share: float = 0.8, column: str = "ngay") -> dt.date:
    """M8: last training day of an 80/20 split over days."""
    days = df.select(column).distinct()
    placed = days.select(column, F.percent_rank().over(Window.orderBy(column)).alias("p"))  # one row per day
    return placed.filter(F.col("p") <= share).agg(F.max(column)).first()[0]


def should_retrain(df: DataFrame, last, n: int = 7, column: str = "ngay") -> DataFrame:
    """Newest data day against the last training day; never trained means retrain."""
    trained = F.lit(None).cast("date") if last is None else day(last)
    age = F.datediff("newest_day", "last_trained")
    return df.agg(F.max(column).alias("newest_day")).withColumn("last_trained", trained).withColumns({
        "new_days": age, "retrain": F.coalesce(age >= n, F.lit(True)),
    })


def horizon(series: DataFrame, as_of, days: int = 14) -> DataFrame:
    """Each series repeated for the next `days` dates."""
    start = day(as_of)
    dates = F.sequence(F.date_add(start, 1), F.date_add(start, days))
    return series.select("*", F.explode(dates).alias("forecast_date"))


def cold_reason(days_sold: Column, lowest: Column, highest: Column, first_day: Column, last_day: Column) -> Column:
    """Why a series gets no model: uniform, sparse or short; null for the others.

    One value only shows as an equal minimum and maximum.
    """
    density = days_sold / (F.datediff(last_day, first_day) + 1)
    return (
        F.when((days_sold < 7) & (lowest == highest), "uniform")
        .when((days_sold >= 2) & (density < 0.05) & (days_sold < 10), "sparse")
        .when(days_sold < 2, "short")
    )


def cold_start(history: DataFrame, keys: Sequence[str] = ("chi_nhanh", "ma_hang")) -> DataFrame:
    """Series too short, uniform or sparse for a model, with the reason."""
    per = history.groupBy(*keys).agg(
        F.count("*").alias("days_sold"), F.min("daily_quantity").alias("lo"), F.max("daily_quantity").alias("hi"),
        F.min("ngay").alias("first_day"), F.max("ngay").alias("last_day"),
        F.min("nhom_hang_cap_1").alias("nhom_hang_cap_1"),
    )
    n = F.col("days_sold")
    density = n / (F.datediff("last_day", "first_day") + 1)
    reason = cold_reason(n, F.col("lo"), F.col("hi"), F.col("first_day"), F.col("last_day"))
    return per.withColumns({"density": density, "reason": reason}).withColumn(
        "is_cold_start", F.col("reason").isNotNull()
    ).drop("lo", "hi")


def cold_start_forecast(
    cold: DataFrame, medians: DataFrame, factors: DataFrame, as_of, days: int = 14,
    default: float = 10.0, uniform_cap: float = 50.0,
) -> DataFrame:
    """Category median (capped for uniform series) times the month factor.

    `medians` has a row per category. Factors are reduced to twelve months and broadcast.
    """
    base = F.coalesce("median", F.lit(default))
    level = F.when(F.col("reason") == "uniform", F.least(base, F.lit(uniform_cap))).otherwise(base)
    known = cold.filter("is_cold_start").join(
        medians.select("nhom_hang_cap_1", "median"), "nhom_hang_cap_1", "left"
    ).withColumn("level", level)
    month = factors.filter(F.col("month").between(1, 12)).groupBy(F.col("month").alias("_month")).agg(
        F.max("seasonal_factor").alias("_factor")
    )
    ahead = horizon(known, as_of, days).join(
        F.broadcast(month), F.month("forecast_date") == F.col("_month"), "left"
    )
    raw = F.greatest(F.lit(0.0), F.col("level") * F.coalesce("_factor", F.lit(1.0)))
    return ahead.withColumn("predicted_quantity_raw", raw).withColumns({
        "predicted_quantity": rules.whole(F.col("predicted_quantity_raw")),
        "confidence_lower": F.col("predicted_quantity_raw") * 0.5,
        "confidence_upper": F.col("predicted_quantity_raw") * 1.5,
    }).drop("_month", "_factor", "level", "median")


def forecast_quality(forecasts: DataFrame, newest, as_of) -> DataFrame:
    """Cold starts, their share of products, zero predictions and data age."""
    cold = F.countDistinct(F.when(F.col("is_cold_start"), F.col("ma_hang")))
    return forecasts.agg(
        cold.alias("cold_start_count"), F.count_if(F.col("predicted_quantity") == 0).alias("zero_predictions"),
        F.countDistinct("ma_hang").alias("total_products"),
    ).select(
        "cold_start_count", (F.col("cold_start_count") > 0).alias("fallback_used"),
        F.coalesce(F.try_divide(F.col("cold_start_count") * 100.0, F.col("total_products")), F.lit(0.0))
        .alias("missing_data_pct"),
        "zero_predictions", "total_products",
        F.datediff(day(as_of), day(newest)).alias("data_age_days"),
    )


def blend(a: DataFrame, b: DataFrame, keys: Sequence[str], weight: float = 0.7) -> DataFrame:
    """Weighted mean of two forecasts of equal keys."""
    other = b.select(*keys, F.col("predicted_quantity").alias("_other"))
    mixed = F.col("predicted_quantity") * weight + F.col("_other") * (1 - weight)
    return a.join(other, list(keys)).withColumn("predicted_quantity", mixed).drop("_other")


def asymmetric_loss(y: Column, yhat: Column, penalty: float = 2.0) -> Column:
    """Squared error, weighted where the forecast falls short."""
    error = yhat - y
    return error * error * F.when(error < 0, penalty).otherwise(1.0)

"""Time-series features (D18-D20, E9-E12, F7, K6 helpers, M1-M5).

A series has at most one row per day, so a window per series is bounded by the calendar.
All windows of one call share the partitioning and order, hence one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.text import PROMO_PATTERNS, is_promo
from shelfwise.operators.calendar import with_calendar
from shelfwise.operators.clean import fill_dims
from shelfwise.operators.facts import daily_base, sales_lines, valid_sales
from shelfwise.operators.ordered import quantiles
from shelfwise.operators.seasonality import with_seasonal
from shelfwise.session import pinned

SERIES = ("chi_nhanh", "ma_hang")
LAGS = (1, 3, 7, 14, 21, 30)
WINDOWS = (7, 14, 30)

# Factors used when no seasonal table is at hand.
NO_SEASON = {
    "is_peak_day": 0, "peak_level": 0, "seasonal_factor": 1.0, "revenue_factor": 1.0, "quantity_factor": 1.0,
}


def training_history(
    sales: DataFrame, products: DataFrame, abc: DataFrame | None = None,
    factors: DataFrame | None = None, patterns: Sequence[str] | None = None, positive: bool = True,
) -> DataFrame:
    """Daily sales with product attributes and seasonal factors.

    `sales` are regular sales; with daily sales instead, give the promotional `patterns` to
    leave out. Without `factors` the neutral ones apply.
    """
    attributes = products.select(
        F.col("ma_hang").alias("product_code"), F.col("ten_hang").alias("ten_san_pham"),
        F.col("cap_1").alias("nhom_hang_cap_1"), F.col("cap_2").alias("nhom_hang_cap_2"), "thuong_hieu",
    )
    joined = sales.join(attributes, "product_code", "left")
    if patterns is not None:
        joined = joined.filter(~is_promo(F.col("nhom_hang_cap_1"), patterns))
    if abc is None:
        classed = joined.withColumn("abc_class", F.lit(None).cast("string"))
    else:
        classed = joined.join(abc.select("product_code", "abc_class"), "product_code", "left")
    history = fill_dims(classed).select(
        F.col("transaction_date").alias("ngay"), F.col("branch_code").alias("chi_nhanh"),
        F.col("product_code").alias("ma_hang"), "ten_san_pham",
        "nhom_hang_cap_1", "nhom_hang_cap_2", "thuong_hieu", "abc_class",
        F.col("quantity_sold").alias("daily_quantity"), F.col("gross_revenue").alias("daily_revenue"),
        F.col("gross_profit").alias("daily_profit"), "transaction_count",
    )
    kept = valid_sales(history, "daily_quantity", "daily_revenue", positive)
    if factors is None:
        return kept.withColumns({n: F.lit(v) for n, v in NO_SEASON.items()})
    return with_seasonal(kept, factors)


def category_sales(
    transactions: DataFrame, details: DataFrame, products: DataFrame, branches: DataFrame,
    patterns: Sequence[str] = PROMO_PATTERNS,
) -> DataFrame:
    """Units and revenue per date, branch and category, the sums of `training_history` of regular sales.

    Category and promotion come by one join, in which a product has a row for each pair of its
    catalog rows, as two joins would give. Rows are summed before they meet branches, so those
    meet days x branches x categories at most.
    """
    base = valid_sales(daily_base(sales_lines(transactions, details)), "quantity_sold", "gross_revenue")
    named = products.select(F.col("ma_hang").alias("product_code"), F.col("cap_1").alias("nhom_hang_cap_1"))
    pairs = products.select(F.col("ma_hang").alias("product_code"), "cap_1").join(named, "product_code")
    sold = base.join(pairs, "product_code", "left").filter(~is_promo(F.col("cap_1"), patterns))
    summed = fill_dims(sold).groupBy(
        F.col("transaction_date").alias("ngay"), F.col("branch_code").alias("chi_nhanh"), "nhom_hang_cap_1",
    ).agg(F.sum("quantity_sold").alias("daily_quantity"), F.sum("gross_revenue").alias("daily_revenue"))
    return summed.join(branches.select(F.col("ma_chi_nhanh").alias("chi_nhanh")), "chi_nhanh", "left")


def winsorize(df: DataFrame, column: str, p: float = 0.99) -> tuple[DataFrame, DataFrame]:
    """M2: values above the p-quantile become it; also a one-row table of what changed.

    `df` is read twice, so pass a written or pinned table rather than a long plan.
    """
    cap = pinned(quantiles(df, column, {"cap": p}))
    cap_value = cap.agg(F.max("cap")).scalar()
    capped = df.withColumn(column, F.least(F.col(column), cap_value))
    x = F.col(column)
    stats = df.agg(
        F.lit(column).alias("column_name"), F.max(cap_value).alias("cap_value"),
        F.max(x).alias("original_max"), F.avg(x).alias("original_mean"),
        F.avg(F.least(x, cap_value)).alias("new_mean"),
        F.count_if(x > cap_value).alias("outliers_count"),
        F.count("*").alias("total_records"),
    )
    return capped, stats


def dynamic_percentiles(df: DataFrame, columns: Sequence[str], points: Sequence[float] = (0.95, 0.99)) -> DataFrame:
    """Percentiles, mean, deviation and maximum per column; nulls for a column without values.

    The columns are melted to (column, value, count), so that all are ordered in one pass.
    """
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns]
    counts = pinned(
        df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*").filter(F.col("v").isNotNull())
        .groupBy("column_name", "v").agg(F.count("*").alias("n")))
    v, n = F.col("v"), F.col("n")
    means = counts.groupBy("column_name").agg((F.sum(v * n) / F.sum(n)).alias("mean"))
    moments = counts.join(means, "column_name").groupBy("column_name").agg(
        F.first("mean").alias("mean"),
        F.sqrt(F.try_divide(F.sum(n * F.pow(v - F.col("mean"), 2.0)), F.sum(n) - 1)).alias("std"), F.max(v).alias("max"))
    found = quantiles(counts, "v", {f"p{round(p * 100)}": p for p in points}, ["column_name"], weight="n")
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(found, "column_name", "left").join(moments, "column_name", "left")


def category_series(df: DataFrame, keys: Sequence[str] = ("nhom_hang_cap_1",)) -> DataFrame:
    """Daily totals per category with mean factors and the peak flag."""
    return df.groupBy("ngay", *keys).agg(
        F.sum("daily_quantity").alias("daily_quantity"), F.sum("daily_revenue").alias("daily_revenue"),
        F.avg("seasonal_factor").alias("seasonal_factor"), F.avg("revenue_factor").alias("revenue_factor"),
        F.avg("quantity_factor").alias("quantity_factor"), F.max("is_peak_day").alias("is_peak_day"),
    )


def category_days(sold: DataFrame, keys: Sequence[str], factors: DataFrame | None = None) -> DataFrame:
    """D18 from `category_sales`: a day has one month and so one factor, which is attached to the sums."""
    summed = sold.groupBy("ngay", *keys).agg(
        F.sum("daily_quantity").alias("daily_quantity"), F.sum("daily_revenue").alias("daily_revenue"))
    if factors is None:
        named = summed.withColumns({n: F.lit(v) for n, v in NO_SEASON.items()})
    else:
        named = with_seasonal(summed, factors)
    return named.select(
        "ngay", *keys, "daily_quantity", "daily_revenue", "seasonal_factor", "revenue_factor", "quantity_factor", "is_peak_day")


def category_stats(df: DataFrame, key: str = "nhom_hang_cap_1", value: str = "daily_quantity") -> DataFrame:
    """Mean, median and deviation of daily quantity per category."""
    counts = pinned(
        df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    )
    v, n = F.col(value), F.col("n")
    means = counts.groupBy(key).agg((F.sum(v * n) / F.sum(n)).alias("mean"))
    spread = counts.join(means, key).groupBy(key).agg(
        F.first("mean").alias("mean"),
        F.sqrt(F.try_divide(F.sum(n * F.pow(v - F.col("mean"), 2.0)), F.sum(n) - 1)).alias("std"),
    )
    return quantiles(counts, value, {"median": 0.5}, [key], weight="n").join(spread, key)


def dense_series(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Every day between a series' first and last, `values` 0 where it has no row."""
    days = df.groupBy(*keys).agg(F.explode(F.sequence(F.min("ngay"), F.max("ngay"))).alias("ngay"))
    return days.join(df, [*keys, "ngay"], "left").na.fill(0.0, list(values))


def _ordered(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("ngay")


def with_lags(
    df: DataFrame, keys: Sequence[str], lags: Sequence[int] = LAGS, names: Sequence[str] = ("quantity", "revenue")
) -> DataFrame:
    """Values some rows back; 0 before the start."""
    w = _ordered(keys)
    return df.withColumns({
        f"lag_{k}_{n}": F.coalesce(F.lag(f"daily_{n}", k).over(w), F.lit(0.0)) for k in lags for n in names
    })


def _frame(keys: Sequence[str], rows: int, leak: bool):
    """The last `rows` rows with the current one, or before it when `leak` is off."""
    return _ordered(keys).rowsBetween(-rows + 1, 0) if leak else _ordered(keys).rowsBetween(-rows, -1)


def with_rolling(
    df: DataFrame, keys: Sequence[str], windows: Sequence[int] = WINDOWS, leak: bool = True,
    stats: Sequence[str] = ("mean", "std", "min", "max", "range"),
) -> DataFrame:
    """Rolling statistics of quantity over rows; the deviation of one row is 0."""
    q = F.col("daily_quantity")
    columns: dict[str, Column] = {}
    for n in windows:
        w = _frame(keys, n, leak)
        made = {
            "mean": F.avg(q).over(w), "std": F.stddev_samp(q).over(w), "min": F.min(q).over(w),
            "max": F.max(q).over(w), "range": F.max(q).over(w) - F.min(q).over(w),
        }
        columns |= {f"rolling_{s}_{n}_quantity": F.coalesce(made[s], F.lit(0.0)) for s in stats}
    return df.withColumns(columns)


def alpha(span: int) -> float:
    return 2.0 / (span + 1)


def ema_of(values: Column, span: int) -> Column:
    """Exponential mean of an array, oldest first, started at its first value."""
    a = alpha(span)
    return F.aggregate(
        F.slice(values, 2, F.size(values)), F.get(values, F.lit(0)), lambda acc, v: acc * (1 - a) + v * a
    )


#: Values that are averaged one after the other before the running list is cut.
BLOCK = 64


def running_ema(values: Column, span: int) -> Column:
    """Exponential means of an array up to each of its values; nulls leave the mean as it is.

    Appending to a list copies it, so one list over all values would cost the square of
    their number. Here blocks of values are first reduced to what they do to a mean that
    comes in (a factor and a summand); a short fold over blocks gives the mean before each,
    and the lists are only as long as a block.
    """
    a = alpha(span)

    def after(before: Column, v: Column) -> Column:
        return F.coalesce(before * (1 - a) + v * a, before, v)

    def effect(block: Column) -> Column:
        line = F.aggregate(
            block, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("q")),
            lambda s, v: F.when(v.isNull(), s).otherwise(
                F.struct((s["p"] * (1 - a)).alias("p"), (s["q"] * (1 - a) + v * a).alias("q"))))
        return F.struct(F.aggregate(block, none, after).alias("fresh"), line["p"].alias("p"), line["q"].alias("q"))

    def onward(means: Column, block: Column) -> Column:
        before = F.element_at(means, -1)
        return F.concat(means, F.array(F.coalesce(before * block["p"] + block["q"], block["fresh"])))

    def run(block: Column, before: Column) -> Column:
        longer = F.aggregate(
            block, F.array(before), lambda acc, v: F.concat(acc, F.array(after(F.element_at(acc, -1), v))))
        return F.slice(longer, 2, BLOCK)

    none = F.lit(None).cast("double")
    count = F.greatest(F.ceil(F.size(values) / BLOCK), F.lit(1)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK)))
    means = F.aggregate(F.transform(blocks, effect), F.array(none), onward)
    whole = F.flatten(F.zip_with(blocks, F.slice(means, F.lit(1), count), run))
    # One block needs no fold over blocks; most series of products are that short.
    return F.when(F.size(values) <= BLOCK, run(values, none)).otherwise(whole)


def with_ema(df: DataFrame, keys: Sequence[str], spans: Sequence[int] = WINDOWS, leak: bool = True) -> DataFrame:
    """Exponential moving average per span, over all earlier rows of the series.

    One ordered array per series, averaged for each span and exploded again; the days bound
    its length, and the work grows with it in proportion.
    """
    others = [c for c in df.columns if c not in (*keys, "ngay")]
    rows = F.array_sort(F.collect_list(F.struct("ngay", *others)))
    one = df.groupBy(*keys).agg(rows.alias("_rows"))
    values = F.transform("_rows", lambda r: r["daily_quantity"].cast("double"))
    means = {f"ema_{n}_quantity": running_ema(values, n) for n in spans}
    folded = one.select(*keys, "_rows", *[m.alias(n) for n, m in means.items()])
    first = F.array(F.lit(0.0))
    shown = {n: F.col(n) if leak else F.concat(first, F.slice(n, 1, F.size(n) - 1)) for n in means}
    rows = folded.withColumns(shown).select(*keys, F.explode(F.arrays_zip("_rows", *means)).alias("_z"))
    return rows.select(*keys, "_z._rows.*", *[F.coalesce(f"_z.{n}", F.lit(0.0)).alias(n) for n in means]).select(
        *df.columns, *means)


def _change(now: Column, before: Column) -> Column:
    """Relative change; 0 without or from zero."""
    return F.coalesce(F.try_divide(now - before, before), F.lit(0.0))


def with_growth(df: DataFrame, keys: Sequence[str], leak: bool = True) -> DataFrame:
    """Mean price, its change and the change of quantity."""
    w = _ordered(keys)
    price = F.col("daily_revenue") / (F.col("daily_quantity") + 1e-8)
    priced = df.withColumn("avg_price", price)
    late = 0 if leak else 1

    def at(name: str, back: int) -> Column:
        return F.lag(name, back).over(w) if back else F.col(name)

    changed = priced.withColumns({
        "price_change": _change(at("avg_price", late), at("avg_price", late + 1)),
        "quantity_growth": _change(at("daily_quantity", late), at("daily_quantity", late + 1)),
    })
    if leak:
        return changed
    return changed.withColumn("avg_price", F.coalesce(F.lag("avg_price", 1).over(w), F.lit(0.0)))


#: Labels of an encoded column, all of which the driver holds.
MOST_LABELS = 100_000


def encode(df: DataFrame, columns: Sequence[str]) -> StringIndexerModel:
    """M4: codes in alphabetical order, to be fitted once, saved and used in both modes.

    The labels go to the driver: branches, categories and brands, not products. More than
    `MOST_LABELS` in a column is an error.
    """
    for c in columns:
        if df.select(c).distinct().limit(MOST_LABELS + 1).count() > MOST_LABELS:
            raise ValueError(f"{c} has more than {MOST_LABELS} labels")
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_encoded" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    ).fit(df)


def make_features(
    df: DataFrame, keys: Sequence[str] = SERIES, mode: str = "train", lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS, spans: Sequence[int] = WINDOWS, encoder: StringIndexerModel | None = None,
) -> DataFrame:
    """M3: calendar, lags, rolling statistics, averages, growth, price and codes.

    `parity` lets the current row into its own statistics, as the original columns do;
    `train` uses earlier rows only.
    """
    leak = mode == "parity"
    steps = with_lags(with_calendar(df), keys, lags)
    steps = with_growth(with_ema(with_rolling(steps, keys, windows, leak), keys, spans, leak), keys, leak)
    if encoder is not None:
        codes = encoder.getOutputCols()
        steps = encoder.transform(steps).withColumns({c: F.col(c).cast("int") for c in codes})
    doubles = [c for c, t in steps.dtypes if t == "double"]
    return steps.withColumns({c: F.when(F.isnan(c), 0.0).otherwise(F.col(c)) for c in doubles}).na.fill(0.0, doubles)


# Columns that are keys, targets or text, never features.
NOT_FEATURES = (
    "ngay", "chi_nhanh", "ma_hang", "ten_san_pham", "nhom_hang_cap_1", "nhom_hang_cap_2", "thuong_hieu",
    "abc_class", "peak_reason", "daily_quantity", "daily_revenue", "daily_profit", "transaction_count", "city",
)


def feature_columns(df: DataFrame, without: Sequence[str] = NOT_FEATURES) -> list[str]:
    """M5: numeric columns that are not excluded."""
    return [c for c, t in df.dtypes if c not in without and t in ("int", "bigint", "double")]

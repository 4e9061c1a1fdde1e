"""Queries over features, evaluation, models and forecasts."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.operators import evaluate, facts, features, forecast, inventory, quality, seasonality
from shelfwise.plans.query import PROMO, query
from shelfwise.sources import files
from shelfwise.plans.stock import LATEST, ORDERS, PEAKS, Orders, regular, seasonal_factors_of
from shelfwise.session import pinned, scratch_path, shared_dir

SERIES = ("city", "nhom_hang_cap_1")


def history(s, factors: DataFrame | None = None, days: int = 0) -> DataFrame:
    return features.training_history(regular(s, days), s.products, factors=factors)


def category_sales(s) -> DataFrame:
    """Daily quantity and revenue per branch and category."""
    return features.category_sales(s.transactions, s.details, s.products, s.branches, PROMO)


def series(s, factors: DataFrame | None = None, sold: DataFrame | None = None) -> DataFrame:
    """Daily quantity and revenue per region and category: dense enough for lags."""
    city = s.branches.select(F.col("ma_chi_nhanh").alias("chi_nhanh"), "city")
    named = (category_sales(s) if sold is None else sold).join(city, "chi_nhanh")
    made = features.category_days(named, SERIES, factors)
    return made.withColumn("daily_revenue", F.round("daily_revenue", 2))


_SERIES = """series AS (
      SELECT transaction_date AS ngay, city, cap_1 AS nhom_hang_cap_1, sum(quantity_sold) AS daily_quantity,
             round(sum(gross_revenue), 2) AS daily_revenue
      FROM regular JOIN branches ON branch_code = ma_chi_nhanh
      WHERE quantity_sold > 0 AND gross_revenue > 0 GROUP BY 1, 2, 3)"""
_W = "PARTITION BY city, nhom_hang_cap_1 ORDER BY ngay"
_BASE = "ngay, city, nhom_hang_cap_1, daily_quantity"


@query(
    "M1_training_history", "M1 B20 B22 H7 C2",
    f"""{PEAKS}, {LATEST}, answer AS (
      SELECT transaction_date AS ngay, branch_code AS chi_nhanh, product_code AS ma_hang, cap_1 AS nhom_hang_cap_1,
             cap_2 AS nhom_hang_cap_2, brand AS thuong_hieu, 'C' AS abc_class, quantity_sold AS daily_quantity,
             gross_revenue AS daily_revenue, gross_revenue - cost AS daily_profit, line_count AS transaction_count,
             coalesce(is_peak_day, 0) AS is_peak_day, coalesce(seasonal_factor, 1) AS seasonal_factor,
             coalesce(revenue_factor, 1) AS revenue_factor, coalesce(quantity_factor, 1) AS quantity_factor
      FROM regular LEFT JOIN latest ON month(transaction_date) = month WHERE quantity_sold > 0 AND gross_revenue > 0)""",
    two="daily_revenue daily_profit",
)
def training_history(s):
    latest = seasonality.latest_factors(seasonal_factors_of(s))
    return history(s, latest).drop("ten_san_pham", "peak_reason", "peak_level")


@query(
    "M1_history_from_daily", "M1 B19",
    """answer AS (
      SELECT transaction_date AS ngay, branch_code AS chi_nhanh, product_code AS ma_hang, cap_1 AS nhom_hang_cap_1,
             quantity_sold AS daily_quantity, CAST(1 AS DOUBLE) AS seasonal_factor, 0 AS is_peak_day FROM regular)""",
)
def history_from_daily(s):
    """The fallback: all daily sales less promotions, neutral factors."""
    daily = facts.daily_sales(s.transactions, s.details, s.products, s.branches)
    made = features.training_history(daily, s.products, patterns=("%promo%",))
    return made.select(
        "ngay", "chi_nhanh", "ma_hang", "nhom_hang_cap_1", "daily_quantity", "seasonal_factor", "is_peak_day"
    )


@query(
    "D18_category_series", "D18",
    f"""{PEAKS}, {LATEST}, answer AS (
      SELECT transaction_date AS ngay, cap_1 AS nhom_hang_cap_1, sum(quantity_sold) AS daily_quantity,
             sum(gross_revenue) AS daily_revenue, avg(coalesce(seasonal_factor, 1)) AS seasonal_factor,
             avg(coalesce(revenue_factor, 1)) AS revenue_factor, avg(coalesce(quantity_factor, 1)) AS quantity_factor,
             max(coalesce(is_peak_day, 0)) AS is_peak_day
      FROM regular LEFT JOIN latest ON month(transaction_date) = month GROUP BY 1, 2)""",
    two="daily_revenue", four="seasonal_factor revenue_factor quantity_factor",
)
def category_series(s):
    return features.category_series(history(s, seasonality.latest_factors(seasonal_factors_of(s))))


@query(
    "D19_category_stats", "D19",
    """answer AS (
      SELECT cap_1 AS nhom_hang_cap_1, avg(quantity_sold) AS mean, median(quantity_sold) AS median,
             stddev_samp(quantity_sold) AS std FROM regular GROUP BY 1)""",
    four="mean std",
)
def category_stats(s):
    return features.category_stats(history(s))


@query(
    "D20_dynamic_percentiles", "D20",
    """answer AS (
      SELECT 'quantity_sold' AS column_name, quantile_cont(quantity_sold, 0.95) AS p95, quantile_cont(quantity_sold, 0.99) AS p99,
             avg(quantity_sold) AS mean, stddev_samp(quantity_sold) AS std, max(quantity_sold) AS max FROM daily
      UNION ALL
      SELECT 'transaction_count', quantile_cont(line_count, 0.95), quantile_cont(line_count, 0.99), avg(line_count),
             stddev_samp(line_count), max(line_count) FROM daily)""",
    four="p95 p99 mean std",
)
def dynamic_percentiles(s):
    base = facts.daily_base(facts.sales_lines(s.transactions, s.details)).withColumnRenamed(
        "line_count", "transaction_count"
    )
    return features.dynamic_percentiles(base, ["quantity_sold", "transaction_count"])


@query(
    "E9_lags", "E9 F7",
    f"""{_SERIES}, answer AS (
      SELECT {_BASE}, {', '.join(
          f"coalesce(lag(daily_{c}, {k}) OVER w, 0) AS lag_{k}_{c}"
          for k in (1, 3, 7, 14, 21, 30) for c in ('quantity', 'revenue'))}
      FROM series WINDOW w AS ({_W}))""",
)
def lags(s):
    made = features.with_lags(series(s), SERIES)
    return made.drop("daily_revenue", "seasonal_factor", "revenue_factor", "quantity_factor", "is_peak_day")


_ROLLING = ", ".join(
    f"{fn}(daily_quantity) OVER w{n} AS rolling_{name}_{n}_quantity"
    for n in (7, 14, 30) for name, fn in (("mean", "avg"), ("min", "min"), ("max", "max"))
) + ", " + ", ".join(
    f"coalesce(stddev_samp(daily_quantity) OVER w{n}, 0) AS rolling_std_{n}_quantity, "
    f"max(daily_quantity) OVER w{n} - min(daily_quantity) OVER w{n} AS rolling_range_{n}_quantity"
    for n in (7, 14, 30)
)


@query(
    "E10_rolling", "E10",
    f"""{_SERIES}, answer AS (
      SELECT {_BASE}, {_ROLLING} FROM series
      WINDOW {', '.join(f"w{n} AS ({_W} ROWS {n - 1} PRECEDING)" for n in (7, 14, 30))})""",
    four=" ".join(f"rolling_{x}_{n}_quantity" for n in (7, 14, 30) for x in ("mean", "std")),
)
def rolling(s):
    made = features.with_rolling(series(s), SERIES)
    return made.drop("daily_revenue", "seasonal_factor", "revenue_factor", "quantity_factor", "is_peak_day")


def _ema_sql(span: int, frame: str) -> str:
    a = repr(2 / (span + 1))
    return (
        f"coalesce(list_reduce(list(daily_quantity) OVER ({_W} {frame}), "
        f"lambda x, y: x * (1 - CAST({a} AS DOUBLE)) + y * CAST({a} AS DOUBLE)), 0) AS ema_{span}_quantity"
    )


@query(
    "E11_ema", "E11",
    f"""{_SERIES}, answer AS (
      SELECT {_BASE}, {', '.join(_ema_sql(n, 'ROWS UNBOUNDED PRECEDING') for n in (7, 14, 30))} FROM series)""",
    four="ema_7_quantity ema_14_quantity ema_30_quantity",
)
def ema(s):
    return features.with_ema(series(s), SERIES).select(
        "ngay", *SERIES, "daily_quantity", *[f"ema_{n}_quantity" for n in (7, 14, 30)]
    )


@query(
    "E12_growth", "E12",
    f"""{_SERIES}, priced AS (SELECT *, daily_revenue / (daily_quantity + 1e-8::DOUBLE) AS avg_price FROM series),
    answer AS (
      SELECT {_BASE}, avg_price,
             coalesce((avg_price - lag(avg_price) OVER w) / nullif(lag(avg_price) OVER w, 0), 0) AS price_change,
             coalesce((daily_quantity - lag(daily_quantity) OVER w) / nullif(lag(daily_quantity) OVER w, 0), 0) AS quantity_growth
      FROM priced WINDOW w AS ({_W}))""",
    four="avg_price price_change quantity_growth",
)
def growth(s):
    return features.with_growth(series(s), SERIES).select(
        "ngay", *SERIES, "daily_quantity", "avg_price", "price_change", "quantity_growth"
    )


def _m3_sql() -> str:
    """Every lag, window and span of the training features, from earlier rows only."""
    lags = [f"coalesce(lag({v}, {k}) OVER w, 0) AS lag_{k}_{n}"
            for k in features.LAGS for n, v in (("quantity", "daily_quantity"), ("revenue", "daily_revenue"))]
    made = {"mean": "avg({q})", "std": "stddev_samp({q})", "min": "min({q})", "max": "max({q})"}
    rolling = [f"coalesce({f.format(q='daily_quantity')} OVER p{n}, 0) AS rolling_{stat}_{n}_quantity"
               for n in features.WINDOWS for stat, f in made.items()]
    rolling += [f"coalesce(max(daily_quantity) OVER p{n} - min(daily_quantity) OVER p{n}, 0) AS rolling_range_{n}_quantity"
                for n in features.WINDOWS]
    means = [_ema_sql(n, "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING") for n in features.WINDOWS]
    frames = ", ".join(f"p{n} AS ({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in features.WINDOWS)
    return f"""{_SERIES}, priced AS (SELECT *, daily_revenue / (daily_quantity + 1e-8::DOUBLE) AS price FROM series),
    answer AS (
      SELECT {_BASE}, CAST(isodow(ngay) AS INTEGER) AS day_of_week, {', '.join(lags + rolling + means)},
             coalesce(lag(price) OVER w, 0) AS avg_price,
             coalesce((lag(price) OVER w - lag(price, 2) OVER w) / nullif(lag(price, 2) OVER w, 0), 0) AS price_change,
             coalesce((lag(daily_quantity) OVER w - lag(daily_quantity, 2) OVER w) / nullif(lag(daily_quantity, 2) OVER w, 0), 0) AS quantity_growth,
             CAST(dense_rank() OVER (ORDER BY city) - 1 AS INTEGER) AS city_encoded,
             CAST(dense_rank() OVER (ORDER BY nhom_hang_cap_1) - 1 AS INTEGER) AS nhom_hang_cap_1_encoded
      FROM priced WINDOW w AS ({_W}), {frames})"""


_M3 = ("lag_", "rolling_", "ema_", "avg_price", "price_change", "quantity_growth", "day_of_week")


@query(
    "M3_train_features", "M3 M4 M5", _m3_sql(),
    four=" ".join(
        [f"rolling_{stat}_{n}_quantity" for n in features.WINDOWS for stat in ("mean", "std", "range")]
        + [f"ema_{n}_quantity" for n in features.WINDOWS] + ["avg_price", "price_change", "quantity_growth"]
    ),
    two=" ".join(f"lag_{k}_revenue" for k in features.LAGS),
)
def train_features(s):
    """The full feature set; calendar features other than the week day are shown by H3."""
    rows = pinned(series(s))
    encoder = features.encode(rows, SERIES)
    made = features.make_features(rows, SERIES, encoder=encoder)
    wanted = [c for c in features.feature_columns(made) if c.startswith(_M3) or c.endswith("_encoded")]
    return made.select("ngay", *SERIES, "daily_quantity", *wanted)


@query(
    "M2_winsorize", "M2",
    """cap AS (SELECT quantile_cont(quantity_sold, 0.99) AS c FROM regular),
    answer AS (
      SELECT transaction_date AS ngay, branch_code AS chi_nhanh, product_code AS ma_hang,
             least(quantity_sold, c) AS daily_quantity FROM regular, cap)""",
    four="daily_quantity",
)
def winsorize(s):
    rows = pinned(history(s).select("ngay", "chi_nhanh", "ma_hang", "daily_quantity"))
    return features.winsorize(rows, "daily_quantity")[0]


@query(
    "M2_winsorize_stats", "M2",
    """cap AS (SELECT quantile_cont(quantity_sold, 0.99) AS c FROM regular),
    answer AS (
      SELECT 'daily_quantity' AS column_name, max(c) AS cap_value, max(quantity_sold) AS original_max,
             avg(quantity_sold) AS original_mean, avg(least(quantity_sold, c)) AS new_mean,
             count(*) FILTER (quantity_sold > c) AS outliers_count, count(*) AS total_records FROM regular, cap)""",
    four="cap_value original_mean new_mean",
)
def winsorize_stats(s):
    rows = pinned(history(s).select("daily_quantity"))
    return features.winsorize(rows, "daily_quantity")[1]


@query(
    "K7_lag_coverage", "K7",
    f"""{_SERIES}, l AS (
      SELECT *, lag(daily_quantity, 1) OVER w AS a, lag(daily_quantity, 7) OVER w AS b, lag(daily_quantity, 30) OVER w AS c
      FROM series WINDOW w AS ({_W})),
    answer AS (
      SELECT 'lag_1_quantity' AS feature, count(*) FILTER (a <> 0) AS non_zero, count(*) FILTER (a <> 0) * 100.0 / count(*) AS coverage_pct FROM l
      UNION ALL SELECT 'lag_7_quantity', count(*) FILTER (b <> 0), count(*) FILTER (b <> 0) * 100.0 / count(*) FROM l
      UNION ALL SELECT 'lag_30_quantity', count(*) FILTER (c <> 0), count(*) FILTER (c <> 0) * 100.0 / count(*) FROM l)""",
    four="coverage_pct",
)
def lag_coverage(s):
    made = features.with_lags(series(s), SERIES, (1, 7, 30), ("quantity",))
    return quality.lag_coverage(made, ["lag_1_quantity", "lag_7_quantity", "lag_30_quantity"])


@query(
    "M8_fold_bounds", "M8",
    """days AS (SELECT ngay, count(*) AS n, row_number() OVER (ORDER BY ngay) AS i, count(*) OVER () AS total FROM tx GROUP BY 1),
    k AS (SELECT 5 AS folds, max(total) // 6 AS size, max(total) AS total FROM days),
    f AS (SELECT unnest(range(1, folds + 1)) AS fold, folds, size, total FROM k),
    b AS (SELECT fold, total - (folds - fold + 1) * size AS t, size FROM f),
    answer AS (
      SELECT fold, min(ngay) FILTER (i <= t) AS train_start, max(ngay) FILTER (i <= t) AS train_end,
             min(ngay) FILTER (i > t AND i <= t + size) AS test_start, max(ngay) FILTER (i > t AND i <= t + size) AS test_end,
             CAST(sum(n) FILTER (i <= t) AS BIGINT) AS train_rows, CAST(sum(n) FILTER (i > t AND i <= t + size) AS BIGINT) AS test_rows
      FROM days, b GROUP BY fold)""",
)
def fold_bounds(s):
    return evaluate.fold_bounds(s.transactions)


@query(
    "M11_should_retrain", "M11",
    """answer AS (
      SELECT max(ngay) AS newest_day, DATE '2001-07-20' AS last_trained,
             CAST(max(ngay) - DATE '2001-07-20' AS INTEGER) AS new_days, max(ngay) - DATE '2001-07-20' >= 7 AS retrain FROM tx)""",
)
def should_retrain(s):
    return evaluate.should_retrain(s.transactions, "2001-07-20")


@query(
    "M12_horizon", "M12",
    """active AS (SELECT DISTINCT ma_chi_nhanh AS chi_nhanh, ma_hang FROM lines WHERE ngay >= (SELECT d - 60 FROM newest)),
    answer AS (
      SELECT chi_nhanh, ma_hang, CAST(d + h AS DATE) AS forecast_date
      FROM active, newest, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS h))""",
)
def horizon(s):
    active = facts.sales_lines(s.transactions, s.details, s.as_of, 60).select(
        F.col("branch_code").alias("chi_nhanh"), F.col("product_code").alias("ma_hang")
    ).distinct()
    return evaluate.horizon(active, s.as_of)


_COLD = """hist AS (
      SELECT transaction_date AS ngay, branch_code AS chi_nhanh, product_code AS ma_hang, cap_1 AS nhom_hang_cap_1,
             quantity_sold AS q FROM regular),
    per AS (
      SELECT chi_nhanh, ma_hang, count(*) AS days_sold, min(ngay) AS first_day, max(ngay) AS last_day,
             min(nhom_hang_cap_1) AS nhom_hang_cap_1, count(*) / (max(ngay) - min(ngay) + 1) AS density,
             count(DISTINCT q) AS kinds FROM hist GROUP BY 1, 2),
    cold AS (
      SELECT * EXCLUDE (kinds), CASE WHEN days_sold < 7 AND kinds = 1 THEN 'uniform'
               WHEN days_sold >= 2 AND density < 0.05 AND days_sold < 10 THEN 'sparse'
               WHEN days_sold < 2 THEN 'short' END AS reason,
             (days_sold < 7 AND kinds = 1) OR (days_sold >= 2 AND density < 0.05 AND days_sold < 10) OR days_sold < 2 AS is_cold_start
      FROM per)"""


@query("M13_cold_start", "M13", f"{_COLD}, answer AS (SELECT * FROM cold)", four="density")
def cold_start(s):
    return evaluate.cold_start(history(s))


_COLD_FORECAST = f"""{PEAKS}, {LATEST}, {_COLD}, med AS (SELECT nhom_hang_cap_1, median(q) AS m FROM hist GROUP BY 1),
    cf AS (
      SELECT chi_nhanh, ma_hang, nhom_hang_cap_1, CAST(d + h AS DATE) AS forecast_date, reason, is_cold_start,
             CASE WHEN reason = 'uniform' THEN least(coalesce(m, 10), 50) ELSE coalesce(m, 10) END * coalesce(seasonal_factor, 1) AS raw
      FROM cold LEFT JOIN med USING (nhom_hang_cap_1), newest, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS h)
      LEFT JOIN latest ON latest.month = month(d + h) WHERE is_cold_start)"""


def _cold_forecast(s):
    rows = pinned(history(s).select("ngay", "chi_nhanh", "ma_hang", "nhom_hang_cap_1", "daily_quantity"))
    latest = seasonality.latest_factors(seasonal_factors_of(s))
    return evaluate.cold_start_forecast(
        evaluate.cold_start(rows), features.category_stats(rows), latest, s.as_of
    )


@query(
    "M14_cold_start_forecast", "M14",
    f"""{_COLD_FORECAST}, answer AS (
      SELECT chi_nhanh, ma_hang, forecast_date, raw AS predicted_quantity_raw, round_even(round(raw, 6), 0) AS predicted_quantity,
             raw * 0.5::DOUBLE AS confidence_lower, raw * 1.5::DOUBLE AS confidence_upper FROM cf)""",
    four="predicted_quantity_raw confidence_lower confidence_upper",
)
def cold_start_forecast(s):
    made = _cold_forecast(s)
    return made.select(
        "chi_nhanh", "ma_hang", "forecast_date", "predicted_quantity_raw",
        rules.whole(F.round("predicted_quantity_raw", 6)).alias("predicted_quantity"),
        "confidence_lower", "confidence_upper",
    )


# A naive forecast of the last 28 days: each product's mean units per selling day before them.
_PAST = """sold AS (SELECT transaction_date, product_code, any_value(cap_1) AS c, sum(quantity_sold) AS q FROM regular GROUP BY 1, 2),
    past AS (SELECT product_code, any_value(c) AS c, avg(q) AS m FROM sold WHERE transaction_date < (SELECT d - 27 FROM newest) GROUP BY 1),
    act AS (SELECT transaction_date, product_code, q AS actual_quantity FROM sold WHERE transaction_date >= (SELECT d - 27 FROM newest)),
    pairs AS (
      SELECT transaction_date AS forecast_date, product_code AS ma_hang, c AS nhom_hang_cap_1, round(m, 6) AS predicted_quantity,
             actual_quantity, round(m, 6) - actual_quantity AS error, abs(round(m, 6) - actual_quantity) AS abs_error,
             abs((round(m, 6) - actual_quantity) / nullif(actual_quantity, 0)) AS abs_pct_error
      FROM act JOIN past USING (product_code))"""


def _units(s) -> DataFrame:
    return regular(s).groupBy("transaction_date", "product_code").agg(F.sum("quantity_sold").alias("q"))


def _pairs(s) -> DataFrame:
    units = pinned(_units(s))
    start = F.date_sub(s.as_of, 27)
    past = units.filter(F.col("transaction_date") < start).groupBy(F.col("product_code").alias("ma_hang")).agg(
        F.round(F.avg("q"), 6).alias("predicted_quantity")
    )
    ahead = evaluate.horizon(past, F.date_sub(s.as_of, 28), 28)
    actual = units.withColumnRenamed("q", "actual_quantity")
    return evaluate.matched(ahead, actual, start, s.as_of)


@query(
    "C17_forecast_actual", "C17",
    f"{_PAST}, answer AS (SELECT * EXCLUDE (nhom_hang_cap_1) FROM pairs)",
    four="predicted_quantity error abs_error abs_pct_error",
)
def forecast_actual(s):
    return _pairs(s)


@query(
    "M18_accuracy", "M18 M19",
    f"""{_PAST}, answer AS (
      SELECT avg(abs_error) AS mae, sqrt(avg(error * error)) AS rmse, avg(abs_pct_error) AS mape,
             sum(abs_error) / sum(actual_quantity) AS wmape, count(*) AS num_records, median(abs_pct_error) AS mdape,
             sum(predicted_quantity) AS total_forecast, sum(actual_quantity) AS total_actual,
             sum(predicted_quantity) - sum(actual_quantity) AS overall_bias, count(DISTINCT ma_hang) AS num_products FROM pairs)""",
    four="mae rmse mape wmape mdape total_forecast overall_bias",
)
def accuracy(s):
    return evaluate.accuracy(_pairs(s))


@query(
    "K10_grades", "K10 M19",
    f"""{_PAST}, m AS (
      SELECT avg(abs_error) AS mae, avg(abs_pct_error) AS mape, sum(abs_error) / sum(actual_quantity) AS wmape,
             median(abs_pct_error) AS mdape FROM pairs),
    answer AS (
      SELECT mae, mape, wmape, mdape,
             CASE WHEN mae < 5 THEN 'very good' WHEN mae < 15 THEN 'good' WHEN mae < 30 THEN 'acceptable' ELSE 'needs work' END AS mae_grade,
             CASE WHEN mape < 0.1 THEN 'very good' WHEN mape < 0.2 THEN 'good' WHEN mape < 0.3 THEN 'acceptable' ELSE 'needs work' END AS mape_grade,
             CASE WHEN wmape < 0.1 THEN 'excellent' WHEN wmape < 0.2 THEN 'very good' WHEN wmape < 0.3 THEN 'good'
                  WHEN wmape < 0.4 THEN 'acceptable' ELSE 'needs work' END AS wmape_grade,
             CASE WHEN mdape < 0.1 THEN 'very good' WHEN mdape < 0.2 THEN 'good' WHEN mdape < 0.3 THEN 'acceptable' ELSE 'needs work' END AS mdape_grade
      FROM m)""",
    four="mae mape wmape mdape",
)
def grades(s):
    names = ("mae", "mape", "wmape", "mdape")
    m = evaluate.metrics(_pairs(s), "actual_quantity", "predicted_quantity")
    return m.select(*names, *[rules.grade(F.col(n), n).alias(f"{n}_grade") for n in names])


@query(
    "F4_top_errors", "F4",
    f"""{_PAST}, answer AS (
      SELECT forecast_date, ma_hang, predicted_quantity, actual_quantity, error, abs_pct_error FROM pairs
      ORDER BY abs_error DESC, forecast_date, ma_hang LIMIT 10)""",
    four="predicted_quantity error abs_pct_error",
)
def top_errors(s):
    return evaluate.top_errors(_pairs(s))


@query(
    "M18_actual_baseline", "M18",
    f"""{_PAST}, d AS (SELECT transaction_date, sum(actual_quantity) AS q FROM act GROUP BY 1),
    answer AS (
      SELECT sum(actual_quantity) AS actual_total_quantity, count(DISTINCT product_code) AS num_products,
             min(transaction_date) AS first_day, max(transaction_date) AS last_day,
             (SELECT avg(q) FROM d) AS actual_avg_daily, (SELECT stddev_samp(q) FROM d) AS actual_std_daily FROM act)""",
    four="actual_avg_daily actual_std_daily",
)
def actual_baseline(s):
    recent = _units(s).filter(F.col("transaction_date") >= F.date_sub(s.as_of, 27))
    return evaluate.actual_baseline(recent.withColumnRenamed("q", "actual_quantity"))


@query(
    "F4_top_actual_products", "F4",
    f"""{_PAST}, answer AS (
      SELECT product_code, sum(actual_quantity) AS actual_quantity FROM act GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""",
)
def top_actual_products(s):
    recent = _units(s).filter(F.col("transaction_date") >= F.date_sub(s.as_of, 27))
    return evaluate.top_actual_products(recent.withColumnRenamed("q", "actual_quantity"))


@query(
    "F6_top_forecasts", "F6 D22",
    f"""{ORDERS}, answer AS (
      SELECT ma_hang, round(sum(predicted_quantity), 6) AS total_quantity FROM fc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)""",
    four="total_quantity",
)
def top_forecasts(s):
    return evaluate.top_forecasts(Orders(s).forecasts, 15)


# A second, category-level forecast: a 30-day mean per day for seven of the categories' days.
_TWO = f"""{ORDERS}, cat AS (
      SELECT CAST(d + h AS DATE) AS forecast_date, cap_1 AS nhom_hang_cap_1, sum(so_luong) / 30 AS predicted_quantity
      FROM lines, newest, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS h)
      WHERE ngay >= d - 30 AND cap_1 <> 'PROMO' GROUP BY 1, 2),
    cmp AS (
      SELECT nhom_hang_cap_1, coalesce(a.q, 0) AS model1_quantity, coalesce(a.n, 0) AS num_products, coalesce(b.q, 0) AS model2_quantity
      FROM (SELECT nhom_hang_cap_1, sum(predicted_quantity) AS q, count(DISTINCT ma_hang) AS n FROM fc GROUP BY 1) a
      FULL JOIN (SELECT nhom_hang_cap_1, sum(predicted_quantity) AS q FROM cat GROUP BY 1) b USING (nhom_hang_cap_1)),
    compared AS (
      SELECT *, CASE WHEN model1_quantity > 0 THEN (model2_quantity - model1_quantity) / model1_quantity * 100
                     WHEN model2_quantity = 0 THEN 0 END AS difference_pct FROM cmp),
    judged AS (
      SELECT *, CASE WHEN abs(difference_pct) <= 10 THEN 'Consistent' WHEN abs(difference_pct) <= 25 THEN 'Warning'
                     ELSE 'Significant' END AS status FROM compared)"""


def _category_forecast(s) -> DataFrame:
    lines = facts.sales_lines(s.transactions, s.details, s.as_of, 30)
    cap = s.products.select(F.col("ma_hang").alias("product_code"), F.col("cap_1").alias("nhom_hang_cap_1"))
    sold = lines.groupBy("product_code").agg(F.sum("quantity").alias("q")).join(cap, "product_code")
    level = sold.filter(F.col("nhom_hang_cap_1") != "PROMO").groupBy("nhom_hang_cap_1").agg(
        (F.sum("q") / 30).alias("predicted_quantity")
    )
    return evaluate.horizon(level, s.as_of)


@query("M17_compare_models", "M17 C18 G6", f"{_TWO}, answer AS (SELECT * FROM judged)",
       four="model1_quantity model2_quantity difference_pct")
def compare_models(s):
    return evaluate.compare_models(Orders(s).forecasts, _category_forecast(s))


@query(
    "M17_comparison_summary", "M17",
    f"""{_TWO}, t AS (
      SELECT sum(model1_quantity) AS total_model1, sum(model2_quantity) AS total_model2,
             abs(sum(model2_quantity) - sum(model1_quantity)) / sum(model1_quantity) * 100 AS overall_deviation_pct,
             count(*) FILTER (status = 'Consistent') * 100.0 / count(*) AS consistency_score FROM judged),
    answer AS (
      SELECT *, CASE WHEN consistency_score >= 80 THEN 'High consistency'
                     WHEN consistency_score >= 60 THEN 'Moderate consistency - review significant differences'
                     ELSE 'Low consistency - investigate data quality' END AS recommendation FROM t)""",
    four="total_model1 total_model2 overall_deviation_pct consistency_score",
)
def comparison_summary(s):
    return evaluate.comparison_summary(evaluate.compare_models(Orders(s).forecasts, _category_forecast(s)))


@query(
    "M22_blend", "M22",
    f"""{_PAST}, last AS (SELECT transaction_date, product_code, q, lag(q) OVER (PARTITION BY product_code ORDER BY transaction_date) AS p FROM sold),
    answer AS (
      SELECT forecast_date, ma_hang, predicted_quantity * 0.7::DOUBLE + p * 0.3::DOUBLE AS predicted_quantity,
             (predicted_quantity * 0.7::DOUBLE + p * 0.3::DOUBLE - actual_quantity) ** 2
               * CASE WHEN predicted_quantity * 0.7::DOUBLE + p * 0.3::DOUBLE < actual_quantity THEN 2 ELSE 1 END AS loss
      FROM pairs JOIN last ON forecast_date = transaction_date AND ma_hang = product_code WHERE p IS NOT NULL)""",
    four="predicted_quantity loss",
)
def blend(s):
    """The naive mean blended with the product's previous sale."""
    from pyspark.sql import Window

    w = Window.partitionBy("product_code").orderBy("transaction_date")
    last = _units(s).select(
        F.col("transaction_date").alias("forecast_date"), F.col("product_code").alias("ma_hang"),
        F.lag("q").over(w).alias("predicted_quantity"),
    ).filter(F.col("predicted_quantity").isNotNull())
    mixed = evaluate.blend(_pairs(s), last, ["forecast_date", "ma_hang"])
    return mixed.select(
        "forecast_date", "ma_hang", "predicted_quantity",
        evaluate.asymmetric_loss(F.col("actual_quantity"), F.col("predicted_quantity")).alias("loss"),
    )


@query(
    "M21_report", "M21",
    f"""{_TWO}, answer AS (
      SELECT 'totals' AS section, '' AS name, sum(predicted_quantity) AS value FROM fc
      UNION ALL SELECT * FROM (SELECT 'top_products', ma_hang, round(sum(predicted_quantity), 6) FROM fc GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 15)
      UNION ALL SELECT 'categories', nhom_hang_cap_1, sum(predicted_quantity) FROM cat GROUP BY 2
      UNION ALL SELECT 'comparison', nhom_hang_cap_1, difference_pct FROM judged
      UNION ALL SELECT 'recommendations', ma_hang,
             CASE WHEN safety_stock < min_stock THEN min_stock - safety_stock
                  ELSE round_even(forecast_units / horizon_days * 14, 0) END
      FROM fs LEFT JOIN safety ON ma_hang = product_code)""",
    four="value",
)
def report(s):
    """The report tables of the naive forecasts, one value per line."""
    orders = Orders(s)
    tables = forecast.report(
        pinned(orders.forecasts), pinned(_category_forecast(s)), inventory.recommendations(orders.summary, orders.safety, orders.stock)
    )
    lines = {
        "totals": (F.lit(""), F.col("total_quantity")),
        "top_products": (F.col("ma_hang"), F.col("total_quantity")),
        "categories": (F.col("nhom_hang_cap_1"), F.col("total_quantity")),
        "comparison": (F.col("nhom_hang_cap_1"), F.col("difference_pct")),
        "recommendations": (F.col("product_code"), F.col("suggested_order_quantity")),
    }
    out = None
    for section, (name, value) in lines.items():
        part = tables[section].select(F.lit(section).alias("section"), name.alias("name"), value.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


_SHAPE = {"lags": features.LAGS, "windows": features.WINDOWS, "spans": features.WINDOWS}


#: The models: keys of their series, columns with codes, days ahead, shape of the features.
MODELS = {
    "product": (("chi_nhanh", "ma_hang"), ("chi_nhanh", "nhom_hang_cap_1", "thuong_hieu"), 14, _SHAPE),
    "region": (SERIES, SERIES, 14, _SHAPE),
    "category": (("nhom_hang_cap_1",), ("nhom_hang_cap_1",), 7, {"lags": (1, 7, 14), "windows": (7, 14), "spans": (7,)}),
}
#: The model whose series the search runs on; its best setting trains all three.
SEARCHED = "region"


class Sold:
    """What the models of one `Sources` share, written once: month factors, sales per branch and category."""

    def __init__(self, s):
        self.s = s

    @classmethod
    def of(cls, s) -> Sold:
        if not hasattr(s, "_sold"):
            s._sold = cls(s)
        return s._sold

    @cached_property
    def latest(self) -> DataFrame:
        return pinned(seasonality.latest_factors(seasonal_factors_of(self.s)))

    @cached_property
    def categories(self) -> DataFrame:
        return pinned(category_sales(self.s))


class Learned:
    """One of `MODELS`: its series, and the model trained on them.

    A model is trained once, with the setting that the search found, and saved into the
    shared folder with its encoder; later it is loaded, until there are a week of days newer
    than those it has seen (M11).
    """

    def __init__(self, s, kind: str):
        self.s, self.kind = s, kind
        self.keys, self.coded, self.days, self.shape = MODELS[kind]

    @property
    def latest(self) -> DataFrame:
        return Sold.of(self.s).latest

    @cached_property
    def rows(self) -> DataFrame:
        if self.kind == "product":
            # One row per product, branch and day: only what the features and the state read.
            wanted = ("ngay", *dict.fromkeys((*self.keys, *self.coded)), "daily_quantity", "daily_revenue", *features.NO_SEASON)
            return pinned(history(self.s, self.latest).select(*wanted))
        sold = Sold.of(self.s).categories
        if self.kind == "region":
            return pinned(series(self.s, self.latest, sold))
        return pinned(features.category_days(sold, self.keys, self.latest))

    @cached_property
    def encoder(self):
        return features.encode(self.rows, self.coded)

    @cached_property
    def training(self) -> tuple[DataFrame, list[str]]:
        """Training rows with features, and the features."""
        made = features.make_features(self.rows, self.keys, encoder=self.encoder, **self.shape)
        wanted = [
            c for c in features.feature_columns(made) if not c.endswith("_revenue") and c not in ("avg_price", "price_change")]
        made = made.select("ngay", "daily_quantity", *wanted)
        # The search reads its rows several times; training writes its own, as vectors.
        return (pinned(made) if self.kind == SEARCHED else made), wanted

    @property
    def path(self) -> str:
        """The saved model of this application and data folder."""
        name = hashlib.sha256(self.s.folder.encode()).hexdigest()[:16]
        return f"{shared_dir(self.s.spark)}/models-{self.s.spark.sparkContext.applicationId}/{name}/{self.kind}"

    def search(self) -> tuple[dict, list[dict]]:
        """The best setting, and every score."""
        # Two fits a core where fits pass over partitions: each level of a tree is a task or two.
        return forecast.tune(*self.training, parallel=2 * self.s.spark.sparkContext.defaultParallelism)

    def learn(self, found: tuple[dict, list[dict]] | None = None) -> None:
        """Train with the setting found, or search or take it, and save."""
        made, wanted = self.training
        if found is None:
            found = self.search() if self.kind == SEARCHED else (Learned(self.s, SEARCHED).saved[2]["params"], [])
        best, scores = found
        trained = forecast.learn(made, wanted, params=best)
        forecast.save(
            self.s.spark, trained, self.encoder, self.path, params=best, scores=scores if self.kind == SEARCHED else [])

    def stale(self) -> bool:
        """No saved model, or one that has not seen a week of days."""
        last = forecast.last_trained(self.s.spark, self.path)
        return last is None or evaluate.should_retrain(self.s.transactions, last).first()["retrain"]

    @cached_property
    def saved(self):
        """(trained, encoder, {params, scores}) from the saved model."""
        train([self])
        return forecast.load(self.s.spark, self.path)

    @cached_property
    def state(self) -> DataFrame:
        extra = ("nhom_hang_cap_1", "thuong_hieu") if self.kind == "product" else ()
        return forecast.state_of(self.rows, self.keys, extra=extra, **self.shape)

    def ahead(self, state: DataFrame | None = None) -> DataFrame:
        """The recursive forecast of all series, or of those of `state`."""
        trained, encoder, _ = self.saved
        coded = forecast.encoded(self.state if state is None else state, encoder)
        made = forecast.forecast(trained.model, coded, self.latest, self.s.as_of, self.days, **self.shape)
        return made.drop(*encoder.getOutputCols())


def train(models: Sequence[Learned]) -> None:
    """Train and save those of the models that are due: first the search, whose setting all take,
    then the models side by side, the searched one among them where it was due too.

    Trees on few rows wait for jobs, not for cores, which those on many rows use meanwhile.
    """
    due = [m for m in models if m.stale()]
    if not due:
        return
    s = due[0].s
    first = next((m for m in due if m.kind == SEARCHED), None)
    if first is None:
        first = Learned(s, SEARCHED)
        if first.stale():
            due.append(first)
    found = first.search() if first in due else (first.saved[2]["params"], [])
    Sold.of(s).latest  # written before the models share it
    with ThreadPoolExecutor(len(due)) as pool:
        list(pool.map(lambda m: m.learn(found), due))


@query("M6_train_importance", "M6 M10 M5")
def train_importance(s):
    """Feature importances of a quantity model over all regional category series."""
    return forecast.importance(s.spark, Learned(s, "region").saved[0].model)


@query(
    "M10_importance_facts", "M6 M9 M10 M4",
    _SERIES + """, answer AS (
      SELECT unnest(['category', 'product', 'region']) AS model, true AS sums_to_one, true AS never_negative,
             true AS trees_in_bounds, true AS judged, d AS last_day, unnest([30, 43, 41]) AS features,
             unnest([1, 3, 2]) AS codes
      FROM newest, (SELECT max(ngay) AS seen FROM series) WHERE seen = d)""",
)
def importance_facts(s):
    """What must hold of the three trained models: importances, chosen number of trees, days, codes."""
    made = []
    models = {kind: Learned(s, kind) for kind in sorted(MODELS)}
    train([*models.values()])
    for kind, model in models.items():
        trained, encoder, _ = model.saved
        weights = forecast.importance(s.spark, trained.model)
        made.append(weights.agg(
            F.lit(kind).alias("model"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
            F.bool_and(F.col("importance") >= 0).alias("never_negative"),
            F.lit(1 <= trained.trees <= forecast.ROUNDS).alias("trees_in_bounds"),
            F.lit(trained.mdape is not None and trained.mdape >= 0).alias("judged"),
            F.lit(trained.last_day).alias("last_day"), F.countDistinct("feature").alias("features"),
            F.lit(len(encoder.getOutputCols())).alias("codes")))
    return made[0].union(made[1]).union(made[2])


@query("M7_tune", "M7 M8")
def tune(s):
    """The whole search: every score of every setting, and whether it is the winner's."""
    _, _, more = Learned(s, SEARCHED).saved
    return s.spark.createDataFrame(
        [(r["trial"], r["rung"], r["folds"], r["rounds"], str(sorted(r["params"].items())), float(r["mdape"]),
          r["params"] == more["params"]) for r in more["scores"]],
        "trial int, rung int, folds int, rounds int, params string, mdape double, chosen boolean",
    )


@query(
    "M7_search", "M7 M8 M6",
    _SERIES + """, rungs AS (
      SELECT unnest([0, 1, 2, 3]) AS rung, unnest([50, 17, 6, 2]) AS settings, unnest([1, 2, 3, 5]) AS folds,
             unnest([6, 12, 25, 50]) AS rounds),
    answer AS (
      SELECT rung, CAST(settings AS BIGINT) AS settings, folds, rounds, true AS all_judged, true AS kept_the_best,
             true AS trained_with_winner
      FROM rungs, (SELECT count(DISTINCT ngay) AS days FROM series) WHERE days > 5)""",
)
def search(s):
    """Rounds of the search: how many settings on how many folds and boosting rounds; that each
    round keeps the best of the one before; and that the models were trained with the winner."""
    train([Learned(s, kind) for kind in MODELS])
    scores = tune(s)
    winner = Learned(s, SEARCHED).saved[2]["params"]
    others = [Learned(s, kind).saved[2]["params"] == winner for kind in MODELS]
    worst = scores.groupBy((F.col("rung") - 1).alias("_before")).agg(F.collect_set("trial").alias("_on"))  # 50 at most
    judged = scores.join(worst, F.col("rung") == F.col("_before"), "left")
    on = F.array_contains("_on", F.col("trial"))
    last = F.col("_on").isNull()
    return judged.groupBy("rung").agg(
        F.countDistinct("trial").alias("settings"), F.max("folds").alias("folds"), F.max("rounds").alias("rounds"),
        F.bool_and(F.col("mdape") < float("inf")).alias("all_judged"),
        F.coalesce(
            F.max(F.when(on, F.col("mdape"))) <= F.min(F.when(~on, F.col("mdape"))),
            F.min(F.when(last & F.col("chosen"), F.col("mdape"))) == F.min(F.when(last, F.col("mdape")))).alias("kept_the_best"),
        F.lit(all(others)).alias("trained_with_winner"))


@query("M15_recursive_forecast", "M15 A14")
def recursive_forecast(s):
    """Fourteen days ahead for every regional category series."""
    return Learned(s, "region").ahead()


@query("M16_category_forecast", "M9 M16")
def category_forecast(s):
    """A model over category series; seven days for categories with a week of history."""
    learned = Learned(s, "category")
    return learned.ahead(learned.state.filter("days_sold >= 7"))


def product_forecast(s) -> DataFrame:
    """Fourteen days for every (branch, product) sold in the last 60 days, written once."""
    learned = Learned(s, "product")
    trained, encoder, _ = learned.saved
    active = learned.state.filter(F.col("last_day") >= F.date_sub(s.as_of, 60))
    medians = features.category_stats(learned.rows)
    return pinned(forecast.forecast_all(trained.model, active, medians, learned.latest, s.as_of, 14, encoder, **_SHAPE))


_ALL_FORECASTS = f"""{PEAKS}, {LATEST}, {_COLD}, med AS (SELECT nhom_hang_cap_1, median(q) AS m FROM hist GROUP BY 1),
    fa AS (
      SELECT chi_nhanh, ma_hang, nhom_hang_cap_1, CAST(d + h AS DATE) AS forecast_date, reason, is_cold_start,
             CASE WHEN is_cold_start THEN
               CASE WHEN reason = 'uniform' THEN least(coalesce(m, 10), 50) ELSE coalesce(m, 10) END * coalesce(seasonal_factor, 1)
             END AS cold_quantity
      FROM newest, cold LEFT JOIN med USING (nhom_hang_cap_1), (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS h)
      LEFT JOIN latest ON latest.month = month(d + h) WHERE last_day >= d - 60)"""


@query(
    "M15_forecast_all", "M12 M13 M14 M15",
    f"""{_ALL_FORECASTS}, answer AS (
      SELECT *, true AS never_negative, true AS whole_right, true AS lower_right, true AS upper_right FROM fa)""",
    four="cold_quantity",
)
def forecast_all(s):
    """Every day of every active series, cold or warm, in one table; of warm ones only the bounds are known."""
    made, raw = product_forecast(s), F.col("predicted_quantity_raw")
    cold = F.col("is_cold_start")

    def near(c: str, when_cold: float, when_warm: float):
        return F.abs(F.col(c) - raw * F.when(cold, when_cold).otherwise(when_warm)) < 1e-9

    return made.select(
        "chi_nhanh", "ma_hang", "nhom_hang_cap_1", "forecast_date", "reason", "is_cold_start",
        F.when(cold, raw).alias("cold_quantity"), (raw >= 0).alias("never_negative"),
        (F.col("predicted_quantity") == rules.whole(raw)).alias("whole_right"),
        near("confidence_lower", 0.5, 0.8).alias("lower_right"), near("confidence_upper", 1.5, 1.2).alias("upper_right"))


@query(
    "M20_forecast_quality", "M20 M15",
    f"""{_ALL_FORECASTS}, answer AS (
      SELECT count(DISTINCT ma_hang) FILTER (is_cold_start) AS cold_start_count, count(*) FILTER (is_cold_start) > 0 AS fallback_used,
             CAST(count(DISTINCT ma_hang) FILTER (is_cold_start) * 100.0 / count(DISTINCT ma_hang) AS DOUBLE) AS missing_data_pct,
             count(*) FILTER (round_even(cold_quantity, 0) = 0) AS cold_zeros, true AS zeros_right,
             count(DISTINCT ma_hang) AS total_products, 1 AS data_age_days FROM fa)""",
    four="missing_data_pct",
)
def forecast_quality(s):
    """Quality of the whole forecast, one day after the newest sale; zeros of warm series depend on the model."""
    made = product_forecast(s)
    zero = F.col("predicted_quantity") == 0
    counts = made.agg(F.struct(
        F.count_if(zero & F.col("is_cold_start")).alias("cold"), F.count_if(zero).alias("all")).alias("z")).scalar()
    return evaluate.forecast_quality(made, s.as_of, F.date_add(s.as_of, 1)).select(
        "cold_start_count", "fallback_used", "missing_data_pct", counts["cold"].alias("cold_zeros"),
        (F.col("zero_predictions") == counts["all"]).alias("zeros_right"), "total_products", "data_age_days")


@query(
    "A14_append_all", "A14 M15",
    f"""{_ALL_FORECASTS}, answer AS (
      SELECT forecast_date, 2 * count(*) AS rows, count(DISTINCT ma_hang) AS products, count(DISTINCT chi_nhanh) AS branches
      FROM fa GROUP BY 1)""",
)
def append_all(s):
    """The whole forecast appended twice to a table, as two runs do, and read back."""
    made, path = product_forecast(s), scratch_path(s.spark, "forecasts")
    for _ in range(2):
        files.write_forecasts(made, path)
    return s.spark.read.parquet(path).groupBy("forecast_date").agg(
        F.count("*").alias("rows"), F.countDistinct("ma_hang").alias("products"), F.countDistinct("chi_nhanh").alias("branches"))


@query(
    "M11_saved_model", "M4 M6 M11",
    _SERIES + """, answer AS (
      SELECT city, nhom_hang_cap_1, count(*) AS days, true AS same_codes, true AS same_forecasts, any_value(d) AS last_trained,
             false AS retrain FROM series, newest GROUP BY 1, 2)""",
)
def saved_model(s):
    """A model saved and read again in fresh objects forecasts what it did before; M11 reads its last day."""
    learned, path = Learned(s, "region"), scratch_path(s.spark, "model")
    made, wanted = learned.training
    before = forecast.learn(made, wanted, params={"maxIter": 3})
    forecast.save(s.spark, before, learned.encoder, path)
    after, encoder, _ = forecast.load(s.spark, path)
    gate = evaluate.should_retrain(s.transactions, forecast.last_trained(s.spark, path))
    codes = [f"{c}_encoded" for c in SERIES]
    coded = learned.rows.select("ngay", *SERIES)
    for name, e in (("_old", learned.encoder), ("_new", encoder)):
        coded = forecast.encoded(coded, e).withColumn(name, F.array(*codes)).drop(*codes)
    same = before.model.transform(made).select("features", F.col("prediction").alias("_before"))
    again = after.model.stages[-1].transform(same)
    differing = again.agg(F.count_if(F.col("prediction") != F.col("_before")).alias("n")).scalar()
    day_ = gate.agg(F.struct(F.max("last_trained").alias("last"), F.bool_or("retrain").alias("retrain")).alias("g")).scalar()
    return coded.groupBy(*SERIES).agg(
        F.count("*").alias("days"), F.bool_and(F.col("_old") == F.col("_new")).alias("same_codes")
    ).select("*", (differing == 0).alias("same_forecasts"), day_["last"].alias("last_trained"), day_["retrain"].alias("retrain"))


def _shape(forecasts: DataFrame, keys) -> DataFrame:
    """What must hold of any model's forecast, per series: days, range of dates, bounds."""
    raw = F.col("predicted_quantity_raw")

    def near(c, share):
        return F.bool_and(F.abs(F.col(c) - raw * share) < 1e-9)

    return forecasts.groupBy(*keys).agg(
        F.count("*").alias("days"), F.countDistinct("forecast_date").alias("dates"),
        F.min("forecast_date").alias("first_day"), F.max("forecast_date").alias("last_day"),
        F.bool_and(raw >= 0).alias("never_negative"), near("confidence_lower", 0.8).alias("lower_right"),
        near("confidence_upper", 1.2).alias("upper_right"),
        F.bool_and(F.col("predicted_quantity") == rules.whole(raw)).alias("whole_right"),
        F.bool_or("is_cold_start").alias("cold"),
    )


def _shape_sql(source: str, keys: str, days: int) -> str:
    return f"""answer AS (
      SELECT {keys}, CAST({days} AS BIGINT) AS days, CAST({days} AS BIGINT) AS dates, CAST(d + 1 AS DATE) AS first_day,
             CAST(d + {days} AS DATE) AS last_day, true AS never_negative, true AS lower_right, true AS upper_right,
             true AS whole_right, false AS cold
      FROM ({source}), newest)"""


@query(
    "M15_forecast_shape", "M15 M6",
    _SERIES + ", " + _shape_sql("SELECT DISTINCT city, nhom_hang_cap_1 FROM series", "city, nhom_hang_cap_1", 14),
)
def forecast_shape(s):
    """The recursive forecast has every day of every series, in bounds."""
    return _shape(recursive_forecast(s), SERIES)


@query(
    "M16_forecast_shape", "M16 M9",
    _shape_sql("""SELECT cap_1 AS nhom_hang_cap_1 FROM regular WHERE quantity_sold > 0 AND gross_revenue > 0
      GROUP BY 1 HAVING count(DISTINCT transaction_date) >= 7""", "nhom_hang_cap_1", 7),
)
def category_forecast_shape(s):
    """The category forecast has seven days of each category with a week of history."""
    return _shape(category_forecast(s), ("nhom_hang_cap_1",))

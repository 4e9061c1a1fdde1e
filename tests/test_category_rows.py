"""Rows of the regional and the category model come from one pass over the lines."""

from datetime import date

from pyspark.sql import functions as F

from shelfwise.operators import facts, features, seasonality
from shelfwise.plans import forecasting
from shelfwise.plans.query import PROMO
from shelfwise.sources.canonical import Sources


def tables(spark):
    """Two days; product 2 twice in the catalog, 3 a promotion, 4 without a category, 9 unknown; branch x twice."""
    tx = spark.createDataFrame(
        [(1, date(2024, 1, 1), "x"), (2, date(2024, 2, 1), "y"), (3, date(2024, 2, 1), None)],
        "id long, ngay date, ma_chi_nhanh string")
    lines = [(t, m, q, 10.0) for t in (1, 2, 3) for m, q in (("1", 2.0), ("1", 3.0), ("2", 1.0), ("3", 5.0), ("4", 1.0), ("9", 4.0))]
    lines += [(2, "1", -9.0, 5.0), (1, None, 1.0, 5.0), (2, "2", None, None)]
    details = spark.createDataFrame(
        [(t, m, q, None if v is None else v / 2, v) for t, m, q, v in lines],
        "transaction_id long, ma_hang string, so_luong double, don_gia double, thanh_tien double")
    products = spark.createDataFrame(
        [("1", "a"), ("2", "a"), ("2", "b"), ("3", "PROMO c"), ("4", None), (None, "n")], "ma_hang string, cap_1 string",
    ).select("*", F.lit("").alias("ten_hang"), F.lit("").alias("cap_2"), F.lit("").alias("thuong_hieu"), F.lit(1.0).alias("gia_von_mac_dinh"))
    branches = spark.createDataFrame([("x", "north"), ("x", "south"), ("y", "north")], "ma_chi_nhanh string, city string")
    return tx, details, products, branches


def test_sums_are_those_of_the_whole_history(spark):
    tx, details, products, branches = tables(spark)
    factors = spark.createDataFrame(
        [(2, 1, "p", 3, 1.13, 1.21, 0.97)],
        "month int, is_peak_day int, peak_reason string, peak_level int, seasonal_factor double, revenue_factor double, quantity_factor double")
    city = branches.select(F.col("ma_chi_nhanh").alias("chi_nhanh"), "city")
    history = features.training_history(
        facts.regular_sales(tx, details, products, branches, PROMO), products, factors=factors)
    sold = features.category_sales(tx, details, products, branches, PROMO)
    for keys, whole, part in (
        (["nhom_hang_cap_1"], history, sold),
        (["city", "nhom_hang_cap_1"], history.join(city, "chi_nhanh"), sold.join(city, "chi_nhanh")),
    ):
        want, got = features.category_series(whole, keys), features.category_days(part, keys, factors)
        assert got.dtypes == want.dtypes
        rows = [sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str) for df in (want, got)]
        assert rows[0] == rows[1] and len(rows[0]) > 4


def test_models_read_the_lines_once(spark, data, monkeypatch):
    s, seen = Sources(spark, data), []
    sums, factors = facts.daily_base, seasonality.seasonal_factors

    def counted(name, f):
        return lambda *a, **b: (seen.append(name), f(*a, **b))[1]

    for module in (facts, features):
        monkeypatch.setattr(module, "daily_base", counted("lines", sums), raising=False)
    monkeypatch.setattr(seasonality, "seasonal_factors", counted("factors", factors))
    for kind in ("category", "region"):
        assert forecasting.Learned(s, kind).rows.count()
    # Once for the factors' year, once for the rows of both models.
    assert sorted(seen) == ["factors", "lines", "lines"]

"""Features, evaluation and forecasts against pandas and plain loops."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import evaluate, features, forecast, seasonality
from shelfwise.sources import reference

KEYS = ("chi_nhanh", "ma_hang")


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    start = date(2024, 1, 1)
    rows = []
    for code, n, gap in (("one", 1, 1), ("even", 5, 1), ("sparse", 8, 40), ("dense", 60, 1)):
        for i in range(n):
            q = 4.0 if code == "even" else float(rng.integers(0, 9))
            rows.append(("b", code, start + timedelta(days=i * gap), q, q * 10 + 1, "cat"))
    return pd.DataFrame(rows, columns=["chi_nhanh", "ma_hang", "ngay", "daily_quantity", "daily_revenue", "nhom_hang_cap_1"])


@pytest.fixture(scope="module")
def history(spark, frame):
    neutral = {k: F.lit(v) for k, v in features.NO_SEASON.items()}
    return spark.createDataFrame(frame).withColumn("ngay", F.to_date("ngay")).withColumns(neutral)


def test_parity_features_match_pandas(history, frame):
    got = features.make_features(history, KEYS, "parity").toPandas().sort_values(["ma_hang", "ngay"]).reset_index()
    want = frame.sort_values(["ma_hang", "ngay"]).reset_index()
    q = want.groupby("ma_hang")["daily_quantity"]
    for n in (7, 14, 30):
        for stat in ("mean", "std", "min", "max"):
            expected = q.transform(lambda x: getattr(x.rolling(n, min_periods=1), stat)()).fillna(0)
            np.testing.assert_allclose(got[f"rolling_{stat}_{n}_quantity"], expected, atol=1e-9)
        np.testing.assert_allclose(
            got[f"ema_{n}_quantity"], q.transform(lambda x: x.ewm(span=n, adjust=False).mean()), atol=1e-9
        )
    for k in features.LAGS:
        np.testing.assert_allclose(got[f"lag_{k}_quantity"], q.shift(k).fillna(0))
    growth = q.pct_change().replace([np.inf, -np.inf], np.nan).fillna(0)
    np.testing.assert_allclose(got["quantity_growth"], growth, atol=1e-9)


def test_train_features_use_earlier_rows_only(history, frame):
    got = features.make_features(history, KEYS, "train").toPandas().sort_values(["ma_hang", "ngay"]).reset_index()
    want = frame.sort_values(["ma_hang", "ngay"]).reset_index()
    q = want.groupby("ma_hang")["daily_quantity"]
    expected = q.transform(lambda x: x.shift().rolling(7, min_periods=1).mean()).fillna(0)
    np.testing.assert_allclose(got["rolling_mean_7_quantity"], expected, atol=1e-9)
    expected = q.transform(lambda x: x.shift().dropna().ewm(span=7, adjust=False).mean().reindex(x.index)).fillna(0)
    np.testing.assert_allclose(got["ema_7_quantity"], expected, atol=1e-9)


def test_dense_series(history):
    dense = features.dense_series(history.filter("ma_hang = 'sparse'"), KEYS, ["daily_quantity"])
    assert dense.count() == 7 * 40 + 1 and dense.filter("daily_revenue is not null").count() == 8


def test_cold_start_reasons(history):
    got = {r.ma_hang: (r.reason, r.is_cold_start) for r in evaluate.cold_start(history).collect()}
    assert got == {"one": ("uniform", True), "even": ("uniform", True), "sparse": ("sparse", True), "dense": (None, False)}


def test_cold_start_forecast_caps_and_defaults(spark):
    cold = spark.createDataFrame(
        [("u", "big", "uniform"), ("s", "big", "short"), ("n", "none", "sparse")],
        "ma_hang string, nhom_hang_cap_1 string, reason string",
    ).withColumn("is_cold_start", F.lit(True))
    medians = spark.createDataFrame([("big", 80.0)], "nhom_hang_cap_1 string, median double")
    factors = spark.createDataFrame([(2, 1.5)], "month int, seasonal_factor double")
    got = evaluate.cold_start_forecast(cold, medians, factors, "2024-01-30", 3).collect()
    level = {(r.ma_hang, r.forecast_date.isoformat()): r.predicted_quantity_raw for r in got}
    assert level[("u", "2024-01-31")] == 50.0 and level[("u", "2024-02-01")] == 75.0
    assert level[("s", "2024-02-02")] == 120.0 and level[("n", "2024-01-31")] == 10.0


def test_folds_do_not_overlap(history):
    bounds = evaluate.fold_bounds(history, 5).orderBy("fold").collect()
    assert len(bounds) == 5
    for b, after in zip(bounds, bounds[1:] + [None]):
        assert b.train_end < b.test_start <= b.test_end
        if after:
            assert after.train_end == b.test_end
    days = history.select("ngay").distinct().orderBy("ngay").limit(5)
    with pytest.raises(Exception, match="5 days cannot hold 5 folds"):
        evaluate.fold_bounds(days, 5).collect()
    assert evaluate.fold_bounds(days, 4).count() == 4


def test_metrics(spark):
    y, p = [0.0, 2.0, 4.0, 10.0], [1.0, 1.0, 5.0, 10.0]
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    m = evaluate.metrics(df, "y", "p").first()
    assert (m.mae, m.rmse, m.mape, m.wmape, m.mdape) == pytest.approx((0.75, np.sqrt(0.75), 0.25, 3 / 16, 0.25))
    empty = evaluate.metrics(df.limit(0), "y", "p").first()
    assert empty.num_records == 0 and empty.mae is None and empty.mdape is None


def test_compare_models_over_the_union(spark):
    a = spark.createDataFrame([("x", "p1", 100.0), ("z", "p2", 0.0)], "nhom_hang_cap_1 string, ma_hang string, predicted_quantity double")
    b = spark.createDataFrame([("x", 109.0), ("y", 3.0)], "nhom_hang_cap_1 string, predicted_quantity double")
    got = {r.nhom_hang_cap_1: (r.difference_pct, r.status) for r in evaluate.compare_models(a, b).collect()}
    assert got == {"x": (9.0, "Consistent"), "y": (None, "Significant"), "z": (0.0, "Consistent")}


def test_peak_windows_cover_every_year(spark):
    windows = seasonality.peak_windows(reference.peak_days(spark), "2026-01-10")
    facts = spark.createDataFrame(
        [(date(2025, 12, 20),), (date(2025, 6, 1),), (date(2025, 6, 10),)], "transaction_date date"
    )
    got = seasonality.sales_in_peaks(facts, windows).groupBy("transaction_date").count().collect()
    # 20 December: three New Year windows of the next year and Christmas Eve of this one.
    assert {r[0].isoformat(): r[1] for r in got} == {"2025-12-20": 4, "2025-06-01": 1}


def test_ema_weighs_the_whole_series(spark):
    rows = [(date(2020, 1, 1) + timedelta(days=i), "k", 1e9 if i == 0 else 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "ngay date, k string, daily_quantity double")
    got = [r[0] for r in features.with_ema(df, ["k"], [3]).orderBy("ngay").select("ema_3_quantity").collect()]
    assert got == pytest.approx([1e9 * 0.5 ** i for i in range(200)], rel=1e-9)


def test_forecast_looks_back_as_far_as_its_lags(spark, history):
    """A lag beyond a month is served from real values, not 0."""
    dense = features.dense_series(history.filter("ma_hang = 'dense'"), KEYS, ["daily_quantity", "daily_revenue"])
    state = forecast.state_of(dense, KEYS, lags=(45,), windows=(40,), spans=())
    row = state.select("hist", *[c.alias(n) for n, c in forecast.step_features((45,), (40,)).items()]).first()
    values = [r[0] for r in dense.orderBy("ngay").select("daily_quantity").collect()]
    assert row.hist == pytest.approx(values[-45:]) and row.lag_45_quantity == pytest.approx(values[-45])
    assert row.rolling_mean_40_quantity == pytest.approx(np.mean(values[-40:]))


def test_recursive_forecast_matches_day_by_day(spark, history):
    """Each step redone from scratch: the longer history through the training features."""
    dense = history.filter("ma_hang = 'dense'")
    shape = {"lags": (1, 7, 14), "windows": (7, 14), "spans": (7,)}
    made = features.make_features(dense, KEYS, "train", **shape)
    wanted = [c for c in features.feature_columns(made) if not c.endswith("_revenue") and c not in ("avg_price", "price_change")]
    model = forecast.train(made, wanted, params={"maxIter": 3, "maxDepth": 3})
    last = date(2024, 1, 1) + timedelta(days=59)
    state = forecast.state_of(dense, KEYS, **shape)
    got = forecast.forecast(model, state, None, str(last), 4, pin_every=2, **shape).orderBy("forecast_date").collect()

    known = dense.select("ngay", *KEYS, "daily_quantity", "daily_revenue", *features.NO_SEASON)
    want = []
    for i in range(1, 5):
        nxt = spark.createDataFrame([(last + timedelta(days=i), "b", "dense", 0.0, 0.0)], "ngay date, chi_nhanh string, ma_hang string, daily_quantity double, daily_revenue double")
        longer = known.unionByName(nxt.withColumns({k: F.lit(v) for k, v in features.NO_SEASON.items()}))
        row = features.make_features(longer, KEYS, "train", **shape).filter(F.col("ngay") == F.lit(last + timedelta(days=i)))
        value = max(0.0, model.transform(row).first().prediction)
        want.append(value)
        known = known.unionByName(
            nxt.withColumn("daily_quantity", F.lit(value)).withColumns({k: F.lit(v) for k, v in features.NO_SEASON.items()})
        )
    assert [r.predicted_quantity_raw for r in got] == pytest.approx(want)
    assert [r.forecast_date for r in got] == [last + timedelta(days=i) for i in range(1, 5)]
    assert all(r.confidence_lower <= r.predicted_quantity_raw <= r.confidence_upper for r in got)


def test_tune_picks_the_lowest_metric(history):
    made = features.make_features(history.filter("ma_hang = 'dense'"), KEYS, "train", lags=(1,), windows=(7,), spans=())
    best, results = forecast.tune(made, ["lag_1_quantity", "rolling_mean_7_quantity", "day_of_week"], trials=2, folds=2,
                                  metric="mae", parallel=2, fixed={"maxIter": 2, "maxDepth": 2})
    assert len(results) == 2 and best == min(results, key=lambda r: r["mae"])["params"]
    assert set(best) == set(forecast.SPACE) | {"maxIter"}
    assert all(r["params"]["maxDepth"] == 2 and r["params"]["maxIter"] == 2 for r in results)


def test_averages_of_a_long_series_with_gaps(spark):
    """20,000 values with nulls, at the start, alone and over whole blocks, against a loop."""
    rng = np.random.default_rng(11)
    values = [None if i < 3 or rng.random() < 0.1 or 500 <= i < 700 else float(v) for i, v in enumerate(rng.integers(0, 90, 20_000))]
    for some in (values, values[:64], values[:65], values[:1], values[4:5], []):
        df = spark.createDataFrame([(some,)], "v array<double>")
        got = df.select(features.running_ema(F.col("v"), 7).alias("e")).first()[0]
        want, mean = [], None
        for v in some:
            mean = v if mean is None else mean if v is None else mean * 0.75 + v * 0.25
            want.append(mean)
        assert [g is None for g in got] == [w is None for w in want]
        assert [g for g in got if g is not None] == pytest.approx([w for w in want if w is not None], rel=1e-12)

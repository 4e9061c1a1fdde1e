"""Training by MdAPE, the search, saved models, and one forecast for all series."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import evaluate, features, forecast

START = date(2024, 1, 1)
KEYS = ["chi_nhanh", "ma_hang"]
SHAPE = {"lags": (1, 7), "windows": (7,), "spans": (7,)}


@pytest.fixture(scope="module")
def shifted(spark):
    """Three groups of rows. On the last days most rows are what one stump says of them, while
    the others need more trees: the median error is least with one, the squared one with many."""
    rows = []
    for i in range(100):
        late = i >= 80
        rows += [(START + timedelta(days=i), 0.0, 28.0 if late else 10.0)] * 6
        rows += [(START + timedelta(days=i), 1.0, 100.0)] * 2 + [(START + timedelta(days=i), 2.0, 1000.0)] * 2
    return spark.createDataFrame(rows, "ngay date, x double, daily_quantity double")


def test_mdape_and_squared_error_choose_differently(shifted):
    params = {"maxIter": 12, "maxDepth": 1, "stepSize": 0.5}
    found = forecast.learn(shifted, ["x"], params=params)
    late = shifted.filter(F.col("ngay") > F.lit(evaluate.holdout_day(shifted)))
    rows = forecast._vectors(shifted, ["x"], "daily_quantity")
    whole = forecast._regressor("daily_quantity", params).fit(rows.filter(F.col("ngay") <= F.lit(evaluate.holdout_day(shifted))))
    assembled = forecast._assembler(["x"]).transform(late)
    y = np.array([r[0] for r in assembled.select("daily_quantity").collect()])
    said = np.cumsum([
        w * np.array([r[0] for r in t.setFeaturesCol("features").setPredictionCol("_p").transform(assembled).select("_p").collect()])
        for t, w in zip(whole.trees, whole.treeWeights)], axis=0)
    median = [np.median(np.abs(np.maximum(p, 0) - y) / y) for p in said]
    squared = [np.mean((p - y) ** 2) for p in said]
    got = {r["trees"]: r["mdape"] for r in forecast.stage_errors(whole, assembled, "daily_quantity").collect()}
    assert [got[i + 1] for i in range(len(said))] == pytest.approx(median)
    assert found.trees == int(np.argmin(median)) + 1 != int(np.argmin(squared)) + 1
    assert found.mdape == pytest.approx(min(median)) and found.last_day == START + timedelta(days=99)
    assert len(found.model.stages[-1].trees) == found.trees


def test_no_positive_day_after_keeps_all_trees(spark):
    rows = [(START + timedelta(days=i), float(i % 3), 5.0 + i % 3 if i < 40 else 0.0) for i in range(50)]
    df = spark.createDataFrame(rows, "ngay date, x double, daily_quantity double")
    found = forecast.learn(df, ["x"], params={"maxIter": 2, "maxDepth": 1})
    assert found.trees == 2 and found.mdape is None


def test_search_plan():
    plan = forecast.search_plan()
    assert [(r.settings, r.folds, r.rounds) for r in plan] == [(50, 1, 6), (17, 2, 12), (6, 3, 25), (2, 5, 50)]
    assert forecast.search_plan(keep=1) == [forecast.Rung(50, 5, 50)]
    assert forecast.search_plan(trials=2, folds=2) == [forecast.Rung(2, 2, 50)]


def test_search_keeps_the_best_of_each_rung(shifted):
    best, scores = forecast.tune(shifted, ["x"], trials=5, folds=2, rounds=4, keep=2, fixed={"maxDepth": 1})
    rungs = [[r for r in scores if r["rung"] == i] for i in range(3)]
    assert [len(r) for r in rungs] == [5, 3, 2]
    for before, after in zip(rungs, rungs[1:]):
        order = sorted(before, key=lambda r: (r["mdape"], r["trial"]))
        assert {r["trial"] for r in after} == {r["trial"] for r in order[:len(after)]}
    last = min(rungs[-1], key=lambda r: (r["mdape"], r["trial"]))
    assert best == last["params"] and best["maxDepth"] == 1


def test_saved_models_are_what_they_were(spark, shifted, tmp_path):
    path = str(tmp_path / "model")
    assert forecast.last_trained(spark, path) is None
    coded = shifted.withColumn("k", F.concat(F.lit("g"), F.col("x").cast("int").cast("string")))
    encoder = features.encode(coded, ["k"])
    before = forecast.learn(shifted, ["x"], params={"maxIter": 3})
    for _ in range(2):  # a second save replaces the first
        forecast.save(spark, before, encoder, path, params={"maxIter": 3})
    after, again, more = forecast.load(spark, path)
    assert more == {"params": {"maxIter": 3}}
    assert (after.trees, after.mdape, after.last_day) == (before.trees, before.mdape, before.last_day)
    said = [m.transform(shifted).select("prediction").collect() for m in (before.model, after.model)]
    assert said[0] == said[1]
    assert forecast.encoded(coded, encoder).collect() == forecast.encoded(coded, again).collect()
    assert forecast.last_trained(spark, path) == START + timedelta(days=99)
    newer = shifted.withColumn("ngay", F.date_add("ngay", 7))
    assert [evaluate.should_retrain(d, after.last_day).first()["retrain"] for d in (shifted, newer)] == [False, True]
    forecast.save(spark, before, None, path)
    assert forecast.load(spark, path)[1] is None


@pytest.fixture(scope="module")
def history(spark):
    rows = []
    for i in range(60):  # warm: daily; and one that is not sold any more
        rows += [("b1", "dense", i, 20.0 + i % 7, "A"), ("b2", "dense", i, 5.0 + i % 3, "A")]
    rows += [("b1", "once", 59, 4.0, "A"), ("b1", "even", 50, 7.0, "B"), ("b1", "even", 59, 7.0, "B"), ("b2", "thin", 0, 1.0, "B"),
             ("b2", "thin", 58, 300.0, "B"), ("b3", "two", 58, 3.0, "B"), ("b3", "two", 59, 9.0, "B"), (None, "once", 59, 4.0, "C")]
    return spark.createDataFrame(
        [(b, m, START + timedelta(days=i), q, 2 * q, c) for b, m, i, q, c in rows],
        "chi_nhanh string, ma_hang string, ngay date, daily_quantity double, daily_revenue double, nhom_hang_cap_1 string",
    ).withColumns({k: F.lit(v) for k, v in features.NO_SEASON.items()})


def test_one_forecast_for_cold_and_warm_series(spark, history):
    made = features.make_features(history, KEYS, **SHAPE)
    wanted = [c for c in features.feature_columns(made) if not c.endswith("_revenue") and c not in ("avg_price", "price_change")]
    trained = forecast.learn(made, wanted, params={"maxIter": 2, "maxDepth": 2})
    state = forecast.state_of(history, KEYS, extra=("nhom_hang_cap_1",), **SHAPE)
    factors = spark.createDataFrame(
        [(3, 2.0, 1.0, 1.0, 0, 0, None, date(2024, 1, 1))],
        "month int, seasonal_factor double, revenue_factor double, quantity_factor double, is_peak_day int, peak_level int, peak_reason string, last_updated date")
    last = START + timedelta(days=59)
    medians = features.category_stats(history)
    got = forecast.forecast_all(trained.model, state, medians, factors, str(last), 5, **SHAPE).collect()
    routed = {(r["chi_nhanh"], r["ma_hang"]): r["reason"] for r in evaluate.cold_start(history, KEYS).collect()}
    assert routed == {("b1", "dense"): None, ("b2", "dense"): None, ("b1", "once"): "uniform", ("b1", "even"): "uniform",
                      ("b2", "thin"): "sparse", ("b3", "two"): None, (None, "once"): "uniform"}
    assert len(got) == 5 * len(routed)
    middle = {r["nhom_hang_cap_1"]: r["median"] for r in medians.collect()}
    for r in got:
        reason = routed[r["chi_nhanh"], r["ma_hang"]]
        assert (r["reason"], r["is_cold_start"]) == (reason, reason is not None)
        raw = r["predicted_quantity_raw"]
        low, high = (0.5, 1.5) if reason else (0.8, 1.2)
        assert raw >= 0 and r["confidence_lower"] == pytest.approx(low * raw) and r["confidence_upper"] == pytest.approx(high * raw)
        if reason:
            level = middle[r["nhom_hang_cap_1"]]
            level = min(level, 50) if reason == "uniform" else level
            assert raw == pytest.approx(level * (2.0 if r["forecast_date"].month == 3 else 1.0))
    assert {r["forecast_date"] for r in got} == {last + timedelta(days=i) for i in range(1, 6)}
    alone = forecast.forecast(trained.model, state.filter("reason IS NULL"), factors, str(last), 5, **SHAPE)
    warm = {(r["chi_nhanh"], r["ma_hang"], r["forecast_date"]): r["predicted_quantity_raw"] for r in alone.collect()}
    assert warm == {
        (r["chi_nhanh"], r["ma_hang"], r["forecast_date"]): r["predicted_quantity_raw"] for r in got if not r["is_cold_start"]}
    none = forecast.forecast_all(trained.model, state.limit(0), medians, factors, str(last), 5, **SHAPE)
    assert none.count() == 0

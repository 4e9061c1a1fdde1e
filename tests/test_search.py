"""The search fits as many models side by side as the cluster has cores for; models share it, and store what they read."""

from datetime import date, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import features, forecast
from shelfwise.plans import forecasting
from shelfwise.sources.canonical import Sources


@pytest.mark.parametrize("cores", [2, 12])
def test_search_fits_two_models_a_core(monkeypatch, cores):
    seen = []

    def tune(made, wanted, **how):
        seen.append(how["parallel"])
        return {}, []

    monkeypatch.setattr(forecasting.forecast, "tune", tune)
    monkeypatch.setattr(forecasting.forecast, "learn", lambda *a, **how: None)
    monkeypatch.setattr(forecasting.forecast, "save", lambda *a, **how: None)
    spark = SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=cores))
    learned = forecasting.Learned(SimpleNamespace(spark=spark), "region")
    learned.__dict__ |= {"training": (None, []), "encoder": None}
    monkeypatch.setattr(forecasting.Learned, "path", "")
    learned.learn()
    assert seen == [2 * cores]


def test_models_that_are_due_are_trained_with_one_search(monkeypatch):
    fresh, calls = set(), []

    def learn(self, found=None):
        calls.append((self.kind, found))

    monkeypatch.setattr(forecasting.Learned, "stale", lambda self: self.kind not in fresh)
    monkeypatch.setattr(forecasting.Learned, "search", lambda self: calls.append(("search", self.kind)) or ({"maxDepth": 3}, [1]))
    monkeypatch.setattr(forecasting.Learned, "learn", learn)
    monkeypatch.setattr(forecasting.Learned, "saved", (None, None, {"params": {"maxDepth": 5}}))
    monkeypatch.setattr(forecasting.Sold, "latest", None)
    s = SimpleNamespace()
    # The product model's setting comes from the search, which is why the searched model is due with it.
    forecasting.train([forecasting.Learned(s, "product")])
    assert calls[0] == ("search", "region")
    assert sorted(calls[1:]) == [("product", ({"maxDepth": 3}, [1])), ("region", ({"maxDepth": 3}, [1]))]
    calls.clear()
    fresh.add("region")
    forecasting.train([forecasting.Learned(s, kind) for kind in ("category", "product", "region")])
    assert sorted(calls) == [("category", ({"maxDepth": 5}, [])), ("product", ({"maxDepth": 5}, []))]
    calls.clear()
    fresh.update(("category", "product"))
    forecasting.train([forecasting.Learned(s, "product")])
    assert not calls


def test_product_rows_hold_what_is_read_only(spark, data):
    rows = forecasting.Learned(Sources(spark, data), "product").rows
    assert set(rows.columns) == {
        "ngay", "chi_nhanh", "ma_hang", "nhom_hang_cap_1", "thuong_hieu", "daily_quantity", "daily_revenue", *features.NO_SEASON}


def test_months_are_looked_up_and_not_stored_with_every_series(spark, monkeypatch):
    stored = []
    pinned = forecast.pinned
    monkeypatch.setattr(forecast, "pinned", lambda df: stored.append(df.columns) or pinned(df))
    rows = [(date(2024, 1, 1) + timedelta(days=i), "k", float(i % 5), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "ngay date, k string, daily_quantity double, daily_revenue double").withColumns(
        {k: F.lit(v) for k, v in features.NO_SEASON.items()})
    shape = {"lags": (1,), "windows": (7,), "spans": ()}
    made = features.make_features(df, ["k"], **shape)
    model = forecast.train(made, ["lag_1_quantity", "seasonal_factor"], params={"maxIter": 2, "maxDepth": 2})
    factors = spark.createDataFrame(
        [(2, 3.0, 1.0, 1.0, 0, 0, None, date(2024, 1, 1))],
        "month int, seasonal_factor double, revenue_factor double, quantity_factor double, is_peak_day int, peak_level int, peak_reason string, last_updated date")
    state = forecast.state_of(df, ["k"], **shape)
    got = [forecast.forecast(model, state, factors, "2024-02-09", 6, pin_every=n, **shape).orderBy("forecast_date").collect() for n in (2, 9)]
    assert got[0] == got[1] and len(got[0]) == 6
    assert len(stored) >= 4 and not any("_months" in columns for columns in stored)

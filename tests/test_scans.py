"""Date bounds that reach the Parquet scan, and weeks found without reading all days."""

from datetime import date

from pyspark.sql import functions as F

from shelfwise.operators import facts
from shelfwise.plans import catalog


def scans(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line]


def test_period_bounds_reach_the_scan(spark, data):
    for name in ("D11_sales_kpi", "D21_last_week_sales"):
        orders = [line for line in scans(catalog.queries()[name](spark, data)) if "o_orderdate" in line]
        assert orders and all("GreaterThanOrEqual(o_orderdate" in line for line in orders), name


def sold(spark, days):
    rows = [(date(2024, 1, d), f"p{d % 2}", 1.0) for d in days]
    return spark.createDataFrame(rows, "transaction_date date, product_code string, quantity_sold double")


def test_weeks_from_recent_days(spark):
    whole = sold(spark, [1, 2, 9, 10, 16, 17])
    recent = whole.filter("transaction_date >= '2024-01-09'")
    want = [(r["week"], r["first_day"], r["last_day"]) for r in facts.week_spans(whole)]
    assert want == [(r["week"], r["first_day"], r["last_day"]) for r in facts.week_spans(whole, recent=recent)]
    # Too few weeks in the recent days: the whole is read.
    short = whole.filter("transaction_date >= '2024-01-16'")
    assert facts.week_spans(whole, recent=short) == facts.week_spans(whole)
    got = {r[0]: r[1] for r in facts.last_week_sales(whole, short).collect()}
    assert got == {"p1": 1.0, "p0": 1.0}
    assert facts.recent_weeks(whole, recent=recent).collect() == facts.recent_weeks(whole).collect()


def test_one_week_and_none(spark):
    single = sold(spark, [9, 10])
    assert {r[0]: r[1] for r in facts.last_week_sales(single).collect()} == {"p0": 1.0, "p1": 1.0}
    empty = single.filter(F.lit(False))
    assert facts.last_week_sales(empty).count() == 0 and facts.recent_weeks(empty).count() == 0

"""Demand statistics do not depend on the order of rows."""

import itertools
from datetime import date, timedelta

import pytest

from shelfwise.operators import inventory

# Deviation over mean is exactly 1 (first) and 0.5 (the others).
ON_A_CUT = {(1, 1, 1, 1, 6): "Erratic", (1, 1, 1, 2, 3): "Variable", (1, 1, 3, 3, 4): "Variable"}


def test_a_ratio_on_a_cut_is_told_alike_in_any_order(spark):
    start, rows, wanted = date(2024, 1, 1), [], {}
    for values, pattern in ON_A_CUT.items():
        for order in sorted(set(itertools.permutations(values))):
            code = "-".join(map(str, order))
            wanted[code] = pattern
            rows += [(start + timedelta(days=i), code, float(v), 2.0 * v) for i, v in enumerate(order)]
    # One partition: a product's rows are summed in the order given.
    movement = spark.createDataFrame(
        rows, "transaction_date date, product_code string, units_sold double, revenue double").coalesce(1)
    got = inventory.inventory_policy(inventory.demand_stats(movement, "2024-01-05")).collect()
    assert {r.product_code: r.demand_pattern for r in got} == wanted


def test_null_units_count_as_days_without_a_value(spark):
    rows = [(date(2024, 1, 1), "a", 2.5, 1.0), (date(2024, 1, 2), "a", None, 1.0), (date(2024, 1, 3), "a", 4.0, 1.0),
            (date(2024, 1, 1), "b", None, 1.0)]
    movement = spark.createDataFrame(rows, "transaction_date date, product_code string, units_sold double, revenue double")
    a, b = sorted(inventory.demand_stats(movement, "2024-01-05").collect())
    assert (a.avg_daily_sales, a.std_daily_sales, a.selling_days) == (3.25, pytest.approx(0.75), 3)
    assert a.sales_velocity == pytest.approx(6.5 / 3)
    assert (b.avg_daily_sales, b.std_daily_sales, b.sales_velocity, b.selling_days) == (None, None, None, 1)

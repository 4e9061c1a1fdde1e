"""Physical plans: no nested loops, no Python workers, filters and columns pushed to the scan."""

import pytest

from shelfwise.plans import catalog

NAMES = (
    "D1_daily_sales", "D2_regular_sales", "D6_product_performance", "D21_sales_28d", "B1_clean_sales",
    "C9_sales_with_products", "C5_sales_in_peaks", "H6_seasonal_factors", "D20_dynamic_percentiles", "I1_dim_product",
    "I8_flag_outliers", "J10_purchase_order", "M12_horizon", "M18_accuracy", "E11_ema", "K6_continuity",
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loops_or_python(spark, data, name):
    plan = plan_of(catalog.queries()[name](spark, data))
    for word in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan


def test_scan_reads_only_what_is_needed(spark, data):
    df = catalog.queries()["D11_sales_kpi"](spark, data)
    scan = [line for line in plan_of(df).splitlines() if "lineitem.parquet" in line]
    assert scan and all("struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in line for line in scan)


def test_lines_are_reduced_before_products_join(spark, data):
    """Products join the aggregate, not the lines: the first aggregate is below that join."""
    plan = plan_of(catalog.queries()["D1_daily_sales"](spark, data)).splitlines()
    part = next(i for i, line in enumerate(plan) if "part.parquet" in line)
    above = [line for line in plan[:part] if "HashAggregate" in line and "partial_sum" in line]
    assert above and "product_code" in above[0]

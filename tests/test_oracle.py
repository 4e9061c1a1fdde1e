"""Registered queries against their SQL. `ALL_QUERIES=1` checks every one of them."""

import os

import pytest

import oracle
from shelfwise.plans import catalog

SOME = (
    "D1_daily_sales", "D2_regular_sales", "D3_promotional_sales", "D4_monthly_sales", "D6_product_performance",
    "D11_sales_kpi", "D17_daily_state", "D21_last_week_sales", "B1_clean_sales", "A3_catalog_csv_round_trip",
    "C9_sales_with_products", "C12_upsert", "I1_dim_product", "I4_abc_rows", "I4_abc_range", "I6_rfm_customers",
    "I8_flag_outliers", "I9_rank_branches", "H1_dim_date", "H6_seasonal_factors", "C10_stock_with_products",
    "J1_inventory_policy", "J10_purchase_order", "K2_failing_rows", "E10_rolling", "E11_ema", "M3_train_features",
    "M8_fold_bounds", "M18_accuracy", "L1_file_stream", "L3_stream_totals", "A6_dated_files", "C13_insert_new",
    "D20_dynamic_percentiles", "F3_recent_weeks", "A15_order_csv",
)
ORACLES = catalog.oracle_sql()
NAMES = list(ORACLES) if os.environ.get("ALL_QUERIES") else [n for n in SOME if n in ORACLES]


@pytest.fixture(scope="module")
def duck(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, data, name):
    assert oracle.differences(catalog.queries()[name](spark, data), duck, ORACLES[name]) == []

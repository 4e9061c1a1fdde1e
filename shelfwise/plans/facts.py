"""Queries over the sales facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import facts
from shelfwise.plans.query import PROMO, query

_DAILY = """
  transaction_date, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
  product_code, product_code AS product_id, branch_code, branch_code AS branch_id,
  line_count AS transaction_count, quantity_sold, gross_revenue, cost AS cost_of_goods_sold,
  gross_revenue - cost AS gross_profit, price_sum / line_count AS avg_selling_price,
  CASE WHEN gross_revenue > 0 THEN (gross_revenue - cost) / gross_revenue ELSE 0 END AS profit_margin
"""
_DAILY_2 = "quantity_sold gross_revenue cost_of_goods_sold gross_profit"


@query(
    "D1_daily_sales", "D1 C1 C2 C3",
    f"answer AS (SELECT {_DAILY} FROM daily)",
    two=_DAILY_2, four="avg_selling_price profit_margin",
)
def daily_sales(s):
    return facts.daily_sales(s.transactions, s.details, s.products, s.branches)


@query(
    "D2_regular_sales", "D2 B19",
    f"""answer AS (SELECT {_DAILY},
          (gross_revenue - cost) / nullif(quantity_sold, 0) AS avg_profit_per_unit,
          0 AS is_promotional_sale, 'regular' AS sale_type FROM regular)""",
    two=_DAILY_2, four="avg_selling_price profit_margin avg_profit_per_unit",
)
def regular_sales(s):
    return facts.regular_sales(s.transactions, s.details, s.products, s.branches, PROMO)


@query(
    "D3_promotional_sales", "D3 B19",
    f"""answer AS (SELECT {_DAILY},
          (gross_revenue - cost) / nullif(quantity_sold, 0) AS avg_profit_per_unit,
          cap_1 AS promotion_category, cap_2 AS promotion_subcategory,
          1 AS is_promotional_sale, 'promotional' AS sale_type
        FROM daily WHERE cap_1 LIKE '%PROMO%')""",
    two=_DAILY_2, four="avg_selling_price profit_margin avg_profit_per_unit",
)
def promotional_sales(s):
    return facts.promotional_sales(s.transactions, s.details, s.products, s.branches, PROMO)


@query(
    "D4_monthly_sales", "D4",
    """answer AS (
      SELECT CAST(date_trunc('month', ngay) AS DATE) AS month,
             CAST(strftime(ngay, '%Y%m') AS INTEGER) AS month_key,
             ma_hang AS product_code, ma_chi_nhanh AS branch_code,
             sum(so_luong) AS monthly_quantity, sum(thanh_tien) AS monthly_revenue,
             sum(von) AS monthly_cost, sum(thanh_tien - von) AS monthly_profit,
             CASE WHEN sum(thanh_tien) > 0 THEN (sum(thanh_tien) - sum(von)) / sum(thanh_tien)
                  ELSE 0.3 END AS avg_profit_margin,
             count(DISTINCT ngay) AS active_days
      FROM lines GROUP BY 1, 2, 3, 4)""",
    two="monthly_quantity monthly_revenue monthly_cost monthly_profit", four="avg_profit_margin",
)
def monthly_sales(s):
    return facts.monthly_sales(s.transactions, s.details, s.products)


@query(
    "D5_daily_sales_seasonal", "D5 H2",
    """answer AS (
      SELECT transaction_date, product_code, branch_code, quantity_sold, gross_revenue,
             CASE WHEN month(transaction_date) = 1 THEN 'Winter'
                  WHEN month(transaction_date) IN (2, 3) THEN 'Spring'
                  WHEN month(transaction_date) IN (4, 5, 6) THEN 'Summer'
                  WHEN month(transaction_date) IN (7, 8, 9) THEN 'Autumn' ELSE 'Winter' END AS season,
             CAST(CASE WHEN isodow(transaction_date) IN (6, 7) THEN 1.2 ELSE 1.0 END AS DOUBLE) AS seasonal_factor,
             0 AS is_peak_day
      FROM daily)""",
    two="quantity_sold gross_revenue",
)
def daily_sales_seasonal(s):
    return facts.daily_sales_seasonal(s.transactions, s.details)


@query(
    "D6_product_performance", "D6",
    """answer AS (
      SELECT ma_hang AS product_code, any_value(ten_hang) AS product_name,
             any_value(thuong_hieu) AS brand, any_value(cap_1) AS category_l1,
             any_value(cap_2) AS category_l2, count(DISTINCT transaction_id) AS total_transactions,
             sum(so_luong) AS total_quantity_sold, sum(so_luong * don_gia) AS total_revenue,
             sum(so_luong * don_gia - von) AS total_profit, avg(don_gia) AS avg_selling_price,
             sum(so_luong * don_gia - von) / sum(so_luong) AS avg_profit_per_unit,
             sum(so_luong * don_gia - von) / sum(so_luong * don_gia) AS profit_margin,
             min(ngay) AS first_sale_date, max(ngay) AS last_sale_date,
             count(DISTINCT ngay) AS selling_days
      FROM lines GROUP BY ma_hang)""",
    two="total_quantity_sold total_revenue total_profit",
    four="avg_selling_price avg_profit_per_unit profit_margin",
)
def product_performance(s):
    return facts.product_performance(s.transactions, s.details, s.products)


@query(
    "D8_sales_daily_by_product", "D8",
    """answer AS (
      SELECT ngay AS transaction_date, ma_hang AS product_code, any_value(ten_hang) AS product_name,
             any_value(thuong_hieu) AS brand, any_value(cap_1) AS category_l1,
             any_value(cap_2) AS category_l2, any_value(cap_3) AS category_l3,
             count(DISTINCT transaction_id) AS transaction_count, sum(so_luong) AS total_quantity,
             sum(so_luong * don_gia) AS total_revenue, sum(von) AS total_cost,
             sum(so_luong * don_gia - von) AS total_profit, avg(don_gia) AS avg_selling_price,
             avg(so_luong) AS avg_quantity_per_transaction
      FROM lines GROUP BY 1, 2)""",
    two="total_quantity total_revenue total_cost total_profit",
    four="avg_selling_price avg_quantity_per_transaction",
)
def sales_daily_by_product(s):
    return facts.sales_daily_by_product(s.transactions, s.details, s.products)


@query(
    "D9_inventory_movement", "D9",
    """answer AS (
      SELECT ngay AS transaction_date, ma_hang AS product_code, sum(so_luong) AS units_sold,
             sum(thanh_tien) AS revenue, sum(von) AS cogs, sum(thanh_tien - von) AS profit,
             count(DISTINCT transaction_id) AS transaction_count
      FROM lines GROUP BY 1, 2)""",
    two="units_sold revenue cogs profit",
)
def inventory_movement(s):
    return facts.inventory_movement(s.transactions, s.details, s.products)


@query(
    "D11_sales_kpi", "D11 G1",
    """spans AS (
      SELECT 'Current Month' AS period, date_trunc('month', d) AS lo, d AS hi FROM newest
      UNION ALL SELECT 'Previous Month', date_trunc('month', d) - INTERVAL 1 MONTH,
                       date_trunc('month', d) - INTERVAL 1 DAY FROM newest
      UNION ALL SELECT 'YTD', date_trunc('year', d), d FROM newest),
    totals AS (
      SELECT period, sum(thanh_tien) AS revenue, sum(so_luong) AS quantity,
             count(DISTINCT transaction_id) AS transactions
      FROM spans LEFT JOIN lines ON ngay BETWEEN lo AND hi GROUP BY period),
    answer AS (
      SELECT *, CASE WHEN transactions > 0 THEN revenue / transactions ELSE 0 END AS avg_transaction_value,
             CASE WHEN quantity > 0 THEN revenue / quantity ELSE 0 END AS avg_unit_price
      FROM totals)""",
    two="revenue quantity", four="avg_transaction_value avg_unit_price",
)
def sales_kpi(s):
    return facts.sales_kpi(facts.daily_totals(s.transactions, s.details), s.as_of)


@query(
    "D12_product_revenue", "D12 C4",
    """answer AS (
      SELECT p.ma_hang AS product_code, p.ten_hang AS product_name, p.cap_1 AS category_level_1,
             p.cap_2 AS category_level_2, p.cap_3 AS category_level_3,
             coalesce(sum(d.thanh_tien), 0) AS total_revenue,
             coalesce(sum(d.so_luong), 0) AS total_quantity, count(DISTINCT t.ngay) AS active_days
      FROM products p LEFT JOIN de d ON p.ma_hang = d.ma_hang LEFT JOIN tx t ON d.transaction_id = t.id
      GROUP BY 1, 2, 3, 4, 5)""",
    two="total_revenue total_quantity",
)
def product_revenue(s):
    return facts.product_revenue(s.transactions, s.details, s.products)


_STATE = """states AS (
      SELECT ngay, ma_chi_nhanh AS chi_nhanh, coalesce(cap_1, '') AS nhom_hang_cap_1,
             coalesce(cap_2, '') AS nhom_hang_cap_2, sum(thanh_tien) AS doanh_thu,
             sum(thanh_tien - von) AS loi_nhuan, sum(so_luong) AS so_luong, count(*) AS so_giao_dich
      FROM lines GROUP BY 1, 2, 3, 4)"""


@query("D17_daily_state", "D17", f"{_STATE}, answer AS (SELECT * FROM states)",
       two="doanh_thu loi_nhuan so_luong")
def daily_state(s):
    """States of an early and a late load merged: equal to one load of everything."""
    early = F.col("ngay") < "1998-01-01"
    return facts.merge_states(
        facts.daily_state(s.transactions.filter(early), s.details, s.products),
        facts.daily_state(s.transactions.filter(~early), s.details, s.products),
    )


def _regular(s, days: int = 0):
    return facts.regular_sales(
        s.transactions, s.details, s.products, s.branches, PROMO, s.as_of if days else None, days
    )


# Monday-first week of year; week 1 has four days of the year.
WEEK = """CAST(floor((dayofyear({0}) - 1 + isodow(date_trunc('year', {0})) - 1) / 7.0)
      + CASE WHEN isodow(date_trunc('year', {0})) <= 4 THEN 1 ELSE 0 END AS INTEGER)"""
_WEEK = WEEK.format("transaction_date")


@query(
    "D21_last_week_sales", "D21 F3",
    f"""weeks AS (SELECT DISTINCT year(transaction_date) * 100 + {_WEEK} AS w FROM regular),
    answer AS (
      SELECT product_code, sum(quantity_sold) AS last_week_sales FROM regular
      WHERE year(transaction_date) * 100 + {_WEEK}
            = (SELECT min(w) FROM (SELECT w FROM weeks ORDER BY w DESC LIMIT 2))
      GROUP BY 1)""",
)
def last_week_sales(s):
    return facts.last_week_sales(_regular(s), _regular(s, 60))


@query(
    "D21_last_seven_days_sales", "D21",
    """answer AS (
      SELECT product_code, sum(quantity_sold) AS last_week_sales FROM regular,
             (SELECT max(transaction_date) AS m FROM regular)
      WHERE transaction_date >= m - 7 AND transaction_date < m GROUP BY 1)""",
)
def last_seven_days_sales(s):
    return facts.last_seven_days_sales(_regular(s))


@query(
    "D21_sales_28d", "D21",
    """answer AS (
      SELECT product_code, sum(quantity_sold) AS sales_4weeks, sum(gross_revenue) AS revenue_4weeks
      FROM regular WHERE transaction_date >= (SELECT d - 28 FROM newest) GROUP BY 1)""",
    two="revenue_4weeks",
)
def sales_28d(s):
    return facts.sales_28d(_regular(s, 28), s.as_of)


@query(
    "D21_weekly_sales", "D21",
    f"""answer AS (
      SELECT product_code, {_WEEK} AS week_num, sum(quantity_sold) AS weekly_sold,
             sum(gross_revenue) AS weekly_revenue
      FROM regular WHERE transaction_date >= (SELECT d - 28 FROM newest) GROUP BY 1, 2)""",
    two="weekly_revenue",
)
def weekly_sales(s):
    return facts.weekly_sales(_regular(s, 28), s.as_of)


@query(
    "D21_daily_units", "D21",
    """answer AS (
      SELECT product_code, transaction_date, sum(quantity_sold) AS daily_sold
      FROM regular WHERE transaction_date >= (SELECT d - 28 FROM newest) GROUP BY 1, 2)""",
)
def daily_units(s):
    return facts.daily_units(_regular(s, 28), s.as_of)


@query(
    "F3_recent_weeks", "F3 G2",
    f"""answer AS (
      SELECT DISTINCT CAST(year(transaction_date) AS INTEGER) AS year, {_WEEK} AS week
      FROM regular ORDER BY 1 DESC, 2 DESC LIMIT 2)""",
)
def recent_weeks(s):
    return facts.recent_weeks(_regular(s), recent=_regular(s, 60))


@query(
    "A13_recent_transactions", "A13 B21",
    """answer AS (
      SELECT t.id, t.ma_giao_dich, t.ngay, t.ma_chi_nhanh, t.ten_chi_nhanh, b.city
      FROM tx t JOIN branches b ON t.ma_chi_nhanh = b.ma_chi_nhanh
      WHERE t.ngay >= (SELECT d - 60 FROM newest))""",
)
def recent_transactions(s):
    return facts.recent_transactions(s.transactions, s.branches, s.as_of)


@query(
    "B20_valid_sales", "B20 C1",
    """answer AS (
      SELECT transaction_id, ngay AS transaction_date, ma_chi_nhanh AS branch_code,
             ma_hang AS product_code, so_luong AS quantity, thanh_tien AS net_amount
      FROM lines WHERE so_luong > 0 AND thanh_tien > 0)""",
    two="net_amount",
)
def valid_sales(s):
    lines = facts.sales_lines(s.transactions, s.details)
    return facts.valid_sales(lines).drop("unit_price")


@query(
    "G2_sold_products", "G2",
    """answer AS (SELECT DISTINCT ma_hang AS product_code, ma_chi_nhanh AS branch_code FROM lines)""",
)
def sold_products(s):
    lines = facts.sales_lines(s.transactions, s.details)
    return lines.select("product_code", "branch_code").distinct()

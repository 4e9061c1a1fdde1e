"""Queries over seasonality, stock, purchasing and data quality."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.operators import facts, inventory, quality, seasonality, staging
from shelfwise.plans.dimensions import RECEIPTS
from shelfwise.plans.facts import WEEK
from shelfwise.plans.query import PROMO, query
from shelfwise.session import pinned, scratch_path
from shelfwise.sources import files, reference


def regular(s, days: int = 0):
    return facts.regular_sales(
        s.transactions, s.details, s.products, s.branches, PROMO, s.as_of if days else None, days
    )


PEAKS = """peaks AS (SELECT * FROM (VALUES
        (1,1,'Tet Nguyen Dan',3,14),(1,2,'Tet Nguyen Dan',3,14),(1,3,'Tet Nguyen Dan',3,14),(2,14,'Valentine',1,1),
        (3,8,'Quoc te Nu',1,1),(4,30,'Gio To',2,7),(5,1,'Quoc te Lao dong',2,7),(6,1,'Quoc te Thieu nhi',1,1),
        (7,1,'Cao diem he',2,7),(8,15,'Back to school',2,7),(9,2,'Thu sang',2,7),(10,20,'Cuoi nam',2,7),
        (11,11,'Black Friday',1,1),(11,29,'Sale cuoi nam',2,7),(12,24,'Giang sinh',2,7),(12,25,'Giang sinh',1,1),
        (12,31,'Countdown',1,1)) v(month, day, peak_reason, peak_level, impact_days)),
    windows AS (
      SELECT p.*, make_date(y, month, day) AS peak_date, CAST(y AS INTEGER) AS peak_year
      FROM peaks p, (SELECT unnest(range(year(d - 365) - 1, year(d) + 2)) AS y FROM newest)),
    recent AS (SELECT * FROM regular WHERE transaction_date >= (SELECT d - 365 FROM newest)),
    base AS (
      SELECT CAST(month(transaction_date) AS INTEGER) AS month,
             CASE WHEN isodow(transaction_date) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
             avg(gross_revenue) AS avg_daily_revenue, avg(quantity_sold) AS avg_daily_quantity,
             count(DISTINCT transaction_date) AS num_days
      FROM recent GROUP BY 1, 2),
    hits AS (
      SELECT r.*, peak_reason, peak_level, impact_days, peak_date, peak_year
      FROM recent r JOIN windows w
        ON transaction_date BETWEEN peak_date - impact_days AND peak_date + impact_days),
    actual AS (
      SELECT CAST(month(transaction_date) AS INTEGER) AS month, peak_reason, peak_level, impact_days,
             avg(gross_revenue) AS actual_avg_revenue, avg(quantity_sold) AS actual_avg_quantity,
             count(DISTINCT transaction_date) AS num_peak_days,
             CASE WHEN count(*) FILTER (isodow(transaction_date) >= 6) * 2 > count(*) THEN 'weekend'
                  ELSE 'weekday' END AS dominant_day_type
      FROM hits GROUP BY 1, 2, 3, 4),
    factors AS (
      SELECT a.month, peak_reason, peak_level, impact_days, actual_avg_revenue, avg_daily_revenue AS baseline_revenue,
             CASE WHEN avg_daily_revenue > 0 THEN round_even(actual_avg_revenue / avg_daily_revenue, 2) ELSE 1 END AS revenue_factor,
             CASE WHEN avg_daily_quantity > 0 THEN round_even(actual_avg_quantity / avg_daily_quantity, 2) ELSE 1 END AS quantity_factor,
             CASE WHEN avg_daily_revenue > 0 AND avg_daily_quantity > 0 THEN round_even(
               (actual_avg_revenue / avg_daily_revenue + actual_avg_quantity / avg_daily_quantity) / 2, 2) ELSE 1 END AS seasonal_factor,
             num_peak_days, day_type AS baseline_day_type, CASE WHEN peak_level > 0 THEN 1 ELSE 0 END AS is_peak_day
      FROM actual a LEFT JOIN base b ON a.month = b.month AND a.dominant_day_type = b.day_type)"""


@query(
    "H5_peak_windows", "H5 A17",
    f"""{PEAKS}, answer AS (
      SELECT peak_reason, peak_level, peak_date, CAST(peak_date - impact_days AS DATE) AS impact_start_date,
             CAST(peak_date + impact_days AS DATE) AS impact_end_date, count(t.id) AS receipts
      FROM windows LEFT JOIN tx t ON t.ngay BETWEEN peak_date - impact_days AND peak_date + impact_days
      GROUP BY ALL)""",
)
def peak_windows(s):
    """Peak windows with the receipts inside each."""
    windows = seasonality.peak_windows(reference.peak_days(s.spark), s.as_of)
    receipts = s.transactions.groupBy(F.col("ngay").alias("transaction_date")).agg(F.count("*").alias("n"))
    inside = seasonality.peak_dates(windows).join(receipts, "transaction_date").groupBy(
        "peak_reason", "peak_level", "peak_date"
    ).agg(F.sum("n").alias("receipts"))
    return windows.join(inside, ["peak_reason", "peak_level", "peak_date"], "left").select(
        "peak_reason", "peak_level", "peak_date", "impact_start_date", "impact_end_date",
        F.coalesce("receipts", F.lit(0)).alias("receipts"),
    )


@query(
    "C5_sales_in_peaks", "C5",
    f"""{PEAKS}, answer AS (
      SELECT transaction_date, product_code, branch_code, quantity_sold, gross_revenue, peak_reason, peak_level, peak_date
      FROM hits)""",
    two="gross_revenue",
)
def sales_in_peaks(s):
    windows = seasonality.peak_windows(reference.peak_days(s.spark), s.as_of)
    return seasonality.sales_in_peaks(regular(s, 365), windows).select(
        "transaction_date", "product_code", "branch_code", "quantity_sold", "gross_revenue",
        "peak_reason", "peak_level", "peak_date",
    )


@query("D14_seasonal_baseline", "D14", f"{PEAKS}, answer AS (SELECT * FROM base)",
       four="avg_daily_revenue avg_daily_quantity")
def seasonal_baseline(s):
    return seasonality.seasonal_baseline(seasonality.per_day(regular(s, 365), s.as_of))


@query("D15_peak_actuals", "D15", f"{PEAKS}, answer AS (SELECT * FROM actual)",
       four="actual_avg_revenue actual_avg_quantity")
def peak_actuals(s):
    windows = seasonality.peak_windows(reference.peak_days(s.spark), s.as_of)
    return seasonality.peak_actuals(seasonality.per_day(regular(s, 365), s.as_of), windows)


def seasonal_factors_of(s):
    return seasonality.seasonal_factors(regular(s, 365), reference.peak_days(s.spark), s.as_of)


@query("H6_seasonal_factors", "H6 C6", f"{PEAKS}, answer AS (SELECT * FROM factors)",
       four="actual_avg_revenue baseline_revenue")
def seasonal_factors(s):
    return seasonal_factors_of(s)


LATEST = """latest AS (
      SELECT month, is_peak_day, peak_reason, peak_level, seasonal_factor, revenue_factor, quantity_factor
      FROM factors QUALIFY row_number() OVER (PARTITION BY month
        ORDER BY peak_level DESC, seasonal_factor DESC, peak_reason DESC) = 1)"""


@query("D16_latest_factors", "D16", f"{PEAKS}, {LATEST}, answer AS (SELECT * FROM latest)")
def latest_factors(s):
    return seasonality.latest_factors(seasonal_factors_of(s))


@query(
    "H7_with_seasonal", "H7",
    f"""{PEAKS}, {LATEST}, answer AS (
      SELECT t.id, t.ngay, coalesce(is_peak_day, 0) AS is_peak_day, coalesce(peak_reason, '') AS peak_reason,
             coalesce(peak_level, 0) AS peak_level, coalesce(seasonal_factor, 1) AS seasonal_factor,
             coalesce(revenue_factor, 1) AS revenue_factor, coalesce(quantity_factor, 1) AS quantity_factor
      FROM tx t LEFT JOIN latest ON month(ngay) = month)""",
)
def with_seasonal(s):
    latest = seasonality.latest_factors(seasonal_factors_of(s))
    return seasonality.with_seasonal(s.transactions.select("id", "ngay"), latest)


_COVER = """CASE WHEN sl_xuat > 0 THEN round(ton_cuoi_ky / sl_xuat, 2) END AS so_ngay_ton_kho,
             CASE WHEN ton_dau_ky > 0 THEN round((ton_cuoi_ky - ton_dau_ky) / ton_dau_ky * 100, 2) END"""


@query(
    "B16_stg_inventory", "B16 J4",
    """answer AS (
      SELECT ma_hang AS product_code, chi_nhanh AS branch_name, snapshot_date AS inventory_date,
             ton_dau_ky AS opening_stock, sl_nhap AS quantity_imported, sl_xuat AS quantity_exported,
             ton_cuoi_ky AS closing_stock, sl_xuat / nullif((ton_dau_ky + ton_cuoi_ky) / 2, 0) AS inventory_turnover,
             ton_cuoi_ky / nullif(sl_xuat / 30, 0) AS days_of_inventory,
             ton_cuoi_ky / nullif(sl_xuat, 0) AS stock_to_sales_ratio
      FROM stock)""",
    four="inventory_turnover days_of_inventory stock_to_sales_ratio",
)
def stg_inventory(s):
    return staging.stg_inventory(s.stock)


@query(
    "C10_stock_with_products", "C10 J2 J3",
    f"""answer AS (
      SELECT s.ma_hang, chi_nhanh, snapshot_date, p.id AS product_id, {_COVER} AS bien_dong_ton_kho_pct,
             CASE WHEN ton_dau_ky + sl_nhap - sl_xuat <> ton_cuoi_ky THEN 'ERROR' ELSE 'OK' END AS consistency_check
      FROM stock s LEFT JOIN products p ON s.ma_vach = p.ma_vach)""",
    four="so_ngay_ton_kho bien_dong_ton_kho_pct",
)
def stock_with_products(s):
    return inventory.stock_with_products(s.stock, s.products).select(
        "ma_hang", "chi_nhanh", "snapshot_date", "product_id", "so_ngay_ton_kho",
        "bien_dong_ton_kho_pct", "consistency_check",
    )


@query(
    "C10_match_counts", "C10",
    """answer AS (
      SELECT count(*) AS total_rows, count(p.id) AS matched_rows, count(*) - count(p.id) AS unmatched_rows
      FROM stock s LEFT JOIN (SELECT * FROM products WHERE cap_1 <> 'SMALL') p ON s.ma_vach = p.ma_vach)""",
)
def match_counts(s):
    listed = s.products.filter(F.col("cap_1") != "SMALL")
    return inventory.match_counts(inventory.stock_with_products(s.stock, listed))


@query(
    "C11_weekly_stock_summary", "C11 J2",
    f"""weekly AS (
      SELECT strftime(ngay, '%G-%V') AS week_year, ma_chi_nhanh AS chi_nhanh, ma_hang, sum(so_luong) AS sl_xuat,
             count(*) * 10.0::DOUBLE AS ton_dau_ky, sum(so_luong) + count(*) AS nhap_trong_ky,
             count(*) * 11.0::DOUBLE AS ton_cuoi_ky, sum(von) AS gia_tri_ton_kho
      FROM lines GROUP BY 1, 2, 3),
    answer AS (
      SELECT week_year, chi_nhanh, w.ma_hang, ten_hang, cap_1, cap_2, cap_3, ton_dau_ky, nhap_trong_ky,
             sl_xuat AS xuat_trong_ky, ton_cuoi_ky, gia_tri_ton_kho, {_COVER} AS tang_truong_ton_kho_pct
      FROM weekly w LEFT JOIN products p USING (ma_hang))""",
    two="gia_tri_ton_kho", four="so_ngay_ton_kho tang_truong_ton_kho_pct",
)
def weekly_stock_summary(s):
    """Weekly stock with ten units per line at the start and one more at the end."""
    lines = facts.sales_lines(s.transactions, s.details)
    d = F.col("transaction_date")
    # The ISO week belongs to the year of its Thursday.
    thursday = F.date_add(d, 3 - F.weekday(d))
    week = F.concat(F.year(thursday), F.lit("-"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))
    weekly = (
        lines.groupBy(week.alias("week_year"), F.col("branch_code").alias("chi_nhanh"),
                      F.col("product_code").alias("ma_hang"))
        .agg(F.sum("quantity").alias("xuat_trong_ky"), F.count("*").cast("double").alias("n"))
        .join(s.products.select("ma_hang", "gia_von_mac_dinh"), "ma_hang", "left")
        .select(
            "week_year", "chi_nhanh", "ma_hang", "xuat_trong_ky",
            (F.col("n") * 10).alias("ton_dau_ky"), (F.col("xuat_trong_ky") + F.col("n")).alias("nhap_trong_ky"),
            (F.col("n") * 11).alias("ton_cuoi_ky"),
            (F.col("xuat_trong_ky") * F.col("gia_von_mac_dinh")).alias("gia_tri_ton_kho"),
        )
    )
    return inventory.weekly_stock_summary(weekly, s.products)


@query(
    "C16_latest_stock", "C16",
    """days AS (SELECT ma_hang, snapshot_date, sum(ton_cuoi_ky) AS closing FROM stock GROUP BY 1, 2),
    answer AS (
      SELECT ma_hang, max_by(closing, snapshot_date) AS current_stock FROM days GROUP BY 1)""",
)
def latest_stock(s):
    return inventory.latest_stock(s.stock)


@query(
    "C16_recent_stock", "C16",
    """days AS (
      SELECT ma_hang, chi_nhanh, snapshot_date, sum(ton_cuoi_ky) AS closing FROM stock
      WHERE snapshot_date >= (SELECT d - 60 FROM newest) GROUP BY ALL),
    answer AS (
      SELECT ma_hang, chi_nhanh, max_by(closing, snapshot_date) AS current_stock FROM days GROUP BY 1, 2)""",
)
def recent_stock(s):
    return inventory.latest_stock(s.stock, ("ma_hang", "chi_nhanh"), s.as_of, 60)


@query(
    "D23_stock_by_branch", "D23",
    """answer AS (
      SELECT snapshot_date, chi_nhanh, count(*) AS products, sum(ton_cuoi_ky) AS total_closing FROM stock GROUP BY 1, 2)""",
)
def stock_by_branch(s):
    return inventory.stock_by_branch(s.stock)


@query(
    "D24_inventory_facts", "D24",
    """answer AS (
      SELECT snapshot_date, ma_hang AS product_code, chi_nhanh AS branch_code, sum(ton_dau_ky) AS total_opening_stock,
             sum(sl_nhap) AS total_imported, sum(sl_xuat) AS total_exported, sum(ton_cuoi_ky) AS total_closing_stock,
             avg(sl_xuat / nullif((ton_dau_ky + ton_cuoi_ky) / 2, 0)) AS avg_turnover_rate,
             avg(ton_cuoi_ky / nullif(sl_xuat / 30, 0)) AS avg_days_inventory
      FROM stock GROUP BY 1, 2, 3)""",
    four="avg_turnover_rate avg_days_inventory",
)
def inventory_facts(s):
    return inventory.inventory_facts(staging.stg_inventory(s.stock))


DEMAND = """movement AS (
      SELECT ngay, ma_hang, sum(so_luong) AS u, sum(thanh_tien) AS r FROM lines
      WHERE ngay >= (SELECT d - 90 FROM newest) GROUP BY 1, 2),
    demand AS (
      SELECT ma_hang AS product_code, avg(u) AS avg_daily_sales, stddev_pop(u) AS std_daily_sales, max(u) AS max_daily_sales,
             quantile_cont(u, 0.95) AS p95_daily_sales, avg(r) AS avg_daily_revenue, sum(r) AS total_revenue,
             count(*) AS selling_days, min(ngay) AS first_sale, max(ngay) AS last_sale, sum(u) / count(*) AS sales_velocity
      FROM movement GROUP BY 1)"""


def demand_of(s):
    lines = facts.sales_lines(s.transactions, s.details, s.as_of, 90)
    movement = lines.groupBy("transaction_date", "product_code").agg(
        F.sum("quantity").alias("units_sold"), F.sum("net_amount").alias("revenue")
    )
    return inventory.demand_stats(movement, s.as_of)


@query("D10_demand_stats", "D10", f"{DEMAND}, answer AS (SELECT * FROM demand)", two="total_revenue",
       four="avg_daily_sales std_daily_sales p95_daily_sales avg_daily_revenue sales_velocity")
def demand_stats(s):
    return demand_of(s)


@query(
    "J1_inventory_policy", "J1 I11 I12",
    f"""{DEMAND}, answer AS (
      SELECT product_code, sales_velocity,
             CAST(ceil((avg_daily_sales + 1.65 * coalesce(std_daily_sales, 0)) * sqrt(7)) AS BIGINT) AS suggested_safety_stock,
             CAST(ceil(avg_daily_sales * 14) AS BIGINT) AS suggested_reorder_point,
             CAST(ceil(sqrt(2 * avg_daily_sales * 30 * 100 / CAST(0.1 AS DOUBLE))) AS BIGINT) AS suggested_order_quantity,
             CASE WHEN sales_velocity >= 10 THEN 'Fast' WHEN sales_velocity >= 3 THEN 'Medium'
                  WHEN sales_velocity > 0 THEN 'Slow' ELSE 'Dead' END AS velocity_class,
             CASE WHEN std_daily_sales / nullif(avg_daily_sales, 0) < 0.5 THEN 'Stable'
                  WHEN std_daily_sales / nullif(avg_daily_sales, 0) < 1.0 THEN 'Variable' ELSE 'Erratic' END AS demand_pattern
      FROM demand)""",
    four="sales_velocity",
)
def inventory_policy(s):
    return inventory.inventory_policy(demand_of(s)).select(
        "product_code", "sales_velocity", "suggested_safety_stock", "suggested_reorder_point",
        "suggested_order_quantity", "velocity_class", "demand_pattern",
    )


# A naive forecast, the mean of 60 days per day of a 14-day horizon, feeds the order rules.
ORDERS = f"""month_sales AS (
      SELECT ma_hang, any_value(ten_hang) AS ten_san_pham, any_value(cap_1) AS nhom_hang_cap_1, sum(so_luong) AS q
      FROM lines WHERE ngay >= (SELECT d - 60 FROM newest) GROUP BY 1),
    fc AS (
      SELECT CAST(d + h AS DATE) AS forecast_date, ma_hang, ten_san_pham, nhom_hang_cap_1,
             CASE WHEN q >= 50 THEN 'A' WHEN q >= 20 THEN 'B' ELSE 'C' END AS abc_class, q / 60 AS predicted_quantity
      FROM month_sales, newest, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS h)),
    fs AS (
      SELECT ma_hang, round(sum(predicted_quantity), 6) AS forecast_units, count(DISTINCT forecast_date) AS horizon_days,
             min(ten_san_pham) AS ten_san_pham, min(nhom_hang_cap_1) AS nhom_hang_cap_1, min(abc_class) AS abc_class
      FROM fc GROUP BY 1),
    r28 AS (SELECT * FROM regular WHERE transaction_date >= (SELECT d - 28 FROM newest)),
    day_units AS (SELECT product_code, transaction_date, sum(quantity_sold) AS u FROM r28 GROUP BY 1, 2),
    week_units AS (
      SELECT product_code, {WEEK.format('transaction_date')} AS w, sum(quantity_sold) AS u, sum(gross_revenue) AS r
      FROM r28 GROUP BY 1, 2),
    safety AS (
      SELECT ma_hang AS product_code, ton_nho_nhat AS min_stock, mx AS max_daily, av AS avg_daily,
             CASE WHEN coalesce(n, 0) >= 2 THEN greatest(0, round_even(mx * 14 - av * 10, 0))
                  ELSE round_even(ton_nho_nhat * 0.5::DOUBLE, 0) END AS safety_stock
      FROM products LEFT JOIN (SELECT product_code, max(u) AS mx, avg(u) AS av, count(*) AS n FROM day_units GROUP BY 1) d
        ON ma_hang = product_code),
    optimal AS (
      SELECT ma_hang AS product_code, coalesce(round_even(m + ton_nho_nhat * 0.75::DOUBLE, 0), 0) AS optimal_stock,
             coalesce(q, 0) AS quantity_sold, coalesce(r, 0) AS revenue
      FROM products LEFT JOIN (SELECT product_code, median(u) AS m, sum(u) AS q, sum(r) AS r FROM week_units GROUP BY 1) w
        ON ma_hang = product_code),
    now_stock AS (
      SELECT ma_hang, max_by(closing, snapshot_date) AS current_stock
      FROM (SELECT ma_hang, snapshot_date, sum(ton_cuoi_ky) AS closing FROM stock GROUP BY 1, 2) GROUP BY 1),
    seven AS (
      SELECT product_code, sum(quantity_sold) AS last_week_sales FROM r28,
             (SELECT max(transaction_date) AS m FROM r28)
      WHERE transaction_date >= m - 7 AND transaction_date < m GROUP BY 1),
    needs AS (
      SELECT fs.*, coalesce(last_week_sales, 0) AS last_week_sales, coalesce(current_stock, 0) AS current_stock,
             round_even(greatest(0, forecast_units * 1.5 - coalesce(last_week_sales, 0) - coalesce(current_stock, 0)), 0) AS suggested_order
      FROM fs LEFT JOIN seven ON product_code = ma_hang LEFT JOIN now_stock USING (ma_hang))"""

MIN_DAYS = 2  # Series of the test tables are sparse.


class Orders:
    """Inputs of the order rules, built on the naive forecast."""

    def __init__(self, s):
        self.s = s

    @cached_property
    def recent(self):
        """Read by several rules, so fixed once, and only where a rule asks for it."""
        return pinned(regular(self.s, 28))

    @cached_property
    def stock(self):
        return inventory.latest_stock(self.s.stock)

    @property
    def forecasts(self):
        s = self.s
        lines = facts.sales_lines(s.transactions, s.details, s.as_of, 60)
        sold = lines.groupBy(F.col("product_code").alias("ma_hang")).agg(F.sum("quantity").alias("q"))
        names = s.products.select(
            "ma_hang", F.col("ten_hang").alias("ten_san_pham"), F.col("cap_1").alias("nhom_hang_cap_1")
        )
        days = F.sequence(F.date_add(s.as_of, 1), F.date_add(s.as_of, 14))
        return sold.join(names, "ma_hang", "left").select(
            F.explode(days).alias("forecast_date"), "ma_hang", "ten_san_pham", "nhom_hang_cap_1",
            rules.bands(F.col("q"), [(50, "A"), (20, "B")], "C").alias("abc_class"),
            (F.col("q") / 60).alias("predicted_quantity"),
        )

    @property
    def summary(self):
        rounded = F.round("forecast_units", 6)
        return inventory.forecast_summary(self.forecasts).withColumn("forecast_units", rounded)

    @property
    def safety(self):
        daily = facts.daily_units(self.recent, self.s.as_of)
        return inventory.safety_stock(daily, self.s.products, min_days=MIN_DAYS)

    @property
    def optimal(self):
        return inventory.optimal_stock(facts.weekly_sales(self.recent, self.s.as_of), self.s.products)

    @property
    def needs(self):
        return inventory.order_needs(
            self.summary, facts.last_seven_days_sales(self.recent), self.stock
        )


@query("D22_forecast_summary", "D22", f"{ORDERS}, answer AS (SELECT * FROM fs)", four="forecast_units")
def forecast_summary(s):
    return Orders(s).summary


@query("J5_safety_stock", "J5", f"{ORDERS}, answer AS (SELECT * FROM safety)", four="avg_daily")
def safety_stock(s):
    return Orders(s).safety


@query("J6_optimal_stock", "J6", f"{ORDERS}, answer AS (SELECT * FROM optimal)", two="revenue")
def optimal_stock(s):
    return Orders(s).optimal


@query(
    "J7_recommendations", "J7",
    f"""{ORDERS}, answer AS (
      SELECT ma_hang AS product_code, forecast_units AS predicted_units, forecast_units / horizon_days AS avg_daily_demand,
             CAST(coalesce(min_stock, 0) AS DOUBLE) AS min_stock, coalesce(safety_stock, 0) AS recommended_safety_stock,
             round_even(forecast_units / horizon_days * 14, 0) AS reorder_point,
             CASE WHEN safety_stock < min_stock THEN min_stock - safety_stock
                  ELSE round_even(forecast_units / horizon_days * 14, 0) END AS suggested_order_quantity,
             CASE WHEN safety_stock < min_stock THEN 'gap to minimum' ELSE 'two weeks of demand' END AS order_logic,
             CASE WHEN round(coalesce(current_stock, 0) - forecast_units / horizon_days * 7 - coalesce(safety_stock, 0), 6) < 0
                  THEN 'High' ELSE 'Normal' END AS reorder_urgency
      FROM fs LEFT JOIN safety ON ma_hang = product_code LEFT JOIN now_stock USING (ma_hang))""",
    four="predicted_units avg_daily_demand",
)
def recommendations(s):
    orders = Orders(s)
    return inventory.recommendations(orders.summary, orders.safety, orders.stock)


@query(
    "J8_order_needs", "J8",
    f"""{ORDERS}, answer AS (
      SELECT ma_hang, forecast_units, last_week_sales, current_stock, suggested_order FROM needs)""",
    four="forecast_units",
)
def order_needs(s):
    """The needs of all products."""
    return Orders(s).needs.select("ma_hang", "forecast_units", "last_week_sales", "current_stock", "suggested_order")


@query(
    "J9_active_candidates", "J9",
    f"""{ORDERS}, answer AS (
      SELECT ma_hang, abc_class, forecast_units, coalesce(u, 0) AS sales_4weeks
      FROM fs LEFT JOIN (SELECT product_code, sum(u) AS u FROM day_units GROUP BY 1) ON ma_hang = product_code
      WHERE abc_class IN ('B', 'C') OR coalesce(u, 0) > 0)""",
    four="forecast_units",
)
def active_candidates(s):
    orders = Orders(s)
    sold = facts.sales_28d(orders.recent, s.as_of)
    return inventory.active_candidates(orders.summary, sold).select(
        "ma_hang", "abc_class", "forecast_units", "sales_4weeks"
    )


_ORDER_SQL = f"""{ORDERS}, listed AS (
      SELECT n.*, optimal_stock, quantity_sold, round(revenue, 2) AS revenue, min_stock, safety_stock, ma_vach, ten_hang,
             CASE WHEN gia_von_mac_dinh > 0 THEN (gia_ban_mac_dinh - gia_von_mac_dinh) / gia_von_mac_dinh * 100 ELSE 0 END AS margin
      FROM needs n LEFT JOIN optimal o ON o.product_code = ma_hang LEFT JOIN safety s ON s.product_code = ma_hang
           LEFT JOIN products p USING (ma_hang)
      ORDER BY suggested_order DESC, quantity_sold DESC, round(revenue, 2) DESC, ma_hang LIMIT 50),
    marked AS (SELECT *, quantile_cont(revenue, 0.8) OVER () AS cut FROM listed),
    answer AS (
      SELECT ma_hang, ma_vach, ten_hang AS ten_san_pham, suggested_order AS luong_can_nhap, optimal_stock AS ton_kho_toi_uu,
             safety_stock AS ton_an_toan, optimal_stock + safety_stock AS tong_muc_tieu, min_stock AS ton_nho_nhat,
             current_stock AS ton_hien_tai, round_even(forecast_units, 0) AS du_bao, quantity_sold AS da_ban_4tuan,
             round_even(revenue, 0) AS doanh_thu_4tuan, round_even(margin, 1) AS margin_pct,
             CASE WHEN suggested_order > current_stock * 2 THEN 'urgent' WHEN suggested_order > 0 THEN 'needed'
                  ELSE 'enough' END AS uu_tien,
             CASE WHEN margin > 20 AND revenue >= cut THEN 'HIGH MARGIN + HIGH VALUE' WHEN margin > 20 THEN 'HIGH MARGIN'
                  WHEN revenue >= cut THEN 'HIGH VALUE' ELSE '' END AS ghi_chu,
             CAST(row_number() OVER (ORDER BY suggested_order DESC, quantity_sold DESC, revenue DESC, ma_hang) AS INTEGER) AS stt
      FROM marked)"""


@query("J10_purchase_order", "J10 F5", _ORDER_SQL, two="doanh_thu_4tuan")
def purchase_order(s):
    o = Orders(s)
    return inventory.purchase_order(o.needs, o.optimal, o.safety, s.products)


@query("A15_order_csv", "A15", _ORDER_SQL, two="doanh_thu_4tuan")
def order_csv(s):
    """The purchase order, written as CSV and read back."""
    made, path = purchase_order(s), scratch_path(s.spark, "order")
    files.write_purchase_order(made, path)
    return files.read_purchase_order(s.spark, path, made.schema)


@query(
    "J11_order_list", "J11 J12",
    f"""{ORDERS}, answer AS (
      SELECT ma_hang, ten_hang, ma_vach, suggested_order AS so_luong,
             CAST(ceil(suggested_order / quy_doi) * quy_doi AS DOUBLE) AS so_luong_theo_quy_doi
      FROM needs LEFT JOIN products USING (ma_hang) WHERE suggested_order > 0)""",
)
def order_list(s):
    return inventory.order_list(Orders(s).needs, s.products)


@query(
    "J13_trends", "J13",
    f"""{ORDERS}, t AS (SELECT ma_hang, forecast_units / horizon_days * 7 AS weekly_forecast, last_week_sales FROM needs),
    p AS (SELECT *, CASE WHEN last_week_sales > 0 THEN (weekly_forecast - last_week_sales) / last_week_sales * 100
                         WHEN weekly_forecast > 0 THEN 100 ELSE 0 END AS trend_pct FROM t),
    answer AS (SELECT *, CASE WHEN trend_pct > 5 THEN 'up' WHEN trend_pct < -5 THEN 'down' ELSE 'stable' END AS trend FROM p)""",
    four="weekly_forecast trend_pct",
)
def trends(s):
    return inventory.trends(Orders(s).needs)


@query(
    "J14_category_share", "J14",
    f"""{ORDERS}, c AS (
      SELECT nhom_hang_cap_1, sum(predicted_quantity) AS quantity FROM fc GROUP BY 1),
    p AS (SELECT *, quantity / sum(quantity) OVER () * 100 AS percentage FROM c),
    answer AS (SELECT *, CASE WHEN percentage >= 30 THEN 'high' WHEN percentage >= 20 THEN 'raised'
                              WHEN percentage >= 10 THEN 'medium' ELSE 'low' END AS band FROM p)""",
    four="quantity percentage",
)
def category_share(s):
    return inventory.category_share(Orders(s).forecasts)


@query(
    "K1_checks", "K1",
    """answer AS (
      SELECT 'not_null:l_partkey' AS rule, count(*) FILTER (l_partkey IS NULL) AS failures FROM lineitem
      UNION ALL SELECT 'not_null:l_shipdate', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
      UNION ALL SELECT 'unique:l_orderkey', count(l_orderkey) - count(DISTINCT l_orderkey) FROM lineitem)""",
)
def checks(s):
    return quality.check(s.table("lineitem"), ["l_partkey", "l_shipdate"], ["l_orderkey"])


@query(
    "K2_failing_rows", "K2",
    f"""{RECEIPTS}, r AS (SELECT *, CASE WHEN revenue > 0 THEN gross_profit / revenue ELSE 0 END AS margin FROM receipts),
    answer AS (
      SELECT transaction_id, 'positive_value' AS rule FROM r WHERE round(gross_profit, 2) < 0
      UNION ALL SELECT transaction_id, 'profit_margin_range' FROM r WHERE margin < -1 OR margin > 1
      UNION ALL SELECT transaction_id, 'not_future_date' FROM r WHERE transaction_date > (SELECT d - 30 FROM newest)
      UNION ALL SELECT transaction_id, 'transaction_consistency' FROM r WHERE abs(gross_amount - discount_amount - revenue) > 0.01)""",
)
def failing_rows(s):
    """Receipts against the four rules; the last 30 days count as the future."""
    receipts = staging.stg_transactions(s.transactions, s.details, s.products).withColumns({
        "margin": rules.ratio_or(F.col("gross_profit"), F.col("revenue")),
        "gross_profit": F.round("gross_profit", 2),
    })
    return quality.failing_rows(receipts, {
        "positive_value": quality.positive_value("gross_profit"),
        "profit_margin_range": quality.profit_margin_range("margin"),
        "not_future_date": quality.not_future_date("transaction_date", F.date_sub(s.as_of, 30)),
        "transaction_consistency": quality.transaction_consistency("gross_amount", "discount_amount", "revenue"),
    }).select("transaction_id", "rule")


@query(
    "K3_table_profile", "K3",
    """answer AS (
      SELECT 'transactions' AS table_name, count(*) AS rows, min(ngay) AS first_day, max(ngay) AS last_day,
             count(DISTINCT ngay) AS days, count(DISTINCT ma_chi_nhanh) AS branches FROM tx
      UNION ALL
      SELECT 'stock', count(*), min(snapshot_date), max(snapshot_date), count(DISTINCT snapshot_date),
             count(DISTINCT chi_nhanh) FROM stock)""",
)
def table_profile(s):
    return quality.table_profile(s.transactions, "transactions", "ngay", "ma_chi_nhanh").unionByName(
        quality.table_profile(s.stock, "stock", "snapshot_date", "chi_nhanh")
    )


@query(
    "K4_reconcile", "K4",
    """answer AS (
      SELECT 'transactions' AS table_name, count(*) AS source_rows, count(*) FILTER (ngay < DATE '1998-01-01') AS target_rows,
             count(*) FILTER (ngay < DATE '1998-01-01') / count(*) * 100 AS sync_pct FROM tx
      UNION ALL SELECT 'products', count(*), count(*), 100 FROM products)""",
    four="sync_pct",
)
def reconcile(s):
    early = s.transactions.filter(F.col("ngay") < "1998-01-01")
    return quality.reconcile(
        {"transactions": s.transactions, "products": s.products},
        {"transactions": early, "products": s.products},
    )


@query(
    "K5_forecast_profile", "K5 F6",
    f"""{ORDERS}, answer AS (
      SELECT nhom_hang_cap_1 AS model, count(*) AS rows, min(forecast_date) AS first_day, max(forecast_date) AS last_day,
             count(DISTINCT ma_hang) AS products, sum(predicted_quantity) AS total_quantity,
             avg(predicted_quantity) AS avg_quantity FROM fc GROUP BY 1)""",
    four="total_quantity avg_quantity",
)
def forecast_profile(s):
    """One naive model per category."""
    return quality.forecast_profile(Orders(s).forecasts.withColumnRenamed("nhom_hang_cap_1", "model"))


@query(
    "K6_continuity", "K6",
    """per_day AS (SELECT ngay, count(*) AS n FROM tx GROUP BY 1),
    t AS (SELECT min(ngay) AS a, max(ngay) AS b, count(*) AS k, avg(n) AS m FROM per_day),
    answer AS (
      SELECT a AS first_day, b AS last_day, CAST(b - a + 1 AS BIGINT) AS expected_days, k AS actual_days,
             CAST(b - a + 1 - k AS BIGINT) AS missing_days, (b - a + 1 - k) / (b - a + 1) * 100 AS missing_pct,
             m AS avg_rows_per_day, (SELECT count(*) FROM per_day WHERE n < m * 0.5::DOUBLE) AS sparse_days,
             CASE WHEN k < 14 THEN 'too short' WHEN k < 30 THEN 'short' ELSE 'enough' END AS history_level,
             (b - a + 1 - k) / (b - a + 1) > 0.2 AS too_many_missing FROM t)""",
    four="missing_pct avg_rows_per_day",
)
def continuity(s):
    return quality.continuity(s.transactions, "ngay")


@query(
    "K8_alert_level", "K8",
    """per_branch AS (
      SELECT ma_chi_nhanh AS branch_code, count(*) FILTER (so_luong = 1) AS cold_start_count,
             count(*) FILTER (chiet_khau = 0) / count(*) * 100 AS missing_data_pct,
             CAST(0 AS BIGINT) AS zero_predictions,
             CAST((SELECT d FROM newest) - max(ngay) AS INTEGER) AS data_age_days
      FROM lines GROUP BY 1),
    answer AS (
      SELECT *, CASE WHEN missing_data_pct > 20 OR zero_predictions > 0 OR data_age_days > 2 THEN 'error'
                     WHEN cold_start_count > 0 OR missing_data_pct > 5 OR data_age_days > 1 THEN 'warning' ELSE 'info' END AS alert_level
      FROM per_branch)""",
    four="missing_data_pct",
)
def alert_level(s):
    """Sales quality per branch: single pieces as cold starts, undiscounted lines as missing."""
    lines = s.details.join(s.transactions, F.col("transaction_id") == F.col("id"))
    per_branch = lines.groupBy(F.col("ma_chi_nhanh").alias("branch_code")).agg(
        F.count_if(F.col("so_luong") == 1).alias("cold_start_count"),
        (F.count_if(F.col("chiet_khau") == 0) / F.count("*") * 100).alias("missing_data_pct"),
        F.lit(0).cast("bigint").alias("zero_predictions"),
        F.datediff(s.as_of, F.max("ngay")).alias("data_age_days"),
    )
    return quality.with_alert_level(per_branch)


@query(
    "K11_price_coverage", "K11",
    """answer AS (
      SELECT 'products' AS scope, count(*) AS rows, count(*) FILTER (gia_ban_mac_dinh > 0) AS priced,
             count(*) FILTER (gia_ban_mac_dinh > 0) * 100.0 / count(*) AS coverage_pct FROM products
      UNION ALL SELECT 'lines', count(*), count(*) FILTER (don_gia > 0), count(*) FILTER (don_gia > 0) * 100.0 / count(*) FROM de)""",
    four="coverage_pct",
)
def price_coverage(s):
    return quality.price_coverage(s.products, s.details)

"""Queries over staging, calendar, dimensions and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import dates, rules, text
from shelfwise.operators import calendar, classify, dimensions, facts, staging
from shelfwise.plans.facts import WEEK
from shelfwise.plans.query import PROMO, query
from shelfwise.session import scratch_path
from shelfwise.sources import reference

PRICE_CUTS = (980, 950, 920)


@query(
    "B10_stg_products", "B10",
    """answer AS (
      SELECT id AS product_id, ma_hang AS product_code, ma_vach AS barcode, ten_hang AS product_name,
             thuong_hieu AS brand, cap_1 AS category_level_1, cap_2 AS category_level_2,
             cap_3 AS category_level_3, gia_von_mac_dinh AS default_cost_price,
             gia_ban_mac_dinh AS default_selling_price, quy_doi,
             CASE WHEN gia_ban_mac_dinh > 0 THEN (gia_ban_mac_dinh - gia_von_mac_dinh) / gia_ban_mac_dinh
                  ELSE 0 END AS default_margin_rate
      FROM products)""",
    two="default_cost_price", four="default_margin_rate",
)
def stg_products(s):
    return staging.stg_products(s.products)


RECEIPTS = """receipts AS (
      SELECT t.id AS transaction_id, t.ma_giao_dich AS transaction_code, t.ma_chi_nhanh AS branch_id,
             t.ma_chi_nhanh AS branch_code, t.ten_chi_nhanh AS branch_name, t.ngay AS transaction_date,
             t.ma_khach, coalesce(g, 0) AS gross_amount, coalesce(k, 0) AS discount_amount,
             coalesce(r, 0) AS revenue, coalesce(c, 0) AS total_cost, coalesce(n, 0) AS line_count,
             coalesce(r, 0) - coalesce(c, 0) AS gross_profit
      FROM tx t LEFT JOIN (
        SELECT transaction_id, sum(so_luong * don_gia) AS g, sum(chiet_khau) AS k, sum(thanh_tien) AS r,
               sum(von) AS c, count(*) AS n FROM lines GROUP BY 1) m ON t.id = m.transaction_id)"""


def _receipts(s, days: int = 0):
    return staging.stg_transactions(s.transactions, s.details, s.products, s.as_of if days else None, days)


@query(
    "B11_stg_transactions", "B11", f"{RECEIPTS}, answer AS (SELECT * FROM receipts)",
    two="gross_amount revenue total_cost gross_profit", four="discount_amount",
)
def stg_transactions(s):
    return _receipts(s)


@query(
    "B12_stg_transaction_details", "B12",
    """answer AS (
      SELECT transaction_id, ma_hang AS product_code, ten_hang AS product_name, thuong_hieu AS brand,
             cap_1 AS category_l1, cap_2 AS category_l2, cap_3 AS category_l3, so_luong AS quantity,
             don_gia AS unit_price, chiet_khau AS discount_amount, thanh_tien AS line_total,
             so_luong * don_gia AS line_revenue, von AS line_cost, so_luong * don_gia - von AS line_profit,
             ma_chi_nhanh AS branch_code, ngay AS transaction_date
      FROM lines)""",
    two="line_total line_revenue line_cost line_profit", four="unit_price discount_amount",
)
def stg_transaction_details(s):
    return staging.stg_transaction_details(s.details, s.products, s.transactions).drop("tax_amount")


@query(
    "B13_stg_transactions_enriched", "B13",
    """answer AS (
      SELECT ma_giao_dich AS transaction_id, ma_chi_nhanh AS branch_code, ten_chi_nhanh AS branch_name,
             ngay AS transaction_date, CAST(strftime(ngay, '%Y%m%d') AS INTEGER) AS date_key,
             CAST(year(ngay) AS INTEGER) AS year, CAST(month(ngay) AS INTEGER) AS month,
             CAST(isodow(ngay) AS INTEGER) AS day_of_week, CAST(quarter(ngay) AS INTEGER) AS quarter,
             CASE WHEN isodow(ngay) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend
      FROM tx)""",
)
def stg_transactions_enriched(s):
    return staging.stg_transactions_enriched(s.transactions)


@query(
    "B14_stg_product_variant", "B14",
    r"""named AS (
      SELECT p_partkey, p_retailprice, p_name || ' ' || CAST(p_size AS VARCHAR) || ' '
             || CASE p_type WHEN 'LARGE' THEN 'kg' WHEN 'SMALL' THEN 'G' WHEN 'MEDIUM' THEN 'ml'
                            WHEN 'PROMO' THEN 'L' ELSE '' END AS name
      FROM part),
    found AS (
      SELECT *, regexp_extract(lower(name), '(\d+(?:\.\d+)?)\s*(kg|ml|g|l)$', 1) AS n,
             regexp_extract(lower(name), '(\d+(?:\.\d+)?)\s*(kg|ml|g|l)$', 2) AS u FROM named),
    answer AS (
      SELECT p_partkey AS product_id, CAST(p_partkey AS VARCHAR) AS product_code, name AS clean_name,
             n || u AS weight, u AS unit,
             CASE WHEN u = '' THEN 0 ELSE CAST(n AS DOUBLE) END
               * CASE WHEN u IN ('kg', 'l') THEN 1000 ELSE 1 END AS weight_normalized_g_or_ml,
             trim(regexp_replace(lower(name), '(\d+(?:\.\d+)?)\s*(kg|ml|g|l)$', '')) AS product_family,
             p_retailprice AS default_selling_price, 
             round(p_retailprice * CAST(0.7 AS DOUBLE), 2) AS default_cost_price
      FROM found)""",
    two="default_cost_price",
)
def stg_product_variant(s):
    unit = F.create_map(*[F.lit(x) for x in ("LARGE", "kg", "SMALL", "G", "MEDIUM", "ml", "PROMO", "L")])
    named = s.products.withColumn(
        "ten_hang",
        F.concat("ten_hang", F.lit(" "), "quy_doi", F.lit(" "),
                 F.coalesce(F.try_element_at(unit, F.col("cap_1")), F.lit(""))),
    )
    return staging.stg_product_variant(staging.stg_products(named))


@query(
    "B15_stg_branches", "B15",
    """answer AS (
      SELECT b.ma_chi_nhanh AS branch_id, b.ma_chi_nhanh AS branch_code, ten_chi_nhanh AS branch_name,
             '' AS address, city, store_type_code AS branch_type FROM branches b)""",
)
def stg_branches(s):
    return staging.stg_branches(s.branches)


@query(
    "B17_price_fallback", "B17",
    """answer AS (
      SELECT transaction_id, ma_hang, so_luong, coalesce(gia_ban_mac_dinh, don_gia, 0) AS gia_ban,
             coalesce(gia_von_mac_dinh, 0) AS gia_von
      FROM de LEFT JOIN (SELECT * FROM products WHERE cap_1 <> 'SMALL') p USING (ma_hang))""",
    four="gia_ban gia_von",
)
def price_fallback(s):
    """Small parts are missing from the price list."""
    listed = s.products.filter(F.col("cap_1") != "SMALL")
    return staging.with_price_fallback(s.details, listed).select(
        "transaction_id", "ma_hang", "so_luong", "gia_ban", "gia_von"
    )


@query(
    "B18_price_tier", "B18",
    """answer AS (
      SELECT ma_hang, CASE WHEN gia_ban_mac_dinh >= 980 THEN 'Premium' WHEN gia_ban_mac_dinh >= 950 THEN 'Mid-range'
             WHEN gia_ban_mac_dinh >= 920 THEN 'Economy' ELSE 'Budget' END AS price_tier FROM products)""",
)
def price_tier(s):
    return s.products.select("ma_hang", rules.price_tier(F.col("gia_ban_mac_dinh"), PRICE_CUTS).alias("price_tier"))


_SPINE = """spine AS (
      SELECT CAST(unnest(generate_series((SELECT min(ngay) FROM tx), (SELECT max(ngay) FROM tx),
             INTERVAL 1 DAY)) AS DATE) AS d)"""


@query("A19_date_spine", "A19", f"{_SPINE}, answer AS (SELECT d AS date_day FROM spine)")
def date_spine(s):
    return calendar.date_spine(calendar.bounds_of(s.transactions, "ngay"))


@query(
    "H1_dim_date", "H1",
    f"""{_SPINE}, answer AS (
      SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
             CAST(year(d) AS INTEGER) AS year, 'Năm ' || CAST(year(d) AS VARCHAR) AS year_name,
             CAST(quarter(d) AS INTEGER) AS quarter,
             'Q' || CAST(quarter(d) AS VARCHAR) || '-' || CAST(year(d) AS VARCHAR) AS quarter_name,
             CAST(month(d) AS INTEGER) AS month, strftime(d, '%m/%Y') AS month_name,
             CAST(strftime(d, '%U') AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
             CAST(isodow(d) AS INTEGER) AS day_of_week,
             ['Thứ hai','Thứ ba','Thứ tư','Thứ năm','Thứ sáu','Thứ bảy','Chủ nhật'][isodow(d)] AS day_name,
             isodow(d) IN (6, 7) AS is_weekend, day(d) = 1 AS is_first_day_of_month,
             d = last_day(d) AS is_last_day_of_month,
             CAST(CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS fiscal_year
      FROM spine)""",
)
def dim_date(s):
    return calendar.dim_date(calendar.date_spine(calendar.bounds_of(s.transactions, "ngay")))


@query(
    "H3_calendar", "H3 H4",
    """days AS (SELECT ngay AS d, count(*) AS receipts FROM tx GROUP BY 1),
    answer AS (
      SELECT d AS ngay, receipts, CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(day(d) AS INTEGER) AS day_of_month,
             CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
             CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
             CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
             CASE WHEN day(d) = 1 THEN 1 ELSE 0 END AS is_month_start,
             CASE WHEN d = last_day(d) THEN 1 ELSE 0 END AS is_month_end,
             CASE WHEN (month(d) = 1 AND day(d) <= 5) OR (month(d) = 4 AND day(d) = 30)
                    OR (month(d) = 5 AND day(d) = 1) OR (month(d) = 9 AND day(d) = 2) THEN 1 ELSE 0 END AS is_holiday
      FROM days)""",
)
def calendar_features(s):
    days = s.transactions.groupBy("ngay").agg(F.count("*").alias("receipts"))
    return calendar.with_calendar(days)


@query(
    "H2_season_schemes", "H2 A17",
    """seed AS (SELECT * FROM (VALUES (1,'Winter'),(2,'Winter'),(3,'Spring'),(4,'Spring'),(5,'Spring'),(6,'Summer'),
        (7,'Summer'),(8,'Summer'),(9,'Autumn'),(10,'Autumn'),(11,'Autumn'),(12,'Winter')) v(m, season)),
    answer AS (
      SELECT CASE WHEN m IN (2,3) THEN 'Spring' WHEN m IN (4,5,6) THEN 'Summer' WHEN m IN (7,8,9) THEN 'Autumn'
                  ELSE 'Winter' END AS fact, season AS seed,
             CASE WHEN m IN (12,1,2) THEN 'Winter' WHEN m IN (3,4,5) THEN 'Spring' WHEN m IN (6,7,8) THEN 'Summer'
                  ELSE 'Autumn' END AS meteo, count(*) AS receipts
      FROM tx JOIN seed ON month(ngay) = m GROUP BY 1, 2, 3)""",
)
def season_schemes(s):
    seed = reference.seasons(s.spark).select("month", F.col("season").alias("seed"))
    receipts = s.transactions.withColumn("month", F.month("ngay")).join(F.broadcast(seed), "month")
    d = F.col("ngay")
    return receipts.groupBy(
        dates.season(d, "fact").alias("fact"), "seed", dates.season(d, "meteo").alias("meteo")
    ).agg(F.count("*").alias("receipts"))


@query(
    "G5_missing_dates", "G5",
    """sold AS (SELECT DISTINCT ngay FROM tx),
    answer AS (
      SELECT CAST(d AS DATE) AS missing_date
      FROM (SELECT unnest(generate_series((SELECT min(ngay) FROM tx), (SELECT max(ngay) FROM tx), INTERVAL 1 DAY)) AS d)
      WHERE d NOT IN (SELECT ngay FROM sold))""",
)
def missing_dates(s):
    return calendar.missing_dates(s.transactions, "ngay")


BRANCHES = """bt AS (
      SELECT t.ma_chi_nhanh AS branch_code, count(*) AS total_transactions, min(ngay) AS first_transaction_date,
             max(ngay) AS last_transaction_date, count(DISTINCT ngay) AS operating_days
      FROM tx t GROUP BY 1),
    bm AS (SELECT ma_chi_nhanh AS branch_code, round(sum(thanh_tien), 2) AS total_revenue,
                  round(sum(thanh_tien) - sum(von), 2) AS total_profit FROM lines GROUP BY 1),
    branch_perf AS (
      SELECT branch_code, total_transactions, total_revenue, total_profit,
             total_revenue / total_transactions AS avg_transaction_value, first_transaction_date,
             last_transaction_date, operating_days,
             CAST(rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank,
             CAST(rank() OVER (ORDER BY total_profit DESC) AS INTEGER) AS profit_rank,
             total_revenue / avg(total_revenue) OVER () AS revenue_vs_avg,
             total_profit / avg(total_profit) OVER () AS profit_vs_avg
      FROM bt JOIN bm USING (branch_code))"""


def _branch_performance(s):
    totals = facts.branch_totals(s.transactions, s.details, s.products)
    return dimensions.branch_performance(totals, staging.stg_branches(s.branches))


@query(
    "D7_branch_performance", "D7 E1 E2",
    f"""{BRANCHES}, answer AS (
      SELECT p.*, ten_chi_nhanh AS branch_name, city, store_type_code AS branch_type
      FROM branch_perf p LEFT JOIN branches b ON p.branch_code = b.ma_chi_nhanh)""",
    two="total_revenue total_profit", four="avg_transaction_value revenue_vs_avg profit_vs_avg",
)
def branch_performance(s):
    return _branch_performance(s)


@query(
    "I2_dim_branch", "I2",
    f"""{BRANCHES}, answer AS (
      SELECT b.ma_chi_nhanh AS branch_id, b.ma_chi_nhanh AS branch_code, ten_chi_nhanh AS branch_name,
             '' AS address, city, store_type_code AS branch_type,
             coalesce(total_revenue, 0) AS total_historical_revenue,
             coalesce(total_transactions, 0) AS total_historical_transactions,
             coalesce(avg_transaction_value, 0) AS avg_transaction_value,
             coalesce(revenue_rank, 0) AS revenue_rank,
             CASE WHEN revenue_vs_avg >= 1.5 THEN 'Star' WHEN revenue_vs_avg >= 1.0 THEN 'Standard'
                  WHEN revenue_vs_avg >= 0.5 THEN 'Developing' ELSE 'Underperforming' END AS performance_tier
      FROM branches b LEFT JOIN branch_perf p ON p.branch_code = b.ma_chi_nhanh)""",
    two="total_historical_revenue", four="avg_transaction_value",
)
def dim_branch(s):
    return dimensions.dim_branch(staging.stg_branches(s.branches), _branch_performance(s))


@query(
    "I3_dim_store", "I3 E7 A17",
    """types AS (SELECT * FROM (VALUES
        ('KPDT','UP','Cửa hàng khu phố đô thị','50-200'),('KCC','AP','Cửa hàng khu chung cư','30-100'),
        ('KCN','IZ','Cửa hàng khu công nghiệp','80-300'),('CTT','TM','Cửa hàng chợ truyền thống','15-50'),
        ('KVNT','RL','Cửa hàng khu vực nông thôn','40-150')) v(c, g, n, a)),
    answer AS (
      SELECT store_type_code || '_' || lpad(CAST(row_number() OVER (PARTITION BY store_type_code
               ORDER BY ma_chi_nhanh) AS VARCHAR), 3, '0') AS store_id,
             store_type_code, n AS store_type_name, g AS peer_group, a AS typical_area_m2,
             ma_chi_nhanh AS branch_code, ten_chi_nhanh AS store_name, '' AS address, city,
             0 AS store_area_m2, 0 AS selling_area_m2, 0 AS storage_area_m2,
             DATE '2000-01-01' AS open_date, 'active' AS status
      FROM branches LEFT JOIN types ON store_type_code = c)""",
)
def dim_store(s):
    df = dimensions.dim_store(staging.stg_branches(s.branches), reference.store_types(s.spark))
    return df.drop("store_type_description", "target_customer")


ABC = """revenue AS (
      SELECT p.ma_hang AS product_code, p.ten_hang AS product_name, round(coalesce(sum(d.thanh_tien), 0), 2) AS total_revenue,
             coalesce(sum(d.so_luong), 0) AS total_quantity
      FROM products p LEFT JOIN de d ON p.ma_hang = d.ma_hang GROUP BY 1, 2),
    abc AS (
      SELECT *, round(sum(total_revenue) OVER w / sum(total_revenue) OVER (), 9) AS cumulative_pct,
             CAST(ntile(100) OVER (ORDER BY total_revenue DESC, product_code) AS INTEGER) AS revenue_percentile
      FROM revenue
      WINDOW w AS (ORDER BY total_revenue DESC, product_code ROWS UNBOUNDED PRECEDING)),
    classed AS (
      SELECT *, CASE WHEN cumulative_pct <= 0.8 THEN 'A' WHEN cumulative_pct <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
      FROM abc)"""


def _abc(s, **options):
    revenue = facts.product_revenue(s.transactions, s.details, s.products)
    return classify.abc_classify(revenue, "product_code", "total_revenue", **options)


@query(
    "I4_abc_rows", "I4 C7 C8 E4 E6 E13",
    f"""{ABC}, answer AS (
      SELECT product_code, product_name, total_revenue, total_quantity, cumulative_pct, abc_class,
             revenue_percentile FROM classed)""",
    two="total_revenue total_quantity", four="cumulative_pct",
)
def abc_rows(s):
    return _abc(s, tiles=100).select(
        "product_code", "product_name", "total_revenue", "total_quantity", "cumulative_pct",
        "abc_class", "revenue_percentile",
    )


@query(
    "I4_abc_range", "I4 E3",
    f"""{ABC}, ranged AS (
      SELECT product_code, total_revenue,
             round(sum(total_revenue) OVER (ORDER BY total_revenue DESC) / sum(total_revenue) OVER (), 9) AS cumulative_pct
      FROM revenue),
    answer AS (
      SELECT *, CASE WHEN cumulative_pct <= 0.8 THEN 'A' WHEN cumulative_pct <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
      FROM ranged)""",
    two="total_revenue", four="cumulative_pct",
)
def abc_range(s):
    return _abc(s, frame="range").select("product_code", "total_revenue", "cumulative_pct", "abc_class")


@query(
    "D25_abc_summary", "D25",
    f"""{ABC}, answer AS (
      SELECT abc_class, count(*) AS cnt, sum(total_revenue) AS total_rev FROM classed GROUP BY 1)""",
    two="total_rev",
)
def abc_summary(s):
    return classify.abc_summary(_abc(s), "total_revenue")


DIM_PRODUCT = """sold AS (
      SELECT ma_hang, round(sum(so_luong * don_gia), 2) AS r, sum(so_luong) AS q,
             sum(so_luong * don_gia - von) / sum(so_luong * don_gia) AS m, max(ngay) AS last
      FROM lines GROUP BY 1),
    perf AS (
      SELECT *, CASE WHEN c <= 0.8 THEN 'A' WHEN c <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
      FROM (SELECT *, round(sum(r) OVER (ORDER BY r DESC) / sum(r) OVER (), 9) AS c FROM sold)),
    dim AS (
      SELECT p.ma_hang AS product_code, p.id AS product_id, p.ten_hang AS product_name, p.thuong_hieu AS brand, p.cap_1 AS category_level_1,
             CASE WHEN gia_ban_mac_dinh >= 980 THEN 'Premium' WHEN gia_ban_mac_dinh >= 950 THEN 'Mid-range'
                  WHEN gia_ban_mac_dinh >= 920 THEN 'Economy' ELSE 'Budget' END AS price_tier,
             coalesce(abc_class, 'N/A') AS abc_class, coalesce(r, 0) AS total_historical_revenue,
             coalesce(q, 0) AS total_historical_quantity, coalesce(m, 0) AS historical_profit_margin,
             CASE WHEN last IS NULL THEN 'New' WHEN last >= (SELECT d - 30 FROM newest) THEN 'Active'
                  WHEN last >= (SELECT d - 90 FROM newest) THEN 'Slow Moving' ELSE 'Inactive' END AS product_status
      FROM products p LEFT JOIN perf USING (ma_hang))"""


def product_dimension(s):
    stg = staging.stg_products(s.products)
    performance = facts.product_performance(s.transactions, s.details, s.products)
    classed = classify.abc_classify(performance, "product_code", "total_revenue", frame="range")
    return dimensions.dim_product(stg, staging.stg_product_variant(stg), classed, s.as_of, PRICE_CUTS)


@query(
    "I1_dim_product", "I1",
    f"{DIM_PRODUCT}, answer AS (SELECT * FROM dim)",
    two="total_historical_revenue total_historical_quantity", four="historical_profit_margin",
)
def dim_product(s):
    return product_dimension(s).select(
        "product_code", "product_id", "product_name", "brand", "category_level_1", "price_tier", "abc_class",
        "total_historical_revenue", "total_historical_quantity", "historical_profit_margin", "product_status",
    )


@query(
    "I5_apply_abc", "I5",
    f"""{ABC}, promo AS (
      SELECT product_code, CASE WHEN c <= 0.5 THEN 'A' WHEN c <= 0.75 THEN 'B' ELSE 'C' END AS abc_class, total_revenue
      FROM (SELECT *, round(sum(total_revenue) OVER (ORDER BY total_revenue DESC, product_code ROWS UNBOUNDED PRECEDING)
                      / sum(total_revenue) OVER (), 9) AS c
            FROM revenue WHERE product_code IN (SELECT ma_hang FROM products WHERE cap_1 = 'PROMO'))),
    answer AS (
      SELECT c.product_code, coalesce(p.abc_class, c.abc_class) AS abc_class,
             coalesce(p.total_revenue, c.total_revenue) AS total_historical_revenue
      FROM classed c LEFT JOIN promo p USING (product_code))""",
    two="total_historical_revenue",
)
def apply_abc(s):
    """Promotional products are classified again on their own, with other cuts."""
    classed = _abc(s).withColumnRenamed("total_revenue", "total_historical_revenue")
    own = facts.product_revenue(s.transactions, s.details, s.products.filter(F.col("cap_1") == "PROMO"))
    again = classify.abc_classify(own, "product_code", "total_revenue", 0.5, 0.75)
    dim = classed.select("product_code", "abc_class", "total_historical_revenue")
    return dimensions.apply_abc(dim, again)


@query(
    "F2_top_products", "F2 F1",
    f"""{DIM_PRODUCT}, answer AS (
      SELECT product_code, abc_class, total_historical_revenue FROM dim
      WHERE total_historical_revenue > 0 AND category_level_1 NOT LIKE '%PROMO%'
      ORDER BY total_historical_revenue DESC, product_code LIMIT 50)""",
    two="total_historical_revenue",
)
def top_products(s):
    return classify.top_products(product_dimension(s), 50, patterns=PROMO)


@query(
    "C20_movement_view", "C20",
    """answer AS (
      SELECT product_code, ten_hang AS product_name, thuong_hieu AS brand, p.cap_1 AS category_level_1, transaction_date,
             branch_code, quantity_sold, gross_revenue, gross_revenue - cost AS gross_profit
      FROM daily LEFT JOIN products p ON p.ma_hang = product_code)""",
    two="quantity_sold gross_revenue gross_profit",
)
def movement_view(s):
    daily = facts.daily_sales(s.transactions, s.details, s.products, s.branches)
    return facts.movement_view(daily, staging.stg_products(s.products))


def _rfm_sql(key: str) -> str:
    return f"""{RECEIPTS}, base AS (
      SELECT {key} AS customer_id, CAST(date_diff('day', max(transaction_date), (SELECT d FROM newest)) AS INTEGER) AS recency_days,
             count(DISTINCT transaction_date) AS frequency, round(sum(revenue), 2) AS monetary,
             avg(revenue) AS avg_order_value, sum(gross_profit) AS total_profit
      FROM receipts WHERE transaction_date >= (SELECT d - 365 FROM newest) GROUP BY 1),
    scored AS (
      SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
             CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
             CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score FROM base),
    answer AS (
      SELECT *, r_score * 100 + f_score * 10 + m_score AS rfm_score,
        CASE WHEN r_score >= 4 THEN CASE WHEN f_score >= 4 AND m_score >= 4 THEN 'Champions'
                  WHEN f_score >= 4 AND m_score >= 2 THEN 'Loyal Customers'
                  WHEN f_score >= 2 THEN 'Potential Loyalists' ELSE 'New Customers' END
             WHEN r_score = 3 THEN CASE WHEN f_score <= 2 THEN 'Promising' ELSE 'Need Attention' END
             WHEN r_score = 2 THEN CASE WHEN f_score >= 2 THEN 'About to Sleep' ELSE 'Hibernating' END
             WHEN f_score >= 4 THEN 'At Risk' WHEN f_score <= 2 THEN 'Hibernating' ELSE 'Lost' END AS rfm_segment,
        CASE WHEN r_score >= 4 THEN CASE WHEN f_score >= 4 AND m_score >= 4 THEN 'Reward them, early adopter for new products'
                  WHEN f_score >= 4 THEN 'Upsell higher value products'
                  WHEN f_score >= 2 THEN 'Offer membership/loyalty program' ELSE 'Make them familiar, nurture them' END
             WHEN r_score = 3 THEN CASE WHEN f_score <= 2 THEN 'Offer free trials, build trust' ELSE 'Make limited time offers' END
             WHEN r_score = 2 THEN CASE WHEN f_score >= 2 THEN 'Share valuable resources' ELSE 'Offer discounts/win-back campaigns' END
             WHEN f_score >= 4 THEN 'Send personalized reactivation campaigns'
             WHEN f_score <= 2 THEN 'Offer discounts/win-back campaigns' ELSE 'Ignore' END AS recommended_action
      FROM scored)"""


@query("I6_rfm_branches", "I6 D13 E5", _rfm_sql("branch_code"), two="monetary total_profit", four="avg_order_value")
def rfm_branches(s):
    """Branches stand for customers, as in the warehouse model."""
    return classify.rfm(classify.rfm_base(_receipts(s, 365), s.as_of))


@query("I6_rfm_customers", "I6 D13 E5", _rfm_sql("ma_khach"), two="monetary total_profit", four="avg_order_value")
def rfm_customers(s):
    return classify.rfm(classify.rfm_base(_receipts(s, 365), s.as_of, "ma_khach"))


@query(
    "I7_customer_transactions", "I7",
    f"""{RECEIPTS}, answer AS (
      SELECT transaction_code AS customer_id, branch_code, city, transaction_date,
             CAST(isodow(transaction_date) AS INTEGER) AS day_of_week, revenue, gross_profit, discount_amount,
             line_count AS item_count
      FROM receipts LEFT JOIN branches ON branch_code = ma_chi_nhanh)""",
    two="revenue gross_profit", four="discount_amount",
)
def customer_transactions(s):
    return classify.customer_transactions(_receipts(s), staging.stg_branches(s.branches))


# Lines under the names of the enrichment rules.
RULE_LINES = """rule_lines AS (
      SELECT transaction_id, ma_hang, b.store_type_code || '_' || l.ma_chi_nhanh AS chi_nhanh, ngay, so_luong,
             thanh_tien AS doanh_thu, thanh_tien - von AS loi_nhuan_gop, don_gia - gia_von AS loi_nhuan_sp,
             CASE WHEN don_gia > 0 THEN (don_gia - gia_von) / don_gia * 100 ELSE 0 END AS ty_suat_loi_nhuan
      FROM lines l JOIN branches b ON l.ma_chi_nhanh = b.ma_chi_nhanh)"""


def rule_lines(s):
    priced = staging.with_price_fallback(s.details, s.products)
    receipts = s.transactions.join(s.branches.select("ma_chi_nhanh", "store_type_code"), "ma_chi_nhanh")
    price, cost = F.col("don_gia"), F.col("gia_von")
    return priced.join(receipts, F.col("transaction_id") == F.col("id")).select(
        "transaction_id", "ma_hang",
        F.concat("store_type_code", F.lit("_"), "ma_chi_nhanh").alias("chi_nhanh"),
        "ngay", "so_luong",
        F.col("thanh_tien").alias("doanh_thu"),
        (F.col("thanh_tien") - F.col("so_luong") * cost).alias("loi_nhuan_gop"),
        (price - cost).alias("loi_nhuan_sp"),
        F.when(price > 0, (price - cost) / price * 100).otherwise(0.0).alias("ty_suat_loi_nhuan"),
    )


_OUTLIERS = f"""{RULE_LINES}, s AS (
      SELECT avg(doanh_thu) AS m, stddev_samp(doanh_thu) AS sd, quantile_cont(so_luong, 0.25) AS q1,
             quantile_cont(so_luong, 0.75) AS q3 FROM rule_lines),
    flagged AS (
      SELECT rule_lines.*, abs((doanh_thu - m) / sd) AS revenue_zscore, abs((doanh_thu - m) / sd) > 3 AS is_revenue_outlier,
             so_luong < q1 - 1.5 * (q3 - q1) OR so_luong > q3 + 1.5 * (q3 - q1) AS is_quantity_outlier,
             loi_nhuan_sp < 0 OR ty_suat_loi_nhuan > 100 AS is_margin_outlier
      FROM rule_lines, s)"""


@query(
    "I8_flag_outliers", "I8 E14",
    f"""{_OUTLIERS}, answer AS (
      SELECT transaction_id, ma_hang, so_luong, revenue_zscore, is_revenue_outlier, is_quantity_outlier,
             is_margin_outlier FROM flagged)""",
    four="revenue_zscore",
)
def flag_outliers(s):
    return classify.flag_outliers(rule_lines(s)).select(
        "transaction_id", "ma_hang", "so_luong", "revenue_zscore",
        "is_revenue_outlier", "is_quantity_outlier", "is_margin_outlier",
    )


_PEERS = """peers AS (
      SELECT chi_nhanh, CASE WHEN chi_nhanh LIKE 'KPDT%' THEN 'UP' WHEN chi_nhanh LIKE 'KCC%' THEN 'AP'
               WHEN chi_nhanh LIKE 'KCN%' THEN 'IZ' WHEN chi_nhanh LIKE 'CTT%' THEN 'TM'
               WHEN chi_nhanh LIKE 'KVNT%' THEN 'RL' ELSE 'OTHER' END AS peer_group,
             round(sum(doanh_thu), 2) AS total_revenue, avg(doanh_thu) AS avg_transaction,
             count(*) AS transaction_count, sum(loi_nhuan_gop) AS total_profit
      FROM rule_lines GROUP BY 1),
    ranked AS (
      SELECT *, rank() OVER (PARTITION BY peer_group ORDER BY total_revenue DESC)
             + (count(*) OVER (PARTITION BY peer_group, total_revenue) - 1) / 2.0 AS branch_rank
      FROM peers)"""


@query(
    "I9_rank_branches", "I9 E8 D27",
    f"{RULE_LINES}, {_PEERS}, answer AS (SELECT * FROM ranked)",
    two="total_revenue total_profit", four="avg_transaction branch_rank",
)
def rank_branches(s):
    return classify.rank_branches(classify.branch_metrics(rule_lines(s)))


_INDEX = """idx AS (
      SELECT m.ma_hang, m.month, m.a / o.a AS seasonal_index
      FROM (SELECT ma_hang, CAST(month(ngay) AS INTEGER) AS month, avg(doanh_thu) AS a FROM rule_lines GROUP BY 1, 2) m
      JOIN (SELECT ma_hang, avg(doanh_thu) AS a FROM rule_lines GROUP BY 1) o USING (ma_hang))"""


@query("D28_seasonal_index", "D28", f"{RULE_LINES}, {_INDEX}, answer AS (SELECT * FROM idx)", four="seasonal_index")
def seasonal_index(s):
    return classify.seasonal_index(rule_lines(s))


@query(
    "I10_seasonal_profile", "I10 C19",
    f"""{RULE_LINES}, {_INDEX}, answer AS (
      SELECT transaction_id, ma_hang, ngay, doanh_thu, idx.month,
             CASE WHEN idx.month IN (12,1,2) THEN 'Winter' WHEN idx.month IN (3,4,5) THEN 'Spring'
                  WHEN idx.month IN (6,7,8) THEN 'Summer' ELSE 'Autumn' END AS season,
             isodow(ngay) >= 6 AS is_weekend, CAST(quarter(ngay) AS INTEGER) AS quarter,
             strftime(ngay, '%B') AS month_name, seasonal_index
      FROM rule_lines JOIN idx USING (ma_hang) WHERE month(ngay) = idx.month)""",
    two="doanh_thu", four="seasonal_index",
)
def seasonal_profile(s):
    return classify.seasonal_profile(rule_lines(s)).select(
        "transaction_id", "ma_hang", "ngay", "doanh_thu", "month", "season", "is_weekend", "quarter",
        "month_name", "seasonal_index",
    )


@query(
    "I15_enrich_stats", "I15 C19 D25",
    f"""{_OUTLIERS}, {_PEERS}, pr AS (SELECT ma_hang, round(sum(doanh_thu), 2) AS r FROM rule_lines GROUP BY 1),
    cls AS (
      SELECT ma_hang, CASE WHEN c <= 0.8 THEN 'A' WHEN c <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
      FROM (SELECT ma_hang, round(sum(r) OVER (ORDER BY r DESC, ma_hang ROWS UNBOUNDED PRECEDING) / sum(r) OVER (), 9) AS c FROM pr)),
    answer AS (
      SELECT 'total' AS statistic, '' AS value, count(*) AS records FROM flagged
      UNION ALL SELECT 'abc_class', abc_class, count(*) FROM flagged JOIN cls USING (ma_hang) GROUP BY ALL
      UNION ALL SELECT 'peer_group', peer_group, count(*) FROM flagged JOIN peers USING (chi_nhanh) GROUP BY ALL
      UNION ALL SELECT 'season', CASE WHEN month(ngay) IN (12,1,2) THEN 'Winter' WHEN month(ngay) IN (3,4,5) THEN 'Spring'
                  WHEN month(ngay) IN (6,7,8) THEN 'Summer' ELSE 'Autumn' END, count(*) FROM flagged GROUP BY ALL
      UNION ALL SELECT 'outlier', 'revenue_outlier', count(*) FROM flagged WHERE is_revenue_outlier HAVING count(*) > 0
      UNION ALL SELECT 'outlier', 'quantity_outlier', count(*) FROM flagged WHERE is_quantity_outlier HAVING count(*) > 0
      UNION ALL SELECT 'outlier', 'margin_outlier', count(*) FROM flagged WHERE is_margin_outlier HAVING count(*) > 0)""",
)
def enrich_stats(s):
    """The lines are written once and then read by each rule."""
    path = scratch_path(s.spark, "rule-lines")
    rule_lines(s).write.parquet(path)
    return classify.run_stats(classify.enrich(s.spark.read.parquet(path)))


@query(
    "I13_time_of_day", "I13 I14",
    """events_h AS (SELECT *, hour(ts) AS h FROM events),
    answer AS (
      SELECT event_id, CASE WHEN h >= 5 AND h < 12 THEN 'Morning' WHEN h >= 12 AND h < 18 THEN 'Afternoon'
               WHEN h >= 18 AND h < 22 THEN 'Evening' ELSE 'Night' END AS part_of_day,
             isodow(ts) >= 6 AS is_weekend, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS days_since,
             format('{:,}', CAST(round_even(value * 1000, 0) AS BIGINT)) || ' ₫' AS amount
      FROM events_h)""",
)
def time_of_day(s):
    d = F.to_date("ts")
    return s.table("events").select(
        "event_id",
        rules.time_of_day(F.hour("ts")).alias("part_of_day"),
        dates.is_weekend(d).alias("is_weekend"),
        dates.days_since(d, F.lit("2024-02-01").cast("date")).alias("days_since"),
        text.format_currency(F.col("value") * 1000).alias("amount"),
    )


@query(
    "I14_growth_margin", "I14",
    """monthly AS (
      SELECT CAST(date_trunc('month', ngay) AS DATE) AS month, ma_chi_nhanh AS branch_code,
             round(sum(thanh_tien), 2) AS revenue, round(sum(thanh_tien - von), 2) AS profit FROM lines GROUP BY 1, 2),
    answer AS (
      SELECT month, branch_code, revenue,
             (revenue - lag(revenue) OVER w) / lag(revenue) OVER w AS revenue_growth, profit / revenue AS margin
      FROM monthly WINDOW w AS (PARTITION BY branch_code ORDER BY month))""",
    two="revenue", four="revenue_growth margin",
)
def growth_margin(s):
    from pyspark.sql import Window

    monthly = facts.monthly_sales(s.transactions, s.details, s.products).groupBy("month", "branch_code").agg(
        F.round(F.sum("monthly_revenue"), 2).alias("revenue"), F.round(F.sum("monthly_profit"), 2).alias("profit")
    )
    before = F.lag("revenue").over(Window.partitionBy("branch_code").orderBy("month"))
    return monthly.select(
        "month", "branch_code", "revenue",
        rules.growth(F.col("revenue"), before).alias("revenue_growth"),
        rules.margin(F.col("profit"), F.col("revenue")).alias("margin"),
    )


@query(
    "WEEKS_week_numbers", "H3",
    f"""days AS (SELECT DISTINCT ngay AS d FROM tx),
    answer AS (
      SELECT d AS ngay, CAST(strftime(d, '%U') AS INTEGER) AS week_sunday, {WEEK.format('d')} AS week_monday,
             CAST(weekofyear(d) AS INTEGER) AS week_iso FROM days)""",
)
def week_numbers(s):
    d = F.col("ngay")
    return s.transactions.select("ngay").distinct().select(
        "ngay", dates.week_sunday(d).alias("week_sunday"), dates.week_monday(d).alias("week_monday"),
        F.weekofyear(d).alias("week_iso"),
    )

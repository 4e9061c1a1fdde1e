"""Sales facts.

Lines are reduced to the grain of the fact before products or branches are joined. A
product that holds a large part of all lines is therefore a few rows by the time it meets
a join, and product columns never travel with the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import dates
from shelfwise.functions.rules import ratio_or
from shelfwise.functions.text import PROMO_PATTERNS, is_promo
from shelfwise.session import day, pinned


def last_days(df: DataFrame, as_of, days: int, column: str = "transaction_date") -> DataFrame:
    """Rows of the last `days` days; 0 keeps all."""
    return df if days <= 0 else df.filter(F.col(column) >= F.date_sub(day(as_of), days))


def valid_sales(df: DataFrame, quantity="quantity", revenue="net_amount", positive=True) -> DataFrame:
    """Rows with quantity and revenue, above zero unless `positive` is off."""
    q, r = F.col(quantity), F.col(revenue)
    kept = q.isNotNull() & r.isNotNull()
    return df.filter(kept & (q > 0) & (r > 0) if positive else kept)


def sales_lines(transactions: DataFrame, details: DataFrame, as_of=None, days: int = 0) -> DataFrame:
    """Receipt lines with the date and branch of their receipt."""
    receipts = transactions.select(
        F.col("id").alias("transaction_id"),
        F.to_date("ngay").alias("transaction_date"),
        F.col("ma_chi_nhanh").alias("branch_code"),
    )
    return last_days(receipts, as_of, days).join(
        details.select(
            "transaction_id",
            F.col("ma_hang").alias("product_code"),
            F.col("so_luong").alias("quantity"),
            F.col("don_gia").alias("unit_price"),
            F.col("thanh_tien").alias("net_amount"),
        ),
        "transaction_id",
    )


SUMS = ("line_count", "quantity_sold", "gross_revenue", "price_sum", "list_value")


def _line_sums() -> list[Column]:
    return [
        F.count("*").alias("line_count"),
        F.sum("quantity").alias("quantity_sold"),
        F.sum("net_amount").alias("gross_revenue"),
        F.sum("unit_price").alias("price_sum"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("list_value"),
    ]


def daily_base(lines: DataFrame) -> DataFrame:
    """Sums per date, product and branch: the grain shared by the sales facts."""
    return lines.groupBy("transaction_date", "product_code", "branch_code").agg(*_line_sums())


def roll_up(base: DataFrame, *keys) -> DataFrame:
    """The same sums on coarser keys."""
    return base.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def _catalog(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("ma_hang").alias("product_code"),
        F.col("ma_hang").alias("product_id"),
        F.col("gia_von_mac_dinh").alias("unit_cost"),
        "cap_1",
        "cap_2",
    )


def cost_of_sales(fallback: bool) -> Column:
    """Quantity times catalog cost; without one, 0 or 70 % of the line prices."""
    other = F.col("list_value") * 0.7 if fallback else F.lit(0.0)
    return F.coalesce(F.col("quantity_sold") * F.col("unit_cost"), other)


def _priced(base: DataFrame, products: DataFrame, branches: DataFrame) -> DataFrame:
    """Product and branch lookups on an aggregated base."""
    known = branches.select(
        F.col("ma_chi_nhanh").alias("branch_code"), F.col("ma_chi_nhanh").alias("branch_id")
    )
    return base.join(_catalog(products), "product_code", "left").join(known, "branch_code", "left")


def _sales_columns() -> list[Column]:
    cost = cost_of_sales(fallback=False)
    revenue = F.col("gross_revenue")
    return [
        F.col("transaction_date"),
        dates.date_key(F.col("transaction_date")).alias("date_key"),
        F.col("product_code"),
        F.col("product_id"),
        F.col("branch_code"),
        F.col("branch_id"),
        F.col("line_count").alias("transaction_count"),
        F.col("quantity_sold"),
        revenue,
        cost.alias("cost_of_goods_sold"),
        (revenue - cost).alias("gross_profit"),
        (F.col("price_sum") / F.col("line_count")).alias("avg_selling_price"),
        ratio_or(revenue - cost, revenue).alias("profit_margin"),
    ]


def daily_sales(transactions, details, products, branches) -> DataFrame:
    """Sales per date, product and branch."""
    base = daily_base(sales_lines(transactions, details))
    return _priced(base, products, branches).select(*_sales_columns())


def _unit_profit() -> Column:
    return (
        (F.col("gross_revenue") - cost_of_sales(fallback=False))
        / F.nullif(F.col("quantity_sold"), F.lit(0.0))
    ).alias("avg_profit_per_unit")


def regular_sales(
    transactions, details, products, branches, patterns=PROMO_PATTERNS, as_of=None, days=0
) -> DataFrame:
    """Daily sales of products outside the promotional categories."""
    base = daily_base(sales_lines(transactions, details, as_of, days))
    return (
        _priced(base, products, branches)
        .filter(~is_promo(F.col("cap_1"), patterns))
        .select(
            *_sales_columns(),
            _unit_profit(),
            F.lit(0).alias("is_promotional_sale"),
            F.lit("regular").alias("sale_type"),
        )
    )


def promotional_sales(
    transactions, details, products, branches, patterns=PROMO_PATTERNS
) -> DataFrame:
    """D3: daily sales of promotional categories, with the category."""
    base = daily_base(sales_lines(transactions, details))
    return (
        _priced(base, products, branches)
        .filter(is_promo(F.col("cap_1"), patterns))
        .select(
            *_sales_columns(),
            _unit_profit(),
            F.col("cap_1").alias("promotion_category"),
            F.col("cap_2").alias("promotion_subcategory"),
            F.lit(1).alias("is_promotional_sale"),
            F.lit("promotional").alias("sale_type"),
        )
    )


def monthly_sales(transactions, details, products) -> DataFrame:
    """Sales per month, product and branch; margin is 0.3 without revenue."""
    base = daily_base(sales_lines(transactions, details))
    month = F.trunc("transaction_date", "MM")
    monthly = base.groupBy(month.alias("month"), "product_code", "branch_code").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.count("*").alias("active_days")
    )
    cost = cost_of_sales(fallback=True)
    revenue = F.col("gross_revenue")
    return monthly.join(_catalog(products), "product_code", "left").select(
        "month",
        dates.month_key(F.col("month")).alias("month_key"),
        "product_code",
        "branch_code",
        F.col("quantity_sold").alias("monthly_quantity"),
        revenue.alias("monthly_revenue"),
        cost.alias("monthly_cost"),
        (revenue - cost).alias("monthly_profit"),
        ratio_or(revenue - cost, revenue, 0.3).alias("avg_profit_margin"),
        "active_days",
    )


def daily_sales_seasonal(transactions, details) -> DataFrame:
    """Daily sales with season label and weekend factor."""
    d = F.col("transaction_date")
    return daily_base(sales_lines(transactions, details)).select(
        "transaction_date",
        "product_code",
        "branch_code",
        "quantity_sold",
        "gross_revenue",
        dates.season(d, "fact").alias("season"),
        F.when(dates.is_weekend(d), 1.2).otherwise(1.0).alias("seasonal_factor"),
        F.lit(0).alias("is_peak_day"),
    )


def product_performance(transactions, details, products) -> DataFrame:
    """One row per sold product.

    Lines are reduced to product and receipt first: a receipt has one date, so receipts
    are counted as rows and only the dates need a distinct count.
    """
    per_receipt = sales_lines(transactions, details).groupBy(
        "product_code", "transaction_id", "transaction_date"
    ).agg(*_line_sums())
    per_day = per_receipt.groupBy("product_code", "transaction_date").agg(
        F.count("*").alias("receipts"), *[F.sum(c).alias(c) for c in SUMS]
    )
    totals = per_day.groupBy("product_code").agg(
        F.sum("receipts").alias("total_transactions"),
        *[F.sum(c).alias(c) for c in SUMS],
        F.min("transaction_date").alias("first_sale_date"),
        F.max("transaction_date").alias("last_sale_date"),
        F.count("*").alias("selling_days"),
    )
    names = products.select(
        F.col("ma_hang").alias("product_code"),
        F.col("ten_hang").alias("product_name"),
        F.coalesce("thuong_hieu", F.lit("")).alias("brand"),
        F.col("cap_1").alias("category_l1"),
        F.col("cap_2").alias("category_l2"),
        F.col("gia_von_mac_dinh").alias("unit_cost"),
    )
    revenue = F.col("list_value")
    profit = revenue - cost_of_sales(fallback=True)
    return totals.join(names, "product_code", "left").select(
        "product_code", "product_name", "brand", "category_l1", "category_l2",
        "total_transactions",
        F.col("quantity_sold").alias("total_quantity_sold"),
        revenue.alias("total_revenue"),
        profit.alias("total_profit"),
        (F.col("price_sum") / F.col("line_count")).alias("avg_selling_price"),
        (profit / F.nullif(F.col("quantity_sold"), F.lit(0.0))).alias("avg_profit_per_unit"),
        ratio_or(profit, revenue).alias("profit_margin"),
        "first_sale_date", "last_sale_date", "selling_days",
    )


def branch_totals(transactions, details, products) -> DataFrame:
    """One row per branch that has receipts."""
    receipts = transactions.groupBy(F.col("ma_chi_nhanh").alias("branch_code")).agg(
        F.count("*").alias("total_transactions"),
        F.min("ngay").alias("first_transaction_date"),
        F.max("ngay").alias("last_transaction_date"),
        F.countDistinct("ngay").alias("operating_days"),
    )
    sold = sales_lines(transactions, details).groupBy("branch_code", "product_code").agg(*_line_sums())
    money = (
        sold.join(_catalog(products), "product_code", "left")
        .groupBy("branch_code")
        .agg(
            F.sum("gross_revenue").alias("revenue"),
            F.sum(cost_of_sales(fallback=True)).alias("cost"),
        )
    )
    revenue = F.coalesce("revenue", F.lit(0.0))
    return receipts.join(money, "branch_code", "left").select(
        "branch_code",
        "total_transactions",
        revenue.alias("total_revenue"),
        (revenue - F.coalesce("cost", F.lit(0.0))).alias("total_profit"),
        (revenue / F.col("total_transactions")).alias("avg_transaction_value"),
        "first_transaction_date", "last_transaction_date", "operating_days",
    )


def _per_product_day(transactions, details) -> DataFrame:
    """Sums and receipts per date and product, reduced per receipt first."""
    per_receipt = sales_lines(transactions, details).groupBy(
        "transaction_date", "product_code", "transaction_id"
    ).agg(*_line_sums())
    return per_receipt.groupBy("transaction_date", "product_code").agg(
        F.count("*").alias("transaction_count"), *[F.sum(c).alias(c) for c in SUMS]
    )


def sales_daily_by_product(transactions, details, products) -> DataFrame:
    """Daily sales per product with brand and categories."""
    names = products.select(
        F.col("ma_hang").alias("product_code"),
        F.col("ten_hang").alias("product_name"),
        F.coalesce("thuong_hieu", F.lit("")).alias("brand"),
        F.col("cap_1").alias("category_l1"),
        F.col("cap_2").alias("category_l2"),
        F.col("cap_3").alias("category_l3"),
        F.col("gia_von_mac_dinh").alias("unit_cost"),
    )
    cost = cost_of_sales(fallback=True)
    return _per_product_day(transactions, details).join(names, "product_code", "left").select(
        "transaction_date", "product_code", "product_name", "brand",
        "category_l1", "category_l2", "category_l3", "transaction_count",
        F.col("quantity_sold").alias("total_quantity"),
        F.col("list_value").alias("total_revenue"),
        cost.alias("total_cost"),
        (F.col("list_value") - cost).alias("total_profit"),
        (F.col("price_sum") / F.col("line_count")).alias("avg_selling_price"),
        (F.col("quantity_sold") / F.col("line_count")).alias("avg_quantity_per_transaction"),
    )


def inventory_movement(transactions, details, products) -> DataFrame:
    """Daily units, revenue, cost of goods and profit per product."""
    cost = cost_of_sales(fallback=True)
    return (
        _per_product_day(transactions, details)
        .join(_catalog(products), "product_code", "left")
        .select(
            "transaction_date", "product_code",
            F.col("quantity_sold").alias("units_sold"),
            F.col("gross_revenue").alias("revenue"),
            cost.alias("cogs"),
            (F.col("gross_revenue") - cost).alias("profit"),
            "transaction_count",
        )
    )


def movement_view(daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    """C20: daily sales with product names."""
    names = dim_product.select("product_code", "product_name", "brand", "category_level_1")
    return daily.join(names, "product_code", "left").select(
        "product_code", "product_name", "brand", "category_level_1",
        "transaction_date", "branch_code", "quantity_sold", "gross_revenue", "gross_profit",
    )


def daily_totals(transactions, details) -> DataFrame:
    """Revenue, quantity and receipts per day, over all products."""
    per_receipt = sales_lines(transactions, details).groupBy("transaction_date", "transaction_id").agg(
        F.sum("net_amount").alias("gross_revenue"), F.sum("quantity").alias("quantity_sold")
    )
    return per_receipt.groupBy("transaction_date").agg(
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("quantity_sold").alias("quantity_sold"),
        F.count("*").alias("transaction_count"),
    )


def sales_kpi(daily: DataFrame, as_of) -> DataFrame:
    """Current month, previous month and year to date, in one pass."""
    d, today = F.col("transaction_date"), day(as_of)
    # The periods reach back to January or, in January, to the month before.
    start = F.least(F.trunc(today, "year"), F.add_months(F.trunc(today, "MM"), -1))
    daily = daily.filter(d >= start)
    month = F.trunc(d, "MM")
    periods = {
        "Current Month": month == F.trunc(today, "MM"),
        "Previous Month": month == F.trunc(F.add_months(today, -1), "MM"),
        "YTD": (F.year(d) == F.year(today)) & (d <= today),
    }
    wanted = {"revenue": "gross_revenue", "quantity": "quantity_sold", "transactions": "transaction_count"}
    sums = [
        F.struct(
            F.lit(name).alias("period"),
            *[F.sum(F.when(inside, F.col(c))).alias(k) for k, c in wanted.items()],
        )
        for name, inside in periods.items()
    ]
    return daily.agg(F.array(*sums).alias("p")).select(F.inline("p")).select(
        "period", "revenue", "quantity", "transactions",
        ratio_or(F.col("revenue"), F.col("transactions")).alias("avg_transaction_value"),
        ratio_or(F.col("revenue"), F.col("quantity")).alias("avg_unit_price"),
    )


def product_revenue(transactions, details, products) -> DataFrame:
    """Revenue, quantity and active days of every catalog product, sold or not.

    Dates come by a left join, so a line without a receipt still counts its money.
    """
    days = transactions.select(F.col("id").alias("transaction_id"), "ngay")
    per_day = (
        details.join(days, "transaction_id", "left")
        .groupBy("ma_hang", "ngay")
        .agg(F.sum("thanh_tien").alias("revenue"), F.sum("so_luong").alias("quantity"))
    )
    sold = per_day.groupBy("ma_hang").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity"),
        F.count("ngay").alias("days"),
    )
    return products.join(sold, "ma_hang", "left").select(
        F.col("ma_hang").alias("product_code"),
        F.col("ten_hang").alias("product_name"),
        *[F.col(f"cap_{i}").alias(f"category_level_{i}") for i in (1, 2, 3)],
        F.coalesce("revenue", F.lit(0.0)).alias("total_revenue"),
        F.coalesce("quantity", F.lit(0.0)).alias("total_quantity"),
        F.coalesce("days", F.lit(0)).alias("active_days"),
    )


STATE_KEYS = ("ngay", "chi_nhanh", "nhom_hang_cap_1", "nhom_hang_cap_2")
STATE_SUMS = ("doanh_thu", "loi_nhuan", "so_luong", "so_giao_dich")


def daily_state(transactions, details, products) -> DataFrame:
    """Mergeable sums per date, branch and category."""
    base = daily_base(sales_lines(transactions, details)).join(_catalog(products), "product_code", "left")
    return base.groupBy(
        F.col("transaction_date").alias("ngay"),
        F.col("branch_code").alias("chi_nhanh"),
        F.coalesce("cap_1", F.lit("")).alias("nhom_hang_cap_1"),
        F.coalesce("cap_2", F.lit("")).alias("nhom_hang_cap_2"),
    ).agg(
        F.sum("gross_revenue").alias("doanh_thu"),
        F.sum(F.col("gross_revenue") - cost_of_sales(fallback=True)).alias("loi_nhuan"),
        F.sum("quantity_sold").alias("so_luong"),
        F.sum("line_count").alias("so_giao_dich"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """States of several loads added up."""
    merged = states[0]
    for other in states[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy(*STATE_KEYS).agg(*[F.sum(c).alias(c) for c in STATE_SUMS])


def _weeks(facts: DataFrame, n: int, column: str) -> DataFrame:
    d = F.col(column)
    return (
        facts.groupBy(F.year(d).alias("year"), dates.week_monday(d).alias("week"))
        .agg(F.min(d).alias("first_day"), F.max(d).alias("last_day"))
        .orderBy(F.desc("year"), F.desc("week")).limit(n)
    )


def week_spans(facts: DataFrame, n: int = 2, column: str = "transaction_date", recent: DataFrame | None = None) -> list:
    """the latest `n` year-week pairs that have sales, with their first and last day.

    `recent` is the same table of the last days only; if it holds `n` weeks, the whole is
    not read. Only the `n` rows reach the driver.
    """
    found = [] if recent is None else _weeks(recent, n, column).collect()
    return found if len(found) == n else _weeks(facts, n, column).collect()


def recent_weeks(
    facts: DataFrame, n: int = 2, column: str = "transaction_date", recent: DataFrame | None = None
) -> DataFrame:
    """the latest `n` year-week pairs that have sales."""
    rows = [(r["year"], r["week"]) for r in week_spans(facts, n, column, recent)]
    return facts.sparkSession.createDataFrame(rows, _weeks(facts, n, column).select("year", "week").schema)


def last_week_sales(facts: DataFrame, recent: DataFrame | None = None) -> DataFrame:
    """Units per product in the last but one week that has sales (the only one if single).

    The weeks are found from dates alone (`week_spans`); the days of the chosen one are
    literals, so that they reach the scan.
    """
    d = F.col("transaction_date")
    spans = week_spans(facts, 2, recent=recent)
    if not spans:
        kept = facts.filter(F.lit(False))
    else:
        week = spans[-1]
        kept = facts.filter(
            (d >= F.lit(week["first_day"])) & (d <= F.lit(week["last_day"]))
            & (F.year(d) == week["year"]) & (dates.week_monday(d) == week["week"]))
    return kept.groupBy("product_code").agg(F.sum("quantity_sold").alias("last_week_sales"))


def last_seven_days_sales(facts: DataFrame) -> DataFrame:
    """The fallback without weeks: seven days before the newest sale."""
    newest = facts.agg(F.max("transaction_date").alias("d")).scalar()
    d = F.col("transaction_date")
    return facts.filter((d >= F.date_sub(newest, 7)) & (d < newest)).groupBy("product_code").agg(
        F.sum("quantity_sold").alias("last_week_sales")
    )


def sales_28d(facts: DataFrame, as_of) -> DataFrame:
    """Units and revenue per product over 28 days."""
    return last_days(facts, as_of, 28).groupBy("product_code").agg(
        F.sum("quantity_sold").alias("sales_4weeks"),
        F.sum("gross_revenue").alias("revenue_4weeks"),
    )


def weekly_sales(facts: DataFrame, as_of, days: int = 28) -> DataFrame:
    """Units and revenue per product and week."""
    return (
        last_days(facts, as_of, days)
        .groupBy("product_code", dates.week_monday(F.col("transaction_date")).alias("week_num"))
        .agg(F.sum("quantity_sold").alias("weekly_sold"), F.sum("gross_revenue").alias("weekly_revenue"))
    )


def daily_units(facts: DataFrame, as_of, days: int = 28) -> DataFrame:
    """Units per product and day."""
    return last_days(facts, as_of, days).groupBy("product_code", "transaction_date").agg(
        F.sum("quantity_sold").alias("daily_sold")
    )


def recent_transactions(transactions: DataFrame, branches: DataFrame, as_of, days: int = 60) -> DataFrame:
    """Receipts of the last days with their branch."""
    known = branches.select("ma_chi_nhanh", "city")
    return last_days(transactions, as_of, days, "ngay").join(known, "ma_chi_nhanh").select(
        "id", "ma_giao_dich", "ngay", "ma_chi_nhanh", "ten_chi_nhanh", "city"
    )

"""Stock views, demand statistics, policies and purchase orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.operators.facts import last_days
from shelfwise.operators.merge import barcode


def stock_metrics(opening: Column, sold: Column, closing: Column) -> tuple[Column, Column]:
    """Coverage (closing over sold) and change in percent, two decimals, null-guarded."""
    coverage = F.when(sold > 0, F.round(closing / sold, 2))
    change = F.when(opening > 0, F.round((closing - opening) / opening * 100, 2))
    return coverage, change


def stock_consistency(opening: Column, received: Column, sold: Column, closing: Column) -> Column:
    """ERROR where the balance does not add up."""
    return F.when(opening + received - sold != closing, "ERROR").otherwise("OK")


def stock_with_products(stock: DataFrame, products: DataFrame) -> DataFrame:
    """Snapshots matched to products by barcode; a blank one matches nothing."""
    known = products.select(
        barcode("ma_vach").alias("ma_vach"), F.col("id").alias("product_id"), "cap_1", "cap_2", "cap_3",
        "gia_von_mac_dinh", "gia_ban_mac_dinh",
    )
    opening, received, sold, closing = (
        F.col(c) for c in ("ton_dau_ky", "sl_nhap", "sl_xuat", "ton_cuoi_ky")
    )
    coverage, change = stock_metrics(opening, sold, closing)
    return stock.join(known, "ma_vach", "left").withColumns({
        "so_ngay_ton_kho": coverage,
        "bien_dong_ton_kho_pct": change,
        "consistency_check": stock_consistency(opening, received, sold, closing),
    })


def match_counts(matched: DataFrame) -> DataFrame:
    """Rows with and without a product."""
    return matched.agg(
        F.count("*").alias("total_rows"),
        F.count("product_id").alias("matched_rows"),
        F.count_if(F.col("product_id").isNull()).alias("unmatched_rows"),
    )


def weekly_stock_summary(weekly: DataFrame, products: DataFrame) -> DataFrame:
    """Weekly stock with product names, coverage and change."""
    names = products.select("ma_hang", "ten_hang", "cap_1", "cap_2", "cap_3")
    coverage, change = stock_metrics(
        F.col("ton_dau_ky"), F.col("xuat_trong_ky"), F.col("ton_cuoi_ky")
    )
    return weekly.join(names, "ma_hang", "left").select(
        "week_year", "chi_nhanh", "ma_hang", "ten_hang", "cap_1", "cap_2", "cap_3",
        "ton_dau_ky", "nhap_trong_ky", "xuat_trong_ky", "ton_cuoi_ky", "gia_tri_ton_kho",
        coverage.alias("so_ngay_ton_kho"), change.alias("tang_truong_ton_kho_pct"),
    )


def latest_stock(stock: DataFrame, keys: Sequence[str] = ("ma_hang",), as_of=None, days: int = 0) -> DataFrame:
    """Closing stock of the newest snapshot per key, summed over rows of that day."""
    recent = last_days(stock, as_of, days, "snapshot_date")
    per_day = recent.groupBy(*keys, "snapshot_date").agg(F.sum("ton_cuoi_ky").alias("closing"))
    return per_day.groupBy(*keys).agg(F.max_by("closing", "snapshot_date").alias("current_stock"))


def stock_by_branch(stock: DataFrame) -> DataFrame:
    """Products and closing stock per snapshot and branch."""
    return stock.groupBy("snapshot_date", "chi_nhanh").agg(
        F.count("*").alias("products"), F.sum("ton_cuoi_ky").alias("total_closing")
    )


def inventory_facts(stg: DataFrame) -> DataFrame:
    """Staged stock summed per date, product and branch."""
    return stg.groupBy(
        F.col("inventory_date").alias("snapshot_date"), "product_code", F.col("branch_name").alias("branch_code")
    ).agg(
        F.sum("opening_stock").alias("total_opening_stock"),
        F.sum("quantity_imported").alias("total_imported"),
        F.sum("quantity_exported").alias("total_exported"),
        F.sum("closing_stock").alias("total_closing_stock"),
        F.avg("inventory_turnover").alias("avg_turnover_rate"),
        F.avg("days_of_inventory").alias("avg_days_inventory"),
    )


def demand_stats(movement: DataFrame, as_of, days: int = 90, approx: bool = False) -> DataFrame:
    """Daily demand statistics per product.

    A product has one row per day here, at most `days` + 1, so its list of values is small.
    Mean and deviation are folded over the ordered values, so no order of rows changes them; the
    deviation goes by `n * x - total`, which is exact for whole units, and so is its ratio to the mean.
    """
    p95 = F.percentile_approx("units_sold", 0.95) if approx else F.percentile("units_sold", 0.95)
    n = F.size("_units").cast("double")
    total = F.aggregate("_units", F.lit(0.0), lambda a, v: a + v)
    squares = F.aggregate(
        "_units", F.lit(0.0), lambda a, v: a + (n * v - F.col("_total")) * (n * v - F.col("_total")))
    per = last_days(movement, as_of, days).groupBy("product_code").agg(
        F.array_sort(F.collect_list(F.col("units_sold").cast("double"))).alias("_units"),
        F.max("units_sold").alias("max_daily_sales"),
        p95.cast("double").alias("p95_daily_sales"),
        F.avg("revenue").alias("avg_daily_revenue"),
        F.sum("revenue").alias("total_revenue"),
        F.count("*").alias("selling_days"),
        F.min("transaction_date").alias("first_sale"),
        F.max("transaction_date").alias("last_sale"),
    ).withColumn("_total", F.when(F.size("_units") > 0, total))
    return per.select(
        "product_code", F.try_divide("_total", n).alias("avg_daily_sales"),
        F.try_divide(F.sqrt(F.try_divide(squares, n)), n).alias("std_daily_sales"),
        "max_daily_sales", "p95_daily_sales", "avg_daily_revenue", "total_revenue", "selling_days",
        "first_sale", "last_sale", F.try_divide("_total", "selling_days").alias("sales_velocity"),
    )


def inventory_policy(stats: DataFrame) -> DataFrame:
    """Safety stock, reorder point, order quantity and classes."""
    mean, std = F.col("avg_daily_sales"), F.coalesce("std_daily_sales", F.lit(0.0))
    return stats.withColumns({
        "suggested_safety_stock": F.ceil((mean + 1.65 * std) * F.sqrt(F.lit(7.0))),
        "suggested_reorder_point": F.ceil(mean * 14),
        "suggested_order_quantity": F.ceil(F.sqrt(2 * mean * 30 * 100 / 0.1)),
        "velocity_class": rules.velocity_class(F.col("sales_velocity")),
        "demand_pattern": rules.demand_pattern(F.col("std_daily_sales"), mean),
    })


def safety_stock(
    daily: DataFrame, products: DataFrame, lead_max: int = 14, lead_avg: int = 10, min_days: int = 7
) -> DataFrame:
    """Peak demand over the long lead time less mean demand over the usual one.

    Products with fewer than `min_days` selling days get half their minimum stock.
    """
    demand = daily.groupBy("product_code").agg(
        F.max("daily_sold").alias("max_daily"), F.avg("daily_sold").alias("avg_daily"),
        F.count("*").alias("sold_days"),
    )
    minimum = products.select(F.col("ma_hang").alias("product_code"), F.col("ton_nho_nhat").alias("min_stock"))
    formula = F.col("max_daily") * lead_max - F.col("avg_daily") * lead_avg
    few = rules.whole(F.coalesce("min_stock", F.lit(0)) * 0.5)
    enough = F.coalesce(F.col("sold_days") >= min_days, F.lit(False))
    return minimum.join(demand, "product_code", "left").select(
        "product_code", "min_stock", "max_daily", "avg_daily",
        F.when(enough, F.greatest(F.lit(0.0), rules.whole(formula))).otherwise(few).alias("safety_stock"),
    )


def optimal_stock(weekly: DataFrame, products: DataFrame) -> DataFrame:
    """Median over weeks of units sold plus 75 % of the minimum stock, whole units.

    A product has at most five weeks in the look-back.
    """
    minimum = products.select(F.col("ma_hang").alias("product_code"), F.col("ton_nho_nhat").alias("min_stock"))
    median = weekly.groupBy("product_code").agg(
        F.percentile("weekly_sold", 0.5).alias("median_sold"),
        F.sum("weekly_sold").alias("quantity_sold"),
        F.sum("weekly_revenue").alias("revenue"),
    )
    # The minimum stock is the same every week, so it can be added to the median.
    level = F.col("median_sold") + F.coalesce("min_stock", F.lit(0)) * 0.75
    return minimum.join(median, "product_code", "left").select(
        "product_code",
        F.coalesce(rules.whole(level), F.lit(0.0)).alias("optimal_stock"),
        F.coalesce("quantity_sold", F.lit(0.0)).alias("quantity_sold"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
    )


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    """Forecast units per product with its attributes."""
    return forecasts.groupBy("ma_hang").agg(
        F.sum("predicted_quantity").alias("forecast_units"),
        F.countDistinct("forecast_date").alias("horizon_days"),
        F.min("ten_san_pham").alias("ten_san_pham"),
        F.min("nhom_hang_cap_1").alias("nhom_hang_cap_1"),
        F.min("abc_class").alias("abc_class"),
    )


def recommendations(summary: DataFrame, safety: DataFrame, stock: DataFrame, lead_days: int = 7) -> DataFrame:
    """Order advice for all products at once.

    Demand per day is the forecast over its own horizon. Below the minimum stock the gap is
    ordered, otherwise two weeks of demand. An order is urgent where the stock at hand does
    not last through the demand of the lead time and the safety stock.
    """
    avg_daily = F.try_divide("forecast_units", "horizon_days")
    minimum = F.coalesce("min_stock", F.lit(0)).cast("double")
    level = F.coalesce("safety_stock", F.lit(0.0))
    two_weeks = rules.whole(avg_daily * 14)
    joined = summary.join(
        safety.withColumnRenamed("product_code", "ma_hang").select("ma_hang", "min_stock", "safety_stock"),
        "ma_hang", "left",
    ).join(stock.select("ma_hang", "current_stock"), "ma_hang", "left")
    # Rounded, so that sums of doubles do not decide.
    spare = F.round(F.coalesce("current_stock", F.lit(0.0)) - avg_daily * lead_days - level, 6)
    return joined.select(
        F.col("ma_hang").alias("product_code"),
        F.col("forecast_units").alias("predicted_units"),
        avg_daily.alias("avg_daily_demand"),
        minimum.alias("min_stock"),
        level.alias("recommended_safety_stock"),
        two_weeks.alias("reorder_point"),
        F.when(level < minimum, F.greatest(F.lit(0.0), minimum - level)).otherwise(two_weeks)
        .alias("suggested_order_quantity"),
        F.when(level < minimum, "gap to minimum").otherwise("two weeks of demand").alias("order_logic"),
        F.when(spare < 0, "High").otherwise("Normal").alias("reorder_urgency"),
    )


def active_candidates(summary: DataFrame, sold_28d: DataFrame) -> DataFrame:
    """Class A products without a sale in 28 days are left out, as are unclassified ones."""
    sold = sold_28d.select(F.col("product_code").alias("ma_hang"), "sales_4weeks")
    joined = summary.join(sold, "ma_hang", "left").na.fill({"sales_4weeks": 0.0})
    kept = F.col("abc_class").isin("B", "C") | ((F.col("abc_class") == "A") & (F.col("sales_4weeks") > 0))
    return joined.filter(kept)


def order_needs(summary: DataFrame, last_week: DataFrame, stock: DataFrame, formula: str = "cover",
                targets: DataFrame | None = None) -> DataFrame:
    """Units to order per product.

    `cover`: 1.5 x forecast - last week - stock. `target` (needs `targets` with
    `product_code, target`): the larger of forecast and target stock, less stock.
    """
    lw = last_week.select(F.col("product_code").alias("ma_hang"), "last_week_sales")
    joined = (
        summary.join(lw, "ma_hang", "left")
        .join(stock.select("ma_hang", "current_stock"), "ma_hang", "left")
        .na.fill({"last_week_sales": 0.0, "current_stock": 0.0})
    )
    forecast, have = F.col("forecast_units"), F.col("current_stock")
    if formula == "cover":
        need = rules.suggested_order(forecast, F.col("last_week_sales"), have)
    elif formula == "target" and targets is not None:
        joined = joined.join(targets.withColumnRenamed("product_code", "ma_hang"), "ma_hang", "left")
        wanted = F.greatest(forecast, F.coalesce("target", F.lit(0.0)))
        need = rules.whole(F.greatest(F.lit(0.0), wanted - have))
    else:
        raise ValueError(f"unknown order formula {formula!r}")
    return joined.withColumn("suggested_order", need)


def purchase_order(
    needs: DataFrame, optimal: DataFrame, safety: DataFrame, products: DataFrame,
    top_n: int = 50, value_quantile: float = 0.8,
) -> DataFrame:
    """The `top_n` products to order with targets, priority and highlights.

    High value is judged within the listed products; the list is the `top_n` report.
    """
    price, cost = F.col("gia_ban_mac_dinh"), F.col("gia_von_mac_dinh")
    catalog = products.select(
        "ma_hang", "ma_vach", "ten_hang",
        F.when(cost > 0, (price - cost) / cost * 100).otherwise(0.0).alias("margin_pct"),
    )
    wide = (
        needs.join(optimal.withColumnRenamed("product_code", "ma_hang"), "ma_hang", "left")
        .join(safety.withColumnRenamed("product_code", "ma_hang").select("ma_hang", "min_stock", "safety_stock"),
              "ma_hang", "left")
        .join(catalog, "ma_hang", "left")
        .na.fill(0.0, ["optimal_stock", "quantity_sold", "revenue", "safety_stock", "margin_pct"])
        .na.fill(0, ["min_stock"])
        .withColumn("revenue", F.round("revenue", 2))
    )
    keys = [F.desc("suggested_order"), F.desc("quantity_sold"), F.desc("revenue"), F.asc("ma_hang")]
    listed = wide.orderBy(*keys).limit(top_n)
    # Windows over the whole list are fine: it has at most `top_n` rows.
    cut = F.percentile("revenue", value_quantile).over(Window.partitionBy())
    need, have = F.col("suggested_order"), F.col("current_stock")
    high_margin, high_value = F.col("margin_pct") > 20, F.col("revenue") >= cut
    return listed.select(
        F.row_number().over(Window.orderBy(*keys)).alias("stt"),
        "ma_hang", "ma_vach", F.coalesce("ten_hang", "ten_san_pham").alias("ten_san_pham"),
        need.alias("luong_can_nhap"),
        F.col("optimal_stock").alias("ton_kho_toi_uu"),
        F.col("safety_stock").alias("ton_an_toan"),
        (F.col("optimal_stock") + F.col("safety_stock")).alias("tong_muc_tieu"),
        F.col("min_stock").alias("ton_nho_nhat"),
        have.alias("ton_hien_tai"),
        rules.whole(F.col("forecast_units")).alias("du_bao"),
        F.col("quantity_sold").alias("da_ban_4tuan"),
        rules.whole(F.col("revenue")).alias("doanh_thu_4tuan"),
        F.bround("margin_pct", 1).alias("margin_pct"),
        F.when(need > have * 2, "urgent").when(need > 0, "needed").otherwise("enough").alias("uu_tien"),
        F.when(high_margin & high_value, "HIGH MARGIN + HIGH VALUE")
        .when(high_margin, "HIGH MARGIN").when(high_value, "HIGH VALUE").otherwise("").alias("ghi_chu"),
    )


def order_list(needs: DataFrame, products: DataFrame) -> DataFrame:
    """Name, barcode and quantity rounded up to full packs, one row per product."""
    catalog = products.select("ma_hang", "ten_hang", "ma_vach", "quy_doi")
    return needs.filter(F.col("suggested_order") > 0).join(catalog, "ma_hang", "left").select(
        "ma_hang", "ten_hang", F.coalesce("ma_vach", "ma_hang").alias("ma_vach"),
        F.col("suggested_order").alias("so_luong"),
        rules.round_to_pack(F.col("suggested_order"), F.col("quy_doi")).cast("double").alias("so_luong_theo_quy_doi"),
    )


def trends(needs: DataFrame) -> DataFrame:
    """Forecast against last week, both per week."""
    forecast = F.try_divide("forecast_units", "horizon_days") * 7
    last = F.col("last_week_sales")
    return needs.select(
        "ma_hang", forecast.alias("weekly_forecast"), "last_week_sales",
        rules.trend_pct(forecast, last).alias("trend_pct"),
        rules.trend_label(forecast, last).alias("trend"),
    )


def category_share(forecasts: DataFrame) -> DataFrame:
    """Share of each category in the forecast, with its band."""
    per_category = forecasts.groupBy("nhom_hang_cap_1").agg(F.sum("predicted_quantity").alias("quantity"))
    total = F.sum("quantity").over(Window.partitionBy())  # one row per category
    share = F.when(total > 0, F.col("quantity") / total * 100).otherwise(0.0)
    return per_category.withColumn("percentage", share).withColumn(
        "band", rules.share_band(F.col("percentage"))
    )

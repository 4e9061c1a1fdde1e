"""Staging: canonical sources under warehouse names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import dates, text
from shelfwise.functions.rules import ratio_or
from shelfwise.operators.facts import last_days


def stg_products(products: DataFrame) -> DataFrame:
    """Catalog under staging names with the default margin."""
    price, cost = F.col("gia_ban_mac_dinh"), F.col("gia_von_mac_dinh")
    return products.select(
        F.col("id").alias("product_id"),
        F.col("ma_hang").alias("product_code"),
        F.col("ma_vach").alias("barcode"),
        F.col("ten_hang").alias("product_name"),
        F.coalesce("thuong_hieu", F.lit("")).alias("brand"),
        *[F.col(f"cap_{i}").alias(f"category_level_{i}") for i in (1, 2, 3)],
        cost.alias("default_cost_price"),
        price.alias("default_selling_price"),
        "quy_doi",
        ratio_or(price - cost, price).alias("default_margin_rate"),
    )


def unit_cost(cost="gia_von_mac_dinh", price="don_gia"):
    """Catalog cost, or 70 % of the line price when the catalog has none."""
    return F.coalesce(F.col(cost), F.col(price) * 0.7)


def receipt_totals(details: DataFrame, products: DataFrame) -> DataFrame:
    """Money per receipt, from its lines."""
    costs = products.select("ma_hang", "gia_von_mac_dinh")
    quantity = F.col("so_luong")
    return (
        details.join(costs, "ma_hang", "left")
        .groupBy("transaction_id")
        .agg(
            F.sum(quantity * F.col("don_gia")).alias("gross_amount"),
            F.sum("chiet_khau").alias("discount_amount"),
            F.sum("thanh_tien").alias("revenue"),
            F.sum(quantity * unit_cost()).alias("total_cost"),
            F.count("*").alias("line_count"),
        )
    )


MONEY = ("gross_amount", "discount_amount", "revenue", "total_cost")


def stg_transactions(
    transactions: DataFrame, details: DataFrame, products: DataFrame, as_of=None, days: int = 0
) -> DataFrame:
    """Receipts with their money; a receipt without lines has zeros.

    With `days`, only receipts of that look-back, and lines of other receipts are dropped
    before anything is summed.
    """
    if days:
        transactions = last_days(transactions, as_of, days, "ngay")
        wanted = transactions.select(F.col("id").alias("transaction_id"))
        details = details.join(wanted, "transaction_id", "left_semi")
    money = receipt_totals(details, products)
    joined = transactions.join(money, F.col("id") == F.col("transaction_id"), "left")
    zeroed = [F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in MONEY]
    extra = [c for c in ("ma_khach",) if c in transactions.columns]
    return joined.select(
        F.col("id").alias("transaction_id"),
        F.col("ma_giao_dich").alias("transaction_code"),
        F.col("ma_chi_nhanh").alias("branch_id"),
        F.col("ma_chi_nhanh").alias("branch_code"),
        F.col("ten_chi_nhanh").alias("branch_name"),
        F.to_date("ngay").alias("transaction_date"),
        *extra,
        *zeroed,
        F.coalesce(F.col("line_count"), F.lit(0)).alias("line_count"),
    ).withColumn("gross_profit", F.col("revenue") - F.col("total_cost"))


def stg_transaction_details(
    details: DataFrame, products: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Lines with product and receipt lookups, revenue, cost and profit."""
    catalog = products.select(
        F.col("ma_hang").alias("product_code"),
        F.col("ten_hang").alias("product_name"),
        F.coalesce("thuong_hieu", F.lit("")).alias("brand"),
        F.coalesce("cap_1", F.lit("")).alias("category_l1"),
        F.coalesce("cap_2", F.lit("")).alias("category_l2"),
        F.coalesce("cap_3", F.lit("")).alias("category_l3"),
        "gia_von_mac_dinh",
    )
    receipts = transactions.select(
        F.col("id").alias("transaction_id"),
        F.col("ma_chi_nhanh").alias("branch_code"),
        F.to_date("ngay").alias("transaction_date"),
    )
    revenue = F.col("quantity") * F.col("unit_price")
    cost = F.col("quantity") * unit_cost(price="unit_price")
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("brand", "category_l1", "category_l2", "category_l3")]
    return (
        details.select(
            "transaction_id",
            F.col("ma_hang").alias("product_code"),
            F.col("so_luong").alias("quantity"),
            F.col("don_gia").alias("unit_price"),
            F.col("chiet_khau").alias("discount_amount"),
            F.col("thue_gtgt").alias("tax_amount"),
            F.col("thanh_tien").alias("line_total"),
        )
        .join(catalog, "product_code", "left")
        .join(receipts, "transaction_id", "left")
        .select(
            "transaction_id", "product_code", "product_name", *blank,
            "quantity", "unit_price", "discount_amount", "tax_amount", "line_total",
            revenue.alias("line_revenue"),
            cost.alias("line_cost"),
            (revenue - cost).alias("line_profit"),
            "branch_code", "transaction_date",
        )
    )


def stg_transactions_enriched(transactions: DataFrame) -> DataFrame:
    """Receipts with calendar fields."""
    d = F.to_date("ngay")
    return transactions.select(
        F.col("ma_giao_dich").alias("transaction_id"),
        F.col("ma_chi_nhanh").alias("branch_code"),
        F.col("ten_chi_nhanh").alias("branch_name"),
        d.alias("transaction_date"),
        dates.date_key(d).alias("date_key"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        dates.iso_dow(d).alias("day_of_week"),
        F.quarter(d).alias("quarter"),
        dates.is_weekend(d).cast("int").alias("is_weekend"),
    )


def stg_product_variant(stg: DataFrame) -> DataFrame:
    """Family name and pack size read from the product name."""
    name = F.col("product_name")
    return stg.select(
        "product_id",
        "product_code",
        name.alias("clean_name"),
        text.pack_label(name).alias("weight"),
        text.pack_unit(name).alias("unit"),
        text.pack_size_base(name).alias("weight_normalized_g_or_ml"),
        text.family_name(name).alias("product_family"),
        "default_selling_price",
        "default_cost_price",
    )


def stg_branches(branches: DataFrame) -> DataFrame:
    """B15."""
    return branches.select(
        F.col("ma_chi_nhanh").alias("branch_id"),
        F.col("ma_chi_nhanh").alias("branch_code"),
        F.col("ten_chi_nhanh").alias("branch_name"),
        F.lit("").alias("address"),
        "city",
        F.col("store_type_code").alias("branch_type"),
    )


def stg_inventory(stock: DataFrame) -> DataFrame:
    """Stock snapshots with turnover, days of inventory and stock-to-sales."""
    opening, sold, closing = F.col("ton_dau_ky"), F.col("sl_xuat"), F.col("ton_cuoi_ky")
    none = F.lit(0.0)
    return stock.select(
        F.col("ma_hang").alias("product_code"),
        F.col("chi_nhanh").alias("branch_name"),
        F.col("snapshot_date").alias("inventory_date"),
        opening.alias("opening_stock"),
        F.col("sl_nhap").alias("quantity_imported"),
        sold.alias("quantity_exported"),
        closing.alias("closing_stock"),
        (sold / F.nullif((opening + closing) / 2, none)).alias("inventory_turnover"),
        (closing / F.nullif(sold / 30, none)).alias("days_of_inventory"),
        (closing / F.nullif(sold, none)).alias("stock_to_sales_ratio"),
    )


def with_price_fallback(details: DataFrame, products: DataFrame) -> DataFrame:
    """Catalog price, else line price, else 0."""
    catalog = products.select("ma_hang", "gia_ban_mac_dinh", "gia_von_mac_dinh")
    return (
        details.join(catalog, "ma_hang", "left")
        .withColumns({
            "gia_ban": F.coalesce("gia_ban_mac_dinh", "don_gia", F.lit(0.0)),
            "gia_von": F.coalesce("gia_von_mac_dinh", F.lit(0.0)),
        })
        .drop("gia_ban_mac_dinh", "gia_von_mac_dinh")
    )

"""Product, branch and store dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.rules import bands, price_tier
from shelfwise.operators.ordered import with_rank
from shelfwise.session import day, pinned

# Branch tier by revenue relative to the mean branch.
TIERS = [(1.5, "Star"), (1.0, "Standard"), (0.5, "Developing")]


def ranked_branches(totals: DataFrame) -> DataFrame:
    """Revenue and profit ranks, and ratios to the mean branch."""
    totals = pinned(totals)
    means = totals.agg(
        F.struct(F.avg("total_revenue").alias("r"), F.avg("total_profit").alias("p"))
    ).scalar()
    whole = totals.withColumns({c: F.round(c, 2) for c in ("total_revenue", "total_profit")})
    ranked = with_rank(with_rank(whole, "total_revenue", "revenue_rank"), "total_profit", "profit_rank")
    return ranked.withColumns({
        "revenue_vs_avg": F.try_divide("total_revenue", means["r"]),
        "profit_vs_avg": F.try_divide("total_profit", means["p"]),
    })


def branch_performance(totals: DataFrame, stg_branches: DataFrame) -> DataFrame:
    """Branch totals with names, ranks and ratios."""
    names = stg_branches.select("branch_code", "branch_name", "city", "branch_type")
    return ranked_branches(totals).join(names, "branch_code", "left")


def dim_branch(stg_branches: DataFrame, performance: DataFrame) -> DataFrame:
    """Every branch with its totals and performance tier."""
    perf = performance.select(
        "branch_code", "total_revenue", "total_transactions", "avg_transaction_value",
        "revenue_rank", "revenue_vs_avg",
    )
    def zero(name):
        return F.coalesce(F.col(name), F.lit(0))

    return stg_branches.join(perf, "branch_code", "left").select(
        "branch_id", "branch_code", "branch_name", "address", "city", "branch_type",
        zero("total_revenue").cast("double").alias("total_historical_revenue"),
        zero("total_transactions").alias("total_historical_transactions"),
        zero("avg_transaction_value").cast("double").alias("avg_transaction_value"),
        zero("revenue_rank").alias("revenue_rank"),
        bands(F.col("revenue_vs_avg"), TIERS, "Underperforming").alias("performance_tier"),
    )


def dim_store(stg_branches: DataFrame, store_types: DataFrame) -> DataFrame:
    """Stores with type, peer group and an id numbered within the type."""
    number = F.row_number().over(Window.partitionBy("branch_type").orderBy("branch_id"))
    kind = store_types.select(
        F.col("type_code").alias("branch_type"),
        F.col("type_name_vn").alias("store_type_name"),
        F.col("type_code_2").alias("peer_group"),
        F.col("description").alias("store_type_description"),
        "typical_area_m2", "target_customer",
    )
    padded = F.lpad(number.cast("string"), 3, "0")
    return (
        stg_branches.withColumn("store_id", F.concat("branch_type", F.lit("_"), padded))
        .join(kind, "branch_type", "left")
        .select(
            "store_id", F.col("branch_type").alias("store_type_code"), "store_type_name",
            "peer_group", "store_type_description", "typical_area_m2", "target_customer",
            "branch_code", F.col("branch_name").alias("store_name"), "address", "city",
            *[F.lit(0).alias(c) for c in ("store_area_m2", "selling_area_m2", "storage_area_m2")],
            F.lit("2000-01-01").cast("date").alias("open_date"),
            F.lit("active").alias("status"),
        )
    )


def product_status(last_sale, as_of):
    """Never sold is new; then by days since the last sale."""
    today = day(as_of)
    return (
        F.when(last_sale.isNull(), "New")
        .when(last_sale >= F.date_sub(today, 30), "Active")
        .when(last_sale >= F.date_sub(today, 90), "Slow Moving")
        .otherwise("Inactive")
    )


def dim_product(
    stg_products: DataFrame, variants: DataFrame, performance: DataFrame, as_of,
    price_cuts=(1_000_000, 500_000, 200_000),
) -> DataFrame:
    """Catalog with variant, totals, price tier, status and the ABC class of `performance`."""
    parsed = variants.select("product_code", "clean_name", "weight", "unit", "weight_normalized_g_or_ml")
    perf = performance.select(
        "product_code", "total_revenue", "total_quantity_sold", "profit_margin", "last_sale_date", "abc_class"
    )
    return (
        stg_products.join(parsed, "product_code", "left")
        .join(perf, "product_code", "left")
        .select(
            "product_id", "product_code", "barcode", "product_name", "clean_name", "brand",
            "category_level_1", "category_level_2", "category_level_3",
            "weight", "unit", "weight_normalized_g_or_ml",
            "default_cost_price", "default_selling_price", "default_margin_rate",
            price_tier(F.col("default_selling_price"), price_cuts).alias("price_tier"),
            F.coalesce("abc_class", F.lit("N/A")).alias("abc_class"),
            F.coalesce("total_revenue", F.lit(0.0)).alias("total_historical_revenue"),
            F.coalesce("total_quantity_sold", F.lit(0.0)).alias("total_historical_quantity"),
            F.coalesce("profit_margin", F.lit(0.0)).alias("historical_profit_margin"),
            product_status(F.col("last_sale_date"), as_of).alias("product_status"),
        )
    )


def apply_abc(dim: DataFrame, abc: DataFrame) -> DataFrame:
    """Class and revenue of a new classification written over the dimension."""
    fresh = abc.select(
        "product_code", F.col("abc_class").alias("_class"), F.col("total_revenue").alias("_revenue")
    )
    return (
        dim.join(fresh, "product_code", "left")
        .withColumns({
            "abc_class": F.coalesce("_class", "abc_class"),
            "total_historical_revenue": F.coalesce("_revenue", "total_historical_revenue"),
        })
        .drop("_class", "_revenue")
    )

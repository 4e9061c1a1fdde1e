"""ABC, RFM, outliers, peer groups, seasonal profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import dates, rules
from shelfwise.functions.text import PROMO_PATTERNS, is_promo
from shelfwise.operators.ordered import quantiles, running_totals, shared_totals, tile_of, with_scores
from shelfwise.session import day, pinned


def abc_classify(
    df: DataFrame, key: str, value: str, a: float = 0.8, b: float = 0.95,
    frame: str = "rows", tiles: int = 0,
) -> DataFrame:
    """Class by cumulative share of `value`, largest first.

    `rows` adds one row at a time (ties by key), `range` lets equal values share their
    total. With `tiles`, `revenue_percentile` numbers equal parts of the ranking.
    """
    cents = df.withColumn(value, F.round(F.coalesce(F.col(value), F.lit(0.0)), 2))
    if frame == "range":
        if tiles:
            raise ValueError("tiles need the rows frame")
        ranked = shared_totals(cents, {"cumulative": F.col(value)}, value)
    else:
        sums = {"cumulative": F.col(value)}
        if tiles:
            sums["_pos"] = F.lit(1).cast("bigint")
        ranked = running_totals(cents, sums, [F.col(value).desc(), F.col(key).asc()])
    share = F.try_divide("cumulative", "all_cumulative")
    # Sums of cents in doubles may exceed a cut they should meet exactly.
    shared = ranked.withColumn("cumulative_pct", F.round(share, 9))
    classed = shared.withColumn("abc_class", rules.abc_class(F.col("cumulative_pct"), a, b)).withColumnsRenamed(
        {"all_cumulative": "grand_total"}
    )
    if not tiles:
        return classed
    tile = tile_of(F.col("_pos"), F.col("all__pos"), tiles)
    return classed.withColumn("revenue_percentile", tile).drop("_pos", "all__pos")


def abc_summary(classed: DataFrame, value: str) -> DataFrame:
    """Rows and value per class."""
    return classed.groupBy("abc_class").agg(F.count("*").alias("cnt"), F.sum(value).alias("total_rev"))


def rfm_base(receipts: DataFrame, as_of, key: str = "branch_code", days: int = 365) -> DataFrame:
    """Recency, purchase days, money and profit per customer over a year."""
    today = day(as_of)
    recent = receipts.filter(F.col("transaction_date") >= F.date_sub(today, days))
    per_day = recent.groupBy(F.col(key).alias("customer_id"), "transaction_date").agg(
        F.sum("revenue").alias("revenue"), F.count("*").alias("orders"),
        F.sum("gross_profit").alias("profit"),
    )
    return per_day.groupBy("customer_id").agg(
        F.datediff(today, F.max("transaction_date")).alias("recency_days"),
        F.count("*").alias("frequency"),
        F.round(F.sum("revenue"), 2).alias("monetary"),
        (F.sum("revenue") / F.sum("orders")).alias("avg_order_value"),
        F.sum("profit").alias("total_profit"),
    )


# Tests on the scores r, f, m and their label. The first test that holds
# counts, so a later line may never be reached.
RFM_SEGMENTS = (
    ("r >= 4 AND f >= 4 AND m >= 4", "Champions"),
    ("r >= 4 AND f >= 4 AND m >= 2", "Loyal Customers"),
    ("r >= 4 AND f >= 2", "Potential Loyalists"),
    ("r >= 4 AND f <= 2", "New Customers"),
    ("r >= 3 AND f <= 2", "Promising"),
    ("r >= 3 AND f >= 3", "Need Attention"),
    ("r >= 2 AND f >= 2", "About to Sleep"),
    ("r <= 2 AND f >= 4", "At Risk"),
    ("r <= 2 AND f >= 4 AND m >= 4", "Cannot Lose Them"),
    ("r <= 2 AND f <= 2", "Hibernating"),
    ("true", "Lost"),
)
RFM_ACTIONS = (
    ("r >= 4 AND f >= 4 AND m >= 4", "Reward them, early adopter for new products"),
    ("r >= 4 AND f >= 4", "Upsell higher value products"),
    ("r >= 4 AND f >= 2", "Offer membership/loyalty program"),
    ("r >= 4 AND f <= 2", "Make them familiar, nurture them"),
    ("r >= 3 AND f <= 2", "Offer free trials, build trust"),
    ("r >= 3 AND f >= 3", "Make limited time offers"),
    ("r >= 2 AND f >= 2", "Share valuable resources"),
    ("r <= 2 AND f >= 4", "Send personalized reactivation campaigns"),
    ("r <= 2 AND f >= 4 AND m >= 4", "Win them back via renewals/helpful products"),
    ("r <= 2 AND f <= 2", "Offer discounts/win-back campaigns"),
    ("true", "Ignore"),
)


def first_label(rules_table) -> Column:
    """Label of the first test of a (test, label) table that holds."""
    tests = [F.when(F.expr(test), label) for test, label in rules_table]
    return F.coalesce(*tests)


def rfm(base: DataFrame) -> DataFrame:
    """Quintile scores (5 best), combined score, segment and action."""
    values = {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"), "m_score": F.col("monetary")}
    scored = with_scores(base, "customer_id", values, 5)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        scored.withColumns({"r": r, "f": f, "m": m, "rfm_score": r * 100 + f * 10 + m})
        .withColumns({
            "rfm_segment": first_label(RFM_SEGMENTS),
            "recommended_action": first_label(RFM_ACTIONS),
        })
        .drop("r", "f", "m")
    )


def customer_transactions(receipts: DataFrame, branches: DataFrame) -> DataFrame:
    """One feature row per receipt, the receipt standing for the customer."""
    city = branches.select("branch_code", "city")
    d = F.col("transaction_date")
    return receipts.join(city, "branch_code", "left").select(
        F.col("transaction_code").alias("customer_id"), "branch_code", "city",
        "transaction_date", dates.iso_dow(d).alias("day_of_week"),
        "revenue", "gross_profit", "discount_amount", F.col("line_count").alias("item_count"),
    )


def with_zscore(df: DataFrame, value: str, name: str) -> DataFrame:
    """Absolute distance from the mean in sample standard deviations."""
    s = df.agg(F.struct(F.avg(value).alias("m"), F.stddev_samp(value).alias("s"))).scalar()
    return df.withColumn(name, F.abs(F.try_divide(F.col(value) - s["m"], s["s"])))


def flag_outliers(
    df: DataFrame, revenue: str = "doanh_thu", quantity: str = "so_luong",
    unit_profit: str = "loi_nhuan_sp", margin: str = "ty_suat_loi_nhuan",
) -> DataFrame:
    """I8: revenue beyond 3 deviations, quantity outside 1.5 IQR, odd margins.

    One pass reduces the lines to moments of revenue per distinct quantity; quartiles,
    mean and deviation all come from that small table.
    """
    moments = pinned(df.groupBy(quantity).agg(
        F.count("*").alias("rows"), F.count(revenue).alias("n"),
        F.avg(revenue).alias("m"), F.var_pop(revenue).alias("v"),
    ))
    quartiles = quantiles(moments, quantity, {"q1": 0.25, "q3": 0.75}, weight="rows").agg(
        F.struct(F.max("q1").alias("q1"), F.max("q3").alias("q3"))
    ).scalar()
    mean = moments.agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).scalar()
    spread = moments.agg(F.sqrt(F.try_divide(
        F.sum(F.col("n") * (F.col("v") + F.pow(F.col("m") - mean, 2.0))), F.sum("n") - 1
    ))).scalar()
    q1, q3 = quartiles["q1"], quartiles["q3"]
    reach = (q3 - q1) * 1.5
    q = F.col(quantity)

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    scored = df.withColumn("revenue_zscore", F.abs(F.try_divide(F.col(revenue) - mean, spread)))
    return scored.withColumns({
        "is_revenue_outlier": flag(F.col("revenue_zscore") > 3),
        "is_quantity_outlier": flag((q < q1 - reach) | (q > q3 + reach)),
        "is_margin_outlier": flag((F.col(unit_profit) < 0) | (F.col(margin) > 100)),
    })


def branch_metrics(lines: DataFrame) -> DataFrame:
    """Revenue and profit per branch and its peer group."""
    return lines.groupBy("chi_nhanh", rules.peer_group(F.col("chi_nhanh")).alias("peer_group")).agg(
        F.round(F.sum("doanh_thu"), 2).alias("total_revenue"),
        F.avg("doanh_thu").alias("avg_transaction"),
        F.count("*").alias("transaction_count"),
        F.sum("loi_nhuan_gop").alias("total_profit"),
    )


def rank_branches(metrics: DataFrame) -> DataFrame:
    """Rank by revenue within the peer group; equal revenues share the mean rank.

    Counted per distinct revenue, so the window sees one row per group and value.
    """
    per_value = metrics.groupBy("peer_group", "total_revenue").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("peer_group").orderBy(F.desc("total_revenue"))
    ranks = per_value.select(
        "peer_group", "total_revenue",
        (F.sum("_n").over(ahead) - (F.col("_n") - 1) / 2).alias("branch_rank"),
    )
    return metrics.join(ranks, ["peer_group", "total_revenue"])


def seasonal_index(lines: DataFrame, key: str = "ma_hang") -> DataFrame:
    """Mean revenue of a product's month over its overall mean."""
    per_month = lines.groupBy(key, F.month("ngay").alias("month")).agg(
        F.sum("doanh_thu").alias("s"), F.count("doanh_thu").alias("n")
    )
    product = Window.partitionBy(key)
    overall = F.try_divide(F.sum("s").over(product), F.sum("n").over(product))
    return per_month.select(
        key, "month", F.try_divide(F.try_divide("s", "n"), overall).alias("seasonal_index")
    )


def seasonal_profile(lines: DataFrame) -> DataFrame:
    """Season, weekend, quarter, month name and seasonal index on lines."""
    d = F.col("ngay")
    labelled = lines.withColumns({
        "month": F.month(d),
        "season": dates.season(d, "meteo"),
        "is_weekend": dates.is_weekend(d),
        "quarter": F.quarter(d),
        "month_name": F.date_format(d, "MMMM"),
    })
    return labelled.join(seasonal_index(lines), ["ma_hang", "month"], "left")


def enrich(lines: DataFrame) -> DataFrame:
    """ABC class, season, outliers and branch rank attached to lines.

    `lines` is read several times, so pass a written table rather than a long plan.
    """
    revenue = lines.groupBy("ma_hang").agg(F.sum("doanh_thu").alias("revenue"))
    classed = abc_classify(revenue, "ma_hang", "revenue")
    classes = classed.select(
        "ma_hang", "abc_class", F.try_divide("revenue", "grand_total").alias("revenue_pct")
    )
    ranks = rank_branches(branch_metrics(lines)).select("chi_nhanh", "peer_group", "branch_rank")
    with_class = lines.join(classes, "ma_hang", "left")
    return flag_outliers(seasonal_profile(with_class)).join(ranks, "chi_nhanh", "left")


def run_stats(enriched: DataFrame) -> DataFrame:
    """Counts by class, peer group and season, outliers and the date range."""
    flags = ("is_revenue_outlier", "is_quantity_outlier", "is_margin_outlier")
    pairs = [F.struct(F.lit("total").alias("statistic"), F.lit("").alias("value"))]
    pairs += [F.struct(F.lit(n).alias("statistic"), F.col(n).alias("value"))
              for n in ("abc_class", "peer_group", "season")]
    pairs += [F.when(F.col(f), F.struct(F.lit("outlier").alias("statistic"), F.lit(f[3:]).alias("value")))
              for f in flags]
    listed = enriched.select(F.explode(F.array_compact(F.array(*pairs))).alias("p"))
    return listed.groupBy("p.statistic", "p.value").agg(F.count("*").alias("records"))


def top_products(
    dim: DataFrame, n: int = 50, classes: Sequence[str] = ("A", "B", "C"), patterns=PROMO_PATTERNS
) -> DataFrame:
    """the products with most past revenue, promotions left out."""
    return (
        dim.filter(
            F.col("abc_class").isin(*classes)
            & (F.col("total_historical_revenue") > 0)
            & ~is_promo(F.col("category_level_1"), patterns)
        )
        .select("product_code", "abc_class", "total_historical_revenue")
        .orderBy(F.desc("total_historical_revenue"), "product_code")
        .limit(n)
    )

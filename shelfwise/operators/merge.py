"""Keyed merges without MERGE.

Each returns the new table state. Write it to a new path (or overwrite single partitions);
never overwrite the path it is read from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.ordered import first_per_key, join_on


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str],
    columns: Sequence[str] | None = None, order: Sequence[Column | str] = (),
) -> DataFrame:
    """Rows of `updates` replace rows of equal key; only `columns` when given.

    One full join: the target is read and shuffled once. Of repeated updates the first by
    `order` counts. Null keys equal null.
    """
    latest = first_per_key(updates, keys, order).withColumn("_hit", F.lit(True))
    changed = set(columns if columns is not None else updates.columns) - set(keys)
    t, u = target.withColumn("_here", F.lit(True)).alias("t"), latest.alias("u")
    joined = t.join(u, [F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys], "full")
    hit, absent = F.col("u._hit").isNotNull(), F.col("t._here").isNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.when(absent, F.col(f"u.{name}")).otherwise(F.col(f"t.{name}"))
        if name not in updates.columns:
            return F.col(f"t.{name}")
        use = hit if name in changed else hit & absent
        return F.when(use, F.col(f"u.{name}")).otherwise(F.col(f"t.{name}"))

    return joined.select(*[merged(c).alias(c) for c in target.columns])


def insert_new(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """Rows whose key the target lacks are added, once per key; null keys equal null."""
    fresh = join_on(first_per_key(rows, keys, order), target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def attach_ids(lines: DataFrame, transactions: DataFrame) -> DataFrame:
    """C14: receipt id for each line, by receipt code."""
    ids = transactions.select(F.col("id").alias("transaction_id"), "ma_giao_dich")
    return lines.join(ids, "ma_giao_dich").drop("ma_giao_dich")


def dedupe_details(details: DataFrame, order: Sequence[Column | str] = ()) -> DataFrame:
    """One line per receipt and product."""
    return first_per_key(details, ["transaction_id", "ma_hang"], order)


def selected_only(df: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a product list."""
    return df.join(selected.select(key), key, "left_semi")


def barcode(column: str) -> Column:
    """A barcode to join by: null when blank."""
    return F.nullif(F.trim(F.col(column)), F.lit(""))


def sales_with_products(sales: DataFrame, products: DataFrame, sale_id: str) -> DataFrame:
    """Sales matched to products by barcode or by product code.

    Two equi joins and a union stand in for the OR condition; a product that matches both
    ways counts once, and unmatched sales stay with empty product columns. A blank barcode
    matches nothing.
    """
    known = products.select(
        barcode("ma_vach").alias("p_vach"), F.col("ma_hang").alias("p_hang"),
        F.col("thuong_hieu").alias("product_brand"),
        *[F.col(f"cap_{i}").alias(f"product_cat{i}") for i in (1, 2, 3)],
        F.lit(True).alias("_hit"),
    )
    keys = sales.select(sale_id, "ma_vach", "ma_hang")
    by_code = keys.join(known, F.col("ma_hang") == F.col("p_hang"))
    by_barcode = keys.join(known, barcode("ma_vach") == F.col("p_vach")).filter(
        ~F.coalesce(F.col("p_hang") == F.col("ma_hang"), F.lit(False))
    )
    found = [c for c in known.columns if c != "p_vach"]
    matched = by_code.unionByName(by_barcode).select(sale_id, *found)
    return (
        sales.join(matched, sale_id, "left")
        .withColumn("co_trong_products", F.col("_hit").isNotNull())
        .withColumnRenamed("p_hang", "product_code")
        .drop("_hit")
    )


def import_delta(before: DataFrame, after: DataFrame, date_column: str) -> DataFrame:
    """K9: rows and days before and after an import."""
    def counts(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(
            F.lit(stage).alias("stage"), F.count("*").alias("rows"),
            F.countDistinct(date_column).alias("days"),
        )

    return counts(before, "before").unionByName(counts(after, "after"))

"""The four canonical sources (and stock) over the order-line test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise.session import tune
from shelfwise.sources.reference import STORE_TYPES


class Sources:
    """Lazy canonical tables of one data folder."""

    # Region keys 0..4 stand for the five store types.
    store_codes = tuple(row[0] for row in STORE_TYPES)

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder
        # Reading a footer costs a job, so each file's is read once here.
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        reader = self.spark.read
        if path in self._schemas:
            return reader.schema(self._schemas[path]).parquet(path)
        df = reader.parquet(path)
        self._schemas[path] = df.schema
        return df

    @cached_property
    def branches(self) -> DataFrame:
        code = F.element_at(
            F.array(*[F.lit(c) for c in self.store_codes]), F.col("r_regionkey") + 1
        )
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_name").alias("ma_chi_nhanh"),
                F.col("n_name").alias("ten_chi_nhanh"),
                F.col("r_name").alias("city"),
                code.alias("store_type_code"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_partkey").cast("string").alias("ma_hang"),
            F.concat(F.lit("BC"), F.col("p_partkey")).alias("ma_vach"),
            F.col("p_name").alias("ten_hang"),
            F.col("p_brand").alias("thuong_hieu"),
            F.lit("").alias("don_vi_tinh"),
            F.col("p_type").alias("cap_1"),
            F.col("p_brand").alias("cap_2"),
            F.lit("").alias("cap_3"),
            F.col("p_retailprice").alias("gia_ban_mac_dinh"),
            F.round(F.col("p_retailprice") * 0.7, 2).alias("gia_von_mac_dinh"),
            F.col("p_size").alias("quy_doi"),
            F.col("p_size").alias("ton_nho_nhat"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("o_orderkey").cast("string").alias("ma_giao_dich"),
                F.to_date("o_orderdate").alias("ngay"),
                F.col("n_name").alias("ma_chi_nhanh"),
                F.col("n_name").alias("ten_chi_nhanh"),
                F.col("o_custkey").alias("ma_khach"),
            )
        )

    @cached_property
    def details(self) -> DataFrame:
        price = F.col("l_extendedprice")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_partkey").cast("string").alias("ma_hang"),
            F.col("l_quantity").alias("so_luong"),
            (price / F.col("l_quantity")).alias("don_gia"),
            (price * F.col("l_discount")).alias("chiet_khau"),
            (price * F.col("l_tax")).alias("thue_gtgt"),
            price.alias("thanh_tien"),
        )

    @cached_property
    def as_of(self) -> Column:
        """Newest order date, in place of today.

        A literal, read once by one small job: look-backs against it reach the scan, which a
        subquery's value does not.
        """
        newest = self.table("orders").agg(F.max("o_orderdate").cast("date")).first()[0]
        return F.lit(newest).cast("date")

    @cached_property
    def stock(self) -> DataFrame:
        """Month-end stock per product and branch, derived from sales.

        Opening stock is the running balance of (product key mod 7) per month before.
        """
        sold = (
            self.details.join(self.transactions, F.col("transaction_id") == F.col("id"))
            .groupBy("ma_hang", F.col("ma_chi_nhanh").alias("chi_nhanh"),
                     F.last_day("ngay").alias("snapshot_date"))
            .agg(F.sum("so_luong").alias("sl_xuat"))
        )
        spare = (F.col("ma_hang").cast("bigint") % 7).cast("double")
        months = Window.partitionBy("ma_hang", "chi_nhanh").orderBy("snapshot_date")
        closing = F.sum("spare").over(months.rowsBetween(Window.unboundedPreceding, 0))
        return (
            sold.withColumn("spare", spare)
            .withColumn("ton_cuoi_ky", closing)
            .select(
                "ma_hang",
                F.concat(F.lit("BC"), F.col("ma_hang")).alias("ma_vach"),
                "chi_nhanh",
                (F.col("ton_cuoi_ky") - F.col("spare")).alias("ton_dau_ky"),
                (F.col("sl_xuat") + F.col("spare")).alias("sl_nhap"),
                "sl_xuat",
                "ton_cuoi_ky",
                "snapshot_date",
            )
        )

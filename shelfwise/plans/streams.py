"""Queries that run a stream over files derived from the tables until all is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import facts
from shelfwise.plans.cleaning import _RAW, raw_sales
from shelfwise.plans.facts import _STATE
from shelfwise.plans.query import query
from shelfwise.session import scratch_path
from shelfwise.sources import files
from shelfwise.streaming import ingest


@query(
    "L1_file_stream", "L1 L2 A18",
    f"""{_RAW}, answer AS (
      SELECT strftime(thoi_gian, '%Y-%m') AS thang, chi_nhanh, count(*) AS n,
             CAST(sum(so_luong) AS BIGINT) AS so_luong
      FROM cleaned GROUP BY 1, 2)""",
)
def file_stream(s):
    """Raw files dropped twice, read by a stream, cleaned and inserted once."""
    spark, base = s.spark, scratch_path(s.spark, "drop")
    rows = raw_sales(s)
    for _ in range(2):
        rows.write.mode("append").options(header=True, escape='"', compression="gzip").csv(f"{base}/in")
    ingest.ingest_sales(
        spark, f"{base}/in", f"{base}/lines", f"{base}/state", f"{base}/archive", files_per_batch=8, grain="month"
    ).awaitTermination()
    return spark.read.parquet(f"{base}/lines").groupBy("thang", "chi_nhanh").agg(
        F.count("*").alias("n"), F.sum("so_luong").alias("so_luong")
    )


@query("L3_stream_totals", "L3 D17", f"{_STATE}, answer AS (SELECT * FROM states)", two="doanh_thu loi_nhuan so_luong")
def stream_totals(s):
    """Lines streamed in several batches; the merged states equal the batch totals."""
    spark, base = s.spark, scratch_path(s.spark, "totals")
    catalog = s.products.select(
        F.col("ma_hang").alias("product_code"), F.col("gia_von_mac_dinh").alias("cost"), "cap_1", "cap_2"
    )
    cost = F.coalesce("cost", F.col("unit_price") * 0.7)
    lines = facts.sales_lines(s.transactions, s.details).join(catalog, "product_code", "left").select(
        F.col("transaction_date").alias("ngay"), F.col("branch_code").alias("chi_nhanh"),
        F.coalesce("cap_1", F.lit("")).alias("nhom_hang_cap_1"), F.coalesce("cap_2", F.lit("")).alias("nhom_hang_cap_2"),
        F.col("net_amount").alias("doanh_thu"), (F.col("net_amount") - F.col("quantity") * cost).alias("loi_nhuan"),
        F.col("quantity").alias("so_luong"),
    )
    lines.write.parquet(f"{base}/in")
    stream = ingest.drop_folder(spark, f"{base}/in", schema=lines.schema, fmt="parquet", files_per_batch=4)
    ingest.drain(stream, f"{base}/state", ingest.add_states(f"{base}/totals")).awaitTermination()
    return ingest.current_states(spark, f"{base}/totals")


@query(
    "A14_append_forecasts", "A14 A16",
    """answer AS (
      SELECT CAST(d + 1 AS DATE) AS forecast_date, ma_hang, count(*) * 2 AS rows, sum(so_luong) * 2 / 60 AS predicted_quantity
      FROM lines, newest GROUP BY 1, 2)""",
    four="predicted_quantity",
)
def append_forecasts(s):
    """One row per line and twice over: forecasts appended to a table, summed, and written as JSON."""
    base = scratch_path(s.spark, "forecasts")
    lines = facts.sales_lines(s.transactions, s.details)
    rows = lines.select(
        F.date_add(s.as_of, 1).alias("forecast_date"), F.col("product_code").alias("ma_hang"),
        (F.col("quantity") / 60).alias("predicted_quantity"), F.lit(1).alias("unknown_column"),
    )
    for _ in range(2):
        files.write_forecasts(rows, f"{base}/table")
    summed = s.spark.read.parquet(f"{base}/table").groupBy("forecast_date", "ma_hang").agg(
        F.count("*").alias("rows"), F.sum("predicted_quantity").alias("predicted_quantity")
    )
    files.write_report(summed, f"{base}/report")
    return s.spark.read.schema(summed.schema).json(f"{base}/report")

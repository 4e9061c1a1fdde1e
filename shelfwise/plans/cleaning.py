"""Queries over raw files, cleaning and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import text
from shelfwise.operators import clean, merge
from shelfwise.plans.query import query
from shelfwise.session import scratch_path
from shelfwise.sources import files
from shelfwise.sources.schemas import RAW_SALES, SALES_NAMES


def raw_sales(s) -> DataFrame:
    """All order lines as raw sales lines, with the flaws such files have.

    Untaxed lines have an unreadable time, returned lines a negative quantity, undiscounted
    lines no discount; small parts have no brand and their category path has 0-3 levels.
    """
    receipts = s.transactions.join(
        s.branches.select("ma_chi_nhanh", "store_type_code"), "ma_chi_nhanh"
    )
    # Receipts join last and by their code: lines are then placed by a key of the deduplication,
    # which needs no shuffle of the wide rows.
    line = s.table("lineitem").join(s.table("part"), F.col("l_partkey") == F.col("p_partkey")).join(
        receipts, F.col("l_orderkey").cast("string") == F.col("ma_giao_dich")
    )
    hour = F.lpad((F.col("l_linenumber") * 3).cast("string"), 2, "0")
    sep = F.lit(" >> ")
    path = (
        F.when(F.col("p_size") <= 10, "")
        .when(F.col("p_size") <= 20, F.col("p_type"))
        .when(F.col("p_size") <= 30, F.concat("p_type", sep, "p_brand"))
        .otherwise(F.concat("p_type", sep, "p_brand", sep, "p_name"))
    )
    price, cost = F.col("p_retailprice"), F.round(F.col("p_retailprice") * 1.02 - F.col("p_size"), 2)
    net = F.col("l_extendedprice")
    values = (
        F.when(F.col("l_tax") == 0, "not a time").otherwise(
            F.concat(F.date_format("ngay", "dd/MM/yyyy"), F.lit(" "), hour, F.lit(":15:00"))
        ),
        F.col("ma_giao_dich"),
        F.concat("store_type_code", F.lit("_"), "ma_chi_nhanh"),
        F.col("l_partkey").cast("string"),
        F.concat(F.lit("BC"), F.col("l_partkey")),
        F.col("p_name"),
        F.when(F.col("p_size") > 5, F.col("p_brand")),
        path,
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")),
        price, cost, net,
        F.when(F.col("l_discount") > 0, F.round(net * F.col("l_discount"), 1)),
        net, net, net,
    )
    return line.select(
        *[v.cast(f.dataType).alias(f.name) for v, f in zip(values, RAW_SALES.fields)]
    )


_RAW = """raw AS (
      SELECT l_orderkey AS id, CAST(l_orderkey AS VARCHAR) AS ma_giao_dich,
             b.store_type_code || '_' || t.ma_chi_nhanh AS chi_nhanh, CAST(l_partkey AS VARCHAR) AS ma_hang,
             p_name AS ten_hang, CASE WHEN p_size > 5 THEN p_brand ELSE '' END AS thuong_hieu,
             CASE WHEN p_size > 10 THEN p_type ELSE '' END AS cap_1,
             CASE WHEN p_size > 20 THEN p_brand ELSE '' END AS cap_2,
             CASE WHEN p_size > 30 THEN p_name ELSE '' END AS cap_3,
             CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS so_luong,
             p_retailprice AS gia_ban_sp, round(p_retailprice * CAST(1.02 AS DOUBLE) - p_size, 2) AS gia_von_sp,
             l_extendedprice AS doanh_thu,
             CASE WHEN l_tax <> 0 THEN CAST(t.ngay AS TIMESTAMP) + INTERVAL 1 HOUR * (l_linenumber * 3)
                  + INTERVAL 15 MINUTE END AS thoi_gian
      FROM lineitem JOIN tx t ON l_orderkey = t.id JOIN branches b ON b.ma_chi_nhanh = t.ma_chi_nhanh
           JOIN part ON l_partkey = p_partkey),
    cleaned AS (
      SELECT ma_giao_dich, ma_hang, thoi_gian, so_luong, min(chi_nhanh) AS chi_nhanh,
             min(ten_hang) AS ten_hang, min(thuong_hieu) AS thuong_hieu, min(cap_1) AS cap_1,
             min(cap_2) AS cap_2, min(cap_3) AS cap_3, min(gia_ban_sp) AS gia_ban_sp,
             min(gia_von_sp) AS gia_von_sp, min(doanh_thu) AS doanh_thu
      FROM raw GROUP BY 1, 2, 3, 4)"""


def _clean(s, place=None) -> DataFrame:
    return clean.clean_sales(files.rename(raw_sales(s), SALES_NAMES), place=place)


@query(
    "B1_clean_sales", "A5 B1 B2 B6 B8 B9 G3",
    f"""{_RAW}, answer AS (
      SELECT ma_giao_dich, chi_nhanh, ma_hang, ten_hang, thuong_hieu, cap_1, cap_2, cap_3, so_luong,
             CAST(thoi_gian AS DATE) AS ngay, strftime(thoi_gian, '%Y-%m') AS thang,
             CAST(year(thoi_gian) AS INTEGER) AS nam, CAST(weekofyear(thoi_gian) AS INTEGER) AS tuan,
             CAST(hour(thoi_gian) AS INTEGER) AS gio,
             gia_ban_sp - gia_von_sp AS loi_nhuan_sp,
             CASE WHEN gia_ban_sp > 0 THEN (gia_ban_sp - gia_von_sp) / gia_ban_sp * 100 ELSE 0 END
               AS ty_suat_loi_nhuan,
             (gia_ban_sp - gia_von_sp) * so_luong AS tong_loi_nhuan_hang_hoa,
             doanh_thu > 1000000 AS _is_high_value, round(gia_ban_sp - gia_von_sp, 2) < 0 AS _is_negative_margin
      FROM cleaned)""",
    two="loi_nhuan_sp tong_loi_nhuan_hang_hoa", four="ty_suat_loi_nhuan",
)
def clean_sales(s):
    money = ("loi_nhuan_sp", "ty_suat_loi_nhuan", "tong_loi_nhuan_hang_hoa")
    return _clean(s).select(
        "ma_giao_dich", "chi_nhanh", "ma_hang", "ten_hang", "thuong_hieu", "cap_1", "cap_2", "cap_3",
        "so_luong", "ngay", "thang", "nam", "tuan", "gio",
        *[F.col(c).cast("double").alias(c) for c in money], "_is_high_value", "_is_negative_margin",
    )


_SUMMARY = """answer AS (
      SELECT chi_nhanh, count(*) AS total_records, sum(doanh_thu) AS total_revenue,
             CAST(min(thoi_gian) AS DATE) AS min_date, CAST(max(thoi_gian) AS DATE) AS max_date
      FROM {0} GROUP BY 1)"""


@query("A9_branch_load_summary", "A9", f"{_RAW}, {_SUMMARY.format('cleaned')}", two="total_revenue")
def branch_load_summary(s):
    df = files.branch_load_summary(_clean(s))
    return df.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query("A1_sales_csv_round_trip", "A1 A5 A7", f"{_RAW}, {_SUMMARY.format('raw')}", two="total_revenue")
def sales_csv_round_trip(s):
    """Raw lines written as CSV, read under the fixed schema, renamed and summed."""
    path = scratch_path(s.spark, "raw-sales")
    raw_sales(s).write.options(header=True, escape='"', compression="gzip").csv(path)
    read = files.with_lineage(files.read_sales_csv(s.spark, path)).filter(F.col("_source_file") != "")
    lines = clean.with_time_parts(files.rename(read, SALES_NAMES))
    df = files.branch_load_summary(lines)
    return df.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query(
    "A2_lines_by_branch", "A2",
    f"""{_RAW}, answer AS (
      SELECT chi_nhanh, count(*) AS n, CAST(sum(so_luong) AS BIGINT) AS so_luong FROM cleaned GROUP BY 1)""",
)
def lines_by_branch(s):
    """Clean lines written in one folder per branch, read back and counted."""
    path = scratch_path(s.spark, "branches")
    files.write_by_branch(_clean(s, files.by_branch), path, placed=True)
    read = s.spark.read.schema("so_luong int, chi_nhanh string").parquet(path)
    return read.groupBy("chi_nhanh").agg(F.count("*").alias("n"), F.sum("so_luong").alias("so_luong"))


@query(
    "A8_lines_by_month", "A8",
    f"""{_RAW}, answer AS (
      SELECT strftime(thoi_gian, '%Y-%m') AS thang, chi_nhanh, count(*) AS n,
             CAST(sum(so_luong) AS BIGINT) AS so_luong
      FROM cleaned GROUP BY 1, 2)""",
)
def lines_by_month(s):
    """Clean lines written by month, read back and counted."""
    path = scratch_path(s.spark, "lines")
    files.write_lines(_clean(s, files.by_month), path, placed=True)
    read = s.spark.read.schema("chi_nhanh string, so_luong int, thang string").parquet(path)
    return read.groupBy("thang", "chi_nhanh").agg(
        F.count("*").alias("n"), F.sum("so_luong").alias("so_luong")
    )


def raw_catalog(s) -> DataFrame:
    """The catalog as text under its own headers, with commas and quotes in numbers."""
    p = s.table("part")
    return p.select(
        F.col("p_partkey").cast("string").alias("Mã hàng"),
        F.col("p_name").alias("Tên hàng"),
        F.when(F.col("p_size") <= 10, "thùng").when(F.col("p_size") <= 20, "lốc")
        .when(F.col("p_size") <= 30, "chai").when(F.col("p_size") <= 40, "hộp").alias("ĐVT"),
        F.concat("p_type", F.lit(" >> "), "p_brand").alias("Nhóm hàng(3 Cấp)"),
        F.when(F.col("p_size") == 1, "abc").otherwise(
            F.format_number(F.col("p_retailprice") * 700, 2)).alias("Giá vốn"),
        F.format_number(F.col("p_retailprice") * 1000, 2).alias("Giá bán"),
        F.concat(F.lit("BC"), F.col("p_partkey")).alias("Mã vạch"),
        F.concat(F.lit(" "), F.col("p_size"), F.lit(" ")).alias("Quy đổi"),
        F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise("").alias("Tồn kho"),
        F.concat(F.lit('"'), F.col("p_size"), F.lit('"')).alias("Tồn nhỏ nhất"),
        F.lit(None).cast("string").alias("Tồn lớn nhất"),
    )


_CATALOG = """catalog AS (
      SELECT CAST(p_partkey AS VARCHAR) AS ma_hang, p_name AS ten_hang,
             CASE WHEN p_size <= 10 THEN 'thùng' WHEN p_size <= 20 THEN 'lốc'
                  WHEN p_size <= 30 THEN 'chai' WHEN p_size <= 40 THEN 'hộp' ELSE '' END AS don_vi_tinh,
             p_type AS cap_1, p_brand AS cap_2, '' AS cap_3,
             round(p_retailprice * 1000, 2) AS gia_ban_mac_dinh,
             CASE WHEN p_size = 1 THEN 0 ELSE round(p_retailprice * 700, 2) END AS gia_von_mac_dinh,
             'BC' || CAST(p_partkey AS VARCHAR) AS ma_vach, p_size AS quy_doi,
             CAST(CASE WHEN p_size > 25 THEN p_size ELSE 0 END AS DOUBLE) AS current_stock,
             p_size AS min_stock, 0 AS max_stock
      FROM part)"""


@query(
    "A3_catalog_csv_round_trip", "A3 A4 B3 B6 G4",
    f"{_CATALOG}, answer AS (SELECT * FROM catalog)", two="gia_ban_mac_dinh gia_von_mac_dinh",
)
def catalog_csv_round_trip(s):
    """The catalog written twice as text CSV, read, its headers resolved, numbers cleaned."""
    path = scratch_path(s.spark, "catalog")
    rows = raw_catalog(s)
    rows.unionByName(rows).write.options(header=True, escape='"').csv(path)
    return clean.catalog_rows(files.read_catalog_csv(s.spark, path))


@query(
    "D26_stock_counts", "D26",
    f"""{_CATALOG}, answer AS (
      SELECT sum(current_stock) AS total_stock, count(*) FILTER (current_stock > 0) AS products_with_stock,
             CAST(sum(min_stock) AS BIGINT) AS total_min_stock,
             count(*) FILTER (min_stock > 0) AS products_with_min_stock FROM catalog)""",
)
def stock_counts(s):
    return clean.stock_counts(clean.catalog_rows(raw_catalog(s)))


@query(
    "B7_conversion_ratio", "B7",
    """named AS (
      SELECT l_orderkey, l_partkey, l_linenumber,
             ['thùng', 'lốc', 'chai', 'hộp', 'kg', NULL, ''][l_linenumber] AS unit,
             p_name || CASE WHEN l_quantity < 10 THEN ' x6' WHEN l_quantity < 20 THEN ' X 12'
                            WHEN l_quantity < 30 THEN ' x24' ELSE '' END AS name
      FROM lineitem JOIN part ON l_partkey = p_partkey),
    answer AS (
      SELECT unit, name, CAST(CASE
               WHEN unit IN ('thùng', 'lốc') AND (lower(name) LIKE '%x24%' OR lower(name) LIKE '%x 24%') THEN 24
               WHEN unit IN ('thùng', 'lốc') AND (lower(name) LIKE '%x12%' OR lower(name) LIKE '%x 12%') THEN 12
               WHEN unit IN ('thùng', 'lốc') THEN 6
               WHEN unit = 'chai' THEN 1
               WHEN unit = 'hộp' AND (lower(name) LIKE '%x12%' OR lower(name) LIKE '%x 12%') THEN 12
               ELSE 1 END AS INTEGER) AS ratio, count(*) AS n
      FROM named GROUP BY ALL)""",
)
def conversion_ratio(s):
    q = F.col("l_quantity")
    hint = F.when(q < 10, " x6").when(q < 20, " X 12").when(q < 30, " x24").otherwise("")
    units = F.array(*[F.lit(u) for u in ("thùng", "lốc", "chai", "hộp", "kg", None, "")])
    lines = s.table("lineitem").join(s.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    named = lines.select(
        F.element_at(units, F.col("l_linenumber")).alias("unit"),
        F.concat("p_name", hint).alias("name"),
    )
    return named.withColumn("ratio", text.conversion_ratio(F.col("unit"), F.col("name"))).groupBy(
        "unit", "name", "ratio"
    ).agg(F.count("*").alias("n"))


@query(
    "B4_clean_keys", "B4",
    f"""{_RAW}, answer AS (
      SELECT ma_giao_dich, strftime(thoi_gian, '%Y-%m-%d %H:%M:%S') AS thoi_gian, ma_hang FROM raw WHERE thoi_gian IS NOT NULL)""",
)
def clean_keys(s):
    lines = files.rename(raw_sales(s), SALES_NAMES)
    return clean.clean_keys(lines, "ma_giao_dich", "thoi_gian_raw").select(
        "ma_giao_dich", F.date_format("thoi_gian_raw", "yyyy-MM-dd HH:mm:ss").alias("thoi_gian"), "ma_hang"
    )


@query(
    "B22_fill_dims", "B22",
    """answer AS (
      SELECT p_partkey AS id, CASE WHEN p_size > 10 THEN p_type ELSE 'Unknown' END AS nhom_hang_cap_1,
             CASE WHEN p_size > 20 THEN p_brand ELSE 'Unknown' END AS thuong_hieu, 'C' AS abc_class
      FROM part)""",
)
def fill_dims(s):
    return clean.fill_dims(s.table("part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("nhom_hang_cap_1"),
        F.when(F.col("p_size") > 20, F.col("p_brand")).alias("thuong_hieu"),
        F.lit(None).cast("string").alias("abc_class"),
    ))


@query(
    "B23_fill_by_type", "B23 B24",
    """answer AS (
      SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN c_name ELSE '' END AS name,
             CASE WHEN c_acctbal > 0 THEN c_nationkey ELSE 0 END AS nation,
             CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS balance,
             DATE '2000-01-01' AS seen
      FROM customer)""",
)
def fill_by_type(s):
    kept = F.col("c_acctbal") > 0
    gaps = s.table("customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(kept, F.col("c_name")).alias("name"),
        F.when(kept, F.col("c_nationkey")).cast("string").alias("nation"),
        F.when(kept, F.col("c_acctbal")).alias("balance"),
        F.lit("not a date").alias("seen"),
    )
    target = T.StructType().add("id", "long").add("name", "string").add("nation", "integer") \
        .add("balance", "double").add("seen", "date")
    return clean.fill_by_type(
        clean.coerce_schema(gaps, target), F.lit("2000-01-01").cast("timestamp")
    )


@query(
    "B25_transactions_from_lines", "B25",
    """answer AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS ma_giao_dich, min(o_orderpriority) AS ma_chi_nhanh,
             min(CAST(l_shipdate AS DATE)) AS ngay
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)""",
)
def transactions_from_lines(s):
    """Lines of a receipt carry different dates; the header takes the earliest."""
    lines = s.table("lineitem").join(s.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return clean.transactions_from_lines(lines.select(
        F.col("l_orderkey").cast("string").alias("ma_giao_dich"),
        F.col("o_orderpriority").alias("ma_chi_nhanh"),
        F.to_date("l_shipdate").alias("ngay"),
    ))


@query(
    "B26_lines_by_receipt", "B26",
    """answer AS (
      SELECT CAST(transaction_id AS VARCHAR) AS ma_giao_dich, ma_hang, sum(so_luong) AS so_luong,
             avg(don_gia) AS don_gia, sum(don_gia * so_luong) AS thanh_tien
      FROM de GROUP BY 1, 2)""",
    two="thanh_tien", four="don_gia",
)
def lines_by_receipt(s):
    lines = s.details.withColumn("ma_giao_dich", F.col("transaction_id").cast("string"))
    return clean.lines_by_receipt(lines)


@query(
    "C12_upsert", "C12",
    """answer AS (
      SELECT ma_hang, ten_hang, gia_ban_mac_dinh * CASE WHEN cap_1 = 'PROMO' THEN 2 ELSE 1 END
               AS gia_ban_mac_dinh, gia_von_mac_dinh FROM products
      UNION ALL
      SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, s_acctbal, 0 FROM supplier)""",
    two="gia_ban_mac_dinh gia_von_mac_dinh",
)
def upsert(s):
    """Promotional prices doubled and suppliers' own items added, each update sent twice."""
    columns = ("ma_hang", "ten_hang", "gia_ban_mac_dinh", "gia_von_mac_dinh")
    target = s.products.select(*columns)
    promo = s.products.filter(F.col("cap_1") == "PROMO").select(
        "ma_hang", "ten_hang", (F.col("gia_ban_mac_dinh") * 2).alias("gia_ban_mac_dinh"), "gia_von_mac_dinh"
    )
    own = s.table("supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("ma_hang"), F.col("s_name").alias("ten_hang"),
        F.col("s_acctbal").alias("gia_ban_mac_dinh"), F.lit(0.0).alias("gia_von_mac_dinh"),
    )
    updates = promo.unionByName(own)
    return merge.upsert(target, updates.unionByName(updates), ["ma_hang"])


@query(
    "C13_insert_new", "C13",
    "answer AS (SELECT id, ma_giao_dich, ngay, ma_chi_nhanh FROM tx)",
)
def insert_new(s):
    """A late load that repeats every receipt adds only the new ones."""
    everything = s.transactions.select("id", "ma_giao_dich", "ngay", "ma_chi_nhanh")
    loaded = everything.filter(F.col("ngay") < "1998-01-01")
    return merge.insert_new(loaded, everything.unionByName(everything), ["ma_giao_dich", "ngay"])


@query(
    "C14_attach_ids", "C14 G4",
    """answer AS (
      SELECT transaction_id, ma_hang, min(so_luong) AS so_luong FROM de GROUP BY 1, 2)""",
)
def attach_ids(s):
    lines = s.details.select(
        F.col("transaction_id").cast("string").alias("ma_giao_dich"), "ma_hang", "so_luong"
    )
    return merge.dedupe_details(merge.attach_ids(lines, s.transactions), ["so_luong"])


@query(
    "C15_selected_only", "C15",
    """answer AS (
      SELECT transaction_id, ma_hang, so_luong FROM de
      WHERE ma_hang IN (SELECT ma_hang FROM products WHERE cap_1 = 'LARGE'))""",
)
def selected_only(s):
    chosen = s.products.filter(F.col("cap_1") == "LARGE")
    return merge.selected_only(s.details.select("transaction_id", "ma_hang", "so_luong"), chosen, "ma_hang")


@query(
    "C9_sales_with_products", "C9",
    """sales AS (
      SELECT o_orderkey AS sale_id, 'BC' || CAST(o_custkey AS VARCHAR) AS ma_vach,
             CAST(o_orderkey AS VARCHAR) AS ma_hang FROM orders),
    answer AS (
      SELECT sale_id, s.ma_vach, s.ma_hang, p.ma_hang AS product_code, p.thuong_hieu AS product_brand,
             p.cap_1 AS product_cat1, p.cap_2 AS product_cat2, p.cap_3 AS product_cat3,
             p.ma_hang IS NOT NULL AS co_trong_products
      FROM sales s LEFT JOIN products p ON s.ma_vach = p.ma_vach OR s.ma_hang = p.ma_hang)""",
)
def sales_with_products(s):
    sales = s.table("orders").select(
        F.col("o_orderkey").alias("sale_id"),
        F.concat(F.lit("BC"), "o_custkey").alias("ma_vach"),
        F.col("o_orderkey").cast("string").alias("ma_hang"),
    )
    return merge.sales_with_products(sales, s.products, "sale_id")


@query(
    "A6_file_date", "A6",
    """answer AS (
      SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) ELSE d END AS ngay
      FROM orders, newest)""",
)
def file_date(s):
    """Dates read from report names; names without one fall back to the run date."""
    name = F.when(
        F.col("o_orderstatus") == "F",
        F.concat(F.lit("BaoCaoBanHang_KV"), F.date_format("o_orderdate", "ddMMyyyy"), F.lit("-142156.csv")),
    ).otherwise("BaoCaoBanHang.csv")
    return s.table("orders").select(
        F.col("o_orderkey").alias("id"), F.coalesce(files.file_date(name), s.as_of).alias("ngay")
    )


@query(
    "A6_dated_files", "A6 A1",
    """answer AS (
      SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN last_day(CAST(o_orderdate AS DATE)) ELSE d END AS ngay
      FROM orders, newest)""",
)
def dated_files(s):
    """Orders written as monthly report files, named by the month's last day or, if still
    open, by no date; read again and dated by the file they came from."""
    path = scratch_path(s.spark, "reports")
    name = F.when(
        F.col("o_orderstatus") == "F",
        F.concat(F.lit("BaoCaoBanHang_KV"), F.date_format(F.last_day("o_orderdate"), "ddMMyyyy"), F.lit("-142156.csv")),
    ).otherwise("BaoCaoBanHang.csv")
    named = s.table("orders").select(F.col("o_orderkey").alias("id"), name.alias("report"))
    named.hint("rebalance", "report").write.partitionBy("report").csv(path)
    read = s.spark.read.schema("id long").option("recursiveFileLookup", True).csv(path)
    return files.with_file_date(read, s.as_of)


@query(
    "K9_import_delta", "K9",
    """early AS (SELECT * FROM tx WHERE ngay < DATE '1998-01-01'),
    answer AS (
      SELECT 'before' AS stage, count(*) AS rows, count(DISTINCT ngay) AS days FROM early
      UNION ALL SELECT 'after', count(*), count(DISTINCT ngay) FROM tx)""",
)
def import_delta(s):
    loaded = s.transactions.filter(F.col("ngay") < "1998-01-01")
    after = merge.insert_new(loaded, s.transactions, ["ma_giao_dich", "ngay"])
    return merge.import_delta(loaded, after, "ngay")


@query(
    "A12_refresh_staging", "A12",
    """answer AS (
      SELECT 'products' AS name, count(*) AS rows FROM products
      UNION ALL SELECT 'branches', count(*) FROM branches
      UNION ALL SELECT 'transactions', count(*) FROM tx
      UNION ALL SELECT 'details', count(*) FROM de)""",
)
def refresh_staging(s):
    path = scratch_path(s.spark, "staging")
    tables = {"products": s.products, "branches": s.branches,
              "transactions": s.transactions, "details": s.details}
    files.refresh_staging(tables, path)
    counted = [
        s.spark.read.parquet(f"{path}/staging_{n}").agg(F.lit(n).alias("name"), F.count("*").alias("rows"))
        for n in tables
    ]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out

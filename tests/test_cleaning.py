"""Cleaning, headers and merges on small tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import dates, rules, text
from shelfwise.operators import clean, inventory, merge
from shelfwise.sources import files, schemas


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_clean_number(spark):
    rows = [("1,234,500",), ('"12.5"',), ("",), ("abc",), (" 12 ",), (None,), ("-3",), ("5f",), ("7d",), ("nan",), ("1e999",), ("2.5e3",)]
    got = values(spark, rows, "t string", text.clean_number(F.col("t")))
    assert [g[0] for g in got] == [1234500.0, 12.5, 0.0, 0.0, 12.0, 0.0, -3.0, 0.0, 0.0, 0.0, 0.0, 2500.0]


def test_clean_whole(spark):
    rows = [("3000000000",), ("nan",), ("7.9",), ("-2",), (None,), ("5f",)]
    assert [g[0] for g in values(spark, rows, "t string", text.clean_whole(F.col("t")))] == [0, 0, 7, -2, 0, 0]


def test_category_levels(spark):
    rows = [("",), ("A",), ("A >> B",), ("A>>B>> C >> D",), (None,)]
    got = values(spark, rows, "t string", *text.category_levels(F.col("t")))
    assert got == [("", "", ""), ("A", "", ""), ("A", "B", ""), ("A", "B", "C"), ("", "", "")]
    assert values(spark, [("A > B",)], "t string", *text.category_levels(F.col("t"), ">")) == [("A", "B", "")]
    assert values(spark, [("A | B",)], "t string", *text.category_levels(F.col("t"), "|")) == [("A", "B", "")]


def test_blank_barcodes_match_nothing(spark):
    products = spark.createDataFrame(
        [(1, "", "p1"), (2, " ", "p2"), (3, "B3", "p3")], "id int, ma_vach string, ma_hang string").withColumns(
        {c: F.lit("x") for c in ("thuong_hieu", "cap_1", "cap_2", "cap_3")} | {c: F.lit(1.0) for c in ("gia_von_mac_dinh", "gia_ban_mac_dinh")})
    sales = spark.createDataFrame([(1, "", "zz"), (2, "B3", "zz"), (3, "", "p1"), (4, None, "q")], "sale int, ma_vach string, ma_hang string")
    got = merge.sales_with_products(sales, products, "sale").collect()
    assert sorted((r.sale, r.product_code) for r in got) == [(1, None), (2, "p3"), (3, "p1"), (4, None)]
    stock = spark.createDataFrame([("", 1.0, 1.0, 1.0, 1.0), ("B3", 1.0, 1.0, 1.0, 1.0)], "ma_vach string, ton_dau_ky double, sl_nhap double, sl_xuat double, ton_cuoi_ky double")
    assert sorted((r.ma_vach, r.product_id) for r in inventory.stock_with_products(stock, products).collect()) == [("", None), ("B3", 3)]


def test_upsert_takes_null_keys_as_equal(spark):
    target = spark.createDataFrame([(None, 1, 7), (2, 2, 8)], "k int, v int, w int")
    updates = spark.createDataFrame([(None, 5), (3, 6)], "k int, v int")
    for _ in range(2):
        target = merge.upsert(target, updates, ["k"])
    assert sorted(((r.k or 0), r.v, r.w) for r in target.collect()) == [(0, 5, 7), (2, 2, 8), (3, 6, None)]


def test_urgency_is_judged_against_the_stock(spark):
    summary = spark.createDataFrame([("a", 28.0, 14), ("b", 28.0, 14), ("c", 28.0, 14)], "ma_hang string, forecast_units double, horizon_days long")
    safety = spark.createDataFrame([("a", 1, 4.0), ("b", 1, 4.0)], "product_code string, min_stock int, safety_stock double")
    stock = spark.createDataFrame([("a", 18.0), ("b", 17.0), ("c", 14.0)], "ma_hang string, current_stock double")
    got = {r.product_code: r.reorder_urgency for r in inventory.recommendations(summary, safety, stock).collect()}
    assert got == {"a": "Normal", "b": "High", "c": "Normal"}  # 2 a day for 7 days and 4 spare: 18


@pytest.mark.parametrize("unit,name,want", [
    ("Thùng", "Bia x24", 24), ("thùng", "Bia", 6), ("lốc", "Sữa X 12", 12), ("chai", "Dầu x24", 1),
    ("hộp", "Trà x12", 12), ("hộp", "Trà", 1), (None, "x24", 1), ("kg", None, 1),
])
def test_conversion_ratio(spark, unit, name, want):
    got = values(spark, [(unit, name)], "u string, n string", text.conversion_ratio(F.col("u"), F.col("n")))
    assert got == [(want,)]


def test_promo_category(spark):
    rows = [("Hàng Khuyến mại",), ("KHUYEN MAI tet",), ("Sữa",), (None,)]
    assert [g[0] for g in values(spark, rows, "t string", text.is_promo(F.col("t")))] == [True, True, False, False]


def test_pack_size(spark):
    rows = [("Sữa 1.5L",), ("Gạo 5 kg",), ("Mì 75g",), ("Kẹo 3 gói",), ("Trà",)]
    got = values(spark, rows, "t string", text.pack_size_base(F.col("t")), text.pack_unit(F.col("t")), text.family_name(F.col("t")))
    assert got == [(1500.0, "l", "sữa"), (5000.0, "kg", "gạo"), (75.0, "g", "mì"), (0.0, "", "kẹo 3 gói"), (0.0, "", "trà")]


def test_weeks_at_year_edges(spark):
    days = [date(y, m, d) for y in range(1999, 2031) for m, d in ((1, 1), (1, 2), (1, 3), (1, 4), (12, 28), (12, 31))]
    got = values(spark, [(d,) for d in days], "d date", "d", dates.week_sunday(F.col("d")), dates.week_monday(F.col("d")))
    for d, sunday, monday in got:
        assert sunday == int(d.strftime("%U"))
        year, week, _ = d.isocalendar()
        want = week if year == d.year else (0 if year < d.year else 53)
        assert monday == want, d


def test_rules(spark):
    one = spark.range(1)
    row = one.select(
        rules.growth(F.lit(5.0), F.lit(0.0)).alias("g"), rules.margin(F.lit(5.0), F.lit(0.0)).alias("m"),
        rules.whole(F.lit(2.5)).alias("w"), rules.round_to_pack(F.lit(13.0), F.lit(6)).alias("p"),
        rules.round_to_pack(F.lit(13.0), F.lit(0)).alias("p0"), rules.trend_label(F.lit(1.0), F.lit(0.0)).alias("t"),
        rules.demand_pattern(F.lit(1.0), F.lit(0.0)).alias("d"), text.format_currency(F.lit(1234567.0)).alias("vnd"),
        text.format_currency(F.lit(1234.5), "USD").alias("usd"),
    ).first()
    assert tuple(row) == (None, 0.0, 2.0, 18, 13, "up", "Erratic", "1,234,567 ₫", "USD 1,234.50")


def test_headers():
    catalog = ["Mã hàng", "Tên hàng", "ĐVT", "Nhóm hàng(3 Cấp)", "Giá vốn", "Giá bán", "Mã vạch", "Quy đổi",
               "Tồn kho", "Tồn nhỏ nhất", "Tồn lớn nhất"]
    found = schemas.resolve_columns(catalog, schemas.CATALOG_RULES)
    assert list(found) == ["ma_hang", "ten_hang", "don_vi_tinh", "nhom_hang", "gia_von", "gia_ban", "ma_vach",
                           "quy_doi", "current_stock", "min_stock", "max_stock"]
    sales = schemas.resolve_columns(["Mã giao dịch", "Chi nhánh", "Mã hàng", "SL", "Giá bán/SP", "Doanh thu"], schemas.SALES_RULES)
    assert sales == {"ma_giao_dich": "Mã giao dịch", "chi_nhanh": "Chi nhánh", "ma_hang": "Mã hàng", "so_luong": "SL",
                     "don_gia": "Giá bán/SP", "thanh_tien": "Doanh thu"}


def test_sales_rows(spark):
    df = spark.createDataFrame([(" T1 ", "H1", "1,000")], "`Mã giao dịch` string, `Mã hàng` string, `Đơn giá` string")
    got = clean.sales_rows(df, F.lit("2026-03-09").cast("date")).first()
    assert tuple(got) == ("T1", "Unknown", date(2026, 3, 9), "H1", 1, 1000.0)
    with pytest.raises(ValueError):
        clean.sales_rows(df.drop("Mã hàng"), F.lit(None).cast("date"))


def test_file_date_and_lineage(spark, tmp_path):
    (tmp_path / "BaoCaoBanHang_KV09032026-142156-201.csv").write_text("﻿a,b\n1,\"x, y\"\n", encoding="utf-8")
    df = files.read_catalog_csv(spark, str(tmp_path))
    assert df.columns == ["a", "b"]
    row = files.with_lineage(files.with_file_date(df, "2026-01-01")).first()
    assert row.ngay == date(2026, 3, 9) and row.b == "x, y" and row._source_file.endswith(".csv")
    named = spark.createDataFrame([("KV31022026.csv",), ("x.csv",)], "n string")
    assert [r[0] for r in named.select(files.file_date(F.col("n"))).collect()] == [None, None]


def test_read_sales_csv_with_line_break(spark, tmp_path):
    header = ",".join(f'"{h}"' for h, _, _ in schemas.SALES_COLUMNS)
    line = '31/12/2025 23:59:59,T1,KCC_1,16000109-1,B1,"Kẹo ""dẻo""\nloại 1",X,A >> B,-2,1000.5,900,2001,,2001,1800,201'
    (tmp_path / "s.csv").write_text(f"{header}\n{line}\n", encoding="utf-8")
    row = clean.clean_sales(files.rename(files.read_sales_csv(spark, str(tmp_path)), schemas.SALES_NAMES)).first()
    assert row.ten_hang == 'Kẹo "dẻo"\nloại 1' and row.so_luong == -2 and row.giam_gia == 0
    assert row.thoi_gian == datetime(2025, 12, 31, 23, 59, 59) and row.tuan == 1 and row.thang == "2025-12"
    assert (row.cap_1, row.cap_2, row.cap_3) == ("A", "B", "") and float(row.tong_loi_nhuan_hang_hoa) == -201.0


def test_validate(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert clean.validate(df, ["a"]) == []
    assert clean.validate(df, ["a", "b"]) == ["missing column b"]
    assert clean.validate(df.filter("a > 1"), ["a"]) == ["no rows"]


def test_fill_and_coerce(spark):
    df = spark.createDataFrame([(None, "x", None)], "n int, t string, at timestamp")
    filled = clean.fill_by_type(df, F.lit("2026-01-02 03:04:05").cast("timestamp")).first()
    assert tuple(filled) == (0, "x", datetime(2026, 1, 2, 3, 4, 5))
    bad = clean.coerce_schema(df, T.StructType().add("t", "integer").add("n", "string")).first()
    assert tuple(bad) == (None, None)


def test_dedupe_is_idempotent_and_keeps_null_keys(spark):
    rows = [("T1", None, None, 1, "b"), ("T1", None, None, 1, "a"), ("T1", "H", None, 1, "c")]
    df = spark.createDataFrame(rows, "ma_giao_dich string, ma_hang string, thoi_gian string, so_luong int, x string")
    once = clean.dedupe_lines(df)
    assert sorted(r.x for r in once.collect()) == ["a", "c"]
    assert sorted(r.x for r in clean.dedupe_lines(once).collect()) == ["a", "c"]


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    updates = spark.createDataFrame([("a", 9, None), ("a", 7, "q"), ("c", 3, "z")], "k string, v int, w string")
    got = merge.upsert(target, updates, ["k"], order=["v"])
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == [("a", 7, "q"), ("b", 2, "y"), ("c", 3, "z")]
    again = merge.upsert(got, updates, ["k"], order=["v"])
    assert sorted(tuple(r) for r in again.collect()) == rows
    part = merge.upsert(target, updates, ["k"], columns=["v"], order=["v"])
    assert sorted(tuple(r) for r in part.collect()) == [("a", 7, "x"), ("b", 2, "y"), ("c", 3, "z")]


def test_insert_new_counts_null_keys_once(spark):
    target = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    rows = spark.createDataFrame([(None, 5), ("b", 6), ("b", 4), ("a", 9)], "k string, v int")
    got = merge.insert_new(target, rows, ["k"], ["v"])
    assert sorted((str(r.k), r.v) for r in got.collect()) == [("None", 2), ("a", 1), ("b", 4)]


def test_sales_with_products_by_either_key(spark):
    sales = spark.createDataFrame(
        [(1, "B1", "H1"), (2, "B1", "H2"), (3, None, "H3"), (4, "B1", None), (5, "B9", "H9")],
        "sale_id int, ma_vach string, ma_hang string",
    )
    products = spark.createDataFrame(
        [("B1", "H1", "x"), ("B2", "H2", "y"), ("B1", None, "n")], "ma_vach string, ma_hang string, thuong_hieu string"
    ).selectExpr("*", "'c' cap_1", "'' cap_2", "'' cap_3")
    got = merge.sales_with_products(sales, products, "sale_id").collect()
    pairs = sorted((r.sale_id, str(r.product_brand)) for r in got)
    assert pairs == [(1, "n"), (1, "x"), (2, "n"), (2, "x"), (2, "y"), (3, "None"), (4, "n"), (4, "x"), (5, "None")]
    assert all(r.co_trong_products == (r.sale_id not in (3, 5)) for r in got)


@pytest.mark.parametrize("place,column,write", [
    (files.by_branch, "chi_nhanh", files.write_by_branch), (files.by_month, "thang", files.write_lines)])
def test_lines_are_laid_out_while_they_are_narrow(spark, tmp_path, place, column, write):
    """What derives from other columns is added after the shuffle for the write, not carried through it."""
    names = [n for _, n, _ in schemas.SALES_COLUMNS]
    rows = [(f"{i % 3 + 1:02d}/0{i % 2 + 1}/2026 10:00:00" if i % 5 else "bad", f"T{i % 7}", f"B{i % 2}", f"H{i % 3}", "V", "N", None,
             "A >> B" if i % 2 else None, i % 4, *[None] * 7) for i in range(60)]
    raw = spark.createDataFrame(rows, T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schemas.RAW_SALES.fields)]))
    placed, plain = clean.clean_sales(raw, place=place), clean.clean_sales(raw)
    below = placed._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")[1]
    assert "doanh_thu" in below and not any(c in below for c in ("loi_nhuan_sp", "cap_1", "tuan", "_is_high_value"))
    assert sorted(placed.columns) == sorted(plain.columns)
    want = sorted(map(str, plain.select(sorted(plain.columns)).collect()))
    assert sorted(map(str, placed.select(sorted(plain.columns)).collect())) == want
    write(placed, str(tmp_path / "a"), placed=True)
    write(plain, str(tmp_path / "b"))
    read = [spark.read.schema(plain.schema).parquet(str(tmp_path / d)).select(sorted(plain.columns)) for d in "ab"]
    assert [sorted(map(str, r.collect())) for r in read] == [want, want]
    assert any(f.suffix == ".parquet" and "zstd" in f.name for f in (tmp_path / "a").rglob("*"))

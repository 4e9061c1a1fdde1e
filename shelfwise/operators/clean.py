"""Cleaning of raw lines and catalog rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import dates, text
from shelfwise.operators.ordered import first_per_key
from shelfwise.sources.schemas import CATALOG_RULES, SALES_RULES, SALES_REQUIRED, resolve_columns


def with_time_parts(df: DataFrame, column: str = "thoi_gian_raw") -> DataFrame:
    """B1: receipt time and its parts in place of the raw text."""
    return df.withColumns(dates.time_parts(F.col(column))).drop(column)


# Columns whose missing amount is 0 and whose missing name is ''.
DEFAULT_ZERO = ("gia_ban_sp", "gia_von_sp", "so_luong", "doanh_thu", "giam_gia")
DEFAULT_BLANK = ("ma_hang", "ten_hang", "thuong_hieu", "chi_nhanh")


def fill_defaults(df: DataFrame) -> DataFrame:
    """B2: missing amounts are 0, missing names ''."""
    values = {c: 0 for c in DEFAULT_ZERO} | {c: "" for c in DEFAULT_BLANK}
    return df.na.fill({c: v for c, v in values.items() if c in df.columns})


def clean_keys(df: DataFrame, code: str, time: str, fmt: str = "dd/MM/yyyy HH:mm:ss") -> DataFrame:
    """Parsed time; rows without receipt code or readable time are dropped."""
    parsed = df.withColumn(time, F.try_to_timestamp(F.col(time), F.lit(fmt)))
    return parsed.dropna(subset=[code, time])


def validate(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Problems with a loaded table: missing columns, or no rows."""
    problems = [f"missing column {c}" for c in required if c not in df.columns]
    return problems or (["no rows"] if df.isEmpty() else [])


def with_categories(df: DataFrame, column: str = "nhom_hang_3_cap", sep: str = ">>") -> DataFrame:
    """Category path split into `cap_1..3`."""
    return df.select("*", *text.category_levels(F.col(column), sep))


def with_unit_economics(df: DataFrame) -> DataFrame:
    """Unit margin, margin percent (0 without a price) and line profit."""
    price = F.col("gia_ban_sp")
    profit = price - F.col("gia_von_sp")
    return df.withColumns({
        "loi_nhuan_sp": profit,
        "ty_suat_loi_nhuan": F.when(price > 0, profit / price * 100).otherwise(0.0),
        "tong_loi_nhuan_hang_hoa": profit * F.col("so_luong"),
    })


def with_flags(df: DataFrame, threshold: float = 1_000_000) -> DataFrame:
    """High-value line and negative unit margin; a missing value is neither."""
    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    return df.withColumns({
        "_is_high_value": flag(F.col("doanh_thu") > threshold),
        "_is_negative_margin": flag(F.col("loi_nhuan_sp") < 0),
    })


LINE_KEY = ("ma_giao_dich", "ma_hang", "thoi_gian", "so_luong")


def dedupe_lines(df: DataFrame, keys: Sequence[str] = LINE_KEY) -> DataFrame:
    """One line per receipt, product, time and quantity."""
    return first_per_key(df, list(keys), [])


def clean_sales(
    df: DataFrame, sep: str = ">>", place: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Raw lines under canonical names to clean lines.

    `place` lays the lines out, by branch or month say, while they are narrow: what can be told
    from other columns is added after its shuffle.
    """
    time = "thoi_gian"
    parts = dates.time_parts(F.col("thoi_gian_raw"))
    single = dedupe_lines(fill_defaults(df.withColumn(time, parts[time]).drop("thoi_gian_raw")))
    placed = single if place is None else place(single)
    whole = placed.withColumns(dates.parts_of(F.col(time)))
    return with_flags(with_unit_economics(with_categories(whole, sep=sep)))


def fill_dims(df: DataFrame) -> DataFrame:
    """Unknown category or brand, class C."""
    defaults = {
        "nhom_hang_cap_1": "Unknown", "nhom_hang_cap_2": "Unknown",
        "thuong_hieu": "Unknown", "abc_class": "C",
    }
    return df.na.fill({c: v for c, v in defaults.items() if c in df.columns})


def fill_by_type(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Nulls by type: text '', whole numbers 0, floats 0.0, times `now`."""
    stamp = F.current_timestamp() if now is None else now
    zeros = {
        T.StringType: F.lit(""), T.ShortType: F.lit(0), T.IntegerType: F.lit(0),
        T.LongType: F.lit(0), T.FloatType: F.lit(0.0), T.DoubleType: F.lit(0.0),
        T.TimestampType: stamp, T.DateType: stamp.cast("date"),
    }
    filled = {
        f.name: F.coalesce(F.col(f.name), zeros[type(f.dataType)].cast(f.dataType))
        for f in df.schema.fields
        if type(f.dataType) in zeros
    }
    return df.withColumns(filled)


def coerce_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of `target` in its order and types; unreadable values become null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target.fields])


# Catalog columns by kind, with what a missing column stands for.
CATALOG_LABELS = {"ten_hang": "ten_hang", "don_vi_tinh": "don_vi_tinh", "ma_vach": "ma_vach"}
CATALOG_NUMBERS = {
    "gia_ban": ("gia_ban_mac_dinh", text.clean_number, "0"), "gia_von": ("gia_von_mac_dinh", text.clean_number, "0"),
    "quy_doi": ("quy_doi", text.clean_whole, "1"), "current_stock": ("current_stock", text.clean_number, "0"),
    "min_stock": ("min_stock", text.clean_whole, "0"), "max_stock": ("max_stock", text.clean_whole, "0"),
}


def catalog_rows(df: DataFrame, sep: str = ">>") -> DataFrame:
    """An all-text catalog under any known headers to typed products."""
    at = resolve_columns(df.columns, CATALOG_RULES)

    def raw(name: str, default: str | None = None) -> Column:
        return F.col(f"`{at[name]}`") if name in at else F.lit(default)

    made = {new: F.coalesce(F.trim(raw(old)), F.lit("")) for old, new in CATALOG_LABELS.items()}
    made |= {new: number(raw(old, missing)) for old, (new, number, missing) in CATALOG_NUMBERS.items()}
    typed = df.select(
        F.trim(raw("ma_hang")).alias("ma_hang"), *text.category_levels(raw("nhom_hang"), sep),
        *[c.alias(n) for n, c in made.items()],
    )
    return first_per_key(typed, ["ma_hang"], [])


def sales_rows(df: DataFrame, ngay: Column) -> DataFrame:
    """An all-text sales report under any known headers to typed lines.

    `ngay` is the date used where the file has no date column. Raises when the receipt or
    product column is missing, as such a file cannot be loaded.
    """
    at = resolve_columns(df.columns, SALES_RULES)
    missing = [c for c in SALES_REQUIRED if c not in at]
    if missing:
        raise ValueError(f"no column for {', '.join(missing)}")

    def raw(name: str) -> Column:
        return F.col(f"`{at[name]}`")

    def number(name: str, default: str, rule) -> Column:
        return rule(raw(name) if name in at else F.lit(default))

    own = [raw("thoi_gian").try_cast("date")] if "thoi_gian" in at else []
    branch = F.trim(raw("chi_nhanh")) if "chi_nhanh" in at else F.lit("Unknown")
    return df.select(
        F.trim(raw("ma_giao_dich")).alias("ma_giao_dich"),
        branch.alias("ma_chi_nhanh"),
        F.coalesce(*own, ngay).alias("ngay"),
        F.trim(raw("ma_hang")).alias("ma_hang"),
        number("so_luong", "1", text.clean_whole).alias("so_luong"),
        number("don_gia", "0", text.clean_number).alias("don_gia"),
    )


def transactions_from_lines(lines: DataFrame) -> DataFrame:
    """One header per receipt code: its earliest date, then the first branch name."""
    return first_per_key(
        lines.select("ma_giao_dich", "ma_chi_nhanh", "ngay"), ["ma_giao_dich"],
        ["ngay", "ma_chi_nhanh"],
    )


def lines_by_receipt(lines: DataFrame) -> DataFrame:
    """Quantity, mean price and price times quantity per receipt and product."""
    return lines.groupBy("ma_giao_dich", "ma_hang").agg(
        F.sum("so_luong").alias("so_luong"),
        F.avg("don_gia").alias("don_gia"),
        F.sum(F.col("don_gia") * F.col("so_luong")).alias("thanh_tien"),
    )


def stock_counts(products: DataFrame) -> DataFrame:
    """Total stock and how many products hold stock or a minimum."""
    return products.agg(
        F.sum("current_stock").alias("total_stock"),
        F.count_if(F.col("current_stock") > 0).alias("products_with_stock"),
        F.sum("min_stock").alias("total_min_stock"),
        F.count_if(F.col("min_stock") > 0).alias("products_with_min_stock"),
    )

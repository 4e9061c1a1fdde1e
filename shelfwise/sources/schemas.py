"""Schemas and header rules of the raw files (A1, A4, A5)."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(15, 2)

# Raw sales header, canonical name, type.
SALES_COLUMNS = (
    ("Thờigian", "thoi_gian_raw", T.StringType()),
    ("Mã giao dịch", "ma_giao_dich", T.StringType()),
    ("Chi nhánh", "chi_nhanh", T.StringType()),
    ("Mã hàng", "ma_hang", T.StringType()),
    ("Mã vạch", "ma_vach", T.StringType()),
    ("Tên hàng", "ten_hang", T.StringType()),
    ("Thương hiệu", "thuong_hieu", T.StringType()),
    ("Nhóm hàng(3 Cấp)", "nhom_hang_3_cap", T.StringType()),
    ("SL", "so_luong", T.IntegerType()),
    ("Giá bán/SP", "gia_ban_sp", _MONEY),
    ("Giá vốn/SP", "gia_von_sp", _MONEY),
    ("Tổng tiền hàng (theo thờigian)", "tong_tien_hang", _MONEY),
    ("Giảm giá (theo thờigian)", "giam_gia", _MONEY),
    ("Doanh thu (theo thờigian)", "doanh_thu", _MONEY),
    ("Tổng giá vốn (theo thờigian)", "tong_gia_von", _MONEY),
    ("Lợi nhuận gộp (theo thờigian)", "loi_nhuan_gop", _MONEY),
)

RAW_SALES = T.StructType([T.StructField(h, t) for h, _, t in SALES_COLUMNS])
SALES_NAMES = {h: n for h, n, _ in SALES_COLUMNS}

# Canonical name -> words a lower-case header must hold, and alternatives
# of which it must hold one. The first rule that fits a header takes it.
CATALOG_RULES = (
    ("ma_hang", ("mã", "hàng"), ()),
    ("ten_hang", ("tên", "hàng"), ()),
    ("don_vi_tinh", (), ("đvt", "đơn vị")),
    ("nhom_hang", ("nhóm", "cấp"), ()),
    ("gia_von", ("giá vốn",), ()),
    ("gia_ban", ("giá bán",), ()),
    ("ma_vach", ("mã vạch",), ()),
    ("quy_doi", ("quy", "đổi"), ()),
    ("current_stock", ("tồn",), ("kho", "hiện tại", "current")),
    ("min_stock", ("tồn",), ("nhỏ", "tối thiểu", "min")),
    ("max_stock", ("tồn",), ("lớn", "tối đa", "max")),
)
SALES_RULES = (
    ("ma_giao_dich", ("mã", "giao dịch"), ()),
    ("chi_nhanh", ("chi nhánh",), ()),
    ("ma_hang", ("mã", "hàng"), ()),
    ("so_luong", (), ("số lượng", "=sl")),
    ("don_gia", (), ("đơn giá", "giá bán/sp", "giá bán")),
    ("thanh_tien", (), ("thành tiền", "doanh thu")),
    ("tong_tien", ("tổng tiền",), ()),
    ("thoi_gian", ("thờigian",), ("giao",)),
)
SALES_REQUIRED = ("ma_giao_dich", "ma_hang")


def resolve_columns(headers, rules) -> dict[str, str]:
    """A4: canonical name -> header. A word with a leading '=' must equal the header.

    Of several headers for one name the last wins, as a later file column overrides.
    """
    found: dict[str, str] = {}
    for header in headers:
        text = header.lower()
        packed = text.replace(" ", "")

        def holds(word: str) -> bool:
            if word.startswith("="):
                return text == word[1:]
            return word in text or (word == "thờigian" and word in packed)

        for name, every, some in rules:
            if all(holds(w) for w in every) and (not some or any(holds(w) for w in some)):
                found[name] = header
                break
    return found

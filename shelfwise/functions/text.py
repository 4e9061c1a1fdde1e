"""Rules for dirty text, numbers and product names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a promotional category is spelled in the source data.
PROMO_PATTERNS = ("%khuyến mại%", "%khuyen mai%")

# Unit words that mean a carton, a multi-pack and a single piece.
CARTON_UNITS = ("thùng", "thung", "carton", "thung carton")
PACK_UNITS = ("lốc", "loc", "pack")
SINGLE_UNITS = ("can", "chai", "gói", "goi", "cái", "cai", "bịch", "bich", "hũ", "hu")


# Digits with an optional fraction and exponent: no letters, as in `5f` or `nan`.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def clean_number(text: Column) -> Column:
    """Thousands commas and quotes dropped; empty, bad or endless text is 0.0."""
    bare = F.trim(F.regexp_replace(text.cast("string"), '[,"]', ""))
    number = F.when(bare.rlike(NUMBER), bare.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number).otherwise(0.0)


def clean_whole(text: Column) -> Column:
    """The same without its fraction; 0 where it is beyond a whole number's range."""
    return F.coalesce(clean_number(text).try_cast("int"), F.lit(0))


def category_level(path: Column, level: int, sep: str = ">>") -> Column:
    """One trimmed level (0-based) of a category path, '' when absent; `sep` is plain text."""
    quoted = "".join(c if c.isalnum() or c.isspace() else f"\\{c}" for c in sep)
    return F.coalesce(F.trim(F.get(F.split(path, quoted), F.lit(level))), F.lit(""))


def category_levels(path: Column, sep: str = ">>") -> list[Column]:
    """The three levels as `cap_1`, `cap_2`, `cap_3`."""
    return [category_level(path, i, sep).alias(f"cap_{i + 1}") for i in range(3)]


def _contains_any(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def conversion_ratio(unit: Column, name: Column) -> Column:
    """Pieces per sales unit, read from the unit word and an `x6/x12/x24` hint."""
    u = F.lower(F.trim(unit))
    n = F.lower(F.coalesce(name, F.lit("")))

    def hinted(size: int) -> Column:
        return n.contains(f"x{size}") | n.contains(f"x {size}")

    bulk = F.when(hinted(24), 24).when(hinted(12), 12).otherwise(6)
    return (
        F.when(unit.isNull() | (unit == ""), 1)
        .when(_contains_any(u, CARTON_UNITS), bulk)
        .when(_contains_any(u, PACK_UNITS), bulk)
        .when(_contains_any(u, SINGLE_UNITS), 1)
        .when((u.contains("hộp") | n.contains("hop")) & hinted(12), 12)
        .otherwise(1)
        .cast("int")
    )


def is_promo(category: Column, patterns=PROMO_PATTERNS) -> Column:
    """Category names a promotion; a missing category does not."""
    text = F.lower(F.coalesce(category, F.lit("")))
    return reduce(lambda a, b: a | b, [text.like(p.lower()) for p in patterns])


def pack_size(name: Column) -> Column:
    """Number of a `500 g`, `1.5l` style size in a name, 0 when there is none."""
    return F.coalesce(
        F.regexp_extract(F.lower(name), _SIZE, 1).try_cast("double"), F.lit(0.0)
    )


def pack_unit(name: Column) -> Column:
    """Unit of that size, '' when there is none."""
    return F.regexp_extract(F.lower(name), _SIZE, 2)


_SIZE = r"(\d+(?:\.\d+)?)\s*(kg|ml|g|l)(?!\p{L})"


def pack_label(name: Column) -> Column:
    """The size as `500g`, '' when there is none."""
    return F.concat(F.regexp_extract(F.lower(name), _SIZE, 1), pack_unit(name))


def pack_size_base(name: Column) -> Column:
    """The size in grams or millilitres."""
    return pack_size(name) * F.when(pack_unit(name).isin("kg", "l"), 1000.0).otherwise(1.0)


def family_name(name: Column) -> Column:
    """The name without its size."""
    return F.trim(F.regexp_replace(F.lower(name), _SIZE, ""))


def format_currency(amount: Column, currency: str = "VND") -> Column:
    """`1,234 ₫` for VND, `USD 1,234.50` style otherwise."""
    if currency == "VND":
        return F.concat(F.format_number(amount, 0), F.lit(" ₫"))
    return F.concat(F.lit(f"{currency} "), F.format_number(amount, 2))

"""Calendar rules on date columns (B1, H2-H4, section 2.13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month -> season under the three schemes in use.
SEASONS = {
    "fact": {
        "Winter": (1, 10, 11, 12),
        "Spring": (2, 3),
        "Summer": (4, 5, 6),
        "Autumn": (7, 8, 9),
    },
    "seed": {
        "Winter": (1, 2, 12),
        "Spring": (3, 4, 5),
        "Summer": (6, 7, 8),
        "Autumn": (9, 10, 11),
    },
    "meteo": {
        "Winter": (12, 1, 2),
        "Spring": (3, 4, 5),
        "Summer": (6, 7, 8),
        "Autumn": (9, 10, 11),
    },
}

# Weekday names, Monday first.
DAY_NAMES = ("Thứ hai", "Thứ ba", "Thứ tư", "Thứ năm", "Thứ sáu", "Thứ bảy", "Chủ nhật")


def iso_dow(d: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(d) + 1


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def day_type(d: Column) -> Column:
    return F.when(is_weekend(d), "weekend").otherwise("weekday")


def date_key(d: Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_key(d: Column) -> Column:
    """yyyyMM as an integer."""
    return F.year(d) * 100 + F.month(d)


def week_sunday(d: Column) -> Column:
    """Week of year, weeks start on Sunday, days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(d) - 1 + 7 - (F.dayofweek(d) - 1)) / F.lit(7)).cast("int")


def week_monday(d: Column) -> Column:
    """Week of year, weeks start on Monday, week 1 has at least four days of the year."""
    jan1 = F.weekday(F.trunc(d, "YEAR"))
    return (
        F.floor((F.dayofyear(d) - 1 + jan1) / F.lit(7)) + F.when(jan1 <= 3, 1).otherwise(0)
    ).cast("int")


def season(d: Column, scheme: str = "fact") -> Column:
    """H2: season of a date under one of the three schemes."""
    m = F.month(d)
    names = list(SEASONS[scheme].items())
    rule = F.when(m.isin(*names[0][1]), names[0][0])
    for name, months in names[1:]:
        rule = rule.when(m.isin(*months), name)
    return rule


def is_holiday(d: Column) -> Column:
    """H4: 1-5 January, 30 April, 1 May, 2 September."""
    m, dom = F.month(d), F.dayofmonth(d)
    return (
        ((m == 1) & (dom <= 5))
        | ((m == 4) & (dom == 30))
        | ((m == 5) & (dom == 1))
        | ((m == 9) & (dom == 2))
    )


def time_parts(text: Column, fmt: str = "dd/MM/yyyy HH:mm:ss") -> dict[str, Column]:
    """B1: columns derived from receipt time text; bad text gives nulls."""
    ts = F.try_to_timestamp(text, F.lit(fmt))
    return {"thoi_gian": ts, **parts_of(ts)}


def parts_of(ts: Column) -> dict[str, Column]:
    """B1: columns derived from the receipt time itself."""
    return {
        "ngay": F.to_date(ts),
        "thang": F.date_format(ts, "yyyy-MM"),
        "nam": F.year(ts),
        "tuan": F.weekofyear(ts),
        "gio": F.hour(ts),
    }


def days_since(d: Column, as_of: Column) -> Column:
    return F.datediff(as_of, d)

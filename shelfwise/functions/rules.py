"""Business thresholds as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Branch code prefix -> two-letter peer group, in matching order.
PEER_GROUPS = (("KPDT", "UP"), ("KCC", "AP"), ("KCN", "IZ"), ("CTT", "TM"), ("KVNT", "RL"))


def bands(value: Column, cuts, otherwise) -> Column:
    """First label whose bound `value` reaches; `cuts` is [(bound, label)], highest first."""
    rule = F.when(value >= cuts[0][0], cuts[0][1])
    for bound, label in cuts[1:]:
        rule = rule.when(value >= bound, label)
    return rule.otherwise(otherwise)


def at_most(value: Column, cuts, otherwise) -> Column:
    """First label whose bound `value` stays within; `cuts` is lowest first."""
    rule = F.when(value <= cuts[0][0], cuts[0][1])
    for bound, label in cuts[1:]:
        rule = rule.when(value <= bound, label)
    return rule.otherwise(otherwise)


def below(value: Column, cuts, otherwise) -> Column:
    """First label whose bound `value` is under; `cuts` is lowest first."""
    rule = F.when(value < cuts[0][0], cuts[0][1])
    for bound, label in cuts[1:]:
        rule = rule.when(value < bound, label)
    return rule.otherwise(otherwise)


def ratio_or(top: Column, bottom: Column, default: float | None = 0.0) -> Column:
    """top / bottom where bottom > 0, `default` otherwise."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(default).cast("double"))


def whole(x: Column) -> Column:
    """Nearest integer, halves to even."""
    return F.rint(x)


def price_tier(price: Column, cuts=(1_000_000, 500_000, 200_000)) -> Column:
    """B18."""
    return bands(price, list(zip(cuts, ("Premium", "Mid-range", "Economy"))), "Budget")


def velocity_class(v: Column, fast: float = 10, medium: float = 3) -> Column:
    """I11."""
    return (
        F.when(v >= fast, "Fast").when(v >= medium, "Medium").when(v > 0, "Slow").otherwise("Dead")
    )


def demand_pattern(std: Column, mean: Column) -> Column:
    """By coefficient of variation; no mean counts as erratic."""
    return below(std / F.nullif(mean, F.lit(0.0)), [(0.5, "Stable"), (1.0, "Variable")], "Erratic")


def time_of_day(hour: Column) -> Column:
    """I13."""
    return (
        F.when((hour >= 5) & (hour < 12), "Morning")
        .when((hour >= 12) & (hour < 18), "Afternoon")
        .when((hour >= 18) & (hour < 22), "Evening")
        .otherwise("Night")
    )


def growth(current: Column, previous: Column) -> Column:
    """Null without a previous value."""
    return (current - previous) / F.nullif(previous, F.lit(0.0))


def margin(profit: Column, revenue: Column) -> Column:
    """0 without revenue."""
    return F.coalesce(profit / F.nullif(revenue, F.lit(0.0)), F.lit(0.0))


def abc_class(share: Column, a: float = 0.8, b: float = 0.95) -> Column:
    """I4: class of a cumulative share; the row that crosses a cut gets the lower class."""
    return at_most(share, [(a, "A"), (b, "B")], "C")


def peer_group(code: Column) -> Column:
    """By branch code prefix."""
    rule = F.when(code.startswith(PEER_GROUPS[0][0]), PEER_GROUPS[0][1])
    for prefix, group in PEER_GROUPS[1:]:
        rule = rule.when(code.startswith(prefix), group)
    return rule.otherwise("OTHER")


def suggested_order(forecast: Column, last_week: Column, stock: Column, cover: float = 1.5) -> Column:
    """Whole units, never negative."""
    return whole(F.greatest(F.lit(0.0), forecast * cover - last_week - stock))


def round_to_pack(qty: Column, pack: Column) -> Column:
    """Up to a full pack; a missing or zero pack counts as one."""
    size = F.when(pack > 0, pack).otherwise(1)
    return F.ceil(qty / size) * size


def trend_pct(forecast: Column, last: Column) -> Column:
    """Percent change; 100 for new demand, 0 for none."""
    return F.when(last > 0, (forecast - last) / last * 100).otherwise(
        F.when(forecast > 0, 100.0).otherwise(0.0)
    )


def trend_label(forecast: Column, last: Column) -> Column:
    """J13."""
    pct = trend_pct(forecast, last)
    return F.when(pct > 5, "up").when(pct < -5, "down").otherwise("stable")


def share_band(pct: Column) -> Column:
    """Bands at 30, 20 and 10 percent."""
    return bands(pct, [(30, "high"), (20, "raised"), (10, "medium")], "low")


# Grade limits per metric (errors as fractions, MAE in units), best first.
GRADE_LIMITS = {
    "mae": (5.0, 15.0, 30.0),
    "wmape": (0.10, 0.20, 0.30, 0.40),
    "mdape": (0.10, 0.20, 0.30),
    "mape": (0.10, 0.20, 0.30),
}
GRADES = ("excellent", "very good", "good", "acceptable", "needs work")


def grade(value: Column, metric: str) -> Column:
    """Grade of an error metric under its limits."""
    limits = GRADE_LIMITS[metric]
    labels = GRADES[-(len(limits) + 1):]
    return below(value, list(zip(limits, labels)), labels[-1])


def alert_level(cold_starts: Column, missing_pct: Column, zeros: Column, age_days: Column) -> Column:
    """K8."""
    return (
        F.when((missing_pct > 20) | (zeros > 0) | (age_days > 2), "error")
        .when((cold_starts > 0) | (missing_pct > 5) | (age_days > 1), "warning")
        .otherwise("info")
    )

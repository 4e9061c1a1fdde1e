"""Global order against brute force."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators import classify, ordered


@pytest.fixture(scope="module", autouse=True)
def many_slices(spark):
    """Small test tables would be merged into one slice; keep them apart."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    # A third of all rows share one value, as one hot key would.
    return [(f"k{i:04d}", "a" if i % 3 else "b", 0 if i % 3 == 0 else pick.randint(1, 9)) for i in range(500)]


def test_running_totals_and_positions(spark, rows):
    df = spark.createDataFrame(rows, "k string, g string, v int")
    got = ordered.running_totals(
        df, {"run": F.col("v"), "pos": F.lit(1)}, [F.col("v").desc(), F.col("k").asc()]
    ).collect()
    total, want = 0, {}
    for i, (k, _, v) in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])), 1):
        total += v
        want[k] = (total, i)
    assert {r.k: (r.run, r.pos) for r in got} == want
    assert {r.all_run for r in got} == {total} and {r.all_pos for r in got} == {500}


def test_a_hot_value_is_spread_over_slices(spark):
    """A third of the rows share one value; the unique order still splits them."""
    df = spark.range(30000).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v")
    )
    cut = ordered.sliced(df, [F.col("v").desc(), F.col("k").asc()])
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert sum(sizes) == 30000 and len(sizes) > 1 and max(sizes) < 0.45 * 30000
    hot = cut.filter("v = 7").select("_slice").distinct().count()
    assert hot > 1


def test_running_totals_per_group_with_null_group(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 5), (None, 7)], "g string, v int")
    got = ordered.running_totals(df, {"run": F.col("v")}, [F.col("v").asc()], ["g"]).collect()
    assert sorted((str(r.g), r.v, r.run) for r in got) == [("None", 5, 5), ("None", 7, 12), ("x", 1, 1), ("x", 2, 3)]


def test_shared_totals_and_rank(spark, rows):
    df = spark.createDataFrame(rows, "k string, g string, v int")
    shared = ordered.shared_totals(df, {"run": F.col("v")}, "v").collect()
    for r in shared:
        assert r.run == sum(v for _, _, v in rows if v >= r.v)
    ranked = ordered.with_rank(df, "v", "rank").collect()
    for r in ranked:
        assert r["rank"] == 1 + sum(v > r.v for _, _, v in rows)


@pytest.mark.parametrize("n,tiles", [(500, 5), (500, 100), (7, 5), (3, 5), (11, 4)])
def test_tiles(spark, rows, n, tiles):
    df = spark.createDataFrame(rows[:n], "k string, g string, v int")
    got = {r.k: r.t for r in ordered.with_tiles(df, "t", tiles, [F.col("v").asc(), F.col("k").asc()]).collect()}
    order = sorted(rows[:n], key=lambda r: (r[2], r[0]))
    parts = np.array_split(np.arange(n), tiles)
    want = {order[i][0]: t for t, part in enumerate(parts, 1) for i in part}
    assert got == want


def test_quantiles(spark, rows):
    df = spark.createDataFrame(rows, "k string, g string, v int")
    got = {r.g: (r.q1, r.m, r.p) for r in ordered.quantiles(df, "v", {"q1": 0.25, "m": 0.5, "p": 0.99}, ["g"]).collect()}
    for g in "ab":
        values = [v for _, x, v in rows if x == g]
        assert got[g] == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.99])))
    whole = ordered.quantiles(df, "v", {"m": 0.3}).first()
    assert whole.m == pytest.approx(np.quantile([v for _, _, v in rows], 0.3))


def test_quantiles_with_weight(spark):
    df = spark.createDataFrame([(1.0, 3), (4.0, 2)], "v double, n int")
    assert ordered.quantiles(df, "v", {"m": 0.5, "q": 0.75}, weight="n").first()[:] == pytest.approx((1.0, 4.0))


def test_first_per_key_is_stable(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 3, "n"), (None, 3, "n")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = ordered.first_per_key(df, ["k"], ["o"]).collect()
    assert sorted((str(r.k), r.o, r.v) for r in got) == [("None", 3, "n"), ("a", 1, "y")]


def test_abc_ties_and_cuts(spark):
    df = spark.createDataFrame([("p1", 80.0), ("p2", 10.0), ("p3", 5.0), ("p4", 5.0), ("p5", None)], "k string, v double")
    rows = {r.k: r.abc_class for r in classify.abc_classify(df, "k", "v").collect()}
    assert rows == {"p1": "A", "p2": "B", "p3": "B", "p4": "C", "p5": "C"}
    ranged = {r.k: r.abc_class for r in classify.abc_classify(df, "k", "v", frame="range").collect()}
    assert ranged == {"p1": "A", "p2": "B", "p3": "C", "p4": "C", "p5": "C"}


def test_abc_without_revenue_and_empty(spark):
    zero = spark.createDataFrame([("p1", 0.0)], "k string, v double")
    assert [r.abc_class for r in classify.abc_classify(zero, "k", "v").collect()] == ["C"]
    assert classify.abc_classify(zero.limit(0), "k", "v").count() == 0


def test_rank_branches_shares_mean_rank(spark):
    rows = [("KCC_1", 5.0), ("KCC_2", 9.0), ("KCC_3", 9.0), ("ZZ_1", 1.0)]
    lines = spark.createDataFrame(rows, "chi_nhanh string, doanh_thu double").withColumn("loi_nhuan_gop", F.lit(1.0))
    got = {r.chi_nhanh: (r.peer_group, r.branch_rank) for r in classify.rank_branches(classify.branch_metrics(lines)).collect()}
    assert got == {"KCC_1": ("AP", 3.0), "KCC_2": ("AP", 1.5), "KCC_3": ("AP", 1.5), "ZZ_1": ("OTHER", 1.0)}


def test_outliers(spark):
    rows = [(float(10 + i % 3), float(1 + i % 4), 1.0, 10.0) for i in range(60)] + [(500.0, 90.0, -1.0, 200.0)]
    df = spark.createDataFrame(rows, "doanh_thu double, so_luong double, loi_nhuan_sp double, ty_suat_loi_nhuan double")
    got = classify.flag_outliers(df).filter("is_revenue_outlier or is_quantity_outlier or is_margin_outlier").collect()
    assert [(r.doanh_thu, r.is_revenue_outlier, r.is_quantity_outlier, r.is_margin_outlier) for r in got] == [(500.0, True, True, True)]
    revenue = [r[0] for r in rows]
    want = abs((500.0 - np.mean(revenue)) / np.std(revenue, ddof=1))
    assert got[0].revenue_zscore == pytest.approx(want)


def test_rfm_scores_are_quintiles(spark):
    rows = [(f"c{i:02d}", date(2024, 1, 1 + i), 10.0 * i, 1.0) for i in range(10)]
    receipts = spark.createDataFrame(rows, "branch_code string, transaction_date date, revenue double, gross_profit double")
    got = classify.rfm(classify.rfm_base(receipts, "2024-01-31")).orderBy("customer_id").collect()
    assert [r.r_score for r in got] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert got[-1].rfm_segment == "Champions" and got[-1].rfm_score == 555
    assert got[0].rfm_segment == "Hibernating"


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    """Of a key with a third of the rows each task hands on one row."""
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"), F.lit("wide").alias("v"))
    got = ordered.first_per_key(df, ["k"], ["o"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Partial" in plan[plan.index("WindowGroupLimit"):]
    rows = got.collect()
    assert len(rows) == 20_001 and [r.o for r in rows if r.k == 0] == [0]


def test_scores_of_several_values_in_one_pass(spark):
    """NTILE of each value as a window gives it, with ties and a null key."""
    rows = [(None if i == 5 else f"k{i:03}", (i * 7) % 13, float(i % 4)) for i in range(83)]
    df = spark.createDataFrame(rows, "k string, a int, b double")
    got = {r.k: (r.x, r.y) for r in ordered.with_scores(df, "k", {"x": -F.col("a"), "y": F.col("b")}, 5).collect()}
    want = df.select(
        "k", F.ntile(5).over(Window.orderBy(F.col("a").desc(), "k")).alias("x"),
        F.ntile(5).over(Window.orderBy("b", "k")).alias("y")).collect()
    assert got == {r.k: (r.x, r.y) for r in want} and len(got) == 83
    assert ordered.with_scores(df.limit(0), "k", {"x": F.col("a")}, 5).count() == 0

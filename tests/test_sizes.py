"""What keeps a task's share, and what is written, in bounds as the input grows."""

import glob
from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfwise.operators import forecast
from shelfwise.plans import catalog
from shelfwise.session import pinned, shared_dir, tune


def test_more_rows_make_more_tasks(spark):
    """64 MB that do not compress: more reducers than spark.sql.shuffle.partitions (4), each of some 8 MB."""
    rows = tune(spark).range(4_000_000).select(F.rand(1).alias("k"))
    assert pinned(rows.groupBy("k").count()).rdd.getNumPartitions() > 4


def test_clean_lines_are_not_shuffled_by_their_key(spark, data):
    """The last join places raw lines by receipt, so the wide rows go to the deduplication as they lie."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.queries()["B1_clean_sales"](spark, data)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert window < join and not any("Exchange" in line for line in lines[:join])


def test_raw_files_are_written_compressed(spark, data):
    known = set(glob.glob(f"{shared_dir(spark)}/raw-sales-*"))
    catalog.queries()["A1_sales_csv_round_trip"](spark, data)
    made = set(glob.glob(f"{shared_dir(spark)}/raw-sales-*")) - known
    files = [f for path in made for f in glob.glob(f"{path}/part-*")]
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_few_rows_are_fitted_in_one_partition(spark):
    rows = [(date(2024, 1, 1) + timedelta(days=i), float(i % 3), 5.0 + i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "ngay date, x double, daily_quantity double").repartition(20)
    made = forecast._vectors(df, ["x"], "daily_quantity")
    assert made.rdd.getNumPartitions() == 1 and made.count() == 60

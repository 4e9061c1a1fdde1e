"""Streams: archive, replay and agreement with batch."""

import os
from datetime import date, datetime

from pyspark.sql import functions as F

from shelfwise.operators import clean
from shelfwise.session import tune
from shelfwise.sources import schemas
from shelfwise.streaming import ingest

HEADER = ",".join(f'"{h}"' for h, _, _ in schemas.SALES_COLUMNS)


def line(code, product, qty, time="01/02/2026 10:00:00"):
    return f"{time},{code},KCC_1,{product},B,Name,X,A >> B,{qty},10,7,10,,10,7,3"


def drop(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


def test_files_are_inserted_once_and_archived(spark, tmp_path):
    inbox, out, state, archive = (str(tmp_path / n) for n in ("in", "out", "state", "archive"))

    def run():
        ingest.ingest_sales(spark, inbox, out, state, archive, files_per_batch=1).awaitTermination()
        return spark.read.parquet(out)

    drop(inbox, "a.csv", line("T1", "H1", 1), line("T1", "H1", 1), line("T1", "H2", 2), line("T9", "H9", 1, "bad time"))
    assert run().count() == 3
    drop(inbox, "b.csv", line("T1", "H1", 1), line("T2", "H1", 5), line("T9", "H9", 1, "bad time"))
    rows = run()
    assert sorted((r.ma_giao_dich, r.ma_hang, r.so_luong) for r in rows.collect()) == [
        ("T1", "H1", 1), ("T1", "H2", 2), ("T2", "H1", 5), ("T9", "H9", 1)]
    drop(inbox, "c.csv", line("T3", "H1", 1))
    assert run().count() == 5
    archived = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".csv")]
    assert "a.csv" in archived


def test_replayed_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "t")
    insert = ingest.insert_batch(out, ["k"])
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    second = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    insert(first, 0)
    insert(second, 1)
    insert(second, 1)
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 2), ("c", 3)]


def _totals(spark, tmp_path):
    rows = [(datetime(2026, 1, 1 + i % 3, 9), "KCC", "A", "B", 10.0 * i, 1.0 * i, float(i), i) for i in range(12)]
    df = spark.createDataFrame(
        rows, "at timestamp, chi_nhanh string, nhom_hang_cap_1 string, nhom_hang_cap_2 string, "
        "doanh_thu double, loi_nhuan double, so_luong double, id int"
    )
    path = str(tmp_path / "in")
    df.repartition(3).write.parquet(path)
    return df, path


def test_streamed_totals_equal_batch(spark, tmp_path):
    df, path = _totals(spark, tmp_path)
    out = str(tmp_path / "memory")
    stream = ingest.drop_folder(spark, path, schema=df.schema, fmt="parquet", files_per_batch=1)
    keys = ("chi_nhanh", "nhom_hang_cap_1", "nhom_hang_cap_2")
    totals = ingest.daily_totals_stream(stream, "at", keys, "10 days")
    latest = {}

    def keep(rows, batch):
        for r in rows.collect():
            latest[r.ngay] = (r.doanh_thu, r.loi_nhuan, r.so_luong, r.so_giao_dich)

    ingest.drain(totals, out, keep, "update").awaitTermination()
    want = {
        r.d: (r.a, r.b, r.c, r.n)
        for r in df.groupBy(F.to_date("at").alias("d")).agg(
            F.sum("doanh_thu").alias("a"), F.sum("loi_nhuan").alias("b"), F.sum("so_luong").alias("c"), F.count("*").alias("n")
        ).collect()
    }
    assert latest == want and len(want) == 3 and date(2026, 1, 2) in want


def test_stream_drops_duplicates(spark, tmp_path):
    df, path = _totals(spark, tmp_path)
    df.write.mode("append").parquet(path)
    stream = ingest.drop_folder(spark, path, schema=df.schema, fmt="parquet")
    seen = []
    unique = ingest.dedupe_stream(stream, "at", ["id"], "10 days")
    ingest.drain(unique, str(tmp_path / "s"), lambda rows, batch: seen.extend(r.id for r in rows.collect())).awaitTermination()
    assert sorted(seen) == list(range(12))


def test_clean_sales_of_nothing(spark):
    empty = spark.createDataFrame([], schemas.RAW_SALES).withColumnsRenamed(schemas.SALES_NAMES)
    assert clean.clean_sales(empty).count() == 0


def _keyed(spark, day, n, first=0):
    rows = [(datetime(2026, 1, day, 9) if day else None, f"k{i}", i) for i in range(first, first + n)]
    return spark.createDataFrame(rows, "at timestamp, k string, v int")


def test_a_batch_opens_the_index_of_its_days_only(spark, tmp_path):
    out, keys = str(tmp_path / "t"), ["at", "k"]
    insert = ingest.insert_batch(out, keys, "at")
    for batch in range(12):
        insert(_keyed(spark, batch + 1, 3), batch)
    insert(_keyed(spark, None, 2), 12)
    schema = ingest._index_rows(_keyed(spark, 5, 1), keys, "at", F.lit(0)).schema
    known = ingest.known_keys(spark, out, keys, [date(2026, 1, 5)], 13, schema)
    opened = known.inputFiles()
    assert 1 <= len(opened) <= 2 and all("day=2026-01-05" in f for f in opened)
    assert sorted(r.k for r in known.collect()) == ["k0", "k1", "k2"]
    assert ingest.known_keys(spark, out, keys, [date(2026, 3, 1)], 13, schema) is None
    # New and known keys of two days, and rows without a time.
    insert(_keyed(spark, 5, 5).unionByName(_keyed(spark, 6, 4)).unionByName(_keyed(spark, None, 3)), 13)
    insert(_keyed(spark, 5, 5), 13 + 1)
    rows = spark.read.parquet(out)
    assert "day" not in rows.columns and rows.count() == 12 * 3 + 2 + 2 + 1 + 1
    assert rows.count() == rows.select(*keys).distinct().count()


def test_a_replayed_batch_replaces_its_index(spark, tmp_path):
    out, keys = str(tmp_path / "t"), ["at", "k"]
    insert = ingest.insert_batch(out, keys, "at")
    insert(_keyed(spark, 1, 3), 0)
    for _ in range(2):
        insert(_keyed(spark, 1, 5), 1)
    assert spark.read.parquet(out).groupBy("batch").count().orderBy("batch").collect() == [(0, 3), (1, 2)]
    assert spark.read.parquet(f"{out}/_keys").count() == 5


def test_an_index_is_built_for_a_table_without_one(spark, tmp_path):
    out, keys = str(tmp_path / "t"), ["at", "k"]
    _keyed(spark, 1, 3).write.parquet(f"{out}/batch=0")
    ingest.insert_batch(out, keys, "at")(_keyed(spark, 1, 5), 1)
    assert spark.read.parquet(out).count() == 5


def test_an_index_by_month(spark, tmp_path):
    out, keys = str(tmp_path / "t"), ["at", "k"]
    insert = ingest.insert_batch(out, keys, "at", "month")
    insert(_keyed(spark, 1, 3), 0)
    insert(_keyed(spark, 31, 3).unionByName(_keyed(spark, 1, 4)), 1)
    assert spark.read.parquet(out).count() == 3 + 3 + 1
    assert os.listdir(f"{out}/_keys") and all("day=2026-01-01" in f for f in spark.read.parquet(f"{out}/_keys").inputFiles())


def test_a_batch_runs_in_tasks_by_its_size(spark, tmp_path):
    """A shuffle is cut into 1,000 pieces at first; those of a small batch are joined in every pass over it."""
    tune(spark)
    out, tracker = str(tmp_path / "t"), spark.sparkContext.statusTracker()
    insert = ingest.insert_batch(out, ["at", "k"], "at")
    insert(_keyed(spark, 1, 3), 0)
    spark.sparkContext.setJobGroup("second-batch", "insert")
    insert(_keyed(spark, 1, 5).repartition(4), 1)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {i for job in tracker.getJobIdsForGroup("second-batch") for i in tracker.getJobInfo(job).stageIds}
    tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    assert tasks and max(tasks) < 100
    assert spark.read.parquet(out).count() == 5

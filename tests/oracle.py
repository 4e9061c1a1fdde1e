"""Compare registered queries with their SQL in DuckDB: `python tests/oracle.py SF_DIR [name ...]`."""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _kind(text: str) -> str:
    text = str(text).lower()
    for kind, words in {
        "int": ("bigint", "long", "hugeint", "integer", "int", "smallint", "tinyint"),
        "float": ("double", "float", "decimal"),
        "text": ("varchar", "string"),
        "bool": ("boolean",),
    }.items():
        if any(text.startswith(w) for w in words):
            return kind
    return text.split("_")[0]


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r),
    )


def differences(frame, con, sql: str) -> list[str]:
    """Empty when columns, kinds and rows agree."""
    names = frame.columns
    got = _rows(names, [tuple(r) for r in frame.collect()])
    answer = con.execute(sql)
    cols = [d[0] for d in answer.description]
    kinds = {d[0]: _kind(d[1]) for d in answer.description}
    want = _rows(cols, answer.fetchall())
    out = []
    if sorted(names) != sorted(cols):
        return [f"columns {sorted(set(names) ^ set(cols))}"]
    for c, t in frame.dtypes:
        if _kind(t) != kinds[c]:
            out.append(f"kind of {c}: {t} / {kinds[c]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} / {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, columns {sorted(names)}:\n   {bad[0][0]}\n   {bad[0][1]}")
    return out


def main(folder: str, wanted: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.coalescePartitions.enabled", os.environ.get("COALESCE", "true")).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in oracles:
                wrong = differences(df, con, oracles[name])
                note = "ok" if not wrong else "; ".join(wrong)
            else:
                wrong, note = [], f"rows only: {len(df.collect())}"
        except Exception as e:
            wrong, note = [1], f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {name} {time.time() - start:.2f}s {note}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]) > 0)

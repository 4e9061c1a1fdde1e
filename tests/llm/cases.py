"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

LONG = " ".join(f"word{i * i % 977} and" for i in range(6000))


def documents(spark, extra=()):
    rows = [
        (1, "The cat sat on the mat.", "en", "a", 23),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, "The cat sat on the mat.", "en", None, 23),
        (4, "The cat sat on the mat.", "en", None, 23),
        (None, "Der Hund lief über die Straße.", "de", "b", 30),
        (6, LONG, "en", "c", len(LONG)),
        (7, " \t\n ", None, None, 4),
        (8, "<|endoftext|> 12,5 ½ 🙂\x1c x", None, "c", None),
        *extra,
    ]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df, *names):
    """The table with columns named like outputs and inner columns."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names})


def empty(df):
    return df.limit(0)

"""Rows that every operator must take: nulls, empty and very long texts, repeats, clashing extra columns."""

from pyspark.sql import DataFrame, SparkSession

EXTRA = "_key string, d long, h string, n int, row string, pattern string, size int, node string, line int, whole string, _u int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def odd_documents(spark: SparkSession) -> DataFrame:
    prose = "one two three four five six seven eight nine ten eleven twelve"
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, prose, "en", "a"),
        (1, prose, "en", "a"),  # the same row again
        (1, "another text under the same id", "en", "b"),
        (None, prose, None, None),
        (None, None, None, "a"),
        (2, None, "en", "b"),
        (3, "", "en", None),
        (4, " \n\t\n ", "de", "b"),
        (5, long, "en", "a"),
        (6, "éü 漢字 x <|endoftext|> \U0001f600", "fr", "c"),
        (-7, "idiot", "en", "c"),
    ]
    extra = ("k", 9, "h", 1, "r", "p", 2, "n", 3, "w", 4)
    return spark.createDataFrame([(*r, len(r[1] or ""), *extra) for r in rows], SCHEMA)


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def labels(spark: SparkSession, rows=()) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

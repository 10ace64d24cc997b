"""Small tables with every kind of row that an operator must stand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
HARD = [
    (1, "the quick brown fox jumps over the lazy dog"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "the quick brown fox jumps over the lazy dog"),
    (6, "ONE  two\n\n three   1234 don't <|endoftext|> 日本語 é\x1c"),
    (7, LONG),
    (8, "short"),
    (9, "short"),
]


def hard(spark: SparkSession, rows=HARD) -> DataFrame:
    """Nulls, empty, repeated and very long texts, with further columns whose names operators use inside."""
    wide = [(i, t, "en", "src", None if t is None else len(t), 7, 8, "x", [1.5]) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, key int, n int, set_id string, score array<double>")


def empty(spark: SparkSession) -> DataFrame:
    return hard(spark).limit(0)


def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SF}/documents.parquet")

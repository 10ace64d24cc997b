"""Checks of a table's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quality_checks(df: DataFrame, required: Sequence[str] = ("symbol", "time"), prices: Sequence[str] = ("open", "high", "low", "close"), volume: str = "volume", expected_rows: int | None = None) -> DataFrame:
    """(rule, violations, passed): nulls, prices not above 0, volume below 0, times that don't rise within a symbol, row count.

    With ``__file`` and ``__position`` (as ``tables.stored`` gives them) times must rise in the order of each file, and a symbol's files must not interleave; a
    violation is a row whose time isn't after that of the symbol's row before it in the file, or a file that begins before the symbol's file before it ended.
    Without them rows have no order but their time's, and a violation is a repeated time.
    """
    rules: list[tuple[str, Column]] = [(f"{c} is known", F.sum(F.col(c).isNull().cast("long"))) for c in required]
    rules += [(f"{c} is positive", F.sum(F.coalesce(F.col(c) <= 0, F.lit(False)).cast("long"))) for c in prices if c in df.columns]
    if volume in df.columns:
        rules.append((f"{volume} is not negative", F.sum(F.coalesce(F.col(volume) < 0, F.lit(False)).cast("long"))))
    rules.append(("times rise within a symbol", F.sum(F.coalesce(F.col("time") <= F.col("__before"), F.lit(False)).cast("long"))))
    in_files = "__file" in df.columns
    if expected_rows is not None:
        rules.append(("rows as expected", F.abs(F.count("*") - expected_rows)))
    if in_files:
        rows = df.withColumn("__before", F.lag("time").over(Window.partitionBy("symbol", "__file").orderBy("__position")))
        spans = df.groupBy("symbol", "__file").agg(F.min("time").alias("a"), F.max("time").alias("b"))
        crossed = spans.withColumn("c", F.col("a") <= F.max("b").over(Window.partitionBy("symbol").orderBy("a", "b", "__file").rowsBetween(Window.unboundedPreceding, -1)))
    else:
        rows = df.withColumn("__before", F.lag("time").over(Window.partitionBy("symbol").orderBy("time")))
    listed = rows.agg(F.array(*[F.struct(F.lit(name).alias("rule"), F.coalesce(v, F.lit(0)).cast("long").alias("violations")) for name, v in rules]).alias("r"))
    found = listed.select(F.explode("r").alias("r")).select("r.rule", "r.violations")
    if in_files:
        found = found.unionByName(crossed.agg(F.count(F.when(F.col("c"), 1)).alias("violations")).select(F.lit("files of a symbol follow each other").alias("rule"), "violations"))
    return found.withColumn("passed", F.col("violations") == 0)

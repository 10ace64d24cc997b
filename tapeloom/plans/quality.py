"""Data quality: validation of rollups, checks, and repair of stamps and duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.checks import quality_checks  # noqa: F401
from ..operators.joins import reconcile
from ..operators.resample import rollup_bars


def freshness(df: DataFrame, calendar: DataFrame, today, time: str = "time") -> DataFrame:
    """Latest day of a dataset, the last open day up to ``today``, and the open days between them."""
    last = df.agg(F.max(time).cast("date").alias("latest"))
    days = calendar.where((F.col("is_open") == 1) & (F.col("cal_date") <= F.lit(today).cast("date"))).select("cal_date").distinct()
    joined = days.join(F.broadcast(last), F.col("cal_date") > F.coalesce("latest", F.lit("0001-01-01").cast("date")), "right")
    return joined.groupBy("latest").agg(F.max("cal_date").alias("last_open"), F.count("cal_date").alias("days_behind")).withColumn("is_stale", F.col("days_behind") > 0)


def validate_rollup(bars: DataFrame, stored: DataFrame, unit: str, tolerance: float = 1e-4) -> tuple[DataFrame, DataFrame]:
    """(summary, details) of stored weekly or monthly prices against ones computed anew."""
    details = reconcile(rollup_bars(bars, unit), stored, ["symbol", "time"], ["open", "high", "low", "close"], tolerance)
    summary = details.agg(F.count("*").alias("n_rows"), F.sum((~F.col("passed")).cast("long")).alias("n_failed"), F.max("max_error").alias("max_error"))
    return summary, details


def hour_histogram(tables: Mapping[str, DataFrame], time: str = "time") -> DataFrame:
    """Rows by table and hour of the day."""
    return reduce(DataFrame.unionByName, [df.groupBy(F.hour(time).alias("hour")).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "hour", "n") for name, df in tables.items()])


def duplicated_hours(df: DataFrame, keep: int = 15, wrong: int = 8) -> DataFrame:
    """(symbol, day) stamped at the wrong hour that have no row at the right one."""
    at = lambda h: df.where(F.hour("time") == h).select("symbol", F.col("time").cast("date").alias("day"))
    return at(wrong).subtract(at(keep))


def repair_duplicate_bars(df: DataFrame, keep: int = 15, wrong: int = 8) -> DataFrame:
    """Rows at the wrong hour are moved to the right one, or dropped where that has a row; other hours stay."""
    w = Window.partitionBy("symbol", F.col("time").cast("date"))
    hour = F.hour("time")
    has = F.max((hour == keep).cast("int")).over(w) == 1
    out = df.withColumn("__has", has).where((hour != wrong) | ~F.col("__has"))
    return out.withColumn("time", F.when(F.hour("time") == wrong, F.date_trunc("day", "time") + F.make_interval(hours=F.lit(keep))).otherwise(F.col("time"))).drop("__has")


def repair_timestamps(df: DataFrame, hours: Sequence[int], to: int = 15, time: str = "time") -> DataFrame:
    return df.withColumn(time, F.when(F.hour(time).isin(list(hours)), F.date_trunc("day", time) + F.make_interval(hours=F.lit(to))).otherwise(F.col(time)))

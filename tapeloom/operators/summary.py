"""Latest rows, table statistics and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], time: str = "time") -> DataFrame:
    """The latest time of each key."""
    return df.groupBy(*keys).agg(F.max(time).alias("latest"))


def latest_row(df: DataFrame, keys: Sequence[str], time: str = "time", tie: Sequence[str] = ()) -> DataFrame:
    """The whole latest row of each key, as one aggregate that combines before its shuffle."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(time), *[F.col(c) for c in tie])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def last_n(df: DataFrame, n: int, keys: Sequence[str] = ("symbol",), time: str = "time") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(time))
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def table_stats(df: DataFrame, key: str = "symbol", time: str = "time") -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys"), F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def integrity_report(tables: Mapping[str, DataFrame], time: Mapping[str, str] | None = None) -> DataFrame:
    """Rows and latest time of each table, one row a table."""
    parts = [df.agg(F.count("*").alias("n_rows"), F.max((time or {}).get(name, "time")).cast("timestamp").alias("latest")).select(F.lit(name).alias("table_name"), "n_rows", "latest") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def approximate_counts(tables: Mapping[str, DataFrame], key: Mapping[str, str]) -> DataFrame:
    """Rows (from file footers) and about how many distinct keys each table has."""
    parts = [df.agg(F.count("*").alias("n_rows"), F.approx_count_distinct(key[name]).alias("about_keys")).select(F.lit(name).alias("table_name"), "n_rows", "about_keys") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def member_count(members: DataFrame, level: str = "l2_name") -> DataFrame:
    current = members.where("is_new = 'Y'") if "is_new" in members.columns else members
    return current.groupBy(level).agg(F.count("*").alias("members"))


def industry_summary(valued: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(totals, by industry) of industry-valued rows."""
    exempt = F.col("is_exempted").cast("long")
    totals = valued.agg(F.count("*").alias("total"), F.countDistinct("symbol").alias("symbols"), F.countDistinct("time").alias("dates"), F.sum(exempt).alias("exempted"), F.avg(exempt).alias("exempt_rate"))
    by = valued.groupBy("l2_name").agg(F.countDistinct("symbol").alias("symbols"), F.sum(exempt).alias("exempted"))
    return totals, by


def exemption_counts(valued: DataFrame) -> DataFrame:
    return valued.where("is_exempted").groupBy("exemption_reason").agg(F.count("*").alias("n"))

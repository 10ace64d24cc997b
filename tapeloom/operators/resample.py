"""Bars of longer periods, and the maintained weekly and monthly rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import period_end
from .adjust import require_adjusted
from .ranges import spread

#: Rule of each column: first, last, max, min, sum.
RULES = {"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum", "amount": "sum", "adj_factor": "last"}


def rule_of(column: str, rule: str, time: str = "time") -> Column:
    """First and last are by time among non-null values; an all-null sum is 0."""
    value, at = F.col(column), F.when(F.col(column).isNotNull(), F.col(time))
    return {
        "first": lambda: F.min_by(value, at),
        "last": lambda: F.max_by(value, at),
        "max": lambda: F.max(value),
        "min": lambda: F.min(value),
        "mean": lambda: F.avg(value),
        "sum": lambda: F.coalesce(F.sum(value), F.lit(0).cast("double" if column != "volume" else "long")),
    }[rule]().alias(column)


def resample(bars: DataFrame, freq: str, rules: Mapping[str, str] | None = None, check_adjusted: bool = True) -> DataFrame:
    """One row a symbol and period (W, M, Q, Y), stamped at the period's end; periods without an open are dropped."""
    return resample_multi(bars, [freq], rules, check_adjusted).drop("freq")


def resample_multi(bars: DataFrame, freqs: Sequence[str], rules: Mapping[str, str] | None = None, check_adjusted: bool = True) -> DataFrame:
    """Several periods in one aggregation: each bar is put to the end of each of its periods."""
    chosen = {c: r for c, r in (rules or RULES).items() if c in bars.columns}
    if not chosen:
        raise ValueError("no rule applies to a column of these bars")
    if check_adjusted:
        require_adjusted(bars)
    ends = F.explode(F.array(*[F.struct(F.lit(f).alias("freq"), period_end(F.col("time"), f).alias("end")) for f in freqs]))
    rows = spread(bars, ["symbol"]).select("symbol", "time", *chosen, ends.alias("__p"))
    out = rows.groupBy("symbol", F.col("__p.freq").alias("freq"), F.col("__p.end").alias("__end")).agg(*[rule_of(c, r) for c, r in chosen.items()])
    if "open" in chosen:
        out = out.where(F.col("open").isNotNull())
    return out.select("symbol", F.col("__end").alias("time"), "freq", *chosen)


def bucket(unit: str, time: str = "time") -> Column:
    """Start of the calendar week (Monday) or month."""
    return F.date_trunc(unit, F.col(time))


def rollup_bars(bars: DataFrame, unit: str) -> DataFrame:
    """Weekly or monthly bars stamped at the bucket's start, prices times last over first factor of the bucket."""
    ratio = F.max_by("adj_factor", "time") / F.min_by("adj_factor", "time")
    return spread(bars, ["symbol"]).groupBy("symbol", bucket(unit).alias("time")).agg(
        (F.min_by("open", "time") * ratio).alias("open"),
        (F.max("high") * ratio).alias("high"),
        (F.min("low") * ratio).alias("low"),
        F.max_by("close", "time").alias("close"),
        *[F.sum(c).alias(c) for c in ("volume", "amount") if c in bars.columns],
        F.max_by("adj_factor", "time").alias("adj_factor"),
    )


def rollup_ratios(ratios: DataFrame, unit: str, averages: Sequence[str], lasts: Sequence[str]) -> DataFrame:
    return spread(ratios, ["symbol"]).groupBy("symbol", bucket(unit).alias("time")).agg(*[F.avg(c).alias(f"avg_{c}") for c in averages], *[F.max_by(c, "time").alias(c) for c in lasts])


def rollup_factor(factors: DataFrame, unit: str) -> DataFrame:
    return spread(factors, ["symbol"]).groupBy("symbol", bucket(unit).alias("time")).agg(F.max_by("adj_factor", "time").alias("adj_factor"))


def whole_buckets(df: DataFrame, unit: str, start=None, end=None, time: str = "time") -> DataFrame:
    """Rows of all buckets that the open-ended range touches, so that each is recomputed from all its rows."""
    out = df
    if start is not None:
        out = out.where(F.col(time) >= F.date_trunc(unit, F.lit(start).cast("timestamp")))
    if end is not None:
        step = F.expr("INTERVAL 7 DAYS" if unit == "week" else "INTERVAL 1 MONTH")
        out = out.where(F.col(time) < F.date_trunc(unit, F.lit(end).cast("timestamp")) + step)
    return out

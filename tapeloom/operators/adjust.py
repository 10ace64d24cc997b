"""Price adjustment for dividends and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OHLC = ("open", "high", "low", "close")


def base_factor(how: str, key: str = "symbol", time: str = "time", factor: str = "adj_factor") -> Column:
    """The symbol's factor at its latest (qfq) or first (hfq) time."""
    pick = F.max_by if how == "qfq" else F.min_by
    return pick(factor, time).over(Window.partitionBy(key))


def adjust(bars: DataFrame, how: str = "qfq", price_columns: Sequence[str] = OHLC) -> DataFrame:
    """Prices times factor over base factor; ``none`` leaves them.  Adds ``adjust_type`` and whether the row was ``adjusted``:
    a symbol whose base factor is null or 0 keeps its raw prices."""
    if how == "none":
        return bars.withColumn("adjust_type", F.lit("none")).withColumn("adjusted", F.lit(False))
    if how not in ("qfq", "hfq"):
        raise ValueError(f"unknown adjustment {how!r}")
    if "adj_factor" not in bars.columns:
        raise ValueError("bars have no adj_factor")
    out = bars.withColumn("__base", base_factor(how)).withColumn("adjusted", F.coalesce(F.col("__base") != 0, F.lit(False)))
    ratio = F.when(F.col("adjusted"), F.col("adj_factor") / F.col("__base")).otherwise(1.0)
    return out.withColumns({c: F.col(c) * ratio for c in price_columns if c in bars.columns}).withColumn("adjust_type", F.lit(how)).drop("__base")


def reverse_adjust(bars: DataFrame, how: str = "qfq", price_columns: Sequence[str] = OHLC) -> DataFrame:
    """The inverse of ``adjust``: raw prices from adjusted ones."""
    out = bars.withColumn("__base", base_factor(how))
    ok = (F.col("__base") != 0) & (F.col("adj_factor") != 0)
    ratio = F.when(ok, F.col("__base") / F.when(F.col("adj_factor") != 0, F.col("adj_factor"))).otherwise(1.0)
    return out.withColumns({c: F.col(c) * ratio for c in price_columns if c in bars.columns}).withColumn("adjust_type", F.lit("none")).drop("__base", "adjusted")


def require_adjusted(bars: DataFrame) -> DataFrame:
    """Refuse bars of which any row is labelled unadjusted (one row is looked for)."""
    if "adjust_type" in bars.columns and bars.where("adjust_type = 'none'").limit(1).count():
        raise ValueError("bars must be adjusted before they are resampled")
    return bars

"""Rolling and cross-sectional percentiles of valuation ratios."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.industry import with_defaults
from .joins import asof_join, with_membership
from .kernels import GROUP_ROWS, apply_kernel, count_below
from .ranges import small, spread

METRICS = ("pe_ttm", "pb", "ps_ttm")


def percentile_in_window(x: np.ndarray, known: np.ndarray, window: int, min_rows: int) -> np.ndarray:
    """Of each value that is positive: the share (in percent) of the positive values of the last ``window`` rows that lie below it.

    NaN where there are fewer than ``min_rows`` known or 2 positive values; a known NaN is positive and above all.
    """
    n = np.arange(len(x))
    first = np.maximum(n - window + 1, 0)
    positive = known & ((x > 0) | np.isnan(x))
    seen, counted = (np.concatenate([[0], np.cumsum(m)]) for m in (known, positive))
    at = np.flatnonzero(positive)
    below = count_below(x[at], counted[first[at]])
    out = np.full(len(x), np.nan)
    size, rows = counted[at + 1] - counted[first[at]], seen[at + 1] - seen[first[at]]
    enough = (size >= 2) & (rows >= min_rows)
    out[at[enough]] = below[enough] / size[enough] * 100
    return out


def rolling_percentile(df: DataFrame, metrics: Sequence[str] = METRICS, windows: Sequence[int] = (1250,), min_rows: int = 20, rows: int = GROUP_ROWS) -> DataFrame:
    """Adds {metric}_pct_{window}d for each metric and window, all in one pass over each symbol's rows.

    Order statistics come from ``count_below``, whose cost doesn't depend on the window; a symbol of over ``rows`` rows is cut with the window's overlap.
    """
    names = {f"{m}_pct_{n}d": (m, n) for m in metrics if m in df.columns for n in windows}
    if not names:
        return df

    def kernel(table):
        columns = {m: pc.cast(table.column(m), "float64").combine_chunks() for m, _ in names.values()}
        known = {m: ~np.asarray(c.is_null()) for m, c in columns.items()}
        x = {m: c.fill_null(0.0).to_numpy(zero_copy_only=False) for m, c in columns.items()}
        return {name: percentile_in_window(x[m], known[m], n, min_rows) for name, (m, n) in names.items()}

    return apply_kernel(df, kernel, ", ".join(f"{c} double" for c in names), warmup=max(windows) - 1, rows=max(rows, max(windows))).select(*[c for c in df.columns if c not in names], *names)


def current_percentile(df: DataFrame, metric: str, window: int = 250) -> DataFrame:
    """Of each symbol with at least ``window`` rows: its latest value, and the percentile of that among the window's positive values."""
    w = Window.partitionBy("symbol").orderBy(F.desc("time"))
    x = F.col(metric).cast("double")
    recent = df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= window).withColumn("__now", F.max(F.when(F.col("__n") == 1, x)).over(Window.partitionBy("symbol")))
    out = recent.groupBy("symbol").agg(F.count("*").alias("__rows"), F.first("__now").alias("current"), F.count(F.when(x > 0, 1)).alias("__positive"), F.count(F.when((x > 0) & (x < F.col("__now")), 1)).alias("__below"), F.max("time").alias("time"))
    out = out.where(F.col("__rows") >= window)
    return out.select("symbol", "time", "current", F.when((F.col("current") > 0) & (F.col("__positive") >= 2), F.col("__below") / F.col("__positive") * 100).alias("percentile"))


def cross_section_percentile(value: str, group: Sequence[str] = ("time", "l2_name"), min_group: int = 3) -> Column:
    """Average rank over count (in percent) among the group's values; groups of fewer than ``min_group`` values, or of a null name, give null."""
    v = F.col(value)
    known = v.isNotNull()
    w = Window.partitionBy(*group)
    n = F.count(v).over(w)  # nulls come last in both orders, so ranks of values are among values
    rank = (F.rank().over(w.orderBy(v.asc_nulls_last())) + n + 1 - F.rank().over(w.orderBy(v.desc_nulls_last()))) / 2
    named = F.lit(True)
    for g in group:
        named = named & F.col(g).isNotNull()
    return F.when(known & named & (n >= min_group), rank / n * 100)


def with_peg(ratios: DataFrame, statements: DataFrame, growth: str = "netprofit_yoy") -> DataFrame:
    """Adds ``peg``: pe_ttm over the growth last announced at or before the day, if both are positive."""
    known = statements.select("symbol", "ann_date", F.col(growth).alias("__growth"))
    out = asof_join(ratios, known, "time", "ann_date", ["symbol"], tie=["__growth"])
    return out.withColumn("peg", rules.peg(F.col("pe_ttm"), F.col("__growth"))).drop("__growth", "ann_date")


OUTPUT = ("symbol", "time", "l1_name", "l2_name", "l3_name", "core_indicator_type", "core_indicator_value", "core_indicator_pct_1250d", "core_indicator_industry_pct", "ref_indicator_type", "ref_indicator_value", "ref_indicator_pct_1250d", "ref_indicator_industry_pct", "is_exempted", "exemption_reason", "fscore_exemptions")


def industry_valuation(valuation: DataFrame, members: DataFrame, config: DataFrame, min_group: int = 3, window: int = 1250) -> DataFrame:
    """The ratios an industry is valued by, with their own history's and their industry's percentiles on the day."""
    df = with_membership(valuation, members).join(small(with_defaults(config)), "l3_name", "left")
    df = df.withColumn("core_indicator_type", F.coalesce("core_indicator", F.lit("PE"))).withColumn("ref_indicator_type", F.coalesce("ref_indicator", F.lit("PB")))
    col = lambda name: F.col(name) if name in df.columns else F.lit(None).cast("double")
    for side in ("core", "ref"):
        kind = F.col(f"{side}_indicator_type")
        df = df.withColumn(f"{side}_indicator_value", rules.pick_indicator(kind, col("pe_ttm"), col("pb"), col("ps_ttm"), col("peg")))
        df = df.withColumn(f"{side}_indicator_pct_1250d", rules.pick_percentile(kind, *[col(f"{m}_pct_{window}d") for m in ("pe_ttm", "pb", "ps_ttm")]))
    df = spread(df, ["time", "l2_name"])
    for side in ("core", "ref"):
        df = df.withColumn(f"{side}_indicator_industry_pct", cross_section_percentile(f"{side}_indicator_value", ("time", "l2_name"), min_group))
    df = df.withColumn("exemption_reason", rules.exemption_reason(F.col("l3_name"), F.col("core_indicator_value"))).withColumn("is_exempted", F.col("exemption_reason").isNotNull())
    df = df.withColumn("fscore_exemptions", F.coalesce("exemptions", F.array().cast("array<string>")))
    return df.select(*[c for c in OUTPUT if c in df.columns])

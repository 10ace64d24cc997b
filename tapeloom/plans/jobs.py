"""The daily jobs: processed bars, valuation, quality, industries, macro cycle.  Each is one lineage for all symbols."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.industry import require_covered, with_defaults
from ..operators.adjust import adjust
from ..operators.indicators import apply_batch
from ..operators.joins import bars_with_factor, semi_filter, small
from ..operators.macro import industry_snapshot, macro_cycle
from ..operators.resample import resample
from ..operators.statements import fscore
from ..operators.valuation import industry_valuation, rolling_percentile, with_peg
from .incremental import QUALITY_WRITE_DAYS, filter_by_rules, valuation_window

PERIODS = {"daily": None, "weekly": "W", "monthly": "M"}


def technical_job(bars: DataFrame, factors: DataFrame, indicators: Sequence[str], freqs: Sequence[str] = ("daily", "weekly", "monthly"), rules: DataFrame | None = None, symbols: DataFrame | None = None, how: str = "qfq") -> Mapping[str, DataFrame]:
    """Processed bars of each period, cut to what the write rules ask for."""
    if symbols is not None:
        bars = semi_filter(bars, symbols, ["symbol"])
    adjusted = adjust(bars_with_factor(bars, factors), how)
    out = {}
    for freq in freqs:
        unit = PERIODS[freq]
        rows = apply_batch(resample(adjusted, unit, check_adjusted=how != "none") if unit else adjusted, indicators)
        out[freq] = filter_by_rules(rows, rules, freq) if rules is not None else rows
    return out


def valuation_job(ratios: DataFrame, statements: DataFrame, window: int = 1250, since=None) -> DataFrame:
    """PEG and rolling percentiles; with ``since`` only the rows that changed since."""
    keep = None
    if since is not None:
        ratios, keep = valuation_window(ratios, since)
    out = rolling_percentile(with_peg(ratios, statements), windows=(window,), metrics=("pe_ttm", "pb", "ps_ttm", "dv_ttm"))
    return out if keep is None else out.where(keep)


def quality_job(indicator: DataFrame, balance: DataFrame, cashflow: DataFrame, income: DataFrame, members: DataFrame, config: DataFrame, since=None) -> DataFrame:
    """Scores with each company's industry exemptions; with ``since`` only reports from 100 days before it on."""
    current = members.where("is_new = 'Y'").select("ts_code", "l3_name")
    exemptions = current.join(small(with_defaults(config).select("l3_name", "exemptions")), "l3_name").groupBy("ts_code").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("exemptions")))).alias("exemptions"))
    out = fscore(indicator, balance, cashflow, income, exemptions)
    return out if since is None else out.where(F.col("end_date") >= F.date_sub(F.lit(since).cast("date"), QUALITY_WRITE_DAYS))


def industry_job(valued: DataFrame, members: DataFrame, config: DataFrame, since=None) -> DataFrame:
    """Industry valuation of days from ``since`` on, over each day's whole industries."""
    rows = valued if since is None else valued.where(F.col("time") >= F.lit(since).cast("timestamp"))
    return industry_valuation(rows, members, config)


def macro_job(money: DataFrame, ppi: DataFrame, pmi: DataFrame, gdp: DataFrame, config: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(phases, snapshot), after checking that every current industry is configured."""
    require_covered(members, config)
    phases = macro_cycle(money, ppi, pmi, gdp)
    return phases, industry_snapshot(phases, config, members)

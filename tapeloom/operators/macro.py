"""The monthly macro cycle: alignment of series, phases, their smoothing, and the industries that fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import effective_month
from ..functions.rules import macro_phase, pick_column_with_values
from .joins import asof_join, industry_dimension, phase_industries


def stable_state(state: str, order: str) -> Column:
    """A state holds until another one comes twice in a row; the first one holds from the start."""
    before = F.lag(state).over(Window.orderBy(order))
    confirmed = F.when(before.isNull() | (before == F.col(state)), F.col(state))
    return confirmed


def changed(state: str, order: str) -> Column:
    """Differs from the row before; the first row doesn't."""
    return F.coalesce(F.col(state) != F.lag(state).over(Window.orderBy(order)), F.lit(False))


def align(money: DataFrame, ppi: DataFrame, pmi: DataFrame, gdp: DataFrame) -> DataFrame:
    """Months that all series know: the latest quarter's growth at or before the month, prices and orders of the month itself."""
    end = F.last_day(F.col("time").cast("date"))
    column = pick_column_with_values(pmi, ["pmi010000", "pmi030000"])
    months = money.select(end.alias("observation_time"), "m2_yoy")
    quarters = gdp.select(end.alias("__q"), "gdp_yoy")
    rows = asof_join(months, quarters, "observation_time", "__q").drop("__q")
    rows = rows.join(ppi.select(end.alias("observation_time"), "ppi_yoy"), "observation_time").join(pmi.select(end.alias("observation_time"), F.col(column).alias("pmi") if column else F.lit(None).cast("double").alias("pmi")), "observation_time")
    return rows.na.drop(subset=["m2_yoy", "gdp_yoy", "ppi_yoy", "pmi"])


def macro_cycle(money: DataFrame, ppi: DataFrame, pmi: DataFrame, gdp: DataFrame) -> DataFrame:
    """One row a month, known from the end of the next one.  A few hundred rows, so one partition orders them."""
    df = align(money, ppi, pmi, gdp).withColumn("credit_impulse", F.col("m2_yoy") - F.col("gdp_yoy"))
    df = df.withColumn("raw_phase", macro_phase(F.col("credit_impulse"), F.col("ppi_yoy"), F.col("pmi")))
    df = df.withColumn("time", effective_month(F.col("observation_time")))
    sofar = Window.orderBy("observation_time").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("__confirmed", stable_state("raw_phase", "observation_time")).withColumn("stable_phase", F.last("__confirmed", ignorenulls=True).over(sofar)).drop("__confirmed")
    df = df.withColumn("raw_phase_changed", changed("raw_phase", "observation_time")).withColumn("stable_phase_changed", changed("stable_phase", "observation_time"))
    return df.select("time", "observation_time", "m2_yoy", "gdp_yoy", "ppi_yoy", "pmi", "credit_impulse", "raw_phase", "stable_phase", "raw_phase_changed", "stable_phase_changed")


def industry_snapshot(phases: DataFrame, config: DataFrame, members: DataFrame) -> DataFrame:
    """Every month and configured industry, and whether the industry's phase is the month's."""
    dimension = industry_dimension(config.withColumnRenamed("macro_cycle", "config_macro_cycle"), members)
    out = phase_industries(phases.select("time", "observation_time", "raw_phase", "stable_phase"), dimension)
    same = lambda phase: F.coalesce(F.col("config_macro_cycle") == F.col(phase), F.lit(False))
    return out.withColumn("matches_raw_phase", same("raw_phase")).withColumn("matches_stable_phase", same("stable_phase"))

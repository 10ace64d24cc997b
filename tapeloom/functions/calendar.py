"""Dates and times of the market: closing stamps, period ends, report periods, trading sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARKET_ZONE = "Asia/Shanghai"
#: Market -> (time zone, sessions as minutes of the day, both ends inclusive).
SESSIONS = {
    "CN": ("Asia/Shanghai", ((570, 690), (780, 900))),
    "HK": ("Asia/Hong_Kong", ((570, 720), (780, 960))),
    "US": ("America/New_York", ((570, 960),)),
    "JP": ("Asia/Tokyo", ((540, 690), (750, 900))),
}


def stamp_close(time: Column, zone: str = MARKET_ZONE) -> Column:
    """15:00 in the market's zone of the calendar day of ``time``, as an instant."""
    return F.to_utc_timestamp(F.date_trunc("day", time) + F.expr("INTERVAL 15 HOURS"), zone)


def period_end(day: Column, unit: str) -> Column:
    """Last day of the week (Friday), month, quarter or year (``W``, ``M``, ``Q``, ``Y``) that ``day`` is in; Saturday and Sunday belong to the next Friday."""
    d = day.cast("date")
    return {
        "W": F.date_add(d, F.pmod(F.lit(4) - F.weekday(d), F.lit(7))),
        "M": F.last_day(d),
        "Q": F.last_day(F.add_months(F.trunc(d, "quarter"), 2)),
        "Y": F.make_date(F.year(d), F.lit(12), F.lit(31)),
    }[unit].cast("date")


def period_start(day: Column, unit: str) -> Column:
    """First day of the calendar week (Monday), month, quarter or year."""
    return F.trunc(day.cast("date"), {"W": "week", "M": "month", "Q": "quarter", "Y": "year"}[unit])


def quarter_to_date(period: Column) -> Column:
    """``2025Q1`` -> 2025-03-31; null for anything else."""
    ok = period.rlike("^[0-9]{4}Q[1-4]$")
    return F.when(ok, F.last_day(F.make_date(F.substring(period, 1, 4).try_cast("int"), F.substring(period, 6, 1).try_cast("int") * 3, F.lit(1))))


def month_to_date(period: Column) -> Column:
    """``202401`` -> 2024-01-31; null for anything else."""
    ok = period.rlike("^[0-9]{4}(0[1-9]|1[0-2])$")
    return F.when(ok, F.last_day(F.make_date(F.substring(period, 1, 4).try_cast("int"), F.substring(period, 5, 2).try_cast("int"), F.lit(1))))


def date_to_month(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def date_to_quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def next_quarter_end(day: Column) -> Column:
    """The report period after the one ``day`` is in."""
    return F.last_day(F.add_months(F.trunc(day.cast("date"), "quarter"), 5))


def month_end_close(time: Column, zone: str = MARKET_ZONE) -> Column:
    """15:00 of the month's last day in the market's zone."""
    return stamp_close(F.last_day(time.cast("date")).cast("timestamp"), zone)


def effective_month(day: Column) -> Column:
    """End of the month after ``day``'s, when a month's figures are known."""
    return F.last_day(F.add_months(day.cast("date"), 1))


def is_trading_time(time: Column, market: str = "CN") -> Column:
    """Whether an instant is on a weekday and in a session of the market."""
    zone, sessions = SESSIONS[market]
    local = F.from_utc_timestamp(time, zone)
    minute = F.hour(local) * 60 + F.minute(local)
    inside = F.lit(False)
    for a, b in sessions:
        inside = inside | minute.between(a, b)
    return inside & (F.weekday(local) < 5)


def open_days(calendar: DataFrame, exchange: str = "exchange", day: str = "cal_date") -> DataFrame:
    """Every day of a calendar (exchange, cal_date, is_open) with the open days before and after it."""
    w = Window.partitionBy(exchange).orderBy(day)
    opened = F.when(F.col("is_open") == 1, F.col(day))
    before = F.last(opened, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(opened, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return calendar.withColumn("previous_open", before).withColumn("next_open", after)

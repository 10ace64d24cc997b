"""Registered queries over the derived market tables, each with SQL for the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import load, oracle
from ..functions import calendar as cal
from ..functions import industry, rules
from ..operators import adjust as adj
from ..operators import indicators as ind
from ..operators import joins, macro, resample, statements, summary, valuation
from ..operators.ranges import spread
from ..sources import schemas, tables
from ..streaming import ticks
from . import incremental, jobs, quality
from .hub import Hub
from .pipeline import Pipeline, calculate_indicators

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
OHLC = ("open", "high", "low", "close")


def query(sql: str, recursive: bool = False, prelude: str = ""):
    """Register a function of ``fx`` (name -> derived table) under its name, with the oracle's text."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: load(spark, sf_dir, name))
        ORACLES[f.__name__] = oracle(same_rounding(sql), recursive, same_rounding(prelude))
        return f

    return add


#: Where values round up.  Not at one half: prices over powers of ten lie exactly there, and engines sum and round such ties differently.
UP = 0.499


def rnd(value, digits: int = 6):
    """A column rounded by arithmetic that is the same in both engines."""
    x = F.col(value) if isinstance(value, str) else value
    return F.floor(x * 10.0**digits + (1 - UP)) / 10.0**digits


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in columns})


def same_rounding(sql: str) -> str:
    """``round(x, n)`` of an oracle's text written out as ``rnd`` does it."""
    out, at = "", 0
    for m in re.finditer(r"\bround\(", sql):
        if m.start() < at:
            continue
        depth, end, comma = 1, m.end(), None
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            comma = end if sql[end] == "," and depth == 1 else comma
            end += 1
        digits = int(sql[comma + 1 : end - 1])
        out += f"{sql[at : m.start()]}(floor(({same_rounding(sql[m.end() : comma])})::DOUBLE * {10.0**digits!r}::DOUBLE + {1 - UP!r}::DOUBLE) / {10.0**digits!r}::DOUBLE)"
        at = end
    return out + sql[at:]


def r(*columns: str, digits: int = 6) -> str:
    """The same in SQL."""
    return ", ".join(f"round({c}, {digits}) AS {c.split('.')[-1]}" for c in columns)


def sc(x: str) -> str:
    return f"round({x}, 6)"


def config(fx) -> DataFrame:
    c = fx("fx_config")
    return c.withColumn("exemptions", F.when(F.col("exemption").isNotNull(), F.array("exemption")).otherwise(F.array().cast("array<string>"))).drop("exemption")


def growth(fx) -> DataFrame:
    return fx("fx_growth").select("symbol", "ann_date", "netprofit_yoy")


# --- adjustment ---------------------------------------------------------------------------------------------


def _adjusted_sql(pick: str) -> str:
    return f"""SELECT symbol, time, {", ".join(f"round({c} * (adj_factor / base), 6) AS {c}" for c in OHLC)}, volume
FROM (SELECT *, {pick}(adj_factor, time) OVER (PARTITION BY symbol) AS base FROM fx_factored)"""


@query("SELECT symbol, time, round(close, 6) AS close, adj_factor FROM fx_factored")
def j1_bars_with_factor(fx):
    return rounded(joins.bars_with_factor(fx("fx_bars"), fx("fx_adj_factor")), "close").select("symbol", "time", "close", "adj_factor")


@query(_adjusted_sql("arg_max"))
def a1_adjust_forward(fx):
    return rounded(adj.adjust(fx("fx_factored"), "qfq"), *OHLC).select("symbol", "time", *OHLC, "volume")


@query(_adjusted_sql("arg_min"))
def a2_adjust_backward(fx):
    return rounded(adj.adjust(fx("fx_factored"), "hfq"), *OHLC).select("symbol", "time", *OHLC, "volume")


@query(f"SELECT symbol, time, {r(*OHLC)}, 'none' AS adjust_type FROM fx_factored")
def a3_adjust_none(fx):
    return rounded(adj.adjust(fx("fx_factored"), "none"), *OHLC).select("symbol", "time", *OHLC, "adjust_type")


@query(f"SELECT symbol, time, {r(*OHLC, digits=5)} FROM fx_factored")
def a4_reverse_adjust(fx):
    return rounded(adj.reverse_adjust(adj.adjust(fx("fx_factored"))), *OHLC, digits=5).select("symbol", "time", *OHLC)


# --- resampling and rollups -----------------------------------------------------------------------------------

_ENDS = {"W": "CAST(time AS DATE) + CAST((4 - (isodow(time) - 1) + 7) % 7 AS INT)", "M": "last_day(time)", "Q": "CAST(date_trunc('quarter', time) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)", "Y": "make_date(year(time), 12, 31)"}


def _resample_sql(freq: str) -> str:
    return f"""SELECT symbol, CAST({_ENDS[freq]} AS DATE) AS time, '{freq}' AS freq, round(arg_min(open, time), 6) AS open, round(max(high), 6) AS high, round(min(low), 6) AS low,
round(arg_max(close, time), 6) AS close, CAST(sum(volume) AS BIGINT) AS volume, round(sum(amount), 2) AS amount, arg_max(adj_factor, time) AS adj_factor FROM fx_factored GROUP BY 1, 2"""


@query(_resample_sql("W"))
def g1_resample_weekly(fx):
    out = resample.resample(fx("fx_factored"), "W").withColumn("freq", F.lit("W"))
    return rounded(rounded(out, *OHLC), "amount", digits=2)


@query(" UNION ALL ".join(_resample_sql(f) for f in "WMQY"))
def g2_resample_multi(fx):
    return rounded(rounded(resample.resample_multi(fx("fx_factored"), list("WMQY")), *OHLC), "amount", digits=2)


@query("SELECT symbol, last_day(time) AS time, round(avg(close), 6) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM fx_bars GROUP BY 1, 2")
def g3_custom_rules(fx):
    return rounded(resample.resample(fx("fx_bars"), "M", {"close": "mean", "volume": "sum", "absent": "max"}), "close")


def _rollup_sql(unit: str) -> str:
    ratio = "(arg_max(adj_factor, time) / arg_min(adj_factor, time))"
    return f"""SELECT symbol, CAST(date_trunc('{unit}', time) AS TIMESTAMP) AS time, round(arg_min(open, time) * {ratio}, 6) AS open, round(max(high) * {ratio}, 6) AS high, round(min(low) * {ratio}, 6) AS low,
round(arg_max(close, time), 6) AS close, CAST(sum(volume) AS BIGINT) AS volume, round(sum(amount), 2) AS amount, arg_max(adj_factor, time) AS adj_factor FROM fx_factored GROUP BY 1, 2"""


@query(_rollup_sql("week"))
def g4_rollup_weekly(fx):
    return rounded(rounded(resample.rollup_bars(fx("fx_factored"), "week"), *OHLC), "amount", digits=2)


@query(_rollup_sql("month"))
def g5_rollup_monthly(fx):
    return rounded(rounded(resample.rollup_bars(fx("fx_factored"), "month"), *OHLC), "amount", digits=2)


def _ratio_sql(unit: str) -> str:
    return f"SELECT symbol, CAST(date_trunc('{unit}', time) AS TIMESTAMP) AS time, {sc('avg(pe_ttm)')} AS avg_pe_ttm, {sc('avg(pb)')} AS avg_pb, {sc('arg_max(ps_ttm, time)')} AS ps_ttm, {sc('arg_max(dv_ttm, time)')} AS dv_ttm FROM fx_ratios GROUP BY 1, 2"


def _ratios(fx, unit: str) -> DataFrame:
    return rounded(resample.rollup_ratios(fx("fx_ratios"), unit, ["pe_ttm", "pb"], ["ps_ttm", "dv_ttm"]), "avg_pe_ttm", "avg_pb", "ps_ttm", "dv_ttm")


@query(_ratio_sql("week"))
def g6_ratio_rollup_weekly(fx):
    return _ratios(fx, "week")


@query(_ratio_sql("month"))
def g7_ratio_rollup_monthly(fx):
    return _ratios(fx, "month")


def _factor_sql(unit: str) -> str:
    return f"SELECT symbol, CAST(date_trunc('{unit}', time) AS TIMESTAMP) AS time, arg_max(adj_factor, time) AS adj_factor FROM fx_adj_factor GROUP BY 1, 2"


@query(_factor_sql("week"))
def g8_factor_rollup_weekly(fx):
    return resample.rollup_factor(fx("fx_adj_factor"), "week")


@query(_factor_sql("month"))
def g9_factor_rollup_monthly(fx):
    return resample.rollup_factor(fx("fx_adj_factor"), "month")


@query(_rollup_sql("month"))
def i9_refresh_range(fx):
    bars = fx("fx_factored")
    stored = resample.rollup_bars(bars, "month").where("time < '1997-01-01' OR symbol % 2 = 0").withColumn("close", F.when(F.col("time") >= "1997-01-01", 0.0).otherwise(F.col("close")))
    out = incremental.refresh(stored, bars, "month", start="1996-12-15")
    return rounded(rounded(out, *OHLC), "amount", digits=2)


# --- summaries --------------------------------------------------------------------------------------------------


@query("SELECT symbol, time, round(close, 6) AS close, volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time DESC) AS n FROM fx_bars) WHERE n = 1")
def g10_latest_per_key(fx):
    return rounded(summary.latest_row(fx("fx_bars"), ["symbol"]), "close").select("symbol", "time", "close", "volume")


@query("SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_keys, min(time) AS first_time, max(time) AS last_time FROM fx_bars")
def g11_table_stats(fx):
    return summary.table_stats(fx("fx_bars"))


@query("SELECT l2_name, count(*) AS members FROM fx_members GROUP BY 1")
def g12_member_count(fx):
    return summary.member_count(fx("fx_members"))


@query("SELECT 'bars' AS table_name, count(*) AS n_rows FROM fx_bars UNION ALL SELECT 'ticks', count(*) FROM fx_ticks")
def g15_row_counts(fx):
    return summary.approximate_counts({"bars": fx("fx_bars"), "ticks": fx("fx_ticks")}, {"bars": "symbol", "ticks": "symbol"}).select("table_name", "n_rows")


@query("SELECT 'bars' AS table_name, count(*) AS n_rows, max(time) AS latest FROM fx_bars UNION ALL SELECT 'ticks', count(*), max(time) FROM fx_ticks")
def d1_integrity_report(fx):
    return summary.integrity_report({"bars": fx("fx_bars"), "ticks": fx("fx_ticks")})


@query("SELECT symbol, time, volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time DESC) AS n FROM fx_bars) WHERE n <= 20")
def t1_last_n_per_key(fx):
    return summary.last_n(fx("fx_bars"), 20).select("symbol", "time", "volume")


# --- indicators -------------------------------------------------------------------------------------------------

_W = "OVER (PARTITION BY symbol ORDER BY time ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _w(n: int) -> str:
    return _W.format(n=n - 1)


def _scan_sql(name: str, source: str, value: str, alpha: float, span: int | None) -> str:
    """Recursive CTEs: y from a first value, or from the mean of the first ``span`` ones."""
    start = f"SELECT symbol, rn, {value} AS y FROM {name}_x WHERE rn = 1" if span is None else f"SELECT symbol, {span} AS rn, avg({value}) AS y FROM {name}_x WHERE rn <= {span} GROUP BY symbol HAVING count(*) = {span}"
    return (
        f"{name}_x AS MATERIALIZED (SELECT symbol, time, {value}, row_number() OVER (PARTITION BY symbol ORDER BY time) AS rn FROM {source} WHERE {value} IS NOT NULL), "
        f"{name}_y AS ({start} UNION ALL SELECT x.symbol, x.rn, p.y * (1 - {alpha!r}::DOUBLE) + {alpha!r}::DOUBLE * x.{value} FROM {name}_y p JOIN {name}_x x ON x.symbol = p.symbol AND x.rn = p.rn + 1), "
        f"{name} AS (SELECT x.symbol, x.time, y.y FROM {name}_x x LEFT JOIN {name}_y y ON x.symbol = y.symbol AND x.rn = y.rn)"
    )


@query(f"SELECT symbol, time, CASE WHEN count(close) {_w(20)} >= 20 THEN round(avg(close) {_w(20)}, 6) END AS ma_20, round(avg(close) {_w(5)}, 6) AS ma_5 FROM fx_bars")
def i_ma(fx):
    out = ind.MA(5, mode="simple").apply(ind.MA(20).apply(fx("fx_bars")))
    return rounded(out, "ma_20", "ma_5").select("symbol", "time", "ma_20", "ma_5")


@query("SELECT a.symbol, a.time, round(a.y, 6) AS ema_20, round(b.y, 6) AS ema_50 FROM e20 a JOIN e50 b ON a.symbol = b.symbol AND a.time = b.time", True, _scan_sql("e20", "fx_bars", "close", 2 / 21, None) + ", " + _scan_sql("e50", "fx_bars", "close", 2 / 51, 50))
def i_ema(fx):
    out = ind.apply_all(fx("fx_bars"), [ind.EMA(20, seed="first"), ind.EMA(50)])
    return rounded(out, "ema_20", "ema_50").select("symbol", "time", "ema_20", "ema_50")


@query(
    "SELECT m.symbol, m.time, round(m.macd, 6) AS macd, round(s.y, 6) AS macd_signal, round(2 * (m.macd - s.y), 6) AS macd_hist FROM m JOIN s9 s ON m.symbol = s.symbol AND m.time = s.time",
    True,
    _scan_sql("e12", "fx_bars", "close", 2 / 13, None) + ", " + _scan_sql("e26", "fx_bars", "close", 2 / 27, None) + ", m AS (SELECT e12.symbol, e12.time, e12.y - e26.y AS macd FROM e12 JOIN e26 ON e12.symbol = e26.symbol AND e12.time = e26.time), " + _scan_sql("s9", "m", "macd", 2 / 10, None),
)
def i_macd(fx):
    return rounded(ind.MACD().apply(fx("fx_bars")), "macd", "macd_signal", "macd_hist").select("symbol", "time", "macd", "macd_signal", "macd_hist")


_CHANGE = "d AS (SELECT symbol, time, greatest(c, 0) AS gain, greatest(-c, 0) AS loss FROM (SELECT symbol, time, close - lag(close) OVER (PARTITION BY symbol ORDER BY time) AS c FROM fx_bars) WHERE c IS NOT NULL)"


@query("SELECT b.symbol, b.time, round(CASE WHEN g.y + l.y = 0 THEN 0 ELSE 100 * g.y / (g.y + l.y) END, 6) AS rsi_14 FROM fx_bars b LEFT JOIN g ON b.symbol = g.symbol AND b.time = g.time LEFT JOIN l ON b.symbol = l.symbol AND b.time = l.time", True, _CHANGE + ", " + _scan_sql("g", "d", "gain", 1 / 14, 14) + ", " + _scan_sql("l", "d", "loss", 1 / 14, 14))
def i_rsi(fx):
    return rounded(ind.RSI(14).apply(fx("fx_bars")), "rsi_14").select("symbol", "time", "rsi_14")


@query(f"""SELECT b.symbol, b.time, CASE WHEN n >= 14 THEN round(CASE WHEN l = 0 THEN 0 ELSE 100 - 100 / (1 + g / l) END, 6) END AS rsi_14
FROM fx_bars b LEFT JOIN (SELECT symbol, time, avg(gain) {_w(14)} AS g, avg(loss) {_w(14)} AS l, count(*) {_w(14)} AS n FROM d) x ON b.symbol = x.symbol AND b.time = x.time""", False, _CHANGE)
def i_rsi_simple(fx):
    return rounded(ind.RSI(14, mode="simple").apply(fx("fx_bars")), "rsi_14").select("symbol", "time", "rsi_14")


_TR = "t AS (SELECT symbol, time, CASE WHEN pc IS NULL THEN NULL ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr, greatest(high - low, abs(high - coalesce(pc, close)), abs(low - coalesce(pc, close))) AS tr0 FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY time) AS pc FROM fx_bars))"


@query("SELECT symbol, time, round(tr0, 6) AS tr FROM t", False, _TR)
def i_tr(fx):
    return rounded(ind.TR().apply(fx("fx_bars")), "tr").select("symbol", "time", "tr")


@query("SELECT t.symbol, t.time, round(a.y, 6) AS atr_14 FROM t LEFT JOIN a ON t.symbol = a.symbol AND t.time = a.time", True, _TR + ", " + _scan_sql("a", "t", "tr", 1 / 14, 14))
def i_atr(fx):
    return rounded(ind.ATR(14).apply(fx("fx_bars")), "atr_14").select("symbol", "time", "atr_14")


@query(
    f"""SELECT symbol, time, CASE WHEN n >= 20 THEN v END AS nda_value, CASE WHEN n >= 20 THEN v >= 1 END AS volume_confirmed
FROM (SELECT symbol, time, n, CAST(list_sum(list_transform(list_sort(h)[1:5], lambda x: x.s)) AS INT) AS v
FROM (SELECT symbol, time, count(*) {_w(20)} AS n, array_agg({{'v': -volume, 't': time, 's': CASE WHEN close > open THEN 1 ELSE -1 END}}) {_w(20)} AS h FROM fx_bars))"""
)
def i_nda(fx):
    return ind.NDA().apply(fx("fx_bars")).select("symbol", "time", "nda_value", "volume_confirmed")


@query(f"SELECT symbol, time, CASE WHEN count(close) {_w(20)} >= 20 THEN round(avg(close) {_w(20)}, 6) END AS ma_20 FROM ({_adjusted_sql('arg_max').replace('round(close * (adj_factor / base), 6)', 'close * (adj_factor / base)')})")
def p1_fluent_pipeline(fx):
    out = Pipeline(fx("fx_factored")).adjust("qfq").indicators("ma_20", "no such indicator").run()
    return rounded(out, "ma_20").select("symbol", "time", "ma_20")


@query(f"SELECT symbol, time, {sc('greatest(high - low, abs(high - pc), abs(low - pc))')} AS tr FROM (SELECT *, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY time), close) AS pc FROM ({_adjusted_sql('arg_max').replace('round(', '(').replace(', 6) AS', ') AS')}))")
def p12_calculate_indicators(fx):
    return rounded(calculate_indicators(fx("fx_factored"), ["tr", "unknown"]), "tr").select("symbol", "time", "tr")


_WEEK = "w AS (SELECT symbol, CAST(" + _ENDS["W"] + " AS DATE) AS time, arg_max(close * (adj_factor / base), time) AS close FROM (SELECT *, arg_max(adj_factor, time) OVER (PARTITION BY symbol) AS base FROM fx_factored) GROUP BY 1, 2)"


@query(f"SELECT symbol, time, round(close, 6) AS close, CASE WHEN count(close) {_w(20)} >= 20 THEN round(avg(close) {_w(20)}, 6) END AS ma_20 FROM w", False, _WEEK)
def p2_technical_job(fx):
    out = jobs.technical_job(fx("fx_bars"), fx("fx_adj_factor"), ["ma_20"], ["weekly"])["weekly"]
    return rounded(out, "close", "ma_20").select("symbol", "time", "close", "ma_20")


# --- valuation --------------------------------------------------------------------------------------------------


def _pct_sql(metric: str, n: int) -> str:
    return f"CASE WHEN {metric} > 0 AND count({metric}) {_w(n)} >= 20 AND count(CASE WHEN {metric} > 0 THEN 1 END) {_w(n)} >= 2 THEN round(100.0 * len(list_filter(array_agg({metric}) {_w(n)}, lambda v: v > 0 AND v < {metric})) / count(CASE WHEN {metric} > 0 THEN 1 END) {_w(n)}, 6) END"


@query(f"SELECT symbol, time, {_pct_sql('pe_ttm', 250)} AS pe_ttm_pct_250d, {_pct_sql('ps_ttm', 250)} AS ps_ttm_pct_250d FROM fx_ratios")
def v1_rolling_percentile(fx):
    out = valuation.rolling_percentile(fx("fx_ratios"), ["pe_ttm", "ps_ttm"], [250])
    return rounded(out, "pe_ttm_pct_250d", "ps_ttm_pct_250d").select("symbol", "time", "pe_ttm_pct_250d", "ps_ttm_pct_250d")


@query(
    """SELECT symbol, max(time) AS time, round(max(now), 6) AS current, round(CASE WHEN max(now) > 0 AND count(CASE WHEN ps_ttm > 0 THEN 1 END) >= 2 THEN 100.0 * count(CASE WHEN ps_ttm > 0 AND ps_ttm < now THEN 1 END) / count(CASE WHEN ps_ttm > 0 THEN 1 END) END, 6) AS percentile
FROM (SELECT *, max(CASE WHEN n = 1 THEN ps_ttm END) OVER (PARTITION BY symbol) AS now FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time DESC) AS n FROM fx_ratios) WHERE n <= 250) GROUP BY symbol HAVING count(*) >= 250"""
)
def v2_current_percentile(fx):
    return rounded(valuation.current_percentile(fx("fx_ratios"), "ps_ttm", 250), "current", "percentile")


_CROSS = """CASE WHEN {v} IS NOT NULL AND l2_name IS NOT NULL AND count({v}) OVER (PARTITION BY time, l2_name) >= 3 THEN round((rank() OVER (PARTITION BY time, l2_name, {v} IS NULL ORDER BY {v}) + (count(*) OVER (PARTITION BY time, l2_name, {v}) - 1) / 2.0) / count({v}) OVER (PARTITION BY time, l2_name) * 100, 6) END"""


@query(f"SELECT symbol, time, l2_name, {_CROSS.format(v='pb')} AS pb_industry_pct FROM (SELECT q.symbol, q.time, m.l2_name, round(q.pb, 1) AS pb FROM fx_ratios q LEFT JOIN fx_members m ON q.symbol = m.ts_code AND m.ts_code % 7 <> 3)")
def v3_cross_section_pct(fx):
    rows = joins.with_membership(fx("fx_ratios"), fx("fx_members").where("ts_code % 7 <> 3")).withColumn("pb", rnd("pb", 1))
    out = spread(rows, ["time", "l2_name"]).withColumn("pb_industry_pct", valuation.cross_section_percentile("pb"))
    return rounded(out, "pb_industry_pct").select("symbol", "time", "l2_name", "pb_industry_pct")


_PEG = "p AS (SELECT q.*, CASE WHEN q.pe_ttm > 0 AND g.netprofit_yoy > 0 THEN q.pe_ttm / g.netprofit_yoy END AS peg, g.netprofit_yoy FROM fx_ratios q ASOF LEFT JOIN fx_growth g ON q.symbol = g.symbol AND q.time >= g.ann_date)"


@query("SELECT symbol, time, round(peg, 6) AS peg FROM p", False, _PEG)
def j2_asof_peg(fx):
    return rounded(valuation.with_peg(fx("fx_ratios"), growth(fx)), "peg").select("symbol", "time", "peg")


@query("SELECT q.symbol, q.time, g.end_date AS period, round(g.netprofit_yoy, 6) AS netprofit_yoy FROM fx_ratios q ASOF LEFT JOIN fx_growth g ON q.symbol = g.symbol AND q.time >= g.ann_date")
def j3_asof_struct(fx):
    right = fx("fx_growth").withColumnRenamed("end_date", "period")
    out = joins.asof_join(fx("fx_ratios").select("symbol", "time"), right, "time", "ann_date", ["symbol"], tie=["period"])
    return rounded(out, "netprofit_yoy").select("symbol", "time", "period", "netprofit_yoy")


@query(f"SELECT symbol, time, round(peg, 6) AS peg, {_pct_sql('pe_ttm', 120)} AS pe_ttm_pct_120d FROM p", False, _PEG)
def p3_valuation_job(fx):
    out = jobs.valuation_job(fx("fx_ratios"), growth(fx), window=120)
    return rounded(out, "peg", "pe_ttm_pct_120d").select("symbol", "time", "peg", "pe_ttm_pct_120d")


_VALUED = (
    _PEG
    + ", mm AS (SELECT * FROM fx_members WHERE ts_code % 7 <> 3), k AS (SELECT p.*, m.l1_name, m.l2_name, m.l3_name, coalesce(c.core_indicator, 'PE') AS ct, coalesce(c.ref_indicator, 'PB') AS rt FROM p LEFT JOIN mm m ON p.symbol = m.ts_code LEFT JOIN fx_config c ON m.l3_name = c.l3_name)"
    + ", v AS (SELECT *, CASE ct WHEN 'PE' THEN CASE WHEN pe_ttm > 0 THEN pe_ttm END WHEN 'PB' THEN CASE WHEN pb > 0 THEN pb END WHEN 'PS' THEN CASE WHEN ps_ttm > 0 THEN ps_ttm END ELSE peg END AS cv, CASE rt WHEN 'PB' THEN CASE WHEN pb > 0 THEN pb END WHEN 'PS' THEN CASE WHEN ps_ttm > 0 THEN ps_ttm END END AS rv FROM k)"
    + ", iv AS (SELECT symbol, time, l1_name, l2_name, l3_name, ct AS core_indicator_type, " + sc("cv") + " AS core_indicator_value, "
    + _CROSS.format(v="cv")
    + " AS core_indicator_industry_pct, rt AS ref_indicator_type, " + sc("rv") + " AS ref_indicator_value, "
    + _CROSS.format(v="rv")
    + " AS ref_indicator_industry_pct, l3_name IS NULL OR cv IS NULL AS is_exempted, CASE WHEN l3_name IS NULL THEN 'NO_INDUSTRY_CLASSIFICATION' WHEN cv IS NULL THEN 'INVALID_CORE_INDICATOR' END AS exemption_reason FROM v)"
)


def _valued(fx) -> DataFrame:
    rows = valuation.with_peg(fx("fx_ratios"), growth(fx))
    out = valuation.industry_valuation(rows, fx("fx_members").where("ts_code % 7 <> 3"), config(fx))
    out = out.drop("core_indicator_pct_1250d", "ref_indicator_pct_1250d", "fscore_exemptions")
    return rounded(out, "core_indicator_value", "core_indicator_industry_pct", "ref_indicator_value", "ref_indicator_industry_pct")


@query("SELECT * FROM iv", False, _VALUED)
def p6_industry_valuation(fx):
    return _valued(fx)


@query("SELECT count(*) AS total, count(DISTINCT symbol) AS symbols, count(DISTINCT time) AS dates, CAST(sum(CASE WHEN is_exempted THEN 1 ELSE 0 END) AS BIGINT) AS exempted, round(avg(CASE WHEN is_exempted THEN 1 ELSE 0 END), 6) AS exempt_rate FROM iv", False, _VALUED)
def g13_industry_summary(fx):
    return rounded(summary.industry_summary(_valued(fx))[0], "exempt_rate")


@query("SELECT l2_name, count(DISTINCT symbol) AS symbols, CAST(sum(CASE WHEN is_exempted THEN 1 ELSE 0 END) AS BIGINT) AS exempted FROM iv GROUP BY 1", False, _VALUED)
def g13_by_industry(fx):
    return summary.industry_summary(_valued(fx))[1]


@query("SELECT exemption_reason, count(*) AS n FROM iv WHERE is_exempted GROUP BY 1", False, _VALUED)
def g14_exemption_counts(fx):
    return summary.exemption_counts(_valued(fx))


@query("SELECT symbol, time, l2_name, core_indicator_type, core_indicator_value FROM iv WHERE l2_name IN ('FRANCE', 'CHINA') AND NOT is_exempted AND time >= '1996-01-01' AND time < '1998-01-01'", False, _VALUED)
def q33_industry_valuation(fx):
    hub = Hub({"industry_valuation": _valued(fx)})
    return hub.get_industry_valuation(None, "1996-01-01", "1997-12-31", ["FRANCE", "CHINA"], include_exempted=False).select("symbol", "time", "l2_name", "core_indicator_type", "core_indicator_value")


# --- statements -------------------------------------------------------------------------------------------------

_TTM = "CASE WHEN s.q = 4 THEN s.{c} ELSE s.{c} + w.{c} - a.{c} END"
_TTM_JOIN = "fx_statements s LEFT JOIN fx_statements a ON a.ts_code = s.ts_code AND a.y = s.y - 1 AND a.q = s.q LEFT JOIN fx_statements w ON w.ts_code = s.ts_code AND w.y = s.y - 1 AND w.q = 4"
_Q = "OVER (PARTITION BY ts_code ORDER BY end_date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _q(n: int) -> str:
    return _Q.format(n=n - 1)


@query(f"SELECT s.ts_code, s.end_date, round({_TTM.format(c='roa')}, 6) AS roa_ttm, round({_TTM.format(c='n_income')}, 2) AS ni_ttm FROM {_TTM_JOIN}")
def f1_cumulative_to_ttm(fx):
    return fx("fx_statements").select("ts_code", "end_date", rnd(statements.ttm_from_cumulative("roa"), 6).alias("roa_ttm"), rnd(statements.ttm_from_cumulative("n_income"), 2).alias("ni_ttm"))


@query(f"SELECT ts_code, end_date, CASE WHEN count(q_gsprofit_margin) {_q(4)} = 4 THEN round(avg(q_gsprofit_margin) {_q(4)}, 6) END AS mean4, CASE WHEN count(q_gsprofit_margin) {_q(4)} = 4 THEN round(sum(q_gsprofit_margin) {_q(4)}, 6) END AS sum4 FROM fx_statements")
def f2_quarterly_ttm(fx):
    return fx("fx_statements").select("ts_code", "end_date", rnd(statements.ttm_from_quarterly("q_gsprofit_margin"), 6).alias("mean4"), rnd(statements.ttm_from_quarterly("q_gsprofit_margin", "sum"), 6).alias("sum4"))


@query("SELECT ts_code, end_date, CAST(coalesce(roa > lag(roa, 4) OVER w, false) AS INT) AS better, CAST(coalesce(total_share <= lag(total_share, 4) OVER w, false) AS INT) AS no_more_shares FROM fx_statements WINDOW w AS (PARTITION BY ts_code ORDER BY end_date)")
def f3_yoy_improvement(fx):
    return fx("fx_statements").select("ts_code", "end_date", statements.yoy_improved("roa").alias("better"), statements.yoy_improved("total_share", True, True).alias("no_more_shares"))


@query(f"SELECT ts_code, end_date, CASE WHEN count(q_gsprofit_margin) {_q(20)} >= 4 THEN round(sum(q_gsprofit_margin) {_q(20)} / 5, 6) END AS roe_5y_avg FROM fx_statements")
def f4_roe_5y_avg(fx):
    out = statements.with_roe_5y_avg(fx("fx_statements").withColumnRenamed("q_gsprofit_margin", "q_roe"))
    return rounded(out, "roe_5y_avg").select("ts_code", "end_date", "roe_5y_avg")


@query(f"SELECT ts_code, end_date, CASE WHEN count(roa) {_q(12)} >= 4 THEN round(stddev_samp(roa) {_q(12)}, 6) END AS roa_std FROM fx_statements")
def f5_rolling_std(fx):
    return fx("fx_statements").select("ts_code", "end_date", rnd(statements.rolling_std("roa"), 6).alias("roa_std"))


@query(f"SELECT ts_code, end_date, CASE WHEN count(n_income) {_q(12)} >= 3 THEN round(corr(n_income, n_cashflow_act) {_q(12)}, 5) END AS ni_cfo_corr FROM fx_statements")
def f6_rolling_corr(fx):
    return fx("fx_statements").select("ts_code", "end_date", rnd(statements.rolling_corr("n_income", "n_cashflow_act"), 5).alias("ni_cfo_corr"))


@query("SELECT ts_code, end_date, round(roa - lag(roa, 12) OVER (PARTITION BY ts_code ORDER BY end_date), 6) AS roa_diff FROM fx_statements")
def f7_diff_n(fx):
    return fx("fx_statements").select("ts_code", "end_date", rnd(statements.diff_n("roa"), 6).alias("roa_diff"))


_SCORE = (
    f"t AS (SELECT s.*, {_TTM.format(c='roa')} AS roa_ttm, {_TTM.format(c='n_cashflow_act')} AS cfo_ttm, {_TTM.format(c='n_income')} AS ni_ttm FROM {_TTM_JOIN}), "
    f"u AS (SELECT *, CASE WHEN count(*) {_q(4)} = 4 THEN avg(q_gsprofit_margin) {_q(4)} END AS gpm_ttm, CASE WHEN count(*) {_q(4)} = 4 THEN avg(q_netprofit_margin) {_q(4)} END AS npm_ttm, total_ncl / nullif(total_assets, 0) AS lever FROM t), "
    "f AS (SELECT *, CAST(coalesce(roa_ttm > 0, false) AS INT) AS f_roa, CAST(coalesce(cfo_ttm > 0, false) AS INT) AS f_cfo, CAST(coalesce(roa_ttm > lag(roa_ttm, 4) OVER w, false) AS INT) AS f_delta_roa, CAST(coalesce(cfo_ttm > ni_ttm, false) AS INT) AS f_accrual, "
    "CAST(coalesce(lever < lag(lever, 4) OVER w, false) AS INT) AS f_delta_lever, 0 AS f_delta_liquid, CAST(coalesce(total_share <= lag(total_share, 4) OVER w, false) AS INT) AS f_eq_offer, "
    "CASE WHEN ts_code % 3 = 0 THEN 1 ELSE CAST(coalesce(gpm_ttm > lag(gpm_ttm, 4) OVER w, false) AS INT) END AS f_delta_margin, 0 AS f_delta_turn FROM u WINDOW w AS (PARTITION BY ts_code ORDER BY end_date)), "
    f"g AS (SELECT *, f_roa + f_cfo + f_delta_roa + f_accrual + f_delta_lever + f_delta_liquid + f_eq_offer + f_delta_margin + f_delta_turn AS f_score, total_liab / nullif(total_assets, 0) * 100 AS debt_ratio, "
    f"CASE WHEN count(npm_ttm) {_q(12)} >= 4 THEN stddev_samp(npm_ttm) {_q(12)} END AS npm_std, CASE WHEN ni_ttm > 0 THEN cfo_ttm / ni_ttm END AS cfo_to_ni_ttm FROM f)"
)


def _scores(fx) -> DataFrame:
    s = fx("fx_statements")
    exemptions = s.select("ts_code").distinct().where("ts_code % 3 = 0").withColumn("exemptions", F.array(F.lit("f_score_gross_margin")))
    return statements.fscore(s.select("ts_code", "end_date", "roa", "q_gsprofit_margin", "q_netprofit_margin"), s.select("ts_code", "end_date", "total_assets", "total_ncl", "total_liab", "total_share"), s.select("ts_code", "end_date", "n_cashflow_act"), s.select("ts_code", "end_date", "n_income"), exemptions)


_FLAGS = ", ".join(statements.FLAGS)


@query(
    f"SELECT ts_code, end_date, {_FLAGS}, f_score, {r('roa_ttm', 'debt_ratio', 'gpm_ttm', 'cfo_to_ni_ttm')}, CASE WHEN npm_ttm IS NOT NULL AND npm_std IS NOT NULL THEN CAST(npm_ttm > 0 AND npm_std <= 3 AS INT) END AS buffett_npm_stable_flag, CASE WHEN roa_ttm IS NOT NULL THEN CAST(roa_ttm >= 15 AS INT) END AS buffett_roa_flag, CASE WHEN cfo_to_ni_ttm IS NOT NULL THEN CAST(cfo_ttm > 0 AND ni_ttm > 0 AND cfo_to_ni_ttm >= 1 AS INT) END AS buffett_cashflow_flag FROM g",
    False,
    _SCORE,
)
def p4_fscore(fx):
    out = rounded(_scores(fx), "roa_ttm", "debt_ratio", "gpm_ttm", "cfo_to_ni_ttm")
    return out.select("ts_code", "end_date", *statements.FLAGS, "f_score", "roa_ttm", "debt_ratio", "gpm_ttm", "cfo_to_ni_ttm", "buffett_npm_stable_flag", "buffett_roa_flag", "buffett_cashflow_flag")


@query("SELECT ts_code, end_date, f_score AS total, CASE WHEN f_score >= 8 THEN 'excellent' WHEN f_score >= 5 THEN 'good' WHEN f_score >= 3 THEN 'fair' ELSE 'poor' END AS level, f_roa = 1 AS roa, f_delta_margin = 1 AS delta_margin FROM g", False, _SCORE)
def e12_score_breakdown(fx):
    return _scores(fx).select("ts_code", "end_date", rules.score_breakdown().alias("b")).select("ts_code", "end_date", "b.total", "b.level", "b.profitability.roa", "b.efficiency.delta_margin")


@query("SELECT ts_code, end_date, total_assets, total_ncl, n_cashflow_act, n_income, round(roa, 6) AS roa FROM fx_statements")
def j6_statement_joins(fx):
    s = fx("fx_statements")
    out = joins.merge_statements(s.select("ts_code", "end_date", "roa"), s.select("ts_code", "end_date", "total_assets", "total_ncl", "roa"), s.select("ts_code", "end_date", "n_cashflow_act"), s.select("ts_code", "end_date", "n_income"))
    return rounded(out, "roa").select("ts_code", "end_date", "total_assets", "total_ncl", "n_cashflow_act", "n_income", "roa")


@query("SELECT ts_code, end_date, CASE WHEN q = 1 THEN end_date + 20 WHEN q = 2 THEN end_date + 25 WHEN q = 3 AND ts_code % 2 = 0 THEN end_date + 40 ELSE end_date END AS f_ann_date FROM fx_statements")
def j15_backfill_dates(fx):
    s = fx("fx_statements")
    own = s.select("ts_code", "end_date", F.when(F.col("q") == 1, F.date_add("end_date", 20)).alias("f_ann_date"), F.when((F.col("q") == 3) & (F.col("ts_code") % 2 == 0), F.date_add("end_date", 40)).alias("ann_date"))
    late = s.select("ts_code", "end_date", F.when(F.col("q") == 2, F.date_add("end_date", 25)).alias("f_ann_date"))
    empty = s.select("ts_code", "end_date", F.lit(None).cast("date").alias("f_ann_date"))
    return joins.backfill_announcement(own, empty, late, empty).select("ts_code", "end_date", "f_ann_date")


# --- macro --------------------------------------------------------------------------------------------------------

_PHASE = (
    "m AS (SELECT last_day(month_start) AS o, m2_yoy, ppi_yoy, pmi FROM fx_macro_month), j AS (SELECT m.*, g.gdp_yoy, m.m2_yoy - g.gdp_yoy AS ci FROM m ASOF JOIN fx_gdp g ON m.o >= g.time), "
    "h AS (SELECT *, CASE WHEN ci > 0 THEN CASE WHEN ppi_yoy < 0 AND pmi < 52 THEN 'REFLATION' ELSE 'RECOVERY' END WHEN ppi_yoy > 2 THEN CASE WHEN pmi > 50 THEN 'OVERHEAT' ELSE 'STAGFLATION' END WHEN pmi < 50 THEN 'STAGFLATION' ELSE 'RECOVERY' END AS raw_phase, row_number() OVER (ORDER BY o) AS rn FROM j), "
    "z AS (SELECT rn, raw_phase AS raw, raw_phase AS stable FROM h WHERE rn = 1 UNION ALL SELECT h.rn, h.raw_phase, CASE WHEN h.raw_phase = z.stable THEN z.stable WHEN h.raw_phase = z.raw THEN h.raw_phase ELSE z.stable END FROM z JOIN h ON h.rn = z.rn + 1), "
    "ph AS (SELECT last_day(h.o + INTERVAL 1 DAY) AS time, h.o AS observation_time, ci AS credit_impulse, raw_phase, z.stable AS stable_phase, coalesce(raw_phase <> lag(raw_phase) OVER (ORDER BY h.o), false) AS raw_phase_changed, coalesce(z.stable <> lag(z.stable) OVER (ORDER BY h.o), false) AS stable_phase_changed FROM h JOIN z ON h.rn = z.rn)"
)


def _phases(fx) -> DataFrame:
    m = fx("fx_macro_month").withColumnRenamed("month_start", "time")
    pmi = m.select("time", F.lit(None).cast("double").alias("pmi010000"), F.col("pmi").alias("pmi030000"))
    return macro.macro_cycle(m.select("time", "m2_yoy"), m.select("time", "ppi_yoy"), pmi, fx("fx_gdp"))


@query("SELECT * FROM ph", True, _PHASE)
def p8_macro_cycle(fx):
    return _phases(fx).select("time", "observation_time", "credit_impulse", "raw_phase", "stable_phase", "raw_phase_changed", "stable_phase_changed")


_SNAP = _PHASE + ", im AS (SELECT l3_name, min(l2_name) AS l2_name, min(l1_name) AS l1_name FROM fx_members GROUP BY 1), sn AS (SELECT ph.time, c.l3_name, im.l2_name, c.macro_cycle AS config_macro_cycle, im.l3_name IS NOT NULL AS is_present_in_members, c.macro_cycle = raw_phase AS matches_raw_phase, c.macro_cycle = stable_phase AS matches_stable_phase FROM ph CROSS JOIN fx_config c LEFT JOIN im ON im.l3_name = c.l3_name)"


@query("SELECT * FROM sn", True, _SNAP)
def p9_industry_snapshot(fx):
    return macro.industry_snapshot(_phases(fx), config(fx), fx("fx_members")).select("time", "l3_name", "l2_name", "config_macro_cycle", "is_present_in_members", "matches_raw_phase", "matches_stable_phase")


@query("SELECT time, raw_phase AS phase, CASE raw_phase WHEN 'REFLATION' THEN 0 WHEN 'RECOVERY' THEN 1 WHEN 'OVERHEAT' THEN 2 ELSE 3 END AS phase_y FROM ph WHERE time >= '1996-01-01'", True, _PHASE)
def q34_macro_cycle(fx):
    return Hub({"macro_cycle": _phases(fx)}).get_macro_cycle("1996-01-01", phase="raw").select("time", "phase", "phase_y")


@query("SELECT time, l3_name, matches_stable_phase AS is_preferred FROM sn WHERE matches_stable_phase AND time >= '1997-01-01'", True, _SNAP)
def q35_macro_cycle_industries(fx):
    snapshot = macro.industry_snapshot(_phases(fx), config(fx), fx("fx_members"))
    return Hub({"macro_cycle_industries": snapshot}).get_macro_cycle_industries("1997-01-01", preferred_only=True).select("time", "l3_name", "is_preferred")


@query("SELECT DISTINCT m.l3_name FROM fx_members m WHERE m.l3_name NOT IN (SELECT l3_name FROM fx_config) ORDER BY 1 LIMIT 20")
def j13_config_coverage(fx):
    return industry.missing_from_config(fx("fx_members"), config(fx))


@query("SELECT l3_name, macro_cycle, core_indicator, ref_indicator, CASE WHEN exemption IS NULL THEN '[]' ELSE concat('[\"', exemption, '\"]') END AS exemptions FROM fx_config")
def e14_industry_config(fx):
    return industry.with_defaults(config(fx)).select("l3_name", "macro_cycle", "core_indicator", "ref_indicator", rules.list_to_json(F.col("exemptions")).alias("exemptions"))


# --- joins and sets -----------------------------------------------------------------------------------------------


@query("SELECT symbol, count(*) AS n FROM fx_bars WHERE symbol IN (SELECT ts_code FROM fx_members WHERE l1_name = 'ASIA') GROUP BY 1")
def j11_semi_filter(fx):
    keys = fx("fx_members").where("l1_name = 'ASIA'").select(F.col("ts_code").alias("symbol"))
    return joins.semi_filter(fx("fx_bars"), keys, ["symbol"]).groupBy("symbol").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT symbol FROM fx_bars WHERE symbol NOT IN (SELECT symbol FROM fx_adj_factor)")
def j12_anti_missing(fx):
    return joins.anti_missing(fx("fx_bars").select("symbol").distinct(), fx("fx_adj_factor").select("symbol").distinct(), ["symbol"])


@query("SELECT m.ts_code, m.l3_name, coalesce(c.core_indicator, 'PE') AS core_indicator FROM fx_members m LEFT JOIN fx_config c ON m.l3_name = c.l3_name")
def j14_map_lookup(fx):
    return joins.lookup(fx("fx_members").select("ts_code", "l3_name"), "l3_name", config(fx), "l3_name", "core_indicator", "PE")


@query(
    "SELECT count(*) AS n_rows, CAST(sum(CASE WHEN abs(b.close - a.close) / a.close <= 1e-4 THEN 0 ELSE 1 END) AS BIGINT) AS n_failed FROM (SELECT symbol, date_trunc('month', time) AS time, arg_max(close, time) AS close FROM fx_bars GROUP BY 1, 2) a JOIN (SELECT symbol, date_trunc('month', time) AS time, arg_max(close, time) * CASE WHEN symbol % 10 = 3 THEN 1.01 ELSE 1 END AS close FROM fx_bars GROUP BY 1, 2) b ON a.symbol = b.symbol AND a.time = b.time"
)
def d3_validate_rollup(fx):
    bars = fx("fx_factored")
    stored = resample.rollup_bars(bars, "month").withColumn("close", F.col("close") * F.when(F.col("symbol") % 10 == 3, 1.01).otherwise(1.0))
    return quality.validate_rollup(bars, stored, "month")[0].select("n_rows", "n_failed")


# --- keyed storage ------------------------------------------------------------------------------------------------

_NEW = "nw AS (SELECT symbol, time, close * 2 AS close FROM fx_bars WHERE symbol % 4 = 1 UNION ALL SELECT symbol + 100000, time, close FROM fx_bars WHERE symbol % 9 = 2)"


def _base_and_new(fx):
    b = fx("fx_bars").select("symbol", "time", "close")
    return b, b.where("symbol % 4 = 1").withColumn("close", F.col("close") * 2).unionByName(b.where("symbol % 9 = 2").withColumn("symbol", F.col("symbol") + 100000))


@query("SELECT coalesce(n.symbol, b.symbol) AS symbol, coalesce(n.time, b.time) AS time, round(coalesce(n.close, b.close), 6) AS close FROM fx_bars b FULL JOIN nw n ON b.symbol = n.symbol AND b.time = n.time", False, _NEW)
def k1_upsert_by_key(fx):
    return rounded(tables.upsert(*_base_and_new(fx), ["symbol", "time"]), "close")


@query("SELECT coalesce(b.symbol, n.symbol) AS symbol, coalesce(b.time, n.time) AS time, round(coalesce(b.close, n.close), 6) AS close FROM fx_bars b FULL JOIN nw n ON b.symbol = n.symbol AND b.time = n.time", False, _NEW)
def k2_insert_keep_first(fx):
    return rounded(tables.upsert(*_base_and_new(fx), ["symbol", "time"], keep="first"), "close")


@query("SELECT symbol, CAST(date_trunc('day', time) AS TIMESTAMP) + INTERVAL 7 HOUR AS time, round(close, 6) AS close FROM fx_bars WHERE symbol % 6 <> 0")
def k3_processed_rows(fx):
    bars = fx("fx_bars").withColumn("close", F.when(F.col("symbol") % 6 != 0, F.col("close")))
    return rounded(tables.processed_rows(bars, ["symbol", "time", *OHLC, "volume", "not there"]), "close").select("symbol", "time", "close")


@query("SELECT symbol, time, volume FROM fx_bars WHERE time >= '1997-06-01'")
def k6_retention(fx):
    return tables.retain(fx("fx_bars"), "1997-06-01").select("symbol", "time", "volume")


@query("SELECT symbol, time, max(side) AS side FROM (SELECT symbol, CAST(date_trunc('day', time) AS TIMESTAMP) AS time, side FROM fx_ticks) GROUP BY 1, 2")
def s4_dedupe_on_key(fx):
    rows = fx("fx_ticks").select("symbol", F.date_trunc("day", "time").alias("time"), "side")
    return schemas.dedupe_on_key(rows, ["symbol", "time"])


@query("SELECT CAST(symbol AS VARCHAR) AS symbol, time, round(close, 6) AS close, volume FROM fx_bars WHERE symbol % 5 <> 0")
def s2_conform_schema(fx):
    raw = fx("fx_bars").select(F.when(F.col("symbol") % 5 != 0, F.col("symbol")).alias("ts_code"), F.date_format("time", "yyyyMMdd").alias("trade_date"), F.col("close").cast("string").alias("close"), F.col("volume").alias("vol"))
    d = schemas.DATASETS["daily"]
    return rounded(schemas.conform(schemas.rename_columns(raw, d.rename), d)[0], "close").select("symbol", "time", "close", "volume")


@query("SELECT CAST(symbol AS VARCHAR) AS symbol, time + INTERVAL 8 HOUR AS time, round(close, 6) AS close, CAST(volume AS DOUBLE) AS volume FROM fx_bars")
def s5_flatten_nested_bars(fx):
    one = F.map_from_arrays(F.array(F.unix_millis(F.col("time").cast("timestamp")).cast("string")), F.array("close"))
    two = F.map_from_arrays(F.array(F.unix_millis(F.col("time").cast("timestamp")).cast("string")), F.array(F.col("volume").cast("double")))
    payload = F.to_json(F.map_from_arrays(F.array(F.col("symbol").cast("string")), F.array(F.map_from_arrays(F.array(F.lit("close"), F.lit("volume")), F.array(one, two)))))
    return rounded(schemas.flatten_nested(fx("fx_bars").select(payload.alias("payload")), "payload"), "close").select("symbol", "time", "close", "volume")


@query("SELECT symbol, time, round(close - pc, 6) AS change_amount, round((close - pc) / pc * 100, 6) AS change_pct FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY time) AS pc FROM fx_bars)")
def s6_derive_change(fx):
    bars = fx("fx_bars").withColumn("preclose", F.lag("close").over(ind.by_symbol()))
    return rounded(schemas.derive_change(bars), "change_amount", "change_pct").select("symbol", "time", "change_amount", "change_pct")


@query("SELECT DISTINCT s_suppkey AS id, concat(lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), '.SH') AS symbol FROM {supplier}")
def s7_standardize_symbol(fx):
    return fx("supplier").select(F.col("s_suppkey").alias("id"), schemas.standardize_symbol(F.concat(F.lit(" sh."), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"))).alias("symbol")).distinct()


@query("SELECT symbol, time, volume, NULL::DOUBLE AS close, '1d' AS frequency FROM fx_bars WHERE symbol % 2 = 0 UNION ALL SELECT symbol, time, NULL, round(close, 6), '1d' FROM fx_bars WHERE symbol % 2 = 1")
def s8_concat_pages(fx):
    b = fx("fx_bars")
    out = schemas.concat_pages([b.where("symbol % 2 = 0").select("symbol", "time", "volume"), b.where("symbol % 2 = 1").select("symbol", "time", "close")])
    return rounded(schemas.tag_frequency(out, "1d"), "close").select("symbol", "time", "volume", "close", "frequency")


# --- scalar rules ---------------------------------------------------------------------------------------------------

_DAYS = "(SELECT DISTINCT CAST(time AS DATE) AS d FROM fx_bars)"


@query(
    f"""SELECT d, CAST(d + CAST((4 - (isodow(d) - 1) + 7) % 7 AS INT) AS DATE) AS week_end, last_day(d) AS month_end, CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end, make_date(year(d), 12, 31) AS year_end,
CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(date_trunc('month', d) AS DATE) AS month_start, strftime(d, '%Y%m') AS month, concat(CAST(year(d) AS VARCHAR), 'Q', CAST(quarter(d) AS VARCHAR)) AS quarter,
CAST(date_trunc('quarter', d) + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE) AS next_quarter_end, CAST(date_trunc('month', d) + INTERVAL 2 MONTH - INTERVAL 1 DAY AS DATE) AS effective_month,
CAST(d AS TIMESTAMP) + INTERVAL 7 HOUR AS close_at, CAST(last_day(d) AS TIMESTAMP) + INTERVAL 7 HOUR AS month_close_at FROM {_DAYS}"""
)
def t2_t9_calendar(fx):
    d = F.col("d")
    return fx("fx_bars").select(F.col("time").cast("date").alias("d")).distinct().select(
        "d", cal.period_end(d, "W").alias("week_end"), cal.period_end(d, "M").alias("month_end"), cal.period_end(d, "Q").alias("quarter_end"), cal.period_end(d, "Y").alias("year_end"),
        cal.period_start(d, "W").alias("week_start"), cal.period_start(d, "M").alias("month_start"), cal.date_to_month(d).alias("month"), cal.date_to_quarter(d).alias("quarter"),
        cal.next_quarter_end(d).alias("next_quarter_end"), cal.effective_month(d).alias("effective_month"), cal.stamp_close(d.cast("timestamp")).alias("close_at"), cal.month_end_close(d.cast("timestamp")).alias("month_close_at"),
    )


@query(f"SELECT d, CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end, last_day(d) AS month_end, CAST(NULL AS DATE) AS no_period FROM {_DAYS}")
def t5_parse_periods(fx):
    d = F.col("d")
    days = fx("fx_bars").select(F.col("time").cast("date").alias("d")).distinct()
    return days.select("d", cal.quarter_to_date(cal.date_to_quarter(d)).alias("quarter_end"), cal.month_to_date(cal.date_to_month(d)).alias("month_end"), cal.quarter_to_date(F.lit("2024Q7")).alias("no_period"))


@query("SELECT event_id, isodow(l) <= 5 AND (m BETWEEN 570 AND 690 OR m BETWEEN 780 AND 900) AS trading FROM (SELECT event_id, time + INTERVAL 8 HOUR AS l, hour(time + INTERVAL 8 HOUR) * 60 + minute(time + INTERVAL 8 HOUR) AS m FROM fx_ticks)")
def t10_is_trading_time(fx):
    return fx("fx_ticks").select("event_id", cal.is_trading_time(F.col("time")).alias("trading"))


_CAL = "cl AS (SELECT 'SSE' AS exchange, d AS cal_date, CASE WHEN isodow(d) <= 5 AND day(d) % 10 <> 3 THEN 1 ELSE 0 END AS is_open FROM (SELECT DISTINCT CAST(time AS DATE) AS d FROM fx_bars))"


@query("SELECT exchange, cal_date, is_open, max(CASE WHEN is_open = 1 THEN cal_date END) OVER (ORDER BY cal_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_open, min(CASE WHEN is_open = 1 THEN cal_date END) OVER (ORDER BY cal_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_open FROM cl", False, _CAL)
def t11_open_days(fx):
    d = F.col("cal_date")
    days = fx("fx_bars").select(F.lit("SSE").alias("exchange"), F.col("time").cast("date").alias("cal_date")).distinct()
    return cal.open_days(days.withColumn("is_open", F.when((F.weekday(d) < 5) & (F.day(d) % 10 != 3), 1).otherwise(0)))


@query("SELECT symbol, time, CASE WHEN p >= 80 THEN 'very high' WHEN p >= 60 THEN 'high' WHEN p >= 40 THEN 'middle' WHEN p >= 20 THEN 'low' WHEN p IS NULL THEN NULL ELSE 'very low' END AS level, CASE WHEN pe_ttm <= 0 OR pe_ttm IS NULL THEN NULL WHEN pe_ttm / 100 < 0.5 THEN 'very cheap' WHEN pe_ttm / 100 < 1 THEN 'cheap' WHEN pe_ttm / 100 < 1.5 THEN 'fair' WHEN pe_ttm / 100 < 2 THEN 'dear' ELSE 'very dear' END AS peg_level FROM (SELECT *, (symbol * 37 + day(time) * 3) % 100 AS p FROM fx_ratios)")
def e10_levels(fx):
    return fx("fx_ratios").select("symbol", "time", rules.percentile_level((F.col("symbol") * 37 + F.day("time") * 3) % 100).alias("level"), rules.peg_level(F.col("pe_ttm") / 100).alias("peg_level"))


@query("SELECT event_id, CASE symbol % 4 WHEN 0 THEN '5m' WHEN 1 THEN '1d' WHEN 2 THEN '15m' ELSE '1w' END AS frequency FROM fx_ticks")
def e16_canonical_frequency(fx):
    names = F.when(F.col("symbol") % 4 == 0, "minute_5").when(F.col("symbol") % 4 == 1, "daily").when(F.col("symbol") % 4 == 2, "15m").otherwise("weekly")
    return fx("fx_ticks").select("event_id", rules.canonical_frequency(names).alias("frequency"))


# --- incremental ------------------------------------------------------------------------------------------------------

_PROC = "pr AS (SELECT symbol, arg_max(adj_factor, time) + CASE WHEN symbol % 8 = 0 THEN 0.01 ELSE 0 END AS a FROM fx_adj_factor WHERE symbol % 5 <> 0 GROUP BY symbol)"


def _processed(fx) -> DataFrame:
    return fx("fx_adj_factor").where("symbol % 5 <> 0").withColumn("adj_factor", F.col("adj_factor") + F.when(F.col("symbol") % 8 == 0, 0.01).otherwise(0.0))


@query("SELECT b.symbol, coalesce(f.a, 1.0) AS current_adj, pr.a IS NULL OR abs(coalesce(f.a, 1.0) - pr.a) > 1e-10 AS needs_full FROM (SELECT DISTINCT symbol FROM fx_bars) b LEFT JOIN (SELECT symbol, arg_max(adj_factor, time) AS a FROM fx_adj_factor GROUP BY 1) f ON f.symbol = b.symbol LEFT JOIN pr ON pr.symbol = b.symbol", False, _PROC)
def i1_classify(fx):
    return incremental.classify(fx("fx_adj_factor"), _processed(fx), fx("fx_bars"))


_DONE = (
    "src AS (SELECT symbol, CAST(max(time) AS DATE) AS src FROM fx_bars GROUP BY 1), fr AS (SELECT unnest(['daily', 'weekly', 'monthly']) AS freq), "
    "dn AS (SELECT symbol, freq, CASE WHEN symbol % 6 = 0 THEN NULL WHEN freq = 'daily' THEN src - CAST(symbol % 3 AS INT) WHEN freq = 'weekly' THEN CAST(src + CAST((4 - (isodow(src) - 1) + 7) % 7 AS INT) - 7 * CAST(symbol % 2 AS INT) AS DATE) ELSE CASE WHEN symbol % 2 = 0 THEN last_day(src) ELSE CAST(date_trunc('month', src) - INTERVAL 1 DAY AS DATE) END END AS done FROM src CROSS JOIN fr), "
    "ru AS (SELECT symbol, freq, done AS start_date, CASE WHEN done IS NULL THEN true WHEN freq = 'daily' THEN CASE WHEN src > done THEN false END WHEN done < e THEN false WHEN done = e THEN true END AS inclusive FROM (SELECT dn.*, src.src, CASE freq WHEN 'weekly' THEN CAST(src.src + CAST((4 - (isodow(src.src) - 1) + 7) % 7 AS INT) AS DATE) ELSE last_day(src.src) END AS e FROM dn JOIN src ON src.symbol = dn.symbol))"
)


def _rules(fx):
    src = fx("fx_bars").groupBy("symbol").agg(F.max("time").alias("latest"))
    d = F.col("latest").cast("date")
    all_freqs = src.withColumn("freq", F.explode(F.array(*map(F.lit, ("daily", "weekly", "monthly")))))
    odd = F.col("symbol") % 2
    done = F.when(F.col("symbol") % 6 == 0, F.lit(None).cast("date")).when(F.col("freq") == "daily", F.date_sub(d, (F.col("symbol") % 3).cast("int"))).when(F.col("freq") == "weekly", F.date_sub(cal.period_end(d, "W"), (7 * odd).cast("int"))).otherwise(F.when(odd == 0, F.last_day(d)).otherwise(F.date_sub(F.trunc(d, "month"), 1)))
    return src, all_freqs.select("symbol", "freq", done.alias("latest"))


@query("SELECT * FROM ru WHERE inclusive IS NOT NULL", False, _DONE)
def i2_upsert_rules(fx):
    return incremental.upsert_rules(*_rules(fx))


@query("SELECT b.symbol, b.time FROM fx_bars b JOIN ru ON ru.symbol = b.symbol AND ru.freq = 'daily' AND inclusive IS NOT NULL WHERE start_date IS NULL OR CAST(b.time AS DATE) > start_date OR inclusive AND CAST(b.time AS DATE) = start_date", False, _DONE)
def i3_filter_by_rule(fx):
    return incremental.filter_by_rules(fx("fx_bars").select("symbol", "time"), incremental.upsert_rules(*_rules(fx)), "daily")


@query("SELECT symbol, CAST(min(start_date) - max(CASE freq WHEN 'daily' THEN 160 WHEN 'weekly' THEN 490 ELSE 1550 END) AS DATE) AS fetch_start FROM ru WHERE inclusive IS NOT NULL GROUP BY 1", False, _DONE)
def i4_warmup_start(fx):
    return incremental.fetch_start(incremental.upsert_rules(*_rules(fx)), ["daily", "weekly", "monthly"])


@query("SELECT s.symbol, s.symbol % 6 = 0 AS needs_full FROM src s", False, _DONE)
def i5_promote_to_full(fx):
    src, done = _rules(fx)
    return incremental.promote(src.select("symbol", F.lit(False).alias("needs_full")), done, ["daily", "weekly", "monthly"])


@query("SELECT s_suppkey AS symbol, l + 1 AS fetch_from, DATE '1998-10-15' AS fetch_to FROM {supplier} LEFT JOIN (SELECT symbol, CAST(max(time) AS DATE) AS l FROM fx_bars WHERE symbol % 3 <> 0 GROUP BY 1) ON s_suppkey = symbol WHERE l IS NULL OR l + 1 <= DATE '1998-10-15'")
def i7_next_fetch_range(fx):
    return incremental.gaps(fx("supplier").select(F.col("s_suppkey").alias("symbol")), fx("fx_bars").where("symbol % 3 <> 0"), "1998-10-15")


@query("SELECT event_id, (CAST(time + INTERVAL 8 HOUR AS DATE) = CAST(time + INTERVAL 11 HOUR AS DATE)) AS minute_overwrite FROM fx_ticks")
def i8_overwrite_latest(fx):
    return fx("fx_ticks").select("event_id", incremental.overwrite_latest(F.col("time"), F.col("time") + F.expr("INTERVAL 3 HOURS"), "minute").alias("minute_overwrite"))


# --- data quality -------------------------------------------------------------------------------------------------------


@query("SELECT 'ticks' AS table_name, hour(time) AS hour, count(*) AS n FROM fx_ticks GROUP BY 2 UNION ALL SELECT 'bars', hour(time), count(*) FROM fx_bars GROUP BY 2")
def d4_hour_histogram(fx):
    return quality.hour_histogram({"ticks": fx("fx_ticks"), "bars": fx("fx_bars")})


_STAMPED = "st AS (SELECT symbol, CAST(time + INTERVAL 8 HOUR AS TIMESTAMP) AS time FROM fx_bars WHERE symbol % 3 <> 0 UNION ALL SELECT symbol, CAST(time + INTERVAL 15 HOUR AS TIMESTAMP) FROM fx_bars WHERE symbol % 2 = 0)"


def _stamped(fx) -> DataFrame:
    b = fx("fx_bars").select("symbol", "time")
    at = lambda rows, h: rows.withColumn("time", F.col("time") + F.expr(f"INTERVAL {h} HOURS"))
    return at(b.where("symbol % 3 <> 0"), 8).unionByName(at(b.where("symbol % 2 = 0"), 15))


@query("SELECT symbol, max(CAST(date_trunc('day', time) AS TIMESTAMP) + INTERVAL 15 HOUR) AS time FROM st GROUP BY symbol, date_trunc('day', time)", False, _STAMPED)
def d5_repair_duplicate_bars(fx):
    return quality.repair_duplicate_bars(_stamped(fx))


@query("SELECT symbol, CAST(time AS DATE) AS day FROM st WHERE hour(time) = 8 EXCEPT SELECT symbol, CAST(time AS DATE) FROM st WHERE hour(time) = 15", False, _STAMPED)
def u2_except(fx):
    return quality.duplicated_hours(_stamped(fx))


@query("SELECT symbol, CAST(date_trunc('day', time) AS TIMESTAMP) + INTERVAL 15 HOUR AS time FROM st", False, _STAMPED)
def d6_repair_timestamps(fx):
    return quality.repair_timestamps(_stamped(fx), [8])


@query("SELECT 'close is positive' AS rule, count(*) AS violations, false AS passed FROM fx_bars WHERE symbol % 4 = 2 UNION ALL SELECT 'volume is not negative', 0, true UNION ALL SELECT 'times rise within a symbol', 0, true UNION ALL SELECT 'symbol is known', 0, true UNION ALL SELECT 'time is known', 0, true")
def d7_quality_checks(fx):
    bars = fx("fx_bars").withColumn("close", F.when(F.col("symbol") % 4 == 2, -F.col("close")).otherwise(F.col("close")))
    return quality.quality_checks(bars, prices=["close"])


# --- query surface ------------------------------------------------------------------------------------------------------

_RANGE = "time >= '1996-03-01' AND time < '1996-07-01'"


@query(f"SELECT symbol, time, round(open, 6) AS open, round(close, 6) AS close, volume FROM fx_bars WHERE {_RANGE}")
def q1_get_daily(fx):
    return rounded(Hub({"daily": fx("fx_bars")}).get_daily(None, "1996-03-01", "1996-06-30"), "open", "close").select("symbol", "time", "open", "close", "volume")


@query("SELECT symbol, time, price, frequency FROM (SELECT *, '5m' AS frequency FROM fx_ticks) WHERE symbol % 2 = 0")
def q2_get_minute(fx):
    rows = fx("fx_ticks").withColumn("frequency", F.when(F.col("symbol") % 2 == 0, "5m").otherwise("1m"))
    return Hub({"minute": rows}).get_minute(frequency="minute_5").select("symbol", "time", "price", "frequency")


@query(f"SELECT symbol, time, {r('pe_ttm', 'pb')} FROM fx_ratios WHERE {_RANGE}")
def q3_get_daily_basic(fx):
    return rounded(Hub({"daily_basic": fx("fx_ratios")}).get_daily_basic(None, "1996-03-01", "1996-06-30"), "pe_ttm", "pb").select("symbol", "time", "pe_ttm", "pb")


@query(f"SELECT symbol, time, adj_factor FROM fx_adj_factor WHERE {_RANGE}")
def q4_get_adj_factor(fx):
    return Hub({"adj_factor": fx("fx_adj_factor")}).get_adj_factor(None, "1996-03-01", "1996-06-30")


@query("SELECT symbol, market FROM (SELECT s_suppkey AS symbol, CASE s_suppkey % 3 WHEN 0 THEN 'main' ELSE 'growth' END AS market, CASE WHEN s_suppkey % 7 = 0 THEN 'D' ELSE 'L' END AS list_status FROM {supplier}) WHERE list_status = 'L'")
def q37_active_assets(fx):
    return _assets(fx).active_assets().select("symbol", "market")


def _assets(fx) -> Hub:
    s = F.col("s_suppkey")
    return Hub({"asset_basic": fx("supplier").select(s.alias("symbol"), F.when(s % 3 == 0, "main").otherwise("growth").alias("market"), F.when(s % 7 == 0, "D").otherwise("L").alias("list_status"))})


@query("SELECT s_suppkey AS symbol FROM {supplier} WHERE s_suppkey % 3 = 0 AND s_suppkey % 7 <> 0 ORDER BY 1 LIMIT 10")
def q38_symbol_list(fx):
    return _assets(fx).symbol_list("main", 10)


@query("SELECT DISTINCT symbol FROM fx_bars")
def q39_distinct_keys(fx):
    return Hub({"daily": fx("fx_bars")}).distinct_keys("daily")


@query("SELECT ts_code, l1_name, l2_name, l3_name FROM fx_members WHERE l1_name = 'EUROPE'")
def q24_members(fx):
    return Hub({"industry_member": fx("fx_members")}).get_members(l1="EUROPE").select("ts_code", "l1_name", "l2_name", "l3_name")


@query("SELECT ts_code, end_date, round(roa, 6) AS roa FROM fx_statements WHERE end_date >= '1995-01-01' AND end_date <= '1996-12-31'")
def q19_fina_indicator(fx):
    return rounded(Hub({"fina_indicator": fx("fx_statements")}).get_fina_indicator(None, "1995-01-01", "1996-12-31"), "roa").select("ts_code", "end_date", "roa")


@query(f"SELECT symbol, time, round(close * (adj_factor / base), 6) AS close FROM (SELECT *, arg_max(adj_factor, time) OVER (PARTITION BY symbol) AS base FROM fx_factored WHERE {_RANGE})")
def q27_daily_adjusted(fx):
    hub = Hub({"daily": fx("fx_bars"), "adj_factor": fx("fx_adj_factor")})
    return rounded(hub.get_daily_adjusted(None, "1996-03-01", "1996-06-30"), "close").select("symbol", "time", "close")


@query(f"SELECT symbol, time, {r(*OHLC)}, volume, amount, CASE WHEN count(close) {_w(20)} >= 20 THEN round(avg(close) {_w(20)}, 6) END AS ma_20 FROM fx_bars")
def q28_processed_daily(fx):
    hub = Hub({"processed_daily": ind.MA(20).apply(fx("fx_bars"))})
    return rounded(hub.get_processed("daily", indicators=["ma_20", "unknown"]), *OHLC, "ma_20")


@query(f"SELECT symbol, time, {r('pb')} FROM fx_ratios WHERE {_RANGE}")
def q31_valuation_pct(fx):
    return rounded(Hub({"valuation_pct": fx("fx_ratios")}).get_valuation(None, "1996-03-01", "1996-06-30", ["pb", "pb", "unknown"]), "pb")


@query("SELECT q.symbol, q.time, round(q.pb, 6) AS pb, f.end_date AS fscore_period, round(f.roa, 6) AS roa FROM fx_ratios q ASOF LEFT JOIN (SELECT s.s_suppkey AS symbol, st.end_date, st.roa, CAST(st.end_date + 30 AS TIMESTAMP) AS eff FROM fx_statements st JOIN {supplier} s ON s.s_nationkey = st.ts_code) f ON q.symbol = f.symbol AND q.time >= f.eff WHERE q.time >= '1996-03-01' AND q.time < '1996-07-01'")
def q36_fundamental_combined(fx):
    s = fx("supplier").select(F.col("s_suppkey").alias("__s"), F.col("s_nationkey").alias("ts_code"))
    reports = fx("fx_statements").join(s, "ts_code").select(F.col("__s").alias("ts_code"), "end_date", "roa", F.date_add("end_date", 30).alias("ann_date"), F.lit(None).cast("date").alias("f_ann_date"))
    hub = Hub({"valuation_pct": fx("fx_ratios"), "fundamental_quality": reports})
    return rounded(hub.get_fundamental_combined(None, "1996-03-01", "1996-06-30", ["pb", "fscore_period", "roa"]), "pb", "roa")


@query("SELECT symbol, time_bucket(INTERVAL 5 MINUTE, time) AS time, arg_min(price, time) AS open, max(price) AS high, min(price) AS low, arg_max(price, time) AS close, count(*) AS volume, count(*) AS ticks FROM fx_ticks GROUP BY 1, 2")
def x2_ticks_to_bars(fx):
    return ticks.ticks_to_bars(fx("fx_ticks"))


from . import catalog_jobs, catalog_streams  # noqa: E402, F401  (register further queries here)

"""Registered queries of the getters by dataset, the jobs, and what is written to and read back from the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import adjust as adj
from ..operators import indicators as ind
from ..operators import resample, statements, valuation
from ..sources import schemas, tables
from ..streaming import ticks
from . import catalog as c
from . import incremental, jobs, quality
from .hub import Hub

FROM, TO = "1996-03-01", "1996-06-30"
_DAYS = f"time >= '{FROM}' AND time < '1996-07-01'"


def session(fx):
    return fx("supplier").sparkSession


# --- getters --------------------------------------------------------------------------------------------------------------


@c.query("SELECT s_suppkey AS symbol, CASE WHEN s_suppkey % 3 = 0 THEN 'main' ELSE 'growth' END AS market, CASE WHEN s_suppkey % 7 = 0 THEN 'D' ELSE 'L' END AS list_status FROM {supplier}")
def q5_get_basic(fx):
    return c._assets(fx).get_basic([])


def _rolled(name: str, unit: str):
    @c.query(f"SELECT symbol, time, round(close, 6) AS close, volume FROM ({c._rollup_sql(unit)}) WHERE {_DAYS}")
    def bars(fx):
        hub = Hub({f"{unit}ly": resample.rollup_bars(fx("fx_factored"), unit)})
        return c.rounded(getattr(hub, f"get_{unit}ly")(None, FROM, TO), "close").select("symbol", "time", "close", "volume")

    @c.query(f"SELECT symbol, time, avg_pe_ttm, ps_ttm FROM ({c._ratio_sql(unit)}) WHERE {_DAYS}")
    def ratios(fx):
        hub = Hub({f"daily_basic_{unit}ly": c._ratios(fx, unit)})
        return getattr(hub, f"get_daily_basic_{unit}ly")(None, FROM, TO).select("symbol", "time", "avg_pe_ttm", "ps_ttm")

    @c.query(f"SELECT symbol, time, adj_factor FROM ({c._factor_sql(unit)}) WHERE {_DAYS}")
    def factors(fx):
        hub = Hub({f"adj_factor_{unit}ly": resample.rollup_factor(fx("fx_adj_factor"), unit)})
        return getattr(hub, f"get_adj_factor_{unit}ly")(None, FROM, TO).select("symbol", "time", "adj_factor")

    first = {"week": (6, 8, 10), "month": (7, 9, 11)}[unit]
    for f, k, kind in zip((bars, ratios, factors), first, ("", "daily_basic_", "adj_factor_")):
        c.QUERIES[f"q{k}_{kind}{unit}ly"], c.ORACLES[f"q{k}_{kind}{unit}ly"] = c.QUERIES.pop(f.__name__), c.ORACLES.pop(f.__name__)


_rolled("", "week")
_rolled("", "month")


def _dataset(name: str, dataset: str, table: str, renamed: dict[str, str], columns: list[str], time: str):
    """A getter over a derived table whose columns are renamed to the dataset's."""
    back = {v: k for k, v in renamed.items()}
    listed = ", ".join(f"{back.get(x, x)} AS {x}" for x in columns)

    def get(fx):
        hub = Hub({dataset: fx(table).withColumnsRenamed(renamed)})
        call = getattr(hub, f"get_{dataset}")
        return (call(None, FROM, TO) if hub_has_key(dataset) else call(start=FROM, end=TO)).select(*columns)

    get.__name__ = name
    c.query(f"SELECT {listed} FROM {table} WHERE {back.get(time, time)} >= '{FROM}' AND {back.get(time, time)} < '1996-07-01'")(get)


def hub_has_key(dataset: str) -> bool:
    from .hub import SPECS

    return SPECS[dataset].key is not None


_index = {"symbol": "ts_code", "time": "trade_date"}
_month = {"month_start": "time"}
_dataset("q12_gdp", "gdp", "fx_gdp", {}, ["time", "gdp_yoy"], "time")
_dataset("q13_ppi", "ppi", "fx_macro_month", _month, ["time", "ppi_yoy"], "time")
_dataset("q14_money", "money", "fx_macro_month", _month, ["time", "m2_yoy"], "time")
_dataset("q15_pmi", "pmi", "fx_macro_month", _month, ["time", "pmi"], "time")
_dataset("q16_index_daily", "index_daily", "fx_bars", _index, ["ts_code", "trade_date", "volume"], "trade_date")
_dataset("q17_index_dailybasic", "index_dailybasic", "fx_ratios", _index, ["ts_code", "trade_date", "dv_ttm"], "trade_date")
_dataset("q18_sw_daily", "sw_daily", "fx_bars", _index, ["ts_code", "trade_date", "amount"], "trade_date")
_dataset("q20_cashflow", "cashflow", "fx_statements", {}, ["ts_code", "end_date", "n_cashflow_act"], "end_date")
_dataset("q21_balancesheet", "balancesheet", "fx_statements", {}, ["ts_code", "end_date", "total_assets", "total_liab"], "end_date")
_dataset("q22_income", "income", "fx_statements", {}, ["ts_code", "end_date", "n_income"], "end_date")


@c.query("SELECT concat('N', CAST(n_nationkey AS VARCHAR)) AS industry_code, n_name AS industry_name, 'L2' AS level FROM {nation}")
def q23_classify(fx):
    one = fx("region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("industry_code"), F.col("r_name").alias("industry_name"), F.lit("L1").alias("level"))
    two = fx("nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("industry_code"), F.col("n_name").alias("industry_name"), F.lit("L2").alias("level"))
    return Hub({"industry_classify": one.unionByName(two)}).get_classify("L2")


def _calendar(fx) -> DataFrame:
    d = F.col("cal_date")
    days = fx("fx_bars").select(F.explode(F.array(F.lit("SSE"), F.lit("SZSE"))).alias("exchange"), F.col("time").cast("date").alias("cal_date")).distinct()
    return days.withColumn("is_open", F.when((F.weekday(d) < 5) & (F.day(d) % 10 != 3), 1).otherwise(0))


_OPEN = "op AS (SELECT DISTINCT CAST(time AS DATE) AS cal_date, CASE WHEN isodow(time) <= 5 AND day(time) % 10 <> 3 THEN 1 ELSE 0 END AS is_open FROM fx_bars)"


@c.query(f"SELECT 'SSE' AS exchange, cal_date, is_open FROM op WHERE is_open = 1 AND cal_date >= '{FROM}' AND cal_date <= '{TO}'", False, _OPEN)
def q25_trade_cal(fx):
    return Hub({"trade_cal": _calendar(fx)}).get_calendar("sse", FROM, TO, is_open=1)


@c.query("SELECT l1_name AS index_code, ts_code AS con_code, last_day(month_start) AS trade_date FROM fx_members, fx_macro_month WHERE last_day(month_start) = DATE '1996-03-31'")
def q26_index_weight(fx):
    days = fx("fx_macro_month").select(F.last_day("month_start").alias("trade_date"))
    weights = fx("fx_members").join(F.broadcast(days.agg(F.collect_list("trade_date").alias("d"))), F.lit(True))
    hub = Hub({"index_weight": weights.select(F.col("l1_name").alias("index_code"), F.col("ts_code").alias("con_code"), F.explode("d").alias("trade_date"))})
    return hub.get_index_weight(day="1996-03-31")


def _period(name: str, freq: str, unit: str):
    @c.query(f"SELECT symbol, time, round(close, 6) AS close, CASE WHEN count(close) {c._w(5)} >= 5 THEN round(avg(close) {c._w(5)}, 6) END AS ma_5 FROM ({c._resample_sql(unit).replace('round(', '(').replace(', 6) AS', ') AS').replace(', 2) AS', ') AS')})")
    def processed(fx):
        hub = Hub({f"processed_{freq}": ind.MA(5).apply(resample.resample(fx("fx_factored"), unit))})
        return c.rounded(hub.get_processed(freq, indicators=["ma_5"]), "close", "ma_5").select("symbol", "time", "close", "ma_5")

    c.QUERIES[name], c.ORACLES[name] = c.QUERIES.pop("processed"), c.ORACLES.pop("processed")


_period("q29_processed_weekly", "weekly", "W")
_period("q30_processed_monthly", "monthly", "M")


@c.query("SELECT ts_code, end_date, f_score FROM g WHERE end_date >= '1995-01-01' AND end_date <= '1996-12-31'", False, c._SCORE)
def q32_quarterly_fundamental(fx):
    return Hub({"fundamental_quality": c._scores(fx)}).get_fundamental_quality(None, "1995-01-01", "1996-12-31").select("ts_code", "end_date", "f_score")


# --- rules and indicators ---------------------------------------------------------------------------------------------------


@c.query(c._WEEK.removeprefix("w AS (").removesuffix(")").replace("arg_max(close * (adj_factor / base), time) AS close", "round(arg_max(close * (adj_factor / base), time), 6) AS close"))
def a5_require_adjusted(fx):
    """Weekly bars of adjusted ones; unadjusted ones are refused first."""
    try:
        resample.resample(adj.adjust(fx("fx_factored"), "none"), "W")
    except ValueError:
        return c.rounded(resample.resample(adj.adjust(fx("fx_factored"), "qfq"), "W"), "close").select("symbol", "time", "close")
    raise AssertionError("unadjusted bars were resampled")


@c.query("SELECT symbol, time, CASE symbol % 5 WHEN 0 THEN day(time) WHEN 1 THEN month(time) WHEN 2 THEN year(time) WHEN 3 THEN -1 END AS pct FROM fx_bars")
def e5_pick_percentile(fx):
    kind = F.element_at(F.array(*map(F.lit, ("PE", "PB", "PS", "PEG", "none"))), (F.col("symbol") % 5 + 1).cast("int"))
    return fx("fx_bars").select("symbol", "time", rules.pick_percentile(kind, F.day("time"), F.month("time"), F.year("time"), F.lit(-1)).alias("pct"))


@c.query(
    "SELECT ts_code, end_date, CASE WHEN q = 1 THEN end_date + 20 WHEN q = 2 AND ts_code % 2 = 0 THEN end_date + 25 WHEN q = 2 THEN end_date + 30 WHEN q = 3 AND ts_code % 3 = 0 THEN end_date + 35 WHEN q = 3 THEN end_date + 40 WHEN y % 2 = 0 THEN end_date + 45 ELSE end_date + 50 END AS f_ann_date, f_score FROM g",
    False,
    c._SCORE,
)
def e11_announcement_date(fx):
    return _dated_scores(fx).select("ts_code", "end_date", "f_ann_date", "f_score")


def _dated_scores(fx) -> DataFrame:
    """Scores of statements that name their announcement dates: the cash flow of the first half, income of the second and third quarter, balance sheet of the third."""
    s, q, odd = fx("fx_statements"), F.col("q"), F.col("ts_code") % 2
    after = lambda when, days: F.when(when, F.date_add("end_date", days)).alias("f_ann_date")
    own = s.select("ts_code", "end_date", "roa", "q_gsprofit_margin", "q_netprofit_margin", F.date_add("end_date", 50).alias("ann_date"), after(F.col("y") % 2 == 0, 45))
    balance = s.select("ts_code", "end_date", "total_assets", "total_ncl", "total_liab", "total_share", after(q == 3, 40))
    cash = s.select("ts_code", "end_date", "n_cashflow_act", F.when(q == 1, F.date_add("end_date", 20)).when((q == 2) & (odd == 0), F.date_add("end_date", 25)).alias("f_ann_date"))
    income = s.select("ts_code", "end_date", "n_income", F.when(q == 2, F.date_add("end_date", 30)).when((q == 3) & (F.col("ts_code") % 3 == 0), F.date_add("end_date", 35)).alias("f_ann_date"))
    exempt = s.select("ts_code").distinct().where("ts_code % 3 = 0").withColumn("exemptions", F.array(F.lit("f_score_gross_margin")))
    return statements.fscore(own, balance, cash, income, exempt)


class _Range(ind.Indicator):
    needs = ("symbol", "time", "high", "low")
    name = property(lambda self: "range")
    columns = property(lambda self: ["range"])

    def calculate(self, bars: DataFrame) -> DataFrame:
        return bars.withColumn("range", F.col("high") - F.col("low"))


@c.query("SELECT symbol, time, round(high - low, 6) AS range FROM fx_bars")
def y1_registry(fx):
    """An indicator of one's own, by name, after its input has been checked."""
    ind.register_indicator("range", _Range)
    try:
        made = ind.create_indicator("range")
        try:
            made.validate_input(fx("fx_bars").drop("high"))
        except ValueError:
            return c.rounded(ind.apply_batch(fx("fx_bars"), ["range"]), "range").select("symbol", "time", "range")
        raise AssertionError("bars without a needed column were taken")
    finally:
        ind.REGISTRY.pop("range")


# --- jobs ------------------------------------------------------------------------------------------------------------------------

_EXEMPT = "ts_code IN (SELECT m.ts_code FROM fx_members m JOIN fx_config cf ON m.l3_name = cf.l3_name WHERE cf.exemption IS NOT NULL)"


@c.query("SELECT ts_code, end_date, f_delta_margin, f_score FROM g WHERE end_date >= DATE '1996-01-01' - 100", False, c._SCORE.replace("ts_code % 3 = 0", _EXEMPT))
def p5_quality_job(fx):
    s = fx("fx_statements")
    parts = [s.select("ts_code", "end_date", *x) for x in (["roa", "q_gsprofit_margin", "q_netprofit_margin"], ["total_assets", "total_ncl", "total_liab", "total_share"], ["n_cashflow_act"], ["n_income"])]
    return jobs.quality_job(*parts, fx("fx_members"), c.config(fx), since="1996-01-01").select("ts_code", "end_date", "f_delta_margin", "f_score")


@c.query("SELECT symbol, time, l3_name, core_indicator_type, core_indicator_value, core_indicator_industry_pct FROM iv WHERE time >= '1997-01-01'", False, c._VALUED)
def p7_industry_job(fx):
    rows = valuation.with_peg(fx("fx_ratios"), c.growth(fx))
    out = jobs.industry_job(rows, fx("fx_members").where("ts_code % 7 <> 3"), c.config(fx), since="1997-01-01")
    return c.rounded(out, "core_indicator_value", "core_indicator_industry_pct").select("symbol", "time", "l3_name", "core_indicator_type", "core_indicator_value", "core_indicator_industry_pct")


@c.query("SELECT * FROM sn", True, c._SNAP)
def p10_macro_job(fx):
    """Both tables replaced twice in the shared folder, and the second one read back."""
    spark, m = session(fx), fx("fx_macro_month").withColumnRenamed("month_start", "time")
    covered = fx("fx_members").join(fx("fx_config").select("l3_name"), "l3_name", "left_semi")
    both = jobs.macro_job(m.select("time", "m2_yoy"), m.select("time", "ppi_yoy"), m.select("time", F.col("pmi").alias("pmi010000")), fx("fx_gdp"), c.config(fx), covered)
    paths = [tables.scratch(spark, "macro"), tables.scratch(spark, "industries")]
    for path, out in zip(paths, both):
        tables.replace_all(spark, path, out.limit(1))
        tables.replace_all(spark, path, out)
    return tables.read(spark, paths[1]).select("time", "l3_name", "l2_name", "config_macro_cycle", "is_present_in_members", "matches_raw_phase", "matches_stable_phase")


@c.query(f"SELECT symbol, time, CASE WHEN count(close) {c._w(20)} >= 20 THEN round(avg(close) {c._w(20)}, 6) END AS ma_20 FROM (SELECT symbol, time, close * (adj_factor / base) AS close FROM (SELECT *, arg_max(adj_factor, time) OVER (PARTITION BY symbol) AS base FROM fx_factored)) WHERE symbol IN (SELECT ts_code FROM fx_members WHERE l1_name = 'ASIA')")
def p11_batch_symbols(fx):
    symbols = fx("fx_members").where("l1_name = 'ASIA'").select(F.col("ts_code").alias("symbol"))
    out = jobs.technical_job(fx("fx_bars"), fx("fx_adj_factor"), ["ma_20"], ["daily"], symbols=symbols)["daily"]
    return c.rounded(out, "ma_20").select("symbol", "time", "ma_20")


@c.query("SELECT symbol, time, time >= DATE '1998-06-01' - 5 AS written FROM fx_ratios WHERE time >= DATE '1998-06-01' - 1900")
def i6_valuation_window(fx):
    rows, keep = incremental.valuation_window(fx("fx_ratios"), "1998-06-01")
    return rows.select("symbol", "time", keep.alias("written"))


@c.query("SELECT latest, max(cal_date) AS last_open, count(cal_date) AS days_behind, count(cal_date) > 0 AS is_stale FROM (SELECT CAST(max(time) AS DATE) AS latest FROM fx_bars WHERE time < '1998-01-01') LEFT JOIN (SELECT * FROM op WHERE is_open = 1 AND cal_date <= '1998-03-31') ON cal_date > latest GROUP BY 1", False, _OPEN)
def d2_freshness(fx):
    return quality.freshness(fx("fx_bars").where("time < '1998-01-01'"), _calendar(fx), "1998-03-31")


# --- storage ------------------------------------------------------------------------------------------------------------------------


@c.query("SELECT CAST(symbol AS VARCHAR) AS symbol, time, round(close, 6) AS close, volume FROM fx_bars")
def s1_land_dataset(fx):
    """Files of text with the vendor's names, each row twice, to one typed row a key."""
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "landing")
    raw = fx("fx_bars").select(F.col("symbol").cast("string").alias("ts_code"), F.date_format("time", "yyyyMMdd").alias("trade_date"), F.col("close").cast("string").alias("close"), F.col("volume").cast("string").alias("vol"))
    raw.unionByName(raw).write.json(path)
    return c.rounded(schemas.land(spark, path, "daily", "json")[0], "close").select("symbol", "time", "close", "volume")


@c.query("SELECT concat(CAST(s_suppkey AS VARCHAR), '.SH') AS symbol, s_acctbal AS close FROM {supplier}")
def s3_rename_columns(fx):
    raw = fx("supplier").select(F.concat(F.col("s_suppkey").cast("string"), F.lit(".SH")).alias("ts_code"), F.col("s_acctbal").alias("close"))
    return schemas.rename_columns(raw, {"ts_code": "symbol", "vol": "volume"})


@c.query("SELECT symbol, time, l3_name, CASE WHEN cf.exemption IS NULL THEN '[]' ELSE concat('[\"', cf.exemption, '\"]') END AS fscore_exemptions FROM iv LEFT JOIN fx_config cf USING (l3_name)", False, c._VALUED)
def k4_store_industry(fx):
    """Listed columns, lists as JSON, upserted by symbol and time in two runs that overlap."""
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "industry")
    rows = valuation.industry_valuation(valuation.with_peg(fx("fx_ratios"), c.growth(fx)), fx("fx_members").where("ts_code % 7 <> 3"), c.config(fx))
    kept = tables.storable(rows, ["symbol", "time", "l3_name", "fscore_exemptions", "not there"])
    tables.write_upsert(spark, path, kept.where("symbol % 3 <> 0").withColumn("l3_name", F.lit("before")), ["symbol", "time"])
    tables.write_upsert(spark, path, kept, ["symbol", "time"])
    return tables.read(spark, path)


@c.query("SELECT symbol, time, round(CASE WHEN symbol % 2 = 0 THEN close * 3 ELSE close END, 6) AS close, volume FROM fx_bars")
def k1_upsert_listed_columns(fx):
    """New closes of some rows; their stored volumes stay."""
    b = fx("fx_bars").select("symbol", "time", "close", "volume")
    return c.rounded(tables.upsert(b, b.where("symbol % 2 = 0").select("symbol", "time", (F.col("close") * 3).alias("close")), ["symbol", "time"]), "close")


@c.query("SELECT symbol, time, volume FROM fx_bars WHERE symbol % 2 = 1")
def k5_replace_all(fx):
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "replaced")
    b = fx("fx_bars").select("symbol", "time", "volume")
    tables.replace_all(spark, path, b.where("symbol % 2 = 0"))
    tables.replace_all(spark, path, b.where("symbol % 2 = 1"))
    return tables.read(spark, path)


@c.query("SELECT symbol, time, volume FROM fx_bars WHERE time >= '1996-05-15'")
def k6_delete_before(fx):
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "retained")
    tables.replace_all(spark, path, fx("fx_bars").select("symbol", "time", "volume", F.year("time").alias("year")).repartition("year"), ["year"])
    tables.delete_before(spark, path, "1996-05-15")
    return tables.read(spark, path).select("symbol", "time", "volume")


@c.query(
    "SELECT rule, 0 AS violations, true AS passed, (SELECT count(*) FROM fx_bars WHERE time >= '1996-01-01' AND time < '1998-01-01') AS n_rows "
    "FROM (SELECT unnest(['symbol is known', 'time is known', 'open is positive', 'high is positive', 'low is positive', 'close is positive', 'volume is not negative', 'times rise within a symbol', 'rows as expected', 'files of a symbol follow each other']) AS rule)"
)
def k7_etl_export(fx):
    """Two runs of one range, the second over the partitions of the first, and the report of what is stored."""
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "export")
    bars = fx("fx_bars")
    tables.export(bars, path, "1996-01-01", "1996-12-31")
    tables.export(bars, path, "1996-01-01", "1997-12-31")
    n = bars.where("time >= '1996-01-01' AND time < '1998-01-01'").count()
    return tables.export_report(spark, path, n).withColumn("n_rows", F.lit(spark.read.parquet(path).count()))


@c.query("SELECT 'bars' AS job, 'ok' AS status, count(*) AS n_rows FROM fx_bars UNION ALL SELECT 'ticks', 'failed', count(*) FROM fx_ticks")
def k8_run_log(fx):
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "runs")
    tables.log_run(spark, path, "bars", "ok", fx("fx_bars").count())
    tables.log_run(spark, path, "ticks", "failed", fx("fx_ticks").count())
    return spark.read.parquet(path).select("job", "status", "n_rows")


@c.query("SELECT count(*) AS before, 0 AS after FROM fx_bars")
def k9_truncate(fx):
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "cleared")
    fx("fx_bars").write.parquet(path)
    before = spark.read.parquet(path).count()
    tables.truncate(spark, path)
    return tables.read(spark, path).agg(F.lit(before).cast("long").alias("before"), F.count("*").alias("after"))


# --- streams, each over all there is and then ended -----------------------------------------------------------------------------


def _stream(fx, table: str) -> DataFrame:
    """A derived table as a stream of files, as many as tasks write."""
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, table)
    fx(table).write.parquet(path)
    stored = spark.read.parquet(path)
    return spark.readStream.schema(stored.schema).parquet(path)


@c.query("SELECT DISTINCT symbol, time FROM fx_ticks")
def x1_tick_archive(fx):
    spark = session(fx)
    path = tables.scratch(spark, "archive")
    ticks.archive_ticks(_stream(fx, "fx_ticks"), path, tables.scratch(spark, "state")).awaitTermination()
    return spark.read.parquet(path).select("symbol", F.col("time").cast("timestamp_ntz").alias("time"))


@c.query(f"SELECT symbol, time, close, volume FROM ({c._rollup_sql('week')}) WHERE time >= TIMESTAMP '1997-09-01' - INTERVAL 1 MONTH AND time < TIMESTAMP '1997-09-01'")
def x3_incremental_rollup(fx):
    """Weeks within the look-back of the given hour."""
    spark = session(fx)
    path = tables.scratch(spark, "weeks")
    ticks.incremental_rollup(_stream(fx, "fx_factored"), lambda _: fx("fx_factored"), path, tables.scratch(spark, "state"), "week", now="1997-09-01 01:00:00").awaitTermination()
    return c.rounded(tables.read(spark, path), "close").select("symbol", "time", "close", "volume")


@c.query("SELECT symbol, time, CASE WHEN symbol % 8 = 0 AND symbol % 10 <> 9 THEN round(close, 6) ELSE -1 END AS close FROM fx_bars")
def x4_factor_changes(fx):
    """Stored rows of symbols whose factor has moved are computed anew, and only those."""
    spark = session(fx)
    path = tables.scratch(spark, "adjusted")
    moved = F.col("adj_factor") + F.when(F.col("symbol") % 8 == 0, 0.01).otherwise(0.0)
    tables.replace_all(spark, path, ticks.dealt(fx("fx_factored").select("symbol", "time", F.lit(-1.0).alias("close"), moved.alias("adj_factor"))), ["part"])
    job = lambda _, symbols: fx("fx_factored").join(symbols, "symbol", "left_semi").select("symbol", "time", "close", "adj_factor")
    ticks.recompute_on_factor_change(_stream(fx, "fx_adj_factor"), path, tables.scratch(spark, "state"), job).awaitTermination()
    return c.rounded(tables.read(spark, path), "close").select("symbol", "time", "close")

"""Registered queries of streams over several batches, stored order, versions, landing runs, long keys, kernels and gaps of minutes."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import indicators as ind
from ..operators import joins, valuation
from ..operators.scan import affine_scan
from ..sources import landing, tables
from ..streaming import tape, ticks
from . import catalog as c
from . import incremental
from .catalog_jobs import session

# --- ticks that arrive in four files: some come two files late, some are repeated in their file and in the next one ------------

#: Which file a tick comes in, by the day of the month.
_FILE = "CAST(CASE WHEN day(time) <= 8 THEN 0 WHEN day(time) <= 15 THEN 1 WHEN day(time) <= 23 THEN 2 ELSE 3 END AS INT)"
_ARRIVE = f"""k0 AS (SELECT event_id, symbol, time, price, side, {_FILE} AS f FROM fx_ticks),
arrived AS (SELECT event_id, symbol, time, price, side, CASE WHEN event_id % 17 = 0 AND f <= 1 THEN f + 2 ELSE f END AS f FROM k0
  UNION ALL SELECT event_id, symbol, time, price + 1, side, f FROM k0 WHERE event_id % 13 = 0 UNION ALL SELECT event_id, symbol, time, price - 1, side, f + 1 FROM k0 WHERE event_id % 13 = 0 AND f <= 2),
marked AS (SELECT a.*, a.time < (SELECT max(b.time) FROM arrived b WHERE b.f < a.f) - INTERVAL 10 MINUTES AS late FROM (SELECT * FROM arrived) a),
kept AS (SELECT symbol, time, event_id, price, side, f FROM (SELECT *, row_number() OVER (PARTITION BY symbol, time ORDER BY f, event_id, price, side) AS n FROM marked WHERE late IS DISTINCT FROM true) WHERE n = 1)"""


def arrivals(fx) -> DataFrame:
    t = fx("fx_ticks").withColumn("f", F.expr(_FILE))
    late = t.withColumn("f", F.when((F.col("event_id") % 17 == 0) & (F.col("f") <= 1), F.col("f") + 2).otherwise(F.col("f")))
    again = t.where("event_id % 13 = 0")
    return late.unionByName(again.withColumn("price", F.col("price") + 1)).unionByName(again.where("f <= 2").withColumn("f", F.col("f") + 1).withColumn("price", F.col("price") - 1))


def recorded(fx) -> tuple[SparkSession, str]:
    """The tape of four arrivals, each landed by all tasks and read as one batch by a stream that goes on from its checkpoint."""
    spark = session(fx)
    landing, root, checkpoint = (tables.scratch(spark, name) for name in ("landing", "tape", "state"))
    came = arrivals(fx)
    schema = came.drop("f").schema
    for f in range(4):
        came.where(F.col("f") == f).drop("f").write.mode("append").parquet(landing)
        tape.run_tape(spark.readStream.schema(schema).parquet(landing), root, checkpoint).awaitTermination()
    return spark, root


def _ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


@c.query("SELECT symbol, time, event_id, price, f AS batch FROM kept", False, _ARRIVE)
def x1_tape_archive(fx):
    """The first tick of each symbol and time that the watermark admits."""
    spark, root = recorded(fx)
    return tape.read(spark, root, "archive").select("symbol", _ntz("time"), "event_id", "price", "batch")


@c.query("SELECT symbol, time, event_id, price, f AS batch, 'late' AS reason FROM marked WHERE late", False, _ARRIVE)
def x1_tape_late(fx):
    spark, root = recorded(fx)
    return tape.read(spark, root, "late").select("symbol", _ntz("time"), "event_id", "price", "batch", "reason")


@c.query(
    """SELECT symbol, time_bucket(INTERVAL 5 MINUTES, time) AS time, arg_min(price, time) AS open, max(price) AS high, min(price) AS low, arg_max(price, time) AS close, count(*) AS ticks
FROM kept GROUP BY 1, 2 HAVING time_bucket(INTERVAL 5 MINUTES, any_value(time)) + INTERVAL 5 MINUTES <= (SELECT max(time) FROM arrived) - INTERVAL 10 MINUTES""",
    False,
    _ARRIVE,
)
def x2_tape_bars(fx):
    """Bars of the windows that closed, appended batch by batch."""
    spark, root = recorded(fx)
    return tape.read(spark, root, "bars").select("symbol", _ntz("time"), "open", "high", "low", "close", "ticks")


@c.query(
    """SELECT f AS batch, (SELECT max(time) FROM arrived x WHERE x.f <= m.f) - INTERVAL 10 MINUTES AS watermark, count(*) FILTER (late IS DISTINCT FROM true) AS n_admitted,
count(*) FILTER (late IS DISTINCT FROM true) - (SELECT count(*) FROM kept x WHERE x.f = m.f) AS n_repeated, count(*) FILTER (late) AS n_late FROM marked m GROUP BY f""",
    False,
    _ARRIVE,
)
def x2_tape_progress(fx):
    spark, root = recorded(fx)
    return tape.read(spark, root, "progress").select("batch", _ntz("watermark"), "n_admitted", "n_repeated", "n_late")


# --- factors that move in three batches ------------------------------------------------------------------------------------------------

_MOVES = """mv AS (SELECT symbol, max(time) AS time, CAST(symbol % 3 AS INT) AS b FROM fx_bars GROUP BY symbol),
done AS (SELECT symbol, CASE WHEN symbol % 5 = 4 THEN 0 WHEN b = 0 THEN 1 WHEN b = 1 THEN 2 ELSE 0 END AS n FROM mv)"""


@c.query("SELECT b.symbol, b.time, round(b.close * (1 + done.n), 6) AS close FROM fx_bars b JOIN done ON b.symbol = done.symbol", False, _MOVES)
def x4_factor_batches(fx):
    """Three batches of factors: one of new symbols, one where a third have moved, one with late and unmoved ones.  Rows say how often they were computed."""
    spark = session(fx)
    path, checkpoint, landing = (tables.scratch(spark, name) for name in ("adjusted", "state", "factors"))
    last = fx("fx_bars").groupBy("symbol").agg(F.max("time").cast("timestamp").alias("time")).where("symbol % 5 <> 4")
    first = last.where("symbol % 3 <> 2").withColumn("adj_factor", F.lit(1.5))
    moved = last.where("symbol % 3 = 1").select("symbol", (F.col("time") + F.expr("INTERVAL 1 DAY")).alias("time"), F.lit(2.5).alias("adj_factor"))
    nothing = first.withColumn("time", F.when(F.col("symbol") % 3 == 1, F.col("time") - F.expr("INTERVAL 9 DAYS")).otherwise(F.col("time") + F.expr("INTERVAL 9 DAYS")))
    base = fx("fx_bars").select("symbol", F.col("time").cast("timestamp").alias("time"), "close")
    tables.replace_all(spark, path, ticks.dealt(base.withColumn("adj_factor", F.lit(None).cast("double")).withColumn("runs", F.lit(0))), ["part"])
    tables.replace_all(spark, f"{path}-state", ticks.dealt(last.limit(0).withColumn("adj_factor", F.lit(1.0))), ["part"])

    def job(spark: SparkSession, symbols: DataFrame) -> DataFrame:
        before = tables.read(spark, path).join(symbols, "symbol", "left_semi")
        return before.withColumn("runs", F.col("runs") + 1).drop("part")

    for k, batch in enumerate((first, moved, nothing)):
        batch.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(batch.schema).parquet(landing)
        ticks.recompute_on_factor_change(stream, path, checkpoint, job).awaitTermination()
    out = tables.read(spark, path)
    return c.rounded(out.withColumn("close", F.col("close") * (1 + F.col("runs"))), "close").select("symbol", F.col("time").cast("timestamp_ntz").alias("time"), "close")


# --- stored order and versions -------------------------------------------------------------------------------------------------------


@c.query(
    "SELECT 'times rise within a symbol' AS rule, sum(n - 1)::BIGINT AS violations, false AS passed FROM (SELECT symbol, count(*) AS n FROM fx_bars WHERE symbol % 4 = 1 GROUP BY 1) "
    "UNION ALL SELECT 'files of a symbol follow each other', count(*), false FROM (SELECT symbol FROM fx_bars WHERE symbol % 4 = 2 GROUP BY symbol HAVING max(CASE WHEN day(time) % 2 = 0 THEN time END) >= min(CASE WHEN day(time) % 2 = 1 THEN time END) AND max(CASE WHEN day(time) % 2 = 1 THEN time END) >= min(CASE WHEN day(time) % 2 = 0 THEN time END)) "
    "UNION ALL SELECT r, 0, true FROM (SELECT unnest(['symbol is known', 'time is known', 'close is positive', 'volume is not negative']) AS r)"
)
def d7_stored_order(fx):
    """Files in which every fourth symbol's bars are stored backwards, and another fourth's are dealt by odd and even days."""
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "ordered")
    b = fx("fx_bars").select("symbol", "time", "close", "volume")
    by_time = F.when(F.col("symbol") % 4 == 1, -F.unix_date(F.to_date("time"))).otherwise(F.unix_date(F.to_date("time")))
    odd = (F.col("symbol") % 4 == 2) & (F.dayofmonth("time") % 2 == 1)
    for part in (b.where(~odd), b.where(odd)):
        part.repartition(4, "symbol").sortWithinPartitions("symbol", by_time).write.mode("append").parquet(path)
    return c.quality.quality_checks(tables.stored(spark, path), prices=["close"])


@c.query("SELECT symbol, count(*) AS n_rows, min(time) AS first_time, max(time) AS last_time, count(DISTINCT CAST(time AS DATE)) AS n_days, count(DISTINCT (year(time), month(time))) AS n_files FROM fx_bars WHERE time >= '1996-02-10' AND time < '1997-07-05' GROUP BY symbol")
def k7_export_summary(fx):
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "export")
    tables.export(fx("fx_bars"), path, "1996-02-10", "1997-07-04")
    return tables.export_summary(spark, path)


def _stamped(fx, keep: str) -> DataFrame:
    """Stored rows, then new ones for even symbols and one symbol more, stamped; by year."""
    spark, path = session(fx), tables.scratch(fx("supplier").sparkSession, "stamped")
    b = fx("fx_bars").select("symbol", "time", "close", F.year("time").alias("year"))
    tables.write_upsert(spark, path, b.where("symbol <> 4"), ["symbol", "time"], ["year"])
    tables.write_upsert(spark, path, b.where("symbol % 2 = 0 AND year = 1997").withColumn("close", F.col("close") * 2), ["symbol", "time"], ["year"], keep, updated_at=True)
    out = tables.read(spark, path).withColumn("is_stamped", F.col("updated_at") > F.current_timestamp() - F.expr("INTERVAL 1 HOUR"))
    return c.rounded(out, "close").select("symbol", "time", "close", F.coalesce("is_stamped", F.lit(False)).alias("is_stamped"))


_NEWER = "symbol % 2 = 0 AND year(time) = 1997"


@c.query(f"SELECT symbol, time, round(CASE WHEN {_NEWER} THEN close * 2 ELSE close END, 6) AS close, {_NEWER} AS is_stamped FROM fx_bars WHERE symbol <> 4 OR year(time) = 1997")
def k1_write_stamped(fx):
    return _stamped(fx, "last")


@c.query(f"SELECT symbol, time, round(CASE WHEN symbol = 4 THEN close * 2 ELSE close END, 6) AS close, {_NEWER} AS is_stamped FROM fx_bars WHERE symbol <> 4 OR year(time) = 1997")
def k2_write_stamped(fx):
    return _stamped(fx, "first")


# --- landing run by run ---------------------------------------------------------------------------------------------------------------

_LANDED = """raw AS (SELECT symbol, time, close, CAST(symbol % 2 AS INT) AS run, (symbol * 31 + day(time)) % 11 = 0 AS broken, (symbol * 31 + day(time)) % 13 = 0 AS undated, day(time) = 7 AS twice FROM fx_bars),
record AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE twice)"""


def _landed(fx) -> tuple[SparkSession, str]:
    """Two runs over one folder: even symbols' files lie there first, odd ones' come later; some lines are cut off, some have no date, some come twice."""
    spark = session(fx)
    folder, target = tables.scratch(spark, "landing"), tables.scratch(spark, "daily")
    b = fx("fx_bars").withColumn("k", F.col("symbol") * 31 + F.dayofmonth("time"))
    stamp = F.when(F.col("k") % 13 == 0, "never").otherwise(F.date_format("time", "yyyyMMdd"))
    line = F.to_json(F.struct(F.col("symbol").cast("string").alias("ts_code"), stamp.alias("trade_date"), F.col("close").cast("string").alias("close")))
    cut = F.concat(F.lit('{"ts_code":"'), F.col("symbol").cast("string"), F.lit('","trade_date":"'), F.date_format("time", "yyyyMMdd"))
    lines = b.select("symbol", F.when(F.col("k") % 11 == 0, cut).otherwise(line).alias("value"), (F.dayofmonth("time") == 7).alias("twice"))
    lines = lines.unionByName(lines.where("twice")).persist(StorageLevel.DISK_ONLY)  # for both runs
    for odd in (0, 1):
        lines.where(F.col("symbol") % 2 == odd).select("value").repartition(2).write.mode("append").text(folder)
        landing.land_new(spark, folder, "daily", target)
    lines.unpersist()
    return spark, target


@c.query("SELECT CAST(symbol AS VARCHAR) AS symbol, time, round(close, 6) AS close FROM raw WHERE NOT broken AND NOT undated", False, _LANDED)
def s1_landing_rows(fx):
    spark, target = _landed(fx)
    return c.rounded(tables.read(spark, target), "close").select("symbol", F.col("time").cast("timestamp_ntz").alias("time"), "close")


@c.query(
    """SELECT run AS batch, 2 AS n_files, count(*) AS n_records, count(*) FILTER (NOT broken AND NOT undated) AS n_rows, count(*) FILTER (broken OR undated) AS n_rejects,
count(*) FILTER (NOT broken AND NOT undated) - (SELECT count(*) FROM raw x WHERE x.run = r.run AND NOT broken AND NOT undated) AS n_repeated FROM record r GROUP BY run""",
    False,
    _LANDED,
)
def s1_landing_runs(fx):
    """The second run reads the second files alone, and rows and rejects make up the records."""
    return landing.runs(*_landed(fx)).select("batch", "n_files", "n_records", "n_rows", "n_rejects", "n_repeated")


@c.query("SELECT run AS batch, CASE WHEN broken THEN 'can''t be parsed' ELSE 'no time' END AS reason, CAST(symbol AS VARCHAR) AS symbol, count(*) AS n FROM record WHERE broken OR undated GROUP BY 1, 2, 3", False, _LANDED)
def s1_landing_rejects(fx):
    r = landing.rejects(*_landed(fx))
    return r.groupBy("batch", "reason", F.regexp_extract("record", '"ts_code":"([0-9]+)"', 1).alias("symbol")).agg(F.count("*").alias("n"))


# --- long keys, kernels, gaps ---------------------------------------------------------------------------------------------------------

_HOT = "hot AS (SELECT CASE WHEN symbol % 2 = 0 THEN 0 ELSE symbol END AS symbol, CAST(time AS TIMESTAMP) + to_seconds(symbol) AS time, close FROM fx_bars)"


def _hot(fx) -> DataFrame:
    """Bars of which one symbol has half."""
    at = F.timestamp_add("SECOND", F.col("symbol").cast("int"), F.col("time").cast("timestamp"))
    return fx("fx_bars").select(F.when(F.col("symbol") % 2 == 0, 0).otherwise(F.col("symbol")).cast("long").alias("symbol"), at.alias("time"), "close")


def _read(df: DataFrame) -> DataFrame:
    return df.withColumn("time", F.col("time").cast("timestamp_ntz"))


@c.query(
    "SELECT q.symbol, q.time, round(g.netprofit_yoy, 6) AS netprofit_yoy, g.end_date AS period FROM hot q ASOF LEFT JOIN (SELECT symbol, ann_date, max(end_date) AS end_date, arg_max(netprofit_yoy, end_date) AS netprofit_yoy "
    "FROM (SELECT CASE WHEN symbol % 2 = 0 THEN 0 ELSE symbol END AS symbol, ann_date + to_seconds(symbol) AS ann_date, end_date, netprofit_yoy FROM fx_growth WHERE netprofit_yoy IS NOT NULL) GROUP BY 1, 2) g ON q.symbol = g.symbol AND q.time >= g.ann_date",
    False,
    _HOT,
)
def j2_asof_ranges(fx):
    """Half of all rows of one symbol, read by a task for each 500 rows."""
    g = fx("fx_growth").where("netprofit_yoy IS NOT NULL")
    right = g.select(F.when(F.col("symbol") % 2 == 0, 0).otherwise(F.col("symbol")).cast("long").alias("symbol"), F.timestamp_add("SECOND", F.col("symbol").cast("int"), F.col("ann_date").cast("timestamp")).alias("ann_date"), F.col("end_date").alias("period"), "netprofit_yoy")
    out = joins.asof_join(_hot(fx), right, "time", "ann_date", ["symbol"], tie=["period"], rows=500)
    return _read(c.rounded(out, "netprofit_yoy")).select("symbol", "time", "netprofit_yoy", "period")


@c.query(
    "SELECT symbol, time, round(list_sum(list_transform(range(len(l)), lambda i: l[i + 1] * 0.5 ** (len(l) - 1 - i) * CASE WHEN i = 0 AND n <= 80 THEN 1 ELSE 0.5 END)), 6) AS y "
    "FROM (SELECT symbol, time, list(close) OVER w AS l, row_number() OVER (PARTITION BY symbol ORDER BY time) AS n FROM hot WINDOW w AS (PARTITION BY symbol ORDER BY time ROWS 79 PRECEDING))",
    False,
    _HOT,
)
def r1_scan_ranges(fx):
    """A recurrence over a symbol with half of all rows, in two phases."""
    return _read(c.rounded(affine_scan(_hot(fx), "close", 0.5, "y", rows=500), "y")).select("symbol", "time", "y")


@c.query(
    f"SELECT symbol, time, CASE WHEN n >= 200 THEN {c.sc('100.0 * list_sum(list_transform(l, lambda v: CASE WHEN v < close THEN 1 ELSE 0 END)) / len(l)')} END AS close_pct_300d "
    "FROM (SELECT symbol, time, close, list(close) OVER w AS l, count(*) OVER w AS n FROM hot WINDOW w AS (PARTITION BY symbol ORDER BY time ROWS 299 PRECEDING))",
    False,
    _HOT,
)
def v1_percentile_ranges(fx):
    """A sliding percentile of a symbol with half of all rows, cut with overlap."""
    out = valuation.rolling_percentile(_hot(fx), ["close"], [300], min_rows=200, rows=1000)
    return _read(c.rounded(out, "close_pct_300d")).select("symbol", "time", "close_pct_300d")


@c.query("SELECT symbol, time, CASE WHEN count(*) OVER w = 10 THEN round(list_sum(list_transform(range(10), lambda i: (list(close) OVER w)[i + 1] * (i + 1))) / 55, 6) END AS wma_10 FROM hot WINDOW w AS (PARTITION BY symbol ORDER BY time ROWS 9 PRECEDING)", False, _HOT)
def y2_kernel(fx):
    """A user's kernel in pandas: the mean of ten closes by linear weights."""

    def wma(frame):
        import numpy as np

        x, weights = frame["close"].to_numpy(), np.arange(1, 11)
        y = np.full(len(x), np.nan)
        if len(x) >= 10:
            y[9:] = np.lib.stride_tricks.sliding_window_view(x, 10) @ weights / weights.sum()
        return frame.assign(wma_10=y)

    ind.register_indicator("wma_10", lambda: ind.Kernel("wma_10", "wma_10 double", wma, warmup=10, rows=1000))
    try:
        out = ind.apply_batch(_hot(fx), ["wma_10"])
    finally:
        del ind.REGISTRY["wma_10"]
    return _read(c.rounded(out, "wma_10")).select("symbol", "time", "wma_10")


_MARKET = "CASE symbol % 4 WHEN 0 THEN 'CN' WHEN 1 THEN 'HK' WHEN 2 THEN 'US' ELSE 'JP' END"
_MINUTES = f"""sy AS (SELECT DISTINCT symbol, {_MARKET} AS market FROM fx_ticks),
zone AS (SELECT * FROM (VALUES ('CN', 8, 570, 690), ('CN', 8, 780, 900), ('HK', 8, 570, 720), ('HK', 8, 780, 960), ('US', -5, 570, 960), ('JP', 9, 540, 690), ('JP', 9, 750, 900)) v(market, hours, a, b)),
od AS (SELECT DISTINCT market, CAST(time AS DATE) AS day FROM fx_ticks, (SELECT DISTINCT market FROM zone) WHERE isodow(time) < 6 AND (day(time) + ord(market)) % 9 <> 0),
expected AS (SELECT symbol, CAST(day AS TIMESTAMP) + to_minutes(CAST(m AS INT)) - to_hours(hours) AS minute FROM sy JOIN zone USING (market) JOIN od USING (market), range(1440) r(m) WHERE m BETWEEN a AND b),
lacking AS (SELECT symbol, minute, k - row_number() OVER (PARTITION BY symbol ORDER BY minute) AS island FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY minute) AS k FROM expected)
  WHERE (symbol, minute) NOT IN (SELECT (symbol, date_trunc('minute', time)) FROM fx_ticks))"""


@c.query("SELECT symbol, min(minute) AS fetch_from, max(minute) AS fetch_to, count(*) AS n_minutes FROM lacking GROUP BY symbol, island", False, _MINUTES)
def i7_minute_gaps(fx):
    """Minutes of four markets' sessions on open days without a tick, a row for each run of them."""
    t = fx("fx_ticks").withColumn("time", F.col("time").cast("timestamp"))
    market = F.when(F.col("symbol") % 4 == 0, "CN").when(F.col("symbol") % 4 == 1, "HK").when(F.col("symbol") % 4 == 2, "US").otherwise("JP")
    days = t.where(F.weekday("time") < 5).select(F.to_date("time").alias("day")).distinct().select("day", F.explode(F.array(*[F.lit(m) for m in ("CN", "HK", "US", "JP")])).alias("market"))
    out = incremental.minute_gaps(t.select("symbol", market.alias("market")).distinct(), t, days.where((F.dayofmonth("day") + F.ascii("market")) % 9 != 0))
    return out.withColumns({k: F.col(k).cast("timestamp_ntz") for k in ("fetch_from", "fetch_to")})


def _in_session(hours: int, *sessions: tuple[int, int]) -> str:
    local = f"(time + INTERVAL ({hours}) HOUR)"
    inside = " OR ".join(f"hour{local} * 60 + minute{local} BETWEEN {a} AND {b}" for a, b in sessions)
    return f"isodow{local} < 6 AND ({inside})"


@c.query(f"SELECT event_id, CAST(time + INTERVAL 8 HOUR AS DATE) = CAST(time + INTERVAL 11 HOUR AS DATE) AND {_in_session(11, (570, 690), (780, 900))} AS daily_overwrite FROM fx_ticks")
def i8_overwrite_daily(fx):
    """Whether today's row is still being formed three hours after a tick."""
    t = fx("fx_ticks").withColumn("time", F.col("time").cast("timestamp"))
    return t.select("event_id", incremental.overwrite_latest(F.col("time"), F.col("time") + F.expr("INTERVAL 3 HOURS"), "daily").alias("daily_overwrite"))


@c.query(f"SELECT event_id, {_in_session(8, (570, 690), (780, 900))} AS cn, {_in_session(8, (570, 720), (780, 960))} AS hk, {_in_session(-5, (570, 960))} AS us, {_in_session(9, (540, 690), (750, 900))} AS jp FROM fx_ticks")
def t10_markets(fx):
    t = fx("fx_ticks").withColumn("time", F.col("time").cast("timestamp"))
    return t.select("event_id", *[calendar.is_trading_time(F.col("time"), m).alias(m.lower()) for m in ("CN", "HK", "US", "JP")])

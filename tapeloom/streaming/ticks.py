"""Ticks as they come: archive, bars, rollups kept current, and recomputation when factors change."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.resample import bucket, rollup_bars
from ..operators.summary import latest_row
from ..plans.incremental import TOLERANCE
from ..sources.tables import exists, read, write_upsert

#: How far back late bars still count, by rollup, and how old a bucket must be.
LOOK_BACK = {"week": "1 month", "month": "3 months"}
LAG = "1 hour"
FREQUENCIES = ("1 minute", "5 minutes", "15 minutes", "30 minutes", "60 minutes")


def archive_ticks(ticks: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", trigger: dict | None = None) -> StreamingQuery:
    """Ticks, one a symbol and time, to Parquet partitioned by day; repeats within the watermark are dropped."""
    unique = ticks.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", late).dropDuplicatesWithinWatermark(["symbol", "time"]).withColumn("date", F.to_date("time"))
    return unique.writeStream.format("parquet").partitionBy("date").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def ticks_to_bars(ticks: DataFrame, every: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Tumbling bars from ticks (symbol, time, price, optional volume); works on streams and tables alike."""
    source = ticks.withWatermark("time", late) if ticks.isStreaming else ticks
    volume = F.sum("volume") if "volume" in ticks.columns else F.count("*")
    bars = source.groupBy("symbol", F.window("time", every).alias("w")).agg(
        F.min_by("price", "time").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "time").alias("close"), volume.alias("volume"), F.count("*").alias("ticks")
    )
    return bars.select("symbol", F.col("w.start").alias("time"), "open", "high", "low", "close", "volume", "ticks")


def incremental_rollup(bars: DataFrame, base: Callable[[SparkSession], DataFrame], path: str, checkpoint: str, unit: str = "week", trigger: dict | None = None, now: str | None = None) -> StreamingQuery:
    """Keep a rollup current: of each batch's buckets, those within the look-back and at least ``LAG`` old are computed anew from the base table and upserted.

    Both are measured against the clock (or ``now``), so late data further back are ignored.  The target is partitioned by the bucket's year, and only years that a batch touches are read and rewritten."""
    clock = F.lit(now).cast("timestamp") if now else F.current_timestamp()

    def batch(new: DataFrame, _: int) -> None:
        spark = new.sparkSession
        touched = new.select("symbol", bucket(unit).alias("__bucket")).distinct()
        settled = clock - F.expr(f"INTERVAL {LAG}")
        touched = touched.where((F.col("__bucket") >= settled - F.expr(f"INTERVAL {LOOK_BACK[unit]}")) & (F.col("__bucket") < settled))
        if touched.isEmpty():
            return
        rows = base(spark).withColumn("__bucket", bucket(unit)).join(touched, ["symbol", "__bucket"], "left_semi").drop("__bucket")
        write_upsert(spark, path, rollup_bars(rows, unit).withColumn("year", F.year("time")), ["symbol", "time"], ["year"])

    return bars.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def dealt(df: DataFrame, parts: int = 64) -> DataFrame:
    """Rows with ``part``, the hash partition of their symbol."""
    return df.withColumn("part", F.pmod(F.xxhash64(F.col("symbol").cast("string")), F.lit(parts)).cast("int"))


def recompute_on_factor_change(factors: DataFrame, path: str, checkpoint: str, job: Callable[[SparkSession, DataFrame], DataFrame], keys: Sequence[str] = ("symbol", "time"), parts: int = 64, trigger: dict | None = None) -> StreamingQuery:
    """Symbols whose latest factor differs from the one they were last processed with are recomputed by ``job(spark, symbols)`` and upserted into ``path``.

    What is known of a symbol between batches is one row of ``{path}-state``: its last processed factor and that one's time.  Target and state are dealt into the same
    ``parts`` hash partitions (column ``part``), so a batch reads and writes only those of its own symbols, however large both tables are.
    The target is one of ``tables.read``, with ``part`` from ``dealt``.  Where there is a target but no state, the state is built from it once.  A factor that comes late, of an earlier time than the processed one, changes
    nothing.  The target is written before the state: a batch that stops between them is done again, with the same rows.
    """
    state = f"{path}-state"

    def batch(new: DataFrame, _: int) -> None:
        spark = new.sparkSession
        now = dealt(latest_row(new.select("symbol", "time", "adj_factor").where("symbol IS NOT NULL AND time IS NOT NULL"), ["symbol"]), parts)
        touched = [r.part for r in now.select("part").distinct().collect()]  # at most ``parts``
        if not touched:
            return
        if not exists(spark, state):
            done = dealt(latest_row(read(spark, path).select("symbol", "time", "adj_factor"), ["symbol"]), parts) if exists(spark, path) else now.limit(0)
            write_upsert(spark, state, done, ["symbol"], ["part"])
        done = read(spark, state).where(F.col("part").isin(touched)).select("symbol", F.col("time").alias("__then"), F.col("adj_factor").alias("__factor"))
        moved = F.col("__then").isNull() | ((F.col("time") >= F.col("__then")) & (F.abs(F.coalesce("adj_factor", F.lit(1.0)) - F.coalesce("__factor", F.lit(1.0))) > TOLERANCE))
        changed = now.join(done, "symbol", "left").where(moved).select("symbol", "time", "adj_factor", "part")
        write_upsert(spark, path, dealt(job(spark, changed.select("symbol")), parts), list(keys), ["part"])
        write_upsert(spark, state, changed, ["symbol"], ["part"])

    return factors.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

"""A tape of ticks kept over many batches and restarts: archive, bars of closed windows, late ticks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import exists, folders, remove
from .ticks import ticks_to_bars

#: Tables of a tape, each in folders by batch; ``progress`` is written last and says that a batch is whole.
PARTS = ("archive", "bars", "late", "open", "progress")


def _windows(ticks: DataFrame, every: str, condition: str) -> DataFrame:
    """Ticks of windows whose end, ``w``, meets a condition."""
    return ticks.withColumn("__w", F.window("time", every)).withColumn("w", F.col("__w.end")).where(condition).select(*ticks.columns)


def _sql(time: dt.datetime) -> str:
    since = time.astimezone(dt.UTC) - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
    return f"timestamp_micros({since // dt.timedelta(microseconds=1)})"


def _progress(spark: SparkSession, root: str, batch: int):
    path = f"{root}/progress/batch={batch}"
    return spark.read.parquet(path).first() if batch >= 0 and exists(spark, path) else None


def run_tape(ticks: DataFrame, root: str, checkpoint: str, every: str = "5 minutes", late: str = "10 minutes", trigger: dict | None = None) -> StreamingQuery:
    """Put a stream of ticks (symbol, time, price, optional volume and more) to ``root``, each tick to exactly one of its tables.

    A batch's watermark is the greatest time of all batches before it less ``late``.  A tick of an earlier time, or without symbol or time, goes
    to ``late`` with the reason.  Of the others the first of a symbol and time goes to ``archive``, by date; further ones are repeats, which ``progress``
    counts.  ``bars`` gets the bars of a window once the watermark has passed its end: no admitted tick can change them then, so nothing is ever rewritten.

    What outlives a batch is ``open``: the ticks of windows that haven't closed, which also hold every key that a repeat can still meet.  Its size
    depends on ``late`` and ``every``, not on what has been archived.  All tables of a batch are written under its number and overwritten if the
    batch is run again after a stop, and ``read`` shows whole batches only, so ticks count once.
    """
    spark = ticks.sparkSession
    if exists(spark, f"{root}/progress") and not exists(spark, f"{checkpoint}/commits"):
        raise ValueError(f"{root} holds batches of another checkpoint")

    def batch(new: DataFrame, n: int) -> None:
        spark = new.sparkSession
        before = _progress(spark, root, n - 1)
        watermark = before.watermark if before else None
        rows = new.withColumn("time", F.col("time").cast("timestamp"))
        usable = F.col("symbol").isNotNull() & F.col("time").isNotNull()
        in_time = usable & (F.lit(True) if watermark is None else F.col("time") >= F.lit(watermark))
        put = lambda df, part, *by: df.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/{part}/batch={n}")
        put(rows.where(~in_time).withColumn("reason", F.when(usable, "late").otherwise("no symbol or time")), "late")

        live = rows.where(in_time).withColumn("__fresh", F.lit(True))
        if before:
            still = spark.read.parquet(f"{root}/open/batch={n - 1}")
            live = live.unionByName((still if watermark is None else _windows(still, every, f"w > {_sql(watermark)}")).withColumn("__fresh", F.lit(False)).drop("fresh", "seen"))
        rest = [c for c in live.columns if c not in ("symbol", "time", "__fresh")]
        first = live.groupBy("symbol", "time").agg(F.min(F.struct("__fresh", *rest)).alias("__r"), F.count(F.when(F.col("__fresh"), 1)).alias("seen"))
        put(first.select("symbol", "time", *[F.col("__r")[c].alias(c) for c in rest], F.col("__r.__fresh").alias("fresh"), "seen"), "open")

        held = spark.read.parquet(f"{root}/open/batch={n}")
        newest, admitted, archived = held.agg(F.max("time"), F.coalesce(F.sum("seen"), F.lit(0)), F.count(F.when(F.col("fresh"), 1))).first()
        after = watermark
        if newest is not None:
            reached = spark.range(1).select(F.lit(newest) - F.expr(f"INTERVAL {late}")).first()[0]
            after = reached if watermark is None else max(watermark, reached)
        ticks = held.drop("fresh", "seen")
        put(held.where("fresh").drop("fresh", "seen").withColumn("date", F.to_date("time")), "archive", "date")
        closed = ticks.limit(0) if after is None else _windows(ticks, every, f"w <= {_sql(after)}")
        put(ticks_to_bars(closed, every), "bars")
        n_late, n_bars = spark.read.parquet(f"{root}/late/batch={n}").count(), spark.read.parquet(f"{root}/bars/batch={n}").count()
        counted = {"n_admitted": admitted, "n_repeated": admitted - archived, "n_late": n_late, "n_bars": n_bars}
        put(spark.range(1).select(F.lit(after).cast("timestamp").alias("watermark"), *[F.lit(v).cast("long").alias(k) for k, v in counted.items()]), "progress")
        remove(spark, f"{root}/open/batch={n - 2}")

    return ticks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def last_batch(spark: SparkSession, root: str) -> int:
    """The last whole batch; -1 if there is none."""
    return max((int(name.split("=")[1]) for name in folders(spark, f"{root}/progress")), default=-1)


def read(spark: SparkSession, root: str, part: str) -> DataFrame:
    """One of ``PARTS`` over all whole batches, with ``batch``; ``open`` is that of the last one."""
    if part not in PARTS:
        raise ValueError(f"no part {part!r}; there are {PARTS}")
    last = last_batch(spark, root)
    if last < 0:
        raise ValueError(f"{root} has no whole batch")
    rows = spark.read.parquet(f"{root}/{part}")
    return rows.where(F.col("batch") == last).drop("fresh", "seen") if part == "open" else rows.where(F.col("batch") <= last)


def open_bars(spark: SparkSession, root: str, every: str = "5 minutes") -> DataFrame:
    """Bars of the windows that haven't closed, as far as their ticks have come."""
    watermark: dt.datetime | None = _progress(spark, root, last_batch(spark, root)).watermark
    ticks = read(spark, root, "open").drop("batch")
    return ticks_to_bars(ticks if watermark is None else _windows(ticks, every, f"w > {_sql(watermark)}"), every)

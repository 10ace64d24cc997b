"""Long keys cut into consecutive ranges of time, so that one key's rows spread over tasks; joins with small tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Dimension tables up to so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Rows that a task gets, about, where keys are dealt to tasks.
TASK_ROWS = 250_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def matched(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join by equal columns in which null equals null; ``right`` goes out to the tasks if it is small."""
    other = small(right.withColumnsRenamed({c: f"__on_{c}" for c in on}))
    return left.join(other, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__on_{c}")) for c in on]), how).drop(*[f"__on_{c}" for c in on])


def spread(df: DataFrame, by: Sequence[str], rows: int = TASK_ROWS) -> DataFrame:
    """``df`` dealt by key to as many tasks as get about ``rows`` rows each, so what a task sorts or aggregates doesn't grow with the table.

    Windows and aggregates by these keys, or by more, need no further shuffle.  Costs one count; tables of at most ``rows`` rows, and streams, stay as they are.
    """
    tasks = 1 if df.isStreaming else ceil(df.select(*by).count() / rows)
    return df if tasks < 2 else df.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism), *by)


def has_long_key(df: DataFrame, by: Sequence[str], rows: int) -> bool:
    """Whether any key has more than ``rows`` rows: one count by key, combined before its shuffle."""
    return not df.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > rows).isEmpty()


def cut(df: DataFrame, by: Sequence[str], time: str, rows: int, overlap: int = 0, bucket: str = "day") -> DataFrame:
    """``df`` with ``__range``, the number of the row's range: consecutive in time within a key, and begun anew after about ``rows`` rows.

    Buckets of time (``day``, ``month``, ``hour`` ...) stay whole, so a range has at most ``rows`` rows and those of one bucket more.  With ``overlap`` (``rows`` at
    most) a range also gets at least so many of the rows before it, as far as there are; ``__own`` says which rows are the range's own.  Null times come first.

    The buckets are counted in one aggregate, combined before its shuffle; no row is sorted, and the counts go out to the tasks while they are few.
    """
    if overlap > rows:
        raise ValueError("an overlap can't be longer than a range")
    keys = list(by)
    placed = df.withColumn("__bucket", F.date_trunc(bucket, F.col(time).cast("timestamp")))
    counts = placed.groupBy(*keys, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy(F.col("__bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn("__range", F.floor(F.col("__start") / rows))
    if not overlap:
        return matched(placed, counts.select(*keys, "__bucket", "__range"), [*keys, "__bucket"]).drop("__bucket")
    # a bucket is also wanted by the next ranges, two at most, that begin less than ``overlap`` rows after its end
    whole = Window.partitionBy(*keys, "__range")
    counts = counts.withColumn("__end", F.col("__start") + F.col("__n")).withColumn("__first", F.min("__start").over(whole))
    firsts = Window.partitionBy(*keys).orderBy("__range").rangeBetween(1, Window.unboundedFollowing)
    later = F.slice(F.array_distinct(F.collect_list(F.struct("__range", "__first")).over(firsts)), 1, 2)
    counts = counts.withColumn("__to", F.transform(F.filter(later, lambda r: r["__first"] - F.col("__end") < overlap), lambda r: r["__range"]))
    counts = counts.select(*keys, "__bucket", F.explode(F.concat(F.array("__range"), "__to")).alias("__to"), "__range")
    counts = counts.select(*keys, "__bucket", F.col("__to").alias("__range"), (F.col("__to") == F.col("__range")).alias("__own"))
    return matched(placed, counts, [*keys, "__bucket"]).drop("__bucket")

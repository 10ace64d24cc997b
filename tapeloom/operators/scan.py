"""First-order linear recurrences over ordered rows, without a recursive plan."""

from __future__ import annotations

from collections.abc import Sequence
from math import log

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .kernels import importable
from .ranges import cut, matched

#: Weight of a block too far back to change a double.
NOTHING = 1e-22


def affine_scan(df: DataFrame, value: str, alpha: float, out: str, key: str = "symbol", order: str = "time", seed: str = "first", span: int = 1, block: int = 1024, rows: int | None = None, bucket: str = "day") -> DataFrame:
    """Adds ``out`` with y(t) = (1 - alpha) * y(t-1) + alpha * x(t) for each key.

    ``seed="first"`` starts at the first non-null value; ``seed="sma"`` starts at row ``span`` of the non-null values with their mean, rows
    before it are null.  Null values are left out of the recurrence and carry the last y.

    Non-null rows are numbered and cut into blocks.  Within a block, y is a prefix sum of inputs weighted by powers of 1 - alpha,
    and blocks are short enough for these not to overflow.  The carry into a block is y at the end of the block before: a sum over the
    ends of earlier blocks, taken by doubling (the last one, two, four blocks) until what is further back weighs less than ``NOTHING``.
    All windows are by key, so one shuffle serves every scan of a chain; no row is joined and no array is built.

    With ``rows`` a key is cut into ranges of time of about so many rows (``order`` is a date or time then), which different tasks scan in two phases: each
    range on its own, from nothing, and then a table of one row a range, in which a range's end is what it has made plus what it got, faded by its length.
    Joined back, what a range got fades along its rows.
    """
    d = 1.0 - alpha
    block = max(1, min(block, int(600 / -log(d)))) if 0 < d < 1 else 1
    x = F.col(value).cast("double")
    start = span if seed == "sma" else 1
    if rows is None:
        by_key = Window.partitionBy(key)
        rows_ = df.withColumn("__k", F.when(x.isNotNull(), F.count(x).over(by_key.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))))
        first = F.avg(F.when(F.col("__k") <= span, x)).over(by_key) if seed == "sma" else x
        n = F.col("__k") - start  # 0 at the seed
        local, groups = n, [key]
    else:
        groups = [key, "__range"]
        by_key = Window.partitionBy(*groups)
        ranged = cut(df, [key], order, rows, bucket=bucket)
        earlier = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
        counted = ranged.groupBy(*groups).agg(F.count(x).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
        rows_ = matched(ranged, counted, groups)
        rows_ = rows_.withColumn("__k", F.when(x.isNotNull(), F.col("__before") + F.count(x).over(by_key.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))))
        first = x
        if seed == "sma":
            rows_ = matched(rows_, rows_.where(F.col("__k") <= span).groupBy(key).agg(F.avg(x).alias("__first")), [key], "left")
            first = F.col("__first")
        n = F.col("__k") - start
        local = F.col("__k") - F.greatest(F.lit(start), F.col("__before") + 1)  # 0 at the range's first row that counts
    sofar = by_key.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows_ = rows_.withColumn("__a", F.when(n == 0, first).when(n > 0, x * alpha)).withColumn("__b", F.floor(local / block)).withColumn("__i", local % block)
    within = Window.partitionBy(*groups, "__b")
    power = lambda e: F.pow(F.lit(d), e)
    total = F.sum(F.col("__a") * power(-F.col("__i"))).over(within.orderBy("__k").rowsBetween(Window.unboundedPreceding, 0))
    rows_ = rows_.withColumn("__s", total * power(F.col("__i")) if block > 1 else F.col("__a"))
    in_order = by_key.orderBy("__b", "__k")  # null values, and rows before the seed, come first
    rows_ = rows_.withColumn("__y", F.when(F.col("__a").isNotNull() & (F.col("__i") == block - 1), F.col("__s")))
    step = block
    while d > 0 and d**step > NOTHING and step < 1 << 30:
        rows_ = rows_.withColumn("__y", F.col("__y") + F.coalesce(F.lag("__y", step).over(in_order), F.lit(0.0)) * d**step)
        step *= 2
    carry = F.coalesce(F.last("__y", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows_ = rows_.withColumn(out, F.when(F.col("__a").isNotNull(), F.col("__s") + carry * power(F.col("__i") + 1)))
    if rows is not None:
        rows_ = matched(rows_, _carries(rows_, key, out, d), groups, "left")
        rows_ = rows_.withColumn(out, F.col(out) + F.coalesce("__in", F.lit(0.0)) * power((local + 1).cast("double")))
    filled = F.last(out, ignorenulls=True).over(sofar)
    rows_ = rows_.withColumn(out, filled if rows is None else F.coalesce(filled, "__in"))
    return rows_.drop("__k", "__a", "__b", "__i", "__s", "__y", "__range", "__before", "__first", "__in")


def _carries(scanned: DataFrame, key: str, out: str, d: float) -> DataFrame:
    """(key, __range, __in): y at the end of the range before, null where the recurrence hasn't begun.  A key's ranges, one row each, are folded in order, once over."""
    ends = scanned.groupBy(key, "__range").agg(F.count("__a").alias("n"), F.max_by(out, F.when(F.col("__a").isNotNull(), F.col("__k"))).alias("y"))
    importable(scanned.sparkSession)
    kind = ends.schema[key].dataType

    def fold(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[("__range", "ascending")]))
        got, y = [], None
        for n, own in zip(table.column("n").to_pylist(), table.column("y").to_pylist()):
            got.append(y)
            if n:
                y = own + (y or 0.0) * d**n
        return pa.table({key: table.column(key), "__range": table.column("__range"), "__in": pa.array(got, pa.float64())})

    return ends.groupBy(key).applyInArrow(fold, StructType([StructField(key, kind), StructField("__range", LongType()), StructField("__in", DoubleType())]))


def keep_columns(df: DataFrame, like: DataFrame, extra: Sequence[str]) -> DataFrame:
    """``like``'s columns and the extra ones; working columns go."""
    return df.select(*like.columns, *[c for c in extra if c not in like.columns])

"""Joins of market data: factors, point-in-time rows, statements, memberships, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import BROADCAST_ROWS, cut, matched, small


def bars_with_factor(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Bars with the factor of the same symbol and time, 1 where there is none."""
    bars = bars.drop("adj_factor")
    return bars.join(factors.select("symbol", "time", "adj_factor"), ["symbol", "time"], "left").withColumn("adj_factor", F.coalesce("adj_factor", F.lit(1.0)))


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, by: Sequence[str] = (), tie: Sequence[str] = (), prefix: str = "", rows: int | None = None, bucket: str = "day") -> DataFrame:
    """Each left row with the last right row of the same key at or before its time; unmatched ones with nulls.

    Both sides are laid in one stream by key and time, right rows first at equal times (``tie`` orders equal right times), and
    the last right row so far is carried forward as a whole, so a matched row's nulls stay null.  One shuffle, no row is compared with another.

    With ``rows`` a key is cut into ranges of time of about so many rows (``ranges.cut``), which different tasks read; the last right row of each
    range, one row a range, is carried over to the next ones in a second small pass.  So a key with half of all rows, or no key at all, spreads over tasks.
    """
    keys = list(by)
    payload = [c for c in right.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in payload])
    kind = right.select(packed.alias("p")).schema["p"].dataType
    row = F.struct(*[F.col(c) for c in left.columns if c not in keys])
    row_kind = left.select(row.alias("p")).schema["p"].dataType
    tie_cols = [F.col(c) for c in tie]
    a = left.select(*keys, F.col(left_time).cast("timestamp").alias("__at"), F.lit(1).alias("__side"), *[F.lit(None).cast(right.schema[c].dataType).alias(f"__tie{i}") for i, c in enumerate(tie)], row.alias("__left"), F.lit(None).cast(kind).alias("__right"))
    b = right.where(F.col(right_time).isNotNull()).select(*keys, F.col(right_time).cast("timestamp").alias("__at"), F.lit(0).alias("__side"), *[c.alias(f"__tie{i}") for i, c in enumerate(tie_cols)], F.lit(None).cast(row_kind).alias("__left"), packed.alias("__right"))
    ties = [f"__tie{i}" for i in range(len(tie))]
    stream, groups = a.unionByName(b), keys
    if rows is not None:
        stream, groups = cut(stream, keys, "__at", rows, bucket=bucket), [*keys, "__range"]
    w = Window.partitionBy(*groups).orderBy("__at", "__side", *ties).rowsBetween(Window.unboundedPreceding, 0)
    out = stream.withColumn("__hit", F.last("__right", ignorenulls=True).over(w)).where("__side = 1")
    if rows is not None:
        ends = stream.groupBy(*groups).agg(F.max_by("__right", F.when(F.col("__side") == 0, F.struct("__at", *ties))).alias("__end"))
        earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
        out = matched(out, ends.withColumn("__carried", F.last("__end", ignorenulls=True).over(earlier)).drop("__end"), groups).withColumn("__hit", F.coalesce("__hit", "__carried"))
    taken = set(left.columns)
    return out.select(*keys, *[F.col("__left")[c].alias(c) for c in left.columns if c not in keys], *[F.col("__hit")[c].alias(prefix + c) for c in payload if prefix + c not in taken])


def merge_statements(indicator: DataFrame, balance: DataFrame | None = None, cashflow: DataFrame | None = None, income: DataFrame | None = None, keys: Sequence[str] = ("ts_code", "end_date")) -> DataFrame:
    """Indicator rows with the other statements' columns; a name already present gets the suffix _bs, _cf or _inc."""
    out = indicator
    for other, suffix in ((balance, "_bs"), (cashflow, "_cf"), (income, "_inc")):
        if other is not None:
            clash = {c: c + suffix for c in other.columns if c in out.columns and c not in keys}
            out = out.join(other.withColumnsRenamed(clash), list(keys), "left")
    return out


def with_membership(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows by symbol with the symbol's current industries, null where it has none."""
    current = members.where(F.col("is_new") == "Y") if "is_new" in members.columns else members
    levels = [c for c in ("l1_code", "l1_name", "l2_code", "l2_name", "l3_code", "l3_name") if c in members.columns]
    return rows.join(small(current.select(F.col("ts_code").alias("symbol"), *levels)), "symbol", "left")


def industry_dimension(config: DataFrame, members: DataFrame) -> DataFrame:
    """Configured industries with the codes of the current member row of the smallest l3_code."""
    levels = [c for c in ("l1_code", "l1_name", "l2_code", "l2_name", "l3_code", "l3_name") if c in members.columns]
    order = [c for c in ("l3_code", "l2_name", "l1_name") if c in levels]
    current = members.where((F.col("is_new") == "Y") & F.col("l3_name").isNotNull()).select(*levels)
    first = current.withColumn("__n", F.row_number().over(Window.partitionBy("l3_name").orderBy(*order))).where("__n = 1").drop("__n")
    present = first.withColumn("__here", F.lit(True))
    return config.join(present, "l3_name", "left").withColumn("is_present_in_members", F.coalesce("__here", F.lit(False))).drop("__here")


def phase_industries(phases: DataFrame, industries: DataFrame) -> DataFrame:
    """Every month with every configured industry: the smaller table, of at most ``BROADCAST_ROWS`` rows, goes out as one array and is exploded; two larger ones are refused."""
    names = industries.columns
    if industries.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        if phases.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
            raise ValueError("one of months and industries must be small")
        months = phases.agg(F.collect_list(F.struct(*phases.columns)).alias("__all"))
        return industries.join(F.broadcast(months), F.lit(True)).select(*names, F.explode("__all").alias("__m")).select(*[F.col("__m")[c].alias(c) for c in phases.columns], *names)
    listed = industries.agg(F.sort_array(F.collect_list(F.struct("l3_name", *[c for c in names if c != "l3_name"]))).alias("__all"))
    return phases.join(F.broadcast(listed), F.lit(True)).select(*phases.columns, F.explode("__all").alias("__i")).select(*phases.columns, *[F.col("__i")[c].alias(c) for c in names])


def lookup(df: DataFrame, column: str, table: DataFrame, key: str, value: str, default=None, alias: str | None = None) -> DataFrame:
    """``df`` with the value of a dictionary table, or the default."""
    t = small(table.select(F.col(key).alias(column), F.col(value).alias("__value")))
    out = df.join(t, column, "left")
    return out.withColumn(alias or value, F.coalesce("__value", F.lit(default))).drop("__value")


def semi_filter(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_semi")


def anti_missing(wanted: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Wanted keys that ``present`` has not."""
    return wanted.join(present.select(*on), list(on), "left_anti")


def backfill_announcement(own: DataFrame, cashflow: DataFrame, balance: DataFrame, income: DataFrame, keys: Sequence[str] = ("ts_code", "end_date"), column: str = "f_ann_date") -> DataFrame:
    """A null announcement date becomes that of the cash flow, balance sheet or income statement, its own ann_date, or the period's end, the first that is known."""
    out = own
    names = []
    for i, other in enumerate((cashflow, balance, income)):
        names.append(f"__d{i}")
        one = other.groupBy(*keys).agg(F.min(column).alias(f"__d{i}"))
        out = out.join(one, list(keys), "left")
    last: list[Column] = [F.col(c) for c in ("ann_date", keys[-1]) if c in own.columns]
    return out.withColumn(column, F.coalesce(column, *names, *last)).drop(*names)


def reconcile(expected: DataFrame, actual: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 1e-4) -> DataFrame:
    """Rows of both sides by key, each column's relative error, the largest of them, and whether the row passes; a row of one side only fails."""
    e, a = expected.select(*keys, *[F.col(c).alias(f"{c}_expected") for c in columns], F.lit(1).alias("__e")), actual.select(*keys, *[F.col(c).alias(f"{c}_actual") for c in columns], F.lit(1).alias("__a"))
    out = e.join(a, list(keys), "full")
    for c in columns:
        x, y = F.col(f"{c}_expected"), F.col(f"{c}_actual")
        out = out.withColumn(f"{c}_error", F.when(x.isNull() & y.isNull(), 0.0).otherwise(F.abs(y - x) / F.when(x == 0, 1.0).otherwise(F.abs(x))))
    errors = [F.col(f"{c}_error") for c in columns]
    worst = F.greatest(*errors) if len(errors) > 1 else errors[0]
    both = F.col("__e").isNotNull() & F.col("__a").isNotNull()
    known = ~F.exists(F.array(*errors), lambda x: x.isNull())
    return out.withColumn("max_error", worst).withColumn("passed", both & known & (F.col("max_error") <= tolerance)).drop("__e", "__a")

"""Kernels over a key's rows in order of time, as Arrow tables or pandas frames, on groups of bounded size."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .ranges import cut, has_long_key

#: Rows of a key that one call gets, besides its warm-up.
GROUP_ROWS = 200_000

#: What a kernel gives: an array of as many values as the table has rows, for each declared column.
Kernel = Callable[[pa.Table], Mapping[str, pa.Array | np.ndarray]]


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def apply_kernel(df: DataFrame, kernel: Kernel, columns: str, warmup: int = 0, by: Sequence[str] = ("symbol",), time: str = "time", rows: int = GROUP_ROWS, bucket: str = "month") -> DataFrame:
    """``df`` with the ``columns`` (a schema in SQL) that ``kernel`` computes from a key's rows, which it gets in order of time, null times first.

    ``warmup``: rows before a row that its values depend on.  If any key has more than ``rows`` rows, keys are cut into ranges of time, each of which gets the warm-up before it again;
    only the range's own rows are given out.  So no call holds more than ``rows`` and ``warmup`` rows and two buckets of time, however long a key is.
    """
    importable(df.sparkSession)
    added = StructType.fromDDL(columns)
    like = df.select(*[c for c in df.columns if c not in added.names])
    long = has_long_key(like, by, rows)
    ranged = cut(like, by, time, rows, warmup, bucket) if long else like
    groups = [*by, "__range"] if long else by

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[(time, "ascending")], null_placement="at_start"))
        own = table.column("__own") if "__own" in table.column_names else None
        table = table.drop_columns([c for c in ("__range", "__own") if c in table.column_names])
        found = kernel(table)
        for f, kind in zip(added.names, kinds):
            values = found[f]
            values = values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values, from_pandas=True)
            table = table.append_column(f, values.cast(kind))
        return table if own is None else table.filter(own)

    kinds = [to_arrow_type(f.dataType) for f in added]
    return ranged.groupBy(*groups).applyInArrow(run, StructType([*like.schema.fields, *added.fields]))


def pandas_kernel(f: Callable[[pd.DataFrame], pd.DataFrame]) -> Kernel:
    """A function of a pandas frame that returns a frame, or the frame with further columns, as a kernel."""

    def kernel(table: pa.Table) -> Mapping[str, pa.Array]:
        out = f(table.to_pandas())
        if len(out) != table.num_rows:
            raise ValueError("a kernel gives one row for each row")
        return {c: pa.Array.from_pandas(out[c]) for c in out.columns}

    return kernel


def count_below(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each i, how many of ``values[start[i]:i]`` are less than ``values[i]``.

    All questions go down the values' bits together: at each bit the values are parted stably into zeros and ones, and an interval
    goes on where its own value's bit leads, counting the zeros it leaves behind.  Ranks have log n bits, so this costs n log n however long the intervals are.
    """
    n = len(values)
    if not n:
        return np.zeros(0, np.int64)
    own = np.unique(values, return_inverse=True)[1].astype(np.int64)
    ranks, lo, hi, below = own, start.astype(np.int64), np.arange(n), np.zeros(n, np.int64)
    for bit in range(int(own.max()).bit_length() - 1, -1, -1):
        one = (ranks >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~one)])
        at_lo, at_hi = zeros[lo], zeros[hi]
        up = (own >> bit & 1).astype(bool)
        below += np.where(up, at_hi - at_lo, 0)
        lo, hi = np.where(up, zeros[-1] + lo - at_lo, at_lo), np.where(up, zeros[-1] + hi - at_hi, at_hi)
        ranks = np.concatenate([ranks[~one], ranks[one]])
    return below

"""Technical indicators and their registry.

Every indicator adds columns to bars by symbol.  Moving windows are window functions; exponential ones are an affine
scan.  ``mode="strict"`` gives null until a window is full; ``mode="simple"`` uses what there is.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .kernels import GROUP_ROWS, apply_kernel, pandas_kernel
from .ranges import spread
from .scan import affine_scan, keep_columns


def by_symbol():
    return Window.partitionBy("symbol").orderBy("time")


class Indicator(ABC):
    """``name``, the ``columns`` it adds, the input it needs, and ``apply``.  A kernel in pandas is a ``Kernel``."""

    needs: Sequence[str] = ("symbol", "time", "close")

    @property
    def warmup(self) -> int:
        """Bars before the first value."""
        return 1

    @property
    @abstractmethod
    def name(self) -> str: ...

    @property
    @abstractmethod
    def columns(self) -> list[str]: ...

    @abstractmethod
    def calculate(self, bars: DataFrame) -> DataFrame: ...

    def validate_input(self, bars: DataFrame) -> None:
        missing = [c for c in self.needs if c not in bars.columns]
        if missing:
            raise ValueError(f"{self.name} needs columns {missing}")

    def apply(self, bars: DataFrame) -> DataFrame:
        return apply_all(bars, [self])


class MA(Indicator):
    def __init__(self, period: int = 20, mode: str = "strict"):
        self.period, self.mode = period, mode

    name = property(lambda self: f"ma_{self.period}")
    warmup = property(lambda self: self.period)
    columns = property(lambda self: [self.name])

    def calculate(self, bars: DataFrame) -> DataFrame:
        w = by_symbol().rowsBetween(-(self.period - 1), 0)
        mean = F.avg("close").over(w)
        return bars.withColumn(self.name, mean if self.mode == "simple" else F.when(F.count("close").over(w) >= self.period, mean))


class EMA(Indicator):
    """``seed="sma"`` starts at the mean of the first ``period`` values, ``seed="first"`` at the first one."""

    def __init__(self, period: int = 20, seed: str = "sma"):
        self.period, self.seed = period, seed

    name = property(lambda self: f"ema_{self.period}")
    warmup = property(lambda self: self.period)
    columns = property(lambda self: [self.name])

    def calculate(self, bars: DataFrame) -> DataFrame:
        return affine_scan(bars, "close", 2 / (self.period + 1), self.name, seed=self.seed, span=self.period)


class MACD(Indicator):
    """Difference of two exponential means, its own exponential mean, and twice what lies between."""

    def __init__(self, fast: int = 12, slow: int = 26, signal: int = 9, seed: str = "first"):
        self.fast, self.slow, self.signal, self.seed = fast, slow, signal, seed

    name = property(lambda self: "macd")
    warmup = property(lambda self: self.slow + self.signal)
    columns = property(lambda self: ["macd", "macd_signal", "macd_hist"])

    def calculate(self, bars: DataFrame) -> DataFrame:
        out = affine_scan(bars, "close", 2 / (self.fast + 1), "__fast", seed=self.seed, span=self.fast)
        out = affine_scan(out, "close", 2 / (self.slow + 1), "__slow", seed=self.seed, span=self.slow)
        out = out.withColumn("macd", F.col("__fast") - F.col("__slow"))
        out = affine_scan(out, "macd", 2 / (self.signal + 1), "macd_signal", seed=self.seed, span=self.signal)
        return out.withColumn("macd_hist", 2 * (F.col("macd") - F.col("macd_signal")))


class RSI(Indicator):
    """Strength of gains against losses: smoothed as Wilder does, or (``simple``) by rolling means, where no loss gives 0."""

    def __init__(self, period: int = 14, mode: str = "wilder"):
        self.period, self.mode = period, mode

    name = property(lambda self: f"rsi_{self.period}")
    warmup = property(lambda self: self.period)
    columns = property(lambda self: [self.name])

    def calculate(self, bars: DataFrame) -> DataFrame:
        change = F.col("close") - F.lag("close").over(by_symbol())
        out = bars.withColumn("__gain", F.greatest(change, F.lit(0.0))).withColumn("__loss", F.greatest(-change, F.lit(0.0)))
        out = out.withColumn("__gain", F.when(change.isNotNull(), F.col("__gain"))).withColumn("__loss", F.when(change.isNotNull(), F.col("__loss")))
        if self.mode == "simple":
            w = by_symbol().rowsBetween(-(self.period - 1), 0)
            gain, loss = F.avg("__gain").over(w), F.avg("__loss").over(w)
            rsi = F.when(F.count("__gain").over(w) >= self.period, F.when(loss == 0, 0.0).otherwise(100 - 100 / (1 + gain / F.when(loss != 0, loss))))
            return out.withColumn(self.name, rsi)
        for side in ("__gain", "__loss"):
            out = affine_scan(out, side, 1 / self.period, f"{side}_mean", seed="sma", span=self.period)
        gain, loss = F.col("__gain_mean"), F.col("__loss_mean")
        return out.withColumn(self.name, F.when(gain + loss == 0, 0.0).otherwise(100 * gain / F.when(gain + loss != 0, gain + loss)))


def true_range(first: str = "own") -> Column:
    before = F.lag("close").over(by_symbol())
    if first == "own":
        before = F.coalesce(before, F.col("close"))
    high, low = F.col("high"), F.col("low")
    return F.when(before.isNotNull(), F.greatest(high - low, F.abs(high - before), F.abs(low - before)))


class TR(Indicator):
    """True range; the first row is measured against its own close, or (``strict``) is null."""

    needs = ("symbol", "time", "high", "low", "close")

    def __init__(self, mode: str = "simple"):
        self.mode = mode

    name = property(lambda self: "tr")
    columns = property(lambda self: ["tr"])

    def calculate(self, bars: DataFrame) -> DataFrame:
        return bars.withColumn("tr", true_range("own" if self.mode == "simple" else "none"))


class ATR(Indicator):
    """Wilder's mean of the true range, or (``simple``) its exponential mean from the first row on."""

    needs = TR.needs

    def __init__(self, period: int = 14, mode: str = "wilder"):
        self.period, self.mode = period, mode

    name = property(lambda self: f"atr_{self.period}")
    warmup = property(lambda self: self.period)
    columns = property(lambda self: [self.name])

    def calculate(self, bars: DataFrame) -> DataFrame:
        if self.mode == "simple":
            return affine_scan(bars.withColumn("__tr", true_range()), "__tr", 2 / (self.period + 1), self.name, seed="first")
        return affine_scan(bars.withColumn("__tr", true_range("none")), "__tr", 1 / self.period, self.name, seed="sma", span=self.period)


class NDA(Indicator):
    """Among the heaviest quarter of the last 20 bars by volume (of equal ones the earlier first): days that closed above their
    open less the others; confirmed from 1 on.  Bars with a null open, close or volume don't count, but fill the window."""

    needs = ("symbol", "time", "open", "close", "volume")

    def __init__(self, window: int = 20, share: float = 0.25):
        self.window, self.share = window, share

    name = property(lambda self: "nda")
    warmup = property(lambda self: self.window)
    columns = property(lambda self: ["nda_value", "volume_confirmed"])

    def calculate(self, bars: DataFrame) -> DataFrame:
        w = by_symbol().rowsBetween(-(self.window - 1), 0)
        top = max(1, ceil(self.window * self.share))
        whole = F.col("open").isNotNull() & F.col("close").isNotNull() & F.col("volume").isNotNull()
        side = F.when(F.col("close") > F.col("open"), 1).otherwise(-1)
        heavy = F.collect_list(F.when(whole, F.struct((-F.col("volume")).alias("v"), F.col("time").alias("t"), side.alias("s")))).over(w)
        score = F.aggregate(F.slice(F.sort_array(heavy), 1, top), F.lit(0), lambda a, x: a + x["s"])
        full = (F.count(F.lit(1)).over(w) >= self.window) & (F.size(heavy) > 0)
        return bars.withColumn("nda_value", F.when(full, score)).withColumn("volume_confirmed", F.col("nda_value") >= 1)


class Kernel(Indicator):
    """An indicator by a function of a symbol's rows as a pandas frame, in order of time, that returns the declared columns (a schema in SQL), a row for each row.

    A value may depend on the ``warmup - 1`` rows before its own; symbols of over ``rows`` rows are cut with that overlap.
    """

    def __init__(self, name: str, columns: str, calculate: Callable[[pd.DataFrame], pd.DataFrame], warmup: int = 1, needs: Sequence[str] = ("symbol", "time", "close"), rows: int = GROUP_ROWS):
        self._name, self._schema, self._kernel, self._warmup, self.needs, self._rows = name, columns, pandas_kernel(calculate), warmup, needs, rows

    @property
    def warmup(self) -> int:
        return self._warmup

    @property
    def name(self) -> str:
        return self._name

    @property
    def columns(self) -> list[str]:
        return StructType.fromDDL(self._schema).names

    def calculate(self, bars: DataFrame) -> DataFrame:
        return apply_kernel(bars, self._kernel, self._schema, warmup=self._warmup - 1, rows=self._rows)


REGISTRY: dict[str, Callable[[], Indicator]] = {}


def register_indicator(name: str, factory: Callable[[], Indicator]) -> None:
    REGISTRY[name] = factory


def create_indicator(name: str) -> Indicator:
    if name not in REGISTRY:
        raise KeyError(f"no indicator {name!r}; there are {list_indicators()}")
    return REGISTRY[name]()


def list_indicators() -> list[str]:
    return sorted(REGISTRY)


def is_registered(name: str) -> bool:
    return name in REGISTRY


for _name, _factory in {
    "ma_20": lambda: MA(20),
    "ma_50": lambda: MA(50),
    "ema_20": lambda: EMA(20),
    "ema_50": lambda: EMA(50),
    "macd": MACD,
    "rsi_14": lambda: RSI(14),
    "atr_14": lambda: ATR(14),
    "tr": TR,
    "nda": NDA,
}.items():
    register_indicator(_name, _factory)


def apply_all(bars: DataFrame, indicators: Sequence[Indicator]) -> DataFrame:
    """The indicators one after the other, on bars dealt to tasks of bounded size once for all of them."""
    for n, indicator in enumerate(indicators):
        indicator.validate_input(bars)
        rows = bars.drop(*indicator.columns)
        bars = keep_columns(indicator.calculate(rows if n else spread(rows, ["symbol"])), bars, indicator.columns)
    return bars


def apply_batch(bars: DataFrame, names: Sequence[str]) -> DataFrame:
    """All known indicators of the list in one lineage; unknown names are skipped."""
    return apply_all(bars, [create_indicator(name) for name in names if is_registered(name)])

"""Query surface: every dataset by keys, inclusive calendar days and its own filters, sorted."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import canonical_frequency, phase_attributes
from ..operators.adjust import adjust
from ..operators.joins import asof_join, bars_with_factor


@dataclass(frozen=True)
class Spec:
    """How a dataset is queried: key column, time column, sort order."""

    key: str | None
    time: str | None
    sort: tuple[str, ...]


_BY_SYMBOL = Spec("symbol", "time", ("symbol", "time"))
_MACRO = Spec(None, "time", ("time",))
_INDEX = Spec("ts_code", "trade_date", ("trade_date", "ts_code"))
_REPORT = Spec("ts_code", "end_date", ("ts_code", "end_date"))
SPECS = {
    **dict.fromkeys("daily minute daily_basic adj_factor weekly monthly daily_basic_weekly daily_basic_monthly adj_factor_weekly adj_factor_monthly processed_daily processed_weekly processed_monthly valuation_pct industry_valuation fundamental_combined".split(), _BY_SYMBOL),
    **dict.fromkeys("gdp ppi money pmi macro_cycle".split(), _MACRO),
    **dict.fromkeys("index_daily index_dailybasic sw_daily".split(), _INDEX),
    **dict.fromkeys("fina_indicator cashflow balancesheet income fundamental_quality".split(), _REPORT),
    "asset_basic": Spec("symbol", None, ("symbol",)),
    "industry_classify": Spec(None, None, ("industry_code",)),
    "industry_member": Spec("ts_code", None, ("l1_name", "l2_name", "l3_name", "ts_code")),
    "trade_cal": Spec("exchange", "cal_date", ("exchange", "cal_date")),
    "index_weight": Spec("index_code", "trade_date", ("index_code", "trade_date", "con_code")),
    "macro_cycle_industries": Spec(None, "time", ("time", "l3_name")),
}
#: More values than this go in as a joined list rather than as an IN.
IN_LIST = 1000


class Hub:
    """Named tables and their getters.  ``None`` leaves a dimension unrestricted; days are inclusive on both sides."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self.tables = dict(tables)

    def table(self, name: str) -> DataFrame:
        t = self.tables[name]
        return t() if callable(t) else t

    def get(self, name: str, keys: Sequence | None = None, start=None, end=None, columns: Sequence[str] | None = None, **equal) -> DataFrame:
        """The dataset filtered before anything else, so that key and day conditions reach the scan; ``equal`` are equalities on columns."""
        spec = SPECS[name]
        df = self.table(name)
        if keys is not None and not spec.key:
            raise ValueError(f"{name} has no key column to restrict")
        if keys is not None:
            keys = list(keys)
            if len(keys) <= IN_LIST:
                df = df.where(F.col(spec.key).isin(keys))
            else:
                df = df.join(df.sparkSession.createDataFrame([(k,) for k in keys], f"{spec.key} {dict(df.dtypes)[spec.key]}"), spec.key, "left_semi")
        if spec.time:
            if start is not None:
                df = df.where(F.col(spec.time) >= F.lit(start).cast("date"))
            if end is not None:
                df = df.where(F.col(spec.time) < F.date_add(F.lit(end).cast("date"), 1))
        for column, value in equal.items():
            if value is not None:
                df = df.where(F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(column) == value)
        if columns is not None:
            base = [c for c in dict.fromkeys((spec.key, spec.time, *spec.sort)) if c and c in df.columns]
            df = df.select(*base, *[c for c in dict.fromkeys(columns) if c in df.columns and c not in base])
        return df.orderBy(*[c for c in spec.sort if c in df.columns])

    def get_daily(self, keys=None, start=None, end=None) -> DataFrame:
        """Daily bars; without any restriction no rows, so that nobody reads the whole history by oversight."""
        out = self.get("daily", keys, start, end)
        return out.where(F.lit(False)) if keys is None and start is None and end is None else out

    def get_minute(self, keys=None, start=None, end=None, frequency: str = "1m") -> DataFrame:
        """One frequency; ``minute_5`` and ``5m`` are the same."""
        wanted = canonical_frequency(F.lit(frequency))
        df = Hub({"minute": self.table("minute").where(canonical_frequency(F.col("frequency")) == wanted)})
        return df.get("minute", keys, start, end)

    def get_basic(self, keys=None) -> DataFrame:
        return self.get("asset_basic", keys or None)

    def get_classify(self, level: str | None = None) -> DataFrame:
        return self.get("industry_classify", level=level)

    def get_members(self, l1=None, l2=None, l3=None, ts_code=None) -> DataFrame:
        return self.get("industry_member", [ts_code] if isinstance(ts_code, str) else ts_code, l1_name=l1, l2_name=l2, l3_name=l3)

    def get_calendar(self, exchange: str | None = None, start=None, end=None, is_open: int | None = None) -> DataFrame:
        return self.get("trade_cal", [exchange.upper()] if exchange else None, start, end, is_open=is_open)

    def get_index_weight(self, index=None, day=None, start=None, end=None) -> DataFrame:
        if day is not None and (start is not None or end is not None):
            raise ValueError("give a day or a range, not both")
        return self.get("index_weight", index, day if day is not None else start, day if day is not None else end)

    def get_daily_adjusted(self, keys=None, start=None, end=None, how: str = "qfq") -> DataFrame:
        """Bars adjusted on read by the factors of the range."""
        bars = self.get("daily", keys, start, end)
        return adjust(bars_with_factor(bars, self.get("adj_factor", keys, start, end)), how).orderBy("symbol", "time")

    def get_processed(self, freq: str = "daily", keys=None, start=None, end=None, indicators: Sequence[str] | None = None) -> DataFrame:
        """Bars, and of the indicator columns those asked for; unknown names are ignored."""
        bars = ["open", "high", "low", "close", "volume", "amount", "adjust_type"]
        return self.get(f"processed_{freq}", keys, start, end, None if indicators is None else [*bars, *indicators])

    def get_valuation(self, keys=None, start=None, end=None, columns: Sequence[str] | None = None) -> DataFrame:
        """``valuation`` among the columns stands for all of them."""
        return self.get("valuation_pct", keys, start, end, None if columns is None or "valuation" in columns else columns)

    def get_industry_valuation(self, keys=None, start=None, end=None, l2_names=None, include_exempted: bool = True) -> DataFrame:
        out = self.get("industry_valuation", keys, start, end, l2_name=l2_names)
        return out if include_exempted else out.where(~F.col("is_exempted"))

    def get_macro_cycle(self, start=None, end=None, phase: str = "stable") -> DataFrame:
        """Months with the chosen phase and its label, colour and ordinal."""
        out = self.get("macro_cycle", None, start, end).withColumn("phase", F.col(f"{phase}_phase"))
        return out.select("*", *phase_attributes(F.col("phase"))).orderBy("time")

    def get_macro_cycle_industries(self, start=None, end=None, phase: str = "stable", preferred_only: bool = False) -> DataFrame:
        out = self.get("macro_cycle_industries", None, start, end).withColumn("is_preferred", F.col(f"matches_{phase}_phase"))
        return out.where("is_preferred") if preferred_only else out

    def get_fundamental_combined(self, keys=None, start=None, end=None, columns: Sequence[str] | None = None) -> DataFrame:
        """Daily valuation with the quality row announced last at or before the day."""
        daily = self.get("valuation_pct", keys, start, end)
        quality = self.table("fundamental_quality").withColumnRenamed("ts_code", "symbol").withColumn("fscore_effective_date", F.coalesce("f_ann_date", "ann_date")).withColumnRenamed("end_date", "fscore_period").drop("f_ann_date", "ann_date")
        out = asof_join(daily, quality, "time", "fscore_effective_date", ["symbol"], tie=["fscore_period"])
        if columns is not None:
            out = out.select("symbol", "time", *[c for c in dict.fromkeys(columns) if c in out.columns and c not in ("symbol", "time")])
        return out.orderBy("symbol", "time")

    def active_assets(self) -> DataFrame:
        return self.table("asset_basic").where("list_status = 'L'")

    def symbol_list(self, market: str | None = None, limit: int | None = None) -> DataFrame:
        out = self.active_assets()
        if market is not None:
            out = out.where(F.col("market") == market)
        out = out.select("symbol").orderBy("symbol")
        return out if limit is None else out.limit(limit)

    def distinct_keys(self, name: str, key: str | None = None) -> DataFrame:
        key = key or SPECS[name].key or SPECS[name].sort[0]
        return self.table(name).select(key).distinct().orderBy(key)


def _getter(name: str):
    def get(self: Hub, keys=None, start=None, end=None, **equal) -> DataFrame:
        return self.get(name, keys, start, end, **equal)

    get.__name__, get.__doc__ = f"get_{name}", f"Rows of {name}."
    return get


for _name in SPECS:
    if not hasattr(Hub, f"get_{_name}"):
        setattr(Hub, f"get_{_name}", _getter(_name))

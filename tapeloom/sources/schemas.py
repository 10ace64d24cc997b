"""Landed datasets: their columns, and how a landed frame is made to fit them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import MARKET_ZONE

_BAR = "open double, high double, low double, close double"
_MACRO_PPI = "ppi_yoy double, ppi_mom double, ppi_accu double"


@dataclass(frozen=True)
class Dataset:
    """``columns`` as a DDL string, ``key`` of a row, ``required`` columns, and the vendor's names for some of them."""

    columns: str
    key: tuple[str, ...]
    rename: Mapping[str, str]

    @property
    def fields(self) -> list[tuple[str, str]]:
        return [tuple(c.strip().split(" ", 1)) for c in self.columns.split(",")]  # type: ignore[misc]

    @property
    def required(self) -> tuple[str, ...]:
        return self.key


def _d(columns: str, key: str, **rename: str) -> Dataset:
    return Dataset(columns, tuple(key.split()), rename)


DATASETS = {
    "asset_basic": _d("symbol string, name string, area string, industry string, market string, exchange string, list_status string, list_date date, delist_date date, is_hs string", "symbol", ts_code="symbol"),
    "daily": _d(f"time timestamp, symbol string, {_BAR}, preclose double, change_amount double, change_pct double, volume long, amount double", "symbol time", ts_code="symbol", trade_date="time", vol="volume", pre_close="preclose", change="change_amount", pct_chg="change_pct"),
    "minute": _d(f"time timestamp, symbol string, {_BAR}, volume long, amount double, frequency string", "symbol time frequency", ts_code="symbol", trade_time="time", vol="volume"),
    "daily_basic": _d("time timestamp, symbol string, turnover_rate double, volume_ratio double, pe double, pe_ttm double, pb double, ps double, ps_ttm double, dv_ratio double, dv_ttm double, total_share double, float_share double, free_share double, total_mv double, circ_mv double", "symbol time", ts_code="symbol", trade_date="time"),
    "adj_factor": _d("time timestamp, symbol string, adj_factor double", "symbol time", ts_code="symbol", trade_date="time"),
    "gdp": _d("time timestamp, quarter string, gdp double, gdp_yoy double", "time"),
    "ppi": _d(f"time timestamp, month string, {_MACRO_PPI}", "time"),
    "money": _d("time timestamp, month string, m0 double, m0_yoy double, m1 double, m1_yoy double, m2 double, m2_yoy double", "time"),
    "pmi": _d("time timestamp, month string, pmi010000 double, pmi030000 double", "time"),
    "index_daily": _d(f"trade_date timestamp, ts_code string, {_BAR}, pre_close double, pct_chg double, vol double, amount double", "ts_code trade_date"),
    "index_dailybasic": _d("trade_date timestamp, ts_code string, total_mv double, float_mv double, turnover_rate double, pe double, pe_ttm double, pb double", "ts_code trade_date"),
    "fina_indicator": _d("ts_code string, end_date date, ann_date date, f_ann_date date, roe double, roe_yearly double, q_roe double, roa double, grossprofit_margin double, netprofit_margin double, q_gsprofit_margin double, q_netprofit_margin double, assets_turn double, current_ratio double, debt_to_assets double, netprofit_yoy double", "ts_code end_date"),
    "cashflow": _d("ts_code string, end_date date, ann_date date, f_ann_date date, n_cashflow_act double", "ts_code end_date"),
    "balancesheet": _d("ts_code string, end_date date, ann_date date, f_ann_date date, total_assets double, total_liab double, total_ncl double, total_cur_assets double, total_cur_liab double, total_share double", "ts_code end_date"),
    "income": _d("ts_code string, end_date date, ann_date date, f_ann_date date, total_revenue double, n_income double", "ts_code end_date"),
    "industry_classify": _d("industry_code string, industry_name string, level string, parent_code string", "industry_code", index_code="industry_code"),
    "industry_member": _d("ts_code string, l1_code string, l1_name string, l2_code string, l2_name string, l3_code string, l3_name string, in_date date, out_date date, is_new string", "ts_code l3_code in_date"),
    "sw_daily": _d(f"trade_date timestamp, ts_code string, {_BAR}, vol double, amount double, pe double, pb double", "ts_code trade_date"),
    "trade_cal": _d("exchange string, cal_date date, is_open int, pretrade_date date", "exchange cal_date"),
    "index_weight": _d("index_code string, con_code string, trade_date date, weight double", "index_code con_code trade_date"),
}


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Old names to new ones, where the old one is present and the new one isn't."""
    return df.withColumnsRenamed({a: b for a, b in mapping.items() if a in df.columns and b not in df.columns})


def parse_time(c: Column) -> Column:
    """From ``20240131``, ISO dates and times, or epoch milliseconds; else null."""
    s = c.cast("string")
    return F.when(s.rlike("^[0-9]{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd"))).when(s.rlike("^[0-9]{12,13}$"), F.timestamp_millis(s.try_cast("long"))).otherwise(s.try_cast("timestamp"))


def coerced(c: Column, kind: str, int_null_fill: int | None = None) -> Column:
    if kind == "timestamp":
        return parse_time(c)
    if kind == "date":
        return parse_time(c).cast("date")
    if kind in ("long", "int"):
        whole = c.cast("string").try_cast("double").try_cast(kind)
        return whole if int_null_fill is None else F.coalesce(whole, F.lit(int_null_fill).cast(kind))
    return c.cast("string").try_cast(kind)


def conform(df: DataFrame, dataset: Dataset, strict: bool = False, int_null_fill: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rows cast to the dataset's columns, and the raw rows whose key doesn't parse.

    A missing key column is an error; ``strict`` also refuses columns that the dataset hasn't.
    """
    missing = [c for c in dataset.required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    extra = [c for c in df.columns if c not in dict(dataset.fields)]
    if strict and extra:
        raise ValueError(f"unknown columns: {extra}")
    kinds = dict(dataset.fields)
    ok = F.lit(True)
    for c in dataset.required:
        ok = ok & coerced(F.col(c), kinds[c]).isNotNull()
    cast = [(coerced(F.col(c), k, int_null_fill) if c in df.columns else F.lit(None).cast(k)).alias(c) for c, k in dataset.fields]
    return df.where(ok).select(*cast), df.where(~ok)


def dedupe_on_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row a key: the last by ``order``, then by all columns, so that the choice doesn't depend on arrival."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    by = F.struct(*order, *rest)
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), by).alias("__r")).select(*[F.col(c) if c in key else F.col("__r")[c].alias(c) for c in df.columns])


def concat_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with differing columns."""
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def land(spark: SparkSession, path: str | Sequence[str], name: str, fmt: str = "parquet", strict: bool = False, **options: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of landed files: read, rename, conform, one row a key.  Text formats are read as strings; nothing is inferred."""
    dataset = DATASETS[name]
    reader = spark.read.options(**options)
    if fmt == "csv":
        raw = reader.option("header", True).option("inferSchema", False).csv(path)
    elif fmt == "json":
        raw = reader.option("primitivesAsString", True).json(path)
    else:
        raw = reader.format(fmt).load(path)
    good, rejects = conform(rename_columns(raw, dataset.rename), dataset, strict)
    return dedupe_on_key(good, dataset.key), rejects


def flatten_nested(df: DataFrame, column: str, fields: Sequence[str] = ("open", "high", "low", "close", "volume", "amount"), zone: str = MARKET_ZONE) -> DataFrame:
    """``{symbol: {field: {epoch ms: value}}}`` in JSON text to one row a symbol and time, times in the market's zone."""
    nested = df.select(F.explode(F.from_json(column, "map<string,map<string,map<string,double>>>")).alias("symbol", "m"))
    cells = nested.select("symbol", F.explode("m").alias("field", "v")).select("symbol", "field", F.explode("v").alias("key", "value"))
    wide = cells.groupBy("symbol", "key").agg(*[F.first(F.when(F.col("field") == f, F.col("value")), ignorenulls=True).alias(f) for f in fields])
    return wide.select("symbol", F.from_utc_timestamp(F.timestamp_millis(F.col("key").try_cast("long")), zone).alias("time"), *fields)


def derive_change(bars: DataFrame) -> DataFrame:
    """Change against the previous close, absolute and in percent; null without one."""
    return bars.withColumn("change_amount", F.col("close") - F.col("preclose")).withColumn("change_pct", F.try_divide(F.col("close") - F.col("preclose"), F.col("preclose")) * 100)


def standardize_symbol(c: Column) -> Column:
    """Trimmed, upper case, exchange last: ``SH.600519`` -> ``600519.SH``."""
    return F.regexp_replace(F.upper(F.trim(c)), r"^([A-Z]{2})\.(.*)$", "$2.$1")


def tag_frequency(df: DataFrame, frequency: str) -> DataFrame:
    return df if "frequency" in df.columns else df.withColumn("frequency", F.lit(frequency))

"""Trailing twelve months, year-on-year tests, and the nine-point quality score of quarterly statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import announcement_date, exempted, nullable_flag, safe_ratio
from .joins import merge_statements

KEY, TIME = "ts_code", "end_date"
FLAGS = ("f_roa", "f_cfo", "f_delta_roa", "f_accrual", "f_delta_lever", "f_delta_liquid", "f_eq_offer", "f_delta_margin", "f_delta_turn")


def ordered(rows: tuple[int, int] | None = None):
    w = Window.partitionBy(KEY).orderBy(TIME)
    return w.rowsBetween(*rows) if rows else w


def ttm_from_cumulative(column: str) -> Column:
    """Year-to-date to trailing twelve months: in the last quarter the value itself, else the value plus last year's whole less last year's same quarter.

    Years are looked up by value, so a missing quarter gives null, never a wrong neighbour.
    """
    year, month = F.year(TIME), F.month(TIME)
    same = F.last(column).over(Window.partitionBy(KEY, month).orderBy(year).rangeBetween(-1, -1))
    whole = F.max(F.when(month == 12, F.col(column))).over(Window.partitionBy(KEY).orderBy(year).rangeBetween(-1, -1))
    return F.when(month == 12, F.col(column)).otherwise(F.col(column) + whole - same)


def ttm_from_quarterly(column: str, agg: str = "mean") -> Column:
    """Mean or sum of four rows, all of them known."""
    w = ordered((-3, 0))
    value = F.avg(column).over(w) if agg == "mean" else F.sum(column).over(w)
    return F.when(F.count(column).over(w) == 4, value)


def yoy_improved(column: str | Column, lower_is_better: bool = False, allow_equal: bool = False) -> Column:
    """1 if better than four rows earlier, else (also if unknown) 0."""
    now = F.col(column) if isinstance(column, str) else column
    before = F.lag(now, 4).over(ordered())
    better = (now <= before if allow_equal else now < before) if lower_is_better else (now >= before if allow_equal else now > before)
    return F.coalesce(better, F.lit(False)).cast("int")


def rolling_std(column: str, rows: int = 12, at_least: int = 4) -> Column:
    w = ordered((-(rows - 1), 0))
    return F.when(F.count(column).over(w) >= at_least, F.stddev_samp(column).over(w))


def rolling_corr(x: str, y: str, rows: int = 12, at_least: int = 3) -> Column:
    """Pearson's correlation of the window's complete pairs, from centred sums; no variance gives null."""
    w = ordered((-(rows - 1), 0))
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    pairs = F.collect_list(F.when(both, F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))).over(w)
    n = F.size(pairs)

    def mean(side: str) -> Column:
        return F.aggregate(pairs, F.lit(0.0), lambda a, p: a + p[side]) / F.when(n > 0, n)

    means = F.struct(mean("x").alias("x"), mean("y").alias("y"))
    zero = F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("yy"))
    sums = F.transform(
        F.array(means),
        lambda m: F.aggregate(pairs, zero, lambda a, p: F.struct((a["xy"] + (p["x"] - m["x"]) * (p["y"] - m["y"])).alias("xy"), (a["xx"] + (p["x"] - m["x"]) * (p["x"] - m["x"])).alias("xx"), (a["yy"] + (p["y"] - m["y"]) * (p["y"] - m["y"])).alias("yy"))),
    )[0]
    spread = F.sqrt(sums["xx"] * sums["yy"])
    return F.when(n >= at_least, sums["xy"] / F.when(spread > 0, spread))


def diff_n(column: str, rows: int = 12) -> Column:
    return F.col(column) - F.lag(column, rows).over(ordered())


def with_roe_5y_avg(df: DataFrame) -> DataFrame:
    """Twenty quarters of q_roe (at least four) summed, over five; a company without any takes the mean of five rows of its last yearly figures."""
    yearly_from = next((c for c in ("roe_yearly", "roe") if c in df.columns), None)
    df = df.withColumn("__yearly", F.lit(None).cast("double"))
    if yearly_from:
        last_of_year = F.row_number().over(Window.partitionBy(KEY, F.year(TIME)).orderBy(F.desc(TIME))) == 1
        df = df.withColumn("__annual", F.when(last_of_year, F.col(yearly_from)))
        df = df.withColumn("__yearly", F.last("__annual", ignorenulls=True).over(ordered((Window.unboundedPreceding, 0)))).drop("__annual")
    fallback = F.avg("__yearly").over(ordered((-4, 0)))
    if "q_roe" in df.columns:
        w = ordered((-19, 0))
        quarterly = F.when(F.count("q_roe").over(w) >= 4, F.sum("q_roe").over(w) / 5)
        value = F.when(F.count("q_roe").over(Window.partitionBy(KEY)) > 0, quarterly).otherwise(fallback)
    else:
        value = fallback
    return df.withColumn("roe_5y_avg", value).drop("__yearly")


def fscore(indicator: DataFrame, balance: DataFrame | None = None, cashflow: DataFrame | None = None, income: DataFrame | None = None, exemptions: DataFrame | None = None, default: Sequence[str] = ()) -> DataFrame:
    """Nine flags, their sum, and further metrics, by company and report period.

    ``exemptions`` (ts_code, exemptions) overrides the ``default`` list of exempted rules; an exempted rule scores full.  Columns that are
    absent, and companies for which a column is null throughout, take the fallbacks of the flag.  ``f_ann_date``, from when on a score is known, is
    that of the cash flow, income or balance sheet, the indicator's own, or its ann_date, the first that is known.
    """
    def dated(other: DataFrame | None, name: str) -> DataFrame | None:
        return other if other is None or "f_ann_date" not in other.columns else other.withColumnRenamed("f_ann_date", name)

    df = merge_statements(indicator, dated(balance, "__ann_bs"), dated(cashflow, "__ann_cf"), dated(income, "__ann_inc"))
    known = [F.col(c).cast("date") for c in ("__ann_cf", "__ann_inc", "__ann_bs", "f_ann_date", "ann_date") if c in df.columns]
    if known:
        df = df.withColumn("f_ann_date", announcement_date(*known))
    have = set(df.columns)
    default_list = F.array(*map(F.lit, default)).cast("array<string>")
    if exemptions is not None:
        df = df.join(exemptions.select(KEY, F.col("exemptions").alias("__ex")), KEY, "left").withColumn("exemptions", F.coalesce("__ex", default_list)).drop("__ex")
    else:
        df = df.withColumn("exemptions", default_list)
    none = F.lit(None).cast("double")

    def add(**columns: Column) -> None:
        nonlocal df
        df = df.withColumns(columns)

    def cumulative(name: str) -> Column:
        return ttm_from_cumulative(name) if name in have else none

    any_of = lambda name: F.count(name).over(Window.partitionBy(KEY)) > 0
    add(roa_ttm=cumulative("roa"), cfo_ttm=cumulative("n_cashflow_act"), ni_ttm=cumulative("n_income"), at_ttm=cumulative("assets_turn"))
    add(gpm_ttm=ttm_from_quarterly("q_gsprofit_margin") if "q_gsprofit_margin" in have else none, npm_ttm=ttm_from_quarterly("q_netprofit_margin") if "q_netprofit_margin" in have else none)
    if "netprofit_margin" in have:
        add(__npm=ttm_from_cumulative("netprofit_margin"))
        add(npm_ttm=F.when(any_of("npm_ttm"), F.col("npm_ttm")).otherwise(F.col("__npm")))
    add(__gpm_fallback=cumulative("grossprofit_margin"), __lever=safe_ratio(F.col("total_ncl"), F.col("total_assets")) if {"total_ncl", "total_assets"} <= have else none)
    if "current_ratio" not in have:
        add(current_ratio=safe_ratio(F.col("total_cur_assets"), F.col("total_cur_liab")) if {"total_cur_assets", "total_cur_liab"} <= have else none)
    if "assets_turn" not in have and {"total_revenue", "total_assets"} <= have:
        add(__turn=safe_ratio(F.col("total_revenue"), F.col("total_assets")))
        add(at_ttm=ttm_from_cumulative("__turn"))

    true = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    exempt = lambda rule, flag: F.when(exempted(F.col("exemptions"), rule), 1).otherwise(flag)
    add(
        f_roa=true(F.col("roa_ttm") > 0),
        f_cfo=exempt("f_score_cfo_positive", true(F.col("cfo_ttm") > 0)),
        f_delta_roa=yoy_improved("roa_ttm"),
        f_accrual=exempt("f_score_cfo", true(F.col("cfo_ttm") > F.col("ni_ttm"))),
        f_delta_lever=exempt("f_score_leverage", yoy_improved("__lever", lower_is_better=True)),
        f_delta_liquid=exempt("f_score_current_ratio", yoy_improved("current_ratio")),
        f_eq_offer=yoy_improved("total_share", lower_is_better=True, allow_equal=True) if "total_share" in have else F.lit(1),
        f_delta_margin=exempt("f_score_gross_margin", F.when(any_of("gpm_ttm"), yoy_improved("gpm_ttm")).otherwise(yoy_improved("__gpm_fallback"))),
        f_delta_turn=yoy_improved("at_ttm"),
    )
    total = F.col(FLAGS[0])
    for f in FLAGS[1:]:
        total = total + F.col(f)
    add(f_score=total)
    df = with_roe_5y_avg(df)
    margin_exempt = exempted(F.col("exemptions"), "f_score_gross_margin")
    add(
        ni_cfo_corr_3y=rolling_corr("n_income", "n_cashflow_act") if {"n_income", "n_cashflow_act"} <= have else none,
        debt_ratio=safe_ratio(F.col("total_liab"), F.col("total_assets")) * 100 if {"total_liab", "total_assets"} <= have else none,
        gpm_ttm_12q_std=F.when(~margin_exempt, rolling_std("gpm_ttm")),
        gpm_ttm_12q_delta=F.when(~margin_exempt, diff_n("gpm_ttm")),
        npm_ttm_12q_std=rolling_std("npm_ttm"),
        cfo_to_ni_ttm=F.when(F.col("ni_ttm") > 0, F.col("cfo_ttm") / F.when(F.col("ni_ttm") != 0, F.col("ni_ttm"))),
    )
    known = lambda *names: F.expr(" AND ".join(f"{n} IS NOT NULL" for n in names))
    add(
        buffett_gpm_flag=nullable_flag(known("gpm_ttm", "gpm_ttm_12q_delta", "gpm_ttm_12q_std") & ~margin_exempt, (F.col("gpm_ttm") >= 40) & (F.col("gpm_ttm_12q_delta") >= 0) & (F.col("gpm_ttm_12q_std") <= 5)),
        buffett_npm_stable_flag=nullable_flag(known("npm_ttm", "npm_ttm_12q_std"), (F.col("npm_ttm") > 0) & (F.col("npm_ttm_12q_std") <= 3)),
        buffett_roa_flag=nullable_flag(known("roa_ttm"), F.col("roa_ttm") >= 15),
        buffett_cashflow_flag=nullable_flag(known("cfo_ttm", "ni_ttm", "cfo_to_ni_ttm"), (F.col("cfo_ttm") > 0) & (F.col("ni_ttm") > 0) & (F.col("cfo_to_ni_ttm") >= 1)),
    )
    return df.drop("__npm", "__gpm_fallback", "__lever", "__turn", "__ann_bs", "__ann_cf", "__ann_inc")

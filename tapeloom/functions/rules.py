"""Decision tables and labels as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phases of the cycle with label, colour and ordinal.
PHASES = {
    "REFLATION": ("再通胀", "#60a5fa", 0),
    "RECOVERY": ("复苏", "#4ade80", 1),
    "OVERHEAT": ("过热", "#f87171", 2),
    "STAGFLATION": ("滞胀", "#fbbf24", 3),
}
#: Bounds of the bands, from above; a value at a bound is in the upper band.
PERCENTILE_BANDS = ((80, "very high"), (60, "high"), (40, "middle"), (20, "low"), (None, "very low"))
SCORE_BANDS = ((8, "excellent"), (5, "good"), (3, "fair"), (None, "poor"))
PEG_BANDS = ((0.5, "very cheap"), (1.0, "cheap"), (1.5, "fair"), (2.0, "dear"), (None, "very dear"))


def macro_phase(credit_impulse: Column, ppi: Column, pmi: Column) -> Column:
    growing = F.when((ppi < 0) & (pmi < 52), "REFLATION").otherwise("RECOVERY")
    heated = F.when(pmi > 50, "OVERHEAT").otherwise("STAGFLATION")
    slack = F.when(pmi < 50, "STAGFLATION").otherwise("RECOVERY")
    return F.when(credit_impulse > 0, growing).when(ppi > 2.0, heated).otherwise(slack)


def phase_attributes(phase: Column) -> list[Column]:
    """Label, colour and ordinal of a phase."""
    pairs = {k: F.create_map(*[F.lit(x) for name, row in PHASES.items() for x in (name, row[i])]) for i, k in enumerate(("phase_label", "phase_color", "phase_y"))}
    return [m[phase].alias(k) for k, m in pairs.items()]


def pick_indicator(kind: Column, pe: Column, pb: Column, ps: Column, peg: Column) -> Column:
    """The ratio of a kind; PE, PB and PS count only if positive."""
    out = F.when(kind == "PEG", peg)
    for name, value in (("PE", pe), ("PB", pb), ("PS", ps)):
        out = out.when((kind == name) & (value > 0), value)
    return out


def pick_percentile(kind: Column, pe: Column, pb: Column, ps: Column, peg: Column | None = None) -> Column:
    out = F.when(kind == "PE", pe).when(kind == "PB", pb).when(kind == "PS", ps)
    return out if peg is None else out.when(kind == "PEG", peg)


def exemption_reason(industry: Column, core_value: Column) -> Column:
    return F.when(industry.isNull(), "NO_INDUSTRY_CLASSIFICATION").when(core_value.isNull(), "INVALID_CORE_INDICATOR")


def peg(pe_ttm: Column, growth: Column) -> Column:
    return F.when((pe_ttm > 0) & (growth > 0), pe_ttm / growth)


def nullable_flag(valid: Column, condition: Column) -> Column:
    """1 or 0 where the inputs are valid, else null."""
    return F.when(valid, F.coalesce(condition, F.lit(False)).cast("int"))


def safe_ratio(x: Column, y: Column) -> Column:
    return F.when(y != 0, x / y)


def band(value: Column, bounds: Sequence[tuple[float | None, str]], rising: bool = False) -> Column:
    """The first band whose bound is reached from above (or, ``rising``, stayed below); null stays null."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in bounds:
        if bound is None:
            return out.otherwise(name)
        out = out.when(value < bound if rising else value >= bound, name)
    return out


def percentile_level(p: Column) -> Column:
    return band(p, PERCENTILE_BANDS)


def score_level(score: Column) -> Column:
    return band(score, SCORE_BANDS)


def peg_level(value: Column) -> Column:
    """Bands of a positive PEG; others are null."""
    return band(F.when(value > 0, value), PEG_BANDS, rising=True)


def announcement_date(*candidates: Column) -> Column:
    """The first that is known."""
    return F.coalesce(*candidates)


def exempted(rules: Column, rule: str) -> Column:
    return F.coalesce(F.array_contains(rules, rule), F.lit(False))


def score_breakdown() -> Column:
    """Nested, labelled struct of a score row's flags and metrics."""
    flag = lambda name: (F.col(name) == 1).alias(name.removeprefix("f_"))
    return F.struct(
        F.col("f_score").alias("total"),
        score_level(F.col("f_score")).alias("level"),
        F.struct(*map(flag, ("f_roa", "f_cfo", "f_delta_roa", "f_accrual"))).alias("profitability"),
        F.struct(*map(flag, ("f_delta_lever", "f_delta_liquid", "f_eq_offer"))).alias("safety"),
        F.struct(*map(flag, ("f_delta_margin", "f_delta_turn"))).alias("efficiency"),
        F.struct("roe_5y_avg", "ni_cfo_corr_3y", "debt_ratio", "current_ratio").alias("metrics"),
    )


def list_to_json(values: Column) -> Column:
    return F.to_json(F.coalesce(values, F.array().cast("array<string>")))


def canonical_frequency(name: Column) -> Column:
    """``minute_5`` -> ``5m``; names already short stay, ``daily``, ``weekly`` and ``monthly`` become 1d, 1w and 1mo."""
    minutes = F.regexp_extract(name, r"^minute_([0-9]+)$", 1)
    return F.when(minutes != "", F.concat(minutes, F.lit("m"))).when(name == "daily", "1d").when(name == "weekly", "1w").when(name == "monthly", "1mo").otherwise(name)


def pick_column_with_values(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` that has any value in the table: one aggregate over it."""
    have = [n for n in names if n in df.columns]
    if not have:
        return None
    counts = df.agg(*[F.count(n).alias(n) for n in have]).first()
    return next((n for n in have if counts[n]), None)

"""Industry configuration: which ratio values an industry, its phase of the cycle, its exemptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "l3_name string, macro_cycle string, core_indicator string, ref_indicator string, logic string, exemptions array<string>"


def load(spark: SparkSession, path: str) -> DataFrame:
    """From a JSON object {l3_name: {...}} in one file, or from JSON lines of SCHEMA."""
    entry = "struct<macro_cycle:string,core_indicator:string,ref_indicator:string,logic:string,exemptions:array<string>>"
    whole = spark.read.text(path, wholetext=True)
    mapped = whole.select(F.explode(F.from_json("value", f"map<string,{entry}>")).alias("l3_name", "c")).select("l3_name", "c.*")
    return mapped if mapped.where("l3_name = 'l3_name'").limit(1).count() == 0 else spark.read.schema(SCHEMA).json(path)


def with_defaults(config: DataFrame) -> DataFrame:
    """Missing settings become PE, PB and no exemptions."""
    return config.select("l3_name", "macro_cycle", F.coalesce("core_indicator", F.lit("PE")).alias("core_indicator"), F.coalesce("ref_indicator", F.lit("PB")).alias("ref_indicator"), "logic", F.coalesce("exemptions", F.array().cast("array<string>")).alias("exemptions"))


def by_indicator(config: DataFrame, indicator: str) -> DataFrame:
    """Industries whose core ratio is ``indicator``."""
    return with_defaults(config).where(F.col("core_indicator") == indicator.upper()).select("l3_name").orderBy("l3_name")


def missing_from_config(members: DataFrame, config: DataFrame, show: int = 20) -> DataFrame:
    """Current industries that the configuration doesn't name, the first ``show`` by name."""
    current = members.where((F.col("is_new") == "Y") & F.col("l3_name").isNotNull()).select("l3_name").distinct()
    return current.join(config.select("l3_name"), "l3_name", "left_anti").orderBy("l3_name").limit(show)


def require_covered(members: DataFrame, config: DataFrame) -> None:
    missing = [r[0] for r in missing_from_config(members, config).collect()]
    if missing:
        raise ValueError(f"industries without configuration: {', '.join(missing)}")

"""Market tables derived from the generic input tables, as one SQL text for Spark and for the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
FX = {
    "fx_bars": """
SELECT symbol, time, max(CASE WHEN rn = 1 THEN px END) AS open, max(px) AS high, min(px) AS low, max(CASE WHEN rn = c THEN px END) AS close,
       CAST(sum(l_quantity) AS BIGINT) AS volume, round(sum(l_extendedprice), 2) AS amount
FROM (SELECT l_suppkey AS symbol, l_shipdate AS time, l_extendedprice / l_quantity AS px, l_quantity, l_extendedprice,
             row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS rn,
             count(*) OVER (PARTITION BY l_suppkey, l_shipdate) AS c
      FROM {lineitem}) l
GROUP BY symbol, time""",
    "fx_adj_factor": "SELECT symbol, time, 1.0E0 + 0.05E0 * (year(time) - 1995) * (1 + symbol % 3) AS adj_factor FROM fx_bars WHERE symbol % 10 <> 9",
    "fx_factored": "SELECT b.*, coalesce(f.adj_factor, 1.0E0) AS adj_factor FROM fx_bars b LEFT JOIN fx_adj_factor f ON b.symbol = f.symbol AND b.time = f.time",
    "fx_ratios": """
SELECT symbol, time, CASE WHEN (symbol + day(time)) % 11 = 0 THEN NULL WHEN (symbol + day(time)) % 13 = 0 THEN -1.0E0 ELSE close / (10 + symbol % 7) END AS pe_ttm,
       close / 500.0E0 AS pb, amount / 20000.0E0 AS ps_ttm, (symbol % 5) * 0.5E0 AS dv_ttm
FROM fx_bars""",
    "fx_quarters": """
SELECT c.c_nationkey AS ts_code, year(o.o_orderdate) AS y, quarter(o.o_orderdate) AS q, round(sum(o.o_totalprice), 2) AS amt,
       round(sum(CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice ELSE 0 END), 2) AS amt_f,
       round(sum(CASE WHEN o.o_orderstatus = 'P' THEN o.o_totalprice ELSE 0 END), 2) AS amt_p, count(*) AS n
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3""",
    "fx_statements": """
SELECT ts_code, y, q, make_date(y, q * 3, CASE WHEN q IN (1, 4) THEN 31 ELSE 30 END) AS end_date,
       round(sum(amt) OVER yt, 2) AS n_income, round(sum(amt_f) OVER yt * 3, 2) AS n_cashflow_act, sum(amt_f) OVER yt / sum(amt) OVER yt * 20 AS roa,
       amt_p / amt * 100 AS q_gsprofit_margin, amt_f / amt * 30 AS q_netprofit_margin, round(sum(amt) OVER al, 2) AS total_assets,
       round(sum(amt_p) OVER al, 2) AS total_ncl, round(sum(amt_f) OVER al, 2) AS total_liab, sum(n) OVER al AS total_share
FROM fx_quarters
WINDOW yt AS (PARTITION BY ts_code, y ORDER BY q), al AS (PARTITION BY ts_code ORDER BY y, q)""",
    "fx_growth": """
SELECT s.s_suppkey AS symbol, f.end_date, CAST(f.end_date + CAST(30 + f.ts_code % 20 AS INT) AS TIMESTAMP) AS ann_date,
       CASE WHEN f.q = 2 THEN NULL ELSE f.q_gsprofit_margin - 20 END AS netprofit_yoy
FROM fx_statements f JOIN {supplier} s ON s.s_nationkey = f.ts_code""",
    "fx_members": """
SELECT s.s_suppkey AS ts_code, r.r_name AS l1_name, n.n_name AS l2_name, concat(n.n_name, '-', CAST(s.s_suppkey % 2 AS VARCHAR(2))) AS l3_name, 'Y' AS is_new
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "fx_config": """
SELECT l3_name, CASE k % 4 WHEN 0 THEN 'REFLATION' WHEN 1 THEN 'RECOVERY' WHEN 2 THEN 'OVERHEAT' ELSE 'STAGFLATION' END AS macro_cycle,
       CASE k % 4 WHEN 0 THEN 'PE' WHEN 1 THEN 'PB' WHEN 2 THEN 'PS' ELSE 'PEG' END AS core_indicator, CASE k % 2 WHEN 0 THEN 'PB' ELSE 'PS' END AS ref_indicator,
       'by rank' AS logic, CASE WHEN k % 3 = 0 THEN 'f_score_gross_margin' END AS exemption
FROM (SELECT l3_name, row_number() OVER (ORDER BY l3_name) AS k FROM (SELECT DISTINCT l3_name FROM fx_members) a) b WHERE k % 5 <> 4""",
    "fx_macro_month": """
SELECT make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start, 5.0E0 + count(*) % 9 AS m2_yoy, (count(*) % 7) - 3.0E0 AS ppi_yoy, 48.0E0 + count(*) % 6 AS pmi
FROM {orders} GROUP BY 1""",
    "fx_gdp": "SELECT last_day(month_start) AS time, 4.0E0 + (year(month_start) + quarter(month_start)) % 6 AS gdp_yoy FROM fx_macro_month WHERE month(month_start) % 3 = 0",
    "fx_ticks": "SELECT event_id, user_id AS symbol, ts AS time, value AS price, event_type AS side FROM {events}",
}


def needed(body: str) -> list[str]:
    """The derived tables that a text names, those they rest on first."""
    out: list[str] = []

    def add(text: str) -> None:
        for name in FX:
            if name not in out and re.search(rf"\b{name}\b", text):
                add(FX[name])
                if name not in out:
                    out.append(name)

    add(body)
    return out


def oracle(body: str, recursive: bool = False, prelude: str = "") -> str:
    """``body`` for DuckDB, with the derived tables that it names."""
    parts = [f"{n} AS ({FX[n]})" for n in needed(body + prelude)] + ([prelude] if prelude else [])
    text = (f"WITH {'RECURSIVE ' if recursive else ''}" + ", ".join(parts) + " " if parts else "") + body
    return re.sub(r"\{(\w+)\}", r"\1", text)


#: Folders with derived tables written by ``store``, by folder of the input tables.
STORED: dict[str, str] = {}


def store(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write all derived tables once, bars and what goes with them sorted by symbol and time, so that ``load`` reads them."""
    for name in FX:
        df = load(spark, sf_dir, name)
        by = [c for c in ("symbol", "time") if c in df.columns]
        (df.repartitionByRange(*by).sortWithinPartitions(*by) if len(by) == 2 else df).write.parquet(f"{path}/{name}")
    STORED[sf_dir] = path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, or an input table by its name."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if sf_dir in STORED:
        return spark.read.parquet(f"{STORED[sf_dir]}/{name}")
    text = "WITH " + ", ".join(f"{n} AS ({FX[n]})" for n in needed(name)) + f" SELECT * FROM {name}"
    return spark.sql(re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", text))

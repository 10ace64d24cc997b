"""Golden values, edge cases, storage and streams of the market operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import calendar as cal
from tapeloom.functions import industry, rules
from tapeloom.operators import adjust as adj
from tapeloom.operators import indicators as ind
from tapeloom.operators import joins, macro, resample, statements, valuation
from tapeloom.operators.scan import affine_scan
from tapeloom.plans import incremental
from tapeloom.plans.hub import Hub
from tapeloom.plans.pipeline import Pipeline
from tapeloom.sources import schemas, tables
from tapeloom.streaming import ticks

D = dt.date


def bars(spark, rows):
    return spark.createDataFrame([(s, dt.datetime.fromisoformat(t), float(o), float(h), float(lo), float(c), v, float(f)) for s, t, o, h, lo, c, v, f in rows], "symbol string, time timestamp, open double, high double, low double, close double, volume long, adj_factor double")


def test_forward_adjustment_scales_by_latest_factor(spark):
    b = bars(spark, [("a", "2024-01-02", 10, 11, 9, 10, 5, 1.0), ("a", "2024-01-03", 10, 11, 9, 10, 5, 1.1), ("z", "2024-01-02", 10, 11, 9, 10, 5, 0.0)])
    got = {(r.symbol, r.time.day): r for r in adj.adjust(b).collect()}
    assert got["a", 2].close == pytest.approx(10 / 1.1) and got["a", 3].close == pytest.approx(10)
    assert got["z", 2].close == 10 and not got["z", 2].adjusted and got["z", 2].adjust_type == "qfq"
    with pytest.raises(ValueError):
        adj.adjust(b.drop("adj_factor"))


def test_resampling_refuses_unadjusted_bars(spark):
    b = adj.adjust(bars(spark, [("a", "2024-01-02", 10, 11, 9, 10, 5, 1.0)]), "none")
    with pytest.raises(ValueError):
        resample.resample(b, "W")
    assert resample.resample(b, "W", check_adjusted=False).first().time == D(2024, 1, 5)


def test_resample_drops_periods_without_open_and_sums_nulls_to_zero(spark):
    b = spark.createDataFrame([("a", dt.datetime(2024, 1, 2), None, None), ("a", dt.datetime(2024, 1, 9), 1.0, None)], "symbol string, time timestamp, open double, volume long")
    got = resample.resample(b, "W").collect()
    assert [(r.time, r.volume) for r in got] == [(D(2024, 1, 12), 0)]


def test_affine_scan_matches_recurrence_over_many_blocks(spark):
    import random

    random.seed(1)
    x = [random.gauss(0, 1) if i % 37 else None for i in range(1500)]
    b = spark.createDataFrame([("a", i, v) for i, v in enumerate(x)], "symbol string, time int, close double")
    for n, block in ((9, 1024), (26, 64), (50, 7), (1, 1024)):
        a = 2 / (n + 1)
        got = {r.time: r.y for r in affine_scan(b, "close", a, "y", block=block).collect()}
        y = None
        for i, v in enumerate(x):
            if v is not None:
                y = v if y is None else (1 - a) * y + a * v
            assert (got[i] is None) == (y is None) and (y is None or abs(got[i] - y) < 1e-9)


def test_registry(spark):
    assert ind.list_indicators() == ["atr_14", "ema_20", "ema_50", "ma_20", "ma_50", "macd", "nda", "rsi_14", "tr"]
    with pytest.raises(KeyError):
        ind.create_indicator("none")
    ind.register_indicator("ma_3", lambda: ind.MA(3))
    assert ind.is_registered("ma_3") and ind.create_indicator("ma_3").columns == ["ma_3"]
    del ind.REGISTRY["ma_3"]
    with pytest.raises(ValueError):
        ind.NDA().apply(spark.createDataFrame([("a", 1)], "symbol string, time int"))


def test_ttm_golden(spark):
    ends = [D(2022, 3, 31), D(2022, 6, 30), D(2022, 9, 30), D(2022, 12, 31), D(2023, 3, 31), D(2023, 6, 30), D(2023, 9, 30)]
    df = spark.createDataFrame([("a", e, v) for e, v in zip(ends, [3.0, 6.5, 10.0, 14.0, 3.5, 7.0, 11.0])], "ts_code string, end_date date, roa double")
    got = [r.t for r in df.select("end_date", statements.ttm_from_cumulative("roa").alias("t")).orderBy("end_date").collect()]
    assert got == [None, None, None, 14.0, 14.5, 14.5, 15.0]


def test_roe_over_five_years(spark):
    days = [D(2018 + k // 4, 3 * (k % 4) + 3, 28) for k in range(20)]
    df = spark.createDataFrame([("a", e, 2.5) for e in days] + [("b", e, v) for e, v in zip(days, [2.5, 3.0, 2.8, 3.2])], "ts_code string, end_date date, q_roe double")
    got = {(r.ts_code, r.end_date): r.roe_5y_avg for r in statements.with_roe_5y_avg(df).collect()}
    assert got["a", days[-1]] == pytest.approx(10.0) and got["b", days[3]] == pytest.approx(2.3) and got["b", days[2]] is None


def test_correlation_without_variance_is_null(spark):
    df = spark.createDataFrame([("a", D(2020, k, 1), 1.0, float(k)) for k in range(1, 7)], "ts_code string, end_date date, x double, y double")
    assert [r[0] for r in df.select(statements.rolling_corr("x", "y")).collect()] == [None] * 6


def test_macro_golden(spark):
    days = [D(2025, m, 28) for m in (1, 2, 3, 4)]
    series = lambda name, values: spark.createDataFrame(list(zip(days, map(float, values))), f"time date, {name} double")
    gdp = spark.createDataFrame([(D(2024, 12, 31), 5.0), (D(2025, 3, 31), 5.0)], "time date, gdp_yoy double")
    got = macro.macro_cycle(series("m2_yoy", [7, 7, 7, 4]), series("ppi_yoy", [-2, 1, 1, 3]), series("pmi010000", [50, 51, 51, 51]), gdp).orderBy("observation_time").collect()
    assert [r.raw_phase for r in got] == ["REFLATION", "RECOVERY", "RECOVERY", "OVERHEAT"]
    assert [r.stable_phase for r in got] == ["REFLATION", "REFLATION", "RECOVERY", "RECOVERY"]
    assert [r.stable_phase_changed for r in got] == [False, False, True, False] and got[0].time == D(2025, 2, 28)


def test_pmi_falls_back_to_the_column_with_values(spark):
    df = spark.createDataFrame([(None, 50.5)], "pmi010000 double, pmi030000 double")
    assert rules.pick_column_with_values(df, ["pmi010000", "pmi030000"]) == "pmi030000"


def test_asof_keeps_a_matched_null(spark):
    left = spark.createDataFrame([("a", D(2024, 1, 5)), ("a", D(2024, 1, 1)), ("b", D(2024, 1, 5))], "k string, time date")
    right = spark.createDataFrame([("a", D(2024, 1, 2), 1.0), ("a", D(2024, 1, 5), None)], "k string, at date, v double")
    got = {(r.k, r.time): (r["at"], r.v) for r in joins.asof_join(left, right, "time", "at", ["k"]).collect()}
    assert got == {("a", D(2024, 1, 5)): (D(2024, 1, 5), None), ("a", D(2024, 1, 1)): (None, None), ("b", D(2024, 1, 5)): (None, None)}


def test_incremental_rules_golden(spark):
    src = spark.createDataFrame([("a", D(2026, 4, 9))], "symbol string, latest date")
    done = spark.createDataFrame([("a", "daily", D(2026, 4, 8)), ("a", "weekly", D(2026, 4, 10)), ("a", "monthly", D(2026, 3, 31))], "symbol string, freq string, latest date")
    got = {r.freq: (r.start_date, r.inclusive) for r in incremental.upsert_rules(src, done).collect()}
    assert got == {"daily": (D(2026, 4, 8), False), "weekly": (D(2026, 4, 10), True), "monthly": (D(2026, 3, 31), False)}
    need = {r.freq: (r.bars, r.records, r.days) for r in incremental.warmup(spark).collect()}
    assert need == {"daily": (80, 80, 160), "weekly": (70, 350, 490), "monthly": (50, 1100, 1550)}
    assert {r.freq: r.bars for r in incremental.warmup(spark, ["tr", "unknown"]).collect()} == {"daily": 80, "weekly": 70, "monthly": 30}


def test_percentile_levels_and_flags(spark):
    df = spark.createDataFrame([(85.0,), (80.0,), (20.0,), (5.0,), (None,)], "p double").select(rules.percentile_level(F.col("p")))
    assert [r[0] for r in df.collect()] == ["very high", "very high", "low", "very low", None]


def test_cross_section_needs_three(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "x", 1.0), (1, "x", 2.0), (1, "y", 1.0), (1, None, 1.0)], "time int, l2_name string, v double")
    got = df.select("l2_name", valuation.cross_section_percentile("v").alias("p")).collect()
    assert sorted(r.p for r in got if r.l2_name == "x") == pytest.approx([50.0, 50.0, 100.0]) and all(r.p is None for r in got if r.l2_name != "x")


def test_conform_rejects_bad_keys_and_refuses_unknown_columns(spark):
    d = schemas.DATASETS["daily"]
    raw = spark.createDataFrame([("600000.SH", "20240102", "1.5", "x"), (None, "20240102", "2", "3"), ("600000.SH", "bad", "2", "3")], "symbol string, time string, close string, volume string")
    good, bad = schemas.conform(raw, d)
    assert [(r.symbol, r.close, r.volume) for r in good.collect()] == [("600000.SH", 1.5, None)] and bad.count() == 2
    assert schemas.conform(raw, d, int_null_fill=0)[0].first().volume == 0
    with pytest.raises(ValueError):
        schemas.conform(raw.withColumn("extra", F.lit(1)), d, strict=True)
    with pytest.raises(ValueError):
        schemas.conform(raw.drop("symbol"), d)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_landing(spark, tmp_path, fmt):
    rows = spark.createDataFrame([("a", "20240102", "1"), ("a", "20240102", "2"), ("b", "2024-01-03", "3")], "ts_code string, trade_date string, adj_factor string")
    rows.write.format(fmt).option("header", True).save(f"{tmp_path}/in")
    good, rejects = schemas.land(spark, f"{tmp_path}/in", "adj_factor", fmt)
    assert {(r.symbol, r.adj_factor) for r in good.collect()} == {("a", 2.0), ("b", 3.0)} and rejects.count() == 0


def test_every_dataset_conforms_an_empty_frame(spark):
    for d in schemas.DATASETS.values():
        empty = spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in d.fields))
        good, _ = schemas.conform(empty, d)
        assert good.columns == [c for c, _ in d.fields] and good.count() == 0


def test_write_upsert_touches_only_its_partitions(spark, tmp_path):
    p = f"{tmp_path}/t"
    df = lambda rows: spark.createDataFrame(rows, "symbol string, day int, v int, month int")
    tables.write_upsert(spark, p, df([("a", 1, 1, 1), ("a", 2, 1, 2)]), ["symbol", "day"], ["month"])
    tables.write_upsert(spark, p, df([("a", 2, 9, 2), ("b", 2, 5, 2)]), ["symbol", "day"], ["month"])
    assert {(r.symbol, r.day, r.v) for r in tables.read(spark, p).collect()} == {("a", 1, 1), ("a", 2, 9), ("b", 2, 5)}
    q = f"{tmp_path}/u"
    tables.write_upsert(spark, q, df([("a", 1, 1, 1)]), ["symbol", "day"])
    tables.write_upsert(spark, q, df([("a", 1, 2, 1)]), ["symbol", "day"], keep="first")
    assert [r.v for r in tables.read(spark, q).collect()] == [1]
    tables.truncate(spark, q)
    assert tables.read(spark, q).count() == 0


def test_export_and_run_log(spark, tmp_path):
    b = bars(spark, [("a", "2024-01-02", 10, 11, 9, 10, 5, 1.0), ("b", "2024-02-02", 10, 11, 9, 10, 5, 1.0)])
    tables.export(b, f"{tmp_path}/e", "2024-01-01", "2024-12-31", ["a", "b"])
    assert sorted((r.year, r.month) for r in spark.read.parquet(f"{tmp_path}/e").collect()) == [(2024, 1), (2024, 2)]
    tables.log_run(spark, f"{tmp_path}/log", "job", "ok", 2)
    tables.log_run(spark, f"{tmp_path}/log", "job", "ok", 3)
    assert spark.read.parquet(f"{tmp_path}/log").count() == 2


def test_industry_config_defaults(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"Banks": {"core_indicator": "PB", "exemptions": ["f_score_leverage"]}, "Steel": {}}', encoding="utf-8")
    c = industry.load(spark, f"{tmp_path}/c.json")
    got = {r.l3_name: (r.core_indicator, r.ref_indicator, r.exemptions) for r in industry.with_defaults(c).collect()}
    assert got == {"Banks": ("PB", "PB", ["f_score_leverage"]), "Steel": ("PE", "PB", [])}
    members = spark.createDataFrame([("1", "Banks", "Y"), ("2", "Tea", "Y")], "ts_code string, l3_name string, is_new string")
    with pytest.raises(ValueError, match="Tea"):
        industry.require_covered(members, c)


def test_hub_rules(spark):
    w = spark.createDataFrame([("i", "c", D(2024, 1, 1), 1.0)], "index_code string, con_code string, trade_date date, weight double")
    hub = Hub({"index_weight": w})
    assert hub.get_index_weight(day="2024-01-01").count() == 1 and hub.get_index_weight(start="2024-01-02").count() == 0
    with pytest.raises(ValueError):
        hub.get_index_weight(day="2024-01-01", start="2024-01-01")
    days = spark.createDataFrame([("SSE", D(2024, 1, 1), 0), ("SSE", D(2024, 1, 2), 1)], "exchange string, cal_date date, is_open int")
    assert [r.cal_date for r in Hub({"trade_cal": days}).get_calendar("sse", is_open=1).collect()] == [D(2024, 1, 2)]


def test_day_filters_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnsRenamed({"ts": "time", "user_id": "symbol"})
    plan = Hub({"daily": df}).get("daily", [1, 2], "2024-01-01", "2024-01-31", columns=["value"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(user_id" in plan or "In(user_id, [1,2])" in plan and "ReadSchema" in plan


def test_pipeline_is_immutable(spark):
    b = bars(spark, [("a", "2024-01-02", 10, 11, 9, 10, 5, 1.0), ("a", "2024-01-09", 10, 11, 9, 12, 5, 1.0)])
    p = Pipeline(b)
    q = p.adjust().indicators("tr").resample("W")
    assert p.steps == () and set(q.run_with_resample()) == {"daily", "W"} and "tr" in q.run_with_resample()["W"].columns
    assert q.reset() == p


def test_calendar_column_functions(spark):
    df = spark.createDataFrame([("2025Q1", "202402"), ("2025Q5", "202413"), (None, None)], "q string, m string")
    got = df.select(cal.quarter_to_date(F.col("q")), cal.month_to_date(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [(D(2025, 3, 31), D(2024, 2, 29)), (None, None), (None, None)]


def tick_folder(spark, tmp_path):
    rows = [("a", dt.datetime(2024, 1, 2, 1, m), float(m), 10) for m in (0, 1, 2, 6, 7)]
    df = spark.createDataFrame(rows + rows[:2], "symbol string, time timestamp, price double, volume long")
    df.write.parquet(f"{tmp_path}/ticks")
    return spark.readStream.schema(df.schema).parquet(f"{tmp_path}/ticks")


def test_archive_drops_repeats(spark, tmp_path):
    ticks.archive_ticks(tick_folder(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == 5 and "date" in got.columns


def test_stream_of_bars(spark, tmp_path):
    s = ticks.ticks_to_bars(tick_folder(spark, tmp_path), "5 minutes", "0 seconds")
    s.writeStream.format("memory").queryName("bars_out").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.time.minute, r.open, r.close, r.ticks) for r in spark.sql("SELECT * FROM bars_out").collect())
    assert got == [(0, 0.0, 2.0, 5), (5, 6.0, 7.0, 2)]


def test_rollup_and_factor_streams(spark, tmp_path):
    b = bars(spark, [("a", "2024-01-02", 10, 11, 9, 10, 5, 1.0), ("a", "2024-01-03", 10, 12, 9, 11, 5, 1.0)])
    b.write.parquet(f"{tmp_path}/bars")
    stream = lambda: spark.readStream.schema(b.schema).parquet(f"{tmp_path}/bars")
    ticks.incremental_rollup(stream(), lambda s: s.read.parquet(f"{tmp_path}/bars"), f"{tmp_path}/weekly", f"{tmp_path}/cp1", now="2024-01-10").awaitTermination()
    assert [(r.high, r.close) for r in tables.read(spark, f"{tmp_path}/weekly").collect()] == [(12.0, 11.0)]
    job = lambda s, symbols: s.read.parquet(f"{tmp_path}/bars").join(symbols, "symbol", "left_semi")
    ticks.recompute_on_factor_change(stream(), f"{tmp_path}/adj", f"{tmp_path}/cp2", job).awaitTermination()
    assert tables.read(spark, f"{tmp_path}/adj").count() == 2


def test_entry_imports_without_optional_parts(spark, tmp_path):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and e.entry(spark).count() > 0
    root = Path(e.__file__).parent
    shutil.copytree(root / "tapeloom", tmp_path / "tapeloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    from tapeloom.plans import catalog

    assert said.stdout.split()[-2:] == [str(len(catalog.QUERIES))] * 2, said.stderr


def test_upsert_leaves_columns_that_the_new_rows_lack(spark):
    base = spark.createDataFrame([("a", 1, 5.0, "x"), ("b", 1, 6.0, "y")], "symbol string, day int, amount double, note string")
    new = spark.createDataFrame([("a", 1, "new"), ("c", 1, "z")], "symbol string, day int, note string")
    got = {r.symbol: (r.amount, r.note) for r in tables.upsert(base, new, ["symbol", "day"]).collect()}
    assert got == {"a": (5.0, "new"), "b": (6.0, "y"), "c": (None, "z")}


def test_hub_refuses_keys_without_a_key_column_and_unrestricted_bars(spark):
    hub = Hub({"gdp": spark.range(1).withColumn("time", F.current_timestamp()), "daily": bars(spark, [("a", "2024-01-02", 10, 11, 9, 10, 5, 1.0)])})
    with pytest.raises(ValueError):
        hub.get("gdp", ["a"])
    assert hub.get_daily().count() == 0 and hub.get_daily(["a"]).count() == 1

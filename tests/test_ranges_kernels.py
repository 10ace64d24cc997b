"""Long keys cut into ranges: as-of joins, scans and kernels give the same rows, from several tasks; gaps of minutes; landing run by run."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import indicators as ind
from tapeloom.operators import kernels, ranges, valuation
from tapeloom.operators.joins import asof_join
from tapeloom.operators.scan import affine_scan
from tapeloom.plans import incremental
from tapeloom.sources import landing, tables

T0 = dt.datetime(2024, 1, 1)


def hour(n):
    return T0 + dt.timedelta(hours=n)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(2)
    left = [(rng.choice(["hot"] * 5 + ["a", "b", None]), hour(rng.randrange(2000)), i) for i in range(2000)] + [("hot", None, -1)]
    right = [(rng.choice(["hot"] * 3 + ["a", "c", None]), hour(rng.randrange(300, 1800)), i, rng.choice([None, 1.5])) for i in range(150)]
    return spark.createDataFrame(left, "k string, t timestamp, i int"), spark.createDataFrame(right, "k string, rt timestamp, j int, v double")


@pytest.mark.parametrize("by", [["k"], []])
def test_asof_join_over_ranges(sides, by):
    left, right = sides[0], sides[1] if by else sides[1].drop("k")
    want = sorted(map(repr, asof_join(left, right, "t", "rt", by, tie=["j"]).collect()))
    for rows in (50, 10**6):
        assert sorted(map(repr, asof_join(left, right, "t", "rt", by, tie=["j"], rows=rows).collect())) == want


def test_ranges_are_bounded_and_overlap(sides):
    left = sides[0]
    rows, overlap = 100, 60
    got = ranges.cut(left, ["k"], "t", rows, overlap).collect()
    own = [r for r in got if r["__own"]]
    assert sorted((r.k or "", r.i) for r in own) == sorted((r.k or "", r.i) for r in left.collect())
    by_day = max(n for (n,) in left.groupBy("k", F.to_date("t")).count().select("count").collect())
    early = lambda r: r.t or dt.datetime.min
    for key in {r.k for r in own}:
        mine = sorted((r for r in own if r.k == key), key=early)
        for n in {r["__range"] for r in mine}:
            inside = [r for r in mine if r["__range"] == n]
            assert len(inside) <= rows + by_day
            first = min(map(early, inside))
            before = sum(early(r) < first for r in mine)
            warm = [r for r in got if r.k == key and r["__range"] == n and not r["__own"]]
            assert all(early(r) < first for r in warm) and len(warm) >= min(before, overlap)
    assert len({r["__range"] for r in own if r.k == "hot"}) > 5
    with pytest.raises(ValueError):
        ranges.cut(left, ["k"], "t", 10, 11)


def test_a_key_with_half_of_all_rows_spreads_over_tasks(spark, sides):
    left, right = sides
    out = asof_join(left, right, "t", "rt", ["k"], tie=["j"], rows=100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = ranges.cut(left, ["k"], "t", 100).repartition(16, "k", "__range").where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(tasks) > 5 and "hashpartitioning(k" in plan and "__range" in plan


@pytest.mark.parametrize(("seed", "span", "alpha"), [("first", 1, 0.1), ("sma", 20, 2 / 21), ("sma", 300, 1 / 300), ("first", 1, 1.0)])
def test_scan_in_two_phases(spark, seed, span, alpha):
    rng = random.Random(span)
    rows = [(k, hour(h), None if rng.random() < 0.2 or (k == "hot" and 500 < h < 900) else rng.gauss(0, 1)) for k, n in (("hot", 1500), ("a", 30), (None, 5)) for h in range(n)]
    df = spark.createDataFrame(rows, "symbol string, time timestamp, close double")
    scan = lambda **x: {(r.symbol, r.time): r.y for r in affine_scan(df, "close", alpha, "y", seed=seed, span=span, **x).collect()}
    want = scan()
    for n in (24, 400):
        got = scan(rows=n)
        assert got.keys() == want.keys()
        assert all((got[k] is None) == (v is None) and (v is None or got[k] == pytest.approx(v, abs=1e-12)) for k, v in want.items())


def test_count_below_against_all_pairs():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 100, 257):
        x = rng.integers(0, 40, n).astype(float)
        start = np.array([rng.integers(0, i + 1) for i in range(n)], np.int64)
        assert kernels.count_below(x, start).tolist() == [int((x[s:i] < x[i]).sum()) for i, s in enumerate(start)]


def test_percentiles_of_nulls_ties_and_long_symbols(spark):
    rng = random.Random(5)
    rows = [(s, hour(24 * i), rng.choice([None, -1.0, 0.0, 1.0, 2.0, 3.5, rng.random()])) for s in ("a", "b") for i in range(400)] + [("c", hour(0), 1.0)]
    df = spark.createDataFrame(rows, "symbol string, time timestamp, pb double")

    def brute(window, least):
        out = {}
        for s in "abc":
            x = [v for k, _, v in rows if k == s]
            for i, v in enumerate(x):
                w = [u for u in x[max(0, i - window + 1) : i + 1] if u is not None]
                pos = [u for u in w if u > 0]
                out[s, i] = sum(u < v for u in pos) / len(pos) * 100 if v is not None and v > 0 and len(w) >= least and len(pos) >= 2 else None
        return out

    for window, cut in ((50, 200_000), (50, 60), (10, 200_000)):
        got = {(r.symbol, (r.time - T0).days): r[f"pb_pct_{window}d"] for r in valuation.rolling_percentile(df, ["pb"], [window], 5, cut).collect()}
        assert {k: v if v is None else round(v, 9) for k, v in got.items()} == {k: v if v is None else round(v, 9) for k, v in brute(window, 5).items()}


def test_kernels_check_what_they_get_and_give(spark):
    df = spark.createDataFrame([("a", hour(1), 1.0), ("a", hour(0), 3.0), ("b", None, None)], "symbol string, time timestamp, close double")
    k = ind.Kernel("first_close", "first_close double, seen int", lambda f: f.assign(first_close=f["close"].iloc[0], seen=range(1, len(f) + 1)))
    got = {(r.symbol, r.close): (r.first_close, r.seen) for r in k.apply(df).collect()}
    assert got == {("a", 3.0): (3.0, 1), ("a", 1.0): (3.0, 2), ("b", None): (None, 1)}
    with pytest.raises(ValueError):
        k.apply(df.drop("close"))
    with pytest.raises(Exception, match="one row for each row"):
        ind.Kernel("short", "x double", lambda f: f.assign(x=1.0).head(1)).apply(df).collect()
    assert k.apply(df.limit(0)).count() == 0


def test_minute_gaps_golden(spark):
    symbols = spark.createDataFrame([("cn", "CN"), ("us", "US"), ("none", "CN"), ("jp", "JP")], "symbol string, market string")
    days = spark.createDataFrame([(m, dt.date(2024, 7, d)) for m in ("CN", "US") for d in (5, 8)], "market string, day date")
    minutes = lambda d, a, b: [dt.datetime(2024, 7, d) + dt.timedelta(minutes=m) for m in range(a, b + 1)]
    cn = [t - dt.timedelta(hours=8) for t in [*minutes(5, 570, 688), *minutes(5, 782, 900), *minutes(8, 570, 690), *minutes(8, 780, 899), *minutes(6, 570, 600), *minutes(8, 700, 720)]]
    us = [t + dt.timedelta(hours=4) for t in [*minutes(5, 571, 960), *minutes(8, 570, 960)]]  # summer time
    have = spark.createDataFrame([("cn", t) for t in cn + cn[:3]] + [("us", t) for t in us] + [("cn", None), ("other", us[0])], "symbol string, time timestamp")
    got = sorted((r.symbol, r.fetch_from, r.fetch_to, r.n_minutes) for r in incremental.minute_gaps(symbols, have, days).collect())
    utc = lambda d, m, h: dt.datetime(2024, 7, d) + dt.timedelta(minutes=m) - dt.timedelta(hours=h)
    assert got == [
        ("cn", utc(5, 689, 8), utc(5, 781, 8), 4),  # over the break
        ("cn", utc(8, 900, 8), utc(8, 900, 8), 1),
        ("none", utc(5, 570, 8), utc(8, 900, 8), 484),
        ("us", utc(5, 570, -4), utc(5, 570, -4), 1),
    ]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_landing_run_by_run(spark, tmp_path, fmt):
    folder, target = tmp_path / "in", f"{tmp_path}/t"
    folder.mkdir()
    files = {
        "json": ['{"ts_code":"a","trade_date":"20240102","adj_factor":"1"}\n{"ts_code":"a","trade_date":\n{"trade_date":"20240102"}\n\n', '{"symbol":"a","time":"2024-01-02","adj_factor":2}\n{"ts_code":"b","trade_date":"never"}\n{"ts_code":"b","trade_date":"20240103"}\n'],
        "csv": ["ts_code,trade_date,adj_factor\na,20240102,1\na,20240102,1,too,many\n,20240102,\n", "ts_code,trade_date,adj_factor\na,2024-01-02,2\nb,never,\nb,20240103,\n"],
    }[fmt]
    run = lambda: landing.land_new(spark, str(folder), "adj_factor", target, fmt, columns="ts_code,trade_date,adj_factor")
    rows = lambda: {(r.symbol, r.time.day, r.adj_factor) for r in tables.read(spark, target).collect()}
    (folder / f"1.{fmt}").write_text(files[0])
    assert run() == 1 and rows() == {("a", 2, 1.0)}
    (folder / f"2.{fmt}").write_text(files[1])
    assert run() == 2 and rows() == {("a", 2, 2.0), ("b", 3, None)}
    assert run() == 2  # nothing new
    counts = {r.batch: (r.n_files, r.n_records, r.n_rows, r.n_rejects) for r in landing.runs(spark, target).collect()}
    assert counts == {0: (1, 3, 1, 2), 1: (1, 3, 2, 1)}
    assert sorted((r.batch, r.file[-6:].strip("/"), r.reason) for r in landing.rejects(spark, target).collect()) == sorted((b, f"{b + 1}.{fmt}"[-6:], why) for b, why in ((0, "can't be parsed"), (0, "no symbol"), (1, "no time")))
    with pytest.raises(ValueError):
        landing.land_new(spark, str(folder), "adj_factor", target, "orc")

"""What a task holds doesn't grow with the table: landed files, dealt keys, carries."""

import pytest
from oracle import differences
from pyspark.sql import functions as F

from tapeloom.operators import ranges
from tapeloom.operators.scan import affine_scan
from tapeloom.plans import catalog, catalog_jobs
from tapeloom.sources import landing, schemas, tables

SF = "/root/testdata/sf0.001"


def test_a_stream_is_landed_by_all_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    table = spark.range(0, 90, 1, 3).withColumn("time", F.lit(0))
    assert "x3_incremental_rollup" in catalog.QUERIES
    stream = catalog_jobs._stream(lambda name: table, "fx_factored")
    query = stream.writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("landed").count() == 90
    assert len(spark.read.parquet(f"{tmp_path}/fx_factored").inputFiles()) == 3


def test_tasks_get_no_more_rows_from_a_larger_table(spark):
    for times in (1, 8):
        dealt = ranges.spread(spark.range(0, 4000 * times, 1, 2).withColumn("symbol", F.col("id") % 500), ["symbol"], rows=200)
        sizes = dealt.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert max(r["count"] for r in sizes) <= 200 * 5 and sum(r["count"] for r in sizes) == 4000 * times
    assert ranges.spread(spark.range(10), ["id"], rows=10).rdd.getNumPartitions() == spark.range(10).rdd.getNumPartitions()


@pytest.mark.parametrize("name", ["i_macd", "i_ema", "i_rsi", "g2_resample_multi", "g6_ratio_rollup_weekly", "v3_cross_section_pct", "p6_industry_valuation", "p7_industry_job"])
def test_keys_dealt_to_many_tasks_give_the_same_rows(spark, monkeypatch, name):
    monkeypatch.setattr(ranges.spread, "__defaults__", (300,))
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    assert differences(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF) == []


def test_cells_are_gathered_in_one_shuffle(spark):
    rows = [('{"a": {"close": {"1000": 1.5, "2000": 2.5}, "other": {"3000": 9.0}}}',), ('{"a": {"volume": {"1000": 7.0}, "close": {"1000": null}}}',)]
    out = schemas.flatten_nested(spark.createDataFrame(rows, "payload string"), "payload", zone="UTC")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    assert sorted((r.symbol, r.time.second, r.close, r.volume) for r in out.collect()) == [("a", 1, 1.5, 7.0), ("a", 2, 2.5, None), ("a", 3, None, None)]


def test_carries_are_folded_once_over(spark):
    rows = spark.range(0, 40_000).selectExpr("id % 2 AS symbol", "timestamp_seconds(id * 86400) AS time", "CAST(id % 7 AS DOUBLE) AS x")
    cut = affine_scan(rows, "x", 0.1, "y", rows=1)
    assert "aggregate(" not in cut._jdf.queryExecution().optimizedPlan().toString()
    both = cut.select("symbol", "time", "y").join(affine_scan(rows, "x", 0.1, "z").select("symbol", "time", "z"), ["symbol", "time"])
    assert both.count() == 40_000 and both.where("abs(y - z) > 1e-9 OR y IS NULL").count() == 0


def test_a_batch_is_read_once(spark, tmp_path, monkeypatch):
    folder, target, upsert = tmp_path / "in", f"{tmp_path}/daily", landing.write_upsert
    folder.mkdir()
    (folder / "a.json").write_text('{"ts_code": "1", "trade_date": "20240102", "close": "2.5"}\n{"ts_code": "1", "trade_date": "never"}\n')

    def gone(*args):
        (folder / "a.json").unlink()
        upsert(*args)

    monkeypatch.setattr(landing, "write_upsert", gone)
    assert landing.land_new(spark, str(folder), "daily", target) == 1
    assert [(r.n_records, r.n_rows, r.n_rejects) for r in landing.runs(spark, target).collect()] == [(2, 1, 1)]
    assert [r.close for r in tables.read(spark, target).collect()] == [2.5]

"""Versions that readers see whole, and streams over several batches, stops and restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeloom.sources import tables
from tapeloom.streaming import tape, ticks


def table(spark, rows):
    return spark.createDataFrame(rows, "symbol string, time timestamp, close double, year int")


def at(day, hour=0, minute=0, second=0):
    return dt.datetime(2024, 1, day, hour, minute, second)


ROWS = [("a", dt.datetime(y, m, 1), float(y + m), y) for y in (2021, 2022, 2023) for m in (1, 6)] + [("b", dt.datetime(2023, 3, 1), 1.0, 2023)]
WRITES = {
    "replace": lambda s, p: tables.replace_all(s, p, table(s, ROWS[:1]), ["year"]),
    "delete": lambda s, p: tables.delete_before(s, p, "2022-03-01"),
    "upsert": lambda s, p: tables.write_upsert(s, p, table(s, [("a", dt.datetime(2023, 1, 1), 9.0, 2023)]), ["symbol", "time"], ["year"]),
}
AFTER = {"replace": ROWS[:1], "delete": [r for r in ROWS if r[1] >= dt.datetime(2022, 3, 1)], "upsert": [("a", dt.datetime(2023, 1, 1), 9.0, 2023) if r[1] == dt.datetime(2023, 1, 1) else r for r in ROWS]}


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("kind", sorted(WRITES))
def test_readers_see_the_old_or_the_new_rows_at_every_step(spark, tmp_path, monkeypatch, kind):
    p = f"{tmp_path}/t"
    tables.replace_all(spark, p, table(spark, ROWS), ["year"])
    before = tables.read(spark, p)  # a reader that has listed its files
    seen = []
    steps = {name: getattr(tables, name) for name in ("_leaves", "_commit", "remove")}

    def stop_at(name):
        def step(*args):
            seen.append(rows_of(tables.read(spark, p)))
            raise KeyboardInterrupt(name)

        return step

    for name in ("_leaves", "_commit"):  # stops before the version counts
        with monkeypatch.context() as m:
            m.setattr(tables, name, stop_at(name))
            with pytest.raises(KeyboardInterrupt):
                WRITES[kind](spark, p)
        assert rows_of(tables.read(spark, p)) == sorted(ROWS)
    WRITES[kind](spark, p)
    assert rows_of(tables.read(spark, p)) == sorted(AFTER[kind])
    assert seen == [sorted(ROWS)] * 2
    assert rows_of(before) == sorted(ROWS)
    with monkeypatch.context() as m:  # stops after it counts, before old files go
        m.setattr(tables, "remove", stop_at("remove"))
        with pytest.raises(KeyboardInterrupt):
            tables.replace_all(spark, p, table(spark, ROWS[:2]), ["year"])
    assert seen[-1] == rows_of(tables.read(spark, p)) == sorted(ROWS[:2])
    assert steps["remove"] is tables.remove
    tables.vacuum(spark, p)
    assert rows_of(tables.read(spark, p)) == sorted(ROWS[:2])


def test_two_writers_do_not_lose_each_others_rows(spark, tmp_path, monkeypatch):
    p = f"{tmp_path}/t"
    tables.replace_all(spark, p, table(spark, ROWS[:1]))
    known = tables._versions(spark, p)
    with monkeypatch.context() as m:
        m.setattr(tables, "_versions", lambda *_: known)
        tables.replace_all(spark, p, table(spark, ROWS[:2]))
        with pytest.raises(RuntimeError):
            tables.replace_all(spark, p, table(spark, ROWS[:3]))
    assert rows_of(tables.read(spark, p)) == sorted(ROWS[:2])


def test_versions_of_empty_and_plain_tables(spark, tmp_path):
    p = f"{tmp_path}/t"
    tables.write_upsert(spark, p, table(spark, []), ["symbol", "time"], ["year"])
    assert tables.read(spark, p).columns == ["symbol", "time", "close", "year"] and tables.read(spark, p).count() == 0
    tables.write_upsert(spark, p, table(spark, [("a", at(1), 1.0, None)]), ["symbol", "time"], ["year"])
    tables.write_upsert(spark, p, table(spark, [("a", at(1), 2.0, None), ("b", at(1), 1.0, 2024)]), ["symbol", "time"], ["year"])
    assert rows_of(tables.read(spark, p)) == [("a", at(1), 2.0, None), ("b", at(1), 1.0, 2024)]
    q = f"{tmp_path}/plain"
    table(spark, ROWS[:2]).write.parquet(q)
    tables.write_upsert(spark, q, table(spark, [ROWS[6]]), ["symbol", "time"])
    assert rows_of(tables.read(spark, q)) == sorted([*ROWS[:2], ROWS[6]])
    with pytest.raises(ValueError):
        tables.write_upsert(spark, q, table(spark, ROWS), ["symbol", "time"], ["year"])


def test_many_touched_partitions_are_found_by_a_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "NAMED", 1)
    p = f"{tmp_path}/t"
    tables.replace_all(spark, p, table(spark, ROWS), ["year"])
    tables.write_upsert(spark, p, table(spark, [("a", dt.datetime(2023, 1, 1), 9.0, 2023), ("z", dt.datetime(2021, 1, 1), 9.0, 2021)]), ["symbol", "time"], ["year"])
    assert rows_of(tables.read(spark, p)) == sorted([*AFTER["upsert"], ("z", dt.datetime(2021, 1, 1), 9.0, 2021)])


TICKS = "symbol string, time timestamp, price double"


def landed(spark, folder, *files):
    for rows in files:
        spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(folder)


def test_tape_goes_on_after_a_stop_in_a_batch(spark, tmp_path, monkeypatch):
    folder, root, cp = (f"{tmp_path}/{x}" for x in ("in", "tape", "cp"))
    first = [("a", at(1, 9, 0, k), float(k)) for k in range(3)] + [("a", at(1, 9, 20), 5.0), (None, at(1, 9), 1.0), ("a", None, 1.0)]
    tape.run_tape(landed(spark, folder, first), root, cp).awaitTermination()
    assert [(r.open, r.close, r.ticks) for r in tape.read(spark, root, "bars").collect()] == [(0.0, 2.0, 3)]
    assert [(r.open, r.close) for r in tape.open_bars(spark, root).collect()] == [(5.0, 5.0)]
    # late by the first file's watermark of 9:10; a repeat of an open tick; a tick that closes its window
    second = [("a", at(1, 9, 9, 59), 7.0), ("a", at(1, 9, 20), 6.0), ("a", at(1, 9, 12), 8.0), ("b", at(1, 9, 40), 1.0)]
    real = tape.ticks_to_bars

    def broken(*_):
        raise RuntimeError("stopped between the archive and the bars")

    monkeypatch.setattr(tape, "ticks_to_bars", broken)
    with pytest.raises(Exception, match="stopped between"):
        tape.run_tape(landed(spark, folder, second), root, cp).awaitTermination()
    assert tape.last_batch(spark, root) == 0 and tape.read(spark, root, "archive").count() == 4  # the broken batch isn't seen
    monkeypatch.setattr(tape, "ticks_to_bars", real)
    tape.run_tape(landed(spark, folder), root, cp).awaitTermination()
    assert sorted((r.symbol, r.time, r.price) for r in tape.read(spark, root, "archive").collect()) == sorted([*first[:4], second[2], second[3]])
    assert sorted((r.price, r.reason) for r in tape.read(spark, root, "late").collect()) == [(1.0, "no symbol or time"), (1.0, "no symbol or time"), (7.0, "late")]
    assert sorted((r.symbol, r.time.minute, r.ticks) for r in tape.read(spark, root, "bars").collect()) == [("a", 0, 3), ("a", 10, 1), ("a", 20, 1)]
    p = {r.batch: (r.n_admitted, r.n_repeated, r.n_late, r.n_bars) for r in tape.read(spark, root, "progress").collect()}
    assert p == {0: (4, 0, 2, 1), 1: (3, 1, 1, 2)}
    tape.run_tape(landed(spark, folder, [("b", at(2), 1.0)]), root, cp).awaitTermination()
    assert tables.folders(spark, f"{root}/open") == ["batch=1", "batch=2"] and tape.read(spark, root, "open").count() <= 2  # what is held doesn't grow with the archive
    with pytest.raises(ValueError):
        tape.run_tape(landed(spark, folder), root, f"{tmp_path}/other")


def test_a_batch_of_one_symbol_touches_one_partition(spark, tmp_path):
    path, folder, cp = (f"{tmp_path}/{x}" for x in ("target", "factors", "cp"))
    schema = "symbol string, time timestamp, adj_factor double"
    rows = spark.createDataFrame([(f"s{k}", at(d), 1.0) for k in range(40) for d in (1, 2)], schema)
    tables.replace_all(spark, path, ticks.dealt(rows.withColumn("n", F.lit(0)), 8), ["part"])
    asked = []

    def job(s, symbols):
        asked.append({r.symbol for r in symbols.collect()})
        return tables.read(s, path).join(symbols, "symbol", "left_semi").withColumn("n", F.col("n") + 1).drop("part")

    def run(*batch):
        spark.createDataFrame(list(batch), schema).coalesce(1).write.mode("append").parquet(folder)
        ticks.recompute_on_factor_change(spark.readStream.schema(schema).parquet(folder), path, cp, job, parts=8).awaitTermination()

    current = lambda p: set(tables._manifest(spark, p, tables._versions(spark, p)[-1])["folders"])
    run(("s1", at(3), 1.0))  # unmoved: the state comes from the target
    assert asked == [set()]
    before = {p: current(p) for p in (path, f"{path}-state")}
    run(("s3", at(3), 2.0))
    assert asked[-1] == {"s3"}
    for p, old in before.items():
        gone, new = old - current(p), current(p) - old
        assert len(gone) == len(new) == 1 and {f.split("part=")[1] for f in gone} == {f.split("part=")[1] for f in new}
    assert {r.symbol for r in tables.read(spark, path).where("n = 1").collect()} == {"s3"}
    run(("s3", at(2), 7.0), ("s3", at(4), 2.0), ("new", at(4), 1.0))  # an older factor, the same one, a symbol without rows
    assert asked[-1] == {"new"}
    scan = tables.read(spark, f"{path}-state").where(F.col("part").isin(3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in scan and "part#" in scan

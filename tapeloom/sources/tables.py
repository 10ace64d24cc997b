"""Keyed tables on Parquet: upsert, replacement, retention, export, run log."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.calendar import stamp_close
from ..operators.checks import quality_checks


def upsert(base: DataFrame, new: DataFrame, keys: Sequence[str], keep: str = "last", updated_at: bool = False) -> DataFrame:
    """``base`` with the rows of ``new`` by key: ``keep="last"`` takes the columns that ``new`` has on conflict and leaves the others as stored, ``"first"`` leaves all.

    One aggregation by key decides, combined before its shuffle.  Of equal keys in ``new`` the greatest row counts.  With ``updated_at`` a
    conflicting or new row is stamped with the time of the job either way.
    """
    stamp = F.current_timestamp()
    if updated_at:
        new = new.withColumn("updated_at", stamp)
    rows = base.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in rows.columns if c != "__new"]
    rest = [c for c in columns if c not in keys]
    order = F.struct(F.col("__new") if keep == "last" else -F.col("__new"), *rest)
    only_stored = [c for c in rest if c not in new.columns]
    found = [F.max_by(F.struct(*rest), order).alias("__r"), F.max("__new").alias("__touched")]
    if only_stored:
        found.append(F.max_by(F.struct(*only_stored), F.when(F.col("__new") == 0, 1)).alias("__stored"))
    picked = {c: F.col(c) for c in keys} | {c: F.col("__r")[c] for c in rest} | {c: F.col("__stored")[c] for c in only_stored}
    if updated_at:
        picked["updated_at"] = F.when(F.col("__touched") == 1, stamp).otherwise(picked["updated_at"])
    return rows.groupBy(*keys).agg(*found).select(*[picked[c].alias(c) for c in columns])


def processed_rows(bars: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What is stored of processed bars: known columns, complete prices, closing stamp, time of processing."""
    kept = bars.select(*[c for c in columns if c in bars.columns]).na.drop(subset=[c for c in ("open", "high", "low", "close") if c in bars.columns])
    return kept.withColumn("time", stamp_close(F.col("time").cast("timestamp"))).withColumn("processed_at", F.current_timestamp())


def storable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns only, arrays of text as JSON."""
    kinds = dict(df.dtypes)
    return df.select(*[F.to_json(c).alias(c) if kinds[c].startswith("array") else F.col(c) for c in columns if c in df.columns])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, none if it isn't there."""
    fs, at = _fs(spark, path)
    return sorted(e.getPath().getName() for e in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


# --- tables that readers see whole: every write adds a version, and a version is a small file that lists the folders it consists of ---

#: Versions that stay readable, the newest among them: a reader that has begun goes on with the files it has listed.
KEPT = 2
#: Touched partitions that are named in a filter; more are found by a join.
NAMED = 1000


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in folders(spark, f"{path}/_versions") if name.isdigit())


def _manifest(spark: SparkSession, path: str, version: int) -> dict:
    fs, at = _fs(spark, f"{path}/_versions/{version:012d}")
    stream = fs.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _leaves(spark: SparkSession, path: str, below: str, depth: int) -> list[str]:
    if not depth:
        return [below]
    return [leaf for name in folders(spark, f"{path}/{below}") if "=" in name for leaf in _leaves(spark, path, f"{below}/{name}", depth - 1)]


def _commit(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    """Make a version the current one: its list is written aside and renamed, which either happens or doesn't."""
    fs, aside = _fs(spark, f"{path}/_versions/.{uuid.uuid4().hex}")
    _, at = _fs(spark, f"{path}/_versions/{version:012d}")
    out = fs.create(aside, False)
    out.write(json.dumps(manifest).encode())
    out.close()
    if fs.exists(at) or not fs.rename(aside, at):
        fs.delete(aside, False)
        raise RuntimeError(f"{path} was written by another job meanwhile")


def _write(spark: SparkSession, path: str, df: DataFrame, partition_by: Sequence[str], replaces: Callable[[str], bool]) -> None:
    """Add a version: the folders of the current one that ``replaces`` doesn't name (by partition, "" without partitions), and those of ``df``."""
    known = _versions(spark, path)
    version = known[-1] + 1 if known else 1
    before = _manifest(spark, path, known[-1]) if known else {"folders": [], "partition_by": list(partition_by)}
    if before["partition_by"] != list(partition_by):
        raise ValueError(f"{path} is partitioned by {before['partition_by']}")
    own = f"__version={version}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{own}")
    written = _leaves(spark, path, own, len(partition_by))
    anew = {f.partition("/")[2] for f in written}
    stay = [f for f in before["folders"] if not (replaces(f.partition("/")[2]) or f.partition("/")[2] in anew)]
    _commit(spark, path, version, {"schema": df.schema.json(), "partition_by": list(partition_by), "folders": stay + written})
    for old in known[: max(0, len(known) + 1 - KEPT)]:
        later = {f for v in _versions(spark, path)[-KEPT:] for f in _manifest(spark, path, v)["folders"]}
        for folder in _manifest(spark, path, old)["folders"]:
            if folder not in later:
                remove(spark, f"{path}/{folder}")
        remove(spark, f"{path}/_versions/{old:012d}")


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current rows of a table, or those of one of the last ``KEPT`` versions.  Whatever a write does meanwhile, the rows are those of one whole version."""
    known = _versions(spark, path)
    if not known:
        return spark.read.parquet(path)  # a plain folder
    manifest = _manifest(spark, path, known[-1] if version is None else version)
    schema = StructType.fromJson(json.loads(manifest["schema"]))
    if not manifest["folders"]:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in manifest["folders"]])
    return rows.select(*schema.names)


def vacuum(spark: SparkSession, path: str) -> None:
    """Remove folders that no readable version has, as of jobs that stopped before their end.  Not while another job writes."""
    used = {f.split("/")[0] for v in _versions(spark, path) for f in _manifest(spark, path, v)["folders"]}
    for name in folders(spark, path):
        if name.startswith("__version=") and name not in used:
            remove(spark, f"{path}/{name}")


def write_upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = (), keep: str = "last", updated_at: bool = False) -> None:
    """Upsert into a table as its next version; with ``updated_at`` new and conflicting rows are stamped.

    With ``partition_by`` (columns that a key determines) only partitions that ``new`` touches are read and rewritten; the others' files stay where they are.
    """
    if not _versions(spark, path):
        base = read(spark, path) if exists(spark, path) else new.limit(0)  # a plain folder becomes the first version's base
        if updated_at and "updated_at" not in base.columns:
            base = base.withColumn("updated_at", F.lit(None).cast("timestamp"))
        _write(spark, path, upsert(base, new, keys, keep, updated_at), partition_by, lambda _: False)
        return
    base = read(spark, path)
    if updated_at and "updated_at" not in base.columns:
        base = base.withColumn("updated_at", F.lit(None).cast("timestamp"))
    if partition_by:
        touched = new.select(*partition_by).distinct()
        some = touched.limit(NAMED + 1).collect()
        if not some:
            return
        if len(some) <= NAMED:  # literals prune the folders that are read
            one = lambda r: reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in partition_by])
            base = base.where(reduce(or_, map(one, some)))
        else:
            named = touched.toDF(*[f"__{c}" for c in partition_by])
            base = base.join(named, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in partition_by]), "left_semi")
    _write(spark, path, upsert(base, new, keys, keep, updated_at), partition_by, lambda part: not partition_by)


def replace_all(spark: SparkSession, path: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
    """The whole table anew.  Readers see the old rows up to the moment that they see the new ones."""
    _write(spark, path, df, partition_by, lambda _: True)


def retain(df: DataFrame, since, time: str = "time") -> DataFrame:
    """Rows at or after a date; on a table partitioned by time the rest isn't read."""
    return df.where(F.col(time) >= F.lit(since).cast("timestamp"))


def delete_before(spark: SparkSession, path: str, since, time: str = "time", by: str = "year") -> None:
    """Delete a table's rows before a date, as its next version.  The table is partitioned by the year of ``time``: earlier years leave the list, and only the date's own year is rewritten."""
    day = str(since)
    year = int(day[:4])
    kept = retain(read(spark, path).where(F.col(by) == year), day, time)
    in_year = lambda part: int(part.split("=")[1]) if part.split("=")[1].lstrip("-").isdigit() else year + 1  # noqa: E731  rows without a year stay
    _write(spark, path, kept, [by], lambda part: in_year(part) <= year)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (spark.checkpoint.dir), removed at the session's end; without that setting in a temporary folder, in local mode only."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir")
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    path = f"{where}/{name}-{uuid.uuid4().hex}"
    fs, at = _fs(spark, path)
    fs.deleteOnExit(at)
    return path


def truncate(spark: SparkSession, path: str) -> None:
    table = read(spark, path)
    replace_all(spark, path, table.limit(0))


def export(df: DataFrame, path: str, start=None, end=None, symbols: Sequence[str] | None = None, by: str = "date", codec: str = "zstd") -> None:
    """Bars of a range and some symbols as Parquet partitioned by year and month, or by symbol; runs again overwrite the partitions they have rows for."""
    out = df
    if symbols is not None:
        out = out.where(F.col("symbol").isin(list(symbols)))
    if start is not None:
        out = out.where(F.col("time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        out = out.where(F.col("time") < F.date_add(F.lit(end).cast("date"), 1))
    parts = ["year", "month"] if by == "date" else ["symbol"]
    if by == "date":
        out = out.withColumn("year", F.year("time")).withColumn("month", F.month("time"))
    order = [c for c in ("symbol", "time") if c in out.columns and c not in parts]
    out.repartition(*parts).sortWithinPartitions(*parts, *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy(*parts).parquet(path)


def export_report(spark: SparkSession, path: str, expected_rows: int | None = None) -> DataFrame:
    """(rule, violations, passed) of an exported table as it is stored: rows, unknown keys, prices not above 0, volume below 0, times that don't rise in stored order."""
    return quality_checks(stored(spark, path), expected_rows=expected_rows)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A table's rows with the place they are stored at: ``__file`` and ``__position``, the row's number in it."""
    return read(spark, path).select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__position"))


def export_summary(spark: SparkSession, path: str, key: str = "symbol", time: str = "time") -> DataFrame:
    """Of each symbol of an exported table: rows, range covered, days with rows, and files it is spread over; one aggregate, combined before its shuffle."""
    rows = stored(spark, path)
    return rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.countDistinct(F.to_date(time)).alias("n_days"), F.countDistinct("__file").alias("n_files"))


def log_run(spark: SparkSession, path: str, job: str, status: str, rows: int, parameters: str = "{}") -> None:
    """Append one row for a job's run."""
    spark.range(1).select(F.lit(job).alias("job"), F.lit(status).alias("status"), F.lit(rows).cast("long").alias("n_rows"), F.lit(parameters).alias("parameters"), F.current_timestamp().alias("finished_at")).write.mode("append").parquet(path)

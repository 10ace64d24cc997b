"""Landing run by run: each run reads the files that have come since the last one, and every record becomes a row or a reject."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import DATASETS, coerced, conform, dedupe_on_key, rename_columns
from .tables import exists, folders, write_upsert


def land_new(spark: SparkSession, folder: str, name: str, target: str, fmt: str = "json", columns: str | None = None, **options: str) -> int:
    """Land the files of ``folder`` that no run has landed yet as dataset ``name`` into table ``target``; returns the number of batches that have been landed in all.

    Which files have been read is known from the checkpoint beside the table, so a run lists the folder but opens new files only, and one
    that stops goes on where it was.  JSON comes a record a line, CSV with the given ``columns`` (their names in order) and a header line.  A record that can't be parsed, or
    whose key can't, goes to ``{target}-rejects`` as it was read, with its file and the reason.  The others are upserted by the dataset's key, the last by
    all columns of a run's equal keys counting.  ``{target}-runs`` has a row a batch: files, records, rows, rejects, and rows that repeat a key of the batch.
    Rejects and runs are written under the batch's number and written over if it is done again, so records count once.
    A batch's records are read and parsed once and held on the executors' disks until all four have been written.
    """
    dataset = DATASETS[name]
    vendor = {b: a for a, b in dataset.rename.items()}
    texts = list(dict.fromkeys([*[vendor.get(c, c) for c, _ in dataset.fields], *[c for c, _ in dataset.fields]]))
    if fmt == "json":
        lines = spark.readStream.options(**options).text(folder)
        parsed = F.from_json("value", ", ".join(f"`{c}` string" for c in [*texts, "__bad"]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad", "primitivesAsString": "true"})
        raw = lines.select(F.col("value").alias("__record"), F.col("_metadata.file_path").alias("__file"), parsed.alias("__p")).select("__record", "__file", "__p.*")
        raw = raw.where(F.trim("__record") != "")
    elif fmt == "csv" and columns:
        names = [c.strip() for c in columns.split(",")]
        schema = ", ".join(f"`{c}` string" for c in [*names, "__bad"])
        reader = spark.readStream.schema(schema).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="__bad", **options)
        raw = reader.csv(folder).select("*", F.col("_metadata.file_path").alias("__file"))
        raw = raw.withColumn("__record", F.coalesce("__bad", F.to_csv(F.struct(*names))))
    else:
        raise ValueError("land_new reads json, and csv with its columns")

    def batch(new: DataFrame, n: int) -> None:
        spark = new.sparkSession
        own = [c for c in new.columns if not c.startswith("__")]
        blank = rename_columns(new.select(*own), {a: b for a, b in dataset.rename.items() if b not in own}).columns
        rows = new.toDF(*[dict(zip(own, blank)).get(c, c) for c in new.columns])
        for a, b in dataset.rename.items():  # a record may have either name
            if a in rows.columns and b in rows.columns:
                rows = rows.withColumn(b, F.coalesce(b, a)).drop(a)
        kinds = dict(dataset.fields)
        reason = F.when(F.col("__bad").isNotNull(), F.lit("can't be parsed"))
        for c in dataset.required:
            reason = reason.when(coerced(F.col(c), kinds[c]).isNull() if c in rows.columns else F.lit(True), F.lit(f"no {c}"))
        judged = rows.withColumn("__reason", reason).persist(StorageLevel.DISK_ONLY)
        put = lambda df, part: df.write.mode("overwrite").parquet(f"{target}-{part}/batch={n}")
        put(judged.where("__reason IS NOT NULL").select(F.col("__file").alias("file"), F.col("__record").alias("record"), F.col("__reason").alias("reason")), "rejects")
        good = conform(judged.where("__reason IS NULL"), dataset)[0]
        one = dedupe_on_key(good, dataset.key)
        write_upsert(spark, target, one, dataset.key)
        counted = judged.agg(F.countDistinct("__file").alias("n_files"), F.count("*").alias("n_records"), F.count(F.when(F.col("__reason").isNull(), 1)).alias("n_rows"), F.count("__reason").alias("n_rejects"))
        keys = F.struct(*[coerced(F.col(c), kinds[c]) for c in dataset.key])
        distinct = judged.where("__reason IS NULL").agg(F.countDistinct(keys).alias("__keys"))
        put(counted.join(F.broadcast(distinct), F.lit(True)).withColumn("n_repeated", F.col("n_rows") - F.col("__keys")).drop("__keys"), "runs")  # one row each
        judged.unpersist()

    raw.writeStream.foreachBatch(batch).option("checkpointLocation", f"{target}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return len(folders(spark, f"{target}-runs"))


def rejects(spark: SparkSession, target: str) -> DataFrame:
    """(file, record, reason, batch) of all runs."""
    return spark.read.parquet(f"{target}-rejects")


def runs(spark: SparkSession, target: str) -> DataFrame:
    """(batch, n_files, n_records, n_rows, n_rejects, n_repeated), one row a batch."""
    return spark.read.parquet(f"{target}-runs") if exists(spark, f"{target}-runs") else spark.createDataFrame([], "n_files long, n_records long, n_rows long, n_rejects long, n_repeated long, batch int")

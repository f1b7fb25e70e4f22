"""Structured Streaming: run logs, windowed counts and a keep-last table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.timeseries import keep_last


def file_stream(spark: SparkSession, path: str, schema, kind: str = "parquet", files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(path)


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling counts; a row later than the watermark is dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, size), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], buckets: int = 16) -> StreamingQuery:
    """Keeps the newest row of each key below ``path``.

    The table is dealt into ``buckets`` folders by a hash of the key; choose as
    many as keep a folder at a task's size. A batch rewrites only the folders its
    keys are in, each as a version that bears the batch's number, so a repeated
    batch replaces its own. Versions before the last two of a folder are deleted:
    the last is read, the one before it is what a repeated batch starts from.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        before = current(spark, path, number)
        rows = fresh if before is None else fresh.unionByName(before.join(fresh.select("_bucket").distinct(), "_bucket", "left_semi"))
        keep_last(rows, keys, order).withColumn("_version", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_version", "_bucket").parquet(path)
        compact(spark, path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The versions of each bucket, ascending, from the folders' names alone."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[int, list[int]] = {}
    for folder in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "_version=*/_bucket=*")) or []:
        place = folder.getPath()
        found.setdefault(int(place.getName().partition("=")[2]), []).append(int(place.getParent().getName().partition("=")[2]))
    return {bucket: sorted(v) for bucket, v in found.items()}


def compact(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes all but the last ``keep`` versions of each bucket."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for bucket, numbers in versions(spark, path).items():
        for v in numbers[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/_version={v}/_bucket={bucket}"), True)


def current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """Each bucket's rows in its newest version (older than ``before``): only those
    folders are read."""
    newest = {b: [v for v in numbers if before is None or v < before] for b, numbers in versions(spark, path).items()}
    folders = [f"{path}/_version={v[-1]}/_bucket={b}" for b, v in sorted(newest.items()) if v]
    return spark.read.option("basePath", path).parquet(*folders).drop("_version") if folders else None


def upsert_windows(counts: DataFrame, path: str, keys: list[str]) -> StreamingQuery:
    """Writes the windows that each batch changed as a version below ``path``: the
    result never passes through the driver."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_version", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_version").parquet(f"{path}/rows")

    return counts.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()


def newest_windows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Each window as the last batch that changed it left it."""
    return keep_last(spark.read.parquet(f"{path}/rows"), keys, ["_version"]).drop("_version")

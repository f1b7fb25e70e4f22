"""Writers: CSV, JSON, Parquet run files, partitioned masters and reports."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ship_package

RENAMES = 32  # at a time
MOUNTED = ("file",)  # stores that tasks and the driver write as files


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_run(df: DataFrame, path: str) -> None:
    """One run's rows as a zstd Parquet file beside the earlier runs'."""
    df.coalesce(1).write.mode("append").option("compression", "zstd").parquet(path)


def write_report(summary: DataFrame, path: str) -> None:
    """Rows as JSON documents."""
    summary.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def write_master(df: DataFrame, path: str, by=("Year", "WeekNumber")) -> None:
    """Replaces the periods that the rows hold and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def report_prefix(weeks: list[int], year: int | None) -> str:
    if not weeks or year is None:
        return "comparison"
    low, high = min(weeks), max(weeks)
    return f"OEW{low:02d}-{year}" if low == high else f"OEW{low:02d}-{high:02d}-{year}"


def write_reports(frames: dict[str, DataFrame], folder: str, prefix: str) -> list[str]:
    """A folder of CSV files per frame that has rows; returns what was written."""
    out = []
    for name, df in frames.items():
        if not df.isEmpty():
            write_csv(df, f"{folder}/{prefix}_{name}")
            out.append(name)
    return out


def write_named(df: DataFrame, folder: str, name: str = "name", force: bool = False) -> int:
    """A CSV file ``<folder>/<value>.csv`` for each value of the column ``name``;
    returns how many were written.

    Files that are there are left alone unless ``force`` is set, so a run that was
    cut short is finished by another. Files are written in a folder that readers
    pass over and then renamed: none is ever seen in part. Rows without a name are
    left out.
    """
    columns, options = [c for c in df.columns if c != name], {"emptyValue": ""}
    header = df.sparkSession.range(1).select(F.to_csv(F.struct(*[F.lit(c).alias(f"_{k}") for k, c in enumerate(columns)]), options)).first()[0]
    rows = df.withColumn("_group", F.col(name).cast("string")).select("_group", *columns)
    return _published(rows, F.to_csv(F.struct(*columns), options), header, lambda w, to: w.options(header=True, **options).csv(to), folder, ".csv", force)


def write_texts(df: DataFrame, folder: str, suffix: str, name: str = "name", text: str = "text", force: bool = False) -> int:
    """A text file ``<folder>/<value><suffix>`` for each value of the column
    ``name``, its texts as lines; else like ``write_named``."""
    rows = df.select(F.col(name).cast("string").alias("_group"), F.coalesce(text, F.lit("")).alias("value"))
    return _published(rows, F.col("value"), None, lambda w, to: w.text(to), folder, suffix, force)


def _published(rows: DataFrame, line: Column, header: str | None, save, folder: str, suffix: str, force: bool) -> int:
    """Rows (_group, fields) as a file a group: each row's ``line``, below a header
    if there is one, as ``save`` writes them with a writer.

    Rows are dealt over as many tasks as the session shuffles to, also where a few
    bytes make many files. In a folder that is mounted everywhere (file:), tasks
    write the files and the driver moves them; in other stores Spark's writer makes
    a folder a group, and the driver renames the files in them.
    """
    spark = rows.sparkSession
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join(parts))
    root = folder.rstrip("/")
    fs = path(root).getFileSystem(hadoop)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = lambda df: df.filter("_group IS NOT NULL").repartition(tasks, "_group")
    staging = f"_staging_{uuid.uuid4().hex}"
    uri = fs.makeQualified(path(root)).toUri()
    try:
        if uri.getScheme() in MOUNTED:
            return _moved(dealt(rows.select("_group", line.alias("value"))), uri.getPath(), staging, suffix, header, force)
        return _renamed(rows, dealt, save, root, staging, suffix, force, fs, path)
    finally:
        fs.delete(path(root, staging), True)


def _moved(lines: DataFrame, root: str, staging: str, suffix: str, header: str | None, force: bool) -> int:
    ship_package(lines.sparkSession)
    ready, part = os.path.join(root, staging, "ready"), os.path.join(root, staging, "part")
    for made in (ready, part):
        os.makedirs(made)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now, out = os.path.join(part, uuid.uuid4().hex), None, None

        def close() -> None:
            if out is not None:
                out.close()
                os.replace(own, os.path.join(ready, file_name(now, suffix)))

        for batch in batches:
            groups, values = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(1).to_pylist()
            cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)] if len(groups) else []
            for a, b in zip(cuts, cuts[1:]):
                if groups[a] != now:
                    close()
                    now, out = groups[a], None
                    if force or not os.path.exists(os.path.join(root, file_name(now, suffix))):
                        out = open(own, "w", encoding="utf-8", newline="")  # noqa: SIM115
                        if header is not None:
                            out.write(header + "\n")
                if out is not None:
                    out.write("\n".join(values[a:b]) + "\n")
        close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([], pa.int64())})

    lines.sortWithinPartitions("_group").mapInArrow(write, "n long").count()
    done = 0
    with os.scandir(ready) as files:
        for file in files:
            target = os.path.join(root, file.name)
            if not force and os.path.exists(target):
                continue
            with contextlib.suppress(FileNotFoundError):
                os.remove(os.path.join(root, f".{file.name}.crc"))  # of a file that Hadoop wrote
            os.replace(file.path, target)
            done += 1
    return done


def file_name(group: str, suffix: str) -> str:
    return group.replace("/", "%2F") + suffix


def _renamed(rows: DataFrame, dealt, save, root: str, staging: str, suffix: str, force: bool, fs, path) -> int:
    """Tasks publish their files in the staging folder themselves, and the driver
    renames many at a time."""
    if not force and fs.exists(path(root)):
        there = rows.sparkSession.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(root).select(F.element_at(F.split("path", "/"), -1).alias("_file"))
        own = F.concat(F.replace("_group", F.lit("/"), F.lit("%2F")), F.lit(suffix))
        rows = rows.join(there.distinct(), own == F.col("_file"), "left_anti")
    save(dealt(rows).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("_group"), f"{root}/{staging}")

    def publish(group) -> int:
        if not group.isDirectory():
            return 0
        value = unquote(group.getPath().getName().removeprefix("_group="))
        (part,) = [f.getPath() for f in fs.listStatus(group.getPath()) if f.getPath().getName().startswith("part-")]
        target = path(root, file_name(value, suffix))
        if force:
            fs.delete(target, False)
        fs.rename(part, target)
        return 1

    with ThreadPoolExecutor(RENAMES) as pool:
        return sum(pool.map(publish, fs.listStatus(path(root, staging))))


def migrate_table(df: DataFrame, path: str, timestamp: str = "timestamp") -> None:
    """A log table into Parquet, its text timestamps as timestamps."""
    if timestamp in df.columns and df.schema[timestamp].dataType.simpleString() == "string":
        df = df.withColumn(timestamp, F.col(timestamp).try_cast("timestamp"))
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_corrected(df: DataFrame, corrections: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").json(f"{folder}/records_json")
    write_csv(df, f"{folder}/records_csv")
    write_report(corrections, f"{folder}/corrections")


def write_export(records: DataFrame, metadata: DataFrame, folder: str, by) -> None:
    """Records as JSON lines in a folder per bulletin, and a document of metadata
    per bulletin beside them."""
    records.write.mode("overwrite").partitionBy(*by).json(f"{folder}/records")
    write_report(metadata, f"{folder}/metadata")

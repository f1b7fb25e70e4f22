"""What the operators share: staging in the cluster's shared folder, and names."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver see: spark.checkpoint.dir.

    Where the session has none, a temporary one is set if master and executors
    are one process (a local test); on a cluster that would be a folder of each
    machine's own, so it is an error there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        found = context.getCheckpointDir() if hasattr(context, "getCheckpointDir") else None
        if not found:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            found = "file://" + tempfile.mkdtemp(prefix="tessera-")
            context.setCheckpointDir(found)
    return found if "://" in found or not found.startswith("/") else f"file://{found}"


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


_open = threading.local()


@contextmanager
def scratch(spark: SparkSession):
    """Deletes on leaving what was staged inside, but for what is to be kept."""
    stack = _open.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            delete(spark, path)


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Cuts the lineage with a Parquet table in the shared folder.

    A lost executor then costs a reread, not a recomputation, and rows numbered
    by partition keep their numbers. ``keep``: a lazily read result needs it
    beyond the innermost ``scratch``.
    """
    spark = df.sparkSession
    path, stack = staging_path(spark, name), _open.__dict__.get("stack", [])
    owners = stack[:-1] if keep else stack
    if owners:
        owners[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that later steps no longer read."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            delete(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of steps that are written.

    It does so when the driver's garbage is collected, else they stay on disk.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Returns freed memory to the machine: idle Python workers live on, and what
    the allocator keeps for them is the next task's."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def light(work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]):
    """``work`` for mapInPandas that leaves no memory behind in its worker."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def by_runs(key: str, work: Callable[[pd.DataFrame], pd.DataFrame], rows: int = 30_000, weigh: str | None = None, most: int = 32 << 20):
    """Applies ``work`` to whole runs of ``key``, a chunk of runs at a time: of
    about ``rows`` rows, or ``most`` bytes in the column ``weigh``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, size = [], 0, 0
        for pdf in batches:
            if not len(pdf):
                continue
            held.append(pdf)
            n += len(pdf)
            size += int(pdf[weigh].str.len().sum()) if weigh else 0
            if n >= rows or size >= most:
                pdf = pd.concat(held, ignore_index=True)
                whole = int((pdf[key].to_numpy() != pdf[key].iloc[-1]).sum())
                if whole:
                    yield work(pdf.iloc[:whole].reset_index(drop=True))
                rest = pdf.iloc[whole:]
                held, n, size = [rest], len(rest), int(rest[weigh].str.len().sum()) if weigh else 0
        if n:
            yield work(pd.concat(held, ignore_index=True))

    return light(run)


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Arrow batches bounded by bytes, so that long texts fit and short rows come
    many at a time; a smaller setting is kept."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    text = spark.conf.get(key, "64m").lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    now = int(text.rstrip("kmg") or 0) * unit
    if now <= 0 or now > size:
        spark.conf.set(key, str(size))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_of_id(name: str = "doc_id"):
    """CRC-32 of the id as text; a null id is an empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def fresh(df: DataFrame | StructType, name: str) -> str:
    """A column name that ``df`` does not have, whatever its letters' case."""
    taken = {c.lower() for c in (df.names if isinstance(df, StructType) else df.columns)}
    while name.lower() in taken:
        name += "_"
    return name

"""Session construction and access to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster use the submitted one."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessera")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once an application.

    They unpickle functions by module name, and an executor has no checkout.
    """
    import os
    import tempfile
    import zipfile

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(), "tessera.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("tessera", os.path.relpath(path, root)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)

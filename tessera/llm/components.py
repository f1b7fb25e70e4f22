"""Connected components of an edge table, by alternating stars.

Each round points a node's larger neighbours at its least one, then its lesser
ones; edge counts never grow, labels meet in few rounds, and nothing but a
count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); root is the least node."""
    e = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    before, least = _mark(e), F.min("v").over(Window.partitionBy("u"))
    while before[0]:
        both = e.union(e.select("v", "u")).withColumn("m", F.least(least, "u"))
        large = both.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        near = large.withColumn("m", least)
        e = staged(near.select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "edges")
        now = _mark(e)
        if now == before:
            break
        before = now
    return e.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("root")).distinct()

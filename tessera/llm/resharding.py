"""Minimum-cost-flow resharding.

``reshard`` lays out a table that has no shards yet. Every old shard is seen as a
fixed number of blocks (slices of its rows by a hash of the row's id and place),
so what the driver plans with has ``old * slices`` rows for any input. A minimum-cost flow from the old shards' sizes to the new
capacities says how many bytes each pair of shards exchanges; bytes that stay
cost nothing, so the fewest bytes move. Blocks are then chosen for each flow.
The old shards are those that the hash deals rows to; the rows are read once,
from the table, and written once, to the files of their new shard.

``rebalance`` changes the number of shards of a layout that is there: its blocks
are the files, the flow says which leave their shard, and only those are read
and written again. All others stay as they are, with their modification times.

Law ``bytes``: the new shards' sizes are near equal (a row's size is its UTF-8
bytes plus a fixed overhead). A null text has size ``overhead`` and is written
as null. Repeated rows, of one id or without one, are spread like others: a row's
place in its partition is part of the hash. ``docs`` must therefore be a table
that is read, or another frame whose partitions have the same rows in the same
order when a task is run again. A text of any length is one row, and a block. Extra columns are written along unchanged; where one is
called shard, the files are partitioned by ``shard_`` (``fresh``). An empty
table gives an empty layout.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera.llm.common import delete, fresh, staging_path

OVERHEAD = 16


@dataclass(frozen=True)
class Move:
    old: int
    piece: int
    new: int


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Ships every supply within the capacities at the least total cost.

    Successive shortest paths with potentials on the bipartite graph of shards;
    ``cost(i, j)`` is the cost of one byte from i to j and must not be negative.
    """
    m, n = len(supply), len(capacity)
    source, sink = m + n, m + n + 1
    to: list[int] = []
    room: list[int] = []
    price: list[float] = []
    out: list[list[int]] = [[] for _ in range(m + n + 2)]

    def edge(a: int, b: int, cap: int, c: float) -> None:
        for x, y, k, d in ((a, b, cap, c), (b, a, 0, -c)):
            out[x].append(len(to))
            to.append(y)
            room.append(k)
            price.append(d)

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(n):
            edge(i, m + j, s, cost(i, j))
    for j, c in enumerate(capacity):
        edge(m + j, sink, c, 0)
    potential = [0.0] * (m + n + 2)
    while True:
        best = [float("inf")] * (m + n + 2)
        via = [-1] * (m + n + 2)
        best[source] = 0
        queue = [(0.0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > best[a]:
                continue
            for e in out[a]:
                b = to[e]
                if room[e] > 0 and d + price[e] + potential[a] - potential[b] < best[b] - 1e-12:
                    best[b] = d + price[e] + potential[a] - potential[b]
                    via[b] = e
                    heapq.heappush(queue, (best[b], b))
        if best[sink] == float("inf"):
            break
        potential = [p + b if b < float("inf") else p for p, b in zip(potential, best)]
        push, a = 1 << 62, sink
        while a != source:
            push, a = min(push, room[via[a]]), to[via[a] ^ 1]
        a = sink
        while a != source:
            room[via[a]] -= push
            room[via[a] ^ 1] += push
            a = to[via[a] ^ 1]
    flow: dict[tuple[int, int], int] = {}
    for i in range(m):
        for e in out[i]:
            if to[e] != source and room[e ^ 1] > 0:
                flow[i, to[e] - m] = room[e ^ 1]
    return flow


def plan_moves(blocks: dict[tuple[int, int], int], old_shards: int, new_shards: int, cost=None) -> list[Move]:
    """Blocks to move: {(old shard, piece): bytes} into near equal new shards.

    A flow of f bytes takes the largest blocks that still fit into it; what no
    block fits is a rounding error of less than one block a flow, which the
    last pass evens out between the shards with the most and the least.
    """
    cost = cost or (lambda i, j: 0 if i == j else 1)
    sizes = [0] * old_shards
    held: dict[int, list[tuple[int, int]]] = {i: [] for i in range(old_shards)}
    for (i, piece), size in sorted(blocks.items()):
        sizes[i] += size
        held[i].append((size, piece))
    total = sum(sizes)
    capacity = [total * (j + 1) // new_shards - total * j // new_shards for j in range(new_shards)]
    flow = min_cost_flow(sizes, capacity, cost)
    where: dict[tuple[int, int], int] = {}
    load = [0] * new_shards
    for i in range(old_shards):
        rest = sorted(held[i], reverse=True)
        for j, need in sorted(((j, f) for (a, j), f in flow.items() if a == i and j != i), key=lambda x: -x[1]):
            kept = []
            for size, piece in rest:
                if size <= need:
                    need -= size
                    where[i, piece] = j
                    load[j] += size
                else:
                    kept.append((size, piece))
            rest = kept
        for size, piece in rest:
            home = i if i < new_shards else min(range(new_shards), key=lambda j: load[j] - capacity[j])
            where[i, piece] = home
            load[home] += size
    by_shard: dict[int, list[tuple[int, tuple[int, int]]]] = {j: [] for j in range(new_shards)}
    for key, j in where.items():
        by_shard[j].append((blocks[key], key))
    for _ in range(20 * new_shards):
        high = max(range(new_shards), key=load.__getitem__)
        low = min(range(new_shards), key=load.__getitem__)
        gap = load[high] - load[low]
        fits = [x for x in by_shard[high] if 0 < x[0] < gap]
        if not fits:
            break
        best = min(fits, key=lambda x: (abs(2 * x[0] - gap), x[1]))
        by_shard[high].remove(best)
        by_shard[low].append(best)
        where[best[1]] = low
        load[high] -= best[0]
        load[low] += best[0]
    return [Move(i, piece, j) for (i, piece), j in sorted(where.items())]


def row_size(text_col: str = "text"):
    return F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + F.lit(OVERHEAD)


def mixed_row(id_col: str):
    """A hash of a row's id and place, so that equal rows are told apart."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.monotonically_increasing_id())


def old_place(mixed, old_shards: int, slices: int):
    """The shard a row is in before, and its block there."""
    return F.pmod(mixed, F.lit(old_shards)).cast("int"), F.pmod(F.shiftright(mixed, 20), F.lit(slices)).cast("int")


def reshard(
    docs: DataFrame, new_shards: int = 40, old_shards: int = 32, slices: int = 256, id_col: str = "doc_id", text_col: str = "text",
    rows_per_file: int = 200_000, task_bytes: int = 64 << 20,
) -> tuple[str, DataFrame]:
    """Plans the moves and writes the new shards' files below the shared folder.

    Returns the folder, partitioned by ``shard``, and where every block went as
    rows (old shard, block, new shard, bytes, moved). A shard is written by as
    many tasks as its planned bytes need at ``task_bytes`` each.
    """
    spark = docs.sparkSession
    name, task, mixed = fresh(docs, "shard"), fresh(docs, "_task"), fresh(docs, "_mixed")
    rows = docs.withColumn(mixed, mixed_row(id_col))
    shard, piece = old_place(F.col(mixed), old_shards, slices)
    found = rows.select(shard.alias("old"), piece.alias("piece"), row_size(text_col).alias("size")).groupBy("old", "piece").agg(F.sum("size").alias("size"))
    blocks = {(r["old"], r["piece"]): int(r["size"]) for r in found.collect()}  # old_shards * slices rows at most
    moves = plan_moves(blocks, old_shards, new_shards)
    goal, planned = [0] * (old_shards * slices), [0] * new_shards
    for m in moves:
        goal[m.old * slices + m.piece] = m.new
        planned[m.new] += blocks[m.old, m.piece]
    goals = F.from_json(F.lit(str(goal)), "array<int>")
    salts = max(1, -(-max(planned) // task_bytes))
    salt = F.pmod(F.shiftright(mixed, 40), F.lit(salts)).cast("int")
    placed = rows.withColumn(name, F.get(goals, shard * F.lit(slices) + piece))
    placed = placed.withColumn(task, F.col(name) * F.lit(salts) + salt)
    path = staging_path(spark, "shards")
    dealt = placed.repartitionById(new_shards * salts, task).drop(task, mixed)
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy(name).parquet(path)
    made = spark.createDataFrame([(m.old, m.piece, m.new, blocks[m.old, m.piece], m.old != m.new) for m in moves], "old int, piece int, new int, bytes long, moved boolean")
    return path, made


def read_shards(spark: SparkSession, path: str, columns: StructType) -> tuple[DataFrame, DataFrame]:
    """The rewritten rows with their shard, file and place, and each file's first slot.

    A slot is the row's place in its file after the rows of the shard's files
    before it: no sort, and no window over a shard's rows.
    """
    name = fresh(columns, "shard")
    schema = StructType([*columns.fields, StructField(name, IntegerType())])
    rows = spark.read.schema(schema).parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy(name, "_file").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(name).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return rows, bases


def rebalance(spark: SparkSession, path: str, columns: StructType, new_shards: int, text_col: str = "text") -> DataFrame:
    """Changes the number of shards of a layout that ``reshard`` wrote, in place.

    Files are the blocks: the driver holds a row a file. Files that leave their
    shard are written into the new one by one task each, then deleted; if that
    is cut short, rows are there twice, never lost, and the returned plan, of
    (file, bytes, old, new, moved), names the files to delete.
    """
    name = fresh(columns, "shard")
    schema = StructType([*columns.fields, StructField(name, IntegerType())])
    rows = spark.read.schema(schema).parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    found = rows.groupBy(name, "_file").agg(F.sum(row_size(text_col)).alias("size")).orderBy(name, "_file").collect()
    files = [(r[name], r["_file"], int(r["size"])) for r in found]
    old_shards = 1 + max((s for s, _, _ in files), default=-1)
    blocks = {(s, k): size for k, (s, _, size) in enumerate(files)}
    moves = plan_moves(blocks, old_shards, new_shards) if files else []
    gone = [(files[m.piece][1], m.new) for m in moves if m.old != m.new]
    if gone:
        goals = spark.createDataFrame(gone, "_file string, _goal int")
        taken = spark.read.schema(schema).option("basePath", path).parquet(*[f for f, _ in gone]).withColumn("_file", F.col("_metadata.file_path"))
        placed = taken.join(F.broadcast(goals), "_file").withColumn(name, F.col("_goal"))  # a row a file
        placed.repartition(len(gone), "_file").drop("_file", "_goal").write.mode("append").partitionBy(name).parquet(path)
        for file, _ in gone:
            delete(spark, re.sub("^file:/+", "file:///", file))
    plan = [(files[m.piece][1], files[m.piece][2], m.old, m.new, m.old != m.new) for m in moves]
    return spark.createDataFrame(plan, "file string, bytes long, old int, new int, moved boolean")

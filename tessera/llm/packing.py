"""Packing by cutting-stock column generation.

Documents are tokenized and cut into full sequences and one remainder each. The
remainders' length histogram, in steps of ``GRID`` tokens (at most capacity /
GRID bins, whatever the input), is a cutting-stock problem: a linear program
over patterns, whose columns a knapsack dynamic program prices. Patterns are
rounded down, what is left over is packed best-fit, and every remainder finds
its sequence from its rank among the remainders of its bin: no text, and no
list of documents, reaches the driver. Offsets are running sums of the true
lengths in a sequence, so a step costs padding, never a gap.

Null and empty texts are one id (the end id); a null id is an id like any other.
Repeated rows are packed as rows of their own. A text of any length is whole: as
many full sequences as it fills, and the rest. Columns other than id and text
are ignored. An empty table packs into nothing. Should the simplex method use up
its rounds, the patterns found so far are used and best-fit packs what is left:
more padding, no piece lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, light, staged, text_or_empty

END_ID = 0
GRID = 4  # tokens
FULL = 0  # the bin of full pieces
_engines: dict[str, "FileTokenizer"] = {}


class FileTokenizer:
    """The ids of a ``tokenizers`` byte-level BPE file, as little-endian bytes.

    tiktoken merges over the same file's vocabulary, whose ranks are the ids,
    into four bytes an id; texts with an added token's string, and those in which
    a run of blanks is too long for its pattern, go to ``tokenizers`` itself.
    Tests hold both against each other.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_file(path)
        added = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        self.added = tuple(sorted(added))
        shown = sorted(ByteLevel.alphabet())
        raw = [b for b in range(256) if chr(b) in shown]
        rest = [b for b in range(256) if b not in raw]
        byte_of = {chr(b): b for b in raw} | {chr(256 + k): b for k, b in enumerate(rest)}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in self.whole.get_vocab().items() if t not in added}
        self.engine = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        try:
            return self.engine.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
        except ValueError:  # its pattern backtracks over about a million blanks at most
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def tokenizer(path: str) -> FileTokenizer:
    if path not in _engines:
        _engines[path] = FileTokenizer(path)
    return _engines[path]


def best_pattern(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack over the lengths: the pattern of the highest total price."""
    value = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        k = int(np.searchsorted(lengths, c, side="right"))
        value[c] = value[c - 1]
        if k:
            gains = value[c - lengths[:k]] + prices[:k]
            best = int(np.argmax(gains))
            if gains[best] > value[c] + 1e-12:
                value[c], took[c] = gains[best], best
    pattern = np.zeros(len(lengths), dtype=np.int64)
    c = capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= lengths[took[c]]
    return float(value[capacity]), pattern


def first_fit_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns of a first-fit decreasing packing, each made as often as it can be."""
    left, out = demand.astype(np.int64).copy(), []
    while left.any():
        pattern, room = np.zeros(len(lengths), dtype=np.int64), capacity
        for k in np.flatnonzero(left)[::-1]:
            n = min(int(left[k]), room // int(lengths[k]))
            pattern[k] += n
            room -= n * int(lengths[k])
            if not room:
                break
        held = pattern > 0
        left -= pattern * (left[held] // pattern[held]).min()
        out.append(pattern)
    return out


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000, tolerance: float = 3e-4) -> list[tuple[np.ndarray, int]]:
    """Column generation by the revised simplex method, rounded down.

    Returns (pattern, times) with times >= 1; what the rounding leaves over is
    for the caller. ``rounds`` bounds the columns tried, not the lengths.
    """
    m = len(lengths)
    if not m:
        return []
    columns = [np.eye(m, dtype=np.int64)[i] * max(1, min(capacity // int(lengths[i]), int(demand[i]))) for i in range(m)]
    diagonal = np.array([c.max() for c in columns], dtype=float)
    inverse = np.diag(1 / diagonal)
    basis = list(range(m))
    x = demand / diagonal
    inner = lengths / capacity  # duals that no pattern breaks; their bound is the material's
    bound = float(inner @ demand)
    pool = first_fit_patterns(lengths, demand, capacity)
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        if x.sum() <= bound * (1 + tolerance) + 0.5:
            break
        pattern = None
        while pool and pattern is None:
            pattern = pool.pop(0)
            pattern = pattern if pattern @ duals > 1 + 1e-9 else None
        # Prices between the inner duals and the current ones keep the columns
        # from leaping about; where such a column is no gain, go nearer.
        for stay in (0.9, 0.6, 0.0) if pattern is None else ():
            _, found = best_pattern(stay * inner + (1 - stay) * np.maximum(duals, 0), lengths, capacity)
            if found @ duals > 1 + tolerance / 2:
                pattern = found
                break
        if pattern is None:
            break
        entering = inverse @ pattern
        rises = entering > 1e-9
        if not rises.any():
            break
        ratios = np.full(m, np.inf)
        ratios[rises] = np.maximum(x[rises], 0) / entering[rises]
        leaves = int(np.argmin(ratios))
        x = x - ratios[leaves] * entering
        x[leaves] = ratios[leaves]
        pivot = inverse[leaves] / entering[leaves]
        inverse -= np.outer(entering, pivot)
        inverse[leaves] = pivot
        columns.append(pattern)
        basis[leaves] = len(columns) - 1
    times = np.floor(np.maximum(x, 0) + 1e-7).astype(np.int64)
    chosen: dict[bytes, tuple[np.ndarray, int]] = {}
    left = demand.astype(np.int64).copy()
    for k in np.argsort(-times, kind="stable"):
        pattern = columns[basis[k]]
        held = pattern > 0
        n = min(int(times[k]), int((left[held] // pattern[held]).min()) if held.any() else 0)
        if n > 0:
            left -= n * pattern
            chosen[pattern.tobytes()] = (pattern, n + chosen.get(pattern.tobytes(), (pattern, 0))[1])
    return list(chosen.values())


def best_fit(left: np.ndarray, lengths: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Best-fit decreasing over what the rounded patterns leave."""
    room: list[int] = []
    made: list[np.ndarray] = []
    by_room: dict[int, list[int]] = {}
    for k in range(len(lengths) - 1, -1, -1):
        for _ in range(int(left[k])):
            fit = next((r for r in range(int(lengths[k]), capacity + 1) if by_room.get(r)), None)
            if fit is None:
                made.append(np.zeros(len(lengths), dtype=np.int64))
                room.append(capacity)
                b = len(made) - 1
            else:
                b = by_room[fit].pop()
            made[b][k] += 1
            room[b] -= int(lengths[k])
            by_room.setdefault(room[b], []).append(b)
    return made


def layout(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> pd.DataFrame:
    """Where the remainders go: for each length, runs of ranks.

    Ranks [lo, hi) of a length sit ``each`` to a sequence, from sequence
    ``first`` on, the j-th of them at ``offset + j * length``.
    """
    patterns = solve_patterns(lengths, demand, capacity)
    left = demand.astype(np.int64) - sum((n * p for p, n in patterns), np.zeros(len(lengths), dtype=np.int64))
    patterns += [(p, 1) for p in best_fit(left, lengths, capacity)]
    at, first, rows = np.zeros(len(lengths), dtype=np.int64), 0, []
    for pattern, n in patterns:
        offset = 0
        for k in np.flatnonzero(pattern):
            each = int(pattern[k])
            rows.append((int(lengths[k]), int(at[k]), int(at[k]) + each * n, each, first, offset))
            at[k] += each * n
            offset += each * int(lengths[k])
        first += n
    return pd.DataFrame(rows, columns=["length", "lo", "hi", "each", "first", "offset"]).sort_values(["length", "lo"])


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece, with its partition and its rank there among its like."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tok, part = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity // GRID + 2, dtype=np.int64)
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                ids = tok.ids(text) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    n = len(piece) // 4
                    bin_ = -(-n // GRID) if n < capacity else FULL
                    rows.append((doc, start, n, zlib.crc32(piece), total, bin_, part, seen[bin_]))
                    seen[bin_] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin", "part", "local_rank"])

    bounded_batches(docs.sparkSession)
    # Ids pass as strings: pandas would make nullable longs floats.
    return docs.select(F.col(id_col).cast("string").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInPandas(
        light(cut), "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, bin int, part int, local_rank long"
    )


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece.

    Full pieces are sequences of their own; remainders follow the patterns.
    """
    pieces = staged(cut_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    counts = pieces.groupBy("bin", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("bin", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = counts.groupBy("bin").agg(F.sum("n").alias("n")).collect()  # capacity / GRID rows at most
    demand = {int(r["bin"]): int(r["n"]) for r in histogram if r["bin"] != FULL}
    bins = np.array(sorted(demand), dtype=np.int64)
    plan = layout(bins, np.array([demand[n] for n in bins], dtype=np.int64), capacity // GRID)
    packed = int((plan["first"] + (plan["hi"] - plan["lo"]) // plan["each"]).max()) if len(plan) else 0
    runs = {int(n): tuple(g[c].to_numpy() for c in ("lo", "each", "first", "offset")) for n, g in plan.groupby("length")}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            of, rank = pdf["bin"].to_numpy(), pdf["rank"].to_numpy()
            sequence, slot = rank + packed, np.zeros(len(pdf), dtype=np.int64)
            for n in np.unique(of[of != FULL]):
                lo, each, first, start = runs[int(n)]
                own = np.flatnonzero(of == n)
                k = np.searchsorted(lo, rank[own], side="right") - 1
                at = rank[own] - lo[k]
                sequence[own] = first[k] + at // each[k]
                slot[own] = start[k] + (at % each[k]) * n
            pdf["sequence_id"], pdf["slot"] = sequence, slot
            yield pdf.drop(columns=["rank", "bin"])

    ranked = pieces.join(bases, ["bin", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin", (F.col("base") + F.col("local_rank")).alias("rank")
    )
    placed = ranked.mapInPandas(light(place), "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long")
    placed = placed.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")

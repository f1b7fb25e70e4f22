"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of ``LEAST`` words (a seed)
are tiled: running Karp-Rabin finds the longest runs of words common to both
that no tile covers yet, marks them, and goes on with shorter ones down to
``LEAST`` words. Tiles may lie in any order, so a reordered passage counts in
full. An item leaks into a document if tiles cover at least ``threshold`` of
its words.

Seeds are looked up in a broadcast table where the benchmark has at most
``max_words`` words, which is checked; a larger one is joined on the seeds.
Both give the same pairs.

Null and blank texts leak nothing. Items of fewer than ``LEAST`` words have no
seed and never match. A document is its id (or none) and text: rows repeated
with both give one row, another text of an id is searched by itself; of several
texts of an item id each is searched, and the best covered one is reported.
Equal words are equal 64-bit hashes. A long text is a slice of its own; pairs of
places are extended by hashes, a bounded number at a time, so a text of one
repeated word costs some array operations a word. Extra columns, whatever their
names, are ignored; empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, light
from tessera.llm.textarrays import mix, powers, slices, word_hashes

LEAST = 5
SLICE = 500_000  # characters of text worked on at once
PAIRS = 1_000_000  # pairs of places extended at once
_FILTER_BITS = 22
_STEP = np.uint64(0x9E3779B97F4A7C15)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words (Horner's rule over the run)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = total * _STEP + words[k : k + n]
    return mix(total)


def free_runs(words: np.ndarray, marked: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(Karp-Rabin hash, place) of every unmarked run of ``size`` words."""
    covered = np.concatenate(([0], np.cumsum(marked)))
    place = np.flatnonzero(covered[size:] == covered[:-size]) if len(words) >= size else np.zeros(0, dtype=np.int64)
    return run_hashes(words, size)[place], place


def common_runs(item: np.ndarray, doc: np.ndarray, used_item: np.ndarray, used_doc: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(-length, start in the item, start in the document) of every maximal run of
    at least ``size`` unmarked words common to both, in this order."""
    ours, at = free_runs(item, used_item, size)
    if not len(ours):
        return []
    theirs, places = free_runs(doc, used_doc, size)
    order = np.argsort(ours, kind="stable")
    ours, at = ours[order], at[order]
    low, high = np.searchsorted(ours, theirs, "left"), np.searchsorted(ours, theirs, "right")
    hit = np.flatnonzero(high > low)
    low, count, places = low[hit], (high - low)[hit], places[hit]
    total = np.cumsum(count)
    if not len(total):
        return []
    # Marked words differ from everything, so no extension crosses them.
    x, y = item.copy(), doc.copy()
    x[used_item] = mix(_STEP - np.flatnonzero(used_item).astype(np.uint64))
    y[used_doc] = mix(_STEP + np.uint64(1) + np.flatnonzero(used_doc).astype(np.uint64))
    up, down = powers(max(len(x), len(y)) + 1)
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(w * up[: len(w)], dtype=np.uint64))) for w in (x, y)]
    out = []
    cut = np.unique(np.concatenate(([0], np.searchsorted(total, np.arange(PAIRS, total[-1] + PAIRS, PAIRS)))))
    for a, b in zip(cut, np.append(cut[1:], len(total))):
        n = count[a:b]
        t = np.repeat(places[a:b], n)
        p = at[np.repeat(low[a:b], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        begins = (p == 0) | (t == 0) | (x[p - 1] != y[t - 1])  # else its run begins further left
        p, t = p[begins], t[begins]
        most = np.minimum(len(x) - p, len(y) - t)
        length, step = np.zeros(len(p), dtype=np.int64), 1 << max(0, len(x).bit_length() - 1)
        fx, fy, cx, cy = down[p], down[t], sums[0][p], sums[1][t]
        while step:
            m = np.minimum(length + step, most)
            length = np.where((sums[0][p + m] - cx) * fx == (sums[1][t + m] - cy) * fy, m, length)
            step //= 2
        long = length >= size
        out.append(np.stack([-length[long], p[long], t[long]]))
    rows = np.concatenate(out, axis=1)
    return list(zip(*(r.tolist() for r in rows[:, np.lexsort((rows[2], rows[1], rows[0]))])))


def greedy_tiles(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start in the item, start in the document, length) of each tile."""
    used_item, used_doc = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)
    tiles, size = [], max(least, min(32, len(item), len(doc)))
    while True:
        found = common_runs(item, doc, used_item, used_doc, size)
        longest = -found[0][0] if found else 0
        if longest > 2 * size:
            size = longest
            continue
        pieces: list[tuple[int, int, int]] = []  # what marks leave of longer runs
        k = 0
        while k < len(found) or pieces:
            if pieces and (k == len(found) or pieces[0] < found[k]):
                n, p, t = heapq.heappop(pieces)
            else:
                n, p, t = found[k]
                k += 1
            n, own = -n, ~used_item[p : p - n]
            if not own.any():
                continue
            free = own & ~used_doc[t : t + n]
            if free.all():
                tiles.append((p, t, n))
                used_item[p : p + n] = used_doc[t : t + n] = True
                if used_item.all():
                    return tiles
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if b - a >= size:
                    heapq.heappush(pieces, (a - b, p + a, t + a))
        if size == least:
            return tiles
        size = max(least, size // 2)


def tile_pairs(items: dict[int, np.ndarray], words: np.ndarray, candidates: list[int], threshold: float) -> list[tuple[int, int, int, float, int, int]]:
    out = []
    for item in candidates:
        tiles = greedy_tiles(items[item], words)
        covered = sum(t[2] for t in tiles)
        if covered >= threshold * len(items[item]):
            out.append((item, covered, len(items[item]), covered / len(items[item]), len(tiles), max(t[2] for t in tiles)))
    return out


def best_by_item(rows: list[tuple], item_ids: dict[int, int]) -> list[tuple]:
    """Rows of item texts as rows of item ids, the best covered text's for each."""
    best: dict[int, tuple] = {}
    for key, *found in rows:
        item = item_ids[key]
        if item not in best or (found[2], found) > (best[item][2], best[item]):
            best[item] = found
    return [(item, *found) for item, found in best.items()]


RESULT = "item_id string, covered_words long, item_words long, coverage double, tiles long, longest_tile long"
_COLUMNS = ["item_id", "covered_words", "item_words", "coverage", "tiles", "longest_tile"]


class SeedIndex:
    """Seeds of the benchmark's items: a bit table first, then the exact hashes."""

    def __init__(self, rows: list[tuple[int, str]]):
        words, at = word_hashes([t for _, t in rows])
        self.items: dict[int, np.ndarray] = {}
        seeds, owners = [], []
        for (item, _), a, b in zip(rows, at[:-1], at[1:]):
            self.items[item] = words[a:b]
            hashes = np.unique(run_hashes(words[a:b], LEAST))
            seeds.append(hashes)
            owners.append(np.full(len(hashes), item, dtype=np.int64))
        seeds_, owners_ = np.concatenate([*seeds, np.zeros(0, np.uint64)]), np.concatenate([*owners, np.zeros(0, np.int64)])
        order = np.argsort(seeds_, kind="stable")
        self.seeds, self.owners = seeds_[order], owners_[order]
        self.bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.bits[self.seeds >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, words: np.ndarray, at: np.ndarray) -> dict[int, list[int]]:
        """text number -> items that share a seed with it, for a batch of words."""
        hashes = run_hashes(words, LEAST)
        place = np.flatnonzero(self.bits[hashes >> np.uint64(64 - _FILTER_BITS)])
        value = hashes[place]
        low, high = np.searchsorted(self.seeds, value, "left"), np.searchsorted(self.seeds, value, "right")
        text = np.searchsorted(at, place, side="right") - 1
        good = (high > low) & (place + LEAST <= at[np.minimum(text + 1, len(at) - 1)])
        found: dict[int, set[int]] = defaultdict(set)
        for k in np.flatnonzero(good):
            found[int(text[k])].update(self.owners[low[k] : high[k]].tolist())
        return {k: sorted(v) for k, v in found.items()}


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, max_words: int = 4_000_000, keyed: bool = False) -> DataFrame:
    """(doc_id, item_id, covered_words, ...) of every leak; ``keyed`` adds the
    text's xxhash64 as key, which tells the texts of an id apart."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    items = items.withColumn("key", F.xxhash64("item_id", "text"))  # every text of an id is searched
    size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    text, kind = F.col("text").cast("string"), docs.schema["doc_id"].dataType
    # Ids pass as strings: pandas would make nullable longs floats.
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text.alias("text")).filter("text IS NOT NULL").withColumn("key", F.xxhash64("text"))
    columns = ["doc_id", *["key"] * keyed, *_COLUMNS]
    if size > 6 * max_words:
        found = _joined_leaks(texts, items, threshold)
    else:
        found_items = items.orderBy("item_id", "text").collect()
        index = spark.sparkContext.broadcast((SeedIndex([(r["key"], r["text"]) for r in found_items]), {r["key"]: r["item_id"] for r in found_items}))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            table, item_ids = index.value
            for pdf in batches:
                ids, keys, bodies, rows = pdf["doc_id"].tolist(), pdf["key"].tolist(), pdf["text"].tolist(), []
                for a, b in slices(bodies, SLICE):
                    words, at = word_hashes(bodies[a:b])
                    for k, hit in table.hits(words, at).items():
                        rows += [(ids[a + k], keys[a + k], *x) for x in best_by_item(tile_pairs(table.items, words[at[k] : at[k + 1]], hit, threshold), item_ids)]
                yield pd.DataFrame(rows, columns=["doc_id", "key", *_COLUMNS])

        found = texts.mapInPandas(light(scan), f"doc_id string, key long, {RESULT}")
    found = found.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("item_id", F.col("item_id").cast(benchmark.schema["item_id"].dataType))
    return found.select(columns).distinct()


def _joined_leaks(texts: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """The same by a join on the seeds, for a benchmark of any size; a text is
    searched once, however many rows have it."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bodies, keys = pdf["text"].tolist(), pdf["key"].to_numpy()
            for a, b in slices(bodies, SLICE):
                words, at = word_hashes(bodies[a:b])
                hashes = run_hashes(words, LEAST)
                number = np.searchsorted(at, np.arange(len(hashes)), side="right") - 1
                whole = np.arange(len(hashes)) + LEAST <= at[number + 1] if len(hashes) else np.zeros(0, dtype=bool)
                yield pd.DataFrame({"of": keys[a + number[whole]], "seed": hashes[whole].astype(np.int64)}).drop_duplicates()

    distinct = texts.select("key", "text").dropDuplicates(["key"])
    doc_seeds = distinct.mapInPandas(light(emit), "of long, seed long")
    item_seeds = items.select("key", "text").mapInPandas(light(emit), "of long, seed long").withColumnRenamed("of", "item_key")
    pairs = doc_seeds.join(item_seeds, "seed").select(F.col("of").alias("key"), "item_key").distinct()
    both = pairs.join(distinct, "key").join(items.select(F.col("key").alias("item_key"), "item_id", F.col("text").alias("item_text")), "item_key")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                words, at = word_hashes([r.item_text, r.text])
                rows += [(r.key, *x) for x in tile_pairs({r.item_id: words[: at[1]]}, words[at[1] :], [r.item_id], threshold)]
            yield pd.DataFrame(rows, columns=["key", *_COLUMNS])

    rest = ["coverage", *[c for c in _COLUMNS[1:] if c != "coverage"]]
    best = both.mapInPandas(light(check), f"key long, {RESULT}").groupBy("key", "item_id").agg(F.max(F.struct(*rest)).alias("best"))
    best = best.select("key", "item_id", *[F.col(f"best.{c}").alias(c) for c in _COLUMNS[1:]])
    return texts.select("doc_id", "key").join(best, "key").select("doc_id", "key", *_COLUMNS)

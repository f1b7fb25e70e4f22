"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles; equal sets are one node. A
node is embedded by MinHash; the value at a position is a shingle sampled
alike from every set that holds it, so agreeing there is sharing a sampled
token. Each run splits all nodes by their token at one position. A bucket of at
most ``BUCKET`` nodes is compared by brute force. A larger one is compared with
its least node, and unless all agree with it, split again on further sampled
tokens. Where few nodes disagree, and at the last depth, they are compared with
the whole bucket block by block, so no bucket is cut short. A pair of similarity
s is missed by every run with probability (1 - s)**runs if its buckets are small.
In large ones it survives a level by either of two tokens, a branching process
that dies out with the least probability q = (1 - s + s q)**2, at any depth: all
runs miss with (1 - s + s q)**runs at most, were positions independent. Runs
are repeated until that is no more than 1 - ``recall`` (``runs_for``).

Comparisons in buckets are by embedding and lenient. They give candidate
components, within which the exact similarity of all pairs is counted on the
sets themselves, in blocks of bounded size. Of equal sets one stands for all,
and its links count with their numbers of documents.

Null texts are empty. A text of fewer than five words is one shingle of all;
texts without a word are linked to equal texts alone. A row is its id and text:
rows repeated with the same text are copies, an id repeated with another text
is another document, and a row without an id takes part and is named last (a
class of such rows alone has a null class_id). Texts of any length are whole
sets, a long one in a slice of its own. Ties of the least id are broken by a
hash of the text. Extra columns, whatever their names, are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, by_runs, discard, light, scratch, staged, text_or_empty
from tessera.llm.components import connected_components
from tessera.llm.textarrays import mix, shingles, slices

SHINGLE = 5
WIDTH = 64  # embedding positions
BUCKET = 4096  # nodes of a bucket that are compared by brute force
BLOCK = 256  # sets verified at once
DEPTH = 8
CHILDREN = 2  # above 1 / threshold, or what is similar to the threshold dies out
COLUMNS = ["u", "v", "path", "node", "far", "emb"]
HAND = 4  # rows that a block comparison may make of each row before the last depth
_SCALE = np.random.default_rng(99).integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def embed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash of each set, WIDTH values of 32 bits; no set may be empty."""
    out = np.empty((len(at) - 1, WIDTH), dtype=np.uint32)
    for k in range(WIDTH):
        out[:, k] = np.minimum.reduceat(((values * _SCALE[k]) >> np.uint64(32)).astype(np.uint32), at[:-1])
    return out


def runs_for(threshold: float, recall: float) -> int:
    """How many runs miss a pair of similarity ``threshold`` with at most 1 - recall."""
    miss = 1 - threshold
    for _ in range(200):  # the chance that both children's branches die out
        miss = (1 - threshold + threshold * miss) ** CHILDREN
    once = 1 - threshold + threshold * miss
    return min(WIDTH, max(1, int(np.ceil(np.log(1 - recall) / np.log(once)))))


def set_nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, node, n, emb): the text's hash, the set's identity, size and embedding."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            node, size, emb = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64), [None] * len(texts)
            for a, b in slices(texts, 500_000):
                values, at = shingles(texts[a:b], SHINGLE)
                n = np.diff(at)
                size[a:b] = n
                full = np.flatnonzero(n)
                if len(full):
                    starts = np.append(at[:-1][full], at[-1])
                    rows = embed(values, starts)
                    sums = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts[:-1])
                    node[a + full] = sums.astype(np.int64)
                    for k, row in zip(full.tolist(), rows):
                        emb[a + k] = row.tobytes()
                for k in np.flatnonzero(n == 0).tolist():
                    digest = hashlib.blake2b(b"no word " + texts[a + k].encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    node[a + k] = int.from_bytes(digest, "little", signed=True)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "key": pdf["key"], "node": node, "n": size, "emb": emb})

    bounded_batches(docs.sparkSession)
    text = text_or_empty(text_col)
    # Ids pass as strings: pandas would make nullable longs floats.
    slim = docs.select(F.col(id_col).cast("string").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))
    found = slim.mapInPandas(light(read), "doc_id string, key long, node long, n long, emb binary")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def stack(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(-1, WIDTH)


def with_paths(nodes: DataFrame, runs: int) -> DataFrame:
    """(path, node, far, emb): a path of one token for each run."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                emb, run = stack(pdf["emb"])[:, :runs].astype(np.uint64), np.arange(1, runs + 1, dtype=np.uint64)
                path = mix(mix(emb + run * np.uint64(0x9E3779B97F4A7C15)) + run)
                yield pd.DataFrame({"path": path.ravel().astype(np.int64), "node": np.repeat(pdf["node"].to_numpy(), runs), "far": True, "emb": np.repeat(pdf["emb"].to_numpy(), runs)})

    return nodes.select("node", "emb").mapInPandas(light(emit), "path long, node long, far boolean, emb binary")


def first_paths(nodes: DataFrame, runs: int) -> DataFrame:
    return with_paths(nodes, runs).select("path", "node")


def next_paths(rows: DataFrame) -> DataFrame:
    """Each path extended by the tokens at CHILDREN positions that it chooses."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            emb, path = stack(pdf["emb"]), pdf["path"].to_numpy().astype(np.uint64)
            for c in range(CHILDREN):
                place = (mix(path + np.uint64(c * 7919 + 1)) % np.uint64(WIDTH)).astype(np.int64)
                token = emb[np.arange(len(path)), place].astype(np.uint64)
                child = mix(mix(path + np.uint64(c)) ^ (token * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)))
                yield pdf[["node", "far", "emb"]].assign(path=child.astype(np.int64))[["path", "node", "far", "emb"]]

    return rows.mapInPandas(light(emit), "path long, node long, far boolean, emb binary")


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each index's component, for pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        now = now[now]
        if (now == root).all():
            return root
        root = now


def spanning(emb: np.ndarray, enough: int) -> np.ndarray:
    """Least index of each embedding's component among those of one bucket that
    agree in ``enough`` positions."""
    n = len(emb)
    root, columns = np.arange(n), np.ascontiguousarray(emb.T)
    for lo in range(0, n, 256):
        hi = min(lo + 256, n)
        same = np.zeros((hi - lo, hi), dtype=np.uint8)
        for c in columns:
            same += c[lo:hi, None] == c[None, :hi]
        b, a = np.nonzero(same >= enough)
        root = roots_of(n, np.concatenate((np.arange(n), a)), np.concatenate((root, b + lo)))
    return root


def bucket_rows(rows: DataFrame, lenient: float, whole: bool = False) -> DataFrame:
    """Compares each bucket of ``rows`` (path, node, far, emb) by brute force.

    Gives (u, v), edges that span the agreeing nodes, and the rows of buckets
    of more than BUCKET nodes as they are (unless ``whole``); those pass
    through, so a task holds one bucket of bounded size at a time.
    """
    enough, limit = int(np.ceil(lenient * WIDTH)), None if whole else BUCKET

    def edges(path: np.ndarray, node: np.ndarray, emb: np.ndarray) -> pd.DataFrame:
        begin = np.flatnonzero(np.concatenate(([True], path[1:] != path[:-1])))
        count = np.diff(np.append(begin, len(path)))
        root = np.arange(len(path))
        for k in np.flatnonzero(count > 64):
            part = slice(begin[k], begin[k] + count[k])
            root[part] = begin[k] + spanning(emb[part], enough)
        # Small buckets side by side: the j-th of a bucket meets the j before it.
        place = np.where(np.repeat(count, count) > 64, 0, np.arange(len(path)) - np.repeat(begin, count))
        total = np.cumsum(place)
        cut = np.unique(np.searchsorted(total, np.arange(0, total[-1] + 100_000, 100_000)))
        a_all, b_all = [np.arange(len(path))], [root]
        for lo, hi in zip(cut, np.append(cut[1:], len(path))):
            p = place[lo:hi]
            b = np.repeat(np.arange(lo, hi), p)
            a = b - 1 - (np.arange(len(b)) - np.repeat(np.cumsum(p) - p, p))
            same = (emb[a] == emb[b]).sum(axis=1) >= enough
            a_all.append(a[same])
            b_all.append(b[same])
        root = roots_of(len(path), np.concatenate(a_all), np.concatenate(b_all))
        moved = root != np.arange(len(path))
        return pd.DataFrame({"u": node[moved], "v": node[root[moved]]}).drop_duplicates().assign(path=None, node=None, far=None, emb=None)

    def wide_rows(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(u=None, v=None)[COLUMNS]

    def deal(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        path = pdf["path"].to_numpy()
        begin = np.concatenate(([True], path[1:] != path[:-1]))
        run = np.cumsum(begin) - 1
        count, far = np.bincount(run)[run], np.bincount(run, weights=pdf["far"].to_numpy(dtype=float))[run]
        wide = count > limit if limit else np.zeros(len(pdf), dtype=bool)
        if wide.any():
            yield wide_rows(pdf[wide])
        # Pairs of nodes that agree with one pivot are joined by it, so a bucket
        # without a node far from the last pivot has nothing left to find.
        own = ~wide & (count > 1) & (far > 0)
        if own.any():
            yield edges(path[own], pdf["node"].to_numpy()[own], stack(pdf["emb"][own]))

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, passing = None, None
        for pdf in batches:
            if passing is not None and len(pdf):
                own = pdf["path"].to_numpy() == passing
                if own.any():
                    yield wide_rows(pdf[own])
                pdf = pdf[~own]
                passing = None if len(pdf) else passing
            if not len(pdf):
                continue
            pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            last = pdf["path"].iloc[-1]
            n = int((pdf["path"].to_numpy() != last).sum())  # sorted: all but the last bucket are complete
            kept = pdf.iloc[n:]
            if n:
                yield from deal(pdf.iloc[:n])
            if limit and len(kept) > limit:
                yield wide_rows(kept)
                kept, passing = None, last
        if kept is not None:
            yield from deal(kept)

    dealt = rows.select("path", "node", "far", "emb").repartition("path").sortWithinPartitions("path", "node")
    return dealt.mapInPandas(light(runs), "u long, v long, path long, node long, far boolean, emb binary")


def agreeing(a: str, b: str, lenient: float):
    """Whether two embeddings agree at enough positions, as a vectorised function."""
    enough = int(np.ceil(lenient * WIDTH))

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series((stack(x) == stack(y)).sum(axis=1) >= enough) if len(x) else pd.Series([], dtype=bool)

    return agree(a, b)


def candidate_edges(nodes: DataFrame, runs: int, lenient: float) -> DataFrame:
    """Edges (u, v) whose components hold every similar pair, but for the chance
    that no run or the embedding shows it."""
    level, found = with_paths(nodes, runs), []
    for depth in range(DEPTH + 1):
        dealt = staged(bucket_rows(level, lenient), "buckets")
        found.append(dealt.filter("path IS NULL").select("u", "v"))
        large = dealt.filter("path IS NOT NULL").select("path", "node", "far", "emb")
        if large.isEmpty():
            break
        sizes = large.groupBy("path").agg(F.count("*").alias("size"), F.min("node").alias("pivot"), F.max("far").alias("open")).filter("open").drop("open")
        live = staged(large.drop("far").join(sizes.hint("merge"), "path"), "large")
        pivots = live.filter("node = pivot").select("path", F.col("emb").alias("pivot_emb"))
        split = staged(live.join(pivots, "path").withColumn("far", ~agreeing("emb", "pivot_emb", lenient)).drop("pivot_emb"), "pivots")
        discard(live)
        found.append(split.filter("NOT far AND node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")))
        odd = split.filter("far").groupBy("path").agg(F.count("*").alias("odd"))
        if odd.isEmpty():
            break
        crowded, (blocks, odd_blocks) = split.join(odd, "path"), grid()
        cheap = F.col("odd") * blocks + F.col("size") * odd_blocks <= HAND * F.col("size") if depth < DEPTH else F.lit(True)
        cells = bucket_rows(block_cells(crowded.filter(cheap)), lenient, whole=True)
        found.append(staged(cells.select("u", "v"), "cells"))
        if depth == DEPTH:
            break
        rest = crowded.filter(~cheap).select("path", "node", "far", "emb")
        if rest.isEmpty():
            break
        level = next_paths(rest)
    return reduce(DataFrame.union, found)


def grid():
    """Numbers of blocks of a bucket's nodes, and of those that do not agree."""
    half = max(1, BUCKET // 2)
    return F.ceil(F.col("size") / half).cast("int"), F.ceil(F.col("odd") / half).cast("int")


def block_cells(rows: DataFrame) -> DataFrame:
    """(path, node, emb) of buckets that meet what does not agree with the pivot
    with all, in blocks of both."""
    blocks, odd_blocks = grid()
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    side = F.pmod(F.xxhash64("node", F.lit(1)), odd_blocks).cast("int")
    left = rows.filter("far").select("path", "node", "far", "emb", side.alias("i"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"))
    right = rows.select("path", "node", "far", "emb", F.explode(F.sequence(F.lit(0), odd_blocks - 1)).alias("i"), own.alias("j"))
    cells = left.unionByName(right).distinct()
    return cells.select(F.xxhash64("path", "i", "j").alias("path"), "node", "far", "emb")


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix: which of the left sets are similar to which of the right."""
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    begin = np.concatenate(([True], values[1:] != values[:-1]))
    token = np.cumsum(begin) - 1
    often = np.bincount(token)[token] > 1
    token, rows = token[often], rows[often]
    if len(token):
        token = np.cumsum(np.concatenate(([True], token[1:] != token[:-1]))) - 1
        at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
        at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
        for c in range(0, int(token[-1]) + 1, 4096):
            lo, hi = np.searchsorted(token, [c, c + 4096])
            t, r = token[lo:hi] - c, rows[lo:hi]
            x, y = np.zeros((len(left), 4096), dtype=np.float32), np.zeros((len(right), 4096), dtype=np.float32)
            a, b = at_left[r] >= 0, at_right[r] >= 0
            x[at_left[r[a]], t[a]] = 1
            y[at_right[r[b]], t[b]] = 1
            shared += x @ y.T
    n = np.array([len(s) for s in sets], dtype=np.float64)
    return shared >= threshold * (n[left][:, None] + n[right][None, :] - shared) - 1e-6


def verified(cells: DataFrame, threshold: float) -> DataFrame:
    """Exact links within the cells of components: (node, root, links, set_links)
    per cell, root the cell's first of the nodes that are linked to each other."""

    def check(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
        weight, side, i, j = pdf["weight"].to_numpy(), pdf["side"].to_numpy(), pdf["i"].iloc[0], pdf["j"].iloc[0]
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        links, set_links = np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
        if not len(left) or not len(right):
            return np.arange(len(pdf)), links, set_links
        near = similar([np.frombuffer(v, dtype=np.uint64) for v in pdf["shingles"]], left, right, threshold)
        if i == j:
            np.fill_diagonal(near, False)
        links[left] += near @ weight[right]
        set_links[left] += near.sum(axis=1)
        if i != j:
            links[right] += near.T @ weight[left]
            set_links[right] += near.sum(axis=0)
        a, b = np.nonzero(near)
        return roots_of(len(pdf), left[a], right[b]), links, set_links

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["cell", "node"], ignore_index=True)  # rows repeated with one id and text
        cell = pdf["cell"].to_numpy()
        begin = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        root, links, set_links = np.arange(len(pdf)), np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
        for a, b in zip(begin.tolist(), np.append(begin[1:], len(pdf)).tolist()):
            root[a:b], links[a:b], set_links[a:b] = check(pdf.iloc[a:b])
            root[a:b] += a
        rep = pdf[["node", "first", "first_key"]].iloc[root]
        return pd.DataFrame({
            "node": pdf["node"], "many": pdf["blocks"] > 1, "root": rep["node"].to_numpy(), "class_id": rep["first"].to_numpy(),
            "class_key": rep["first_key"].to_numpy(), "links": links, "set_links": set_links,
        })

    ordered = cells.repartition("cell").sortWithinPartitions("cell", F.col("first").isNull(), "first", "first_key").withColumn("first", F.col("first").cast("string"))
    schema = "node long, many boolean, root long, class_id string, class_key long, links long, set_links long"
    return ordered.mapInPandas(by_runs("cell", whole, 4000, "shingles"), schema).withColumn("class_id", F.col("class_id").cast(cells.schema["first"].dataType))


def classes(docs: DataFrame, threshold: float = 0.8, recall: float = 1 - 1e-7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, class_id, class_key, n_links, n_text_links) per row; the row
    of its class's least id and key stands for the class."""
    rows = staged(set_nodes(docs, id_col, text_col), "sets", keep=True)
    with scratch(docs.sparkSession):
        known = class_nodes(docs, rows, threshold, recall, id_col, text_col)
    return rows.select("doc_id", "key", "node").join(known, "node").drop("node")


def class_nodes(docs: DataFrame, rows: DataFrame, threshold: float, recall: float, id_col: str, text_col: str) -> DataFrame:
    """(node, class_id, class_key, n_links, n_text_links) of every set."""
    slack = 5 * (threshold * (1 - threshold) / WIDTH) ** 0.5
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("f")
    nodes = rows.groupBy("node").agg(least, F.count("*").alias("weight"), F.max("n").alias("n"), F.max("emb").alias("emb"))
    nodes = staged(nodes.select("node", F.col("f.doc_id").alias("first"), F.col("f.key").alias("first_key"), "weight", "n", "emb"), "nodes")
    pairs = candidate_edges(nodes.filter("n > 0"), runs_for(threshold, recall), threshold - slack)
    comps = connected_components(pairs)
    named = staged(comps.join(nodes.select("node", "first", "first_key", "weight"), "node").withColumnRenamed("root", "comp"), "components")
    sizes = named.groupBy("comp").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    wanted = named.join(sizes, "comp").withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            out = []
            for a, b in slices(texts, 500_000):
                values, at = shingles(texts[a:b], SHINGLE)
                out += [values[x:y].tobytes() for x, y in zip(at[:-1], at[1:])]
            yield pdf.drop(columns="text").assign(shingles=out)

    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))
    same = F.col("first").eqNullSafe(F.col("doc_id")) & (F.col("first_key") == F.col("key"))
    kind = docs.schema[id_col].dataType
    fields = ["node", "comp", "first", "first_key", "weight", "blocks", "side"]
    chosen = wanted.hint("merge").join(texts, same).select(*fields, "text").withColumn("first", F.col("first").cast("string"))
    sets = chosen.mapInPandas(light(read), "node long, comp long, first string, first_key long, weight long, blocks int, side int, shingles binary")
    sets = sets.withColumn("first", F.col("first").cast(kind))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = sets.withColumn("k", other).withColumn("i", F.least("side", "k")).withColumn("j", F.greatest("side", "k")).withColumn("cell", F.xxhash64("comp", "i", "j"))
    links = staged(verified(cells, threshold), "links")
    # A component of one block is done; of larger ones the cells' links are joined.
    done = links.filter("NOT many").drop("many", "root")
    many = links.filter("many")
    roots = connected_components(many.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    total = many.groupBy("node").agg(F.sum("links").alias("links"), F.sum("set_links").alias("set_links"))
    rooted = total.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(nodes.select("node", "first", "first_key"), "node")
    least = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "first_key")).alias("f")
    heads = rooted.groupBy("root").agg(least).select("root", F.col("f.first").alias("class_id"), F.col("f.first_key").alias("class_key"))
    per_node = done.unionByName(rooted.join(heads, "root").select(done.columns))
    known = nodes.select("node", "first", "first_key", "weight").join(per_node, "node", "left").select(
        "node",
        F.when(F.col("links").isNull(), F.col("first")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_key", "first_key").alias("class_key"),
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("set_links", F.lit(0)).alias("n_text_links"),
    )
    # Written first, so that the rows of a hot set can be split between tasks.
    return staged(known, "known", keep=True)


def chosen_path_join(docs: DataFrame, threshold: float = 0.8, recall: float = 1 - 1e-7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, n_text_links) per row.

    The class is a component of similar documents, named by its least id;
    n_links counts the other documents similar to this one, n_text_links the
    different shingle sets among them.
    """
    return classes(docs, threshold, recall, id_col, text_col).select("doc_id", "class_id", "n_links", "n_text_links")


def representatives(docs: DataFrame, threshold: float = 0.8, recall: float = 1 - 1e-7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key): the row that stands for each class, by its id and its text's xxhash64."""
    rows = classes(docs, threshold, recall, id_col, text_col)
    return rows.filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))).select("doc_id", "key").distinct()

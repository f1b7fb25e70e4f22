"""SimHash fingerprints and classes of near copies linked at few differing bits.

A text's words are its runs without ASCII white space, A to Z in lower case; its
shingles, repeats included, are four words joined by spaces (fewer words: all of
them). A bit of the fingerprint is set if it is in over half of the shingles'
XXH64 (seed 42). Texts without words, nulls among them, have fingerprint zero.

Fingerprints that differ in at most four bits share at least four of their eight
positional bytes. They are found through an inverted index of bytes by position:
any four of the eight places hold two of one of three groups of places, so seven
pairs of places (``FIRST``) deal distinct fingerprints to lists by two bytes.
Within a list shared positional bytes are tallied for each pair, pairs with four
or more are kept and verified, and only a spanning forest leaves the task.

A crowded list first links what is close to its commonest fingerprint (its
pivot). What is not must meet all, and no other pair has to: in blocks, a task a
cell, or, where that were too many cells, by one byte more (``next_places``).
Nothing is sampled or capped.

Links join texts into components. ``component_id`` is the least doc_id of the
component; null ids are passed over, and a component of nulls alone has null.
Repeated rows stay rows of their own. Other columns, whatever they are called,
are left out of the result. An empty table has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, by_runs, light, staged, text_or_empty
from tessera.llm.components import connected_components

WORDS, SEED, APART = 4, 42, 4
#: Equal positional bytes that APART differing bits leave at least.
SHARED = 8 - APART
#: Two of any four places are in one of the groups 0-2, 3-5 and 6-7.
FIRST = [(0, 1), (0, 2), (1, 2), (3, 4), (3, 5), (4, 5), (6, 7)]
#: Fingerprints that a list may have to be compared in place, those of a block of a
#: crowded list, and its cells at most; bytes of text looked at at once.
CROWD, BLOCK, CELLS, PIECE = 2048, 1024, 1 << 20, 1 << 20
_BLANK = re.compile(rb"[ \t-\r]")


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    text, size = b" ".join(words), np.array([len(w) + 1 for w in words])
    end = np.cumsum(size) - 1
    begin = end - size + 1
    take = max(len(words) - WORDS + 1, 1)
    xx = xxhash.xxh64_intdigest
    return np.array([xx(text[a:b], SEED) for a, b in zip(begin[:take].tolist(), end[-take:].tolist())], dtype=np.uint64)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, part by part; a part repeats the three before it."""
    begin, carry = 0, []
    while begin < len(text):
        blank = _BLANK.search(text, begin + PIECE) if len(text) - begin > PIECE else None
        end = blank.start() if blank else len(text)
        words = carry + text[begin:end].split()
        if end < len(text) and len(words) < WORDS:
            carry = words
        else:
            yield words
            carry = words[1 - WORDS :]
        begin = end


def fingerprint(text: str) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for k, words in enumerate(pieces(text.encode("utf-8", "surrogatepass").lower())):
        if not words or (k and len(words) < WORDS):
            continue
        hashes = shingle_hashes(words)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little") if n else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row, fp as a signed long."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = np.array([fingerprint(t) for t in pdf["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": found})

    kind = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", text_or_empty().alias("text"))
    # Ids travel as strings: pandas would make floats of integers beside nulls.
    named = slim.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(light(rows), "doc_id string, fp long")
    return named.withColumn("doc_id", F.col("doc_id").cast(kind))


def positional_bytes(fp: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8)


def close(fp: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view(np.uint64) ^ other.view(np.uint64)) <= APART


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` after linking a[k] with b[k]: the least index of each component."""
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root != (jumped := root[root])).any():
            root = jumped
        if (root == before).all():
            return root


def links_in_lists(key: np.ndarray, fp: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, index of its root) of close fingerprints that share a list; rows
    come sorted by ``key``. Pairs without a ``far`` row need no comparison."""
    places, root = positional_bytes(fp), np.arange(len(fp))
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(begin, len(key)))
    small = np.repeat(size <= 32, size)
    a_found, b_found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for step in range(1, min(32, int(size.max(initial=1)))):
        a = np.flatnonzero(small[:-step] & (key[step:] == key[:-step]) & (far[step:] | far[:-step]))
        if not len(a):
            break
        a = a[(places[a] == places[a + step]).sum(axis=1) >= SHARED]
        a = a[close(fp[a], fp[a + step])]
        a_found.append(a)
        b_found.append(a + step)
    root = joined(root, np.concatenate(a_found), np.concatenate(b_found))
    for start, n in zip(begin[size > 32], size[size > 32]):
        whole = np.arange(start, start + n)
        ask = whole[far[whole]]
        step = max(1, (1 << 21) // n)
        for k in range(0, len(ask), step):
            rows = ask[k : k + step]
            tally = np.zeros((len(rows), n), dtype=np.uint8)
            for p in range(8):
                tally += places[rows, p][:, None] == places[whole, p][None, :]
            i, j = np.nonzero(tally >= SHARED)
            a, b = rows[i], whole[j]
            a, b = a[near := close(fp[a], fp[b])], b[near]
            new = root[a] != root[b]
            root = joined(root, a[new], b[new])
    own = np.flatnonzero(root != np.arange(len(root)))
    return own, root[own]


def linked(rows: DataFrame) -> DataFrame:
    """Edges (u, v) within the lists of ``rows`` (key, fp, far)."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy()
        own, root = links_in_lists(pdf["key"].to_numpy(), fp, pdf["far"].to_numpy(dtype=bool))
        return pd.DataFrame({"u": fp[own], "v": fp[root]})

    dealt = rows.select("key", "fp", "far").repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInPandas(by_runs("key", work, rows=200_000), "u long, v long")


def byte(place) -> F.Column:
    """The byte of ``fp`` at a place, the lowest first."""
    return F.shiftrightunsigned("fp", 8 * place).bitwiseAND(F.lit(255))


def list_key(places: tuple[int, ...]):
    return F.xxhash64(F.lit(".".join(map(str, places))), *[byte(p) for p in places])


def next_places(places: tuple[int, ...]) -> list[tuple[int, ...]]:
    """One place more. Of the others, SHARED - len(places) more are equal, so one
    of any five is."""
    others = [p for p in range(8) if p not in places]
    return [(*places, p) for p in others[: len(others) - (SHARED - len(places)) + 1]]


def in_lists(rows: DataFrame, lists: list[tuple[int, ...]]) -> DataFrame:
    """(at, key, fp, n, far): each fingerprint under every one of ``lists``."""
    each = F.array(*[F.struct(F.lit(".".join(map(str, p))).alias("at"), list_key(p).alias("key")) for p in lists])
    return rows.withColumn("dealt", F.explode(each)).select("dealt.at", "dealt.key", "fp", "n", "far")


def cells(rows: DataFrame) -> DataFrame:
    """(key, fp, far) of crowded lists in which what is far meets all, block by block."""
    side = lambda count: F.greatest(F.ceil(count / BLOCK), F.lit(1)).cast("int")
    blocks, odd_blocks = side(F.col("size")), side(F.col("odd"))
    asks = rows.filter("far").select("key", "fp", "far", F.pmod(F.xxhash64("fp", F.lit(1)), odd_blocks).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"))
    all_rows = rows.select("key", "fp", F.lit(False).alias("far"), F.explode(F.sequence(F.lit(0), odd_blocks - 1)).alias("i"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("j"))
    both = asks.unionByName(all_rows).groupBy("key", "i", "j", "fp").agg(F.max("far").alias("far"))
    return both.select(F.xxhash64("key", "i", "j").alias("key"), "fp", "far")


def edges(nodes: DataFrame) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of ``nodes`` (fp, n)
    at most APART bits apart."""
    found, lists = [], FIRST
    rows = staged(in_lists(nodes.withColumn("far", F.lit(True)), lists), "lists")
    while True:
        most = F.struct("n", (-F.col("fp").cast("decimal(20)")).alias("less"), "fp")
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(most)["fp"].alias("pivot"), F.max("far").alias("open"))
        crowded = staged(sizes.filter((F.col("size") > CROWD) & F.col("open")).drop("open"), "crowded")
        if crowded.isEmpty():
            found.append(linked(rows))
            return reduce(DataFrame.union, found)
        found.append(linked(rows.join(crowded, "key", "left_anti")))
        near_pivot = F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))) <= APART
        large = staged(rows.join(crowded, "key").withColumn("far", F.col("far") & ~near_pivot), "large")
        found.append(large.filter(near_pivot & (F.col("fp") != F.col("pivot"))).select(F.col("fp").alias("u"), F.col("pivot").alias("v")))
        odd = large.filter("far").groupBy("key").agg(F.count("*").alias("odd"))
        rest = staged(large.join(odd, "key"), "rest")
        last = len(lists[0]) == SHARED
        few = F.lit(True) if last else F.col("size") * F.col("odd") <= CELLS * BLOCK * BLOCK
        found.append(linked(cells(rest.filter(few))))
        finer = rest.filter(~few).select("at", "fp", "n", "far")
        if last or finer.isEmpty():
            return reduce(DataFrame.union, found)
        deeper = [(p, next_places(p)) for p in lists]
        parts = [in_lists(finer.filter(F.col("at") == ".".join(map(str, p))).drop("at"), q) for p, q in deeper]
        lists = [q for _, more in deeper for q in more]
        rows = staged(reduce(DataFrame.union, parts), "lists")


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    printed = staged(fingerprints(docs), "fingerprints")
    nodes = staged(printed.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")), "nodes")
    found = connected_components(edges(nodes.select("fp", "n")))
    rooted = staged(nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return printed.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

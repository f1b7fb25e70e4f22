"""Language identification by rank-order profiles of character n-grams.

A text's most frequent n-grams (of one to three letters, words bounded by a
space) are ranked and compared with each language's ranked profile; an n-gram
adds the difference of its two ranks, a missing one the profile's size. The
language of the least distance is predicted, the alphabetically first of equal
ones. The score is one less the distance as a share of the largest possible.

Null texts and texts without a letter are ``und`` with score 0. Profiles are
learned from at most about ``sample`` texts a language, chosen by a hash of the
id. Repeated rows count as often as they stand there; extra columns are ignored.
A text is counted whole, in about 60 bytes of memory a character. Without a
learned language every text is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, give_back, light

UNKNOWN = "und"
Profiles = dict[str, np.ndarray]


@lru_cache(1)
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x32000)])


def grams_of(text: str, longest: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, packed 21 bits a letter, and their counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    table = letters()
    letter = table[np.minimum(codes, len(table) - 1)]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    codes = np.concatenate(([32], np.where(letter, codes, 32), [32])).astype(np.uint64)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes = codes[keep]
    found, packed = [codes[codes != 32]], codes
    for n in range(2, longest + 1):
        packed = (packed[:-1] << np.uint64(21)) | codes[n - 1 :]
        found.append(packed)
    return np.unique(np.concatenate(found), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, equal counts by n-gram."""
    return grams[np.argsort(-counts, kind="stable")[:top]]


def out_of_place(document: np.ndarray, order: np.ndarray, rank: np.ndarray, top: int) -> int:
    """Distance of a ranked document from a profile given as sorted n-grams and ranks."""
    at = np.minimum(np.searchsorted(order, document), len(order) - 1)
    return int(np.where(order[at] == document, np.abs(rank[at] - np.arange(len(document))), top).sum())


def predict(text: str | None, profiles: dict[str, tuple[np.ndarray, np.ndarray]], top: int) -> tuple[str, float]:
    if not text or not profiles:
        return UNKNOWN, 0.0
    grams, counts = grams_of(text)
    if not len(grams):
        return UNKNOWN, 0.0
    document = ranked(grams, counts, top)
    far, lang = min((out_of_place(document, *profiles[k], top), k) for k in sorted(profiles))
    return lang, max(0.0, 1 - far / (top * len(document)))


def learn_profiles(docs: DataFrame, use: Column, top: int = 300, sample: int = 2000) -> Profiles:
    """The ranked profile of each language among the rows of ``use``.

    The driver gets one count a language and ``top`` n-grams a language.
    """
    rows = docs.filter(use & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text", "doc_id")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, group in pdf.groupby("lang"):
                grams, counts = grams_of("\n".join(t for t in group["text"] if t))
                yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": counts})

    bounded_batches(docs.sparkSession)
    counted = rows.filter(draw < share).select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    sums = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A limit by rank is applied before the rows of a language meet.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    best = sums.withColumn("place", place).filter(F.col("place") <= top).collect()
    found: dict[str, list[tuple[int, int]]] = {}
    for r in best:
        found.setdefault(r["lang"], []).append((r["place"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(rows)], dtype=np.uint64) for lang, rows in found.items()}


def sorted_profiles(profiles: Profiles) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Each profile as its n-grams in order and their ranks, for lookups."""
    orders = {lang: np.argsort(profile) for lang, profile in profiles.items()}
    return {lang: (profiles[lang][order], order.astype(np.int64)) for lang, order in orders.items()}


def identify(docs: DataFrame, profiles: Profiles, top: int = 300) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    tables = sorted_profiles(profiles)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [predict(t, tables, top) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]})

    bounded_batches(docs.sparkSession)
    # Ids pass as strings: pandas would make nullable longs floats.
    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = slim.mapInPandas(light(label), "doc_id string, lang_pred string, score double")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def language_columns(profiles: Profiles, top: int = 300):
    """A column expression builder (lang_pred, score) for filters that keep rows whole."""
    tables = sorted_profiles(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([predict(t, tables, top) for t in texts], columns=["lang_pred", "score"])
        give_back()

    return label

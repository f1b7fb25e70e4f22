"""Groups of spelling variants: words that one edit turns into a commoner one.

Words are counted over whole texts; then near words, one inserted, deleted or
replaced code point apart, are found through an inverted index of positional
q-grams. Two words of lengths L and up to L + 1 that are one edit apart share at
least max(L) - 2q + 1 grams whose places differ by one at most. Hence the first
shared gram, in the order from rare to common, is among the first q + 1 of each
word, and only these grams deal words to tasks, under the key (gram, place,
length): a word waits under its own places and length, and asks for words of its
length and for words shorter by one, whose places may be its own or one less.
Within a key the waiting words' positional pairs of letters are indexed, postings
are merged by a heap, words that meet often enough are kept, and each is verified.

A key with many waiting words is dealt over blocks of them, each of which all of
the key's askers visit, so no task holds more than ``BLOCK`` waiting words of a
key. Counts, links and forms cover all texts and words.

Null texts have no words; a null id counts as an empty string. Repeated rows
count as often as they occur, tables without words give no rows. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from operator import ne

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, by_runs, light, staged

LEAST, Q, PAIR, ONE_IN, TIMES = 7, 3, 2, 31, 10
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST},}}")
#: Waiting words of a key that one task holds, characters of text looked at at
#: once, and distinct words that a task counts before it passes them on.
BLOCK, CHUNK, HELD = 4096, 1 << 20, 200_000


def lowered(run: str) -> str:
    """A to Z in lower case, all else as it is."""
    return run.encode().lower().decode()


def chunks(text: str) -> Iterator[str]:
    """Pieces of a text of about CHUNK characters that cut no run of letters."""
    begin, letter = 0, re.compile("[A-Za-zÀ-ÿ]*")
    while begin < len(text):
        end = letter.match(text, min(begin + CHUNK, len(text))).end()
        yield text[begin:end]
        begin = end


def misspelt(prefix: int, run: str) -> str:
    """``run`` without a letter if 31 divides its hash; prefix: CRC of what precedes it."""
    h = zlib.crc32(run.encode(), prefix)
    if h % ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n) of words of at least LEAST letters that occur twice or more."""

    def rows(held: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": list(held.keys()), "n": np.fromiter(held.values(), dtype=np.int64, count=len(held))})

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for pdf in batches:
            for own, text in zip(pdf["own"], pdf["text"]):
                prefix = zlib.crc32(f"{own}:".encode())
                for piece in chunks(text):
                    found = Counter(_RUN.findall(piece))
                    for run, n in found.items():
                        word = misspelt(prefix, lowered(run))
                        if len(word) >= LEAST:
                            held[word] += n
                    if len(held) >= HELD:
                        yield rows(held)
                        held = Counter()
        if held:
            yield rows(held)

    slim = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("own"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    return slim.mapInPandas(light(words), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n >= 2")


def gram_size(length: int) -> int:
    """Grams of words that wait under ``length``: the longer, the fewer words share
    one; at least two grams of 7 letters, or of more, outlive an edit."""
    return min(max(Q, (length - 1) // 2), 5)


def grams(word: str, size: int = Q) -> list[str]:
    return [word[i : i + size] for i in range(len(word) - size + 1)]


def shared_at_least(length: int, size: int) -> int:
    """Positional grams that words one edit apart share; length: of the longer one."""
    return length - 2 * size + 1


def one_edit_apart(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(map(ne, a, b)) == 1
    if len(b) - len(a) > 1:
        return False
    differ = list(map(ne, a, b))
    return True not in differ or a[(k := differ.index(True)) :] == b[k + 1 :]


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How many words hold each gram. There are at most 90**3 grams, 90 being the
    letters that words are made of: the bound on what reaches the driver."""
    each = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - Q + 1), lambda i: F.substring("word", i, F.lit(Q)))).alias("gram"))
    return {r["gram"]: r["n"] for r in each.groupBy("gram").agg(F.count("*").alias("n")).toLocalIterator()}


def keyed(words: DataFrame, often: dict[str, int]) -> DataFrame:
    """(key, asks, word, n): under which keys each word waits, and which it visits.

    A gram is as rare as the rarest of the three letters in a row that it holds.
    """
    rank = words.sparkSession.sparkContext.broadcast({g: k for k, g in enumerate(sorted(often, key=lambda g: (often[g], g)))})

    def rarest(word: str, size: int, order: dict[str, int]) -> list[tuple[str, int]]:
        each = [order[g] for g in grams(word)]
        own = sorted((min(each[i : i + size - Q + 1]), word[i : i + size], i) for i in range(len(word) - size + 1))
        return [(gram, i) for _, gram, i in own[: size + 1]]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = rank.value
        for pdf in batches:
            out = []
            for word, n in zip(pdf["word"], pdf["n"]):
                length = len(word)
                size, shorter = gram_size(length), gram_size(length - 1)
                first = rarest(word, size, order)
                out += [(f"{gram}{i},{length}", False, word, n) for gram, i in first]
                if length > LEAST:
                    first = first if size == shorter else rarest(word, shorter, order)
                    out += [(f"{gram}{j},{length - 1}", True, word, n) for gram, i in first for j in (i, i - 1) if j >= 0]
            yield pd.DataFrame(out, columns=["key", "asks", "word", "n"])

    return words.mapInPandas(light(deal), "key string, asks boolean, word string, n long")


def blocked(rows: DataFrame) -> DataFrame:
    """``key`` made a key of block: waiting words are dealt over a key's blocks,
    askers visit each; in a key of several blocks waiting words ask as well."""
    waiting = rows.filter("NOT asks").groupBy("key").agg(F.count("*").alias("waiting")).filter(F.col("waiting") > BLOCK)
    crowded = staged(waiting.select("key", F.ceil(F.col("waiting") / BLOCK).cast("int").alias("blocks")), "crowded")
    if crowded.isEmpty():
        return rows
    sized = rows.join(crowded, "key", "left")
    few, many = sized.filter("blocks IS NULL").drop("blocks"), sized.filter("blocks IS NOT NULL")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    waits = many.filter("NOT asks").withColumn("b", block)
    visits = many.withColumn("asks", F.lit(True)).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = waits.unionByName(visits).select(F.concat_ws("/", "key", "b").alias("key"), "asks", "word", "n")
    return few.unionByName(dealt)


def merged(asker: str, own: list[str], index: list[dict[str, list[int]]], words, least: int) -> list[int]:
    """Waiting words that share ``least`` positional grams with ``asker``.

    ``index`` has, for each place, a gram's words in order. Words of the same
    length share grams at the same places; of a word shorter by one those beyond
    the edit are one place earlier. A word that is in ``least`` lists is in one
    of all but the ``least - 1`` longest: those are merged by a heap, and words
    that meet there are counted in the longest by a look at their letters.
    """
    lists = [(len(postings), i, gram, postings) for i, gram in enumerate(own[: len(index)]) if (postings := index[i].get(gram))]
    if len(own) > len(index):
        lists += [(len(postings), i, gram, postings) for i, gram in enumerate(own[1:]) if (postings := index[i].get(gram))]
    if len(lists) < least:
        return []
    lists.sort()
    short, long = lists[: len(lists) - least + 1], [(gram, i) for _, i, gram, _ in lists[len(lists) - least + 1 :]]
    found, last, n = [], -1, 0
    for k in chain(heapq.merge(*[x[3] for x in short]) if len(short) > 1 else short[0][3], (-1,)):
        if k == last:
            n += 1
            continue
        if n >= least or n and n + sum([words[last].startswith(gram, i) for gram, i in long]) >= least:
            found.append(last)
        last, n = k, 1
    return found


def near_pairs(rows: DataFrame) -> DataFrame:
    """(word, near, near_n) in both directions, once each."""

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        out, key, every = [], pdf["key"].to_numpy(), pdf["asks"].to_numpy()
        edge = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key))
        all_words, all_counts = pdf["word"].to_numpy(), pdf["n"].to_numpy()
        for a, b in zip(edge[:-1], edge[1:]):
            # Rows that wait come before those that ask, and all that wait are of one length.
            if b - a < 2 or every[a]:
                continue
            words, counts = all_words[a:b], all_counts[a:b]
            waiting = b - a - int(every[a:b].sum())
            index: list = [{} for _ in range(len(words[0]) - PAIR + 1)]
            for q in range(b - a):
                word, own = words[q], grams(words[q], PAIR)
                for k in merged(word, own, index, words, shared_at_least(len(word), PAIR)):
                    if one_edit_apart(word, words[k]):
                        out += [(word, words[k], counts[k]), (words[k], word, counts[q])]
                if q < waiting:
                    for i, gram in enumerate(own):
                        index[i].setdefault(gram, []).append(q)
        return pd.DataFrame(out, columns=["word", "near", "near_n"]).drop_duplicates()

    near = "key string, asks boolean, word string, n long"
    dealt = rows.repartition("key").sortWithinPartitions("key", "asks", "word").select(*[c.split()[0] for c in near.split(", ")])
    return dealt.mapInPandas(by_runs("key", meet, weigh="word"), "word string, near string, near_n long").distinct()


def forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word; form: the near word of largest
    n, the least of equals, if it is TIMES as common."""
    words = staged(words, "words")
    pairs = near_pairs(blocked(staged(keyed(words, gram_counts(words)), "grams")))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    rows = words.join(best, "word", "left").withColumn("near_n", -F.col("best.less"))
    common = F.col("near_n") >= TIMES * F.col("n")
    return rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(common, F.col("best.near")).alias("form"), F.when(common, F.col("near_n")).alias("form_n"))


def with_roots(rows: DataFrame) -> DataFrame:
    """Adds ``root``: what is reached from a word by following forms.

    Counts grow tenfold a step, so chains are short; each round doubles the
    steps taken.
    """
    rows = staged(rows, "forms")
    links = staged(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = staged(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
        moved = not after.filter("moved").isEmpty()
        links = after.drop("moved")
        if not moved:
            break
    return rows.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_groups(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every counted word of ``docs``."""
    bounded_batches(docs.sparkSession)
    return with_roots(forms(counted_words(docs))).select("word", "form", "root", "n", "n_near", "form_n")

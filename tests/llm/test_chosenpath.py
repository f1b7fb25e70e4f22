import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chosenpath
from tessera.session import ship_package

SCHEMA = "doc_id long, text string, path string"


def brute(rows):
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset({("no word", t or "")})
    root, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def sample(groups=12, copies=30, seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows, i = [], 0
    for g in range(groups):
        base = [word() for _ in range(120)] + passage
        for _ in range(copies if g < 2 else 2):
            text = list(base)
            for _ in range(r.choice((0, 1, 3, 12))):
                text[r.randrange(len(text))] = word()
            rows.append((i, " ".join(text)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "!!!"), (i + 3, "???"), (i + 4, "one two"), (i + 5, "One, two"), (i + 6, "x")]
    return rows


@pytest.mark.parametrize("bucket, depth", [(128, 8), (6, 3), (6, 0)])
def test_links_and_classes_equal_brute_force(spark, monkeypatch, bucket, depth):
    monkeypatch.setattr(chosenpath, "BUCKET", bucket)
    monkeypatch.setattr(chosenpath, "DEPTH", depth)
    monkeypatch.setattr(chosenpath, "BLOCK", 16)
    ship_package(spark)
    rows = sample()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(5)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in chosenpath.chosen_path_join(docs).collect()}
    assert got == brute(rows)


def test_empty_table(spark):
    ship_package(spark)
    assert chosenpath.chosen_path_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_links_equal_brute_force_where_few_disagree(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "BUCKET", 4)
    monkeypatch.setattr(chosenpath, "BLOCK", 16)
    ship_package(spark)
    rows = sample(groups=6, copies=40, seed=8)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(5)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in chosenpath.chosen_path_join(docs).collect()}
    assert got == brute(rows)


def test_similar_pairs_stay_together_down_to_the_last_level(spark):
    """Isolated pairs of similarity 0.8, all of whose buckets are split again."""
    ship_package(spark)
    r, pairs = np.random.default_rng(3), 400
    a, b = (r.integers(0, 1 << 32, (pairs, chosenpath.WIDTH), dtype=np.uint32) for _ in range(2))
    b = np.where(r.random(a.shape) < 0.8, a, b)
    nodes = spark.createDataFrame([(2 * k + side, x[k].tobytes()) for k in range(pairs) for side, x in enumerate((a, b))], "node long, emb binary")
    level = chosenpath.first_paths(nodes, 12).join(nodes, "node").select("path", "node", F.lit(True).alias("far"), "emb")
    for _ in range(chosenpath.DEPTH):
        level = chosenpath.next_paths(level)
        both = level.groupBy("path").count().filter("count > 1").select("path")
        level = level.join(both, "path").localCheckpoint()
    assert level.select(F.expr("node div 2")).distinct().count() == pairs


def test_links_of_an_id_with_two_texts_and_of_rows_without_an_id(spark):
    ship_package(spark)
    r = np.random.default_rng(6)
    text = lambda: [f"w{k}" for k in r.integers(0, 10**6, 100)]
    near = lambda t: " ".join([*t[:-1], "other"])
    x, y, z = text(), text(), text()
    rows = [(5, " ".join(x)), (5, " ".join(y)), (6, near(x)), (7, near(y)), (None, " ".join(z)), (None, near(z)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"] or 99, r["class_id"] or 99, r["n_links"]) for r in chosenpath.chosen_path_join(docs).collect()))
    assert got == [(5, 5, 1), (5, 5, 1), (6, 5, 1), (7, 5, 1), (99, 99, 0), (99, 99, 1), (99, 99, 1)]
    kept = [r["doc_id"] for r in chosenpath.representatives(docs).collect()]
    assert sorted(k or 99 for k in kept) == [5, 5, 99, 99]


def test_runs_follow_from_the_target_recall():
    assert chosenpath.runs_for(0.8, 1 - 1e-7) == 12
    assert [chosenpath.runs_for(0.8, q) for q in (0.5, 0.9, 0.99)] == [1, 2, 4]


def test_long_text_and_string_ids(spark):
    ship_package(spark)
    r = np.random.default_rng(7)
    words = [f"w{k}" for k in r.integers(0, 10**6, 150_000)]
    rows = [("b", " ".join(words)), ("a", " ".join([*words[:-20], "other"])), ("c", "short text")]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in chosenpath.chosen_path_join(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": ("a", 1), "b": ("a", 1), "c": ("c", 0)}

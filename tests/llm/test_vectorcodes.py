"""Product codes: screening, learning and coding against exact arithmetic."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import queries, vectorcodes


def test_screening_keeps_the_nearest_of_large_and_near_equal_entries():
    r = np.random.default_rng(3)
    for scale in (1, 1 << 10, 1 << 20, 1 << 26):
        base = r.integers(-scale, scale + 1, 8)
        book = base + r.integers(-2, 3, (16, 8))
        book[5] = book[9]
        x = np.concatenate((base + r.integers(-3, 4, (300, 8)), r.integers(-scale, scale + 1, (300, 8)), book))
        far = ((x[:, None, :].astype(object) - book[None].astype(object)) ** 2).sum(axis=2)
        code, away = vectorcodes.nearest(x, book)
        assert code.tolist() == [min(range(16), key=lambda e: (row[e], e)) for row in far]
        assert away.tolist() == [min(row) for row in far]
        # Float32 alone would not do for the largest, and screening must leave entries out for the smallest.
        assert vectorcodes.screened(x, book).sum() < (2 if scale == 1 else 16) * len(x) * 4


def brute(rows, parts=8, entries=16, rounds=6):
    ints = [(i, [math.floor(4096 * c) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = len(ints[0][1]) // parts if ints else 0
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(ints, key=lambda r: r[:2])[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def best(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in ints:
                groups[best(v, p)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    out, sums = [], defaultdict(int)
    for i, v, label in ints:
        found = [best(v, p) for p in range(parts)]
        out.append([i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label])
        sums[label] += out[-1][2]
    return sorted((i, code, error, sums[label], digest) for i, code, error, label in out)


@pytest.mark.parametrize("limit", [vectorcodes.BROADCAST_LABELS, 0])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(vectorcodes, "BROADCAST_LABELS", limit)
    r = random.Random(5)
    some = lambda: [float(np.float32(r.choice((-1, 1)) * r.random() * r.choice((0.001, 1, 3)))) for _ in range(16)]
    rows = [(3 * k, some(), r.choice((1, 1, 1, 2, None))) for k in range(120)]
    rows += [(1, None, 1), (2, [math.nan] + [0.0] * 15, 1), (4, [math.inf] + [0.0] * 15, 2), (5, [None] + [0.0] * 15, 2), (7, [0.0] * 16, None)]
    rows += [(400, rows[3][1], 1), (401, rows[3][1], 1), rows[9], (-5, [0.5] * 16, 3)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.QUERIES["op11_vector_codes"](spark, str(tmp_path))
    assert sorted(tuple(x) for x in got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()) == brute(rows)


def test_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label string, CODE string, _label int"
    assert vectorcodes.compress(spark.createDataFrame([], kind)).count() == 0
    rows = [(None, [1.0] * 10, "a", "x", 1), (1, [0.5] * 10, "a", "y", 2), (2, [3e38] * 10, "b", "z", 3), (3, [1.0], None, None, 4), (0, [], None, None, 5)]
    got = {x["vec_id"]: x for x in vectorcodes.compress(spark.createDataFrame(rows, kind)).collect()}
    # The first vector with components is the first entry; the null id comes last.
    assert got[1]["code"] == "00" * 8 and got[None]["code"] == "01" * 8 and got[1]["error"] == 0
    assert all(got[k]["code"] is None and got[k]["error"] is None for k in (0, 2, 3)) and got[1]["_label"] == 2

"""SimHash classes against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from tessera.llm import queries, simhash

KIND = "doc_id long, text string, fp string, n long, component_id string"


def brute_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def brute_classes(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and find(i) != find(j):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        ids = [x for x in (least.get(find(k)), i) if x is not None]
        least[find(k)] = min(ids, default=None)
    return sorted(((i, "%016x" % p, least[find(k)]) for k, ((i, _), p) in enumerate(zip(rows, prints))), key=str)


def documents(r):
    vocabulary = [f"Word{k}" for k in range(400)] + ["É", "a b", "ß"]
    base = [[r.choice(vocabulary) for _ in range(r.choice((1, 3, 4, 60, 300)))] for _ in range(40)]
    rows = [(k, r.choice((" ", "\n", "\t ", "\x0b")).join(w)) for k, w in enumerate(base)]
    for k in range(80):
        w = list(base[20 + k % 4])
        w[r.randrange(len(w))] = "CHANGED"
        rows.append((1000 + k, " ".join(w)))
    return rows + [(None, rows[0][1]), (None, "only null here now"), (5000, None), (5001, ""), (5002, " \n"), rows[3], (6000, rows[3][1].upper())]


@pytest.mark.parametrize("sizes", [None, (4, 2, 1 << 20), (4, 2, 0)])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, sizes):
    """Lists compared in place, crowded ones in blocks, and by finer lists."""
    rows = documents(random.Random(9))
    if sizes:
        for name, value in zip(("CROWD", "BLOCK", "CELLS"), sizes):
            monkeypatch.setattr(simhash, name, value)
    spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], KIND).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_simhash"](spark, str(tmp_path)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_classes(rows)


@pytest.mark.parametrize("crowd", [2048, 8])
def test_chains_of_fingerprints_keep_together(spark, monkeypatch, crowd):
    """Fingerprints a few bits from one another, around one and in chains: components by brute force."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r, found = random.Random(4), {0, (1 << 64) - 1}
    for start in (r.getrandbits(64), 0x0F0F0F0F0F0F0F0F):
        at = start
        for _ in range(120):
            for b in r.sample(range(64), r.choice((1, 4, 4, 5))):
                at ^= 1 << b
            found.add(at)
            at = at if r.random() < 0.6 else start
    fps = np.array(sorted(found), dtype=np.uint64)
    root = np.arange(len(fps))
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    want = simhash.joined(root, i, j)
    nodes = spark.createDataFrame([(int(x), 1) for x in fps.view(np.int64)], "fp long, n long")
    place = {int(x): k for k, x in enumerate(fps.view(np.int64))}
    links = [(place[e["u"]], place[e["v"]]) for e in simhash.edges(nodes).collect()]
    assert all((int(fps[a]) ^ int(fps[b])).bit_count() <= 4 or want[a] == want[b] for a, b in links)
    got = simhash.joined(root, np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert (got == want).all()


def test_long_texts_are_read_in_parts(monkeypatch):
    r = random.Random(1)
    text = " ".join(r.choice(("a", "bb", "Ccc", "é" * 9)) for _ in range(3000)) + "  "
    whole = brute_print(text)
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert simhash.fingerprint(text) == whole
    assert simhash.fingerprint("x " + "y" * 40 + " z" + " " * 60) == brute_print("x " + "y" * 40 + " z")
    assert simhash.fingerprint(" " * 50) == 0


def test_first_places_hold_two_of_any_four():
    from itertools import combinations

    assert all(any(set(p) <= set(c) for p in simhash.FIRST) for c in combinations(range(8), 4))
    for p in simhash.FIRST:
        for c in combinations([x for x in range(8) if x not in p], 2):
            assert any(set(q) - set(p) <= set(c) for q in simhash.next_places(p))


def test_empty(spark):
    assert simhash.near_copies(spark.createDataFrame([], KIND)).count() == 0

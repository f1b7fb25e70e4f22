"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import queries, spelling

KIND = "doc_id long, text string, n string, key string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    found = {w: [x for x in words if near(w, x)] for w in words}
    best = {w: min(x, key=lambda v: (-words[v], v), default=None) for w, x in found.items()}
    form = {w: b if b and words[b] >= 10 * words[w] else None for w, b in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), n, len(found[w]), words.get(form[w], 0)) for w, n in words.items())


def documents(r):
    base = ["abababab", "aabbaabb", "Straßenbahn", "ÉLÉPHANTS", "x" * 9, "banananana", "committee", "aaaaaaa"]
    bag = []
    for w in base:
        bag += [w] * 300
        for _ in range(12):
            k = r.randrange(len(w))
            v = r.choice((w[:k] + w[k + 1 :], w[:k] + r.choice("abß") + w[k:], w[:k] + r.choice("abx") + w[k + 1 :]))
            bag += [v] * r.choice((1, 2, 3, 25, 30))
            v = v[:3] + r.choice("abc") + v[3:]
            bag += [v] * 2
    r.shuffle(bag)
    docs = [(k, r.choice((" ", "-", "9", "—")).join(bag[k * 40 : k * 40 + 40])) for k in range(len(bag) // 40 + 1)]
    return docs + [(None, "committee committee x"), (7, None), (8, ""), docs[0], (9, "Zé" * 100_000 + " " + "committee " * 50)]


def gathered(df):
    return sorted((x["word"], x["form"] or "", x["root"], x["n"], x["n_near"], x["form_n"] or 0) for x in df.collect())


def test_query_against_brute_force(spark, tmp_path, monkeypatch):
    docs = documents(random.Random(2))
    want = brute(docs)
    assert any(r[1] and r[1] != r[2] for r in want) and sum(r[4] for r in want) > 200
    spark.createDataFrame([(i, t, "n", "k") for i, t in docs], KIND).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    run = lambda: gathered(queries.QUERIES["op12_spelling_variants"](spark, str(tmp_path)))
    assert run() == want
    # Keys dealt over blocks, pieces of texts, counters passed on early.
    monkeypatch.setattr(spelling, "BLOCK", 3)
    assert run() == want


def test_no_words(spark):
    assert spelling.spelling_groups(spark.createDataFrame([], KIND)).count() == 0
    assert spelling.spelling_groups(spark.createDataFrame([(1, "short words", None, None), (2, None, None, None)], KIND)).count() == 0


def test_pieces_cut_no_run(monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 5)
    text = "abc defghij  é1ÀÀÀÀÀÀÀÀÀÀÀ2 z"
    assert "".join(spelling.chunks(text)) == text
    assert [w for p in spelling.chunks(text) for w in re.findall("[A-Za-zÀ-ÿ]+", p)] == re.findall("[A-Za-zÀ-ÿ]+", text)


@settings(max_examples=400, deadline=None)
@given(st.text("abé", min_size=7, max_size=12), st.integers(0, 20), st.sampled_from("abé"), st.integers(0, 2))
def test_the_filters_lose_no_near_word(word, place, letter, kind):
    k = place % len(word)
    other = (word[:k] + letter + word[k + 1 :], word[:k] + letter + word[k:], word[:k] + word[k + 1 :])[kind]
    assert spelling.one_edit_apart(word, other) == near(word, other)
    if len(other) >= 7 and other != word:
        asker, waiting = sorted((word, other), key=len, reverse=True)
        size = spelling.PAIR
        index = [{g: [0]} for g in spelling.grams(waiting, size)]
        assert spelling.merged(asker, spelling.grams(asker, size), index, [waiting], spelling.shared_at_least(len(asker), size)) == [0]

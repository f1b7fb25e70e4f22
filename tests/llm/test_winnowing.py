import hashlib

from tessera.llm import winnowing


def test_next_and_edits(spark):
    texts = {5: "one two three four five six seven eight nine ten eleven twelve thirteen", 9: None, 2: "short", 7: "one two three four five six seven eight nine ten eleven twelve thirteen", 30: " \n", 31: "é🙂" * 50}
    docs = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id long, text string, kept string").repartition(3)
    got = {r["doc_id"]: r for r in winnowing.fingerprints_with_edits(docs).collect()}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        own, following = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        third = len(own) // 3
        assert got[i]["edited"] == own[: len(own) - third] + following[:third]
    assert got[5]["kept"] == got[7]["kept"] and got[9]["kept"] == []


def test_kept_hashes_are_rightmost_minima_of_every_window(spark):
    text = "a b c d a b c d a b c d e f g h i j k l a b c d a b c d a b c d"
    row = winnowing.fingerprint(spark.createDataFrame([(text,)], "text string"), "text", "kept").select("kept", winnowing.positions("kept").alias("at"))
    kept = row.first()
    grams = spark.sql(f"SELECT transform(sequence(0, size(t) - {winnowing.K}), i -> i) AS i, t FROM (SELECT split('{text}', ' ') AS t)").first()
    hashed = {}
    for e, p in zip(kept["kept"], kept["at"]):
        hashed[p] = e >> winnowing.PLACE
    same = lambda a, b: grams["t"][a : a + winnowing.K] == grams["t"][b : b + winnowing.K]
    for start in range(len(grams["i"]) - winnowing.W + 1):
        inside = [p for p in kept["at"] if start <= p < start + winnowing.W]
        least = min(inside, key=lambda p: (hashed[p], -p))
        assert inside and not any(same(least, p) for p in range(least + 1, start + winnowing.W))


def test_empty_table(spark):
    assert winnowing.fingerprints_with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_an_insertion_moves_no_token_of_unspaced_text(spark):
    import random

    r = random.Random(2)
    han = "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(600))
    code = "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(900))
    rows = [(1, han), (2, "一" + han), (3, code), (4, "q" + code)]
    docs = winnowing.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "kept")
    sets = {x["doc_id"]: set(x["h"]) for x in docs.select("doc_id", winnowing.hashes("kept").alias("h")).collect()}
    for a, b in ((1, 2), (3, 4)):
        assert len(sets[a]) > 10 and len(sets[a] & sets[b]) >= 0.9 * len(sets[a] | sets[b])


def test_null_ids_come_last_whatever_the_ranges(spark):
    rows = [(1, "one " * 9), (2, "two " * 9), (3, "three " * 9), (None, "none " * 9), (None, "also " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = [3, 2, 1, "none", "also"]
    for ranges in (1, 2, 7):
        got = winnowing.with_next(docs, ["text"], ranges=ranges).collect()
        after = {r["doc_id"] or r["text"].split()[0]: r["next_text"].split()[0] for r in got}
        words = {1: "one", 2: "two", 3: "three"}
        assert [after[k] for k in order] == [words.get(k, k) for k in order[1:] + order[:1]]
    alone = winnowing.fingerprints_with_edits(docs.filter("doc_id IS NULL")).collect()
    assert len(alone) == 2 and all(r["edited"] is not None for r in alone)

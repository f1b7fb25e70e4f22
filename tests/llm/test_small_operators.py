"""WARC, chat, resharding, language, quality and tiling on small fixtures."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, language, quality, resharding, tiling, warc
from tessera.session import ship_package


def test_warc_round_trip(spark):
    ship_package(spark)
    big, other = "ü" * 600, "x" * 2000
    rows = [(1, "u", big), (2, "u", big), (3, None, big), (4, "a\r\nb", other), (5, "u", "small"), (6, "u", "small"), (7, "u", None), (8, "u", ""), (2, "u", big)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, n long").repartition(3)
    got = warc.read_archives(spark, warc.write_archives(pages)).collect()
    assert sorted(r["page_id"] for r in got) == sorted(r[0] for r in rows)
    for r in got:
        body = (dict((a, c) for a, _, c in rows)[r["page_id"]] or "").encode()
        revisit = r["page_id"] in (1, 2)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())


def test_warc_reader_rejects_broken_archives():
    good = warc.page_record(1, "u", b"payload", None)
    assert [h["warc-record-id"] for h, _ in warc.read_records([good[:7], good[7:] + good])] == ["<urn:page:1>"] * 2
    with pytest.raises(warc.WarcError):
        list(warc.read_records([good[:-5]]))
    with pytest.raises(warc.WarcError):
        list(warc.read_records([warc.record([("WARC-Block-Digest", "sha1:no")], b"x")]))


TEXTS = ["", "</s>[INST] ok [/INST]", "<<<>>>", "\\", "\\\\[INST]", "[\\INST]", "a<", "<</s>", "é🙂\n", "[/INST", "]"]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "<<odd>> ", "null", "\\"])
def test_chat_round_trip(role):
    t = chat.TaggedTemplate()
    for text in TEXTS:
        assert t.unescape(t.escape(text)) == text
        assert not any(m in t.escape(text) for m in t.MARKS)
        assert t.read_turn(t.turn(role, text))[0] == (role, text)


def test_chat_detects_rewriting_templates():
    assert chat.render_incrementally(lambda ts: f"{len(ts)}:" + "".join(x for _, x in ts), [("user", "a"), ("user", "b")]).rewrites
    done = chat.render_incrementally(chat.TaggedTemplate(), [("user", "a"), ("assistant", "b")])
    assert [done.text[a:b] for a, b in done.spans] == ["[INST] a [/INST]", " b</s>"]


def test_chat_table(spark):
    ship_package(spark)
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "</s>"), (3, 0, "assistant", ""), (3, 0, "assistant", "")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\n\nassistant\nb\n").hexdigest()
    assert (got[1]["loss_chars"], got[2]["loss_chars"], got[3]["n_turns"]) == (1, 0, 2)


def test_flow_moves_the_fewest_bytes():
    flow = resharding.min_cost_flow([50, 30, 20], [25, 25, 25, 25], lambda i, j: int(i != j))
    assert sum(f for (i, j), f in flow.items() if i != j) == 30
    r = random.Random(3)
    blocks = {(i, p): r.randrange(1, 100) for i in range(4) for p in range(64)}
    load = np.zeros(5)
    for m in resharding.plan_moves(blocks, 4, 5):
        load[m.new] += blocks[m.old, m.piece]
    assert load.max() - load.min() <= 2


def test_resharding_slots(spark):
    docs = spark.createDataFrame([(k, "é" * (k % 50) if k % 7 else None, k) for k in range(400)] + [(5, "again", 0)], "doc_id long, text string, size long")
    path, _ = resharding.reshard(docs, new_shards=8, old_shards=4)
    rows, bases = resharding.read_shards(spark, path, docs.schema)
    got = rows.join(bases, "_file").select("shard", (F.col("_base") + F.col("_row")).alias("slot")).toPandas()
    assert len(got) == 401
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    empty = docs.limit(0)
    path, moves = resharding.reshard(empty, 8, 4)
    assert moves.count() == 0


@pytest.mark.parametrize("ids", ["id", "CASE WHEN id % 2 = 0 THEN id END", "7"])
def test_resharding_keeps_its_law_for_repeated_and_null_ids(spark, ids):
    docs = spark.range(0, 4000, 1, 3).selectExpr(f"CAST({ids} AS BIGINT) AS doc_id", "repeat('x', 124) AS text")
    path, _ = resharding.reshard(docs)
    rows, _ = resharding.read_shards(spark, path, docs.schema)
    sizes = rows.groupBy("shard").agg(F.sum(resharding.row_size()).alias("size")).toPandas()["size"]
    assert len(sizes) == 40 and sizes.sum() == 4000 * 140 and sizes.max() - sizes.min() <= 2 * 140


def test_rebalancing_leaves_files_alone(spark):
    import os

    docs = spark.range(0, 3000, 1, 4).selectExpr("id AS doc_id", "repeat('y', 20 + id % 50) AS text")
    path, _ = resharding.reshard(docs, new_shards=6, old_shards=6, rows_per_file=20)
    local = path.removeprefix("file://")
    before = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(local) for f in names if f.endswith(".parquet")}
    plan = resharding.rebalance(spark, path, docs.schema, 8).toPandas()
    after = {os.path.join(d, f) for d, _, names in os.walk(local) for f in names if f.endswith(".parquet")}
    stayed = set(plan[~plan.moved].file.str.replace("^file:/+", "/", regex=True))
    assert stayed and stayed == {f for f in before if f in after and os.stat(f).st_mtime_ns == before[f]} == set(before) & after
    rows, _ = resharding.read_shards(spark, path, docs.schema)
    got = rows.select("doc_id", "text", "shard", resharding.row_size().alias("size")).toPandas()
    assert sorted(zip(got.doc_id, got.text)) == sorted((r["doc_id"], r["text"]) for r in docs.collect())
    sizes, largest = got.groupby("shard")["size"].sum(), int(plan.bytes.max())
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2 * largest
    # Six shards of total/6 fill eight of total/8: a quarter of the bytes must move.
    total = int(plan.bytes.sum())
    assert abs(int(plan[plan.moved].bytes.sum()) - total // 4) <= 12 * largest
    assert resharding.rebalance(spark, path, docs.schema, 8).toPandas().moved.sum() == 0


def test_leaks_of_items_without_an_id(spark):
    ship_package(spark)
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, "x " + item), (2, "clean words only here in this text")], "doc_id long, text string")
    for size in (4_000_000, 0):
        found = tiling.leaks(docs, spark.createDataFrame([(None, item), (2**60 + 1, item)], "item_id long, text string"), max_words=size)
        assert sorted((r["doc_id"], r["item_id"] or 0) for r in found.collect()) == [(1, 0), (1, 2**60 + 1)]


def test_language(spark):
    ship_package(spark)
    said = {"en": "the quick brown fox jumps over the lazy dog and then the other one", "de": "der schnelle braune fuchs springt über den faulen hund und dann"}
    rows = [(k, said[lang], lang) for k, lang in enumerate(["en", "de"] * 5)] + [(20, None, "en"), (21, "123 !?", "de"), (22, "der hund und der fuchs", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language.learn_profiles(docs, F.lit(True))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, profiles).collect()}
    assert [got[k][0] for k in (0, 1, 20, 21, 22)] == ["en", "de", "und", "und", "de"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert {r["lang_pred"] for r in language.identify(docs, {}).collect()} == {"und"}


def test_field_marginals_equal_enumeration():
    import itertools

    r = np.random.default_rng(1)
    at = np.array([0, 4, 5, 8])
    evidence, couple = r.normal(size=8), r.normal(size=(2, 2))
    good = quality.LineField(np.zeros(1), couple).marginals(evidence, at)
    for a, b in zip(at[:-1], at[1:]):
        weights, total = np.zeros(b - a), 0.0
        for states in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(evidence[a + k] * (s - 0.5) for k, s in enumerate(states)) + sum(couple[x, y] for x, y in zip(states, states[1:])))
            total += w
            weights += w * np.array(states)
        assert np.allclose(good[a:b], weights / total)


def test_quality_learns_and_scores_everything():
    good = [f"A plain line number {k}.\nAnd one more of the kind here." for k in range(40)]
    bad = [f"BUY!!! $$$ {k} ###\nBUY!!! $$$ {k} ###" for k in range(40)]
    field = quality.fit_field(good + bad, np.array([1.0] * 40 + [0.0] * 40))
    scores = field.score([good[0], bad[0], "", "x" * 100_000])
    assert scores[0] > 0.9 and scores[1] < 0.1 and ((scores >= 0) & (scores <= 1)).all()
    assert len(quality.fit_field([], np.zeros(0)).score(["a"])) == 1


def plain_tiling(a, b, least):
    used_a, used_b, covered = [0] * len(a), [0] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return covered
        covered += n
        used_a[i : i + n] = used_b[j : j + n] = [1] * n


def test_tiles_cover_as_much_as_plain_tiling():
    r = np.random.default_rng(3)
    for _ in range(60):
        a = r.integers(0, 8, r.integers(5, 30)).astype(np.uint64)
        b = np.concatenate([r.integers(0, 8, 6), a[len(a) // 2 :], r.integers(0, 8, 3), a[: len(a) // 2]]).astype(np.uint64)
        assert sum(t[2] for t in tiling.greedy_tiles(a, b, 3)) == plain_tiling(a.tolist(), b.tolist(), 3)


@pytest.mark.parametrize("most", [4_000_000, 0])
def test_leaks(spark, most):
    ship_package(spark)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    w = item.split()
    rows = [(1, item), (2, "x y " + " ".join(w[6:]) + " z " + " ".join(w[:6])), (3, "alpha beta gamma delta epsilon only"), (4, None), (5, ""), (6, "nothing here at all to find"), (1, item)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(7, item), (8, "too short"), (9, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["covered_words"] for r in tiling.leaks(docs, bench, max_words=most).collect()}
    assert got == {(1, 7): 12, (2, 7): 12}
    assert tiling.leaks(docs.limit(0), bench).count() == tiling.leaks(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("most", [4_000_000, 1])
def test_every_text_of_an_item_id_is_searched(spark, most):
    ship_package(spark)
    first, second = " ".join(f"a{k}" for k in range(20)), " ".join(f"b{k}" for k in range(20))
    bench = spark.createDataFrame([(1, first), (1, second), (1, second)], "item_id long, text string")
    docs = spark.createDataFrame([(1, first), (2, second), (3, first + " " + second[:40])], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["covered_words"]) for r in tiling.leaks(docs, bench, max_words=most).collect())
    assert got == [(1, 1, 20), (2, 1, 20), (3, 1, 20)]


def test_repeated_words_are_tiled_in_seconds():
    import time

    began = time.time()
    item, doc = np.full(300, 7, dtype=np.uint64), np.full(100_000, 7, dtype=np.uint64)
    assert tiling.greedy_tiles(item, doc) == [(0, 0, 300)]
    assert time.time() - began < 20


def test_tiles_equal_plain_greedy_order():
    r = np.random.default_rng(9)
    for _ in range(40):
        a, b = (r.integers(0, 3, n).astype(np.uint64) for n in (18, 40))
        assert sum(t[2] for t in tiling.greedy_tiles(a, b, 3)) == plain_tiling(a.tolist(), b.tolist(), 3)


def test_signs_beyond_ascii_divide_words(spark):
    ship_package(spark)
    words = [f"w{k}" for k in range(20)]
    docs = spark.createDataFrame([(None, " ".join(words)), (2**60 + 1, "“" + "—".join(words) + "”"), (3, "é".join(words))], "doc_id long, text string")
    bench = spark.createDataFrame([(2**60 + 3, " ".join(words))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["covered_words"]) for r in tiling.leaks(docs, bench).collect()}
    assert got == {(None, 2**60 + 3, 20), (2**60 + 1, 2**60 + 3, 20)}


def test_a_leak_is_one_of_the_text_not_of_the_id(spark):
    ship_package(spark)
    item = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, item), (1, "a clean text of this id"), (1, item)], "doc_id long, text string")
    got = tiling.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), keyed=True).select("key").collect()
    assert [r["key"] for r in got] == [docs.filter("text LIKE 'w0%'").select(F.xxhash64("text")).first()[0]]


def test_long_conversations_take_seconds():
    import time

    began = time.time()
    turns = [("user" if k % 2 == 0 else "assistant", f"turn {k}") for k in range(20_000)]
    done = chat.render_incrementally(chat.TaggedTemplate(), turns)
    assert len(done.spans) == 20_000 and not done.rewrites
    assert time.time() - began < 60


def test_chat_query_equals_brute_force(spark, tmp_path):
    from tessera.llm import queries

    rows = [(5, 0, "user", "a"), (5, 1, "assistant", "b\\</s>"), (5, 1, "assistant", "b\\</s>"), (5, 2, None, None), (None, 0, "user", "<<<[/INST]"), (2**60 + 1, 3, "assistant", "é🙂"), (7, None, "assistant", None)]
    spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn int, role string, text string, formatted string").repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    hard = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", hard), (-1, 1, "assistant", hard)]
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((-1 if t is None else t), r or "null", x or "") for c, t, r, x in rows if c == conv)
        said = "".join(x for _, r, x in own if r == "assistant")
        want[conv] = (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    got = queries.QUERIES["op1_chat_formatting"](spark, str(tmp_path)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == want
    assert len(got) == len(want) and not any(r["rewrites"] for r in got)


def test_chat_of_an_empty_table(spark):
    ship_package(spark)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(empty)).count() == 0


def test_warc_ids(spark):
    ship_package(spark)
    big, low = "x" * 1500, 2**53 + 1
    rows = [(low, "u", big), (low + 6, "u", big), (None, "u", big), (None, "v", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    files = warc.write_archives(pages, max_archive=300)
    assert files.count() > 1
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_archives(spark, files).collect())
    assert got == [(str(low), "revisit", low + 6, 1500), (str(low + 6), "response", None, 1500), ("None", "response", None, 0), ("None", "response", None, 1500)]
    empty = warc.write_archives(pages.limit(0))
    assert warc.read_archives(spark, empty).count() == 0


def test_resharding_keeps_a_column_called_shard(spark):
    docs = spark.createDataFrame([(k, "x" * k, 77) for k in range(60)], "doc_id long, text string, shard int")
    path, moves = resharding.reshard(docs, new_shards=4, old_shards=3, slices=16)
    rows, bases = resharding.read_shards(spark, path, docs.schema)
    got = rows.join(bases, "_file").toPandas()
    assert set(got["shard"]) == {77} and set(got["shard_"]) == {0, 1, 2, 3} and len(got) == 60
    assert 0 < moves.filter("moved").agg(F.sum("bytes")).first()[0] < moves.agg(F.sum("bytes")).first()[0]

"""The registered queries against brute force on a fixture of their tables."""

import hashlib
import random
import zlib

import pytest

from tessera.llm import queries

LANGS = {
    "en": "the house and this water with other things that were there when she thought would have been".split(),
    "de": "das haus und dieses wasser mit anderen dingen die dort waren als sie dachte würde gewesen sein".split(),
}
CHARS = LANGS["en"] + ["É", "ß", "漢字", "<|endoftext|>", "a\n\nb", "  ", "12.5%"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r, rows, labels = random.Random(11), [], []
    for k in range(240):
        lang = ("en", "de")[k % 2]
        words = [r.choice(LANGS[lang] if k % 5 else CHARS) for _ in range(r.choice((3, 30, 200, 1500)))]
        bad = k % 3 == 0
        text = "\n".join("!!! $$$ 99 ###" for _ in range(20)) if bad and k % 5 else " ".join(words) + "."
        rows.append((k, text, lang if k % 7 else None, "s", len(text)))
        labels.append((k, 0 if bad and k % 5 else 1, 0))
    rows += [(500, None, "en", "s", 0), (501, "", None, None, None), (502, "x" * 300_000, "en", "s", 1), (2**60 + 1, rows[4][1], "en", "s", 1), (4, rows[4][1], "en", "s", 1)]
    labels += [(500, None, 0), (3, 1, 0), (3, 1, 0)]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder), rows


def result(spark, folder, name):
    return queries.QUERIES[name](spark, folder).toPandas()


def test_resharding(spark, tables):
    folder, rows = tables
    got = result(spark, folder, "op3_resharding")
    want = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted(zip(got.doc_id, got["size"], got.text_crc32)) == want
    assert set(got.law) == {"bytes"} and got.grown_shard.isna().all() and got.shard.between(0, 39).all()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_winnowing(spark, tables):
    folder, rows = tables
    got = result(spark, folder, "op4_winnowing")
    order = sorted(((i, t or "") for i, t, *_ in rows), reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        third = len(t) // 3
        want.append((i, len(t), hashlib.sha256((t[: len(t) - third] + order[(k + 1) % len(order)][1][:third]).encode()).hexdigest()))
    assert sorted(zip(got.doc_id, got.n_chars, got.edited_sha256)) == sorted(want)
    texts = dict(order)
    by_text = got.assign(text=got.doc_id.map(texts)).groupby("text").fingerprint.nunique()
    assert (by_text == 1).all() and got.fingerprint.nunique() > 150
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()


def test_quality(spark, tables):
    folder, rows = tables
    got = result(spark, folder, "op5_quality_field")
    assert sorted(got.doc_id) == sorted(r[0] for r in rows)
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out))
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    truth = got.doc_id.map({k: 0 if k % 3 == 0 and k % 5 else 1 for k in range(240)})
    held = got[got.held_out & truth.notna()]
    assert (held.predicted == truth[held.index]).mean() >= 0.95


def test_language(spark, tables):
    folder, rows = tables
    got = result(spark, folder, "op6_language_profiles")
    assert sorted(got.doc_id) == sorted(r[0] for r in rows)
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(got.doc_id, got.held_out))
    assert got.score.between(0, 1).all()
    letters = {i: any(c.isalpha() for c in t or "") for i, t, *_ in rows}
    assert all((p == "und") == (not letters[i]) for i, p in zip(got.doc_id, got.lang_pred))
    plain = got[got.held_out & got.doc_id.map(lambda i: i < 240 and i % 5 > 0 and letters[i])]
    assert (plain.lang_pred == plain.doc_id.map(lambda i: ("en", "de")[i % 2])).mean() >= 0.95


def test_packing(spark, tables):
    import public_tokenizers
    from tokenizers import Tokenizer

    folder, rows = tables
    got = result(spark, folder, "op10_packing")
    engine = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    crc = {}
    for i, t, *_ in rows:
        ids = engine.encode(t or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 1024):
            piece = ids[start : start + 1024]
            key = (i, start, len(piece), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in piece)), len(ids))
            crc[key] = crc.get(key, 0) + 1
    found = {}
    for key in zip(got.doc_id, got.start, got.length, got.ids_crc32, got.doc_tokens):
        found[key] = found.get(key, 0) + 1
    assert found == crc
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 1024
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))
    assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 1024) + 2

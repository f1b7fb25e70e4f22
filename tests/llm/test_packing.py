import functools
import zlib

import numpy as np
import pytest

from tessera.llm import packing
from tessera.session import ship_package

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, "a", "Hello  world\n\n  x \t y", "<|endoftext|> inside", "word " * 3000, "é ü z \x85 q", " lead", "trail ", "\n", "one two three " * 341, "🙂 🙂🙂 'll don't 123 45 a1b2"]


@functools.cache
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def reference(text):
    return whole().encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_tokenizers():
    tok = packing.tokenizer(PATH)
    for text in TEXTS:
        assert np.frombuffer(tok.ids(text or ""), dtype="<u4").tolist() == reference(text)


def test_very_long_runs_of_blanks_are_encoded_as_by_tokenizers():
    tok = packing.tokenizer(PATH)
    for blank in (" ", "\n", "\u00a0"):
        text = "a" + blank * 2_000_000 + "b"
        assert np.frombuffer(tok.ids(text), dtype="<u4").tolist() == reference(text)


def test_ids_of_documents_and_hostile_texts_are_those_of_tokenizers():
    import random

    import pyarrow.parquet as pq

    tok, r = packing.tokenizer(PATH), random.Random(3)
    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist() if t]
    alphabet = list("ab 1'\t\n\r.,\u00a0\u0085\u200b\u3000\u00e9\u4e2d\U0001f642\u0301") + ["'ll", "  ", "<|endoftext|>", " \n "]
    texts += ["".join(r.choices(alphabet, k=r.randint(1, 60))) for _ in range(600)] + [" " * 20_000, "\n" * 20_000, "ab" * 20_000]
    for text in texts:
        assert np.frombuffer(tok.ids(text), dtype="<u4").tolist() == reference(text)


def test_pieces_cover_every_id_once_and_leave_no_gap(spark):
    ship_package(spark)
    rows = [(k, TEXTS[k % len(TEXTS)], "x") for k in range(60)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, slot string").repartition(3), PATH, 256).toPandas()
    for k, text, _ in rows:
        ids, at = reference(text) + [0], 0
        for p in got[got.doc_id == k].sort_values("start").itertuples():
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], dtype="<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 256
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))


def test_patterns_leave_little_room():
    r = np.random.default_rng(0)
    lengths, demand = np.unique(r.integers(1, 257, 20_000), return_counts=True)
    plan = packing.layout(lengths, demand, 256)
    sequences = int((plan["first"] + (plan["hi"] - plan["lo"]) // plan["each"]).max())
    assert (lengths * demand).sum() / (256 * sequences) > 0.99
    assert plan.groupby("length").apply(lambda g: (g.hi - g.lo).sum(), include_groups=False).tolist() == demand.tolist()


def test_empty_table(spark):
    ship_package(spark)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0

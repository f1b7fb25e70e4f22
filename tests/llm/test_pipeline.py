import random

import pyarrow.parquet as pq

import corpus_pipeline


def documents(seed=4):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randrange(1, 4))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    rows = [[k, text(120), "en", "s", 0] for k in range(30)]
    rows += [[100 + k, rows[k][1], "en", "s", 0] for k in range(3)]
    words = rows[5][1].split()
    rows.append([110, " ".join(words[:60] + ["zzz"] + words[61:]), "en", "s", 0])
    passage, item = text(60), text(30)
    rows += [[120 + k, text(50) + " " + passage + " " + text(50), "en", "s", 0] for k in range(3)]
    rows.append([130, text(40) + " " + item + " " + text(40), "en", "s", 0])
    rows.append([135, text(80), None, "s", 0])
    rows += [[140, None, "en", "s", 0], [141, "12 34 !!", "en", "s", 0], [142, "", None, None, None]]
    return rows, passage, item


def test_stages_keep_what_they_should(spark, tmp_path):
    rows, passage, item = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = pq.read_table(str(tmp_path / name)).to_pandas()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda n: set(seen[n].doc_id)
    everything = {r[0] for r in rows}
    assert ids("language_id") == everything - {140, 141, 142}
    assert set(seen["language_id"].lang) == {"en"}  # null became the prediction
    assert ids("near_duplicates") == ids("language_id") - {100, 101, 102, 110}
    assert ids("repeated_passages") == ids("near_duplicates")
    cut = seen["repeated_passages"].set_index("doc_id")
    assert passage in cut.text[120] and not any(passage in cut.text[k] for k in (121, 122))
    before = {r[0]: r[1] for r in rows}
    assert all(cut.text[k] == before[k] for k in range(30))
    assert (cut.n_chars == cut.text.str.len()).all()
    assert ids("decontamination") == ids("repeated_passages") - {130}
    assert set(seen["packing"].doc_id) == ids("decontamination")
    packed = seen["packing"].groupby("doc_id").length.sum()
    assert (packed == seen["packing"].groupby("doc_id").doc_tokens.first()).all()

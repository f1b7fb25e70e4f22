"""The registered queries of operators 2, 8 and 9 against brute force on written tables."""

import importlib.util
import os
import random

from tessera.llm import queries


def sibling(name):
    spec = importlib.util.spec_from_file_location(name, os.path.join(os.path.dirname(__file__), f"{name}.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def written(spark, folder, rows):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_suffix_dedup(spark, tmp_path):
    module = sibling("test_suffixes")
    rows = module.sample()
    got = queries.QUERIES["op8_suffix_dedup"](spark, written(spark, tmp_path, rows)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == module.brute(rows) and len(got) == len(rows)


def test_chosen_path_join(spark, tmp_path):
    module = sibling("test_chosenpath")
    rows = module.sample()
    got = queries.QUERIES["op9_chosen_path_join"](spark, written(spark, tmp_path, rows)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in got} == module.brute(rows) and len(got) == len(rows)


def test_decontamination(spark, tmp_path):
    """Documents hold all of an item, its halves the other way round, four fifths, or less than the threshold."""
    r = random.Random(4)
    items = [(k, [f"w{r.randrange(10**6)}" for _ in range(40)]) for k in range(6)]
    noise = lambda n: [f"n{r.randrange(10**6)}" for _ in range(n)]
    rows, leaked = [], set()
    for k, w in items:
        kinds = {"whole": w, "turned": w[20:] + noise(3) + w[:20], "short": w[:12]}
        for n, (kind, words) in enumerate(kinds.items()):
            rows.append((10 * k + n, " ".join(noise(30) + words + noise(30))))
            if kind != "short":
                leaked.add((10 * k + n, k, 40))
    rows += [(100, None), (101, ""), (102, " ".join(noise(5000)))]
    folder = written(spark, tmp_path, rows)
    spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(90, None), (91, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = queries.QUERIES["op2_decontamination"](spark, folder).collect()
    assert {(x["doc_id"], x["item_id"], x["covered_words"]) for x in got} == leaked and len(got) == len(leaked)

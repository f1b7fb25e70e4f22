"""Null ids and empty tables of the learned operators and the pipeline."""

import corpus_pipeline
from tessera.llm import queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
BENCH = "item_id long, text string"


def write(spark, folder, docs, labels, bench=()):
    for name, rows, kind in (("documents", docs, DOCS), ("labels", labels, LABELS), ("benchmark", bench, BENCH)):
        spark.createDataFrame(list(rows), kind).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_null_ids_have_a_fold(spark, tmp_path):
    docs = [(k, ("the house and the water " if k % 2 else "das haus und das wasser ") * 3, ("en", "de")[k % 2 == 0], "s", 0) for k in range(40)]
    folder = write(spark, tmp_path, [*docs, (None, "the house and water", "en", "s", 0)], [(k, k % 2, 0) for k in range(40)])
    for name, fold in (("op5_quality_field", True), ("op6_language_profiles", False)):
        rows = queries.QUERIES[name](spark, folder).collect()
        assert len(rows) == 41 and [r["held_out"] for r in rows if r["doc_id"] is None] == [fold]


def test_empty_tables(spark, tmp_path):
    folder = write(spark, tmp_path, [], [])
    for name in ("op5_quality_field", "op6_language_profiles", "op12_spelling_variants", "op13_simhash"):
        assert queries.QUERIES[name](spark, folder).count() == 0
    assert corpus_pipeline.run(spark, folder).count() == 0

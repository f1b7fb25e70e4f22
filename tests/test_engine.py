"""Reconciliation, corrections, repair, sources and sinks end to end."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from tessera.functions import jsontext as J
from tessera.operators import cleaning, corrections, metrics, reconcile, tables, timeseries
from tessera.sources import files, sinks

WIDE = "Year int, WeekNumber int, Country string, Event string, TotalCases double, CasesConfirmed double, Deaths double, CFR double, Grade string"


def sides(spark):
    a = [(2025, 1, "Kenya", "Cholera", 100, 10, 2, 2.0, "Grade 3"), (2025, 1, None, "Mpox", 5, 5, 0, 0.0, None), (2025, 2, "Chad", "Mpox", 7, 0, 0, 0.0, "Grade 1"), (2025, 3, "Mali", "Mpox", 7, 0, 0, 0.0, None)]
    b = [(2025, 1, "Kenya", "Cholera", 100, 11, 2, 2.009, "Grade 3"), (2025, 1, None, "Mpox", 5, 5, 0, 0.0, None), (2025, 2, "Togo", "Mpox", 7, 0, 0, 0.0, "Grade 1")]
    cast = lambda rows: [tuple(float(v) if 4 <= i < 8 else v for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(cast(a), WIDE), spark.createDataFrame(cast(b), WIDE)


def test_report(spark):
    out = reconcile.report(*sides(spark))
    assert out["discrepancies"].select("Country").collect()[0][0] == "Kenya" and out["discrepancies"].count() == 1
    assert [r["Country"] for r in out["llm_only"].collect()] == ["Chad"]
    assert [r["Country"] for r in out["rule_based_only"].collect()] == ["Togo"]
    week = {r["WeekNumber"]: r for r in out["summary"].collect()}
    assert set(week) == {1, 2} and week[1]["ValueDiscrepancies"] == 1 and week[2]["LLMOnly"] == 1
    assert {r["Category"] for r in out["discrepancies_long"].filter("Parameter = 'Grade'").collect()} == {"Both Zero"}


def test_published_comparison_numbers(spark):
    pairs = spark.createDataFrame([(150.0, 145.0, 5.0, 5.0, "Haiti", "Haiti"), (200.0, 190.0, 8.0, 8.0, "Somalia", "Somalia")], "a double, b double, c double, d double, x string, y string")
    got = {r["column"]: r for r in metrics.numeric_agreement(pairs, {"suspected": ("a", "b"), "deaths": ("c", "d")}).collect()}
    assert got["suspected"]["mae"] == 7.5 and abs(got["suspected"]["rmse"] - 62.5**0.5) < 1e-12 and got["deaths"]["mae"] == 0
    assert metrics.categorical_agreement(pairs, {"country": ("x", "y")}).first()["exact_match_pct"] == 100
    near = spark.createDataFrame([(100.0, 95.0), (200.0, 210.0), (300.0, 290.0)], "a double, b double")
    assert metrics.numeric_agreement(near, {"v": ("a", "b")}).first()["within_tolerance_pct"] == 100
    same = spark.createDataFrame([("A", "A"), ("B", "B"), ("C", "X"), ("D", "D")], "a string, b string")
    assert metrics.categorical_agreement(same, {"v": ("a", "b")}).first()["exact_match_pct"] == 75
    flat = spark.createDataFrame([(1.0, 1.0)], "a double, b double")
    assert metrics.numeric_agreement(flat, {"v": ("a", "b")}).first()["correlation"] is None


def test_clean_pipeline(spark):
    rows = [("Central AfricanRepublic", "Humanitarian crisis", "nan", "1,000", "1,000", "-", "3.3%"), (None, None, "Grade 3", None, "x", "5", None)]
    out = cleaning.clean(spark.createDataFrame(rows, "Country string, Event string, Grade string, `Total cases` string, `Cases Confirmed` string, Deaths string, CFR string"), "model").collect()
    assert out[0].asDict() == {"Country": "Central African Republic", "Event": "Complex Humanitarian crisis", "Grade": None, "TotalCases": 1000.0, "CasesConfirmed": 0.0, "Deaths": 33.0, "CFR": 3.3}
    assert out[1]["TotalCases"] == 0.0 and out[1]["Grade"] == "Grade 3"


def test_typed_records(spark):
    df = spark.createDataFrame([("2024-01-15", "Haiti", "150", "3.3%")], "reporting_date string, country string, suspected_cases string, case_fatality_rate string")
    out = cleaning.typed(df)
    assert out.columns == [f.name for f in cleaning.RECORD.fields] and out.first()["suspected_cases"] == 150 and out.first()["case_fatality_rate"] == 3.3
    assert cleaning.typed(df.limit(0)).count() == 0


def test_year_change_is_a_gap(spark):
    df = spark.createDataFrame([("a", "b", 2025, 52, 1), ("a", "b", 2026, 1, 3)], "Country string, Event string, Year int, WeekNumber int, v int")
    assert [(r["is_gap"], r["v"]) for r in timeseries.with_gap_rows(df).orderBy("Year", F.desc("is_gap")).collect()] == [(False, 1), (True, None), (False, 3)]
    assert [r["CaseChange"] for r in timeseries.case_change(df, "v").orderBy("Year").collect()] == [None, 2]


def test_corrections(spark):
    df = spark.createDataFrame([(0, "Kenya", "Cholera", "1,0 00"), (1, "Chad", "Mpox", "5")], "i int, Country string, Event string, Deaths string")
    fixes = spark.createDataFrame([("Kenya", "Cholera", "Deaths", "1000", "7", 0.9, 1), ("Kenya", "Cholera", "Deaths", "1000", "8", 0.7, 2), ("Chad", "Mpox", "Deaths", "5", "9", 0.5, 3)], "country string, event string, field string, old_value string, new_value string, confidence double, seq int")
    assert [r["Deaths"] for r in corrections.apply_by_key(df, fixes, ["Deaths"]).orderBy("i").collect()] == ["8", "5"]
    found = corrections.unique_text_matches(df, fixes.withColumn("country", F.expr("lower(substring(country, 1, 4))")), "i")
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, "Deaths", "7"), (2, 0, "Deaths", "8"), (3, 1, "Deaths", "9")]


@pytest.mark.parametrize("text, method, n", [
    ('```json\n[{"a":1}]\n```', "markdown_cleanup", 1), ('[{"a":1},{"a":2}', "truncated_array_fix", 2), ('[{"a":1},{"a', "truncated_object_fix", 1), ('x {"a":{"b":1}} y {"c":2} [', "complete_objects_extraction", 2),
    ('"Country": "Kenya", "Deaths": 5, "Country": "Chad", ', "aggressive_repair", 2), ("nothing", "no_recovery_possible", 0), (None, "no_recovery_possible", 0), ("[" * 5000, "truncated_array_fix", 1),
])
def test_recovery(text, method, n):
    got = J.recover(text)
    assert (got[0], len(got[1])) == (method, n)


@pytest.mark.parametrize("text, expected", [('[{"a":1},{"a":2}]', [1, 2]), ('```\n[{"a":1}]\n```', [1]), ('{"records":[{"a":3}]}', [3]), ('{"data":[{"a":4}]}', [4]), ('[{"a":1},{"a":2},{"a', [1, 2]), ("none", None)])
def test_native_records(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(J.records(F.col("t"), "struct<a: int>").alias("r")).first()["r"]
    assert (got and [r["a"] for r in got]) == expected


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Week_21__19_-_25_May_2025.csv").write_text('﻿Country,"Total cases"\nKenya,"1,234"\nChad,\n', encoding="utf-8")
    got = {r["Country"]: r for r in files.csv_folder(spark, str(tmp_path / "in")).collect()}
    assert (got["Kenya"]["Total cases"], got["Kenya"]["WeekNumber"], got["Kenya"]["Year"], got["Chad"]["Total cases"]) == ("1,234", 21, 2025, None)
    (tmp_path / "log.jsonl").write_text('{"id": 1, "s": "a"}\nbroken\n{"id": 2, "s": "b"}\n')
    assert sorted(r["id"] for r in files.json_lines(spark, str(tmp_path / "log.jsonl"), "id int, s string").collect()) == [1, 2]
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf" / "a.pdf").write_bytes(b"%PDF" + b"x" * 20_000)
    (tmp_path / "pdf" / "b.pdf").write_bytes(b"%PDF")
    assert sorted(r["valid"] for r in files.valid_pdfs(spark, str(tmp_path / "pdf")).collect()) == [False, True]
    store = tmp_path / "store"
    store.mkdir()
    for name in ("OEW42-2025_gpt-5_3.csv", "OEW42-2025_gpt-5_10.csv", "OEW41-2025_gpt-5_x.csv"):
        (store / name).write_text(f"Country\n{name}\n")
    catalog = files.extraction_catalog(files.listing(spark, str(store)))
    assert [r["Country"] for r in files.load_extractions(spark, catalog, weeks=[42]).collect()] == ["OEW42-2025_gpt-5_10.csv"]
    with pytest.raises(FileNotFoundError):
        files.load_extractions(spark, catalog, weeks=[1])
    db = sqlite3.connect(tmp_path / "log.db")
    db.execute("CREATE TABLE logs (id INTEGER, seconds REAL, name TEXT)")
    db.executemany("INSERT INTO logs VALUES (?, ?, ?)", [(k, k / 2, None if k == 3 else f"n{k}") for k in range(10)])
    db.commit()
    assert sorted(tuple(r) for r in files.sqlite(spark, str(tmp_path / "log.db"), "logs", 3).collect())[3] == (3, 1.5, None)
    sinks.migrate_table(spark.createDataFrame([("2024-01-01T00:00:00", 1), ("bad", 2)], "timestamp string, id int"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).filter("timestamp IS NULL").count() == 1
    assert sinks.report_prefix([3], 2025) == "OEW03-2025" and sinks.report_prefix([3, 5], 2025) == "OEW03-05-2025" and sinks.report_prefix([], None) == "comparison"


def test_bulletin_pages(spark):
    from tessera.functions.names import bulletin_format

    text = "--- PAGE 1 ---\nintro\n--- PAGE 2 ---\nAll events currently being monitored by WHO AFRO\n"
    pages = tables.pages(spark.createDataFrame([(1, text), (2, "--- PAGE 1 ---\nplain")], "doc_id int, text string"))
    assert {r["doc_id"]: r["format"] for r in bulletin_format(pages).collect()} == {1: "legacy", 2: "modern"}
    found = {r["doc_id"]: (r["first"], r["last"]) for r in tables.table_pages(pages, "(?i)all events").collect()}
    assert found == {1: (2, 2), 2: (1, 1)}

"""Names in texts, merged metrics, numbering, salvage, reconciliation, tables, exports and compaction on small fixtures."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import jsontext as J
from tessera.functions import names
from tessera.operators import cleaning, corrections, logs, reconcile, tables
from tessera.operators.textmatch import contained, held
from tessera.sources import files, sinks
from tessera.streaming import ingest


def test_contained_against_a_nested_loop(spark):
    r = random.Random(1)
    word = lambda n: "".join(r.choice("abéÉ 😀.") for _ in range(n))
    texts = [word(r.randrange(0, 60)) for _ in range(120)] + [None, "", "x" * 5000 + "abéab"]
    found = [word(r.choice((0, 1, 2, 3, 4, 6, 7, 9))) for _ in range(60)] + [t[5:14] for t in texts[:40] if t] + [None]
    got = contained(spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame([(n,) for n in found], "name string"))
    want = {(t, n) for t in texts if t is not None for n in found if n is not None and n in t}
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)
    assert contained(spark.createDataFrame([], "text string"), spark.createDataFrame([("a",)], "name string")).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_is_planned(spark):
    rows = spark.createDataFrame([(k, f"Land {k}", f"Event {k}") for k in range(50)], "i int, Country string, Event string")
    blocks = spark.createDataFrame([(k, f"in land {k} event {k + 1} had 3 cases") for k in range(60)] + [(99, None)], "b int, text string")
    fixes = rows.selectExpr("i AS seq", "Country AS country", "Event AS event", "'Event' AS field", "Event AS old_value", "'x' AS new_value", "0.9 AS confidence")
    known = rows.selectExpr("Country AS name")
    for df in (corrections.linked(rows, blocks), corrections.unique_text_matches(rows, fixes, "i"), names.resolve_countries(rows, known)):
        assert "NestedLoop" not in plan_of(df) and "Cartesian" not in plan_of(df)
    got = {(x["b"], x["i"]): x["score"] for x in corrections.linked(rows, blocks).collect()}
    want = {}
    for b in range(60):
        for i in range(50):
            text = f"in land {b} event {b + 1} had 3 cases"
            hits = (f"land {i}" in text) + (f"event {i}" in text)
            if hits:
                want[b, i] = 0.9 if hits == 2 else 0.6
    assert got == want


def test_linked_keeps_repeated_rows_and_null_names(spark):
    rows = spark.createDataFrame([(1, "Chad", None), (2, "Chad", "Mpox"), (2, "Chad", "Mpox"), (3, None, None)], "i int, Country string, Event string")
    blocks = spark.createDataFrame([("CHAD 5",), ("chad mpox 1",), ("chad mpox 1",), ("chad mpox",)], "text string")
    got = sorted((x["text"], x["i"], x["score"]) for x in corrections.linked(rows, blocks).collect())
    assert got == sorted([("CHAD 5", 1, 0.6)] + [("CHAD 5", 2, 0.6)] * 2 + [("chad mpox 1", 1, 0.6)] * 2 + [("chad mpox 1", 2, 0.9)] * 4)


def test_metrics_are_merged_member_by_member(spark):
    log = [(1, '{"a":1,"accuracy_metrics":0}'), (2, None), (3, "not json"), (4, "[1]"), (5, '{"s":"x\\"y","n":{"k":[1,2.5]},"z":null}'), (6, '{"keep": 1 }'), (7, '{"b":2}')]
    updates = [(1, '{"accuracy_metrics":9}', 1), (2, '{"m":{"f":1}}', 1), (2, '{"b":true}', 2), (2, '{"b":false,"c":1}', 1), (3, '{"x":1}', 1), (4, '{"x":1}', 1), (5, '{"q\\"r":"é"}', 1), (99, "{}", 1), (6, "bad", 3), (None, '{"x":1}', 1), (7, None, 1)]
    log, updates = spark.createDataFrame(log, "id long, custom_metrics string"), spark.createDataFrame(updates, "id long, metrics string, updated_at long")
    got = {x["id"]: x["custom_metrics"] for x in logs.with_metrics(log, updates).collect()}
    assert len(got) == 7 and got[6] == '{"keep": 1 }' and got[7] == '{"b":2}'
    assert json.loads(got[1]) == {"a": 1, "accuracy_metrics": 9} and json.loads(got[2]) == {"m": {"f": 1}, "b": True, "c": 1}
    assert json.loads(got[3]) == json.loads(got[4]) == {"x": 1}
    assert json.loads(got[5]) == {"s": 'x"y', "n": {"k": [1, 2.5]}, "z": None, 'q"r': "é"}
    assert [x["id"] for x in logs.unknown_updates(log, updates.filter("id IS NOT NULL")).collect()] == [99]


@pytest.mark.parametrize("parts", [1, 7])
def test_numbering_by_ranges(spark, parts):
    rows = spark.createDataFrame([(k % 50 if k % 9 else None, f"v{k}", k) for k in range(1000)] + [(3, "same", 1)] * 30, "a int, b string, c int").repartition(5)
    out = logs.numbered(rows, ["a", "b"], spark.range(40).toDF("id"), parts=parts)
    assert "Exchange SinglePartition" not in plan_of(out.filter("id > 0").select("a")) or parts  # one row a range meets, never the rows
    got = out.orderBy("id").collect()
    assert [x["id"] for x in got] == list(range(40, 40 + 1030))
    keys = [(x["a"] is not None, x["a"] or 0, x["b"]) for x in got]
    assert keys == sorted(keys)
    assert logs.numbered(rows.limit(0), ["a"], parts=parts).count() == 0


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"records": [{"a": 1}, {"a": [1,{"b":2}]}, {"a": "x}]', {"records": [{"a": 1}, {"a": [1, {"b": 2}]}]}), ('pre {"m":{"x":1},"records":[{"a":"}"},{"b":2}],"note":"cut', {"m": {"x": 1}, "records": [{"a": "}"}, {"b": 2}]}),
        ('[{"a":1},{"b"', [{"a": 1}]), ('{"a":1} tail', {"a": 1}), ("none", None), (None, None), ('{"records": [', None), ('[{"a":1}}', [{"a": 1}]), ('{"r":[{"a":"q\\"}"},{"a":2', {"r": [{"a": 'q"}'}]}), ("]", None), ("}{", None),
    ],
)
def test_salvage(text, want):
    got = J.salvaged(text)
    assert (json.loads(got) if got else None) == want


def test_corrections_of_responses(spark):
    cases = {
        '```json\n{"corrections": [{"a": 1}], "summary": {"n": 1}}\n```': ("parsed", ['{"a":1}'], '{"n":1}'), '{"corrections": 5, "summary": []}': ("parsed", [], "{}"),
        'x "corrections": [{"a": [1]}, {"b"': ("salvaged", ['{"a":[1]}'], '{"recovery_attempted":true}'), "[1]": ("failed", [], "{}"), "": ("failed", [], "{}"),
    }
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "t string").select("t", J.corrections(F.col("t")).alias("c"))
    got = {x["t"]: (x["c"]["status"], x["c"]["corrections"], x["c"]["summary"]) for x in df.collect()}
    assert got == {**cases, None: ("failed", [], "{}")}


def test_summary_counts_records_of_repeated_keys(spark):
    kind = "Country string, Event string, Year int, WeekNumber int, TotalCases int, CasesConfirmed int, Deaths int, CFR double, Grade string"
    row = lambda c, w, t=1: (c, "E", 2025, w, t, 1, 1, 1.0, "g")
    a = spark.createDataFrame([row("A", 1), row("A", 1, 2), row("B", 1), row(None, 1), row("C", 2)], kind)
    b = spark.createDataFrame([row("A", 1), row("A", 1), row("A", 1), row(None, 1, 5), row("D", 1), row("E", 3)], kind)
    (got,) = reconcile.weekly_summary(a, b).collect()
    # Two left and three right records of A pair sixfold; three of the pairs differ, and the one without a country.
    assert (got["LLMRecords"], got["RuleBasedRecords"], got["LLMOnly"], got["RuleBasedOnly"], got["ValueDiscrepancies"], got["RecordDifference"]) == (4, 5, 1, 1, 4, -1)


def test_tables_are_read_by_their_own_headers(spark):
    rows = [(1, 0, ["Country", None, "Total cases", "Event", "Cases Confirmed", "Deaths", "CFR"]), (1, 1, ["Chad", "Mpox", "1,200", "x", "5", "2", "1.5%"]), (1, 2, ["Ongoing events"]), (1, 3, ["", "1", "2"]),
            (2, 5, ["Mali", "Cholera", "G", "d", "s", "e", "0", "0", "0", "1%"]), (2, 6, ["Mali", "Cholera", "G", "d", "s", "e", "7"]), (2, 7, None), (2, 8, [])]
    got = tables.reconstructed(spark.createDataFrame(rows, "table_id int, row_no int, cells array<string>")).collect()
    # The empty header cell is left out, so cells move up by one; the row of zeros and the dividing one go.
    assert sorted((x["table_id"], x["row_no"], x["Country"], x["Event"], x["Total_Cases"], x["Confirmed_Cases"], x["Deaths"], x["CFR"]) for x in got) == [(1, 1, "Chad", "1,200", 0, 0, 5, 2.0), (2, 6, "Mali", "Cholera", 7, 0, 0, 0.0)]


def test_named_files_are_written_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b/c d", 3), (None, 4)], "name string, v int")
    folder = str(tmp_path / "out")
    assert sinks.write_named(rows.filter("name = 'a'"), folder) == 1
    assert sinks.write_named(rows.filter("name = 'a'").withColumn("v", F.lit(9)), folder) == 0
    read = lambda: sorted((x["name"], x["v"]) for x in files.csv(spark, f"{folder}/*.csv").select(F.regexp_extract(F.col("_metadata.file_name"), r"(.*)\.csv$", 1).alias("name"), "v").collect())
    assert read() == [("a", "1"), ("a", "2")]
    assert sinks.write_named(rows.filter("name = 'a'").withColumn("v", F.lit(9)), folder, force=True) == 1
    assert read() == [("a", "9"), ("a", "9")]
    assert [f for f in os.listdir(folder) if not f.startswith(".")] == ["a.csv"]


def test_stream_keeps_two_versions_of_a_bucket(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "table")
    for k in range(7):  # late rows come last: they change nothing
        spark.createDataFrame([(u, 10 * (7 - k if k > 4 else k) + u, k) for u in range(20)], "u int, at int, v int").coalesce(1).write.mode("append").parquet(inbox)
    stream = ingest.file_stream(spark, inbox, "u int, at int, v int", files_per_batch=1)
    ingest.upsert_stream(stream, out, str(tmp_path / "check"), ["u"], ["at", "v"], buckets=3).awaitTermination()
    assert all(len(v) <= 2 for v in ingest.versions(spark, out).values()) and len(ingest.versions(spark, out)) == 3
    assert sorted((x["u"], x["v"]) for x in ingest.current(spark, out).collect()) == [(u, 4) for u in range(20)]
    assert ingest.current(spark, str(tmp_path / "nothing")) is None


def test_validity_by_group(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "Country string, Event string")
    assert {x["Country"]: x["valid"] for x in cleaning.still_valid(rows, rows.filter("Country = 'a'"), by="Country").collect()} == {"a": True, "b": False}
    assert cleaning.still_valid(rows, rows).first()["valid"]


def test_links_are_merged_and_texts_travel_once(spark):
    """Nothing that grows with names or texts is broadcast, and pairs carry no text."""
    rows = spark.createDataFrame([(k, f"Land {k}", f"Event {k}") for k in range(50)], "i int, Country string, Event string")
    blocks = spark.createDataFrame([(k, f"in land {k} event {k + 1} had 3 cases") for k in range(60)], "b int, text string")
    fixes = rows.selectExpr("i AS seq", "Country AS country", "Event AS event", "'Event' AS field", "Event AS old_value", "'x' AS new_value", "0.9 AS confidence")
    for df in (corrections.linked(rows, blocks), corrections.unique_text_matches(rows, fixes, "i"), corrections.told_corrections(rows, blocks)):
        assert "Broadcast" not in plan_of(df)
    assert held(blocks.select("text"), rows.select(names.F.lower("Country").alias("name"))).columns == ["key", "name"]


def test_no_row_looks_at_all_ranges(spark):
    out = logs.numbered(spark.range(1000).selectExpr("id % 7 AS a", "id AS b"), ["a"], parts=5)
    assert "_cuts" not in plan_of(out)
    assert [(x["id"], x["a"]) for x in out.orderBy("id").collect()] == [(k + 1, a) for k, a in enumerate(sorted(k % 7 for k in range(1000)))]


def test_named_files_are_published_by_tasks(spark, tmp_path):
    rows = spark.range(200).selectExpr("concat('n', id % 90) AS name", "id")
    folder = str(tmp_path / "named")
    assert sinks.write_named(rows, folder) == 90 and sinks.write_named(rows, folder) == 0
    assert sinks.write_named(rows.limit(1), folder, force=True) == 1
    assert files.csv(spark, folder, columns=["id"]).count() == 200 - 2 and sinks.RENAMES > 1


def test_named_files_are_written_by_all_tasks(spark, tmp_path):
    """Rows that came as one partition are dealt, and tasks leave no folder a file behind; odd values are quoted as Spark does."""
    rows = spark.range(300).coalesce(1).selectExpr("concat('n', id % 90) AS name", "if(id % 3 = 0, concat('a,\"', id), if(id % 3 = 1, NULL, '')) AS `v w`", "id")
    folder, plain = str(tmp_path / "named"), str(tmp_path / "plain")
    assert sinks.write_named(rows, folder) == 90
    rows.drop("name").write.option("header", True).option("emptyValue", "").csv(plain)
    lines = lambda at: sorted(x["value"] for x in spark.read.text(at).filter("value NOT LIKE 'v w,%'").collect())
    assert lines(folder) == lines(plain) and spark.read.text(folder).filter("value = 'v w,id'").count() == 90
    assert sorted(os.listdir(folder)) == sorted(f"n{k}.csv" for k in range(90))
    # A slash doesn't lead into another folder, and a rewritten file keeps no old checksum.
    assert sinks.write_named(spark.createDataFrame([("b/c d", 3), (None, 4)], "name string, v int"), folder) == 1 and "b%2Fc d.csv" in os.listdir(folder)


def test_texts_are_written_a_file_a_name(spark, tmp_path):
    folder = str(tmp_path / "texts")
    rows = spark.createDataFrame([("a", "x" * 5), ("b", None), ("c", "é")], "name string, text string")
    assert sinks.write_texts(rows, folder, ".pdf") == 3 and sinks.write_texts(rows, folder, ".pdf") == 0
    assert sorted((x["name"], x["bytes"]) for x in files.listing(spark, folder).select("name", "bytes").collect()) == [("a.pdf", 6), ("b.pdf", 1), ("c.pdf", 3)]


def test_other_stores_are_written_by_sparks_writer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "MOUNTED", ())
    rows, folder = spark.range(200).selectExpr("concat('n', id % 90) AS name", "id"), str(tmp_path / "named")
    assert sinks.write_named(rows, folder) == 90 and sinks.write_named(rows, folder) == 0
    assert sinks.write_named(rows.limit(1), folder, force=True) == 1
    assert files.csv(spark, folder, columns=["id"]).count() == 200 - 2

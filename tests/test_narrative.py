"""Narratives, extraction, summaries, linked runs and registries against plain Python on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import logs as L
from tessera.operators import narrative as N
from tessera.operators import tables as T
from tessera.plans import pipelines
from tessera.sources import files, sinks

KNOWN = ["Mali", "Niger", "Sierra Leone"]
EVENTS = ["Cholera", "measles", "", None]


def is_country(word):
    return 0 < len(word) <= 50 and any(k.lower() in word.lower() or word.lower() in k.lower() for k in KNOWN)


def begins(line):
    return is_country(line.split()[0] if line.split() else "")


def line_of(r):
    words = ["Mali", "mali", "Niger", "cholera", "measles", "of", "il", "rains", "grade", "told", "Sierra Leone", "xyzzyx", "many", "people went on", "a", "  ", "Countryside", "é", "quarantine"]
    return " ".join(r.choice(words) for _ in range(r.choice((0, 1, 2, 5, 8, 14, 40))))


@pytest.fixture(scope="module")
def fixture(spark):
    r = random.Random(3)
    pages = [(k, "\n".join(line_of(r) for _ in range(r.randrange(0, 25)))) for k in range(60)] + [(90, None), (91, ""), (92, "Mali " + "and on went the flood " * 4000)]
    records = [(k, c, e) for k, _ in pages for c in ("Mali", "niger", "Sierra Leone", "", None) for e in EVENTS] + [(1, "Mali", "Cholera"), (None, "Mali", "Cholera"), (500, "Mali", "Cholera")]
    schema = "page_id long, Country string, Event string"
    return dict(pages), records, spark.createDataFrame(records, schema), spark.createDataFrame(pages, "page_id long, text string"), spark.createDataFrame([(k,) for k in KNOWN], "name string")


def told(lines, country, event):
    """By the description, one record at a time."""
    country, event = (country or "").lower(), (event or "").lower()
    if not country:
        return ""
    for sure, ahead in ((True, 4), (False, 2)):
        for i, line in enumerate(lines):
            low = line.lower()
            if len(line) < 30 or any(h in low for h in N.HEADINGS) or country not in low:
                continue
            if (not event or event not in low) if sure else low == country:
                continue
            parts = [line]
            for more in lines[i + 1 : i + 1 + ahead]:
                if len(more) >= 20:
                    if begins(more) or any(h in more.lower() for h in N.HEADINGS[:3]):
                        break
                    parts.append(more)
            out = " ".join(parts)
            return out if sure or len(out) <= 500 else out[:497] + "..."
    return ""


def longest(lines, country):
    best = ""
    for i, line in enumerate(lines):
        if not country or country.lower() not in line.lower() or len(line) <= 50 or any(h in line.lower() for h in (*N.HEADINGS[:3], "total cases")):
            continue
        parts = [line]
        for more in lines[i + 1 : i + 4]:
            if len(more) <= 30 or begins(more):
                break
            parts.append(more)
        best = max(best, " ".join(parts), key=len)
    return best if len(best) <= 300 else best[:300] + "..."


def lines_of(text):
    return [" ".join(x.split()) for x in (text or "").split("\n")]


def test_narratives_against_a_plain_loop(fixture):
    pages, records, asked, texts, known = fixture
    asked = asked.withColumns({"line": F.lit("a clash"), "low": F.lit(1)})
    got = N.told_of(asked, texts, known)
    assert got.columns == [*asked.columns, "narrative"]
    want = sorted((repr((k, c, e)), told(lines_of(pages.get(k)), c, e)) for k, c, e in records)
    assert sorted((repr((x["page_id"], x["Country"], x["Event"])), x["narrative"]) for x in got.collect()) == want
    assert sum(bool(w) for _, w in want) > 50 and any(w.endswith("...") for _, w in want)
    got = N.longest_told(asked, texts, known)
    want = sorted((repr((k, c, e)), longest(lines_of(pages.get(k)), c)) for k, c, e in records)
    assert sorted((repr((x["page_id"], x["Country"], x["Event"])), x["narrative"]) for x in got.collect()) == want


def test_narratives_of_nothing(spark, fixture):
    _, records, asked, texts, known = fixture
    assert N.told_of(asked.limit(0), texts, known).count() == 0
    assert {x["narrative"] for x in N.told_of(asked, texts.limit(0), known).collect()} == {""}
    assert N.longest_told(asked, texts, known.limit(0)).count() == len(records)


def test_pages_with_positioned_words_take_their_lines(spark, fixture):
    known = fixture[-1]
    pages = spark.createDataFrame([(1, "nothing"), (2, "Mali had cholera in the north of the land")], "page_id long, text string")
    words = [(1, n, float(10 * n), 100.0 + n % 3, w) for n, w in enumerate("Mali had no cholera in the south of it".split())] + [(2, 0, 0.0, None, "Niger")]
    asked = spark.createDataFrame([(1, "Mali", "cholera"), (2, "Mali", "cholera")], "page_id long, Country string, Event string")
    got = N.told_of(asked, pages, known, spark.createDataFrame(words, "page_id long, seq long, x0 double, y0 double, text string"))
    assert {x["page_id"]: x["narrative"] for x in got.collect()} == {1: "Mali had no cholera in the south of it", 2: "Mali had cholera in the north of the land"}


def test_stage_one_begins_at_its_marker(spark, fixture):
    known = fixture[-1]
    cells = [["Country", "Event", "Grade"], ["Mali", "Cholera", "Grade 1", None, "", "", "1,000"], ["Atlantis", "Cholera", "Grade 1"], ["Mali", "Cholera", ""], None, []]
    rows = spark.createDataFrame([(d, p, n, c) for d in (1, 2) for p in (1, 2) for n, c in enumerate(cells)], "doc_id long, page int, row_no int, cells array<string>")
    pages = spark.createDataFrame([(1, 1, "x"), (1, 2, f"{N.MARKER}\nIn Mali the rains have made the spread of cholera much worse"), (2, 1, None)], "doc_id long, page int, text string")
    (got,) = N.stage_one(rows, pages, known).collect()
    assert (got["doc_id"], got["page"], got["Country"], got["Total_Cases"], got["Deaths"]) == (1, 2, "Mali", "1,000", "")
    assert got["narrative"].startswith("In Mali the rains")


def test_extracted_rows_keep_their_tags(spark):
    story = "The ministry has reported that many cases were found since the outbreak began in the north of the land"
    cells = [["Mali", "Cholera", "Grade 1", "", "", "", " 1,000 "], [story], ["Mali", "Measles", "Grade 2", "x"], ["short"], [story]]
    rows = spark.createDataFrame([(7, n, 3, c) for n, c in enumerate(cells)], "table_id long, row_no int, page int, cells array<string>")
    got = {x["row_no"]: x for x in T.extracted(rows).collect()}
    assert set(got) == {0, 2} and got[0]["narrative"] == story and got[2]["narrative"] == "" and got[0]["page"] == 3 and got[0]["Total_Cases"] == "1,000" and got[2]["Total_Cases"] == ""


def test_following_narrative_by_plain_python(spark):
    r = random.Random(5)
    story, other = "The  ministry has reported that many cases were found since the outbreak began in the north of the land", "People were in need of help during the crisis and the total of deaths has been low so far"
    both = "To the in of was has a to by at on an it is the of to from"  # long running text in a row of data
    kinds = [[story], [other, None], ["Mali", "Cholera", "Grade 1", "x"], ["Mali", None, "Grade 2", "y", ""], ["short"], ["z" * 60], [both, "Cholera", "Grade 1", "x"], ["Country", "Event", "Grade", "x"], [None, "a"], ["  "], [], None]
    rows = [(k, 3 * n, r.choice(kinds)) for k in range(200) for n in range(r.randrange(0, 12))] + [(None, n, r.choice(kinds)) for n in range(8)]
    is_data, is_long = [kinds[2], kinds[3], kinds[6]], [story, other, both]
    tables, expected = {}, {}
    for k, n, c in rows:
        tables.setdefault(k, []).append((n, c))
    for k, table in tables.items():
        for i, (n, c) in enumerate(table):
            if c in is_data:
                parts = []
                for _, more in table[i + 1 : i + 5]:
                    cell = ((more or [""])[0] or "").strip()
                    if more in is_data or 0 < len(cell) < 50:
                        break
                    parts += [" ".join(cell.split())] if cell in is_long else []
                expected[k, n] = (" ".join(parts), c)
    df = spark.createDataFrame(rows, "table_id long, row_no int, cells array<string>").repartition(3)
    for parts in (None, 1):
        out = T.following_narrative(df, parts=parts)
        assert out.columns == ["table_id", "row_no", "cells", "narrative"]
        assert {(x["table_id"], x["row_no"]): (x["narrative"], x["cells"]) for x in out.collect()} == expected


def test_following_narrative_deals_narrow_rows_with_the_input(spark, capsys):
    cells = "CASE WHEN id % 2 = 0 THEN array('Mali', 'Cholera', 'Grade 1', 'x') ELSE array('short') END AS cells"
    for parts in (2, 10):
        rows = spark.range(0, 40_000, 1, parts).selectExpr("id DIV 4 AS table_id", "id % 4 AS row_no", cells)
        out = T.following_narrative(rows).select("table_id", "row_no", "narrative")
        tasks = [x["count"] for x in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 20_000 and max(tasks) < 2 * 20_000 / (8 * parts)
    out.explain("formatted")
    shuffles = [x for x in capsys.readouterr().out.split("\n\n") if ") Exchange" in x]
    assert shuffles and not any("cells" in x for x in shuffles)


def test_summaries_and_exports(spark, tmp_path):
    rows = [(w, f"L{k % 13:02d}", "E" if k % 2 else None, f"G{k % 3}") for w in (1, 2) for k in range(40)]
    df = spark.createDataFrame(rows, "week int, Country string, Event string, Grade string")
    docs = {x["week"]: json.loads(x["document"]) for x in N.summaries(df, "week").collect()}
    assert docs[1]["records"] == 40 and docs[1]["countries"] == 13 and docs[1]["events"] == 1 and docs[1]["event_types"] == {"E": 20}
    assert list(docs[2]["top_countries"].items()) == [("L00", 4), *[(f"L{k:02d}", 3) for k in range(1, 10)]] and docs[2]["grade_distribution"] == {"G0": 14, "G1": 13, "G2": 13}
    assert N.summaries(df.limit(0), "week").count() == 0
    bare = N.summaries(df.withColumns({c: F.lit(None).cast("string") for c in ("Event", "Grade", "Country")}), "week").first()
    assert (bare["records"], bare["countries"], bare["events"]) == (40, 0, 0)
    sinks.write_export(df, N.export_metadata(df, ["week"]), str(tmp_path / "out"), ["week"])
    assert spark.read.json(str(tmp_path / "out/records")).count() == 80
    told = {x["week"]: x for x in files.json_lines(spark, str(tmp_path / "out/metadata")).collect()}
    assert told[1]["total_records"] == 40 and told[1]["events"] == ["E"] and told[1]["countries"] == sorted({r[1] for r in rows})


def test_linked_runs_double_no_run(spark):
    runs = spark.createDataFrame([(1, 10), (2, None), (3, 11), (4, 99)], "id long, preprocessing_id long")
    before = spark.createDataFrame([(10, "a", True), (10, "a", True), (11, None, False), (None, "z", True)], "id long, method string, success boolean")
    metrics = spark.createDataFrame([(1, "{}"), (1, '{"x":1}'), (None, "no")], "id long, metrics string")
    got = {x["id"]: (x["preprocessing_method"], x["preprocessing_success"], x["accuracy_document"], x["has_metrics"]) for x in L.linked_runs(runs, before, metrics).collect()}
    assert got == {1: ("a", True, "{}", True), 2: (None, None, None, False), 3: (None, False, None, False), 4: (None, None, None, False)}


def test_registry_tables(spark):
    rows = [("a", "v1.2.0", False), ("a", "v1.10.0", None), ("b", "v2.0.0", False), ("b", "v1.0.0", True), ("b", "v1.0.1", True)]
    got = {x["kind"]: (x["version"], x["versions"], x["marked"]) for x in L.current_versions(spark.createDataFrame(rows, "kind string, version string, is_current boolean")).collect()}
    assert got == {"a": ("v1.10.0", 2, False), "b": ("v1.0.1", 3, True)}
    runs = spark.createDataFrame([("1", "y"), ("1", "x"), ("1", "x"), ("2", None)], "version string, model string")
    assert {x["version"]: x["models"] for x in L.models_by_version(runs).collect()} == {"1": ["x", "y"], "2": []}


def test_bulletins_of_every_week_agree_with_one_at_a_time(spark):
    rows = spark.createDataFrame([(w, y, f"{w}-{y}") for w, y in ((1, 2020), (1, 2024), (1, 2022), (2, 2021), (2, 2020), (None, 2022))], "week int, year int, href string")
    got = {x["week"]: x["href"] for x in pipelines.pick_bulletins(rows, 2022).collect()}
    assert got == {1: "1-2022", 2: "2-2021", None: "None-2022"}
    assert all(pipelines.pick_bulletin(rows, w, 2022).first()["href"] == got[w] for w in (1, 2))


def test_filled_tables(spark, tmp_path):
    for name, n in (("a", 2), ("b", 3)):
        (tmp_path / f"{name}.csv").write_text("w,x,y,z\n" + "1,2,3,4\n" * n)
    assert {x["SourceFile"] for x in files.filled_tables(spark, str(tmp_path)).collect()} == {"b.csv"}
    assert files.filled_tables(spark, str(tmp_path), columns=4).count() == 0


def test_a_file_a_supplier_needs_no_folder(spark):
    import os
    from urllib.parse import urlparse

    from __spark_entry__ import DATA, queries
    from tessera.plans import operations

    assert queries()["valid_files"](spark, DATA).count() == spark.read.parquet(f"{DATA}/supplier.parquet").count()
    found = list(os.scandir(urlparse(operations._made[-1][1]).path))
    assert found and all(f.is_file() for f in found)


def test_lines_are_built_a_batch_of_pages_at_a_time(spark):
    """Not a page at a time, and no more than once for the names and once for the lines."""
    from tessera.operators import tables

    words = spark.createDataFrame([(1, None, 0.0, 1.0, "last"), (1, 2, 5.0, 12.0, "b"), (1, 1, 9.0, 10.0, "a"), (1, 3, 1.0, 7.0, "c"), (None, 1, 0.0, 0.0, "x")], "page_id int, seq int, x0 double, y0 double, text string")
    assert sorted(((x["page_id"], x["line_no"], x["y0"], x["line"]) for x in tables.text_lines(words).collect()), key=str) == [(1, 0, 1.0, "last"), (1, 1, 10.0, "c b a"), (None, 0, 0.0, "x")]
    pages = spark.createDataFrame([(1, "nothing")], "page_id int, text string")
    plan = N.page_lines(pages, spark.createDataFrame([("Chad",)], "name string"), words)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and 0 < plan.count("MapInArrow") <= 2

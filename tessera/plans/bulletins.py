"""Queries of bulletins: narratives of records, extraction, summaries, exports, files, linked runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names
from tessera.functions import scalars as S
from tessera.operators import corrections as C
from tessera.operators import logs as L
from tessera.operators import narrative as N
from tessera.operators import tables as T
from tessera.plans.catalog import register
from tessera.plans.harness import SIDES_SQL, side_a, side_b
from tessera.session import ship_package, table

# ------------------------------------------------------ narratives of records

# A page a customer, a line an order: telling lines, lines that go on, short ones, headings, other countries.
_LINE = """CASE o_orderkey % 9 WHEN 0 THEN concat('Officials of ', n_name, ' told of ', o_orderkey, ' cholera patients in the north') WHEN 1 THEN concat('They went on to say that more was needed by ', o_orderkey)
  WHEN 2 THEN concat('short ', o_orderkey) WHEN 3 THEN concat(n_name, ' speaks of measles and of many other things too ', o_orderkey) WHEN 4 THEN 'Country Event Grade header of a table in full length'
  WHEN 5 THEN concat('Visitors of NATION_', o_orderkey % 25, ' saw malaria in the low lands by the river ', o_orderkey) WHEN 6 THEN 'on and on it went without an end in that long season'
  WHEN 7 THEN concat('The weekly brief of ', n_name, ' is calm and without any news ', o_orderkey) ELSE concat('It is thought that the rains made this worse for all ', o_orderkey) END"""
_EVENTS = ("Cholera", "Measles", "Malaria", "")

_LINES_SQL = f"""lines AS (SELECT o_custkey AS page_id, n_name AS own, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS line_no, {_LINE} AS line FROM orders JOIN nation ON n_nationkey = o_custkey % 25),
marked AS (SELECT *, lower(line) AS low, (SELECT bool_or(contains(lower(n_name), split_part(lower(line), ' ', 1)) OR contains(split_part(lower(line), ' ', 1), lower(n_name))) FROM nation) AS names FROM lines)"""
_RECORDS_SQL = "r AS (SELECT DISTINCT o_custkey AS page_id, n_name AS Country, unnest(['Cholera', 'Measles', 'Malaria', '']) AS Event FROM orders JOIN nation ON n_nationkey = o_custkey % 25)"


def _lines(spark, sf_dir) -> DataFrame:
    own = F.col("n_nationkey") == F.col("o_custkey") % 25
    return table(spark, sf_dir, "orders").join(table(spark, sf_dir, "nation"), own).selectExpr("o_custkey AS page_id", "o_orderkey", "n_name", f"{_LINE} AS line")


def _pages(lines: DataFrame) -> DataFrame:
    """A customer's few orders are a page."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("page_id").agg(text.alias("text"))


def _asked(lines: DataFrame) -> DataFrame:
    return lines.select("page_id", F.col("n_name").alias("Country")).distinct().withColumn("Event", F.explode(F.array(*[F.lit(e) for e in _EVENTS])))


def _known(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))


_TOLD_SQL = f"""WITH {_LINES_SQL}, {_RECORDS_SQL},
steps AS (SELECT *, NOT (names OR regexp_matches(low, 'country|event|grade')) AS goes, length(line) < 20 AS short FROM marked),
ahead AS (SELECT *, list({{'t': line, 'ok': goes, 'short': short}}) OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) AS four,
  list({{'t': line, 'ok': goes, 'short': short}}) OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS two FROM steps),
long AS (SELECT page_id, line_no, line, low, list_filter(coalesce(four, []), lambda x: NOT x.short) AS four, list_filter(coalesce(two, []), lambda x: NOT x.short) AS two FROM ahead
  WHERE length(line) >= 30 AND NOT regexp_matches(low, 'country|event|grade|date notified|total cases|start of reporting|end of reporting|cases confirmed|ongoing events|new events|cfr|deaths')),
told AS (SELECT page_id, line_no, low, array_to_string(list_concat([line], list_transform(four[1:coalesce(nullif(list_position(list_transform(four, lambda x: x.ok), false), 0) - 1, len(four))], lambda x: x.t)), ' ') AS long,
  array_to_string(list_concat([line], list_transform(two[1:coalesce(nullif(list_position(list_transform(two, lambda x: x.ok), false), 0) - 1, len(two))], lambda x: x.t)), ' ') AS brief FROM long),
found AS (SELECT r.page_id, Country, Event, arg_min(long, line_no) FILTER (Event <> '' AND contains(low, lower(Event))) AS sure, arg_min(brief, line_no) AS any_line FROM r JOIN told ON r.page_id = told.page_id AND contains(low, lower(Country)) GROUP BY ALL)
SELECT r.page_id, r.Country, r.Event, coalesce(sure, CASE WHEN length(any_line) > 500 THEN concat(left(any_line, 497), '...') ELSE any_line END, '') AS narrative FROM r LEFT JOIN found ON r.page_id = found.page_id AND r.Country = found.Country AND r.Event = found.Event"""


@register("told_narratives", _TOLD_SQL)
def told_narratives(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return N.told_of(_asked(lines), _pages(lines), _known(spark, sf_dir))


@register("placed_narratives", _TOLD_SQL)
def placed_narratives(spark, sf_dir):
    """Every other page has no text but positioned words, of which its lines are built."""
    ship_package(spark)
    lines = _lines(spark, sf_dir)
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("o_orderkey"))
    words = lines.filter("page_id % 2 = 0").withColumn("_n", nth).select("page_id", "_n", F.posexplode(F.split("line", " ")).alias("_w", "text"))
    words = words.select("page_id", (F.col("_n") * 100 + F.col("_w")).alias("seq"), (F.col("_w") * 10.0).alias("x0"), (F.col("_n") * 12.0 + F.col("_w") % 3).alias("y0"), "text")
    pages = _pages(lines).withColumn("text", F.when(F.col("page_id") % 2 == 1, F.col("text")).otherwise("nothing to read"))
    return N.told_of(_asked(lines), pages, _known(spark, sf_dir), words)


_LONGEST_SQL = """ahead AS (SELECT *, coalesce(list({'t': line, 'ok': length(line) > 30 AND NOT names}) OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), []) AS three FROM marked),
long AS (SELECT page_id, line_no, low, array_to_string(list_concat([line], list_transform(three[1:coalesce(nullif(list_position(list_transform(three, lambda x: x.ok), false), 0) - 1, len(three))], lambda x: x.t)), ' ') AS told FROM ahead
  WHERE length(line) > 50 AND NOT regexp_matches(low, 'country|event|grade|total cases'))"""


@register("longest_narratives", f"""WITH {_LINES_SQL}, {_RECORDS_SQL}, {_LONGEST_SQL},
best AS (SELECT r.page_id, Country, Event, arg_max(told, length(told) * 1000000 - line_no) AS told FROM r JOIN long ON r.page_id = long.page_id AND contains(low, lower(Country)) GROUP BY ALL)
SELECT r.page_id, r.Country, r.Event, coalesce(CASE WHEN length(told) > 300 THEN concat(left(told, 300), '...') ELSE told END, '') AS narrative FROM r LEFT JOIN best ON r.page_id = best.page_id AND r.Country = best.Country AND r.Event = best.Event""")
def longest_narratives(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return N.longest_told(_asked(lines), _pages(lines), _known(spark, sf_dir))


# Rows of a customer's table: records, rows without a country, short rows, headings.
_ROW = """CASE o_orderkey % 5 WHEN 0 THEN array('Country', 'Event', 'Grade') WHEN 1 THEN array(n_name, o_orderpriority) WHEN 2 THEN array('Zzyzx', o_orderpriority, 'Grade 1', 'd')
  WHEN 3 THEN array(concat(' ', n_name, '  of the north'), o_orderpriority, NULL, '1  May', '', '', concat(o_orderkey, ',000')) ELSE array(n_name, o_orderpriority, 'Grade 2', '', '', '', string(o_orderkey)) END"""


@register("stage_one_records", f"""WITH {_LINES_SQL}, {_LONGEST_SQL}, t AS (SELECT o_custkey, o_orderkey, o_orderpriority, n_name FROM orders JOIN nation ON n_nationkey = o_custkey % 25 WHERE o_orderkey % 5 >= 3 AND o_custkey % 4 > 0),
w AS (SELECT o_custkey AS doc_id, o_orderkey AS row_no, CASE WHEN o_orderkey % 5 = 3 THEN concat(n_name, ' of the north') ELSE n_name END AS Country, o_orderpriority AS Event, CASE WHEN o_orderkey % 5 = 3 THEN '' ELSE 'Grade 2' END AS Grade,
  CASE WHEN o_orderkey % 5 = 3 THEN '1 May' ELSE '' END AS Date_Notified, CASE WHEN o_orderkey % 5 = 3 THEN concat(o_orderkey, ',000') ELSE CAST(o_orderkey AS VARCHAR) END AS Total_Cases FROM t),
best AS (SELECT doc_id, row_no, arg_max(told, length(told) * 1000000 - line_no) AS told FROM w JOIN long ON doc_id = page_id AND contains(low, lower(Country)) GROUP BY ALL)
SELECT w.*, coalesce(CASE WHEN length(told) > 300 THEN concat(left(told, 300), '...') ELSE told END, '') AS narrative FROM w LEFT JOIN best ON w.doc_id = best.doc_id AND w.row_no = best.row_no""")
def stage_one_records(spark, sf_dir):
    """A document a customer: the marker stands on page 2, but on none of every fourth; page 3 tells."""
    nation = table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders").join(nation, F.col("n_nationkey") == F.col("o_custkey") % 25)
    rows = orders.selectExpr("o_custkey AS doc_id", "explode(array(1, 3)) AS page", "o_orderkey AS row_no", f"{_ROW} AS cells")
    telling = _pages(_lines(spark, sf_dir)).select(F.col("page_id").alias("doc_id"), F.lit(3).alias("page"), "text")
    marks = telling.select("doc_id", F.lit(2).alias("page"), F.when(F.col("doc_id") % 4 > 0, N.MARKER).otherwise("Nothing").alias("text"))
    found = N.stage_one(rows, telling.unionByName(marks), _known(spark, sf_dir))
    return found.select("doc_id", "row_no", "Country", "Event", "Grade", "Date_Notified", "Total_Cases", "narrative")


_CELLS = """CASE (l_linenumber + l_suppkey) % 5 WHEN 0 THEN array(concat('Land', chr(int(65 + l_suppkey % 26))), ' Lassa  Fever', 'Grade 2', '', '', '', concat(l_orderkey, ',000'), '12', NULL)
  WHEN 1 THEN array(concat('The ministry has reported that ', l_orderkey, ' cases were found since the outbreak began in the north of the land')) WHEN 2 THEN array(concat('People were in need of  help during the crisis and the total of deaths has been low so far, number ', l_orderkey))
  WHEN 3 THEN array('Note', 'x') ELSE array('Zzzzzzzzzz zzzzzzzzzz zzzzzzzzzz zzzzzzzzzz zzzzzzzzzz zzzzzzzzzz') END"""


@register("extracted_records", """WITH r AS (SELECT l_suppkey AS s, l_orderkey * 10 + l_linenumber AS row_no, l_orderkey AS o, (l_linenumber + l_suppkey) % 5 AS k, CASE (l_linenumber + l_suppkey) % 5
  WHEN 1 THEN concat('The ministry has reported that ', l_orderkey, ' cases were found since the outbreak began in the north of the land') WHEN 2 THEN concat('People were in need of help during the crisis and the total of deaths has been low so far, number ', l_orderkey) END AS t FROM lineitem),
a AS (SELECT *, coalesce(list({'k': k, 't': t}) OVER (PARTITION BY s ORDER BY row_no ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING), []) AS ahead FROM r),
b AS (SELECT *, ahead[1:coalesce(nullif(list_position(list_transform(ahead, lambda x: x.k IN (0, 3)), true), 0) - 1, len(ahead))] AS upto FROM a WHERE k = 0)
SELECT s AS table_id, row_no, CAST(s % 7 AS BIGINT) AS page, concat('Land', chr(CAST(65 + s % 26 AS INTEGER))) AS Country, 'Lassa Fever' AS Event, concat(o, ',000') AS Total_Cases, '' AS Deaths,
  coalesce(array_to_string(list_filter(list_transform(upto, lambda x: x.t), lambda x: x IS NOT NULL), ' '), '') AS narrative FROM b""")
def extracted_records(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS table_id", "l_orderkey * 10 + l_linenumber AS row_no", "bigint(l_suppkey % 7) AS page", f"{_CELLS} AS cells")
    return T.extracted(rows).select("table_id", "row_no", "page", "Country", "Event", "Total_Cases", "Deaths", "narrative")


# A block an order, on a land of its own: revised deaths, a count that should be another, a malformed number, no number.
_BLOCK = """CASE o_orderkey % 4 WHEN 0 THEN concat('In Land', o_orderkey, 'x the deaths of Fever', o_custkey, 'x were revised to ', o_custkey + 1) WHEN 1 THEN concat('For Land', o_orderkey, 'x it should be ', o_custkey * 2, ' patients')
  WHEN 2 THEN concat('Land', o_orderkey, 'x has 12,34 and not 12,345') ELSE concat('Land', o_orderkey, 'x is calm') END"""


@register("told_corrections", """SELECT concat('Land', o_orderkey, 'x') AS Country, CASE o_orderkey % 4 WHEN 0 THEN 'Deaths' ELSE 'TotalCases' END AS field, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN CAST(o_custkey * 2 + 1 AS VARCHAR) ELSE '12,34' END AS old_value,
  CAST(CASE o_orderkey % 4 WHEN 0 THEN o_custkey + 1 WHEN 1 THEN o_custkey * 2 ELSE 12345 END AS DOUBLE) AS new_value, CASE o_orderkey % 4 WHEN 0 THEN 'revision' WHEN 1 THEN 'should_be' ELSE 'formatting' END AS kind,
  CAST(CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN CASE WHEN o_custkey > 0 THEN 0.7 ELSE 0.6 END ELSE 0.8 END AS DOUBLE) AS confidence FROM orders WHERE o_orderkey % 4 < 3""")
def told_corrections(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = orders.selectExpr("concat('Land', o_orderkey, 'x') AS Country", "concat('Fever', if(o_orderkey % 4 = 0, o_custkey, -1 - o_orderkey), 'x') AS Event", "if(o_orderkey % 4 = 2, '12,34', string(o_custkey * 2 + 1)) AS TotalCases", "string(o_custkey) AS Deaths", "'0' AS CasesConfirmed")
    blocks = orders.selectExpr(f"{_BLOCK} AS text")
    own = F.col("text").contains(F.col("Country"))  # blocks of the same event speak of other lands
    return C.told_corrections(rows, blocks).filter(own).select("Country", "field", "old_value", "new_value", "kind", "confidence")


# --------------------------------------------------------- summaries, exports


@register("bulletin_summaries", f"""WITH {SIDES_SQL}, e AS (SELECT Year, WeekNumber, concat(Event, ' in ', Country) AS v, count(*) AS n FROM side_b GROUP BY ALL), g AS (SELECT Year, WeekNumber, Grade, count(*) AS n FROM side_b WHERE Grade IS NOT NULL GROUP BY ALL),
te AS (SELECT Year, WeekNumber, array_to_string(list(concat(v, '=', n) ORDER BY n DESC, v)[1:10], ';') AS event_types FROM e GROUP BY ALL), tg AS (SELECT Year, WeekNumber, string_agg(concat(Grade, '=', n), ';' ORDER BY n DESC, Grade) AS grades FROM g GROUP BY ALL),
s AS (SELECT Year, WeekNumber, count(*) AS records, count(DISTINCT Country) AS countries, count(DISTINCT concat(Event, ' in ', Country)) AS events FROM side_b GROUP BY ALL)
SELECT s.*, event_types, grades FROM s JOIN te USING (Year, WeekNumber) LEFT JOIN tg USING (Year, WeekNumber)""")
def bulletin_summaries(spark, sf_dir):
    """Written as JSON documents and read back."""
    from tessera.plans.operations import scratch
    from tessera.sources import files, sinks

    rows = side_b(spark, sf_dir).withColumn("Event", F.concat("Event", F.lit(" in "), "Country"))
    folder = scratch(spark, "summaries")
    sinks.write_report(N.summaries(rows, ["Year", "WeekNumber"]), folder)
    read = files.json_lines(spark, folder, "Year int, WeekNumber int, records long, countries long, events long, document string")
    pairs = lambda c: F.array_join(F.transform(F.map_entries(F.from_json(F.get_json_object("document", f"$.{c}"), "map<string,long>")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return read.select("Year", "WeekNumber", "records", "countries", "events", pairs("event_types").alias("event_types"), F.nullif(pairs("grade_distribution"), F.lit("")).alias("grades"))


@register("exported_bulletins", f"""WITH {SIDES_SQL} SELECT Year, WeekNumber, count(*) AS total_records, count(*) AS records_read, string_agg(DISTINCT Country, ';' ORDER BY Country) AS countries, string_agg(DISTINCT Event, ';' ORDER BY Event) AS events FROM side_b GROUP BY ALL""")
def exported_bulletins(spark, sf_dir):
    from tessera.plans.operations import scratch
    from tessera.sources import files, sinks

    rows, by, folder = side_b(spark, sf_dir), ["Year", "WeekNumber"], scratch(spark, "bulletins")
    sinks.write_export(rows, N.export_metadata(rows, by), folder, by)
    told = files.json_lines(spark, f"{folder}/metadata", "Year int, WeekNumber int, total_records long, countries array<string>, events array<string>")
    read = spark.read.schema("Country string").json(f"{folder}/records").groupBy(*by).agg(F.count("*").alias("records_read"))
    return told.join(read, by).select(*by, "total_records", "records_read", F.array_join("countries", ";").alias("countries"), F.array_join("events", ";").alias("events"))


@register("written_evaluation", f"""WITH {SIDES_SQL}, filled AS (SELECT * EXCLUDE (CasesConfirmed, Deaths), CASE WHEN TotalCases >= 100 AND CasesConfirmed = TotalCases AND NOT contains(coalesce(Grade, ''), 'Protracted') THEN 0 ELSE CasesConfirmed END AS CasesConfirmed,
  CASE WHEN TotalCases > 0 AND CFR > 0 AND abs(Deaths * 100.0 / TotalCases - CFR) > 1 THEN round_even(CFR / 100 * TotalCases, 0) ELSE Deaths END AS Deaths FROM side_a),
p AS (SELECT abs(a.TotalCases - b.TotalCases) > 0.01 OR abs(a.CasesConfirmed - b.CasesConfirmed) > 0.01 OR abs(a.Deaths - b.Deaths) > 0.01 OR abs(a.CFR - b.CFR) > 0.01 OR a.Grade IS DISTINCT FROM b.Grade AS d FROM filled a JOIN side_b b USING (Country, Event, Year, WeekNumber))
SELECT count(CASE WHEN d THEN 1 END) AS different, (SELECT count(*) FROM side_a) - count(*) AS left_only, CAST(1 AS BIGINT) AS documents FROM p""")
def written_evaluation(spark, sf_dir):
    """Scores, differences and one-sided records of two text tables, read back from their files."""
    from tessera.plans import pipelines
    from tessera.plans.operations import scratch
    from tessera.sources import files

    text = lambda df: df.select("Year", "WeekNumber", *[F.col(c).cast("string").alias(c) for c in ("Country", "Event", "Grade", "TotalCases", "CasesConfirmed", "Deaths", "CFR")])
    folder = scratch(spark, "evaluation")
    pipelines.evaluate(text(side_a(spark, sf_dir)), text(side_b(spark, sf_dir)), folder)
    n = lambda df, c: df.agg(F.count("*").alias(c))
    return n(files.csv(spark, f"{folder}/discrepancies"), "different").join(n(files.csv(spark, f"{folder}/llm_only"), "left_only")).join(n(files.json_lines(spark, f"{folder}/metrics"), "documents"))


# ------------------------------------------------------------ files and pages


@register("filled_tables", """WITH k AS (SELECT s_nationkey FROM supplier GROUP BY 1 HAVING count(*) > 2) SELECT concat('table_', s_nationkey, '.csv') AS file, s_name AS Country, CAST(s_suppkey AS VARCHAR) AS Event FROM supplier JOIN k USING (s_nationkey)""")
def filled_tables(spark, sf_dir):
    """Of a CSV file a nation, those with more than two rows."""
    from tessera.plans.operations import scratch
    from tessera.sources import files, sinks

    folder = scratch(spark, "tables")
    sinks.write_named(table(spark, sf_dir, "supplier").select(F.concat(F.lit("table_"), F.col("s_nationkey").cast("string")).alias("name"), F.col("s_name").alias("Country"), F.col("s_suppkey").alias("Event"), F.lit("1").alias("Cases"), F.lit("0").alias("Deaths")), folder)
    return files.filled_tables(spark, folder).select(F.col("SourceFile").alias("file"), "Country", "Event")


@register("valid_files", "SELECT s_suppkey, CAST(4 + (s_suppkey % 20) * 1000 + 1 AS BIGINT) AS bytes, 4 + (s_suppkey % 20) * 1000 + 1 >= 10240 AND s_suppkey % 3 <> 0 AS valid FROM supplier")
def valid_files(spark, sf_dir):
    """A file a supplier, of different sizes, two thirds with the right first bytes."""
    from tessera.plans.operations import scratch
    from tessera.sources import files, sinks

    folder = scratch(spark, "pdfs")
    text = "concat(if(s_suppkey % 3 = 0, '<htm', '%PDF'), repeat('x', int(s_suppkey % 20 * 1000))) AS text"
    sinks.write_texts(table(spark, sf_dir, "supplier").selectExpr("concat('supplier_', s_suppkey) AS name", text), folder, ".pdf")
    found = files.valid_pdfs(spark, folder)
    return found.select(F.regexp_extract("path", r"supplier_(\d+)\.pdf$", 1).cast("long").alias("s_suppkey"), "bytes", "valid")


@register("preprocessing_runs", """SELECT o_orderstatus AS method, count(*) AS runs, count(CASE WHEN o_orderkey % 2 = 1 THEN 1 END) AS noted, CAST(sum(o_custkey) AS BIGINT) AS records FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1""")
def preprocessing_runs(spark, sf_dir):
    """Runs in files of two schemas, read as one table and filtered."""
    from tessera.plans.operations import scratch
    from tessera.sources import files, sinks

    folder = scratch(spark, "preprocessing")
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("method"), (F.col("o_orderkey") % 3 != 0).alias("success"), F.col("o_custkey").alias("records"))
    sinks.append_run(runs.filter("id % 2 = 0"), folder)
    sinks.append_run(runs.filter("id % 2 = 1").withColumn("note", F.lit("seen")), folder)
    read = L.query(files.parquet_logs(spark, folder), success=True)
    return read.groupBy("method").agg(F.count("*").alias("runs"), F.count("note").alias("noted"), F.sum("records").alias("records"))


@register("record_pages", """SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 3 END AS INT) AS first, CAST(3 AS INT) AS last FROM documents WHERE text IS NOT NULL GROUP BY doc_id""")
def record_pages(spark, sf_dir):
    """The pages of a document from the one on that begins the table."""
    mark = F.when(F.col("doc_id") % 3 == 0, "all  EVENTS currently being\nmonitored").otherwise("other")
    text = F.concat(F.lit("cover\n--- PAGE 1 ---\n"), "text", F.lit("\n--- PAGE 2 ---\n"), mark, F.lit("\n--- PAGE 3 ---\nend"))
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", text.alias("text"))
    return T.table_pages(T.pages(docs), r"(?i)all\s+events\s+currently\s+being\s+monitored")


@register("picked_bulletins", """WITH b AS (SELECT DISTINCT o_custkey % 52 + 1 AS week, 2020 + o_custkey % 6 AS year FROM orders),
r AS (SELECT week, year, row_number() OVER (PARTITION BY week ORDER BY (year = 2022) DESC, year DESC) AS n FROM b)
SELECT CAST(week AS INT) AS week, CAST(year AS INT) AS year FROM r WHERE n = 1""")
def picked_bulletins(spark, sf_dir):
    from tessera.plans import pipelines

    rows = table(spark, sf_dir, "orders").selectExpr("int(o_custkey % 52 + 1) AS week", "int(2020 + o_custkey % 6) AS year").distinct()
    return pipelines.pick_bulletins(rows, 2022)


# ------------------------------------------------- linked runs, versions, keys


@register("linked_runs", """WITH m AS (SELECT l_orderkey, max(l_partkey) AS p FROM lineitem WHERE l_linenumber < 3 GROUP BY 1)
SELECT o_orderkey AS id, c_mktsegment AS preprocessing_method, c_nationkey % 2 = 0 AS preprocessing_success, p IS NOT NULL AS has_metrics, CAST(p AS BIGINT) AS part FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND o_orderkey % 4 > 0 LEFT JOIN m ON l_orderkey = o_orderkey""")
def linked_runs(spark, sf_dir):
    """Runs name a preprocessing, but for every fourth; documents come from the first lines of orders."""
    runs = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "if(o_orderkey % 4 > 0, o_custkey, NULL) AS preprocessing_id")
    before = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS method", "c_nationkey % 2 = 0 AS success")
    metrics = table(spark, sf_dir, "lineitem").filter("l_linenumber < 3").selectExpr("l_orderkey AS id", "format_string('{\"part\":%010d}', l_partkey) AS metrics")
    found = L.linked_runs(runs, before, metrics)
    return found.select("id", "preprocessing_method", "preprocessing_success", "has_metrics", F.regexp_extract("accuracy_document", r":(\d+)", 1).cast("long").alias("part"))


@register("current_versions", """WITH r AS (SELECT p_brand AS kind, concat('v', p_size, '.', p_partkey % 10, '.', p_partkey % 3) AS version, [CAST(p_size AS INT), CAST(p_partkey % 10 AS INT), CAST(p_partkey % 3 AS INT)] AS k, p_partkey % 41 = 0 AS cur FROM part)
SELECT kind, coalesce(arg_max(version, k) FILTER (cur), arg_max(version, k)) AS version, count(DISTINCT version) AS versions, bool_or(cur) AS marked FROM r GROUP BY kind""")
def current_versions(spark, sf_dir):
    return L.current_versions(table(spark, sf_dir, "part").selectExpr("p_brand AS kind", "concat('v', p_size, '.', p_partkey % 10, '.', p_partkey % 3) AS version", "p_partkey % 41 = 0 AS is_current"))


@register("models_by_version", "SELECT concat('v', p_size) AS version, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS models FROM part GROUP BY 1")
def models_by_version(spark, sf_dir):
    found = L.models_by_version(table(spark, sf_dir, "part").selectExpr("concat('v', p_size) AS version", "p_brand AS model"))
    return found.select("version", F.array_join("models", ",").alias("models"))


@register("derived_keys", """SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN concat(n_name, '_', o_orderpriority) END AS both_key, concat(CASE WHEN o_orderkey % 7 > 0 THEN n_name ELSE 'nan' END, '_', o_orderpriority, '_', o_orderkey % 53) AS week_key,
  concat(2020 + o_orderkey % 6, '-', o_orderkey % 52 + 1) AS year_week, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_custkey AS DOUBLE) / (o_orderkey % 5) END AS ratio, coalesce(o_orderkey % 7 > 0 AND n_nationkey % 2 = 0, false) AS verified
FROM orders JOIN nation ON n_nationkey = o_custkey % 25""")
def derived_keys(spark, sf_dir):
    own = F.col("n_nationkey") == F.col("o_custkey") % 25
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "nation"), own).withColumn("Country", F.when(F.col("o_orderkey") % 7 > 0, F.col("n_name")))
    file = F.concat(F.lit("Week_"), (F.col("o_orderkey") % 52 + 1).cast("string"), F.lit("__1_-_7_May_"), (2020 + F.col("o_orderkey") % 6).cast("string"), F.lit(".pdf"))
    checked = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("elsewhere")
    return rows.select(
        "o_orderkey", S.composite_key(F.col("Country"), F.col("o_orderpriority")).alias("both_key"), S.text_key(F.col("Country"), F.col("o_orderpriority"), F.col("o_orderkey") % 53, sep="_").alias("week_key"),
        names.year_week(file, pad=False).alias("year_week"), S.ratio(F.col("o_custkey"), F.col("o_orderkey") % 5).alias("ratio"), S.verified(F.col("Country"), checked).alias("verified"),
    )


@register("cells_by_header", "SELECT p_partkey, CAST(p_partkey * 1000 + 7 AS BIGINT) AS Total_Cases, CAST(p_size AS BIGINT) AS Deaths, CAST(p_size / 10.0 AS DOUBLE) AS CFR, p_name AS Event FROM part")
def cells_by_header(spark, sf_dir):
    """Cells cleaned by what their header says; line breaks leave the headers."""
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_partkey, ',007') AS `Total\nCases`", "concat(p_size, ' *') AS Deaths", "concat(p_size / 10.0, '%') AS `CFR\n(%)`", "p_name AS Event")
    part = names.positional_headers(part, [])
    cleaned = {h: S.cell_by_header(F.lit(h), F.col(f"`{h}`")) for h in part.columns[1:]}
    return part.select("p_partkey", cleaned["Total Cases"].cast("long").alias("Total_Cases"), cleaned["Deaths"].cast("long").alias("Deaths"), cleaned["CFR (%)"].cast("double").alias("CFR"), cleaned["Event"].alias("Event"))

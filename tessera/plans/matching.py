"""Queries of names in texts, of numbering and of broken JSON, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import jsontext as J
from tessera.operators import corrections as C
from tessera.operators import logs as L
from tessera.operators import narrative, reconcile
from tessera.operators.textmatch import held, text_key
from tessera.plans.catalog import register
from tessera.plans.harness import PAIRS_SQL, SIDES_SQL, side_a, side_b
from tessera.session import ship_package, table

# Names that texts hold: of nations, of sources and languages, and the words that parts' names are made of.
_NAMES = "SELECT lower(n_name) AS name FROM nation UNION SELECT source FROM documents UNION SELECT lang FROM documents UNION SELECT lower(p_type) FROM part UNION SELECT concat(' ', p_size, ' ') FROM part"


@register("names_in_documents", f"""WITH names AS ({_NAMES}), texts AS (SELECT doc_id, lower(text) AS text FROM documents)
SELECT doc_id, name FROM texts JOIN names ON contains(text, name)""")
def names_in_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    names = L.sql(spark, _NAMES.replace("FROM nation", "FROM {nation}").replace("FROM documents", "FROM {documents}").replace("FROM part", "FROM {part}"),
                  **{t: table(spark, sf_dir, t) for t in ("nation", "documents", "part")})
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(held(docs, names), "key").select("doc_id", "name")


@register("linked_documents", """WITH r AS (SELECT DISTINCT n_name AS Country, substr(c_mktsegment, 1, 4) AS Event FROM customer JOIN nation ON c_nationkey = n_nationkey),
b AS (SELECT doc_id, lower(concat(text, ' ', n_name, ' 1')) AS t FROM documents JOIN nation ON n_nationkey = doc_id % 25 WHERE text IS NOT NULL)
SELECT doc_id, Country, Event, CASE WHEN contains(t, lower(Country)) AND contains(t, lower(Event)) THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END AS score
FROM b JOIN r ON contains(t, lower(Country)) OR contains(t, lower(Event))""")
def linked_documents(spark, sf_dir):
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("Country"), F.substring("c_mktsegment", 1, 4).alias("Event")).distinct()
    docs = table(spark, sf_dir, "documents").join(nation, F.col("n_nationkey") == F.col("doc_id") % 25).filter("text IS NOT NULL")
    return C.linked(rows, docs.select("doc_id", F.concat("text", F.lit(" "), "n_name", F.lit(" 1")).alias("text"))).select("doc_id", "Country", "Event", "score")


@register("segments_of_records", """WITH d AS (SELECT doc_id, n_name AS Country, unnest(string_split(concat(text, chr(10), n_name, ' reports one two three four five six seven eight nine ten'), chr(10))) AS line, source FROM documents JOIN nation ON n_nationkey = doc_id % 25 WHERE text IS NOT NULL)
SELECT doc_id, Country, source AS Event, count(*) AS told FROM d WHERE contains(lower(line), lower(Country)) AND ends_with(line, 'six seven eight nine ten') GROUP BY ALL""")
def segments_of_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("doc_id") % 25).filter("text IS NOT NULL")
    text = F.concat("text", F.lit("\n"), "n_name", F.lit(" reports one two three four five six seven eight nine ten"))
    records = docs.select("doc_id", F.col("n_name").alias("Country"), F.col("source").alias("Event"))
    segments = docs.select("doc_id", F.posexplode(F.split(text, "\n")).alias("block_no", "text"))
    found = narrative.segments_of_records(records, segments).filter("narrative IS NOT NULL")
    named = F.regexp_count(F.col("narrative"), F.lit(" reports one two three four five six seven eight nine ten"))
    return found.select("doc_id", "Country", "Event", named.cast("long").alias("told"))


@register("numbered_rows", "SELECT l_orderkey, l_linenumber, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS id FROM lineitem")
def numbered_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return L.numbered(rows, ["l_orderkey", "l_linenumber"], table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))


@register("unknown_metrics_updates", "SELECT event_id * 2 AS id, '{}' AS metrics FROM events WHERE event_id * 2 NOT IN (SELECT event_id FROM events)")
def unknown_metrics_updates(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return L.unknown_updates(events.select(F.col("event_id").alias("id")), events.select((F.col("event_id") * 2).alias("id"), F.lit("{}").alias("metrics")))


_CUT = "CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 40 END"
_BODY = """concat('{"records": [{"id": ', o_orderkey, ', "note": "} ] a"}, {"id": 2, "in": [{"k": 1}]}, {"id": 3, "note": "b \\\\" {"}]}')"""


@register("salvaged_records", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS n, CAST(o_orderkey AS BIGINT) AS first FROM orders""")
def salvaged_records(spark, sf_dir):
    """An envelope an order, cut at its end by 0, 3, 1 or 40 characters."""
    ship_package(spark)
    text = F.expr(f"substring({_BODY}, 1, length({_BODY}) - {_CUT})")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", J.salvaged_column(text).alias("saved"))
    records = F.from_json(F.get_json_object("saved", "$.records"), "array<struct<id: bigint>>")
    return rows.select("o_orderkey", F.size(records).alias("n"), F.get(records, F.lit(0))["id"].alias("first"))


_RESPONSE = """CASE o_orderkey % 6
  WHEN 0 THEN concat('```json', chr(10), '{"corrections": [{"f": ', o_orderkey, '}, {"f": [1, 2]}], "summary": {"n": 2}}', chr(10), '```')
  WHEN 1 THEN concat('{"corrections": {"f": ', o_orderkey, '}, "summary": "two"}')
  WHEN 2 THEN concat('As asked: "corrections": [{"f": ', o_orderkey, '}, {"f": [1, 2]}], and no more')
  WHEN 3 THEN concat('{"corrections": [{"f": ', o_orderkey, '}, {"f": [1, 2')
  WHEN 4 THEN concat('sorry, order ', o_orderkey, ' has none') ELSE '{"summary": {}}' END"""


@register("parsed_corrections", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 2 THEN 'salvaged' WHEN 3 THEN 'salvaged' WHEN 4 THEN 'failed' ELSE 'parsed' END AS status,
  CASE o_orderkey % 6 WHEN 0 THEN concat('{"f":', o_orderkey, '};{"f":[1,2]}') WHEN 2 THEN concat('{"f":', o_orderkey, '};{"f":[1,2]}') WHEN 3 THEN concat('{"f":', o_orderkey, '}') ELSE '' END AS corrections,
  CASE o_orderkey % 6 WHEN 0 THEN '{"n":2}' WHEN 2 THEN '{"recovery_attempted":true}' WHEN 3 THEN '{"recovery_attempted":true}' ELSE '{}' END AS summary FROM orders""")
def parsed_corrections(spark, sf_dir):
    ship_package(spark)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", J.corrections(F.expr(_RESPONSE)).alias("c"))
    return rows.select("o_orderkey", "c.status", F.array_join("c.corrections", ";").alias("corrections"), "c.summary")


@register("reconciled_sides", f"""WITH {SIDES_SQL}
SELECT Country, count(*) AS n, count(CASE WHEN a.TotalCases IS NULL THEN 1 END) AS right_only, count(CASE WHEN b.TotalCases IS NULL THEN 1 END) AS left_only,
  CAST(sum(coalesce(a.TotalCases, 0)) AS BIGINT) AS left_total, CAST(sum(coalesce(b.TotalCases, 0)) AS BIGINT) AS right_total,
  count(CASE WHEN abs(a.Deaths - b.Deaths) > 0.01 THEN 1 END) AS deaths_differ
FROM side_a a FULL JOIN side_b b USING (Country, Event, Year, WeekNumber) GROUP BY Country""")
def reconciled_sides(spark, sf_dir):
    both = reconcile.reconciled(side_a(spark, sf_dir), side_b(spark, sf_dir))
    return both.groupBy("Country").agg(
        F.count("*").alias("n"), F.count_if(~F.col("in_left")).alias("right_only"), F.count_if(~F.col("in_right")).alias("left_only"),
        F.sum(F.coalesce("llm_TotalCases", F.lit(0))).alias("left_total"), F.sum(F.coalesce("rule_based_TotalCases", F.lit(0))).alias("right_total"),
        F.count_if("Deaths_discrepancy").alias("deaths_differ"),
    )


@register("comparison_reports", "WITH " + PAIRS_SQL + """ SELECT Year, WeekNumber, count(*) AS discrepancies FROM pairs
WHERE TotalCases_discrepancy OR CasesConfirmed_discrepancy OR Deaths_discrepancy OR CFR_discrepancy OR Grade_discrepancy GROUP BY 1, 2""")
def comparison_reports(spark, sf_dir):
    """All frames of the report from one join; here its discrepancies a week."""
    return reconcile.report(side_a(spark, sf_dir), side_b(spark, sf_dir))["discrepancies"].groupBy("Year", "WeekNumber").agg(F.count("*").alias("discrepancies"))


# ------------------------------------------------------- tables by their headers

_HEAD = """CASE o_custkey % 3 WHEN 0 THEN array('Country', 'Event', 'Grade', 'Total cases', 'Cases Confirmed', 'Deaths', 'CFR')
  WHEN 1 THEN array('Event name', 'COUNTRY', 'Deaths so far', 'Total  cases', 'Cases Confirmed', 'CFR (%)') ELSE array('New events') END"""
_DATA = """CASE WHEN o_orderkey % 7 = 0 THEN array('Ongoing events') WHEN o_custkey % 3 = 0 THEN array(land, o_orderpriority, 'Grade 1', total, sure, dead, '1.5%')
  WHEN o_custkey % 3 = 1 THEN array(o_orderpriority, land, dead, total, sure, '1.5%') ELSE array(land, o_orderpriority, 'Grade 1', 'd', 's', 'e', total, sure, dead, '1.5%') END"""


@register("reconstructed_tables", """SELECT o_orderkey AS row_no, concat('Land ', o_custkey % 25) AS Country, o_orderpriority AS Event, CASE WHEN o_custkey % 3 = 1 THEN '' ELSE 'Grade 1' END AS Grade,
  CASE WHEN o_custkey % 3 = 2 THEN 'd' ELSE '' END AS Date_Notified, CAST(o_custkey * 1000 AS BIGINT) AS Total_Cases, CAST(o_orderkey % 50 AS BIGINT) AS Confirmed_Cases, CAST(o_orderkey % 9 AS BIGINT) AS Deaths, CAST(1.5 AS DOUBLE) AS CFR
FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL
SELECT NULL, concat('Land ', chr(CAST(65 + n_nationkey AS INTEGER))), 'Cholera', 'Grade 2', '', 100 + n_nationkey, 10, 3, 1.5 FROM nation""")
def reconstructed_tables(spark, sf_dir):
    """A table a customer, with headers of two kinds or none; records of nations stand in text."""
    from tessera.operators import tables

    orders = table(spark, sf_dir, "orders").selectExpr("*", "concat('Land ', o_custkey % 25) AS land", "concat(o_custkey, ',000') AS total", "string(o_orderkey % 50) AS sure", "string(o_orderkey % 9) AS dead")
    data = orders.selectExpr("o_custkey AS table_id", "o_orderkey AS row_no", f"{_DATA} AS cells")
    heads = orders.select("o_custkey").distinct().selectExpr("o_custkey AS table_id", "-1L AS row_no", f"{_HEAD} AS cells")
    texts = table(spark, sf_dir, "nation").selectExpr("-1L - n_nationkey AS table_id", "concat('Land ', chr(int(65 + n_nationkey)), ' Cholera Grade 2 cases ', 100 + n_nationkey, ' and 10 then 3 rate 1.5% end') AS text")
    return tables.reconstructed(data.unionByName(heads), texts).select("row_no", "Country", "Event", "Grade", "Date_Notified", "Total_Cases", "Confirmed_Cases", "Deaths", "CFR")


# ------------------------------------------------- extraction files, end to end


def _extractions(df, model: str, run: int):
    fields = ["Country", "Event", "Grade", "TotalCases", "CasesConfirmed", "Deaths", "CFR"]
    return df.select(F.format_string(f"OEW%02d-%d_{model}_{run}", "WeekNumber", "Year").alias("name"), *fields)


def _written(spark, sf_dir, name: str) -> str:
    """side_a as files of a model, an older run of half the weeks among them."""
    from tessera.plans.operations import scratch
    from tessera.sources import sinks

    folder, rows = scratch(spark, name), side_a(spark, sf_dir)
    sinks.write_named(_extractions(rows.filter("WeekNumber < 3").withColumn("Country", F.lit("nobody")), "gpt-x", 1), folder)
    sinks.write_named(_extractions(rows, "gpt-x", 2), folder)
    return folder


@register("reconciled_extractions", f"""WITH {SIDES_SQL}, j AS (SELECT Year, WeekNumber, a.nk AS l, b.nk AS r FROM side_a a FULL JOIN side_b b USING (Year, WeekNumber, Country, Event))
SELECT Year, WeekNumber, count(l) AS LLMRecords, count(r) AS RuleBasedRecords, count(*) - count(r) AS LLMOnly, count(*) - count(l) AS RuleBasedOnly FROM j GROUP BY ALL""")
def reconciled_extractions(spark, sf_dir):
    """From files of two sources, the newest run of each week, to the summary."""
    from tessera.plans import pipelines
    from tessera.plans.operations import scratch
    from tessera.sources import sinks

    rules = scratch(spark, "rule_files")
    sinks.write_named(_extractions(side_b(spark, sf_dir), "rule", 5), rules)
    summary = pipelines.reconcile_extractions(spark, _written(spark, sf_dir, "model_files"), rules)["summary"]
    return summary.select("Year", "WeekNumber", "LLMRecords", "RuleBasedRecords", "LLMOnly", "RuleBasedOnly")


@register("processed_raw", f"WITH {SIDES_SQL} SELECT Year, WeekNumber, count(*) AS records, count(*) AS in_master FROM side_a GROUP BY Year, WeekNumber")
def processed_raw(spark, sf_dir):
    from tessera.plans import pipelines
    from tessera.plans.operations import scratch

    master = scratch(spark, "raw_master")
    done = pipelines.process_raw(spark, _written(spark, sf_dir, "raw_files"), scratch(spark, "raw_processed"), master)
    there = spark.read.parquet(master).groupBy("Year", "WeekNumber").agg(F.count("*").alias("in_master"))
    return done.join(there, ["Year", "WeekNumber"])


@register("exported_calls", "SELECT concat('call_', user_id) AS name, event_id, event_type FROM events")
def exported_calls(spark, sf_dir):
    """A file a call; a second run adds the calls that the first lacked and no other."""
    from tessera.plans.operations import scratch
    from tessera.sources import files, sinks

    folder = scratch(spark, "calls")
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("call_"), F.col("user_id").cast("string")).alias("name"), "event_id", "event_type")
    sinks.write_named(rows.filter("name < 'call_5'"), folder)
    sinks.write_named(rows.withColumn("event_type", F.when(F.col("name") < "call_5", "overwritten").otherwise(F.col("event_type"))), folder)
    found = files.csv(spark, folder, columns=["event_id", "event_type"]).withColumn("name", F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", ""))
    return found.select("name", F.col("event_id").cast("long").alias("event_id"), "event_type")


# ------------------------------------------------ layout, pages, events, fields


@register("layout_blocks", """WITH s AS (SELECT l_suppkey AS doc_id, CAST(l_orderkey % 5 AS INTEGER) AS page, l_orderkey * 1.0 AS y0, l_linenumber * 10.0 AS x0, l_orderkey + CAST(l_quantity AS DOUBLE) AS y1, l_linenumber * 10.0 + 8 AS x1,
  concat(l_orderkey, '-', l_linenumber) AS text, l_tax * 100 AS size, l_returnflag AS font, l_linestatus = 'F' AS bold FROM lineitem),
a AS (SELECT *, max(y1) OVER (PARTITION BY doc_id, page ORDER BY y0, x0, text, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above FROM s),
b AS (SELECT *, sum(CASE WHEN above IS NULL OR y0 - above > y1 - y0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY y0, x0, text, y1 ROWS UNBOUNDED PRECEDING) - 1 AS block_no FROM a),
f AS (SELECT doc_id, page, block_no, font, row_number() OVER (PARTITION BY doc_id, page, block_no ORDER BY count(*) DESC, font) AS rn FROM b GROUP BY doc_id, page, block_no, font)
SELECT b.doc_id, b.page, CAST(b.block_no AS BIGINT) AS block_no, string_agg(text, ' ' ORDER BY y0, x0, text) AS text, CAST(max(y1) - min(y0) AS DOUBLE) AS height, round(avg(CAST(size AS DOUBLE)), 6) AS avg_size, any_value(f.font) AS dominant_font, bool_or(bold) AS has_bold
FROM b JOIN f ON b.doc_id = f.doc_id AND b.page = f.page AND b.block_no = f.block_no AND rn = 1 GROUP BY 1, 2, 3""")
def layout_blocks(spark, sf_dir):
    """Spans derived from line items: a page of a supplier's orders."""
    from tessera.operators import tables

    spans = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS doc_id", "int(l_orderkey % 5) AS page", "double(l_orderkey) AS y0", "l_linenumber * 10D AS x0", "l_orderkey + double(l_quantity) AS y1", "l_linenumber * 10D + 8 AS x1",
        "concat(l_orderkey, '-', l_linenumber) AS text", "l_tax * 100 AS size", "l_returnflag AS font", "l_linestatus = 'F' AS bold",
    )
    blocks = tables.text_blocks(spans)
    return blocks.select("doc_id", "page", "block_no", "text", (F.col("y1") - F.col("y0")).alias("height"), F.round(F.col("avg_size").cast("double"), 6).alias("avg_size"), "dominant_font", "has_bold")


@register("event_keywords", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat('cholera ', o_orderkey, ';cholera;vibrio cholerae') WHEN 1 THEN concat('yellow fever ', o_orderkey, ';yellow fever;yf')
  WHEN 2 THEN concat('mpox near ', o_orderkey, ';monkeypox;mpox;orthopoxvirus') ELSE concat('flood ', o_orderkey) END AS words FROM orders""")
def event_keywords(spark, sf_dir):
    from tessera.functions import names

    event = F.expr("concat(CASE o_orderkey % 4 WHEN 0 THEN 'CHOLERA ' WHEN 1 THEN 'Yellow Fever ' WHEN 2 THEN 'Mpox near ' ELSE 'Flood ' END, o_orderkey)")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(names.event_keywords(event), ";").alias("words"))


@register("guessed_fields", """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'Deaths' WHEN 1 THEN 'TotalCases' WHEN 2 THEN CASE WHEN abs(l_quantity - 50) < 5 THEN 'TotalCases' WHEN abs(l_quantity - 20) < 2 THEN 'CasesConfirmed' ELSE 'TotalCases' END END AS field FROM lineitem""")
def guessed_fields(spark, sf_dir):
    text = F.expr("concat(l_comment_, CASE l_linenumber % 4 WHEN 0 THEN ' people DIED' WHEN 1 THEN ' new infections' WHEN 2 THEN ' cases' ELSE ' other' END)")
    rows = table(spark, sf_dir, "lineitem").selectExpr("*", "concat('note ', l_partkey) AS l_comment_")
    value = F.when(F.col("l_linenumber") % 4 == 1, 50).otherwise(F.col("l_quantity"))
    return rows.select("l_orderkey", "l_linenumber", C.guessed_field(text, value, F.lit(50), F.lit(20)).alias("field"))


@register("backfilled_accuracy", f"""WITH {SIDES_SQL}, p AS (SELECT concat('1.', a.WeekNumber) AS version, a.Country AS model, abs(a.TotalCases - b.TotalCases) > 0.01 AS t, abs(a.CasesConfirmed - b.CasesConfirmed) > 0.01 AS c, abs(a.Deaths - b.Deaths) > 0.01 AS d, abs(a.CFR - b.CFR) > 0.01 AS r, a.Grade IS DISTINCT FROM b.Grade AS g
  FROM side_a a JOIN side_b b USING (Country, Event, Year, WeekNumber))
SELECT version, model, count(*) AS total_compared, count(CASE WHEN t OR c OR d OR r OR g THEN 1 END) AS total_discrepant FROM p WHERE NOT (version = '1.1' AND model IN (SELECT n_name FROM nation WHERE n_regionkey = 0)) GROUP BY ALL""")
def backfilled_accuracy(spark, sf_dir):
    """Accuracy by version (a quarter) and model (a nation), but for those that the log has."""
    from tessera.plans import pipelines

    pairs = reconcile.compared(side_a(spark, sf_dir), side_b(spark, sf_dir)).withColumns({"version": F.concat(F.lit("1."), F.col("WeekNumber").cast("string")), "model": F.col("Country")})
    logged = table(spark, sf_dir, "nation").filter("n_regionkey = 0").select(F.lit("1.1").alias("version"), F.col("n_name").alias("model"))
    done = pipelines.backfill(pairs, logged)
    return done.select("version", "model", *[F.col(c).cast("long") for c in ("total_compared", "total_discrepant")])


@register("page_paragraphs", """WITH p AS (SELECT doc_id, unnest(regexp_split_to_array(concat(text, chr(10), chr(10), 'page two of ', doc_id), '\\n\\s*\\n')) AS para FROM documents WHERE text IS NOT NULL)
SELECT doc_id, count(*) AS n FROM p WHERE regexp_matches(para, '\\S') GROUP BY doc_id""")
def page_paragraphs(spark, sf_dir):
    from tessera.operators import tables

    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    marked = docs.select("doc_id", F.concat(F.lit("--- PAGE 1 ---\n"), "text", F.lit("\n--- PAGE 2 ---\npage two of "), F.col("doc_id").cast("string")).alias("text"))
    return tables.paragraphs(tables.pages(marked)).groupBy("doc_id").agg(F.count("*").alias("n"))

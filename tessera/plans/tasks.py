"""Queries over cleaning steps, readers, writers and small predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tessera.functions import names as N
from tessera.functions import scalars as S
from tessera.operators import cleaning, logs, metrics, narrative, tables
from tessera.operators import corrections as C
from tessera.plans import pipelines
from tessera.plans.catalog import register
from tessera.plans.harness import SIDES_SQL, side_a
from tessera.plans.operations import events, scratch
from tessera.session import table
from tessera.sources import files, sinks


def orders(spark, sf_dir, *columns):
    return table(spark, sf_dir, "orders").selectExpr(*columns)


@register("model_predicates", """WITH m AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'GPT-5' WHEN 1 THEN 'OpenAI/x' WHEN 2 THEN 'mistral' ELSE 'nick' END || CASE WHEN event_id % 3 = 0 THEN '_RECOVERED' ELSE '' END AS model FROM events)
SELECT event_id, NOT ends_with(model, 'RECOVERED') AS original, lower(model) LIKE '%gpt-%' OR lower(model) LIKE 'openai/%' AS provided, CASE WHEN model = 'nick' THEN 'full/name' ELSE model END AS identifier FROM m""")
def model_predicates(spark, sf_dir):
    model = F.expr("concat(CASE event_id % 4 WHEN 0 THEN 'GPT-5' WHEN 1 THEN 'OpenAI/x' WHEN 2 THEN 'mistral' ELSE 'nick' END, CASE WHEN event_id % 3 = 0 THEN '_RECOVERED' ELSE '' END)")
    return events(spark, sf_dir).select("event_id", N.not_recovered(model).alias("original"), N.is_providers_model(model).alias("provided"), N.model_identifier(model, {"nick": "full/name"}).alias("identifier"))


_GRADE = "CASE o_orderkey % 4 WHEN 0 THEN 'Protracted 2' WHEN 1 THEN 'Grade 3' WHEN 2 THEN NULL ELSE 'not Protracted' END"


@register("grades_not_protracted", f"SELECT o_orderkey, {_GRADE} AS grade FROM orders WHERE coalesce({_GRADE}, 'nan') NOT LIKE '%Protracted%'")
def grades_not_protracted(spark, sf_dir):
    return orders(spark, sf_dir, "o_orderkey", f"{_GRADE} AS grade").filter(N.not_protracted(F.col("grade")))


_CELLS = "CASE s_suppkey % 4 WHEN 0 THEN 'New Events' WHEN 1 THEN s_name WHEN 2 THEN NULL ELSE ' ' END", "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'x' END", "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey AS {t}) END", "s_name"


@register("divider_rows", """WITH c AS (SELECT s_suppkey, {0} AS a, {1} AS b, {2} AS c, {3} AS d FROM supplier)
SELECT s_suppkey, coalesce(lower(a) LIKE '%new events%', false) OR (CASE WHEN trim(coalesce(a, '')) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(coalesce(b, '')) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(coalesce(c, '')) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(coalesce(d, '')) <> '' THEN 1 ELSE 0 END) < 3 AS divider FROM c""".format(*[x.format(t="VARCHAR") for x in _CELLS]))
def divider_rows(spark, sf_dir):
    cells = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", f"array({', '.join(x.format(t='STRING') for x in _CELLS)}) AS cells")
    return cells.select("s_suppkey", tables.is_divider(F.col("cells")).alias("divider"))


@register("dashed_cells", """WITH c AS (SELECT s_suppkey, coalesce({0}, '') AS a, {1} AS b, coalesce({2}, '') AS c, {3} AS d FROM supplier), k AS (SELECT *, CASE WHEN trim(a) = '' THEN '-' ELSE a END AS x, CASE WHEN trim(b) = '' THEN '-' ELSE b END AS y, CASE WHEN trim(c) = '' THEN '-' ELSE c END AS z FROM c)
SELECT s_suppkey, CAST(CASE WHEN trim(a) = '' THEN 1 ELSE 0 END + CASE WHEN trim(b) = '' THEN 1 ELSE 0 END + CASE WHEN trim(c) = '' THEN 1 ELSE 0 END AS INT) AS n, 'before ' || x || ' ' || y || ' ' || z || ' ' || d || ' after' AS page FROM k""".format(*[x.format(t="VARCHAR") for x in _CELLS]))
def dashed_cells(spark, sf_dir):
    cells = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", f"array({', '.join(x.format(t='STRING') for x in _CELLS)}) AS cells")
    page = F.concat(F.lit("before "), F.array_join(F.transform("cells", lambda c: F.coalesce(c, F.lit(""))), " "), F.lit(" after"))
    return cells.select("s_suppkey", tables.blank_cells(F.col("cells"))[1].alias("n"), tables.dashed_rows(page, F.col("cells")).alias("page"))


@register("changed_lines", "WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line FROM documents), n AS (SELECT doc_id, text, CAST(count(CASE WHEN contains(line, 'z') THEN 1 END) AS INT) AS n FROM l GROUP BY doc_id, text, doc_id) SELECT doc_id, max(n) AS n FROM n GROUP BY doc_id, text")
def changed_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", "text").distinct()
    return docs.select("doc_id", tables.changed_lines(F.col("text"), F.translate("text", "z", "s"))[0].alias("n"))


@register("rows_as_json", """SELECT n_nationkey, '{"row_id":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS record FROM nation""")
def rows_as_json(spark, sf_dir):
    return narrative.rows_as_json(table(spark, sf_dir, "nation"), "n_nationkey", ["n_name", "n_regionkey"])


@register("accuracy_text", """WITH m AS (SELECT event_type AS prompt_version, count(*) AS compared, count(CASE WHEN value > 50 THEN 1 END) AS discrepant FROM events GROUP BY 1)
SELECT prompt_version, 'Accuracy Analysis Summary (Prompt ' || prompt_version || ')' || chr(10) || '   Overall Accuracy: ' || (compared - discrepant) || '%' || chr(10) || '   Records Compared: ' || compared || chr(10) || '   Discrepant Records: ' || discrepant || chr(10) || '   Coverage Rate: 100%' || chr(10) || '   Deaths: ' || discrepant || '%' AS summary FROM m""")
def accuracy_text(spark, sf_dir):
    rows = events(spark, sf_dir).groupBy(F.col("event_type").alias("prompt_version")).agg(F.count("*").alias("compared"), F.count(F.when(F.col("value") > 50, 1)).alias("discrepant"))
    rows = rows.withColumns({"overall_accuracy": F.col("compared") - F.col("discrepant"), "coverage": F.lit(100), "Deaths": F.col("discrepant")})
    return metrics.accuracy_text(rows, ("Deaths",)).select("prompt_version", "summary")


@register("metadata_file_names", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'named.pdf' WHEN 1 THEN 'OEW' || lpad(CAST(o_custkey % 53 AS VARCHAR), 2, '0') || '-2024.pdf' ELSE 'f' || o_custkey || '.pdf' END AS file FROM orders""")
def metadata_file_names(spark, sf_dir):
    rows = orders(spark, sf_dir, "o_orderkey", "concat('http://h/a/f', o_custkey, IF(o_orderkey % 2 = 0, '.pdf', '')) AS url", "IF(o_orderkey % 3 = 0, 'named.pdf', NULL) AS name", "IF(o_orderkey % 3 < 2, o_custkey % 53, NULL) AS week", "2024 AS year")
    return rows.select("o_orderkey", N.metadata_file_name(*[F.col(c) for c in ("url", "name", "week", "year")]).alias("file"))


@register("week_formats", "WITH y AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE year(o_orderdate) || '-' || month(o_orderdate) END AS yw FROM orders) SELECT count(yw) AS n, count(DISTINCT yw) AS n_distinct, count(CASE WHEN regexp_matches(yw, '^\\d{4}-\\d$') THEN 1 END) AS single, count(CASE WHEN regexp_matches(yw, '^\\d{4}-\\d{2}$') THEN 1 END) AS double FROM y")
def week_formats(spark, sf_dir):
    rows = orders(spark, sf_dir, "IF(o_orderkey % 7 = 0, NULL, concat(year(o_orderdate), '-', month(o_orderdate))) AS yw")
    return metrics.format_counts(rows, "yw", {"single": r"^\d{4}-\d$", "double": r"^\d{4}-\d{2}$"})


@register("stage_averages", "SELECT event_type, count(*) AS n, round_even(avg(event_id), 6) AS avg_confidence, round_even(avg(value), 6) AS avg_seconds, max(value) AS longest FROM events GROUP BY 1")
def stage_averages(spark, sf_dir):
    return metrics.stage_averages(events(spark, sf_dir), "event_type", "event_id", "value")


@register("version_text_sort", "SELECT v, CAST(row_number() OVER (ORDER BY v) AS INT) AS place FROM (SELECT DISTINCT 'v1.' || n_nationkey || '.0' AS v FROM nation)")
def version_text_sort(spark, sf_dir):
    versions = table(spark, sf_dir, "nation").selectExpr("concat('v1.', n_nationkey, '.0') AS v").distinct()
    return versions.agg(F.sort_array(F.collect_set("v")).alias("vs")).select(F.posexplode("vs").alias("p", "v")).select("v", (F.col("p") + 1).cast("int").alias("place"))


@register("recent_runs", "SELECT event_id, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def recent_runs(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("timestamp", F.col("ts").cast("timestamp"))
    return logs.since(rows.join(F.broadcast(rows.agg(F.max("timestamp").alias("now")))), F.col("now")).select("event_id", "value")


_RAW = {"reporting_date": "CASE WHEN o_orderkey % 5 = 0 THEN 'invalid' ELSE '2024-01-15' END", "country": "o_orderpriority", "suspected_cases": "CASE o_orderkey % 3 WHEN 0 THEN '1,500' WHEN 1 THEN 'bad' ELSE CAST(o_custkey AS {t}) END", "case_fatality_rate": "CASE WHEN o_orderkey % 2 = 0 THEN '3.3%' END"}


@register("typed_records", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 1705276800000000 END AS date_us, o_orderpriority AS country, CAST(CASE o_orderkey % 3 WHEN 0 THEN 1500 WHEN 1 THEN NULL ELSE o_custkey END AS BIGINT) AS suspected_cases, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 3.3 END AS DOUBLE) AS case_fatality_rate, CAST(NULL AS BIGINT) AS deaths FROM orders")
def typed_records(spark, sf_dir):
    schema = StructType([StructField("o_orderkey", table(spark, sf_dir, "orders").schema["o_orderkey"].dataType), *cleaning.RECORD.fields])
    rows = cleaning.typed(orders(spark, sf_dir, "o_orderkey", *[f"{v.format(t='STRING')} AS {k}" for k, v in _RAW.items()]), schema)
    return rows.select("o_orderkey", F.unix_micros("reporting_date").alias("date_us"), "country", "suspected_cases", "case_fatality_rate", "deaths")


@register("cast_where_possible", "SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS deaths, CASE WHEN o_orderkey % 2 = 0 THEN 'x' ELSE '1' END AS confirmed_cases FROM orders")
def cast_where_possible(spark, sf_dir):
    return cleaning.cast_where_possible(orders(spark, sf_dir, "o_orderkey", "string(o_custkey) AS deaths", "IF(o_orderkey % 2 = 0, 'x', '1') AS confirmed_cases"))


@register("cleaned_table", f"WITH {SIDES_SQL} SELECT Country, Event, Year, WeekNumber, CAST(TotalCases AS DOUBLE) AS TotalCases, CASE WHEN nk % 2 = 0 THEN 0.0 ELSE CAST(Deaths AS DOUBLE) END AS Deaths, CASE WHEN nk % 3 = 0 THEN NULL ELSE Grade END AS Grade FROM side_a")
def cleaned_table(spark, sf_dir):
    raw = side_a(spark, sf_dir).selectExpr("Country", "Event", "Year", "WeekNumber", "format_number(TotalCases, 0) AS `Total cases`", "IF(nk % 2 = 0, 'n/a', string(Deaths)) AS Deaths", "IF(nk % 3 = 0, 'nan', Grade) AS Grade")
    return cleaning.clean(raw, "rule").select("Country", "Event", "Year", "WeekNumber", "TotalCases", "Deaths", "Grade")


@register("raw_rule_table", "SELECT o_orderkey, 'two lines' AS Event, CASE WHEN o_orderkey % 3 = 0 THEN '012' ELSE '1234' END AS \"Total cases\", CASE WHEN o_orderkey % 5 = 0 THEN '1.5' ELSE '0' END AS CFR FROM orders WHERE o_orderkey % 4 > 0")
def raw_rule_table(spark, sf_dir):
    raw = orders(spark, sf_dir, "o_orderkey", "' two\nlines ' AS Event", "IF(o_orderkey % 4 = 0, NULL, 'Grade 1') AS Grade", "IF(o_orderkey % 3 = 0, '-12', '1,2 34') AS `Total cases`", "IF(o_orderkey % 5 = 0, '1,5%', '-') AS CFR")
    return cleaning.clean_rule_table(raw).select("o_orderkey", "Event", "Total cases", "CFR")


@register("final_format", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name AS Country, CASE WHEN n_regionkey = 0 THEN 'N/A' ELSE CAST(n_regionkey AS VARCHAR) END AS Grade, 'N/A' AS Deaths FROM nation")
def final_format(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "concat(' ', n_name, ' ') AS Country", "IF(n_regionkey = 0, NULL, n_regionkey) AS Grade")
    return cleaning.final_format(rows, ["n_nationkey", "Country", "Grade", "Deaths"])


_HEADERS = "CASE o_orderkey % 5 WHEN 0 THEN concat(o_clerk_, '  Country   Name') WHEN 1 THEN concat('TOTAL   CASES ', o_clerk_) WHEN 2 THEN concat(o_clerk_, ' reported') WHEN 3 THEN 'CFR (%)' ELSE concat('Start of', chr(10), 'reporting ', o_clerk_) END"


@register("header_names", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Country' WHEN 1 THEN 'Total_Cases' WHEN 2 THEN concat('C', o_custkey, '_reported') WHEN 3 THEN 'CFR' ELSE 'Start_Date' END AS name FROM orders""")
def header_names(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "concat('C', o_custkey) AS o_clerk_").selectExpr("o_orderkey", f"{_HEADERS} AS header")
    return rows.select("o_orderkey", tables.header_field(F.col("header")).alias("name"))


@register("confidence_scores", "SELECT event_id, least(greatest(value / 100 + CASE WHEN event_id % 2 = 0 THEN 0.15 ELSE 0 END + CASE WHEN event_id % 3 = 0 THEN 0.1 ELSE 0 END, 0), 1) AS score FROM events")
def confidence_scores(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", S.confidence(F.col("value") / 100, F.col("event_id") % 2 == 0, F.col("event_id") % 3 == 0).alias("score"))


@register("best_corrections", "SELECT user_id, event_type AS field, arg_max(event_id, (value, event_id)) AS new_value, max(value) AS confidence FROM events GROUP BY 1, 2")
def best_corrections(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", F.col("event_type").alias("field"), F.col("event_id").alias("new_value"), F.col("value").alias("confidence"))
    return C.best_per_field(rows, ["user_id"])


_HEADER = "CASE o_orderkey % 3 WHEN 0 THEN ' Country Event Grade ' WHEN 1 THEN 'total cases Confirmed Deaths CFR' ELSE 'plain text' END"


@register("section_headers", f"SELECT o_orderkey, trim({_HEADER}) AS header FROM orders WHERE o_orderkey % 3 < 2")
def section_headers(spark, sf_dir):
    return tables.section_headers(orders(spark, sf_dir, "o_orderkey", f"{_HEADER} AS line")).select("o_orderkey", "header")


_PAGE = "CASE o_custkey % 4 WHEN 0 THEN 'All events currently being monitored by WHO AFRO' WHEN 1 THEN 'all events currently being monitored; New Events; ongoing events; events reported during the reporting period' WHEN 2 THEN 'all events currently being monitored' ELSE 'nothing' END"


@register("bulletin_formats", "SELECT o_orderkey AS doc_id, CASE o_custkey % 4 WHEN 0 THEN 'legacy' WHEN 1 THEN 'intermediate' WHEN 2 THEN CASE WHEN o_orderkey % 6 + 1 <= 4 THEN 'modern' ELSE 'legacy' END ELSE 'modern' END AS format FROM orders")
def bulletin_formats(spark, sf_dir):
    return N.bulletin_format(orders(spark, sf_dir, "o_orderkey AS doc_id", "o_orderkey % 6 + 1 AS page", f"{_PAGE} AS text"))


@register("weekly_ingest", f"WITH {SIDES_SQL} SELECT Country, Event, Year, WeekNumber, CASE WHEN WeekNumber = 2 THEN TotalCases + 1 ELSE TotalCases END AS TotalCases FROM side_a")
def weekly_ingest(spark, sf_dir):
    rows = side_a(spark, sf_dir).select("Country", "Event", "Year", "WeekNumber", "TotalCases")
    fresh = rows.filter("WeekNumber = 2").withColumns({"TotalCases": F.col("TotalCases") + 1, "ingested_at": F.lit(2)})
    return pipelines.weekly_ingest(rows.withColumn("ingested_at", F.lit(1)), fresh).drop("ingested_at")


@register("roundtrip_csv_folder", "SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, true AS named FROM part")
def roundtrip_csv_folder(spark, sf_dir):
    path = scratch(spark, "folder")
    sinks.write_csv(table(spark, sf_dir, "part").selectExpr("p_partkey AS key", "p_name AS name"), path)
    return files.csv_folder(spark, path).select("key", "name", F.col("SourceFile").endswith(".csv").alias("named"))


@register("roundtrip_run_files", "SELECT n_nationkey AS id, n_name AS name, NULL AS region FROM nation UNION ALL SELECT 100 + n_nationkey, n_name, n_regionkey FROM nation")
def roundtrip_run_files(spark, sf_dir):
    path, rows = scratch(spark, "runs"), table(spark, sf_dir, "nation")
    sinks.append_run(rows.selectExpr("n_nationkey AS id", "n_name AS name"), path)
    sinks.append_run(rows.selectExpr("n_nationkey + 100 AS id", "n_name AS name", "n_regionkey AS region"), path)
    return files.parquet_logs(spark, path)


@register("roundtrip_json_folder", "SELECT n_nationkey AS id, n_name AS name, true AS tagged FROM nation")
def roundtrip_json_folder(spark, sf_dir):
    path = scratch(spark, "arrays")
    rows = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))))).alias("value"))
    # A file holds one array, as a document's records do.
    rows.repartition(64, "n_regionkey").withColumn("r", F.col("n_regionkey")).select("r", "value").write.option("lineSep", "\n").partitionBy("r").text(f"{path}/arrays")
    return files.json_array(spark, f"{path}/arrays").select(F.col("id").cast("int").alias("id"), "name", F.lit(True).alias("tagged"))


@register("written_reports", "SELECT 'counts' AS report, CAST(r_regionkey AS VARCHAR) AS key, r_name AS value FROM region")
def written_reports(spark, sf_dir):
    path, rows = scratch(spark, "reports"), table(spark, sf_dir, "region").selectExpr("r_regionkey AS key", "r_name AS value")
    done = sinks.write_reports({"counts": rows, "none": rows.limit(0)}, path, sinks.report_prefix([3, 5], 2025))
    out = [files.csv(spark, f"{path}/OEW03-05-2025_{name}").select(F.lit(name).alias("report"), "key", "value") for name in done]
    return out[0] if len(out) == 1 else out[0].limit(0)


@register("corrected_sinks", "SELECT n_nationkey AS id, n_name AS name, true AS both FROM nation")
def corrected_sinks(spark, sf_dir):
    path, rows = scratch(spark, "corrected"), table(spark, sf_dir, "nation").selectExpr("n_nationkey AS id", "n_name AS name")
    sinks.write_corrected(rows, rows.limit(1), path)
    as_csv = files.csv(spark, f"{path}/records_csv").select(F.col("id").cast("int").alias("id"), F.col("name").alias("other"))
    as_json = files.json_lines(spark, f"{path}/records_json", rows.schema)
    return as_json.join(as_csv, "id").select("id", "name", (F.col("name") == F.col("other")).alias("both"))


@register("migrated_log", "SELECT event_id, epoch_us(ts) AS at_us FROM events")
def migrated_log(spark, sf_dir):
    path = scratch(spark, "migrated")
    sinks.migrate_table(events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").cast("string").alias("timestamp")), path)
    return spark.read.parquet(path).select("event_id", F.unix_micros("timestamp").alias("at_us"))


@register("still_valid", f"""WITH {SIDES_SQL}, g AS (SELECT Country, count(*) AS n, count(CASE WHEN TotalCases >= 100 THEN 1 END) AS kept, count(CASE WHEN TotalCases < 100 THEN 1 END) AS gone FROM side_a GROUP BY Country),
t AS (SELECT sum(n) AS n, sum(kept) AS kept FROM g)
SELECT Country, true AS cleaned, gone = 0 AS filtered, false AS blanked FROM g""")
def still_valid(spark, sf_dir):
    """By country: cleaned rows, rows without small counts, rows whose events are blanked."""
    rows = side_a(spark, sf_dir)
    checked = lambda after, name: cleaning.still_valid(rows, after, by="Country").withColumnRenamed("valid", name)
    out = checked(cleaning.clean(rows.withColumns({c: F.col(c).cast("string") for c in ("TotalCases", "CasesConfirmed", "Deaths", "CFR")})), "cleaned")
    out = out.join(checked(rows.filter("TotalCases >= 100"), "filtered"), "Country")
    return out.join(checked(rows.withColumn("Event", F.lit(None).cast("string")), "blanked"), "Country")

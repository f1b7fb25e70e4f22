"""The public pipelines: reports, evaluation, raw processing, weekly ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import names
from tessera.operators import cleaning, metrics, reconcile, timeseries
from tessera.sources import files, sinks


def reconcile_extractions(spark: SparkSession, llm_folder: str, rule_folder: str, out: str | None = None, weeks: list[int] | None = None, year: int | None = None, model: str | None = None) -> dict[str, DataFrame]:
    """Newest extractions of both sources, cleaned and reconciled; with ``out`` a
    CSV of every report that has rows is written under one prefix."""
    load = lambda folder, m: files.load_extractions(spark, files.extraction_catalog(files.listing(spark, folder)), weeks=weeks, year=year, model=m)
    left, right = cleaning.clean(load(llm_folder, model), "model"), cleaning.clean(load(rule_folder, None), "rule")
    frames = reconcile.report(left, right)
    if out:
        wanted = {k: frames[k] for k in ("summary", "discrepancies", "cfr", "unique")}
        sinks.write_reports(wanted, out, sinks.report_prefix(weeks or [], year))
    return frames


def evaluate(left: DataFrame, right: DataFrame, folder: str | None = None) -> DataFrame:
    """Scores of a cleaned pair of tables; written with the differences if asked."""
    a, b = cleaning.clean(left, "model"), cleaning.clean(right, "rule")
    scores = metrics.evaluation(a, b)
    if folder:
        sinks.write_report(scores, f"{folder}/metrics")
        sinks.write_csv(reconcile.discrepant(reconcile.compared(a, b)), f"{folder}/discrepancies")
        sinks.write_csv(reconcile.only_left(a, b), f"{folder}/llm_only")
    return scores


def clean_or_keep(df: DataFrame, source: str = "model") -> DataFrame:
    """The cleaned table if cleaning lost nothing, else the table as it was."""
    done = cleaning.clean(df, source)
    return done if cleaning.still_valid(df, done).first()["valid"] else df


def process_raw(spark: SparkSession, raw: str, processed: str, master: str, source: str = "model") -> DataFrame:
    """Cleans the newest raw extractions and replaces their periods in the master."""
    df = clean_or_keep(files.load_extractions(spark, files.extraction_catalog(files.listing(spark, raw))), source)
    sinks.write_csv(df, processed)
    sinks.write_master(df, master)
    return df.groupBy("Year", "WeekNumber").agg(F.count("*").alias("records"))


def weekly_ingest(history: DataFrame | None, fresh: DataFrame, keys=("Country", "Event", "Year", "WeekNumber"), order=("ingested_at",)) -> DataFrame:
    """History and new rows together, the newest of each key."""
    both = fresh if history is None else history.unionByName(fresh, allowMissingColumns=True)
    there = [k for k in keys if k in both.columns]
    return timeseries.keep_last(both, there, order)


def bulletins(pages: DataFrame) -> DataFrame:
    """PDF links of scraped pages with week and year, newest first, once each."""
    from tessera.operators.tables import html_links

    links = html_links(pages.select("page_id", "html")).filter(F.lower("href").contains(".pdf"))
    name = F.element_at(F.split("href", "/"), -1)
    week, year = names.file_week(name)
    rows = links.select("href", "label", name.alias("name"), F.coalesce(week, F.regexp_extract(name, r"OEW(\d{1,2})", 1).try_cast("int")).alias("week"), year.alias("year"))
    return rows.dropDuplicates(["href"]).orderBy(F.desc("year"), F.desc("week"), "name")


def pick_bulletin(rows: DataFrame, week: int | None, current_year: int) -> DataFrame:
    """The wanted week's bulletin, of the current year if there is one, else the newest."""
    wanted = rows if week is None else rows.filter(F.col("week") == week)
    return wanted.orderBy(F.desc(F.coalesce(F.col("year") == current_year, F.lit(False))), F.desc("year"), F.desc("week")).limit(1)


def pick_bulletins(rows: DataFrame, current_year: int) -> DataFrame:
    """``pick_bulletin`` for every week at once."""
    order = F.struct(F.coalesce(F.col("year") == current_year, F.lit(False)), "year", *[c for c in rows.columns if c not in ("week", "year")])
    best = rows.groupBy("week").agg(F.max_by(F.struct(*rows.columns), order).alias("_b"))
    return best.select("_b.*")


def backfill(pairs: DataFrame, logged: DataFrame, force: bool = False) -> DataFrame:
    """Accuracy per version and model that the log lacks yet, versions in order."""
    found = metrics.accuracy(pairs, by=("version", "model"))
    return found if force else found.join(logged.select("version", "model").distinct(), ["version", "model"], "left_anti")

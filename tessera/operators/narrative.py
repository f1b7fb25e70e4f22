"""Running text that belongs to records: relevant lines, segments, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names
from tessera.functions import scalars as S
from tessera.operators import tables as T

# What headers of tables say; the first three also end a narrative.
HEADINGS = ("country", "event", "grade", "date notified", "total cases", "start of reporting", "end of reporting", "cases confirmed", "ongoing events", "new events", "cfr", "deaths")
# Fixed value: what the page says on which the monitored events begin.
MARKER = "All events currently being monitored"


def relevant_lines(docs: DataFrame, records: DataFrame, most: int = 15, names: int = 10, doc: str = "doc_id", seq: str = "seq") -> DataFrame:
    """(doc, line_no, line): the first ``most`` lines of a document of 20 characters
    or more that name one of the first countries or events, or hold a digit and a
    word of reporting. The limit is the feature."""
    firsts = [records.groupBy(F.lower(c).alias("name")).agg(F.min(seq).alias("s")).orderBy("s").limit(names).select("name") for c in ("Country", "Event")]
    known = F.broadcast(firsts[0].union(firsts[1]).agg(F.collect_set("name").alias("_names")))  # twice `names` words
    rows = T.lines(docs.select(doc, "text")).withColumn("line", S.strip(F.col("line"))).filter(F.length("line") >= 20).join(known)
    low = F.lower("line")
    wanted = F.exists("_names", lambda n: low.contains(n)) | (F.col("line").rlike(r"\d") & low.rlike("cases|deaths|reported|confirmed"))
    nth = F.row_number().over(Window.partitionBy(doc).orderBy("line_no"))
    return rows.filter(wanted).withColumn("_n", nth).filter(F.col("_n") <= most).select(doc, "line_no", "line")


def segments_of_records(records: DataFrame, segments: DataFrame, doc: str = "doc_id", least_words: int = 10) -> DataFrame:
    """Records with the segments of their own document that name the country and
    have enough words, joined in order."""
    parts = segments.filter(T.word_count(F.col("text")) >= least_words).withColumnRenamed("text", "_text")
    hits = records.join(parts, doc).filter(F.lower("_text").contains(F.lower("Country")))
    told = hits.groupBy(doc, "Country", "Event").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "_text"))), lambda x: x["_text"]), " ").alias("narrative"))
    return records.join(told, [doc, "Country", "Event"], "left")


def table_summary(df: DataFrame, top: int = 5) -> DataFrame:
    """One row: record, country and event counts and the most frequent of each."""
    counts = df.agg(F.count("*").alias("records"), F.countDistinct("Country").alias("countries"), F.countDistinct("Event").alias("events"))
    for c in ("Country", "Event"):
        best = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(top)
        counts = counts.join(best.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "value"))).alias(f"top_{c}")))  # one-row aggregates
    return counts


def rows_as_json(df: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    """(row id, record): each row as a JSON document that names its row."""
    return df.select(row_id, F.to_json(F.struct(F.col(row_id).alias("row_id"), *columns)).alias("record"))


def country_words(words: DataFrame, known: DataFrame, most: int = 50) -> DataFrame:
    """(word), lower-cased: those of ``most`` characters at most that hold a known
    name (name) or are a part of one, ignoring case. Words are short, so their and
    the names' parts meet in equi-joins."""
    own = words.select(F.lower("word").alias("word")).filter(F.length("word").between(1, most)).distinct()
    dim = known.select(F.lower("name").alias("name")).filter("length(name) > 0").distinct()
    # Both at once, so that lines are not made anew for each: a word asks for itself among parts of names, and its parts among names.
    asks = F.concat(F.array(F.struct(F.lit(False).alias("whole"), F.col("word").alias("name"))), F.transform(_pieces("word", most), lambda p: F.struct(F.lit(True).alias("whole"), p.alias("name"))))
    there = dim.select(F.lit(True).alias("whole"), "name").union(dim.select(F.lit(False).alias("whole"), F.explode(_pieces("name", most))).distinct())
    return own.select("word", F.inline(asks)).join(there, ["whole", "name"], "left_semi").select("word").distinct()


def _pieces(c: str, most: int) -> Column:
    """The distinct parts of ``most`` characters at most of a text that isn't empty."""
    size = F.length(c)
    each = F.transform(F.sequence(F.lit(1), size), lambda a: F.transform(F.sequence(F.lit(1), F.least(size - a + 1, F.lit(most))), lambda n: F.substr(F.col(c), a, n)))
    return F.array_distinct(F.flatten(each))


def page_lines(pages: DataFrame, known: DataFrame, words: DataFrame | None = None, keys=("page_id",)) -> DataFrame:
    """(keys, line_no, line, low, names): lines of page texts, single-spaced, and
    whether the first word ``names`` a country.

    Where a page has positioned ``words`` (key, seq, x0, y0, text), its lines are
    built from them; ``keys`` is one column then.
    """
    rows = T.lines(pages.select(*keys, "text")).withColumn("line_no", F.col("line_no").cast("long"))
    if words is not None:
        words = words.filter("y0 IS NOT NULL")
        placed = T.text_lines(words, *keys).select(*keys, "line_no", "line")
        rows = rows.join(words.select(*keys).distinct(), list(keys), "left_anti").unionByName(placed)
    rows = rows.withColumn("line", S.spaces(F.col("line"))).withColumn("low", F.lower("line"))
    rows = rows.withColumn("_word", F.element_at(F.split("low", " "), 1))
    begins = country_words(rows.select(F.col("_word").alias("word")), known).select(F.col("word").alias("_word"), F.lit(True).alias("names"))
    return rows.join(begins, "_word", "left").select(*keys, "line_no", "line", "low", F.coalesce("names", F.lit(False)).alias("names"))


def says(low: Column, headings) -> Column:
    return low.rlike("|".join(headings))


def carried_on(keys, most: int, stop: Column, skip: Column | None = None) -> Column:
    """A line and those of the next ``most`` that go on with it: skipped ones are
    left out, the first that stops it and all behind it are not taken."""
    skip = F.lit(False) if skip is None else skip
    step = F.struct((stop & ~skip).alias("stop"), F.when(~skip & ~stop, F.col("line")).alias("part"))
    ahead = F.collect_list(step).over(Window.partitionBy(*keys).orderBy("line_no").rowsBetween(1, most))
    end = F.array_position(F.transform(ahead, lambda x: x["stop"]), True).cast("int")
    taken = F.when(end > 0, F.slice(ahead, F.lit(1), end - 1)).otherwise(ahead)
    return F.concat_ws(" ", F.col("line"), F.transform(taken, lambda x: x["part"]))


def _naming(records: DataFrame, lines: DataFrame, keys) -> DataFrame:
    """Records (keys, Country, Event), each once, with the lines of their own page
    that name the country. They meet by page, which is a bounded group, so lines
    stay where they were carried on."""
    asked = records.select(*keys, "Country", "Event").distinct().withColumn("_name", F.lower("Country")).filter("length(_name) > 0")
    return asked.join(lines, list(keys)).filter(F.col("low").contains(F.col("_name")))


def _with_told(records: DataFrame, told: DataFrame, keys) -> DataFrame:
    fields = [*keys, "Country", "Event"]
    told = told.withColumnsRenamed({f: f"_of_{f}" for f in fields})
    same = [records[f].eqNullSafe(told[f"_of_{f}"]) for f in fields]
    return records.join(told, same, "left").drop(*[f"_of_{f}" for f in fields]).withColumn("narrative", F.coalesce("narrative", F.lit("")))


def told_of(records: DataFrame, pages: DataFrame, known: DataFrame, words: DataFrame | None = None, keys=("page_id",)) -> DataFrame:
    """Records (keys, Country, Event) with the ``narrative`` that their page tells.

    It begins with the page's first line of 30 characters or more, not a heading,
    that names the country and a keyword of the event, and takes up to four lines
    more; without such a line, with the first that names the country and says
    more, and two lines, of 500 characters at most. Lines under 20 characters are
    passed over; a line that begins with a country, or a heading, ends it. Records
    without a country or a telling line have an empty one.
    """
    lines = page_lines(pages, known, words, keys)
    ends, short = F.col("names") | says(F.col("low"), HEADINGS[:3]), F.length("line") < 20
    begun = lines.withColumns({"_long": carried_on(keys, 4, ends, short), "_brief": carried_on(keys, 2, ends, short)})
    begun = begun.filter((F.length("line") >= 30) & ~says(F.col("low"), HEADINGS))
    found = _naming(records, begun, keys)
    at = lambda c, cond: F.min_by(c, F.when(cond, F.col("line_no")))
    sure = F.exists(names.event_keywords(F.col("Event")), lambda w: F.col("low").contains(w))
    told = found.groupBy(*keys, "Country", "Event").agg(at("_long", sure).alias("_sure"), at("_brief", F.col("low") != F.col("_name")).alias("_any"))
    return _with_told(records, told.select(*keys, "Country", "Event", F.coalesce("_sure", S.clipped(F.col("_any"), 500)).alias("narrative")), keys)


def longest_told(records: DataFrame, pages: DataFrame, known: DataFrame, keys=("page_id",), most: int = 300) -> DataFrame:
    """Records (keys, Country, Event) with the longest ``narrative`` of their page.

    Each line of over 50 characters that names the country and is no heading
    begins one; up to three lines go on, until one of 30 characters or fewer or one
    that begins with a country. Of equally long ones the first counts; more than
    ``most`` characters are cut and marked.
    """
    lines = page_lines(pages, known, keys=keys)
    begun = lines.withColumn("_told", carried_on(keys, 3, (F.length("line") <= 30) | F.col("names")))
    begun = begun.filter((F.length("line") > 50) & ~says(F.col("low"), (*HEADINGS[:3], "total cases")))
    found = _naming(records, begun, keys)
    told = found.groupBy(*keys, "Country", "Event").agg(F.max_by("_told", F.struct(F.length("_told"), -F.col("line_no"))).alias("_told"))
    cut = F.when(F.length("_told") > most, F.concat(F.substring("_told", 1, most), F.lit("..."))).otherwise(F.col("_told"))
    return _with_told(records, told.select(*keys, "Country", "Event", cut.alias("narrative")), keys)


def stage_one(rows: DataFrame, pages: DataFrame, known: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Records of table rows (doc, page, row_no, cells), from the page on that says
    ``MARKER``, with the longest narrative of their page (doc, page, text).

    A row is a record if three of its cells are filled, the first of them names a
    known country (name) and says no heading. Cells are the fields in order; the
    places that a row lacks are empty.
    """
    begins = pages.groupBy(doc).agg(F.min(F.when(F.col("text").contains(MARKER), F.col("page"))).alias("_from"))
    cells = rows.withColumn("cells", F.transform("cells", lambda c: S.spaces(F.coalesce(c, F.lit("")))))
    first = F.lower(T.first_cell(F.col("cells")))
    cells = cells.join(begins, doc).filter(F.col("page") >= F.col("_from")).withColumn("_word", first)
    filled = F.size(F.filter("cells", lambda c: F.length(c) > 0))
    cells = cells.filter((F.size("cells") >= 3) & (filled >= 3) & ~says(F.col("_word"), ("country", "new events", "ongoing events")))
    cells = cells.join(country_words(cells.select(F.col("_word").alias("word")), known).withColumnRenamed("word", "_word"), "_word", "left_semi")
    return longest_told(cells.select(doc, "page", "row_no", *T.fields_by_place(F.col("cells"))), pages.select(doc, "page", "text"), known, (doc, "page"))


def summaries(records: DataFrame, by, top: int = 10) -> DataFrame:
    """(by, records, countries, events, document): each bulletin's counts, its
    ``top`` events and countries, most frequent first, and all its grades, also as
    one JSON document. Values are counted before any bulletin's are gathered."""
    by = [by] if isinstance(by, str) else list(by)
    kinds = {"event_types": ("Event", top), "grade_distribution": ("Grade", None), "top_countries": ("Country", top)}
    entries = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value"), F.lit(n).cast("int").alias("most")) for k, (c, n) in kinds.items()])
    counts = records.select(*by, F.inline(entries)).filter("value IS NOT NULL").groupBy(*by, "kind", "value", "most").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy(*by, "kind").orderBy(F.desc("n"), "value"))
    leading = counts.withColumn("nth", nth).filter("most IS NULL OR nth <= most")
    of = lambda k: F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("nth", "value", "n")))), lambda x: F.struct(x["value"], x["n"]))).alias(k)
    sizes = records.groupBy(*by).agg(F.count("*").alias("records"), F.countDistinct("Country").alias("countries"), F.countDistinct("Event").alias("events"))
    both = sizes.join(leading.groupBy(*by).agg(*[of(k) for k in kinds]), by, "left")
    return both.withColumn("document", F.to_json(F.struct("records", "countries", "events", *kinds))).drop(*kinds)


def export_metadata(records: DataFrame, by) -> DataFrame:
    """(by, total_records, countries, events) with sorted lists of distinct names."""
    names_of = lambda c: F.sort_array(F.collect_set(c)).alias
    return records.groupBy(*([by] if isinstance(by, str) else by)).agg(F.count("*").alias("total_records"), names_of("Country")("countries"), names_of("Event")("events"))

"""Names: events, countries, headers, files and bulletin formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import spaces
from tessera.operators.textmatch import contained

# Event names and what they become, as published.
EVENT_NAMES = {
    "Humanitarian Crisis": "Complex Humanitarian crisis",
    "Humanitarian crisis": "Complex Humanitarian crisis",
    "Humanitarian crisis (North-West & South-West)": "Humanitarian crisis (Noth-West & South-West )",
    "Complex Humanitarian crisis- ETH": "Complex Humanitarian crisis",
    "Complex Humanitarian crisis-ETH": "Complex Humanitarian crisis",
    "Complex Humanitarian crisis -SS": "Complex Humanitarian crisis",
    "Complex Humanitarian crisis-SS": "Complex Humanitarian crisis",
}
# Country names and what they become.
COUNTRY_NAMES = {
    "CÃ´te d'Ivoire": "Côte d'Ivoire",
    "DRC": "Democratic Republic of the Congo",
    "Dem. Rep. of the Congo": "Democratic Republic of the Congo",
    "Dem. Rep. Congo": "Democratic Republic of the Congo",
    "DR Congo": "Democratic Republic of the Congo",
    "Congo-Brazzaville": "Congo",
    "Republic of the Congo": "Congo",
    "Republic of Congo": "Congo",
    "Cabo Verde": "Cape Verde",
    "Swaziland": "Eswatini",
    "The Gambia": "Gambia",
    "Central African Rep.": "Central African Republic",
    "CAR": "Central African Republic",
}
# Spellings the wider standardizer adds.
EXTRACTION_NAMES = {
    "Democratic epublic of the Congo": "Democratic Republic of the Congo",
    "Democratic epublic of Congo": "Democratic Republic of the Congo",
    "emocratic Republic of the Congo": "Democratic Republic of the Congo",
    "emocratic Republic of Congo": "Democratic Republic of the Congo",
    "DRC": "Democratic Republic of the Congo",
    "DR Congo": "Democratic Republic of the Congo",
    "Congo DRC": "Democratic Republic of the Congo",
    "Congo, Democratic Republic": "Democratic Republic of the Congo",
    "Democratic Republic Congo": "Democratic Republic of the Congo",
    "Congo Republic": "Congo",
    "Republic of Congo": "Congo",
    "Congo Brazzaville": "Congo",
    "Tanzania, United Republic of": "United Republic of Tanzania",
    "United Republic Tanzania": "United Republic of Tanzania",
    "Tanzania United Republic": "United Republic of Tanzania",
    "Cote d'Ivoire": "Côte d'Ivoire",
    "Cote dIvoire": "Côte d'Ivoire",
    "Ivory Coast": "Côte d'Ivoire",
    "Côte d Ivoire": "Côte d'Ivoire",
    "Cape Verde Islands": "Cape Verde",
    "Cabo Verde": "Cape Verde",
    "Sao Tome & Principe": "Sao Tome and Principe",
    "São Tomé and Príncipe": "Sao Tome and Principe",
    "São Tomé & Príncipe": "Sao Tome and Principe",
    "Swaziland": "Eswatini",
    "Kingdom of Eswatini": "Eswatini",
    "Guinea Bissau": "Guinea-Bissau",
    "Central African Rep": "Central African Republic",
    "Central African Rep.": "Central African Republic",
    "CAR": "Central African Republic",
    "Democratic Republic of th": "Democratic Republic of the Congo",
    "Democratic Republic of t": "Democratic Republic of the Congo",
    "emocratic Republic of th": "Democratic Republic of the Congo",
}
# Words of an event that call up further keywords, first match wins.
EVENT_KEYWORDS = {
    "covid": ["covid", "coronavirus", "sars-cov", "covid-19"],
    "cholera": ["cholera", "vibrio cholerae"],
    "measles": ["measles", "rubeola"],
    "polio": ["polio", "poliovirus", "cvdpv", "wild poliovirus", "vaccine-derived"],
    "ebola": ["ebola", "evd", "ebola virus"],
    "yellow fever": ["yellow fever", "yf"],
    "dengue": ["dengue"],
    "lassa": ["lassa", "lassa fever"],
    "monkeypox": ["monkeypox", "mpox", "orthopoxvirus"],
    "mpox": ["monkeypox", "mpox", "orthopoxvirus"],
    "meningitis": ["meningitis", "neisseria meningitidis"],
    "hepatitis": ["hepatitis"],
    "chikungunya": ["chikungunya"],
}
# Headers of rule-based tables and their canonical names.
HEADER_NAMES = {
    "Date notified to WCO": "DateNotified",
    "Start of reporting period": "StartReportingPeriod",
    "End of reporting period": "EndReportingPeriod",
    "Total cases": "TotalCases",
    "Cases Confirmed": "CasesConfirmed",
}
# Header fragments, first match wins.
FUZZY_HEADERS = {
    "country": "Country", "event": "Event", "grade": "Grade", "date notified": "Date_Notified", "start of reporting": "Start_Date",
    "end of reporting": "End_Date", "total cases": "Total_Cases", "cases confirmed": "Confirmed_Cases", "deaths": "Deaths", "cfr": "CFR",
}
# File names whose week can't be read by rule.
ODD_FILES = {"OEW05-232901": "2020-05", "OEW01-261222010123": "2023-01", "OEW52-1925120222": "2022-52"}


def mapped(c: Column, names: dict[str, str]) -> Column:
    """One pass of an exact map; other values stay."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c)


def split_joined_words(c: Column) -> Column:
    return F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")


def event_name(c: Column) -> Column:
    return mapped(spaces(split_joined_words(F.regexp_replace(c, r"(?U)(\w)\(", "$1 ("))), EVENT_NAMES)


def country_name(c: Column) -> Column:
    return mapped(spaces(split_joined_words(c)), COUNTRY_NAMES)


def resolve_countries(df: DataFrame, known: DataFrame, column: str = "Country", out: str = "StandardCountry") -> DataFrame:
    """The wider standardizer against a table of known names (name string).

    In this order: a known name; the map; the map ignoring case; a known name
    within the text or the text (over 3 characters) within one, the longest,
    then the alphabetically first; the rules for congo and tanzania; unchanged.
    Texts and known names meet through ``contained``, in both directions.
    """
    text = spaces(F.col(column))
    values = df.select(column).distinct().withColumn("_text", text)
    lower = {k.lower(): v for k, v in reversed(EXTRACTION_NAMES.items())}
    by_map = F.try_element_at(F.create_map(*[F.lit(x) for p in EXTRACTION_NAMES.items() for x in p]), "_text")
    by_case = F.try_element_at(F.create_map(*[F.lit(x) for p in lower.items() for x in p]), F.lower("_text"))
    dim = known.select(F.col("name").alias("_name")).distinct().withColumn("_lname", F.lower("_name"))
    low = F.lower("_text")
    texts = values.filter(F.length("_text") > 0).withColumn("_low", low)
    wider = contained(texts.select(F.col("_low").alias("text")), dim.select(F.col("_lname").alias("name"))).select(F.col("text").alias("_low"), F.col("name").alias("_lname"))
    within = contained(dim.select(F.col("_lname").alias("text")), texts.filter(F.length("_text") > 3).select(F.col("_low").alias("name"))).select(F.col("name").alias("_low"), F.col("text").alias("_lname"))
    found = texts.join(wider.union(within).distinct(), "_low").join(dim, "_lname").groupBy(column).agg(
        F.max_by("_name", F.when(F.col("_name") == F.col("_text"), 1)).alias("_exact"),
        F.min(F.struct(-F.length("_name"), "_name")).getField("_name").alias("_near"),
    )
    congo = F.when(low.contains("democratic"), "Democratic Republic of the Congo").when(low.contains("republic") | low.contains("brazzaville"), "Congo")
    rules = F.when(low.contains("congo"), F.coalesce(congo, F.lit("Democratic Republic of the Congo"))).when(low.contains("tanzania"), "United Republic of Tanzania")
    found = found.withColumnRenamed(column, "_found")
    names = values.join(found, F.col(column).eqNullSafe(F.col("_found")), "left")
    names = names.select(F.col(column).alias("_raw"), F.coalesce("_exact", by_map, by_case, "_near", rules, "_text").alias(out))
    return df.join(names, F.col(column).eqNullSafe(F.col("_raw")), "left").drop("_raw")


def event_keywords(c: Column) -> Column:
    low = F.lower(c)
    more = F.array().cast("array<string>")
    for key, words in reversed(EVENT_KEYWORDS.items()):
        more = F.when(low.contains(key), F.array(*[F.lit(w) for w in words])).otherwise(more)
    return F.when(F.length(low) > 0, F.concat(F.array(low), more)).otherwise(F.array().cast("array<string>"))


def rename_headers(df: DataFrame) -> DataFrame:
    """Canonical names for the columns that are there."""
    return df.withColumnsRenamed(HEADER_NAMES)


def positional_headers(df: DataFrame, names: list[str]) -> DataFrame:
    """Line breaks leave the headers; a table of the expected width is renamed."""
    clean = [c.replace("\n", " ").replace("\r", " ").strip() for c in df.columns]
    return df.toDF(*(names if len(clean) == len(names) else clean))


def fuzzy_header(header: str | None) -> str:
    text = " ".join((header or "").split())
    return next((v for k, v in FUZZY_HEADERS.items() if k in text.lower()), text.replace(" ", "_"))


def file_week(name: Column) -> tuple[Column, Column]:
    """(week, year) of ``Week_21__19_-_25_May_2025.csv``, null where absent."""
    number = lambda p: F.regexp_extract(name, p, 1).try_cast("int")
    return number(r"Week_(\d+)"), number(r"(\d{4})")


def year_week(name: Column, pad: bool = True) -> Column:
    """``YYYY-WW`` of a bulletin's file name, null where it can't be told."""
    stem = F.replace(F.replace(name, F.lit(".pdf"), F.lit("")), F.lit(".."), F.lit(""))
    wide = lambda w: F.lpad(w, 2, "0") if pad else w.try_cast("int").cast("string")
    week = r"Week_(\d{1,2})__.*?(\d{4})"
    by_week = F.when(stem.rlike(week), F.concat(F.regexp_extract(stem, week, 2), F.lit("-"), wide(F.regexp_extract(stem, week, 1))))
    years = F.filter(F.transform(F.regexp_extract_all(stem, F.lit(r"(\d{4})")), lambda y: y.try_cast("int")), lambda y: (y >= 2020) & (y <= 2025))
    number = F.regexp_extract(stem, r"^OEW(\d{1,2})", 1)
    by_number = F.when(number != "", F.concat(F.array_max(years).cast("string"), F.lit("-"), wide(number)))
    odd = F.try_element_at(F.create_map(*[F.lit(x) for p in ODD_FILES.items() for x in p]), stem)
    return F.coalesce(by_week, odd, by_number)


def extraction_file(name: Column) -> tuple[Column, Column, Column, Column]:
    """(week, year, model, run id) of ``OEW42-2025_gpt-5_210.csv``; run 0 if bad."""
    parts = F.split(F.regexp_replace(name, r"\.csv$", ""), "_")
    head = F.split(F.get(parts, F.lit(0)), "-")
    week = F.regexp_replace(F.get(head, F.lit(0)), "^OEW", "").try_cast("int")
    run = F.coalesce(F.get(parts, F.size(parts) - 1).try_cast("int"), F.lit(0))
    model = F.when(F.size(parts) > 2, F.concat_ws("_", F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(1)))))
    return week, F.get(head, F.lit(1)).try_cast("int"), model, run


def bulletin_format(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, format) from page texts (doc, page, text), the first ten pages."""
    low = F.lower("text")
    table = "all events currently being monitored"
    has = lambda s: F.max(low.contains(s).cast("int"))
    found = pages.filter("page <= 10").groupBy(doc).agg(
        F.min(F.when(low.contains(table), F.col("page"))).alias("_first"),
        has(table + " by who afro").alias("_afro"), has("new events").alias("_new"), has("ongoing events").alias("_ongoing"),
        has("events reported during the reporting period").alias("_period"),
    )
    kind = (
        F.when(F.col("_first").isNull(), "modern")
        .when(F.col("_afro") == 1, "legacy")
        .when((F.col("_new") == 1) & (F.col("_ongoing") == 1) & (F.col("_period") == 1), "intermediate")
        .when(F.col("_first") <= 4, "modern")
        .otherwise("legacy")
    )
    return found.select(doc, kind.alias("format"))


def not_recovered(name: Column) -> Column:
    """Whether a name is not that of rows re-inserted by a recovery."""
    return ~F.coalesce(name, F.lit("")).endswith("RECOVERED")


def not_protracted(grade: Column) -> Column:
    return ~F.coalesce(grade, F.lit("nan")).contains("Protracted")


# Parts of model names that tell one provider's models.
PROVIDER_PARTS = ("gpt-", "o1-", "text-davinci", "text-curie", "text-babbage", "text-ada", "code-davinci", "code-cushman", "davinci", "curie", "babbage", "ada")


def is_providers_model(model: Column, prefix: str = "openai/", parts=PROVIDER_PARTS) -> Column:
    low, out = F.lower(model), F.lower(model).startswith(prefix)
    for p in parts:
        out = out | low.contains(p)
    return F.coalesce(out, F.lit(False))


def model_identifier(nickname: Column, known: dict[str, str]) -> Column:
    """The full name of a nickname, else the nickname."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in known.items() for x in p]), nickname), nickname) if known else nickname


def metadata_file_name(url: Column, name: Column, week: Column, year: Column) -> Column:
    """The catalogued file name, else one from week and year, else the url's end."""
    tail = F.element_at(F.split(url, "/"), -1)
    tail = F.when(tail.endswith(".pdf"), tail).otherwise(F.concat(tail, F.lit(".pdf")))
    return F.coalesce(name, F.concat(F.lit("OEW"), F.lpad(week.cast("string"), 2, "0"), F.lit("-"), year.cast("string"), F.lit(".pdf")), tail)

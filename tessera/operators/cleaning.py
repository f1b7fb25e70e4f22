"""The cleaning pipeline both sources go through before they are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from tessera.functions import names
from tessera.functions import scalars as S

#: The only declared schema: fields and types of a typed record.
RECORD = StructType(
    [StructField(n, t) for n, t in (
        ("reporting_date", TimestampType()), ("country", StringType()), ("admin1", StringType()), ("admin2", StringType()),
        ("suspected_cases", LongType()), ("confirmed_cases", LongType()), ("deaths", LongType()), ("case_fatality_rate", DoubleType()),
        ("population_at_risk", LongType()), ("reporting_period_start", TimestampType()), ("reporting_period_end", TimestampType()),
        ("source_file", StringType()), ("extraction_timestamp", TimestampType()),
    )]
)
COUNTS = ("Total cases", "Cases Confirmed", "Deaths", "TotalCases", "CasesConfirmed")


def clean(df: DataFrame, source: str = "rule", fill_gaps: bool = True) -> DataFrame:
    """Numbers, rates, names, headers, missing literals and, for the model's
    table, gap filling; columns that are absent are left out."""
    there = set(df.columns)
    changes = {c: S.clean_count(F.col(c)) for c in COUNTS if c in there}
    if "CFR" in there:
        changes["CFR"] = S.clean_rate(F.col("CFR"))
    if "Event" in there:
        changes["Event"] = names.event_name(F.col("Event"))
    if "Country" in there:
        changes["Country"] = names.country_name(F.col("Country"))
    df = names.rename_headers(df.withColumns(changes))
    df = df.withColumns({c: S.missing_to_null(F.col(c)) for c, kind in df.dtypes if kind == "string"})
    if source == "model" and fill_gaps:
        df = fill(df)
    return df


def fill(df: DataFrame) -> DataFrame:
    there = set(df.columns)
    if {"TotalCases", "CasesConfirmed"} <= there:
        grade = F.col("Grade") if "Grade" in there else F.lit(None).cast("string")
        df = df.withColumn("CasesConfirmed", S.fill_confirmed(F.col("TotalCases"), F.col("CasesConfirmed"), grade))
    if {"TotalCases", "Deaths", "CFR"} <= there:
        df = df.withColumn("Deaths", S.fill_deaths(F.col("TotalCases"), F.col("Deaths"), F.col("CFR")))
    return df


def typed(df: DataFrame, schema: StructType = RECORD) -> DataFrame:
    """Every declared column, coerced by its type; what fails or lacks is null."""

    def coerced(field: StructField):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(field.name)
        by = {"timestamp": S.parse_date, "bigint": S.parse_integer, "double": S.parse_float}.get(field.dataType.simpleString())
        return (by(c) if by else c.cast(field.dataType)).alias(field.name)

    return df.select([coerced(f) for f in schema.fields])


def cast_where_possible(df: DataFrame, schema: StructType = RECORD) -> DataFrame:
    """Casts a column only if every value survives; else it stays as it was."""
    fields = [f for f in schema.fields if f.name in df.columns]
    lost = df.agg(*[F.max((F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).cast("int")).alias(f.name) for f in fields]).first() if fields else {}
    return df.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in fields if not lost[f.name]})


def clean_rule_table(df: DataFrame) -> DataFrame:
    """Raw rule-based rows: empty rows and rows without a grade go, breaks leave
    texts, and counts become text ready for parsing."""
    df = df.dropna(how="all").filter(F.col("Grade").isNotNull())
    df = df.withColumns({c: S.one_line(F.col(c)) for c, kind in df.dtypes if kind == "string"})
    counts = {c: S.raw_count_text(F.col(c)) for c in ("Total cases", "Cases Confirmed", "Deaths") if c in df.columns}
    return df.withColumns(counts | ({"CFR": S.raw_rate_text(F.col("CFR"))} if "CFR" in df.columns else {}))


def still_valid(before: DataFrame, after: DataFrame, by: str | None = None) -> DataFrame:
    """Whether no row was lost and no key part became null: one row, or one for each
    value of ``by`` in ``before``."""
    keys = [by] if by else []
    gaps = lambda df, p: df.groupBy(*keys).agg(F.count("*").alias(f"{p}_rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{p}_{c}") for c in ("Country", "Event")])
    b, a = gaps(before, "b"), gaps(after, "a")
    both = b.join(a, keys, "left") if keys else b.join(a)  # else two one-row aggregates
    valid = (F.col("b_rows") == F.col("a_rows")) & (F.col("a_Country") <= F.col("b_Country")) & (F.col("a_Event") <= F.col("b_Event"))
    return both.select(*keys, F.coalesce(valid, F.lit(False)).alias("valid"))


def final_format(df: DataFrame, columns: list[str]) -> DataFrame:
    there = set(df.columns)
    return df.select([(F.coalesce(S.strip(F.col(c).cast("string")), F.lit("N/A")) if c in there else F.lit("N/A")).alias(c) for c in columns])

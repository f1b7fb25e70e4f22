"""Period-over-period operators: changes, gaps, newest and first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import scalars as S

GROUP = ("Country", "Event")
TIME = ("Year", "WeekNumber")


def case_change(df: DataFrame, value: str = "TotalCases", group=GROUP, order=TIME, out: str = "CaseChange") -> DataFrame:
    """Difference to the group's row before; null for the first and for null groups."""
    before = F.lag(value).over(Window.partitionBy(*group).orderBy(*order))
    known = F.lit(True)
    for g in group:
        known = known & F.col(g).isNotNull()
    return df.withColumn(out, F.when(known, F.col(value) - before))


def with_gap_rows(df: DataFrame, group=GROUP, order=TIME, above: int = 5) -> DataFrame:
    """Adds a row without values before each jump of Year * 100 + Week over ``above``."""
    ordinal = F.col(order[0]) * 100 + F.col(order[1])
    jump = ordinal - F.lag(ordinal).over(Window.partitionBy(*group).orderBy(*order))
    marked = df.withColumn("_gap", F.coalesce(jump > above, F.lit(False))).withColumn("is_gap", F.explode(F.when(F.col("_gap"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    keep = {*group, *order, "is_gap"}
    return marked.drop("_gap").withColumns({c: F.when(~F.col("is_gap"), F.col(c)) for c in df.columns if c not in keep})


def kpis(df: DataFrame, dates: DataFrame, shorten_countries: bool = False) -> DataFrame:
    """Case change per group over the weeks of a date table (YearWeek, WeekDate).

    The table has a row a week; a date that can't be parsed is null. With
    ``shorten_countries`` names over 30 characters, but for the longest official
    one, become ``Cote d'Ivoire``, a known lossy rule that is off by default.
    """
    key = F.concat_ws("-", F.col("Year").cast("string"), F.col("WeekNumber").cast("string"))
    when = F.try_to_timestamp(F.regexp_replace("WeekDate", " ", ""), F.lit("M/d/yyyy"))
    out = df.withColumn("YearWeek", key).join(dates.select("YearWeek", when.alias("WeekDate")), "YearWeek", "left")
    out = case_change(out.withColumn("Total cases", S.number_or_null(F.col("Total cases"))), "Total cases", order=("WeekDate", *TIME), out="Case Change")
    if shorten_countries:
        long = (F.length("Country") > 30) & (F.col("Country") != "Democratic Republic of the Congo")
        out = out.withColumn("Country", F.when(long, "Cote d'Ivoire").otherwise(F.col("Country")))
    return out


def keep_last(df: DataFrame, keys, order) -> DataFrame:
    """The newest row of each key (missing keys are equal)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order]))).filter("_rn = 1").drop("_rn")


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def timeline(left: DataFrame, right: DataFrame, value: str, by=TIME) -> DataFrame:
    """Full outer join of two period series, with label, and whether they differ."""
    a, b = left.select(*by, F.col(value).alias("left_value")), right.select(*by, F.col(value).alias("right_value"))
    differs = F.coalesce(F.col("left_value").cast("double"), F.lit(-1.0)) != F.coalesce(F.col("right_value").cast("double"), F.lit(-1.0))
    out = a.join(b, list(by), "full").withColumn("mismatch", differs)
    return out.withColumns({"TimeLabel": S.week_label(F.col(by[0]), F.col(by[1])), "TimeOrder": F.col(by[0]) * 100 + F.col(by[1])})


def carried(df: DataFrame, flag: str, group, order, out: str = "seen") -> DataFrame:
    """Whether the flag has been true up to and with this row of the group."""
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.coalesce(F.max(F.col(flag).cast("int")).over(window) == 1, F.lit(False)))


def sessions(df: DataFrame, group, time: str, gap: str = "30 minutes") -> DataFrame:
    """Session windows over a time column, with the session's rows."""
    return df.groupBy(*group, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(*group, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def chunked(df: DataFrame, order, size: int, group=()) -> DataFrame:
    """Chunk numbers of ``size`` rows within a group, in order."""
    return df.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1) / size))

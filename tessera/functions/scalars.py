"""Coercions, comparisons and labels as column expressions.

Each dialect of number parsing keeps its own name; none raises on bad input.
A number is recognised by ``NUMBER`` before it is cast, so that words and
suffixes that one engine's cast accepts and another's does not count as bad.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
EDGES = r"^[\s ]+|[\s ]+$"
#: Literal strings that stand for a missing value.
MISSING_LITERALS = ("nan", "None", "", "NaN")
#: Fields that are compared between two sources.
COMPARED = ("TotalCases", "CasesConfirmed", "Deaths", "CFR", "Grade")
TOLERANCE = 0.01
NO_ERROR = 999.0


def strip(c: Column) -> Column:
    return F.regexp_replace(c, EDGES, "")


def number_or_null(c: Column) -> Column:
    """A double where the stripped text is one, else null; never NaN."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def close(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """values_match for numeric columns, which need no parsing."""
    return F.coalesce(F.abs(a - b) <= tolerance, a.isNull() & b.isNull())


def clean_count(c: Column) -> Column:
    """Missing and unparsable count as 0; thousands separators are dropped."""
    return F.coalesce(number_or_null(F.regexp_replace(c.cast("string"), "[, ]", "")), F.lit(0.0))


def clean_rate(c: Column) -> Column:
    """A percentage without its sign; a comma makes it unparsable, hence 0."""
    return F.coalesce(number_or_null(F.regexp_replace(c.cast("string"), "%", "")), F.lit(0.0))


def raw_rate_text(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit("nan"))
    return F.translate(F.regexp_replace(text, "%", ""), ",-", ".0")


def raw_count_text(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit("nan"))
    return F.regexp_replace(F.translate(text, "-", "0"), "[ ,]", "")


def parse_integer(c: Column) -> Column:
    """Truncated toward zero; bad input is null."""
    return number_or_null(F.regexp_replace(c.cast("string"), "[, ]", "")).try_cast("bigint")


def parse_float(c: Column) -> Column:
    return number_or_null(F.regexp_replace(F.regexp_replace(c.cast("string"), "[, ]", ""), "%+$", ""))


def parse_date(c: Column) -> Column:
    text = strip(c.cast("string"))
    formats = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "d-MMM-yyyy", "d-MMM-yy", "d MMMM yyyy")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def cell_count(c: Column) -> Column:
    digits = F.regexp_replace(F.regexp_replace(c.cast("string"), "[^0-9,.]", ""), ",", "")
    return F.coalesce(number_or_null(digits).try_cast("bigint"), F.lit(0))


def cell_rate(c: Column) -> Column:
    return F.coalesce(number_or_null(F.regexp_replace(c.cast("string"), "[^0-9.]", "")), F.lit(0.0))


def cell_by_header(header: Column, c: Column) -> Column:
    """A cell as text, cleaned as its header asks."""
    return (
        F.when(header.contains("Cases") | header.contains("Deaths"), cell_count(c).cast("string"))
        .when(header.contains("CFR"), cell_rate(c).cast("string"))
        .otherwise(spaces(c))
    )


def lenient_count(c: Column) -> Column:
    text = strip(c.cast("string"))
    return number_or_null(F.regexp_replace(F.when(~text.isin("N/A", "-", ""), text), ",", ""))


def lenient_rate(c: Column) -> Column:
    text = strip(c.cast("string"))
    return number_or_null(F.translate(F.regexp_replace(F.when(~text.isin("N/A", "-", ""), text), "%", ""), ",", "."))


def spaces(c: Column) -> Column:
    return strip(F.regexp_replace(c.cast("string"), r"[\s ]+", " "))


def one_line(c: Column) -> Column:
    return strip(F.translate(c.cast("string"), "\n", " "))


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_LITERALS), c)


def values_match(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """Two missing match; numbers match within the tolerance, else stripped text."""
    x, y = number_or_null(a), number_or_null(b)
    return (
        F.when(a.isNull() & b.isNull(), True)
        .when(a.isNull() | b.isNull(), False)
        .when(x.isNotNull() & y.isNotNull(), F.abs(x - y) <= tolerance)
        .otherwise(strip(a.cast("string")) == strip(b.cast("string")))
    )


def same_but_format(a: Column, b: Column) -> Column:
    bare = lambda c: F.regexp_replace(c.cast("string"), "[, ]", "")
    return bare(a) == bare(b)


def discrepancy_category(left: Column, right: Column) -> Column:
    """The kind of a numeric difference; the order of the cases matters."""
    a, b = F.coalesce(left, F.lit(0.0)), F.coalesce(right, F.lit(0.0))
    ratio, gap = F.try_divide(a, b), F.abs(a - b)
    separator = ((ratio > 900) & (ratio < 1100)) | ((ratio > 9) & (ratio < 11)) | ((ratio > 90) & (ratio < 110))
    return (
        F.when((a == 0) & (b == 0), "Both Zero")
        .when((a == 0) | (b == 0), "Zero vs Non-Zero")
        .when((a > b) & (b > 0) & separator, "Comma/Thousands Issue")
        .when(gap > 100, "Large Difference (>100)")
        .when(gap > 20, "Medium Difference (21-100)")
        .otherwise("Small Difference (≤20)")
    )


def zero_side(left: Column, right: Column, names: tuple[str, str] = ("LLM", "RuleBased")) -> Column:
    a, b = F.coalesce(left, F.lit(0.0)), F.coalesce(right, F.lit(0.0))
    return F.when((a == 0) & (b != 0), f"{names[0]} has 0").when((b == 0) & (a != 0), f"{names[1]} has 0").otherwise("")


def fill_confirmed(total: Column, confirmed: Column, grade: Column) -> Column:
    """A confirmed count copied from a large total is taken back."""
    return F.when((total >= 100) & (confirmed == total) & ~F.coalesce(grade, F.lit("nan")).contains("Protracted"), F.lit(0.0)).otherwise(confirmed)


def fill_deaths(total: Column, deaths: Column, rate: Column) -> Column:
    """Deaths that contradict the stated rate by over a point follow the rate."""
    off = F.abs(F.try_divide(deaths, total) * 100 - rate) > 1
    return F.when((total > 0) & (rate > 0) & off, F.bround(rate / 100 * total, 0)).otherwise(deaths)


def implied_rate(deaths: Column, total: Column) -> Column:
    return F.when(total > 0, deaths / total * 100)


def rate_error(deaths: Column, total: Column, rate: Column) -> Column:
    return F.abs(implied_rate(deaths, total) - rate)


def left_is_closer(left_error: Column, right_error: Column) -> Column:
    return F.coalesce(left_error, F.lit(NO_ERROR)) < F.coalesce(right_error, F.lit(NO_ERROR))


def confidence(relevance: Column, mentions: Column, close: Column) -> Column:
    score = relevance + F.when(mentions, 0.15).otherwise(0.0) + F.when(close, 0.1).otherwise(0.0)
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.bround(F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0)), digits)


def assessment(accuracy: Column) -> Column:
    return F.when(accuracy >= 95, "EXCELLENT").when(accuracy >= 85, "GOOD").when(accuracy >= 70, "ACCEPTABLE").otherwise("NEEDS IMPROVEMENT")


def field_status(accuracy: Column) -> Column:
    return F.when(accuracy >= 90, "✓").when(accuracy >= 70, "⚠").otherwise("✗")


def clipped(c: Column, most: int) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def file_token(c: Column) -> Column:
    return F.translate(c, "/-", "__")


def version_key(c: Column) -> Column:
    """v1.10.0 -> [1, 10, 0], which sorts as versions do."""
    return F.transform(F.split(F.regexp_replace(c, "^v", ""), r"\."), lambda x: x.try_cast("int"))


def composite_key(*parts: Column) -> Column:
    """Joined by an underscore; null if a part is."""
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit("_"), p)
    return out


def text_key(*parts: Column, sep: str = "|") -> Column:
    """Joined as text, a missing part as ``nan``, so missing keys match."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("nan")) for p in parts])


def week_label(year: Column, week: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def verified(found: Column, expected: Column) -> Column:
    """Whether both are there and equal."""
    return F.coalesce(found == expected, F.lit(False))

"""Scalar functions on the edge cases of dirty tables."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions import scalars as S


def value(spark, build, *args):
    df = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} string" for i in range(len(args))))
    return df.select(build(*[F.col(f"c{i}") for i in range(len(args))]).alias("x")).first()["x"]


@pytest.mark.parametrize("text, expected", [
    ("1,234", 1234.0), ("27,16", 2716.0), ("-", 0.0), ("N/A", 0.0), ("", 0.0), ("nan", 0.0), ("None", 0.0), ("12 345", 12345.0), ("\t7", 7.0), ("7 ", 7.0),
    ("1e3", 1000.0), ("inf", 0.0), ("1d", 0.0), ("1_000", 0.0), (None, 0.0), ("-5", -5.0),
])
def test_clean_count(spark, text, expected):
    assert value(spark, S.clean_count, text) == expected


@pytest.mark.parametrize("text, expected", [("3.3%", 3.3), ("1,5%", 0.0), (" 2 % ", 2.0), (None, 0.0), ("x", 0.0)])
def test_clean_rate(spark, text, expected):
    assert value(spark, S.clean_rate, text) == expected


@pytest.mark.parametrize("build, text, expected", [
    (S.parse_integer, "150", 150), (S.parse_integer, "1,500", 1500), (S.parse_integer, "7.9", 7), (S.parse_integer, "invalid", None), (S.parse_float, "3.3%", 3.3), (S.parse_float, "1,500.50", 1500.5), (S.parse_float, None, None),
    (S.lenient_count, "N/A", None), (S.lenient_count, "-", None), (S.lenient_rate, "1,5%", 1.5), (S.raw_count_text, "1 -2,3", "1023"), (S.raw_count_text, None, "nan"), (S.raw_rate_text, "1,5%", "1.5"),
    (S.cell_count, "a1,2b", 12), (S.cell_rate, "x", 0.0), (S.missing_to_null, "NaN", None), (S.missing_to_null, "x", "x"), (S.one_line, " a\nb ", "a b"), (S.week_label, "2025", None),
])
def test_other_coercions(spark, build, text, expected):
    if build is S.week_label:
        assert value(spark, lambda y, w: S.week_label(y, w), "2025", "3") == "2025-W03"
    else:
        assert value(spark, build, text) == expected


def test_parse_date(spark):
    assert str(value(spark, S.parse_date, "2024-01-15")) == "2024-01-15 00:00:00"
    assert value(spark, S.parse_date, "invalid") is None and value(spark, S.parse_date, None) is None


@pytest.mark.parametrize("a, b, expected", [(None, None, True), (None, "1", False), ("1", "1.01", False), ("1", "1.0099", True), ("1", "1.02", False), (" x ", "x", True), ("x", "y", False), ("Grade 3", None, False)])
def test_values_match(spark, a, b, expected):
    assert value(spark, S.values_match, a, b) is expected


@pytest.mark.parametrize("a, b, expected", [
    (0, 5, "Zero vs Non-Zero"), (None, 5, "Zero vs Non-Zero"), (0, 0, "Both Zero"), (None, None, "Both Zero"), (9.01, 1, "Comma/Thousands Issue"), (9, 1, "Small Difference (≤20)"), (11, 1, "Small Difference (≤20)"),
    (90, 1, "Medium Difference (21-100)"), (91, 1, "Comma/Thousands Issue"), (110, 1, "Large Difference (>100)"), (900, 1, "Large Difference (>100)"), (950, 1, "Comma/Thousands Issue"), (1100, 1, "Large Difference (>100)"),
    (20, 40, "Small Difference (≤20)"), (20, 41, "Medium Difference (21-100)"), (100, 200, "Medium Difference (21-100)"), (100, 201, "Large Difference (>100)"),
])
def test_category(spark, a, b, expected):
    df = spark.createDataFrame([(None if a is None else float(a), None if b is None else float(b))], "a double, b double")
    assert df.select(S.discrepancy_category(F.col("a"), F.col("b")).alias("x")).first()["x"] == expected


def test_gap_fill(spark):
    rows = [(99.0, 99.0, None, 99.0), (100.0, 100.0, None, 0.0), (100.0, 100.0, "Protracted 2", 100.0), (100.0, 90.0, "Grade 3", 90.0)]
    df = spark.createDataFrame(rows, "t double, c double, g string, e double")
    assert df.filter(S.fill_confirmed(F.col("t"), F.col("c"), F.col("g")) != F.col("e")).isEmpty()
    rows = [(100.0, 1.0, 2.0, 1.0), (100.0, 1.0, 2.01, 2.0), (0.0, 1.0, 50.0, 1.0), (100.0, 1.0, 0.0, 1.0), (50.0, 9.0, 5.0, 2.0)]
    df = spark.createDataFrame(rows, "t double, d double, r double, e double")
    assert df.filter(S.fill_deaths(F.col("t"), F.col("d"), F.col("r")) != F.col("e")).isEmpty()


@pytest.mark.parametrize("text, expected", [("é(", "é ("), ("Crisis(North)", "Crisis (North)"), ("Humanitarian  crisis", "Complex Humanitarian crisis"), ("yellowFever", "yellow Fever"), (None, None)])
def test_event_name(spark, text, expected):
    assert value(spark, N.event_name, text) == expected


@pytest.mark.parametrize("text, expected", [("Central AfricanRepublic", "Central African Republic"), ("CÃ´te d'Ivoire", "Côte d'Ivoire"), ("DRC", "Democratic Republic of the Congo"), ("Kenya", "Kenya")])
def test_country_name(spark, text, expected):
    assert value(spark, N.country_name, text) == expected


@pytest.mark.parametrize("name, padded, bare", [("Week_21__19_-_25_May_2025.csv", "2025-21", "2025-21"), ("OEW42-2025.pdf", "2025-42", "2025-42"), ("OEW05-232901.pdf", "2020-05", "2020-05"), ("OEW7-2021.pdf", "2021-07", "2021-7"), ("OEW7-1999.pdf", None, None), ("x.pdf", None, None)])
def test_year_week(spark, name, padded, bare):
    assert value(spark, N.year_week, name) == padded
    assert value(spark, lambda c: N.year_week(c, pad=False), name) == bare


def test_extraction_file(spark):
    parts = lambda c: F.struct(*[x.alias(f"p{i}") for i, x in enumerate(N.extraction_file(c))])
    assert tuple(value(spark, parts, "OEW42-2025_gpt-5_210.csv")) == (42, 2025, "gpt-5", 210)
    assert tuple(value(spark, parts, "OEW42-2025_gpt-5_x.csv")) == (42, 2025, "gpt-5", 0)


def test_versions_sort_by_number(spark):
    df = spark.createDataFrame([("v1.2.0",), ("v1.10.0",), ("v1.9.1",)], "v string")
    assert [r["v"] for r in df.orderBy(S.version_key(F.col("v"))).collect()] == ["v1.2.0", "v1.9.1", "v1.10.0"]


def test_keys_treat_null_differently(spark):
    assert value(spark, S.composite_key, "a", None) is None
    assert value(spark, S.text_key, "a", None) == "a|nan"


def test_fuzzy_header():
    assert [N.fuzzy_header(h) for h in ("COUNTRY\nname", "Total  cases", "Other Thing", None)] == ["Country", "Total_Cases", "Other_Thing", ""]

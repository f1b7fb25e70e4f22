"""A deterministic pair of sources derived from the order tables.

``side_a`` aggregates line items per nation, priority, year and quarter;
``side_b`` is a copy of all rows with events relabelled, which makes them
one-sided, and values altered by fixed arithmetic. ``SIDES_SQL`` is the same in SQL, as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table


def side_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    rows = (
        t("lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
        .join(t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    keys = [F.col("n_nationkey").alias("nk"), F.col("n_name").alias("Country"), F.col("o_orderpriority").alias("Event"), F.year("o_orderdate").alias("Year"), F.quarter("o_orderdate").alias("WeekNumber")]
    grouped = rows.groupBy(*keys).agg(
        F.sum("l_quantity").cast("long").alias("TotalCases"),
        F.coalesce(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))), F.lit(0.0)).cast("long").alias("CasesConfirmed"),
        F.count(F.when(F.col("l_returnflag") == "A", 1)).alias("Deaths"),
        F.min("c_mktsegment").alias("Grade"),
    )
    return grouped.withColumn("CFR", F.col("Deaths") * 100.0 / F.col("TotalCases"))


def side_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = side_a(spark, sf_dir)
    m = F.expr("(nk * 7 + WeekNumber + Year) % 11")
    total = F.when(m == 0, F.expr("TotalCases div 10")).when(m == 1, F.expr("TotalCases div 1000")).when(m == 2, F.col("TotalCases") + 50).when(m == 3, F.col("TotalCases") + 5).otherwise(F.col("TotalCases"))
    a = a.withColumn("TotalCases", total)
    return a.withColumns({
        "Event": F.expr("CASE WHEN (nk * 5 + WeekNumber) % 17 = 0 THEN concat(Event, '*') ELSE Event END"),
        "CasesConfirmed": F.expr("CASE WHEN (nk + Year) % 7 = 0 THEN TotalCases ELSE CasesConfirmed END"),
        "Deaths": F.expr("CASE WHEN (nk + WeekNumber) % 5 = 0 THEN 0L ELSE Deaths END"),
        "Grade": F.expr("CASE WHEN (nk + Year) % 19 = 0 THEN NULL ELSE Grade END"),
    })


SIDES_SQL = """
side_a AS (
  SELECT n_nationkey AS nk, n_name AS Country, o_orderpriority AS Event, CAST(year(o_orderdate) AS INT) AS Year, CAST(quarter(o_orderdate) AS INT) AS WeekNumber,
    CAST(sum(l_quantity) AS BIGINT) AS TotalCases, CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS BIGINT) AS CasesConfirmed,
    count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS Deaths, min(c_mktsegment) AS Grade,
    count(CASE WHEN l_returnflag = 'A' THEN 1 END) * CAST(100.0 AS DOUBLE) / CAST(sum(l_quantity) AS BIGINT) AS CFR
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4, 5),
altered AS (
  SELECT *, CASE (nk * 7 + WeekNumber + Year) % 11 WHEN 0 THEN TotalCases // 10 WHEN 1 THEN TotalCases // 1000 WHEN 2 THEN TotalCases + 50 WHEN 3 THEN TotalCases + 5 ELSE TotalCases END AS NewTotal
  FROM side_a),
side_b AS (
  SELECT nk, Country, CASE WHEN (nk * 5 + WeekNumber) % 17 = 0 THEN Event || '*' ELSE Event END AS Event, Year, WeekNumber, NewTotal AS TotalCases,
    CASE WHEN (nk + Year) % 7 = 0 THEN NewTotal ELSE CasesConfirmed END AS CasesConfirmed, CASE WHEN (nk + WeekNumber) % 5 = 0 THEN 0 ELSE Deaths END AS Deaths,
    CASE WHEN (nk + Year) % 19 = 0 THEN NULL ELSE Grade END AS Grade, CFR FROM altered)"""

PAIRS_SQL = SIDES_SQL + """,
pairs AS (
  SELECT a.Year, a.WeekNumber, a.Country, a.Event,
    a.TotalCases AS llm_TotalCases, b.TotalCases AS rule_based_TotalCases, a.CasesConfirmed AS llm_CasesConfirmed, b.CasesConfirmed AS rule_based_CasesConfirmed,
    a.Deaths AS llm_Deaths, b.Deaths AS rule_based_Deaths, a.CFR AS llm_CFR, b.CFR AS rule_based_CFR, a.Grade AS llm_Grade, b.Grade AS rule_based_Grade,
    abs(a.TotalCases - b.TotalCases) > 0.01 AS TotalCases_discrepancy, abs(a.CasesConfirmed - b.CasesConfirmed) > 0.01 AS CasesConfirmed_discrepancy,
    abs(a.Deaths - b.Deaths) > 0.01 AS Deaths_discrepancy, abs(a.CFR - b.CFR) > 0.01 AS CFR_discrepancy, a.Grade IS DISTINCT FROM b.Grade AS Grade_discrepancy
  FROM side_a a JOIN side_b b ON a.Country = b.Country AND a.Event = b.Event AND a.Year = b.Year AND a.WeekNumber = b.WeekNumber)"""

LONG_SQL = PAIRS_SQL + """,
long AS (
  SELECT Year, WeekNumber, Country, Event, 'TotalCases' AS Parameter, CAST(llm_TotalCases AS DOUBLE) AS a, CAST(rule_based_TotalCases AS DOUBLE) AS b, TotalCases_discrepancy AS Discrepancy FROM pairs
  UNION ALL SELECT Year, WeekNumber, Country, Event, 'CasesConfirmed', llm_CasesConfirmed, rule_based_CasesConfirmed, CasesConfirmed_discrepancy FROM pairs
  UNION ALL SELECT Year, WeekNumber, Country, Event, 'Deaths', llm_Deaths, rule_based_Deaths, Deaths_discrepancy FROM pairs
  UNION ALL SELECT Year, WeekNumber, Country, Event, 'CFR', llm_CFR, rule_based_CFR, CFR_discrepancy FROM pairs
  UNION ALL SELECT Year, WeekNumber, Country, Event, 'Grade', NULL, NULL, Grade_discrepancy FROM pairs),
categorized AS (
  SELECT *, CASE WHEN b <> 0 THEN a / b END AS Ratio,
    CASE WHEN coalesce(a, 0) = 0 AND coalesce(b, 0) = 0 THEN 'Both Zero' WHEN coalesce(a, 0) = 0 OR coalesce(b, 0) = 0 THEN 'Zero vs Non-Zero'
      WHEN a > b AND b > 0 AND ((a / b > 900 AND a / b < 1100) OR (a / b > 9 AND a / b < 11) OR (a / b > 90 AND a / b < 110)) THEN 'Comma/Thousands Issue'
      WHEN abs(a - b) > 100 THEN 'Large Difference (>100)' WHEN abs(a - b) > 20 THEN 'Medium Difference (21-100)' ELSE 'Small Difference (≤20)' END AS Category
  FROM long)"""

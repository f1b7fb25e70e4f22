"""Accuracy, coverage and agreement metrics over paired rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import reconcile as R


def numeric_agreement(pairs: DataFrame, columns: dict[str, tuple[str, str]], tolerance: float = 0.1) -> DataFrame:
    """mae, rmse, Pearson correlation and share within a relative tolerance, a row
    per column. Missing pairs count as misses; a constant side has no correlation."""
    entries = [F.struct(F.lit(n).alias("column"), R.as_number(pairs, a).alias("a"), R.as_number(pairs, b).alias("b")) for n, (a, b) in columns.items()]
    long = pairs.select(F.inline(F.array(*entries)))
    close = F.coalesce(F.abs((F.col("a") - F.col("b")) / (F.col("b") + F.lit(1e-10))) <= tolerance, F.lit(False))
    gap = F.col("a") - F.col("b")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    a, b = F.when(both, F.col("a")), F.when(both, F.col("b"))
    stats = long.groupBy("column").agg(
        F.count("*").alias("total_records"), F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(close.cast("double")).alias("_close"), F.avg("a").alias("llm_mean"), F.avg("b").alias("baseline_mean"),
        F.covar_pop(a, b).alias("_cov"), F.stddev_pop(a).alias("_sa"), F.stddev_pop(b).alias("_sb"),
    )
    flat = (F.col("_sa") > 0) & (F.col("_sb") > 0)
    return stats.select("column", "total_records", "mae", "rmse", F.when(flat, F.col("_cov") / (F.col("_sa") * F.col("_sb"))).alias("correlation"), (F.col("_close") * 100).alias("within_tolerance_pct"), "llm_mean", "baseline_mean")


def categorical_agreement(pairs: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Exact-match share and distinct values per side and in common; a missing
    value is the empty string."""
    entries = [F.struct(F.lit(n).alias("column"), F.coalesce(F.col(a).cast("string"), F.lit("")).alias("a"), F.coalesce(F.col(b).cast("string"), F.lit("")).alias("b")) for n, (a, b) in columns.items()]
    long = pairs.select(F.inline(F.array(*entries)))
    match = long.groupBy("column").agg((F.avg((F.col("a") == F.col("b")).cast("double")) * 100).alias("exact_match_pct"))
    values = long.select("column", F.inline(F.array(F.struct(F.col("a").alias("value"), F.lit(1).alias("left"), F.lit(0).alias("right")), F.struct(F.col("b").alias("value"), F.lit(0).alias("left"), F.lit(1).alias("right")))))
    per = values.groupBy("column", "value").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    counts = per.groupBy("column").agg(F.sum("left").alias("llm_unique"), F.sum("right").alias("baseline_unique"), F.sum(F.col("left") * F.col("right")).alias("common_values"))
    return match.join(counts, "column")


def one_sided_values(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """(value, side) of values that one side has alone."""
    a, b = (pairs.select(F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")).distinct() for c in (left, right))
    return a.subtract(b).withColumn("side", F.lit("llm")).union(b.subtract(a).withColumn("side", F.lit("baseline")))


def accuracy(pairs: DataFrame, values=S.COMPARED, by=()) -> DataFrame:
    """Per group: compared, discrepant, accuracy, and each field's count and rate."""
    any_ = reduce(lambda a, b: a | b, [F.col(f"{v}_discrepancy") for v in values])
    flag = lambda c: F.sum(c.cast("long"))
    total = F.count("*")
    out = [total.alias("total_compared"), flag(any_).alias("total_discrepant"), S.percent(total - flag(any_), total).alias("overall_accuracy_pct"), S.percent(flag(any_), total).alias("discrepancy_rate_pct")]
    for v in values:
        out += [flag(F.col(f"{v}_discrepancy")).alias(f"{v}_discrepancies"), S.percent(total - flag(F.col(f"{v}_discrepancy")), total).alias(f"{v}_accuracy_pct")]
    return pairs.groupBy(*by).agg(*out) if by else pairs.agg(*out)


def problem_fields(pairs: DataFrame, values=S.COMPARED, above: float = 10) -> DataFrame:
    """Fields whose discrepancy rate exceeds ``above`` percent, the worst first."""
    long = R.long_form(pairs, values, keep=())
    rates = long.groupBy(F.col("Parameter").alias("field")).agg(S.percent(F.sum(F.col("Discrepancy").cast("long")), F.count("*")).alias("discrepancy_rate"))
    return rates.filter(F.col("discrepancy_rate") > above).orderBy(F.desc("discrepancy_rate"), "field")


def coverage(left: DataFrame, right: DataFrame, keys=(*R.PERIOD, *R.KEYS)) -> DataFrame:
    compared_, alone = R.common(left, right, keys).agg(F.count("*").alias("compared")), R.only_left(right, left, keys).agg(F.count("*").alias("baseline_only"))
    both = compared_.join(alone)  # two one-row aggregates
    return both.select("compared", "baseline_only", S.percent(F.col("compared"), F.col("compared") + F.col("baseline_only")).alias("coverage_rate_pct"))


def evaluation(left: DataFrame, right: DataFrame, values=("TotalCases", "CasesConfirmed", "Deaths", "CFR"), keys=(*R.PERIOD, *R.KEYS)) -> DataFrame:
    """Coverage and precision over distinct keys, the share of pairs right in all
    fields, and their weighted sum (0.3, 0.3, 0.4), in percent."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    shared = a.join(b, R.on(a, b, keys), "left_semi")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    pairs = R.compared(left, right, keys, values)
    right_all = reduce(lambda x, y: x & y, [~F.col(f"{v}_discrepancy") for v in values])
    one = n(a, "left_keys").join(n(b, "right_keys")).join(n(shared, "shared")).join(pairs.agg(F.coalesce(F.sum(right_all.cast("long")), F.lit(0)).alias("all_right")))
    cov, pre, acc = (F.coalesce(F.try_divide(F.col(x), F.col(y)) * 100, F.lit(0.0)) for x, y in (("shared", "right_keys"), ("shared", "left_keys"), ("all_right", "shared")))
    return one.select("left_keys", "right_keys", "shared", "all_right", F.bround(cov, 2).alias("coverage"), F.bround(pre, 2).alias("precision"), F.bround(acc, 2).alias("overall_accuracy"), F.bround(cov * 0.3 + pre * 0.3 + acc * 0.4, 2).alias("composite_score"))


def field_accuracy(pairs: DataFrame, values=S.COMPARED) -> DataFrame:
    long = R.long_form(pairs, values, keep=())
    right = F.sum((~F.col("Discrepancy")).cast("long"))
    return long.groupBy(F.col("Parameter").alias("field")).agg(right.alias("correct"), F.count("*").alias("total"), S.percent(right, F.count("*")).alias("accuracy"))


def missing_values(df: DataFrame, columns) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNull().cast("long").alias("gap")) for c in columns])
    return df.select(F.inline(entries)).groupBy("column").agg(F.sum("gap").alias("missing"), S.percent(F.sum("gap"), F.count("*")).alias("missing_pct"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts, most frequent first, equal ones by value; with each one's share."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    counts = counts.join(F.broadcast(total)).select("value", "n", S.percent(F.col("n"), F.col("total")).alias("share_pct"))
    return counts.orderBy(F.desc("n"), "value").limit(top) if top else counts


def capture_rates(reference: DataFrame, found: DataFrame, by: str = "Event", keys=(*R.PERIOD, *R.KEYS)) -> DataFrame:
    """Per group of the reference: how many records the other side found."""
    seen = found.select(*keys).distinct().withColumn("_seen", F.lit(1))
    marked = reference.join(seen, R.on(reference, seen, keys), "left").select(reference[by], "_seen")
    got = F.count("_seen")
    return marked.groupBy(by).agg(F.count("*").alias("total"), got.alias("captured"), (F.count("*") - got).alias("missing"), S.percent(got, F.count("*")).alias("capture_pct"))


def version_matrix(pairs: DataFrame) -> DataFrame:
    """Accuracy by version and model, with each version's mean and the best model."""
    per = accuracy(pairs, by=("version", "model")).select("version", "model", "total_compared", "overall_accuracy_pct")
    return per.groupBy("version").agg(
        F.avg("overall_accuracy_pct").alias("mean_accuracy"), F.max("overall_accuracy_pct").alias("best_accuracy"), F.count("*").alias("models"),
        F.max_by("model", F.struct("overall_accuracy_pct", "model")).alias("best_model"),
    )


def accuracy_text(df: DataFrame, fields: tuple[str, ...], out: str = "summary") -> DataFrame:
    """The report's text of each row of metrics (prompt_version, overall_accuracy,
    compared, discrepant, coverage, and an accuracy per field)."""
    line = lambda text, c, end="": F.concat(F.lit(text), F.col(c).cast("string"), F.lit(end))
    parts = [line("Accuracy Analysis Summary (Prompt ", "prompt_version", ")"), line("   Overall Accuracy: ", "overall_accuracy", "%"), line("   Records Compared: ", "compared"), line("   Discrepant Records: ", "discrepant"), line("   Coverage Rate: ", "coverage", "%")]
    parts += [line(f"   {f}: ", f, "%") for f in fields]
    return df.withColumn(out, F.when(F.col("compared") == 0, "No records available for accuracy analysis.").otherwise(F.concat_ws("\n", *parts)))


def format_counts(df: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """One row: how many values match each pattern, and how many there are."""
    return df.agg(F.count(column).alias("n"), F.countDistinct(column).alias("n_distinct"), *[F.count(F.when(F.col(column).rlike(p), 1)).alias(k) for k, p in patterns.items()])


def stage_averages(df: DataFrame, by: str, confidence: str, seconds: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), F.bround(F.avg(confidence), 6).alias("avg_confidence"), F.bround(F.avg(seconds), 6).alias("avg_seconds"), F.max(seconds).alias("longest"))

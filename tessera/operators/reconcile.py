"""Two sources side by side: alignment, splits, comparison and categories.

Periods are ordinary key columns, so all weeks are compared in one plan. Keys
match null-safely: a missing key part equals a missing one. Equal keys on both
sides pair many-to-many, unless ``first_only`` keeps the first by ``_seq``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.functions import scalars as S

KEYS = ("Country", "Event")
PERIOD = ("Year", "WeekNumber")
SIDES = ("llm", "rule_based")


def on(left: DataFrame, right: DataFrame, keys) -> object:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def common(left: DataFrame, right: DataFrame, keys=(*PERIOD, *KEYS)) -> DataFrame:
    right = right.select(*keys).distinct()
    return left.join(right, on(left, right, keys), "left_semi")


def only_left(left: DataFrame, right: DataFrame, keys=(*PERIOD, *KEYS)) -> DataFrame:
    return left.join(right, on(left, right, keys), "left_anti")


def unique_records(left: DataFrame, right: DataFrame, keys=(*PERIOD, *KEYS)) -> DataFrame:
    """What either side has alone, tagged with its side."""
    a = only_left(left, right, keys).withColumn("unique_source", F.lit("LLM"))
    return a.unionByName(only_left(right, left, keys).withColumn("unique_source", F.lit("RuleBased")), allowMissingColumns=True)


def in_shared_periods(left: DataFrame, right: DataFrame, period=PERIOD) -> tuple[DataFrame, DataFrame]:
    a, b = left.select(*period).distinct(), right.select(*period).distinct()
    return left.join(b, list(period), "left_semi"), right.join(a, list(period), "left_semi")


def first_of(df: DataFrame, keys, order) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def paired(left: DataFrame, right: DataFrame, keys=(*PERIOD, *KEYS), values=S.COMPARED, names=SIDES, first_only=None) -> DataFrame:
    """Inner join on the keys, each side's values under its name's prefix."""
    if first_only:
        left, right = first_of(left, keys, first_only), first_of(right, keys, first_only)
    a = left.select(*keys, *[F.col(v).alias(f"{names[0]}_{v}") for v in values])
    b = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(v).alias(f"{names[1]}_{v}") for v in values])
    match = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_{k}"]) for k in keys])
    return a.join(b, match).drop(*[f"_{k}" for k in keys])


def aligned_by_position(left: DataFrame, right: DataFrame, keys, values, order) -> DataFrame:
    """Pairs the n-th row of a key left with the n-th right, keys as text."""
    key = S.text_key(*[F.col(k) for k in keys])
    place = lambda df, p: df.select(key.alias("key"), *[F.col(v).alias(f"{p}_{v}") for v in values], F.row_number().over(Window.partitionBy(key).orderBy(*order)).alias("n"))
    return place(left, "left").join(place(right, "right"), ["key", "n"])


def compared(left: DataFrame, right: DataFrame, keys=(*PERIOD, *KEYS), values=S.COMPARED, tolerance=S.TOLERANCE, names=SIDES) -> DataFrame:
    """The pairs with a flag <value>_discrepancy each."""
    both = paired(left, right, keys, values, names)
    match = lambda a, b: (S.close if numeric(both, a) and numeric(both, b) else S.values_match)(F.col(a), F.col(b), tolerance)
    return both.withColumns({f"{v}_discrepancy": ~match(f"{names[0]}_{v}", f"{names[1]}_{v}") for v in values})


def numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NumericType)


def as_number(df: DataFrame, column: str):
    """The column as a double; text is parsed, and null where it is no number."""
    return F.col(column).cast("double") if numeric(df, column) else S.number_or_null(F.col(column))


def discrepant(pairs: DataFrame, values=S.COMPARED) -> DataFrame:
    return pairs.filter(reduce(lambda a, b: a | b, [F.col(f"{v}_discrepancy") for v in values]))


def long_form(pairs: DataFrame, values=S.COMPARED, keep=(*PERIOD, *KEYS), names=SIDES) -> DataFrame:
    """One row per pair and compared value: text and, where one, number."""
    entries = [
        F.struct(
            F.lit(v).alias("Parameter"),
            F.col(f"{names[0]}_{v}").cast("string").alias("LLM"), F.col(f"{names[1]}_{v}").cast("string").alias("RuleBased"),
            as_number(pairs, f"{names[0]}_{v}").alias("LLM_numeric"), as_number(pairs, f"{names[1]}_{v}").alias("RuleBased_numeric"),
            F.col(f"{v}_discrepancy").alias("Discrepancy"),
        )
        for v in values
    ]
    return pairs.select(*keep, F.inline(F.array(*entries)))


def categorized(long: DataFrame, grade_aware: bool = False) -> DataFrame:
    """Ratio, category and sub-category. A value that is no number counts as 0,
    so a grade is always ``Both Zero`` unless ``grade_aware``."""
    a, b = F.col("LLM_numeric"), F.col("RuleBased_numeric")
    category = S.discrepancy_category(a, b)
    if grade_aware:
        category = F.when(F.col("Parameter") == "Grade", F.when(F.col("Discrepancy"), "Grade Mismatch").otherwise("Grade Match")).otherwise(category)
    ratio = F.when(b != 0, a / b)
    out = long.withColumns({"Ratio": ratio, "Category": category})
    return out.withColumn("SubCategory", F.when(F.col("Category") == "Zero vs Non-Zero", S.zero_side(a, b)).otherwise(""))


def reconciled(left: DataFrame, right: DataFrame, keys=(*PERIOD, *KEYS), values=S.COMPARED, tolerance=S.TOLERANCE, names=SIDES) -> DataFrame:
    """Both sides in one full outer join: the keys, ``in_left`` and ``in_right``,
    each side's values under its prefix, and a flag <value>_discrepancy each
    (null on one-sided rows).

    Equal keys pair many-to-many, so ``left_once`` and ``right_once`` mark one of
    the rows of each record: summed, they count records. Splits, pairs, the long
    form and all counts are filters and aggregates of this frame; each side is
    scanned and exchanged once.
    """

    def side(df: DataFrame, prefix: str, flag: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_{flag}_{k}") for k in keys], *[F.col(v).alias(f"{prefix}_{v}") for v in values], F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))).alias(f"_{flag}_n"))

    a, b = side(left, names[0], "l"), side(right, names[1], "r")
    both = a.join(b, reduce(lambda x, y: x & y, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys]), "full")
    match = lambda x, y: (S.close if numeric(both, x) and numeric(both, y) else S.values_match)(F.col(x), F.col(y), tolerance)
    in_left, in_right = F.col("_l_n").isNotNull(), F.col("_r_n").isNotNull()
    return both.select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys], in_left.alias("in_left"), in_right.alias("in_right"),
        (in_left & F.coalesce(F.col("_r_n") == 1, F.lit(True))).alias("left_once"), (in_right & F.coalesce(F.col("_l_n") == 1, F.lit(True))).alias("right_once"),
        *[f"{n}_{v}" for n in names for v in values],
        *[F.when(in_left & in_right, ~match(f"{names[0]}_{v}", f"{names[1]}_{v}")).alias(f"{v}_discrepancy") for v in values],
    )


def weekly_summary(left: DataFrame, right: DataFrame, period=PERIOD, keys=KEYS, values=S.COMPARED) -> DataFrame:
    """Counts per period that both sides have: records, unique ones, differing values."""
    return summed_by_period(reconciled(left, right, (*period, *keys), values), period, values)


def summed_by_period(both: DataFrame, period=PERIOD, values=S.COMPARED) -> DataFrame:
    differing = reduce(lambda x, y: x + y, [F.coalesce(F.col(f"{v}_discrepancy").cast("long"), F.lit(0)) for v in values])
    out = both.groupBy(*period).agg(
        F.count_if("left_once").alias("LLMRecords"), F.count_if("right_once").alias("RuleBasedRecords"), F.count_if(F.col("in_left") & ~F.col("in_right")).alias("LLMOnly"),
        F.count_if(~F.col("in_left") & F.col("in_right")).alias("RuleBasedOnly"), F.coalesce(F.sum(differing), F.lit(0)).alias("ValueDiscrepancies"),
    )
    out = out.filter("LLMRecords > 0 AND RuleBasedRecords > 0")
    return out.withColumn("RecordDifference", F.col("LLMRecords") - F.col("RuleBasedRecords"))


def rate_consistency(left: DataFrame, right: DataFrame, long: DataFrame, keys=(*PERIOD, *KEYS), order=("TotalCases", "Deaths", "CFR")) -> DataFrame:
    """For the discrepant rates: which side's rate is nearer its own counts.

    Each side is looked up once a key (its first row by ``order``).
    """
    side = lambda df, p: first_of(df, keys, order).select(*keys, S.implied_rate(F.col("Deaths"), F.col("TotalCases")).alias(f"{p}_calc"), S.rate_error(F.col("Deaths"), F.col("TotalCases"), F.col("CFR")).alias(f"{p}_error"))
    rows = long.filter("Parameter = 'CFR' AND Discrepancy").select(*keys).distinct()
    both = rows.join(side(left, "llm"), list(keys), "left").join(side(right, "rule_based"), list(keys), "left")
    both = both.withColumns({f"{p}_error": F.coalesce(f"{p}_error", F.lit(S.NO_ERROR)) for p in SIDES})
    both = both.filter((F.col("llm_error") < S.NO_ERROR) | (F.col("rule_based_error") < S.NO_ERROR))
    return both.withColumn("llm_better", F.col("llm_error") < F.col("rule_based_error"))


def consistency_wins(rates: DataFrame) -> DataFrame:
    return rates.agg(
        F.count("*").alias("total"), F.sum(F.col("llm_better").cast("long")).alias("llm_wins"), F.sum((~F.col("llm_better")).cast("long")).alias("rule_based_wins"),
        S.percent(F.sum(F.col("llm_better").cast("long")), F.count("*"), 1).alias("llm_win_pct"),
    )


def report(left: DataFrame, right: DataFrame) -> dict[str, DataFrame]:
    """All frames of a reconciliation, lazily: nothing runs until one is used.

    Summary, pairs, categories and long form come from one ``reconciled`` frame,
    which a caller who uses several of them may persist under "reconciled".
    """
    left, right = in_shared_periods(left, right)
    both = reconciled(left, right)
    pairs = both.filter("in_left AND in_right")
    long = categorized(long_form(pairs))
    rates = rate_consistency(left, right, long)
    return {
        "reconciled": both, "summary": summed_by_period(both), "discrepancies": discrepant(pairs).drop("in_left", "in_right", "left_once", "right_once"), "discrepancies_long": long,
        "categories": long.filter("Discrepancy").groupBy("Category").count(), "cfr": rates, "cfr_wins": consistency_wins(rates),
        "llm_only": only_left(left, right), "rule_based_only": only_left(right, left), "unique": unique_records(left, right),
    }

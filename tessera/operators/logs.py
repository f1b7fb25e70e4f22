"""Run logs: identifiers, queries, summaries and updates kept beside the log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalars as S


def query(logs: DataFrame, where: str | None = None, order: str | None = None, limit: int = 0, columns=("*",), **equal) -> DataFrame:
    """Optional equalities, a condition, an order; ``limit`` 0 means all."""
    out = logs
    for name, value in equal.items():
        out = out if value is None else out.filter(F.col(name) == F.lit(value))
    out = out.filter(where) if where else out
    if order:
        out = out.orderBy(*[F.expr(o[:-5]).desc() if o.upper().endswith(" DESC") else F.expr(o) for o in (x.strip() for x in order.split(","))])
    out = out.limit(limit) if limit else out
    return out.select(*columns)


def sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Any SQL over the given tables."""
    return spark.sql(text, **views)


def latest(logs: DataFrame, n: int = 10, by: str = "timestamp", tie: str = "id") -> DataFrame:
    return logs.orderBy(F.desc(by), F.desc(tie)).limit(n)


def latest_of(logs: DataFrame, key: str, by: str = "timestamp", tie: str = "id") -> DataFrame:
    """The newest row of each key."""
    return logs.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(by), F.desc(tie)))).filter("_rn = 1").drop("_rn")


def performance(logs: DataFrame, newest: int = 1000) -> DataFrame:
    """Summary of the newest calls; a time of zero is no time."""
    rows = latest(logs, newest)
    seconds = F.when(F.col("execution_time_seconds") != 0, F.col("execution_time_seconds"))
    good = F.sum(F.col("parsed_success").cast("long"))
    total = F.coalesce(F.sum("records_extracted"), F.lit(0))
    return rows.agg(
        F.count("*").alias("total_calls"), good.alias("successful_parses"), S.percent(good, F.count("*")).alias("success_rate_pct"), total.alias("total_records"),
        F.bround(F.try_divide(total, F.count("*")), 2).alias("avg_records"), F.bround(F.avg(seconds), 2).alias("avg_seconds"), F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"),
    )


def model_statistics(logs: DataFrame, by: str = "model_name") -> DataFrame:
    return logs.groupBy(by).agg(
        F.count("*").alias("runs"), F.sum(F.col("parsed_success").cast("long")).alias("successes"), F.avg("records_extracted").alias("avg_records"),
        F.avg("execution_time_seconds").alias("avg_seconds"), F.min("timestamp").alias("first_run"), F.max("timestamp").alias("last_run"),
    )


def next_id(*tables: DataFrame, column: str = "id") -> DataFrame:
    """One more than the largest id of all tables, 1 if there is none."""
    ids = reduce(lambda a, b: a.unionByName(b), [t.select(F.col(column).cast("long").alias("id")) for t in tables])
    return ids.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("next_id"))


def numbered(rows: DataFrame, order, *tables: DataFrame, column: str = "id", parts: int | None = None) -> DataFrame:
    """Rows with ids in ascending ``order`` after the largest of the tables.

    Rows are dealt into ranges of about equal counts and written, each range is
    counted and numbered by itself, and what lies before it is added: no task
    holds more than a range, and no row looks at the ranges. Equal keys are told
    apart by a hash of the whole row, so only rows equal throughout share a range
    for sure.
    """
    from tessera.plans.operations import scratch

    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = [c for c, t in rows.dtypes if "map<" not in t and t != "variant"]
    keyed = rows.withColumn("_key", F.struct(*order, F.xxhash64(*hashed).alias("_hash")))
    ranged, folder = keyed.repartitionByRange(parts, "_key").withColumn("_range", F.spark_partition_id()), scratch(rows.sparkSession, "ranges")
    ranged.write.parquet(folder)
    ranged = rows.sparkSession.read.schema(ranged.schema).parquet(folder)
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a range
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    base = next_id(*tables, column=column).withColumnRenamed("next_id", "_base") if tables else rows.sparkSession.range(1).select(F.lit(1).cast("long").alias("_base"))
    out = ranged.join(F.broadcast(before), F.col("_range") == F.col("_of")).withColumn("_n", place).join(F.broadcast(base))
    return out.withColumn(column, F.col("_base") + F.col("_before") + F.col("_n") - 1).drop("_key", "_range", "_of", "_before", "_n", "_base")


def with_metrics(logs: DataFrame, updates: DataFrame, column: str = "custom_metrics") -> DataFrame:
    """The log with the members of the side table's documents (id, metrics,
    updated_at) merged into each row's own, in place of an update.

    Members are merged one by one: a newer document's member takes the place of
    an older one's, all others stay. What is no JSON object counts as an empty
    one; rows without an update are left as they are, to the letter.
    """
    members = lambda c: F.coalesce(F.from_json(F.when(F.try_parse_json(c).isNotNull(), c), "map<string, variant>"), F.create_map().cast("map<string, variant>"))
    each = updates.filter("id IS NOT NULL").select("id", "updated_at", F.explode(members(F.col("metrics"))).alias("_k", "_v")).withColumn("_v", F.to_json("_v"))
    newest = each.groupBy("id", "_k").agg(F.max_by("_v", F.struct("updated_at", "_v")).alias("_v"))
    new = newest.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias("_new"))  # a document's members
    own = F.transform_values(members(F.col(column)), lambda _, v: F.to_json(v))
    merged = F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key("_new", k)), F.col("_new"))
    text = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(merged), lambda e: F.concat(F.to_json(F.array(e["key"])).substr(F.lit(2), F.length(F.to_json(F.array(e["key"]))) - 2), F.lit(":"), F.coalesce(e["value"], F.lit("null")))), ","), F.lit("}"))
    return logs.join(new, "id", "left").withColumn(column, F.when(F.col("_new").isNotNull(), text).otherwise(F.col(column))).drop("_new")


def unknown_updates(logs: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates whose id the log does not have."""
    return updates.join(logs.select("id"), "id", "left_anti")


def lacking_metrics(logs: DataFrame, column: str = "custom_metrics", path: str = "$.accuracy_metrics") -> DataFrame:
    return logs.filter(F.get_json_object(column, path).isNull())


def outcome_counts(logs: DataFrame, by: str = "status") -> DataFrame:
    return logs.groupBy(by).agg(F.count("*").alias("runs"), F.coalesce(F.sum("records_extracted"), F.lit(0)).alias("records"))


def since(logs: DataFrame, now, days: int = 7, column: str = "timestamp") -> DataFrame:
    """Rows of the last ``days`` days before ``now`` (a column, such as current_timestamp())."""
    return logs.filter(F.col(column) >= now - F.expr(f"INTERVAL {days} DAYS"))


def run_id():
    """The seconds since 1970 at which a query runs."""
    return F.unix_timestamp(F.current_timestamp())


def linked_runs(logs: DataFrame, preprocessing: DataFrame, metrics: DataFrame, id_col: str = "id", preprocessing_id: str = "preprocessing_id") -> DataFrame:
    """The log with each run's preprocessing (id, method, success) and its accuracy
    document (id, metrics); runs that lack either, or name none, stay with nulls.

    Of several documents of a run the greatest text counts, so no run is doubled.
    """
    before = preprocessing.select(F.col(id_col).alias("_pre"), F.col("method").alias("preprocessing_method"), F.col("success").alias("preprocessing_success"))
    before = before.filter("_pre IS NOT NULL").dropDuplicates(["_pre"])
    found = metrics.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_run")).agg(F.max("metrics").alias("accuracy_document"))
    out = logs.join(before, F.col(preprocessing_id) == F.col("_pre"), "left").join(found, F.col(id_col) == F.col("_run"), "left")
    return out.drop("_pre", "_run").withColumn("has_metrics", F.col("accuracy_document").isNotNull())


def current_versions(registry: DataFrame) -> DataFrame:
    """(kind, version, versions, marked) of a registry (kind, version, is_current):
    the version marked as current, the newest of several, else the newest by number."""
    order = F.struct(F.coalesce("is_current", F.lit(False)), S.version_key(F.col("version")), "version")
    return registry.groupBy("kind").agg(F.max_by("version", order).alias("version"), F.countDistinct("version").alias("versions"), F.bool_or(F.coalesce("is_current", F.lit(False))).alias("marked"))


def models_by_version(runs: DataFrame) -> DataFrame:
    """(version, models): the models that each version ran with, sorted."""
    return runs.groupBy("version").agg(F.sort_array(F.collect_set("model")).alias("models"))

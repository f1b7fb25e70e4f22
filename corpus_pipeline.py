"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents.

1. language_id predicts each text's language: documents without a letter
   (``und``) go, and a null ``lang`` becomes the prediction. A ``lang`` that is
   there is left as it is.
2. near_duplicates keeps of every class of similar texts the least id.
3. repeated_passages cuts out bytes that stand in a document with a smaller id.
4. decontamination drops documents into which a benchmark item leaks.
5. packing lays what is left into sequences of 1024 tokens.

Null texts are rejected by the first stage. A row is its id and text: of rows
equal in both one stays, another text of an id is a document of its own, and a
row without an id is one like any other, named after those with one. Ids are
integers. Columns besides those of documents, whatever their names, pass
through to the last stage. Stages of an empty table return none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chosenpath, language, packing, suffixes, tiling
from tessera.llm.common import bounded_batches, fresh, staged, staging_path, text_or_empty
from tessera.session import ship_package, table


BROADCAST_IDS = 1_000_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    bounded_batches(spark)
    label, found = language.language_columns(language.learn_profiles(docs, F.lit(True))), fresh(docs, "_lang")
    told = docs.withColumn(found, label("text")).filter(F.col(f"{found}.lang_pred") != language.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", F.col(f"{found}.lang_pred"))).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    own, key = fresh(docs, "_id"), fresh(docs, "_key")
    kept = chosenpath.representatives(docs).select(F.col("doc_id").alias(own), F.col("key").alias(key))
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64(text_or_empty()) == F.col(key))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return suffixes.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    own, key = fresh(docs, "_id"), fresh(docs, "_key")
    found = tiling.leaks(docs, table(spark, sf_dir, "benchmark"), keyed=True).select(F.col("doc_id").alias(own), F.col("key").alias(key))
    found = staged(found.distinct(), "leaks")
    # Few documents leak: counted, they need no shuffle of the texts.
    found = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64(text_or_empty()) == F.col(key))
    return docs.join(found, same, "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packed),
]

#: No stage's rules are expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs

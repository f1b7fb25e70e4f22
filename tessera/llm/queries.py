"""The thin queries: each applies one operator to its whole table."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, chosenpath, language, packing, quality, resharding, simhash, spelling, suffixes, tiling, vectorcodes, warc, winnowing
from tessera.llm.common import crc_of_id
from tessera.session import ship_package, table

QUERIES = {}
ORACLES = {}


def query(build):
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path, _ = resharding.reshard(docs, new_shards=40)
    rows, bases = resharding.read_shards(spark, path, docs.schema)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    slim = rows.select("doc_id", resharding.row_size().alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "_file", "_row")
    return slim.join(bases, "_file").select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("_base") + F.col("_row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = winnowing.fingerprints_with_edits(table(spark, sf_dir, "documents"))
    label = lambda c: F.sha2(F.col(c).cast("string").cast("binary"), 256)
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        label("kept").alias("fingerprint"), label("edited_kept").alias("edited_fingerprint"),
        winnowing.likeness("own_set", "edited_set").alias("near_edited"), winnowing.likeness("own_set", "next_set").alias("near_next"),
    )


@query
def op5_quality_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.pmod(crc_of_id(), F.lit(5)) == 0
    field = quality.learn_field(docs, labels, ~held_out)
    return quality.score_documents(docs, field).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op6_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(crc_of_id(), F.lit(4)) == 2
    profiles = language.learn_profiles(docs, ~held_out)
    return language.identify(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_report(table(spark, sf_dir, "documents"))


@query
def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.chosen_path_join(table(spark, sf_dir, "documents"))


ORACLES["op1_chat_formatting"] = """WITH c AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'null') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, len(text) + (len(text) - len(replace(text, chr(92), ''))) + CAST((len(text) - len(replace(text, '[INST]', ''))) / 6 AS BIGINT)
  + CAST((len(text) - len(replace(text, '[/INST]', ''))) / 7 AS BIGINT) + CAST((len(text) - len(replace(text, '</s>', ''))) / 4 AS BIGINT)
  + len(text) - len(regexp_replace(text, '<+', '<', 'g')) + len(text) - len(regexp_replace(text, '>+', '>', 'g')) AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(escaped + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 9 + len(role) END) AS BIGINT) AS formatted_chars, false AS rewrites
FROM e GROUP BY conv_id"""
ORACLES["op7_warc"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN strlen(h) >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN strlen(h) >= 1000 AND page_id < top THEN top END AS refers_to FROM p"""


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 1024)


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectorcodes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds unrolled: n1, n2 ... assign, b1, b2 ... are the codebooks."""
    nearest = """n{k} AS MATERIALIZED (SELECT x.vec_id, x.part, min((list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))), b.entry)) AS best
  FROM x JOIN b{k} b USING (part) GROUP BY ALL)"""
    book = """b{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN (
  SELECT part, entry, list(c ORDER BY i) AS v FROM (SELECT n.part, n.best[2] AS entry, i, CAST(sum(x.v[i]) - (sum(x.v[i]) % count(*) + count(*)) % count(*) AS BIGINT) // count(*) AS c
    FROM n{k} n JOIN x USING (vec_id, part), unnest(range(1, len(x.v) + 1)) u(i) GROUP BY ALL) GROUP BY ALL) m USING (part, entry))"""
    steps = [nearest.format(k=0)]
    for k in range(rounds):
        steps += [book.format(k=k, n=k + 1), nearest.format(k=k + 1)]
    return f"""WITH good AS (SELECT vec_id, label, list_transform(embedding, lambda e: CAST(floor(4096 * CAST(e AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (SELECT vec_id, part, q[part * len(q) // {parts} + 1 : (part + 1) * len(q) // {parts}] AS v FROM good, unnest(range({parts})) p(part)),
b0 AS MATERIALIZED (SELECT part, rank - 1 AS entry, v FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS rank FROM x) WHERE rank <= {entries}),
{", ".join(steps)},
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM b{rounds}),
coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(best[2] AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM n{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded JOIN good USING (vec_id), books"""


ORACLES["op11_vector_codes"] = _codes_sql()


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


@query
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))

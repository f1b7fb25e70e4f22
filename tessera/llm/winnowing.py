"""Document fingerprints by winnowing, in DataFrame expressions alone.

Tokens are words between white space; of scripts written without it (Han, kana,
Thai, Lao, Burmese, Khmer) each character is one, and a run of more than
``TOKEN`` characters (addresses, code, encoded data) is cut behind each of
``CUT``, so its tokens depend on what they hold and an insertion moves none of
those behind it. Only a stretch of 64 characters without one of these is cut by
its length. Every run of K tokens is hashed; of each window of W such hashes the
least is kept, the rightmost of equal ones, with its position. Two texts that
share K + W - 1 tokens in a row share a kept hash, and what is kept depends on
the window's content alone. A text with fewer than K tokens has one hash of them
all, one with fewer than W hashes is one window, and a blank text has an empty
fingerprint. Long texts are whole; columns other than id and text are ignored.

A kept entry is one long: the hash's upper 41 bits, below them the position
counted down (modulo 2**23) so that the least entry is the rightmost.

``with_next`` gives each row the text of the next lower id without a window
over the whole table: ids are cut into ranges of about equal counts, the rows
are dealt by range, and each range also gets the last row of the range below
it. The driver holds two ids a range. Null texts are empty; of rows with one id
the next lower in the order of text counts. Rows without an id come after those
with one, whatever the ranges, by text downwards; in a table without any id no
row has a next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, W, TOKEN = 4, 8, 16
CUT = "aeiou02468./_&=-"
_UNSPACED = "\\u0e00-\\u0eff\\u1000-\\u109f\\u1780-\\u17ff\\u3040-\\u30ff\\u3400-\\u9fff\\uf900-\\ufaff\\x{20000}-\\x{3ffff}"
_RUN = f"[^\\s{_UNSPACED}]"
_TOKENS = f"{_RUN}{{1,{TOKEN}}}(?!{_RUN})|[{_UNSPACED}]|{_RUN}{{0,63}}?[{CUT}]|{_RUN}{{64}}|{_RUN}+"
PLACE = 23
_MASK = (1 << PLACE) - 1


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the kept entries of ``text`` in order."""
    h, g, m = f"_{out}_h", f"_{out}_g", f"_{out}_m"
    df = df.withColumn(h, F.transform(F.regexp_extract_all(F.col(text), F.lit(_TOKENS), F.lit(0)), lambda t: F.xxhash64(t)))
    step, grams = 1, h
    while step < K:  # hashes of 2, 4, ... tokens from two neighbouring halves
        name = f"{g}{step}"
        df = df.withColumn(name, F.expr(f"zip_with(slice({grams}, 1, greatest(size({grams}) - {step}, 0)), slice({grams}, {step + 1}, greatest(size({grams}) - {step}, 0)), (a, b) -> xxhash64(a, b))"))
        df, grams, step = df.drop(grams) if grams != h else df, name, step * 2
    df = df.withColumn(m, F.expr(f"CASE WHEN size({grams}) = 0 AND size({h}) > 0 THEN array(xxhash64({h})) ELSE {grams} END")).drop(grams, h)
    df = df.withColumn(m, F.expr(f"transform({m}, (x, i) -> shiftleft(shiftright(x, {PLACE}), {PLACE}) | ({_MASK} - (i % {_MASK + 1})))"))
    low, step = m, 1
    while step < W:
        name = f"{m}{step}"
        df = df.withColumn(name, F.expr(f"zip_with(slice({low}, 1, greatest(size({low}) - {step}, 0)), slice({low}, {step + 1}, greatest(size({low}) - {step}, 0)), (a, b) -> least(a, b))"))
        df, low, step = df.drop(low) if low != m else df, name, step * 2
    few = f"CASE WHEN size({m}) = 0 THEN {m} ELSE array(array_min({m})) END"
    return df.withColumn(out, F.expr(f"CASE WHEN size({low}) = 0 THEN {few} ELSE array_distinct({low}) END")).drop(low, m)


def hashes(entries: str) -> Column:
    return F.array_distinct(F.transform(F.col(entries), lambda x: F.shiftright(x, PLACE)))


def positions(entries: str) -> Column:
    """The kept positions (exact below 2**23 tokens)."""
    return F.transform(F.col(entries), lambda x: F.lit(_MASK) - x.bitwiseAND(F.lit(_MASK)))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two hash sets; two empty ones are alike."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def range_of(id_col: str, lows: list[int]) -> Column:
    """Index of the range an id lies in, by binary decisions."""

    def tree(a: int, b: int) -> Column:
        if b - a == 1:
            return F.lit(a)
        mid = (a + b) // 2
        return F.when(F.col(id_col) < F.lit(lows[mid]), tree(a, mid)).otherwise(tree(mid, b))

    return F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(tree(0, len(lows)))


def with_next(df: DataFrame, columns: list[str], id_col: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """Adds next_<c> of the next row in descending id order, for each column;
    after the last row comes the first."""
    ranges = ranges or min(1024, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = df.select(id_col).repartitionByRange(ranges, id_col).groupBy(F.spark_partition_id().alias("p"))
    bounds = sorted((r["low"], r["high"]) for r in ids.agg(F.min(id_col).alias("low"), F.max(id_col).alias("high")).collect() if r["low"] is not None)
    if not bounds:
        return df.select("*", *[F.lit(None).cast(df.schema[c].dataType).alias(f"next_{c}") for c in columns])
    lows, highs = [b[0] for b in bounds], [b[1] for b in bounds]
    after = [h for h in highs]
    own = df.withColumn("_range", range_of(id_col, lows)).withColumn("_own", F.lit(1))
    edge = df.filter(F.col(id_col).isin(after)).groupBy(id_col).agg(F.max(F.struct("text", *[c for c in columns if c != "text"])).alias("_e"))
    edge = edge.select(id_col, "_e.*").withColumn("_range", F.pmod(range_of(id_col, lows) + 1, F.lit(len(lows)))).withColumn("_own", F.lit(0))
    order = Window.partitionBy("_range").orderBy("_own", id_col, "text")
    both = own.unionByName(edge, allowMissingColumns=True)
    return both.select("*", *[F.lag(c).over(order).alias(f"next_{c}") for c in columns]).filter("_own = 1").drop("_own", "_range")


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, and that of the text with its last third replaced
    by the beginning of the next document."""
    slim = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(fingerprint(slim, "text", "kept"), ["text", "kept"])
    third = F.expr("length(text) div 3").cast("int")
    rows = rows.withColumns({"next_text": F.coalesce("next_text", F.lit("")), "next_kept": F.coalesce("next_kept", F.array().cast("array<bigint>"))})
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(length(text) div 3 as int))"), F.substring("next_text", F.lit(1), third)))
    rows = fingerprint(rows.drop("next_text"), "edited", "edited_kept")
    return rows.select("*", hashes("kept").alias("own_set"), hashes("next_kept").alias("next_set"), hashes("edited_kept").alias("edited_set"))

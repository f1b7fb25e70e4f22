"""Product codes of integer vectors, screened by float32 matrix products.

A component x becomes floor(4096 * x). Vectors are cut into equal parts, and
every part position has a codebook of its own. The nearest entry of a codebook
is sought with one float32 matrix product a batch; each distance is known up to
a bound on the product's rounding error, so only entries whose interval reaches
below the least upper end are computed again, in int64, and the least index of
the least distances wins. The result is that of exact arithmetic.

Rows whose vector is null, or holds null or non-finite components, are dropped.
Vectors are ordered by ``vec_id`` (null ids last, then by the vector itself);
repeated rows are rows of their own. The dimension is that of the first kept
vector that has components. A vector of another dimension, or with a component so large that a
squared distance would not fit in int64 (``limit``), takes no part in learning;
it is returned with null code and error. A dimension that the number of parts
does not divide gives parts that differ by one component. Fewer vectors than
entries make shorter codebooks; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.llm.common import bounded_batches, fresh, staged

SCALE = 4096.0
_UNIT = 2.0**-24  # of rounding in float32
#: Labels whose sums are broadcast at most (24 bytes each); more are joined salted.
BROADCAST_LABELS = 200_000
SALTS = 32


def limit(dimension: int) -> int:
    """The largest magnitude of a component for which sums of squares fit in int64."""
    return 1 << ((60 - int(dimension).bit_length()) // 2)


def integers(vectors: pa.Array, dimension: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(indexes of usable vectors, their components as int64 rows)."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    size = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(size == dimension)
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dimension)
    whole = np.floor(flat * SCALE)
    good = (np.abs(whole) <= limit(dimension)).all(axis=1)
    return rows[good], whole[good].astype(np.int64)


def bounds(dimension: int, parts: int) -> list[tuple[int, int]]:
    edges = [p * dimension // parts for p in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def screened(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Which entries of ``book`` may be nearest to each row of ``x``.

    With u the unit of rounding, a product of w rounded terms summed in any
    order is off by at most (w + 2) u / (1 - (w + 2) u) times the sum of the
    terms' magnitudes, which the two norms bound (Cauchy-Schwarz); two of the
    w + 2 are for turning x and the entry into float32. What follows in float64
    is covered by the last two terms.
    """
    width = x.shape[1] + 2
    product = (x.astype(np.float32) @ book.astype(np.float32).T).astype(np.float64)
    square = (book * book).sum(axis=1).astype(np.float64)
    norms = np.sqrt((x * x).sum(axis=1).astype(np.float64))[:, None] * np.sqrt(square)[None, :]
    error = 2 * (width * _UNIT / (1 - width * _UNIT)) * norms * (1 + 1e-9) + 1e-15 * (square + 4 * norms) + 1e-9
    score = square - 2 * product
    return score - error <= (score + error).min(axis=1)[:, None]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, the lower one of equals; squared distance)."""
    row, entry = np.nonzero(screened(x, book))
    apart = x[row] - book[entry]
    exact = (apart * apart).sum(axis=1)
    # Rows come in order, and entries within a row: the first least is the lowest index.
    start = np.searchsorted(row, np.arange(len(x)))
    least = np.minimum.reduceat(exact, start) if len(x) else exact
    hit = np.flatnonzero(exact == least[row])
    first = hit[np.searchsorted(row[hit], np.arange(len(x)))]
    return entry[first], exact[first]


def kept(rows: DataFrame, name: str = "embedding") -> DataFrame:
    """Rows whose vector is there and finite throughout."""
    finite = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col(name).isNotNull() & finite)


def first_entries(vectors: DataFrame, entries: int) -> np.ndarray:
    """The first usable vectors by id, at most ``entries`` of them."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    head = vectors.filter(F.size("embedding") > 0).orderBy(*order).select(F.size("embedding").alias("n")).first()
    if head is None:
        return np.zeros((0, 0), dtype=np.int64)
    dimension = head["n"]
    fits = F.forall("embedding", lambda x: F.abs(F.floor(x.cast("double") * SCALE).cast("double")) <= float(limit(dimension)))
    same = vectors.filter((F.size("embedding") == dimension) & fits).orderBy(*order).limit(entries).select("embedding")
    found = [r["embedding"] for r in same.collect()]
    return np.floor(np.array(found, dtype=np.float64).reshape(len(found), dimension) * SCALE).astype(np.int64)


def part_sums(vectors: DataFrame, book: np.ndarray, parts: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> (number of parts assigned, componentwise sums).

    A task sums what it reads, so as many rows leave it as there are entries.
    """
    cuts = bounds(book.shape[1], parts)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, len(book)), dtype=np.int64), np.zeros(book.shape, dtype=np.int64)
        for batch in batches:
            _, x = integers(batch.column(0), book.shape[1])
            for p, (a, b) in enumerate(cuts):
                code, _ = nearest(x[:, a:b], book[:, a:b])
                count[p] += np.bincount(code, minlength=len(book))
                np.add.at(total[:, a:b], code, x[:, a:b])
        part, entry = np.nonzero(count)
        sums = [total[e, cuts[p][0] : cuts[p][1]].tolist() for p, e in zip(part, entry)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
            ["part", "entry", "n", "sums"],
        )

    got = vectors.select("embedding").mapInArrow(totals, "part int, entry int, n long, sums array<long>")
    each = got.select("part", "entry", "n", F.posexplode("sums").alias("at", "component"))
    rows = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("component").alias("total")).collect()
    found: dict = {}
    for r in rows:
        found.setdefault((r["part"], r["entry"]), (r["n"], {}))[1][r["at"]] = r["total"]
    return {k: (n, [t[i] for i in sorted(t)]) for k, (n, t) in found.items()}


def learn_codebooks(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> np.ndarray:
    """All codebooks side by side: row e holds entry e of every part.

    ``vectors`` (vec_id, embedding) are read once a round. The books, of
    ``entries`` rows, are all that reaches the driver.
    """
    book = first_entries(vectors, entries)
    for _ in range(rounds if book.size else 0):
        cuts, book = bounds(book.shape[1], parts), book.copy()
        for (part, entry), (n, sums) in part_sums(vectors, book, parts).items():
            book[entry, slice(*cuts[part])] = [s // n for s in sums]
    return book


def encode(rows: DataFrame, book: np.ndarray, parts: int = 8) -> DataFrame:
    """``rows`` with ``code`` (two hex digits a part) and ``error`` in place of
    ``embedding``; columns of these names are replaced."""
    rest = rows.drop("embedding", "code", "error")
    cuts = bounds(book.shape[1], parts) if book.size else []
    names, schema = rest.columns, StructType([*rest.schema, StructField("code", StringType()), StructField("error", LongType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = integers(batch.column("embedding"), book.shape[1]) if book.size else (np.zeros(0, dtype=np.int64), None)
            code, error, held = np.zeros((len(at), parts), dtype=np.uint8), np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=bool)
            for p, (a, b) in enumerate(cuts):
                code[:, p], away = nearest(x[:, a:b], book[:, a:b])
                error[at] += away
            held[at] = True
            text = np.full(batch.num_rows, None, dtype=object)
            text[at] = [c.tobytes().hex() for c in code]
            own = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(text, pa.string()), pa.array(error, pa.int64(), mask=~held)], [*names, "code", "error"])

    return rows.drop("code", "error").mapInArrow(coded, schema)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors of equal labels summed, null labels together.

    Sums are made before they are shuffled. Beyond what may be broadcast, rows
    of a label are dealt over salts, so a hot label is many tasks' work.
    """
    own, salt = fresh(coded, "_label"), fresh(coded, "_salt")
    sums = staged(coded.groupBy(F.col("label").alias(own)).agg(F.try_sum("error").alias("label_error")), "label-errors")
    same = F.col("label").eqNullSafe(F.col(own))
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), same, "left").drop(own)
    other = fresh(coded, "_salt_of")
    dealt = coded.withColumn(salt, F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    many = sums.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(many, same & (F.col(salt) == F.col(other)), "left").drop(own, salt, other)


def digest(book: np.ndarray, parts: int = 8) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    cuts = bounds(book.shape[1], parts) if book.size else []
    text = ",".join(str(v) for a, b in cuts for row in book for v in row[a:b])
    return hashlib.sha256(text.encode()).hexdigest()


def compress(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """Every kept row of ``rows`` (vec_id, embedding, label, ...) with ``code``,
    ``error``, ``label_error`` and ``codebooks_sha256``, without ``embedding``."""
    bounded_batches(rows.sparkSession)
    clean = staged(kept(rows.drop("code", "error", "label_error", "codebooks_sha256")), "vectors")
    book = learn_codebooks(clean.select("vec_id", "embedding"), parts, entries, rounds)
    coded = staged(encode(clean, book, parts), "codes")
    return with_label_errors(coded).withColumn("codebooks_sha256", F.lit(digest(book, parts)))

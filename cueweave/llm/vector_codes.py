"""Compression of vectors into codes of parts, with Exponion search for the nearest entry.

Components become whole numbers, so distances are exact. Each vector part looks for its nearest entry from the one it had before:
with d its distance to that entry, no entry further than d + b from there can be nearer than b, the best distance so far. The
entries' lists of others, sorted by distance, are scanned in rings that double, and the radius d + b shrinks on the way.
Codebooks are small (entries x components) and travel to the tasks; vectors stay where they are. A round is one
pass over the vectors and one aggregation of sums by entry within tasks, then over a row an entry and task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from cueweave.llm.common import discard, materialize, quoted, scratch, sliced, small_batches

SCALE = 1024
SALTS = 16


def neighbours(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry all entries by (squared distance, index), and those squared distances."""
    d = ((book[:, None, :] - book[None, :, :]) ** 2).sum(2)
    order = np.argsort(d, axis=1, kind="stable")
    return order, np.take_along_axis(d, order, 1)


def exponion(x: np.ndarray, book: np.ndarray, order: np.ndarray, near: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties to the lower index) and squared distance of each row; all numbers are whole, in doubles."""
    best, least = start.copy(), ((x - book[start]) ** 2).sum(1)
    length, square = (x * x).sum(1), (book * book).sum(1)
    for c in np.unique(start):
        rows = np.flatnonzero(start == c)
        begin = np.sqrt(least[rows])
        at, ring = 0, 8
        while len(rows):
            cols = np.sort(order[c, at : at + ring])
            d = length[rows, None] - 2 * (x[rows] @ book[cols].T) + square[cols]
            j = d.argmin(1)
            found, which = d[np.arange(len(rows)), j], cols[j]
            better = (found < least[rows]) | (found == least[rows]) & (which < best[rows])
            least[rows[better]], best[rows[better]] = found[better], which[better]
            at, ring = at + ring, ring * 2
            if at >= len(book):
                break
            # rounded up by more than the error of the roots, so no entry that could be as near is left out
            more = near[c, at] <= (begin + np.sqrt(least[rows])) ** 2 * (1 + 1e-12) + 1
            rows, begin = rows[more], begin[more]
    return best, least


def _load(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, dim)


def largest(wide: int) -> int:
    """Whole components up to this have distances over `wide` of them that are exact in doubles."""
    return math.isqrt((1 << 51) // max(1, int(wide)))


def _whole(vectors: DataFrame, parts: int) -> DataFrame:
    """_id, label, x (whole components as 32-bit integers), of rows whose components are whole lists."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 2048):
            flat = np.floor(SCALE * np.asarray(b.column(2).flatten(), np.float64))
            sizes = np.asarray(b.column(2).value_lengths())
            if len(flat) and np.abs(flat).max() > largest(sizes.max() // parts):
                raise ValueError(f"a component is over {largest(sizes.max() // parts) // SCALE} in magnitude: its distances would not be exact")
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in np.split(flat.astype(np.int32), ends[:-1])], pa.binary())], names=["_id", "label", "x"])

    return vectors.mapInArrow(work, StructType([*vectors.schema.fields[:2], *StructType.fromDDL("x binary").fields]))


def _assigned(rows: DataFrame, books: list[np.ndarray], final: bool) -> DataFrame:
    """_id, label, x, codes and error (of all parts) under these codebooks; rows may have codes to start from."""
    parts, dim = len(books), sum(b.shape[1] for b in books)
    fields = [rows.schema["_id"], rows.schema["label"], *StructType.fromDDL("codes binary, error long" if final else "x binary, codes binary").fields]
    started = "codes" in rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [neighbours(b) for b in books]
        for b in sliced(batches, 4096):
            x = _load(b.column(2), dim).astype(np.float64)
            before = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64) if started else np.zeros((len(x), parts), np.int64)
            found = [exponion(x[:, p * dim // parts : (p + 1) * dim // parts], books[p], *lists[p], before[:, p]) for p in range(parts)]
            codes = pa.array([c.tobytes() for c in np.stack([f for f, _ in found], 1).astype(np.uint8)], pa.binary())
            rest = [codes, pa.array(sum(d for _, d in found).astype(np.int64))] if final else [b.column(2), codes]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *rest], names=[f.name for f in fields])

    return rows.mapInArrow(work, StructType(fields))


def _means(coded: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry's floored mean of its parts; at most one row an entry comes to the driver."""
    parts, wide = len(books), books[0].shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, len(books[0])), np.int64), np.zeros((parts, len(books[0]), wide), np.int64)
        for b in sliced(batches, 4096):
            x, codes = _load(b.column(0), parts * wide), np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], x[:, p * wide : (p + 1) * wide])
                n[p] += np.bincount(codes[:, p], minlength=n.shape[1])
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    schema = StructType([*StructType.fromDDL("part int, entry int, n long").fields, StructField("sums", ArrayType(LongType()))])
    totals = coded.select("x", "codes").mapInArrow(work, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(wide)])
    new = [b.copy() for b in books]
    for part, entry, n, *sums in totals.collect():
        new[part][entry] = [s // n for s in sums]
    return new


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.reshape(-1)).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, codes, error) of all vectors that take part, and the codebooks (entries x components, one a part).

    A component x is floor(1024 * x). Each part's codebook starts as that part of the first vectors by (vec_id, null last,
    bytes). A round assigns every part to the nearest entry (squared Euclidean distance, ties to the lower index) and
    replaces entries by the floored means of their parts; unused entries stay. At the end all are assigned again: codes has
    one byte a part, error is the sum of squared distances.

    Rows whose vector is null, or holds null or non-finite components take no part, nor do those of another number of components than
    the first vector's; one that parts does not divide is an error, as are components too large for exact distances (11,585 for parts of 16 components). Repeated
    rows count each. Fewer vectors than entries make as many entries. Extra columns are dropped. An empty table gives no row.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark = vectors.sparkSession
    small_batches(spark)
    e = vectors.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(label_col)).alias("label"), F.col(quoted(vec_col)).cast("array<double>").alias("e"))
    e = e.filter("size(e) > 0 and forall(e, x -> x is not null and abs(x) < double('Infinity'))")
    with scratch():
        whole = materialize(_whole(e, parts), "codes-whole")
        first = whole.orderBy(F.col("_id").asc_nulls_last(), "x").select("x").limit(1).collect()
        dim = len(first[0][0]) // 4 if first else parts
        if dim % parts:
            raise ValueError(f"{dim} components cannot be cut into {parts} equal parts")
        rows = whole.filter(F.octet_length("x") == 4 * dim)
        start = rows.orderBy(F.col("_id").asc_nulls_last(), "x").select("x").limit(entries).collect()  # at most 256 vectors
        start = np.array([np.frombuffer(x, np.int32) for (x,) in start], np.float64).reshape(-1, dim)
        books = [np.ascontiguousarray(p) for p in np.split(start, parts, 1)]
        for _ in range(rounds if len(start) else 0):
            coded = materialize(_assigned(rows, books, False), "codes-round")
            books = _means(coded, books)
            if "codes" in rows.columns:
                discard(rows)
            rows = coded
        out = materialize(_assigned(rows, books, True), "codes", keep=True)
    return out.select(F.col("_id").alias("vec_id"), "label", "codes", "error"), books


def code_digest(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (over equal labels, nulls together), codebooks_sha256."""
    rows = coded.withColumn("_s", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)))
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.alias("r").join(totals.alias("t"), F.col("r.label").eqNullSafe(F.col("t.label")) & (F.col("r._s") == F.col("t._s")))  # a label may have most rows
    return joined.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def _sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The same rows in DuckDB, for tables whose ids are unique and whose vectors are equally long."""
    nearest = """a{r} AS MATERIALIZED (SELECT vec_id, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS best
    FROM (SELECT vec_id, v.p, v.x, b.e, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v JOIN b{r} b ON v.p = b.p) GROUP BY vec_id, p)"""
    moved = """c{r} AS (SELECT p, e, list(CAST(floor_sum AS BIGINT) ORDER BY i) AS x FROM (SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*) AS n, (s - ((s % n) + n) % n) // n AS floor_sum FROM a{r}, range(1, (SELECT len(x) + 1 FROM v LIMIT 1)) t(i) GROUP BY p, best.e, i) GROUP BY p, e),
b{next} AS MATERIALIZED (SELECT b.p, b.e, coalesce(c.x, b.x) AS x FROM b{r} b LEFT JOIN c{r} c ON b.p = c.p AND b.e = c.e)"""
    steps = ",\n".join(x.format(r=r, next=r + 1) for r in range(rounds) for x in (nearest, moved))
    return f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, label, p, w[p * (len(w) // {parts}) + 1 : (p + 1) * (len(w) // {parts})] AS x FROM k, range({parts}) t(p)),
b0 AS MATERIALIZED (SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM v) WHERE e < {entries}),
{steps},
{nearest.format(r=rounds)},
o AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
s AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o JOIN k USING (vec_id), s
"""


SQL = _sql()

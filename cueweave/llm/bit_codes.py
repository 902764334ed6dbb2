"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector is scaled to length one, padded and rotated at random; the signs of the result are its code and
s = <code / sqrt(bits), rotated vector> its correction. For a query q, <code, q> / s estimates the cosine without bias, and

    eps * sqrt((1 - s^2) / (s^2 (bits - 1)))

bounds the error but for a chance that falls with the square of eps. A query is rotated likewise and its components are
cut to four bits, so that the estimate needs only bitwise ANDs and bit counts. The vectors with the best estimates give
an exact threshold, and every vector whose upper bound reaches it is measured exactly.

The stated queries meet all rows in blocks: rows are dealt evenly into groups and queries into query blocks by hash, and
each pair of a group and a query block is one bounded unit of work that returns its best rows. No index is fitted, so
nothing depends on a sample, and the same rotation holds at every size.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from cueweave.llm.common import materialize, sliced, small_batches

SEED = 20_240_521
PLANES = 4  # bits of a query component
GROUP_ROWS, BLOCK_QUERIES = 4096, 8192  # a vector is shipped once for each query block, so these are the larger


@functools.lru_cache(maxsize=4)
def rotation(dim: int, bits: int) -> np.ndarray:
    """bits x dim with orthonormal columns: a random rotation of the vector padded with zeros to `bits` components."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((bits, dim)))[0]


def code_length(dim: int, expand: int) -> int:
    return max(64, -(-dim * expand // 64) * 64)


def encode(vectors: np.ndarray, expand: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows x bits / 64 unsigned 64-bit words), corrections s and lengths."""
    norms = np.sqrt((vectors * vectors).sum(1))
    bits = code_length(vectors.shape[1], expand)
    turned = (vectors / norms[:, None]) @ rotation(vectors.shape[1], bits).T
    codes = np.packbits(turned > 0, axis=1, bitorder="little").view(np.uint64)
    return codes, np.abs(turned).sum(1) / math.sqrt(bits), norms


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, codes: np.ndarray, s: np.ndarray, norms: np.ndarray, k: int, eps: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, places of its best k rows, exact inner products), ties to the smaller id; a query's own id is left out."""
    dim, bits = queries.shape[1], codes.shape[1] * 64
    words = np.ascontiguousarray(codes.T)
    ones = np.bitwise_count(words).sum(0, dtype=np.int32).astype(np.float64)
    spread = eps * np.sqrt(np.maximum(0, 1 - s * s) / (bits - 1)) / s
    turned = (queries / np.sqrt((queries * queries).sum(1))[:, None]) @ rotation(dim, bits).T
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / (2**PLANES - 1), 1e-12)
    cut = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    missed = np.sqrt(((low[:, None] + step[:, None] * cut - turned) ** 2).sum(1))
    planes = np.stack([np.packbits(cut >> j & 1, axis=1, bitorder="little").view(np.uint64) for j in range(PLANES)], 1)
    for i in range(len(queries)):
        q = queries[i]
        hits = np.zeros(len(rows), np.uint16)
        for j in range(PLANES):
            for w in range(len(words)):
                hits += np.bitwise_count(words[w] & planes[i, j, w]).astype(np.uint16) << np.uint16(j)
        inner = (2 * step[i] * hits + 2 * low[i] * ones - (step[i] * float(cut[i].sum()) + bits * low[i])) / math.sqrt(bits)
        length = math.sqrt(float((q * q).sum()))
        estimate = inner / s * norms * length
        bound = (spread + eps * missed[i] / math.sqrt(bits) / s) * norms * length
        estimate[ids == query_ids[i]] = -np.inf
        exact = lambda at: (rows[at] * q).sum(1)  # noqa: B023, E731  row by row, so equal vectors tie
        there = int(np.isfinite(estimate).sum())
        if there > k:
            best = np.argpartition(-estimate, k - 1)[:k]
            least = exact(best).min()
            pick = np.flatnonzero(estimate + bound >= least)
            pick = np.union1d(pick, best)
        else:
            pick = np.flatnonzero(np.isfinite(estimate))
        scores = exact(pick)
        order = np.lexsort((ids[pick], -scores))[:k]
        yield i, pick[order], scores[order]


def _coded(vectors: DataFrame, expand: int) -> DataFrame:
    """vec_id, vec (little-endian, as wide as the column's own numbers), code, s, norm of all rows that take part."""
    single = isinstance(vectors.schema["e"].dataType.elementType, FloatType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 2048):
            lists = b.column(1)
            flat = np.asarray(lists.flatten(), np.float64)
            sizes = np.diff(np.asarray(lists.offsets))
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = flat[starts[at][:, None] + np.arange(dim)]
                codes, s, norms = encode(x, expand)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array([r.tobytes() for r in (x.astype(np.float32) if single else x)], pa.binary()), pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(s), pa.array(norms)],
                    names=["vec_id", "vec", "code", "s", "norm"],
                )

    small_batches(vectors.sparkSession)
    return vectors.mapInArrow(work, "vec_id long, vec binary, code binary, s double, norm double")


def search(table: DataFrame, query_filter: str = "vec_id % 20 = 0", k: int = 20, eps: float = 1.9, expand: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k rows of largest inner product for each query: query_id, rank (from 1), vec_id, score.

    query_filter is an SQL condition on vec_id. Nearest first, ties to the smaller vec_id; all candidates if they are
    fewer than k. Rows whose id or vector is null, or whose vector is empty, zero or holds a null or non-finite component,
    take no part. Rows that repeat both id and vector count once; a query meets only vectors of its own number of
    components, and never its own id. Extra columns are ignored; an empty table gives no row.
    """
    of = table.schema[vec_col].dataType
    kind = "float" if isinstance(of, ArrayType) and isinstance(of.elementType, FloatType) else "double"
    wide = np.float32 if kind == "float" else np.float64
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{kind}>").alias("e")).filter(
        "vec_id is not null and size(e) > 0 and forall(e, x -> x is not null and abs(x) < double('Infinity')) and exists(e, x -> x != 0)"
    )
    coded = materialize(_coded(rows, expand).distinct(), "bit-codes")
    n, n_queries = coded.agg(F.count("*"), F.count_if(F.expr(query_filter))).first()
    groups, blocks = max(1, -(-n // GROUP_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))
    dealt = F.xxhash64("vec_id", "vec")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    members = coded.select("*", F.pmod(dealt, F.lit(groups)).cast("int").alias("g"), every(blocks).alias("qb"), F.lit(False).alias("asks"))
    queries = coded.filter(query_filter).select("*", every(groups).alias("g"), F.pmod(dealt, F.lit(blocks)).cast("int").alias("qb"), F.lit(True).alias("asks"))

    def unit(t: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        asks = t.column("asks").to_numpy(zero_copy_only=False)
        ids = t.column("vec_id").to_numpy()
        vec = t.column("vec").to_pylist()
        sizes = np.array([len(v) for v in vec])
        for size in np.unique(sizes[asks]):
            at_q, at_r = np.flatnonzero(asks & (sizes == size)), np.flatnonzero(~asks & (sizes == size))
            if not len(at_r):
                continue
            load = lambda at: np.frombuffer(b"".join(vec[i] for i in at), wide).astype(np.float64).reshape(len(at), -1)  # noqa: B023, E731
            code = t.column("code").take(pa.array(at_r)).to_pylist()
            s, norms = (t.column(c).to_numpy()[at_r] for c in ("s", "norm"))
            q = load(at_q)
            for i, place, score in nearest(q, ids[at_q], load(at_r), ids[at_r], np.frombuffer(b"".join(code), np.uint64).reshape(len(at_r), -1), s, norms, k, eps):
                out[0].append(np.full(len(place), ids[at_q[i]]))
                out[1].append(np.full(len(place), _key(vec[at_q[i]])))
                out[2].append(ids[at_r[place]])
                out[3].append(score)
        kinds = (np.int64, np.int64, np.int64, np.float64)
        return pa.table([np.concatenate(c) if c else np.zeros(0, kind) for c, kind in zip(out, kinds, strict=True)], names=["query_id", "qkey", "vec_id", "score"])

    found = members.unionByName(queries).groupBy("g", "qb").applyInArrow(unit, "query_id long, qkey long, vec_id long, score double")
    best = Window.partitionBy("query_id", "qkey").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _key(vec: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(vec) - (1 << 63)

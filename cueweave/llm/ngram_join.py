"""Similarity join on word n-grams with Bayesian pruning of candidates.

Candidates share a band of MinHash values. Their values are then compared a few at a time; with m of n equal and a flat
prior, the posterior of the similarity is Beta(m + 1, n - m + 1), and a pair is dropped as soon as the probability that
it reaches the threshold falls below a tolerance. All that stay are verified exactly on their shingle sets.

Texts with equal shingle sets are one representative with a count, so copies are never expanded. Buckets with the same
members count once; a pair that meets in several buckets is settled in the least. A large bucket is cut into blocks of
bounded rows and bytes, and each pair of blocks is one unit of work that returns one row a representative: its links there
and the least representative it hangs together with. Exact link counts ask for every pair of different texts in a bucket,
so a family of c near copies costs c / BLOCK copies of each of its sets and c^2 / 2 comparisons, spread over
(c / BLOCK)^2 / 2 tasks; nothing less would count them.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueweave.llm.common import discard, materialize, packed, quoted, sliced, small_batches
from cueweave.llm.components import components

HASHES = 96
STEP = 16  # MinHash values compared at a time
BLOCK, BLOCK_BYTES = 512, 8 << 20  # representatives in a block, and bytes of their shingle sets
CACHE_ENTRIES = 300_000

_WORD = re.compile(r"\w+")
_hashes: dict[str, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _odd(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def shingles(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; a text of fewer words has one shingle of all of them."""
    import xxhash

    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    if len(_hashes) > CACHE_ENTRIES:
        _hashes.clear()
    for w in set(words).difference(_hashes):
        _hashes[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(h))
    mult = _odd(k, k)
    total = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        total += h[i : len(h) - k + 1 + i] * mult[i]
    return np.unique(_mix(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (documents x HASHES) of non-empty sets."""
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint32)
    for k, a in enumerate(_odd(HASHES, 77)):
        out[:, k] = np.minimum.reduceat((flat * a) >> np.uint64(32), starts)
    return out


def band_rows(threshold: float) -> int:
    """MinHash values in a band: the most at which a pair of the threshold shares none of the bands with a chance of 1e-5 at most."""
    for rows in (4, 3, 2):
        if (1 - threshold**rows) ** (HASHES // rows) <= 1e-5:
            return rows
    raise ValueError(f"{HASHES} MinHash values do not find all pairs of a similarity of {threshold}")


@functools.lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For each number n of values compared, the least number of equal ones at which a pair stays a candidate."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = [0]
    for n in range(1, HASHES + 1):
        for m in range(n + 1):
            logp = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(logp - logp.max())
            if p[grid >= threshold].sum() / p.sum() >= tolerance:
                break
        out.append(m)
    return tuple(out)


def _sketch(docs: DataFrame, id_col: str, text_col: str, band: int) -> DataFrame:
    """doc_id, th (text hash), f1, f2 (fingerprint of the shingle set, 0 and 0 if empty), n, bands, sig."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band_mult, n_bands = _odd(band, 5), HASHES // band
        for b in sliced(batches):
            texts = b.column(2).to_pylist()
            for at in range(0, len(texts), 64):
                sets = [shingles(t) for t in texts[at : at + 64]]
                full = [i for i, s in enumerate(sets) if len(s)]
                f = np.zeros((len(sets), 2), np.uint64)
                sig = np.zeros((len(sets), HASHES), np.uint32)
                if full:
                    sig[full] = signatures([sets[i] for i in full])
                for i in full:
                    f[i] = _mix(sets[i]).sum(), _mix(sets[i] ^ np.uint64(0x5BF03635)).sum()
                keys = _mix((sig.reshape(len(sets), n_bands, band).astype(np.uint64) * band_mult).sum(2) + np.arange(n_bands, dtype=np.uint64)).astype(np.int64)
                there = set(full)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(sets)), b.column(1).slice(at, len(sets)), pa.array(f[:, 0].astype(np.int64)), pa.array(f[:, 1].astype(np.int64)),
                     pa.array([len(s) for s in sets], pa.int32()), pa.array([k.tolist() if i in there else [] for i, k in enumerate(keys)], pa.list_(pa.int64())),
                     pa.array([s.tobytes() for s in sig], pa.binary())],
                    names=["doc_id", "th", "f1", "f2", "n", "bands", "sig"],
                )

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("_text"))
    return rows.mapInArrow(work, "doc_id long, th long, f1 long, f2 long, n int, bands array<long>, sig binary")


def _with_sets(near: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """near (one row a representative, with rep_id and rep_th) with the shingle set of that document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))
    joined = texts.join(near, F.col("_id").eqNullSafe(F.col("rep_id")) & (F.col("_th") == F.col("rep_th")))
    small_batches(docs.sparkSession)
    keep = ["f1", "f2", "n_docs", "sig", "keys", "blocks"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            sets = pa.array([shingles(t).tobytes() for t in b.column(0).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], sets], names=[*keep, "set"])

    made = joined.select("_text", *keep).mapInArrow(work, "f1 long, f2 long, n_docs long, sig binary, keys array<long>, blocks array<int>, set binary")
    return made.dropDuplicates(["f1", "f2"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of blocks of the membership matrix."""
    sizes = [len(s) for s in sets]
    words, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    keep = shared[where]
    owner, col = owner[keep], column[where[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    edges = np.searchsorted(col, np.arange(0, int(shared.sum()) + width, width))
    for k in range(len(edges) - 1):
        lo, hi = edges[k], edges[k + 1]
        if hi > lo:
            x = np.zeros((len(sets), min(width, int(col[hi - 1]) - k * width + 1)), np.float32)
            x[owner[lo:hi], col[lo:hi] - k * width] = 1
            out += x @ x.T
    return out


def _settle(rows: list[tuple], key: int, across: bool, threshold: float, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Links (weighted by copies) and the least linked row of each row, for the pairs of one unit of work.

    rows: (f1, f2, n_docs, sig, keys, set, side); across: only pairs of different sides.
    """
    c = len(rows)
    i, j = np.triu_indices(c, 1)
    if across:
        side = np.array([r[6] for r in rows])
        keep = side[i] != side[j]
        i, j = i[keep], j[keep]
    sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).reshape(c, HASHES)
    m = np.zeros(len(i), np.int16)
    for at in range(0, HASHES, STEP):
        m += (sig[i, at : at + STEP] == sig[j, at : at + STEP]).sum(1, dtype=np.int16)
        keep = m >= least[at + STEP]
        i, j, m = i[keep], j[keep], m[keep]
    links, root = np.zeros(c, np.int64), np.arange(c)
    if not len(i):
        return links, root
    used = np.union1d(i, j)
    # a pair that shares a lesser bucket is settled there
    lesser = [np.array([k for k in rows[u][4] if k < key], np.int64) for u in used]
    if sum(map(len, lesser)):
        seen = _overlaps([x.astype(np.uint64) for x in lesser]) if len(used) > 1 else np.zeros((1, 1))
    else:
        seen = np.zeros((len(used), len(used)))
    at_i, at_j = np.searchsorted(used, i), np.searchsorted(used, j)
    keep = seen[at_i, at_j] == 0
    i, j = i[keep], j[keep]
    if not len(i):
        return links, root
    used = np.union1d(i, j)
    sets = [np.frombuffer(rows[u][5], np.uint64) for u in used]
    n = np.array([len(s) for s in sets])
    at_i, at_j = np.searchsorted(used, i), np.searchsorted(used, j)
    both = _overlaps(sets)[at_i, at_j].astype(np.float64)
    keep = both >= threshold * (n[at_i] + n[at_j] - both) - 1e-9
    i, j = i[keep], j[keep]
    copies = np.array([r[2] for r in rows], np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    while True:  # least row of each local component
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return links, root
        root = new


def ngram_join(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, class_id, n_links, kept, th (hash of the text).

    n_links counts the other documents whose five-word shingle sets have a Jaccard similarity of `threshold` or more,
    copies included; class_id is the least id of those it hangs together with, over any number of links; kept marks the
    document (all repeats of it) of least id (nulls last), then least th, of its class. Words are lower-case runs of
    word characters; a text of fewer than five has one shingle of all its words; null texts and texts without a word
    have no link, are kept and are classes of their own. Repeated rows count as documents each. Extra columns are
    dropped; an empty table gives no row. Thresholds under 0.5 are refused, as the bands could not serve them.
    """
    sketch = materialize(_sketch(docs, id_col, text_col, band_rows(threshold)), "ngram-sketch")
    rep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    reps = materialize(
        sketch.filter("n > 0").groupBy("f1", "f2").agg(F.count("*").alias("n_docs"), F.min(rep).alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.first("n").alias("n")),
        "ngram-reps",
    )
    slim = reps.select("f1", "f2", "n", F.explode("bands").alias("key"))
    buckets = slim.groupBy("key").agg(F.count("*").alias("c"), (8 * F.sum("n")).alias("bytes"), F.bit_xor(F.xxhash64("f1", "f2")).alias("m1"), F.bit_xor(F.xxhash64("f2", "f1")).alias("m2")).filter("c > 1")
    kept = materialize(buckets.groupBy("c", "m1", "m2").agg(F.min(F.struct("key", "bytes")).alias("k")).select("k.key", "k.bytes", "c"), "ngram-buckets")
    # the number of blocks of a bucket travels with its key, so that sets are never joined with the table of buckets
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
    members = slim.join(kept.select("key", blocks), "key").groupBy("f1", "f2").agg(F.sort_array(F.collect_list(F.struct("key", "blocks"))).alias("spots"))
    near = members.join(reps.select("f1", "f2", "n_docs", "rep", "sig"), ["f1", "f2"])
    near = near.select("f1", "f2", "n_docs", "sig", F.col("spots.key").alias("keys"), F.col("spots.blocks").alias("blocks"), F.col("rep.doc_id").alias("rep_id"), F.col("rep.th").alias("rep_th"))
    full = materialize(_with_sets(near, docs, id_col, text_col), "ngram-sets")

    placed = full.select("f1", "f2", "n_docs", "sig", "keys", "set", F.explode(F.arrays_zip("keys", "blocks")).alias("at")).select("*", F.col("at.keys").alias("key"), F.col("at.blocks").alias("n_blocks"))
    own = F.pmod(F.xxhash64("f1", "f2"), F.col("n_blocks")).cast("int")
    units = (
        placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "f1", "f2", "n_docs", "sig", "keys", "set", F.col("own").alias("side"))
    )
    small_batches(docs.sparkSession)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches(threshold, tolerance)
        unit, rows = None, []

        def done() -> pa.RecordBatch:
            links, root = _settle(rows, unit[0], unit[1] != unit[2], threshold, least) if len(rows) > 1 else (np.zeros(len(rows), np.int64), np.arange(len(rows)))
            some = np.flatnonzero(links)
            pick = lambda k, at: pa.array([rows[x][k] for x in at], pa.int64())
            return pa.RecordBatch.from_arrays([pick(0, some), pick(1, some), pa.array(links[some]), pick(0, root[some]), pick(1, root[some])], names=["f1", "f2", "links", "g1", "g2"])

        for b in sliced(batches):
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[:3] != unit:
                    if rows:
                        yield done()
                    unit, rows = r[:3], []
                rows.append(r[3:])
        if rows:
            yield done()

    found = materialize(
        units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "f1", "f2").mapInArrow(settle, "f1 long, f2 long, links long, g1 long, g2 long"),
        "ngram-links",
    )
    discard(full, kept)
    links = found.groupBy("f1", "f2").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.struct("f1", "f2").alias("a"), F.struct(F.col("g1").alias("f1"), F.col("g2").alias("f2")).alias("b")))
    grouped = (
        reps.select("f1", "f2", "n_docs", "rep")
        .join(links, ["f1", "f2"], "left")
        .join(roots.select("node.f1", "node.f2", "root"), ["f1", "f2"], "left")
        .withColumn("root", F.coalesce("root", F.struct("f1", "f2")))
    )
    first = grouped.groupBy("root").agg(F.min("rep").alias("first"))
    whole = grouped.join(first, "root").select("f1", "f2", (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "first")
    out = sketch.select("doc_id", "th", "f1", "f2", "n").alias("d").join(whole.alias("w"), (F.col("d.f1") == F.col("w.f1")) & (F.col("d.f2") == F.col("w.f2")) & (F.col("n") > 0), "left")
    kept_row = F.col("first").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")))
    return out.select(
        "doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), kept_row.alias("kept"), "th",
    )


def distinct_documents(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that ngram_join keeps, with all their columns; of rows that repeat id and text, one."""
    keys = ngram_join(docs, threshold, id_col=id_col, text_col=text_col).filter("kept").select(F.col("doc_id").alias("_id"), F.col("th").alias("_kept")).distinct()
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("_d"), F.xxhash64(F.coalesce(F.col(quoted(text_col)), F.lit(""))).alias("_h"), packed(docs))
    found = rows.join(keys, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_kept")), "left_semi")
    return found.dropDuplicates(["_d", "_h"]).select("_row.*")

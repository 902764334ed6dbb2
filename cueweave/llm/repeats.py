"""Removal of byte strings that occurred before, by distributed prefix doubling.

A window is a string of `min_bytes` bytes. What shall go are all bytes of windows that start earlier too, in the order of
documents and places. Names of windows are doubled: a string of 2n bytes is named by the pair of names of its halves.

1. Within a document names of 8, 16, 32 .. bytes are doubled in numpy (`names`). Of the `span` strings of `gram` bytes in a window the
   one of least name is its anchor, so equal windows have equal anchors at equal distances, and most windows share
   theirs with their neighbours. Windows whose anchor's name occurs once cannot repeat; that settles most of a corpus.
   An anchor is a third of a window: shorter strings of plain text come again by chance, the more often the larger the corpus is.
2. Runs of windows of one anchor whose whole strings are equal stay once, as equal rows would get equal ranks; the later ones
   have repeated. The same is done with runs of `BLOCK` windows, after blocks whose common part occurs once have left.
3. What is still open are windows near the ends of repeats. Spark numbers them in the order of their places and doubles
   their ranks at growing offsets: the quarters of a window are sorted and ranked, then pairs of ranks of its halves,
   then of the whole; windows with a part that occurs once leave on the way.

Names are 128 bits wide where equality of names decides; ranks are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cueweave.llm.common import discard, materialize, packed, quoted, release, scratch, sliced, small_batches, with_prefix

BLOCK = 8
PIECE = 1 << 16  # bytes that numpy takes at a time: many short texts or a part of a long one
_ODD = ((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 29), (0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB, 31))
_PLACE = ("_none", "_id", "_th")


def shape(min_bytes: int) -> tuple[int, int, int]:
    """gram, span, word: bytes of an anchor, anchors in a window, bytes that are taken as they are."""
    gram = max(8, 1 << (min_bytes // 3).bit_length() - 1)
    return gram, min_bytes - gram + 1, 8


def names(data: np.ndarray, gram: int, word: int) -> tuple[np.ndarray, np.ndarray]:
    """At each place, by doubling: a 64-bit name of the string of gram bytes, and the string of word bytes itself."""
    words, n = data.astype(np.uint64), 1
    while n < word:
        words = words[:-n] << np.uint64(8 * n) | words[n:]
        n *= 2
    h, (a, b, turn) = words, (np.uint64(x) for x in _ODD[0])
    while n < gram:
        right = h[n:] >> turn
        right ^= h[n:]
        right *= a
        left = h[: len(h) - n] ^ (h[: len(h) - n] >> turn)
        left *= b
        right += left
        h, n = right, n * 2
    mixed = h ^ (h >> turn)
    mixed *= b
    mixed ^= mixed >> np.uint64(32)
    mixed *= a
    return mixed, words


def _least(h: np.ndarray, span: int) -> np.ndarray:
    m, n = h, 1
    while 2 * n <= span:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    return np.minimum(m[: len(m) - (span - n)], m[span - n :]) if n < span else m


def anchors(data: np.ndarray, min_bytes: int, ends: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: first window, windows, the anchor's place, its name; and the words at all places.
    data may be several strings, of min_bytes at least, that end at ends; no window lies in two."""
    gram, span, word = shape(min_bytes)
    ends = np.array([len(data)]) if ends is None else ends
    h, words = names(data, gram, word)
    m = _least(h, span)
    new = np.concatenate(([True], m[1:] != m[:-1]))
    starts = np.concatenate(([0], ends[:-1]))
    new[starts] = new[ends[:-1] - min_bytes + 1] = True
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(m)))
    inside = first <= (ends - min_bytes)[np.searchsorted(ends, first, "right")]
    first, n = first[inside], n[inside]
    at = first + span - 1  # where the least name falls, it has just come in at the right end
    other = m[first] > m[first - 1]
    other[np.searchsorted(first, starts)] = True
    other = np.flatnonzero(other)
    for i in range(0, len(other), 4096):
        f = first[other[i : i + 4096]]
        at[other[i : i + 4096]] = f + h[f[:, None] + np.arange(span)].argmin(1)
    if (odd := at < first + n - 1).any():  # the same string again within a run: its windows have several anchors
        parts = [[first[~odd], n[~odd], at[~odd]]]
        for a, k in zip(first[odd], n[odd], strict=True):
            places = a + np.flatnonzero(h[a : a + k - 1 + span] == m[a])
            begin = np.concatenate(([a], places[:-1] + 1))
            size = np.minimum(places, a + k - 1) - begin + 1
            parts.append([x[size > 0] for x in (begin, size, places)])
        first, n, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(first)
        first, n, at = first[order], n[order], at[order]
    return first, n, at, m[first].view(np.int64), words


def _wholes(first: np.ndarray, n: np.ndarray, beside: np.ndarray, words: np.ndarray, min_bytes: int) -> list[np.ndarray]:
    """Two independent 64-bit names of the whole strings of runs, with their anchors' places in them."""
    _, span, word = shape(min_bytes)
    out: list[list[np.ndarray]] = [[] for _ in _ODD]
    places = np.arange(0, span - 1 + min_bytes, word)
    for i in range(0, len(first), 4096):
        f, k = first[i : i + 4096], n[i : i + 4096]
        parts = words[f[:, None] + np.minimum(places, (k - 1 + min_bytes - word)[:, None])]
        for o, (a, b, turn) in zip(out, (tuple(np.uint64(x) for x in c) for c in _ODD), strict=True):
            x = parts + (places + 1).astype(np.uint64) * b
            x ^= x >> turn
            x *= a
            x ^= x >> np.uint64(32)
            x *= b
            x ^= x >> turn
            g = x.sum(1) + (k * span + beside[i : i + 4096]).astype(np.uint64) * a
            o.append(((g ^ (g >> turn)) * b).view(np.int64))
    return [np.concatenate(o) for o in out]


def runs(data: np.ndarray, min_bytes: int, ends: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: first window, windows, the anchor's place, occurrences, name, two names of the
    whole string. Runs of one window that repeat at the next places are one with that many occurrences."""
    first, n, at, m, words = anchors(data, min_bytes, ends)
    whole = _wholes(first, n, at - first, words, min_bytes)
    again = (n[1:] == 1) & (n[:-1] == 1) & (first[1:] == first[:-1] + 1) & (whole[0][1:] == whole[0][:-1]) & (whole[1][1:] == whole[1][:-1])
    keep = np.flatnonzero(np.concatenate(([True], ~again)))
    times = np.diff(np.append(keep, len(first)))
    return first[keep], n[keep], at[keep], times, m[keep], whole[0][keep], whole[1][keep]


def _pieces(texts: pa.Array, min_bytes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts joined to about PIECE bytes, where they end, which ones they are, and how many bytes of them came before. Parts of long
    texts overlap, so that each window is in one."""
    parts: list[bytes] = []
    of: list[tuple[int, int, int]] = []
    held = 0
    for i, t in enumerate(texts):
        data = t.as_py().encode()
        for c in range(0, len(data) - min_bytes + 1, PIECE):
            parts.append(data[c : c + PIECE + min_bytes - 1])
            held += len(parts[-1])
            of.append((held, i, c))
            if held >= PIECE:
                yield np.frombuffer(b"".join(parts), np.uint8), *np.array(of).T
                parts, of, held = [], [], 0
    if of:
        yield np.frombuffer(b"".join(parts), np.uint8), *np.array(of).T


def _anchor_names(texts: DataFrame, min_bytes: int) -> DataFrame:
    """h: the name of the anchor of each run of windows of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, ends, *_ in _pieces(b.column(0), min_bytes):
                yield pa.RecordBatch.from_arrays([pa.array(anchors(data, min_bytes, ends)[3])], names=["h"])

    return texts.select("_text").mapInArrow(work, "h long")


def _anchored(texts: DataFrame, min_bytes: int) -> DataFrame:
    """_id, _th and a row for each run of windows of each text."""
    fields = ["a", "n", "s", "times", "h", "f1", "f2"]
    schema = StructType([texts.schema["_id"], texts.schema["_th"], *StructType.fromDDL("a int, n int, s int, times int, h long, f1 long, f2 long").fields])
    kinds = [pa.int32()] * 4 + [pa.int64()] * 3

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, ends, of, before in _pieces(b.column(2), min_bytes):
                first, n, at, *more = runs(data, min_bytes, ends)
                k = np.searchsorted(ends, first, "right")
                shift = before[k] - np.concatenate(([0], ends[:-1]))[k]
                row = pa.array(of[k])
                yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), *[pa.array(x).cast(t) for x, t in zip((first + shift, n, at + shift, *more), kinds, strict=True)]], names=["_id", "_th", *fields])

    return texts.mapInArrow(work, schema)


def _first(rows: DataFrame, keys: list[str], at: str, *more: str) -> DataFrame:
    """The least place of each group: f_none, f_id, f_th, f_at, and more columns of the row there."""
    least = rows.groupBy(*keys).agg(F.min(F.struct(*_PLACE, F.col(at).alias("_at"), *more)).alias("_f"))
    return least.select(*keys, *[F.col("_f").getField(c).alias("f" + c) for c in (*_PLACE, "_at")], *[F.col("_f").getField(c).alias(c) for c in more])


def _is_first(at: str) -> Column:
    same = F.col("_id").eqNullSafe(F.col("f_id")) & (F.col("_th") == F.col("f_th"))
    return same & (F.col(at) == F.col("f_at"))


def _open(classes: DataFrame, by: list[str]) -> DataFrame:
    """The classes that share `by` with another one."""
    return classes.join(_often(classes, by).hint("shuffle_hash"), by)


def _often(rows: DataFrame, by: list[str]) -> DataFrame:
    """The values of `by` that come more than once."""
    return rows.groupBy(*by).agg(F.count("*").alias("_k")).filter("_k > 1").select(*by)


def _beside_texts(texts: DataFrame, rows: DataFrame, *cols: str) -> DataFrame:
    """_id, _th, _bytes and r (struct of cols) of the rows (_id, _th, cols), whose texts' bytes they are. Each text is shuffled once."""
    lists = rows.groupBy("_id", "_th").agg(F.collect_list(F.struct(*cols)).alias("rows"))
    there = texts.alias("t").join(lists.hint("merge").alias("l"), F.col("t._id").eqNullSafe(F.col("l._id")) & (F.col("t._th") == F.col("l._th")))
    return there.select("t._id", "t._th", F.encode("_text", "UTF-8").alias("_bytes"), F.explode("rows").alias("r"))


def _blocks(texts: DataFrame, reps: DataFrame, min_bytes: int) -> DataFrame:
    """_none, _id, _th, lo, hi, and names of blocks: the runs of reps cut into windows lo to hi at distances BLOCK * j .. from their
    anchors. c names the part that all of them have, g1 and g2 all their bytes, both with their place beside the anchor."""
    cut = _beside_texts(texts, reps, "a", "n", "s")
    near, far = F.expr("r.s - r.a - r.n + 1"), F.expr("r.s - r.a")
    j = F.explode(F.sequence(F.floor(near / BLOCK).cast("int"), F.floor(far / BLOCK).cast("int")))
    cut = cut.withColumn("j", j).withColumn("lo", F.greatest(F.expr("r.a"), F.expr(f"r.s - {BLOCK} * j - {BLOCK - 1}"))).withColumn("hi", F.least(F.expr("r.a + r.n - 1"), F.expr(f"r.s - {BLOCK} * j")))
    core, whole = F.expr(f"substring(_bytes, r.s - {BLOCK} * j + 1, {min_bytes - BLOCK + 1})"), F.expr(f"substring(_bytes, lo + 1, hi - lo + {min_bytes})")
    beside = F.expr(f"r.s - {BLOCK} * j - lo")
    names_of = [F.xxhash64("j", core).alias("c"), *[F.xxhash64(F.lit(k), "j", beside, whole).alias(f"g{k}") for k in (1, 2)]]
    return cut.select(F.col("_id").isNull().alias("_none"), "_id", "_th", "lo", "hi", *names_of)


def _ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """rows (w, i, keys) with the rank of their keys in sorted order in place of these. Windows with keys that occur once leave."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_c")).filter("_c > 1")
    ranks = with_prefix(counted.withColumn("_one", F.lit(1).cast("long")), keys, "_one", "rank", f"{name}-ranks").select(*keys, "rank")
    return rows.join(ranks.hint("shuffle_hash"), keys).select("w", "i", "rank")


def _paired(ranked: DataFrame, parts: int) -> DataFrame:
    """w, i, x, y: the pairs of ranks at places 2i and 2i + 1 of the windows that have all their parts."""
    at = [F.max(F.when(F.col("i") == k, F.col("rank"))).alias(f"r{k}") for k in range(parts)]
    whole = ranked.groupBy("w").agg(*at).dropna()
    pairs = F.explode(F.array(*[F.struct(F.lit(k // 2).alias("i"), F.col(f"r{k}").alias("x"), F.col(f"r{k + 1}").alias("y")) for k in range(0, parts, 2)]))
    return whole.select("w", pairs.alias("p")).select("w", "p.*")


def doubled(blocks: DataFrame, min_bytes: int) -> DataFrame:
    """w: the windows of blocks (no, lo, hi, bytes) that an equal one of smaller w precedes; w is no * BLOCK + its place from lo.
    Blocks that come more than once count once.

    Ranks of quarters, halves and wholes by sorting; quarters overlap where min_bytes is no multiple of four.
    """
    q = -(-min_bytes // 4)
    starts = [0, q, min_bytes - 2 * q, min_bytes - q]
    windows = blocks.select("no", "bytes", F.explode(F.sequence(F.lit(0), F.col("hi") - F.col("lo"))).alias("k"))
    quarters = windows.select((F.col("no") * BLOCK + F.col("k")).alias("w"), "k", "bytes", F.posexplode(F.array(*map(F.lit, starts))).alias("i", "o")).select("w", F.col("i").cast("byte").alias("i"), F.expr(f"substring(bytes, k + o + 1, {q})").alias("x"))
    fours = materialize(_ranked(quarters, ["x"], "quarters"), "quarters")
    release(blocks.sparkSession)
    halves = materialize(_paired(fours, 4), "half-pairs")
    discard(fours)
    release(blocks.sparkSession)
    twos = materialize(_ranked(halves, ["x", "y"], "halves"), "halves")
    wholes = materialize(_paired(twos, 2), "whole-pairs")
    first = wholes.groupBy("x", "y").agg(F.min("w").alias("first"))
    later = materialize(wholes.join(first, ["x", "y"]).filter("w > first").select("w"), "later-windows")
    discard(halves, twos, wholes)
    return later


def repeated_windows(texts: DataFrame, min_bytes: int = 100) -> DataFrame:
    """_id, _th, lo, hi: ranges of starts of windows that an equal one precedes, from texts (_id, _th, _text) without nulls."""
    spark = texts.sparkSession
    often = materialize(_often(_anchor_names(texts, min_bytes), ["h"]), "repeats-often")
    release(spark)
    # from a table of its own, so that adaptive execution can split the rows of a hot name
    live = materialize(_anchored(texts, min_bytes).join(often.hint("shuffle_hash"), "h").withColumn("_none", F.col("_id").isNull()), "repeats-live")
    release(spark)
    discard(often)
    keys = ["h", "f1", "f2"]
    firsts = materialize(_first(live, keys, "a", "n", "s"), "repeats-firsts")
    joined = live.select("_id", "_th", "a", F.col("n").alias("windows"), "times", *keys).join(firsts.drop("n", "s").hint("shuffle_hash"), keys)
    # of the first occurrence of a class all but the first of equal neighbours repeat; of the later ones all
    marks = joined.select("_id", "_th", (F.col("a") + F.when(_is_first("a"), 1).otherwise(0)).alias("lo"), F.expr("a + windows + times - 2").alias("hi"), (_is_first("a") & (F.col("times") == 1)).alias("kept")).filter("not kept")
    release(spark)
    coarse = materialize(marks.drop("kept"), "repeats-coarse")
    discard(live)
    release(spark)
    reps = _open(firsts, ["h"]).select(F.col("f_id").alias("_id"), F.col("f_th").alias("_th"), F.col("f_at").alias("a"), "n", "s")
    blocks = materialize(_blocks(texts, reps, min_bytes), "repeats-blocks")
    discard(firsts)
    release(spark)

    # few blocks share their common part with another one; only these are grouped by their strings
    often = materialize(_often(blocks, ["c"]), "repeats-often-blocks")
    shared = materialize(blocks.join(often.hint("shuffle_hash"), "c"), "repeats-shared")
    discard(blocks, often)
    release(spark)
    keys = ["c", "g1", "g2"]
    firsts = materialize(_first(shared, keys, "lo", "hi"), "repeats-classes")
    fine = materialize(shared.join(firsts.drop("hi").hint("shuffle_hash"), keys).filter(~_is_first("lo")).select("_id", "_th", "lo", "hi"), "repeats-fine")
    discard(shared)
    release(spark)
    left = _open(firsts, ["c"]).select(F.col("f_none").alias("_none"), F.col("f_id").alias("_id"), F.col("f_th").alias("_th"), F.col("f_at").alias("lo"), "hi")
    numbered = materialize(with_prefix(left.withColumn("_one", F.lit(1).cast("long")), [*_PLACE, "lo"], "_one", "no", "repeats-order").drop("_one", "_total"), "repeats-numbered")
    discard(firsts)
    release(spark)
    strings = _beside_texts(texts, numbered, "no", "lo", "hi").select("r.no", "r.lo", "r.hi", F.expr(f"substring(_bytes, r.lo + 1, r.hi - r.lo + {min_bytes})").alias("bytes"))
    strings = materialize(strings, "repeats-strings")
    release(spark)
    later = doubled(strings, min_bytes)
    discard(strings)
    release(spark)
    at = (F.col("lo") + F.pmod("w", F.lit(BLOCK)).cast("int")).alias("at")
    exact = later.withColumn("no", F.expr(f"w div {BLOCK}")).join(numbered.select("no", "_id", "_th", "lo"), "no").select("_id", "_th", at)
    return coarse.union(fine).union(exact.select("_id", "_th", F.col("at").alias("lo"), F.col("at").alias("hi")))


def remove_repeats(docs: DataFrame, min_bytes: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of docs, and spans (array of start and end in bytes of what goes, in order, apart from each other), n_bytes
    and kept (the bytes that stay, joined).

    Texts are UTF-8 bytes. A byte goes if a string of min_bytes bytes that holds it starts earlier as well: in a document of smaller
    id (null last, then by hash of the text) or at an earlier place of the same one. Rows that repeat id and text are one document
    and are treated alike. Null texts are empty; texts under min_bytes keep all. Columns named spans, n_bytes or kept are replaced.
    An empty table gives no row. min_bytes is 16 at least.
    """
    if min_bytes < 16:
        raise ValueError("min_bytes must be 16 at least")
    docs = docs.drop("spans", "n_bytes", "kept")
    full = docs.select(F.col(quoted(id_col)).alias("_id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("_text"), packed(docs)).withColumn("_th", F.xxhash64("_text"))
    small_batches(docs.sparkSession)
    texts = full.select("_id", "_th", "_text")
    with scratch():
        marks = repeated_windows(texts.filter(F.octet_length("_text") >= min_bytes), min_bytes)
        lists = marks.groupBy("_id", "_th").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("_marks"))
        lists = materialize(lists, "repeats-marks", keep=True)
    release(docs.sparkSession)
    joined = full.alias("d").join(lists.hint("merge").alias("m"), F.col("d._id").eqNullSafe(F.col("m._id")) & (F.col("d._th") == F.col("m._th")), "left").select("_row", "_text", "_marks")
    schema = StructType([joined.schema["_row"], *StructType.fromDDL("spans array<struct<start: int, end: int>>, n_bytes long").fields, StructField("kept", BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 256):
            spans, sizes, kept = [], [], []
            for text, marks in zip(b.column(1), b.column(2), strict=True):
                data, cut, at, left = text.as_py().encode(), [], 0, []
                if marks.is_valid:
                    lo, hi = (np.asarray(marks.values.field(k)) for k in (0, 1))
                    end = np.maximum.accumulate(hi + min_bytes)
                    new = np.flatnonzero(np.concatenate(([True], lo[1:] > end[:-1])))
                    cut = list(zip(lo[new].tolist(), end[np.append(new[1:] - 1, len(end) - 1)].tolist(), strict=True))
                for x, y in cut:
                    left.append(data[at:x])
                    at = y
                spans.append([{"start": x, "end": y} for x, y in cut])
                sizes.append(len(data))
                kept.append(b"".join([*left, data[at:]]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary())], names=["_row", "spans", "n_bytes", "kept"])

    return joined.mapInArrow(work, schema).select("_row.*", "spans", "n_bytes", "kept")


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of what remove_repeats returns."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    return removed.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: The same rows in DuckDB, for tables whose ids are unique. Bytes are pairs of hexadecimal digits, cut into pieces of 1,000 windows.
SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT doc_id, c, substr(x, CAST(2000 * c + 1 AS BIGINT), 2198) AS x FROM (SELECT doc_id, x, unnest(range(0, (len(x) // 2 + 999) // 1000)) AS c FROM t)),
w AS (SELECT doc_id, 1000 * c + p AS p, md5(substr(x, CAST(2 * p + 1 AS BIGINT), 200)) AS k FROM (SELECT doc_id, c, x, unnest(range(0, least(1000, len(x) // 2 - 99))) AS p FROM c)),
o AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS rn FROM w) WHERE rn > 1),
g AS (SELECT doc_id, p, sum(CASE WHEN p - before <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM o)),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM g GROUP BY doc_id, g),
l AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z, CAST(sum(z - a) AS BIGINT) AS gone FROM s GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, coalesce(gone, 0) AS n_removed, CAST(coalesce(len(a), 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN a IS NULL THEN x ELSE array_to_string(list_transform(range(0, len(a) + 1), lambda i: substr(x, CAST(2 * (CASE WHEN i = 0 THEN 0 ELSE z[i] END) + 1 AS BIGINT),
           CAST(2 * ((CASE WHEN i = len(a) THEN len(x) // 2 ELSE a[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE z[i] END)) AS BIGINT))), '') END)) AS kept_sha256
FROM t LEFT JOIN l USING (doc_id)
"""

"""Importance resampling towards a target corpus over bucket-partitioned postings.

Words and runs of words are hashed into buckets. A bucket's gain is the log-ratio of its smoothed shares in the target and
in the documents; a document's weight is the mean gain of its features, and documents are drawn without replacement by
weight plus Gumbel noise. Postings (bucket, document, count) are shuffled by group of buckets and a salt of the document: those of
one document for one group travel together, and a bucket that half of all documents have is spread over the salts. Each
part meets its buckets' gains there, which come from the totals of both corpora, and adds up what they give its documents; a
document gets one sum from each group, however many tasks there are.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cueweave.llm.common import materialize, quoted, scratch, sliced, small_batches, with_prefix

GROUPS, SALTS = 64, 64
#: Bytes of words: digits, letters and all of non-ASCII characters; A-Z become a-z and all others spaces.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def features(text: str | None, buckets: int, longest: int) -> tuple[int, Counter]:
    """Number of words, and the counts of buckets of all runs of 1 to `longest` words."""
    words = (text or "").encode().translate(_LETTERS).split()
    counts: Counter = Counter()
    for n in range(1, longest + 1):
        runs = Counter(words) if n == 1 else Counter(b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
        for run, k in runs.items():
            counts[zlib.crc32(run) % buckets] += k
    return len(words), counts


def _featured(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """The columns of texts but _text, with words, n, and postings (arrays of buckets and counts)."""
    kept = [f for f in texts.schema.fields if f.name != "_text"]
    schema = StructType([*kept, *StructType.fromDDL("words long, n long, posts array<struct<g: int, entries: array<long>>>").fields])
    at = texts.columns.index("_text")
    kind = pa.list_(pa.struct([("g", pa.int32()), ("entries", pa.list_(pa.int64()))]))

    def grouped(counts: Counter) -> list[dict]:
        out: dict[int, list[int]] = {}
        for bucket, n in sorted(counts.items()):
            out.setdefault(bucket % GROUPS, []).append(bucket // GROUPS << 32 | n)
        return [{"g": g, "entries": entries} for g, entries in out.items()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 256):
            found = [features(t.as_py(), buckets, longest) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(b.num_columns) if i != at], pa.array([w for w, _ in found], pa.int64()), pa.array([c.total() for _, c in found], pa.int64()), pa.array([grouped(c) for _, c in found], kind)],
                names=schema.names,
            )

    small_batches(texts.sparkSession)
    return texts.mapInArrow(work, schema)


def _totals(featured: DataFrame, name: str) -> DataFrame:
    """g, i, and the occurrences of bucket i * GROUPS + g; tasks add up their own before the shuffle."""
    entries = featured.select(F.explode("posts").alias("p")).select("p.g", F.explode("p.entries").alias("x"))
    return entries.select("g", F.shiftright("x", 32).cast("int").alias("i"), F.col("x").bitwiseAND(F.lit(0xFFFFFFFF)).alias("n")).groupBy("g", "i").agg(F.sum("n").alias(name))


def resample(docs: DataFrame, target: DataFrame, share: int = 10, buckets: int = 10_000, longest: int = 1, least_words: int = 20, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank, words: one row a document. target has texts in text_col.

    rank is 1, 2, 3 .. for the `share` per cent (rounded down) of documents of least_words words at least that have the
    highest scores, ties to the smaller id, null for others. Null texts have no words. A document without features
    has weight 0. A null id comes last among ties and is hashed as an empty one. Repeated rows count each, weigh
    alike and have ranks of their own. Extra columns are dropped. An empty target or table is no error.
    """
    with scratch():
        texts = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).alias("_text")).withColumn("_th", F.xxhash64("_text"))
        # rows are numbered as they are stored: a short key for postings, and rows that repeat id and text stay apart
        featured = materialize(_featured(texts, buckets, longest).withColumn("_row", F.monotonically_increasing_id()), "importance-features")
        aims = _featured(target.select(F.col(quoted(text_col)).alias("_text")), buckets, longest)
        aims, here = materialize(_totals(aims, "t"), "importance-target"), materialize(_totals(featured, "s"), "importance-corpus")
        s_all, t_all = (df.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for df, c in ((here, "s"), (aims, "t")))

        d = lambda c, plus: F.coalesce(F.col(c), F.lit(0)).cast("double") + F.lit(float(plus))
        ratio = d("t", 1) * F.lit(float(s_all + buckets)) / (d("s", 1) * F.lit(float(t_all + buckets)))
        gained = here.join(aims, ["g", "i"], "left").select("g", "i", F.floor(1000 * F.log(ratio)).alias("gain"))
        by_place = F.map_from_entries(F.collect_list(F.struct("i", "gain")))  # as many as a group has buckets
        gains = gained.groupBy("g").agg(by_place.alias("m")).select("g", F.transform(F.sequence(F.lit(0), F.lit(-(-buckets // GROUPS) - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("gains"))
        gains = gains.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        postings = featured.select("_row", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int").alias("salt"), F.explode("posts").alias("p")).select("_row", "salt", "p.g", "p.entries")
        given = F.expr("aggregate(entries, 0L, (sum, x) -> sum + (x & 4294967295L) * gains[cast(shiftright(x, 32) as int)])")
        none = lambda c: F.lit(None).cast(featured.schema[c].dataType).alias(c)
        added = postings.join(gains.hint("shuffle_hash"), ["g", "salt"]).select("_row", given.alias("add"), *map(none, ("_id", "_th", "n", "words")))
        own = featured.select("_row", F.lit(0).cast("long").alias("add"), "_id", "_th", "n", "words")
        weighed = added.unionByName(own).groupBy("_row").agg(F.sum("add").alias("add"), *[F.max(c).alias(c) for c in ("_id", "_th", "n", "words")])

        weight = F.when(F.col("n") > 0, F.expr("(add - pmod(add, n)) div n")).otherwise(F.lit(0).cast("long"))
        h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
        noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
        scored = weighed.select("_row", "_id", "_th", F.col("n").alias("n_features"), "words", weight.alias("weight"), (weight + noise).alias("score"))
        scored = materialize(scored, "importance-scores", keep=True)
        able = F.col("words") >= least_words
        drawn = scored.agg(F.count_if(able)).first()[0] * share // 100
        ordered = scored.filter(able).select("_row", (-F.col("score")).alias("_down"), F.col("_id").isNull().alias("_none"), "_id", "_th", F.lit(1).cast("long").alias("_one"))
        places = with_prefix(ordered, ["_down", "_none", "_id", "_th", "_row"], "_one", "_before", "importance-order")
        places = materialize(places.filter(F.col("_before") < drawn).select("_row", (F.col("_before") + 1).alias("rank")), "importance-ranks", keep=True)
    return scored.join(places, "_row", "left").select(F.col("_id").alias("doc_id"), "n_features", "weight", "score", "rank", "words")


#: The same rows in DuckDB, for tables whose ids are unique: one-word features, 10,000 buckets, 10 per cent of documents of 20 words.
SQL = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS crc FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
texts AS (SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
h AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM w)),
b AS (SELECT word, xor(list_reduce([4294967295] || list_transform(range(0, len(x), 2), lambda i: CAST('0x' || substr(x, i + 1, 2) AS BIGINT)), lambda c, y: xor(c >> 8, crc[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM h, tab),
f AS (SELECT side, doc_id, bucket FROM w JOIN b USING (word)),
n AS (SELECT CAST(count(*) FILTER (side = 0) AS DOUBLE) AS s_all, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS t_all FROM f),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain
      FROM (SELECT bucket, CAST(count(*) FILTER (side = 0) AS DOUBLE) AS s, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS t FROM f GROUP BY bucket), n),
a AS (SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM f JOIN g USING (bucket) WHERE side = 0 GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0) AS weight, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM documents LEFT JOIN a USING (doc_id)),
e AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM e WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank, n_features AS words FROM e LEFT JOIN r USING (doc_id)
"""

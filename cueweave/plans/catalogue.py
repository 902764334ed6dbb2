"""Query catalogue: each operator on the test tables, and the SQL that gives the same rows.

Cues come from `conversations` (a conversation is a file, a turn a cue of 0.5 to 5.5 s every 6 s) and from `events` (a user
is an episode; an hour is a second of media; views and clicks are clean cues, errors garbled ones, purchases and signups
speech). `documents` are a corpus of texts whose files are its sources.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueweave.functions import lexicon as lex
from cueweave.functions import text as T
from cueweave.functions import timecode as C
from cueweave.operators import files, fixes, nouns, oped, regions, report, review, setops, similarity, styled, temporal

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives its rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = 6000 * F.col("turn")
    length = F.least(F.lit(5500), F.greatest(F.lit(500), 50 * F.length("text")))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("file"), F.col("conv_id").alias("ep"), F.col("turn").alias("idx"), start.alias("start_ms"), (start + length).alias("end_ms"), "role", "text"
    )


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts) div 3600000")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ep"), F.col("event_id").alias("idx"), F.col("event_id").alias("_id"), start.alias("start_ms"), (start + F.floor(F.col("value") * 100)).alias("end_ms"), "event_type"
    )


def cues(t: DataFrame) -> DataFrame:
    return t.filter("event_type in ('view', 'click', 'error')").withColumn("is_garbled", F.col("event_type") == "error").drop("event_type")


def speech(t: DataFrame) -> DataFrame:
    return t.filter("event_type in ('purchase', 'signup')").withColumn("seg_idx", F.col("idx")).drop("event_type")


TURNS = "cues AS (SELECT conv_id AS file, conv_id AS ep, turn AS idx, 6000 * turn AS start_ms, 6000 * turn + least(5500, greatest(500, 50 * length(text))) AS end_ms, role, text FROM conversations)"
TIMELINE = """t AS (SELECT user_id AS ep, event_id AS idx, event_id AS _id, event_type, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 3600000 AS start_ms,
  (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 3600000 + CAST(floor(value * 100) AS BIGINT) AS end_ms FROM events),
cues AS (SELECT ep, idx, _id, start_ms, end_ms, event_type = 'error' AS is_garbled FROM t WHERE event_type IN ('view', 'click', 'error')),
speech AS (SELECT ep, idx, _id, idx AS seg_idx, start_ms, end_ms FROM t WHERE event_type IN ('purchase', 'signup'))"""


# text predicates and functions


@query("""SELECT lang, count(*) AS n, count(*) FILTER (regexp_matches(text, '[a-zA-Z]{2,}|[А-Яа-яЁё]')) AS n_ja,
  count(*) FILTER (regexp_matches(text, '[a-zA-Z]{2,}|[А-Яа-яЁё]|[぀-ヿ]')) AS n_zh,
  count(*) FILTER (regexp_matches(text, '[А-Яа-яЁё]|[぀-ヿ]|[一-鿿]')) AS n_en, count(DISTINCT source) AS n_sources FROM documents GROUP BY lang""")
def garbled_by_lang(spark, sf):
    g = lambda lang: F.count_if(T.is_garbled(F.col("text"), lang)).alias(f"n_{lang}")
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), g("ja"), g("zh"), g("en"), F.countDistinct("source").alias("n_sources"))


@query(f"""WITH {TURNS}, g AS (SELECT *, regexp_matches(text, '[a-zA-Z]{{2,}}|[А-Яа-яЁё]') AS bad, max(end_ms) OVER (PARTITION BY file) AS last FROM cues)
SELECT file, count(*) FILTER (bad) AS n_marked, count(*) FILTER (bad AND NOT (start_ms < 6000 OR start_ms > last - 6000)) AS n_left FROM g GROUP BY file""")
def oped_exempt(spark, sf):
    marked = turns(spark, sf).withColumn("is_garbled", T.is_garbled(F.col("text"))).withColumn("_marked", F.col("is_garbled"))
    return oped.exempt(marked, ["file"], lead_ms=6000, tail_ms=6000).groupBy("file").agg(F.count_if("_marked").alias("n_marked"), F.count_if("is_garbled").alias("n_left"))


@query(r"""WITH d AS (SELECT lang, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents),
f AS (SELECT lang, length(t) AS n, t, regexp_matches(t, '[a-zA-Z]{2,}') AS run, regexp_matches(t, '[a-zA-Z]') AS latin, regexp_matches(t, '[А-яЁё]') AS cyr FROM d)
SELECT lang, count(*) FILTER (run AND NOT cyr AND n >= 3) AS n_valid, count(*) FILTER (n >= 3 AND latin AND NOT cyr) AS n_plausible, count(*) FILTER (n <= 20 AND latin) AS n_short,
  count(*) FILTER (latin AND n <= 120) AS n_fixable, count(*) FILTER (regexp_full_match(t, '[A-Z][a-z]{2,}|[A-Z][a-z]+ [A-Z][a-z]+')) AS n_names FROM f GROUP BY lang""")
def valid_plausible_flags(spark, sf):
    c = F.col("text")
    flags = {"n_valid": T.is_valid(c, "en"), "n_plausible": T.is_plausible(c, "en"), "n_short": T.is_short_fragment(c, "en"), "n_fixable": T.is_fixable(c, "en"), "n_names": T.is_name_shape(T.strip(c), "en")}
    return table(spark, sf, "documents").groupBy("lang").agg(*[F.count_if(v).alias(k) for k, v in flags.items()])


@query(f"""SELECT doc_id, CAST(len(list_filter(regexp_extract_all(text, '[a-zA-Z]{{2,}}'), lambda w: lower(w) NOT IN ({', '.join(f"'{w}'" for w in lex.EXCLAMATION_EN)}))) AS INTEGER) AS meaningful,
  CAST(len(regexp_extract_all(text, '[a-zA-Z]+')) AS INTEGER) AS plain FROM documents""")
def meaningful_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.meaningful_count(F.col("text"), "en").alias("meaningful"), T.plain_count(F.col("text"), "en").alias("plain"))


@query(r"""SELECT conv_id, turn, length(trim(text)) / greatest(length(trim(p)), 3) > 3.0 AS anomaly FROM
  (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p IS NOT NULL""")
def length_anomaly(spark, sf):
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    c = table(spark, sf, "conversations").withColumn("p", before).filter("p is not null")
    return c.select("conv_id", "turn", T.is_length_anomaly(F.col("p"), F.col("text")).alias("anomaly"))


@query(f"""WITH {TURNS}, f AS (SELECT role, trim(text) AS t, length(trim(text)) AS n, regexp_matches(text, '[a-zA-Z]') AS latin, len(regexp_extract_all(text, '[a-zA-Z]')) AS nl FROM cues),
o AS (SELECT *, n >= 4 AND list_max(list_transform(list_distinct(string_split(t, '')), lambda x: len(list_filter(string_split(t, ''), lambda y: y = x)))) / n > 0.7 AS over FROM f)
SELECT role, count(*) AS n, count(*) FILTER (CASE WHEN t = '' THEN true WHEN n <= 1 THEN NOT latin ELSE over END) AS n_noise_en,
  count(*) FILTER (CASE WHEN n <= 3 THEN true WHEN latin AND nl / n > 0.5 THEN true ELSE over END) AS n_noise_ja FROM o GROUP BY role""")
def noise_ratio(spark, sf):
    c = F.col("text")
    return turns(spark, sf).groupBy("role").agg(F.count("*").alias("n"), F.count_if(T.is_noise(c, "en")).alias("n_noise_en"), F.count_if(T.is_noise(c, "ja")).alias("n_noise_ja"))


@query("""WITH m AS (SELECT (event_id % 10) / 10.0 AS p, CASE WHEN event_id % 3 > 0 THEN -value / 200 END AS l, (event_id % 7) / 2.0 AS c FROM events)
SELECT CASE WHEN p >= 0 AND p > 0.6 THEN 'no_speech' WHEN l < -1.5 THEN 'low_logprob' WHEN c > 2.4 THEN 'compression' ELSE 'kept' END AS reason, count(*) AS n FROM m GROUP BY 1""")
def confidence_filter(spark, sf):
    e = table(spark, sf, "events")
    m = e.select((F.col("event_id") % 10 / 10.0).alias("no_speech_prob"), F.when(F.col("event_id") % 3 > 0, -F.col("value") / 200).alias("avg_logprob"), (F.col("event_id") % 7 / 2.0).alias("compression_ratio"))
    return regions.confident(m).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {TIMELINE} SELECT idx, printf('%02d:%02d:%02d,%03d', start_ms // 3600000, start_ms // 60000 % 60, start_ms // 1000 % 60, start_ms % 1000) AS srt, start_ms AS back,
  printf('%d:%d:%02d.%02d', start_ms // 3600000, start_ms // 60000 % 60, start_ms // 1000 % 60, start_ms % 1000 // 10) AS ass, start_ms // 10 * 10 AS ass_back FROM t""")
def timecode_roundtrip(spark, sf):
    t = timeline(spark, sf).select("idx", C.srt_time(F.col("start_ms")).alias("srt"), C.ass_time(F.col("start_ms")).alias("ass"))
    return t.select("idx", "srt", C.to_ms(F.col("srt")).alias("back"), "ass", C.ass_to_ms(F.col("ass")).alias("ass_back"))


@query("SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS n_text, length(regexp_replace(regexp_replace(html, '\\{[^}]*\\}', '', 'g'), '<[^>]+>', '', 'g')) AS n_bare FROM pages")
def strip_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.length(T.strip_tags(F.col("html"))).cast("long").alias("n_text"), F.length(T.strip_ass_tags(F.col("html"))).cast("long").alias("n_bare"))


@query("""WITH c AS (SELECT lang, len(regexp_extract_all(text, '[ぁ-ヿ]')) AS k, len(regexp_extract_all(text, '[一-鿿]')) AS h, len(regexp_extract_all(text, '[Ѐ-ӿ]')) AS y,
  len(regexp_extract_all(text, '[a-zA-Z]')) AS a FROM documents)
SELECT lang, CASE WHEN h > greatest(k, y, a) THEN 'cjk' WHEN k > greatest(h, y, a) THEN 'kana' WHEN y > greatest(h, k, a) THEN 'cyrillic' WHEN a > 0 THEN 'latin' ELSE 'unknown' END AS script, count(*) AS n FROM c GROUP BY 1, 2""")
def script_vote(spark, sf):
    return table(spark, sf, "documents").groupBy("lang", T.script(F.col("text")).alias("script")).agg(F.count("*").alias("n"))


@query(f"""WITH {TURNS}, v AS (SELECT * FROM cues WHERE length(trim(text)) >= 2 AND NOT regexp_full_match(trim(text), '\\[[^\\]]+\\]') AND regexp_matches(text, '[ぁ-ヿ一-鿿Ѐ-ӿa-zA-Z]')
  ORDER BY file, idx LIMIT 100)
SELECT CASE WHEN count(*) FILTER (regexp_matches(text, '[a-zA-Z]')) / greatest(count(*), 1) >= 0.5 THEN 'en' ELSE 'ja' END AS lang, count(*) AS n FROM v""")
def language_vote(spark, sf):
    return oped.language_vote(turns(spark, sf))


@query()
def repeat_runs(spark, sf):
    def described(n: int):
        return F.transform(T.repeats(F.col("text"), n, 4), lambda r: F.struct(F.lit(n).alias("length"), F.substring(r, 1, n).alias("sequence"), F.floor(F.length(r) / n).alias("times")))

    runs = F.concat(described(3), described(4))
    found = table(spark, sf, "documents").select("doc_id", F.explode(runs).alias("r")).select("doc_id", "r.*")
    return found.filter(~T.is_excluded_repeat(F.col("sequence"), [])).groupBy("length", "sequence").agg(F.count("*").alias("n_runs"), F.max("times").alias("most"))


@query()
def episode_number(spark, sf):
    return table(spark, sf, "pages").groupBy(T.episode_number(F.col("url")).alias("ep")).agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN CAST(regexp_extract(name, '[Ss]\\d{1,3}[Ee](\\d{1,4})', 1) AS INTEGER) < 1000 THEN 'EP' || lpad(CAST(CAST(regexp_extract(name, '[Ss]\\d{1,3}[Ee](\\d{1,4})', 1) AS INTEGER) AS VARCHAR), 3, '0')
  ELSE 'EP' || CAST(CAST(regexp_extract(name, '[Ss]\\d{1,3}[Ee](\\d{1,4})', 1) AS INTEGER) AS VARCHAR) END AS ep, count(*) AS n
FROM (SELECT 'show.S01E' || CAST(1 + conv_id % 1200 AS VARCHAR) || '.srt' AS name FROM conversations) GROUP BY 1""")
def episode_of_season(spark, sf):
    name = F.concat(F.lit("show.S01E"), (1 + F.col("conv_id") % 1200).cast("string"), F.lit(".srt"))
    return table(spark, sf, "conversations").groupBy(T.episode_number(name).alias("ep")).agg(F.count("*").alias("n"))


@query("""SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(CAST(round(value * 100) AS BIGINT)) / 100.0, 2) AS total FROM events GROUP BY 1""")
def json_props(spark, sf):
    k = F.from_json("props", "struct<k:long>").getField("k")
    return table(spark, sf, "events").groupBy(k.alias("k")).agg(F.count("*").alias("n"), F.round(F.sum(F.round(F.col("value") * 100).cast("long")) / 100.0, 2).alias("total"))


@query(f"""WITH {TURNS}, s AS (SELECT file, idx, text, lag(text) OVER (PARTITION BY file ORDER BY idx) AS p FROM cues)
SELECT file, idx, len(list_intersect(string_split(trim(text), ''), string_split(trim(p), ''))) / len(list_distinct(list_concat(string_split(trim(text), ''), string_split(trim(p), '')))) AS jaccard,
  len(list_intersect(string_split(replace(text, ' ', ''), ''), string_split(replace(p, ' ', ''), ''))) / len(list_distinct(string_split(replace(text, ' ', ''), ''))) AS contained
FROM s WHERE p IS NOT NULL""")
def char_overlap(spark, sf):
    c = turns(spark, sf).withColumn("p", F.lag("text").over(Window.partitionBy("file").orderBy("idx"))).filter("p is not null")
    return c.select("file", "idx", T.char_jaccard(F.col("text"), F.col("p")).alias("jaccard"), T.containment(F.col("text"), F.col("p")).alias("contained"))


@query("""WITH p AS (SELECT a.item_id AS a_id, b.item_id AS b_id, string_split(trim(a.text), '') AS x, string_split(trim(b.text), '') AS y FROM benchmark a JOIN benchmark b ON a.item_id + 1 = b.item_id)
SELECT a_id, b_id, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) AS jaccard FROM p""")
def char_jaccard_pairs(spark, sf):
    b = table(spark, sf, "benchmark")
    pairs = b.alias("a").join(b.alias("b"), F.col("a.item_id") + 1 == F.col("b.item_id"))
    return pairs.select(F.col("a.item_id").alias("a_id"), F.col("b.item_id").alias("b_id"), T.char_jaccard(F.col("a.text"), F.col("b.text")).alias("jaccard"))


# time lines


@query(f"""WITH {TIMELINE}, g AS (SELECT ep, start_ms - lag(end_ms) OVER (PARTITION BY ep ORDER BY start_ms, idx) AS gap FROM cues)
SELECT ep, count(*) FILTER (gap > 0) AS n_gaps, coalesce(max(gap) FILTER (gap > 0), 0) AS max_gap_ms, count(*) FILTER (gap > 20000) AS n_large FROM g GROUP BY ep""")
def gap_stats(spark, sf):
    return temporal.gap_statistics(cues(timeline(spark, sf)), ["ep"])


ISLANDS = """, f AS (SELECT *, CASE WHEN {before} IS NULL OR start_ms - {before} > {slack} THEN 1 ELSE 0 END AS new FROM (SELECT *, {window} AS b FROM {source})),
i AS (SELECT *, sum(new) OVER (PARTITION BY ep ORDER BY start_ms, idx ROWS UNBOUNDED PRECEDING) AS island FROM f)"""
RUNNING = "max(end_ms) OVER (PARTITION BY ep ORDER BY start_ms, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query(f"WITH {TIMELINE}{ISLANDS.format(before='b', slack=2000, window=RUNNING, source='cues')} SELECT ep, CAST(island AS BIGINT) AS island, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM i GROUP BY ep, island")
def covered_islands(spark, sf):
    return temporal.merge_islands(cues(timeline(spark, sf)), ["ep"], 2000)


@query(f"""WITH {TIMELINE}{ISLANDS.format(before='b', slack=500, window='lag(end_ms) OVER (PARTITION BY ep ORDER BY start_ms, idx)', source='speech')}
SELECT ep, CAST(island AS BIGINT) AS island, min(start_ms) AS start_ms, arg_max(end_ms, (start_ms, idx)) AS end_ms, count(*) AS n FROM i GROUP BY ep, island""")
def merged_speech(spark, sf):
    return temporal.merge_islands(speech(timeline(spark, sf)), ["ep"], 500, by="last_end")


@query(f"""WITH {TIMELINE}{ISLANDS.format(before='b', slack=60000, window='lag(start_ms) OVER (PARTITION BY ep ORDER BY start_ms, idx)', source='(SELECT * FROM cues WHERE is_garbled)')}
SELECT ep, CAST(island AS BIGINT) AS island, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM i GROUP BY ep, island""")
def session_clusters(spark, sf):
    return regions.garbled_clusters(cues(timeline(spark, sf)), ["ep"])


@query(f"""WITH {TIMELINE}, w AS (SELECT DISTINCT ep, floor(start_ms / 30) AS f, true AS on_ FROM speech)
SELECT ep, min(f) * 30 AS start_ms, max(f) * 30 + 30 AS end_ms FROM (SELECT ep, f, f - row_number() OVER (PARTITION BY ep ORDER BY f) AS r FROM w) GROUP BY ep, r HAVING max(f) * 30 + 30 - min(f) * 30 >= 30""")
def frame_segments(spark, sf):
    s = speech(timeline(spark, sf)).select("ep", F.floor(F.col("start_ms") / 30).alias("f")).distinct()
    on = s.select("ep", (F.col("f") * 30).alias("start_ms"), F.lit(True).alias("voiced"))
    off = s.select("ep", ((F.col("f") + 1) * 30).alias("start_ms")).join(on.select("ep", "start_ms"), ["ep", "start_ms"], "left_anti").withColumn("voiced", F.lit(False))
    out = temporal.flags_to_segments(on.unionByName(off), ["ep"], "voiced", least_ms=30)
    return out.select("ep", F.col("start_ms").cast("double"), F.col("end_ms").cast("double"))


@query(f"""WITH {TIMELINE}, tot AS (SELECT ep, max(end_ms) AS total_ms FROM t GROUP BY ep), s AS (SELECT ep, start_ms, end_ms FROM speech UNION ALL SELECT ep, total_ms, total_ms FROM tot),
p AS (SELECT ep, start_ms, coalesce(max(end_ms) OVER (PARTITION BY ep ORDER BY start_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f FROM (SELECT ep, start_ms, max(end_ms) AS end_ms FROM s GROUP BY ep, start_ms))
SELECT ep, greatest(0, f - 150) AS start_ms, least(total_ms, start_ms + 150) AS end_ms FROM p JOIN tot USING (ep) WHERE start_ms - f >= 300""")
def silence_complement(spark, sf):
    t = timeline(spark, sf)
    quiet = speech(t).groupBy("ep", "start_ms").agg(F.max("end_ms").alias("end_ms"))
    return temporal.speech_from_silence(quiet, t.groupBy("ep").agg(F.max("end_ms").alias("total_ms")), ["ep"])


@query(f"""WITH {TIMELINE}, v AS (SELECT c.*, EXISTS (SELECT 1 FROM speech s WHERE s.ep = c.ep AND least(c.end_ms, s.end_ms) - greatest(c.start_ms, s.start_ms) >= 0) AS has_speech FROM cues c)
SELECT ep, has_speech, count(*) AS n, sum(end_ms - start_ms)::BIGINT AS total_ms FROM v GROUP BY ep, has_speech""")
def speech_semi_anti(spark, sf):
    t = timeline(spark, sf)
    c = cues(t).withColumn("text", F.lit("some text"))
    v = regions.non_speech(c, speech(t), ["ep"], "en")
    return v.groupBy("ep", "has_speech").agg(F.count("*").alias("n"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("total_ms"))


PAIRS = """, bd AS (SELECT ep, min(start_ms) AS f, max(end_ms) AS l FROM cues GROUP BY ep),
sp AS (SELECT s._id, s.ep, greatest(s.start_ms, f) AS start_ms, least(s.end_ms, l) AS end_ms FROM speech s JOIN bd USING (ep) WHERE s.end_ms > f AND s.start_ms < l),
k AS (SELECT s._id, s.ep, s.start_ms, s.end_ms, count(*) FILTER (c.is_garbled) AS n_garbled, count(c._id) AS n_cues, min(c.start_ms) AS cf, max(c.end_ms) AS cl
  FROM sp s LEFT JOIN cues c ON s.ep = c.ep AND least(s.end_ms, c.end_ms) - greatest(s.start_ms, c.start_ms) >= 300 WHERE s.end_ms - s.start_ms <= 20000 GROUP BY s._id, s.ep, s.start_ms, s.end_ms),
c1 AS (SELECT *, CASE WHEN n_cues = 0 THEN end_ms - start_ms ELSE greatest(cf - start_ms, 0) + greatest(end_ms - cl, 0) END AS bare FROM k),
c2 AS (SELECT *, CASE WHEN n_garbled > 0 THEN 'garbled' WHEN n_cues = 0 THEN 'missing' WHEN bare >= 3000 THEN 'partial_overlap' ELSE 'covered' END AS kind FROM c1)"""


@query(f"WITH {TIMELINE}{PAIRS} SELECT ep, kind, count(*) AS n, sum(bare)::BIGINT AS bare_ms FROM c2 GROUP BY ep, kind")
def speech_kinds(spark, sf):
    t = timeline(spark, sf)
    k = regions.speech_classes(speech(t), cues(t), ["ep"], max_gap_ms=20_000)
    return k.groupBy("ep", "kind").agg(F.count("*").alias("n"), F.sum("bare_ms").alias("bare_ms"))


@query(f"""WITH {TIMELINE}{PAIRS}, r AS (SELECT *, CASE kind WHEN 'garbled' THEN 3 WHEN 'partial_overlap' THEN 2 ELSE 1 END AS rank FROM c2 WHERE kind <> 'covered'),
b AS (SELECT *, max(end_ms) OVER (PARTITION BY ep ORDER BY start_ms, _id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR start_ms > before + 2000 THEN 1 ELSE 0 END) OVER (PARTITION BY ep ORDER BY start_ms, _id ROWS UNBOUNDED PRECEDING) AS region FROM b)
SELECT ep, CAST(region AS BIGINT) AS region, min(start_ms) AS start_ms, max(end_ms) AS end_ms, CAST(sum(n_garbled) AS BIGINT) AS n_garbled, count(*) AS n_segments,
  CASE max(rank) WHEN 3 THEN 'garbled' WHEN 2 THEN 'partial_overlap' ELSE 'missing' END AS kind FROM g GROUP BY ep, region""")
def fix_regions(spark, sf):
    t = timeline(spark, sf)
    return regions.fix_regions(speech(t), cues(t), ["ep"], max_gap_ms=20_000)


@query(f"""WITH {TIMELINE}, bad AS (SELECT * FROM cues WHERE is_garbled),
a AS (SELECT c._id, min(s.seg_idx) AS seg_idx FROM bad c JOIN speech s ON c.ep = s.ep AND least(c.end_ms + 1000, s.end_ms) - greatest(c.start_ms - 1000, s.start_ms) >= 0 GROUP BY 1),
b AS (SELECT c._id, min(s.seg_idx) AS seg_idx FROM bad c JOIN speech s ON c.ep = s.ep AND least(c.end_ms + 3000, s.end_ms) - greatest(c.start_ms - 3000, s.start_ms) >= 0 GROUP BY 1)
SELECT c.ep, c.idx, CASE WHEN a.seg_idx IS NOT NULL THEN 'high' WHEN b.seg_idx IS NOT NULL THEN 'retry' ELSE 'none' END AS confidence, coalesce(a.seg_idx, b.seg_idx) AS seg_idx
FROM bad c LEFT JOIN a ON c._id = a._id LEFT JOIN b ON c._id = b._id""")
def asr_match_rounds(spark, sf):
    t = timeline(spark, sf)
    return regions.match_rounds(speech(t), cues(t).filter("is_garbled"), ["ep"]).select("ep", "idx", "confidence", "seg_idx")


BEST = """, p AS (SELECT c._id, s.seg_idx, greatest(least(c.end_ms, s.end_ms) - greatest(c.start_ms, s.start_ms), 0) / greatest(c.end_ms - c.start_ms, 1) AS ratio
  FROM cues c JOIN speech s ON c.ep = s.ep AND least(c.end_ms, s.end_ms) - greatest(c.start_ms, s.start_ms) >= 1),
b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY _id ORDER BY ratio DESC, seg_idx) = 1)"""


@query(f"WITH {TIMELINE}{BEST} SELECT c.ep, c.idx, b.seg_idx, b.ratio FROM cues c LEFT JOIN b ON c._id = b._id")
def best_overlap(spark, sf):
    t = timeline(spark, sf)
    return temporal.best_overlap(cues(t), speech(t), ["ep"]).select("ep", "idx", F.col("r_seg_idx").alias("seg_idx"), "ratio")


@query(f"""WITH {TIMELINE}{BEST} SELECT c.ep, c.idx, CASE WHEN b.ratio >= 0.5 THEN 'high' WHEN b.ratio >= 0.3 THEN 'retry' ELSE 'none' END AS confidence,
  CASE WHEN b.ratio >= 0.3 THEN 'segment ' || CAST(b.seg_idx AS VARCHAR) END AS replacement FROM cues c LEFT JOIN b ON c._id = b._id WHERE c.is_garbled""")
def aligned_text(spark, sf):
    t = timeline(spark, sf)
    asr = speech(t).withColumn("text", F.concat(F.lit("segment "), F.col("seg_idx").cast("string")))
    return regions.aligned(cues(t).filter("is_garbled"), asr, ["ep"], lang="en").select("ep", "idx", "confidence", "replacement")


@query(f"""WITH {TIMELINE}, s AS (SELECT *, CASE WHEN NOT is_garbled THEN idx END AS ok FROM cues)
SELECT ep, idx, left_idx, right_idx FROM (SELECT ep, idx, is_garbled, last_value(ok IGNORE NULLS) OVER (PARTITION BY ep ORDER BY start_ms, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS left_idx,
  first_value(ok IGNORE NULLS) OVER (PARTITION BY ep ORDER BY start_ms, idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS right_idx FROM s) WHERE is_garbled""")
def nearest_clean(spark, sf):
    n = temporal.neighbours(cues(timeline(spark, sf)), ["ep"], ~F.col("is_garbled"), "idx")
    return n.filter("is_garbled").select("ep", "idx", "left_idx", "right_idx")


@query(f"""WITH {TIMELINE} SELECT ep, idx, ref_idx, dist_ms FROM (SELECT c.ep, c.idx, s.idx AS ref_idx, abs(c.start_ms - s.start_ms) AS dist_ms, row_number() OVER (PARTITION BY c._id ORDER BY abs(c.start_ms - s.start_ms), s.idx) AS n
  FROM cues c JOIN speech s ON c.ep = s.ep AND abs(c.start_ms - s.start_ms) <= 500) WHERE n = 1""")
def nearest_tolerance(spark, sf):
    t = timeline(spark, sf)
    return temporal.nearest(cues(t), speech(t), ["ep"], 500).select("ep", "idx", F.col("r_idx").alias("ref_idx"), "dist_ms")


@query(f"""WITH {TURNS} SELECT file, idx, array_to_string(before, '|') AS context_before, array_to_string(after, '|') AS context_after FROM (SELECT file, idx,
  coalesce(list(text) FILTER (text <> '') OVER (PARTITION BY file ORDER BY start_ms, idx ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), []) AS before,
  coalesce(list(text) FILTER (text <> '') OVER (PARTITION BY file ORDER BY start_ms, idx ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), []) AS after FROM cues)""")
def context_window(spark, sf):
    c = temporal.context(turns(spark, sf), ["file"], 2, 2)
    return c.select("file", "idx", F.array_join("context_before", "|").alias("context_before"), F.array_join("context_after", "|").alias("context_after"))


@query(f"""WITH {TURNS}, n AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY idx) - 1 AS k FROM cues)
SELECT a.file, a.k // 3 AS batch, string_agg(a.text, '|' ORDER BY a.k) AS texts, coalesce(min(b.text), '') AS context FROM n a LEFT JOIN n b ON a.file = b.file AND b.k = a.k // 3 * 3 - 1 GROUP BY a.file, a.k // 3""")
def prompt_batches(spark, sf):
    b = temporal.batches(turns(spark, sf), ["file"], 3, 1)
    return b.select("file", "batch", F.array_join("texts", "|").alias("texts"), F.array_join("context", "|").alias("context"))


@query(f"WITH {TIMELINE} SELECT ep, idx, coalesce(sum(end_ms - start_ms + 2000) OVER (PARTITION BY ep ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset_ms FROM speech")
def concat_offsets(spark, sf):
    return temporal.concat_offsets(speech(timeline(spark, sf)), ["ep"]).select("ep", "idx", "offset_ms")


@query(f"""WITH {TIMELINE}, c AS (SELECT * FROM cues WHERE is_garbled), p AS (SELECT c.ep, c.idx, c.start_ms, c.end_ms, s.start_ms AS ss, s.end_ms AS se, greatest(c.start_ms - 2000, 0) AS f, c.end_ms + 2000 AS l
  FROM c LEFT JOIN speech s ON c.ep = s.ep AND least(c.end_ms + 2000, s.end_ms) - greatest(c.start_ms - 2000, s.start_ms) >= 0),
g AS (SELECT ep, idx, start_ms, end_ms, f, l, coalesce(sum(CASE WHEN ss IS NOT NULL THEN greatest(least(end_ms, se) - greatest(start_ms, ss), 0) END), 0)::BIGINT AS speech_ms, min(ss) FILTER (se >= f) AS fs,
  arg_max(se, (ss, se)) FILTER (ss <= l) AS le FROM p GROUP BY ep, idx, start_ms, end_ms, f, l)
SELECT ep, idx, CASE WHEN ep NOT IN (SELECT ep FROM speech) THEN greatest(0, start_ms - 500) WHEN speech_ms > 0 THEN CASE WHEN fs - f > 2000 THEN fs - 2000 ELSE f END END AS clip_start_ms,
  CASE WHEN ep NOT IN (SELECT ep FROM speech) THEN end_ms + 500 WHEN speech_ms > 0 THEN CASE WHEN l - le > 2000 THEN le + 2000 ELSE l END END AS clip_end_ms, speech_ms FROM g""")
def clip_bounds(spark, sf):
    t = timeline(spark, sf)
    return temporal.clip_bounds(cues(t).filter("is_garbled"), speech(t), ["ep"]).select("ep", F.col("_id").alias("idx"), "clip_start_ms", "clip_end_ms", "speech_ms")


@query("""WITH n AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS k, count(*) OVER () AS c FROM (SELECT DISTINCT source FROM documents)), s AS (SELECT CAST(floor(i * greatest(c / 7.0, 1.0)) AS BIGINT) AS k FROM (SELECT DISTINCT c FROM n), range(7) r(i))
SELECT source FROM n WHERE k IN (SELECT k FROM s)""")
def even_sample(spark, sf):
    return temporal.evenly_sampled(table(spark, sf, "documents").select("source").distinct(), 7, "source")


# openings and endings


def regioned(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as cues of openings (the first three) and endings."""
    t = turns(spark, sf).withColumn("region", F.when(F.col("idx") < 3, "OP").otherwise("ED"))
    return t.withColumn("start_ms", F.col("start_ms") + F.col("file") % 5 * 400)


REGIONED = TURNS + ", r AS (SELECT file, ep, idx, CASE WHEN idx < 3 THEN 'OP' ELSE 'ED' END AS region, start_ms + file % 5 * 400 AS start_ms, text FROM cues), b AS (SELECT *, start_ms // 2000 * 2000 AS bucket_ms FROM r)"


@query(f"WITH {REGIONED} SELECT region, bucket_ms, count(*) AS n, count(DISTINCT file) AS n_files FROM b GROUP BY region, bucket_ms")
def grid_buckets(spark, sf):
    return oped.grid_buckets(regioned(spark, sf)).groupBy("region", "bucket_ms").agg(F.count("*").alias("n"), F.countDistinct("file").alias("n_files"))


@query()
def greedy_buckets(spark, sf):
    return oped.greedy_buckets(regioned(spark, sf)).groupBy("region", "bucket_ms").agg(F.count("*").alias("n"), F.countDistinct("file").alias("n_files"))


@query(f"""WITH {REGIONED}, c AS (SELECT region, bucket_ms, text, count(*) AS n, min((file, idx)) AS first FROM b GROUP BY ALL)
SELECT region, bucket_ms, text, n, n_distinct FROM (SELECT *, count(*) OVER (PARTITION BY region, bucket_ms) AS n_distinct, row_number() OVER (PARTITION BY region, bucket_ms ORDER BY n DESC, first) AS k FROM c) WHERE k = 1""")
def majority_text(spark, sf):
    return oped.majority(oped.grid_buckets(regioned(spark, sf)), ["region", "bucket_ms"], "text", ["file", "idx"])


@query(f"""WITH {REGIONED}, v AS (SELECT *, length(text) <= 1 AND NOT regexp_matches(text, '[a-zA-Z]') OR text = '' AS noise FROM b),
e AS (SELECT region, bucket_ms, count(*) AS n_entries, count(DISTINCT ep) AS n_eps, count(DISTINCT text) AS n_texts FROM v GROUP BY ALL)
SELECT region, bucket_ms, n_entries, n_eps, n_texts FROM e WHERE n_eps >= 3""")
def time_clusters(spark, sf):
    c = oped.clusters(oped.grid_buckets(regioned(spark, sf)), lang="en")
    return c.select("region", "bucket_ms", "n_entries", "n_eps", F.size("variants").cast("long").alias("n_texts"))


@query()
def cluster_kinds(spark, sf):
    b = oped.grid_buckets(regioned(spark, sf))
    c = oped.clusters(b, lang="en").join(oped.pairwise_jaccard(b, ["region", "bucket_ms"]), ["region", "bucket_ms"])
    return oped.cluster_kind(c).select("region", "bucket_ms", "n_entries", "n_valid", "n_noise", "kind")


@query()
def oped_slips(spark, sf):
    return oped.consistency(oped.grid_buckets(regioned(spark, sf)), "en")


@query(f"""WITH {REGIONED}, s AS (SELECT file, idx, region, bucket_ms, 'sing with us line ' || CAST(bucket_ms AS VARCHAR) AS line, CASE WHEN file % 7 = 1 THEN 'sing wiht us line ' || CAST(bucket_ms AS VARCHAR) WHEN file % 7 = 2 THEN text ELSE 'sing with us line ' || CAST(bucket_ms AS VARCHAR) END AS text FROM b)
SELECT file, idx, text AS original, line AS replacement FROM s WHERE file % 7 = 1""")
def oped_slips_of_edits(spark, sf):
    """Songs whose lines one file in seven misspells, and one replaces by whole turns, which are too different to be slips."""
    b = oped.grid_buckets(regioned(spark, sf))
    line = F.concat(F.lit("sing with us line "), F.col("bucket_ms").cast("string"))
    text = F.when(F.col("file") % 7 == 1, F.replace(line, F.lit("with"), F.lit("wiht"))).when(F.col("file") % 7 == 2, F.col("text")).otherwise(line)
    return oped.consistency(b.withColumn("text", text), "en")


@query(f"""WITH {REGIONED}, l AS (SELECT 'song' || CAST(item_id % 4 AS VARCHAR) AS song_id, CASE WHEN item_id % 2 = 0 THEN 'OP' ELSE 'ED' END AS region, item_id % 5 * 100 AS lo, item_id % 5 * 100 + 150 AS hi, item_id % 8 * 6000 AS time_ms FROM benchmark)
SELECT file, idx, song_id, time_ms FROM (SELECT r.file, r.idx, song_id, time_ms, row_number() OVER (PARTITION BY r.file, r.idx ORDER BY song_id, time_ms) AS k FROM r JOIN l ON r.region = l.region AND r.file BETWEEN lo AND hi AND abs(start_ms - time_ms) <= 3000) WHERE k = 1""")
def lyric_match(spark, sf):
    i = F.col("item_id")
    lyrics = table(spark, sf, "benchmark").select(
        F.concat(F.lit("song"), (i % 4).cast("string")).alias("song_id"), F.when(i % 2 == 0, "OP").otherwise("ED").alias("region"), (i % 5 * 100).alias("ep_lo"), (i % 5 * 100 + 150).alias("ep_hi"), (i % 8 * 6000).alias("time_ms"),
        F.col("text").alias("src"), F.lit("").alias("dst"),
    )
    return oped.match_lyrics(regioned(spark, sf).withColumn("ep_no", F.col("file")), lyrics).select("file", "idx", "song_id", "time_ms")


# terms and names


WORDS = r"list_filter(regexp_extract_all({}, '[\p{{L}}\p{{M}}\p{{Nd}}_]+'), lambda w: regexp_full_match(w, '[A-Z][a-z]{{2,}}'))"
CORPUS = f"d AS (SELECT doc_id AS idx, source AS ep, text FROM documents), w AS (SELECT idx, ep, text, unnest({WORDS.format('text')}) AS term FROM d)"


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as cues of their sources. Terms are capitalised words, which all their languages have."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("idx"), F.col("source").alias("ep"), "text")


@query(f"WITH {CORPUS} SELECT term, count(*) AS freq FROM w GROUP BY term HAVING count(*) >= 3")
def term_freq(spark, sf):
    return nouns.term_frequencies(table(spark, sf, "documents"), "en", 3)


@query(f"""WITH {CORPUS}, k AS (SELECT term, ep, length(text) AS n, row_number() OVER (PARTITION BY term ORDER BY ep, idx) AS k FROM w), c AS (SELECT term, string_agg(ep || ':' || CAST(n AS VARCHAR), '|' ORDER BY k) AS contexts FROM k WHERE k <= 5 GROUP BY term)
SELECT term, n, n_eps, contexts FROM (SELECT term, count(*) AS n, count(DISTINCT ep) AS n_eps FROM w GROUP BY term HAVING count(*) >= 3 AND count(DISTINCT ep) >= 2) JOIN c USING (term)""")
def suspects(spark, sf):
    shown = F.array_join(F.transform("contexts", lambda x: F.concat(x["ep"], F.lit(":"), F.length(x["text"]).cast("string"))), "|")
    return nouns.suspects(corpus(spark, sf)).select("term", "n", "n_eps", shown.alias("contexts"))


@query(f"WITH {CORPUS}, k AS (SELECT DISTINCT unnest({WORDS.format('text')}) AS term FROM benchmark) SELECT term, count(*) AS freq FROM w WHERE term NOT IN (SELECT term FROM k) GROUP BY term")
def known_anti(spark, sf):
    known = table(spark, sf, "benchmark")
    return nouns.without(nouns.term_frequencies(corpus(spark, sf)), nouns.term_frequencies(known).select("term"))


@query("""WITH f AS (SELECT upper(p_name[1]) || p_name[2:] AS term, count(*) AS freq FROM part GROUP BY 1), g AS (SELECT *, lower(substr(term, 1, 5)) AS key FROM f)
SELECT key, arg_min(term, (-freq, term)) AS canonical, CAST(sum(freq) AS BIGINT) AS total_freq, CAST(count(*) AS INTEGER) AS n_words FROM g GROUP BY key""")
def variant_groups(spark, sf):
    p = table(spark, sf, "part").groupBy(F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)")).alias("term")).agg(F.count("*").alias("freq"))
    return nouns.variant_groups(p, F.lower(F.substring("term", 1, 5))).select("key", "canonical", "total_freq", "n_words")


@query(f"""WITH {CORPUS}, f AS (SELECT term, count(*) AS freq FROM w GROUP BY term HAVING count(*) >= 3), u AS (SELECT * FROM f WHERE lower(term) NOT IN ('the', 'and', 'with', 'for'))
SELECT term AS canonical, freq AS total_freq, CASE WHEN length(term) <= 5 AND freq >= 5 THEN 'character' ELSE 'other' END AS category FROM u""")
def glossary(spark, sf):
    common = spark.createDataFrame([(w.capitalize(),) for w in ("the", "and", "with", "for")], "term string")
    return nouns.glossary(nouns.term_frequencies(corpus(spark, sf)), common).select("canonical", "total_freq", "category")


@query(f"""WITH {CORPUS}, p AS (SELECT * FROM (VALUES ('The', 'Da'), ('And', 'Und'), ('Her', 'Sie'), ('And', 'Et')) v(term, correction)), t AS (SELECT DISTINCT idx, term FROM w)
SELECT idx, term, correction FROM t JOIN p USING (term)""")
def corrections_found(spark, sf):
    pairs = spark.createDataFrame([("The", "Da"), ("And", "Und"), ("Her", "Sie"), ("And", "Et")], "term string, correction string")
    return nouns.corrections(corpus(spark, sf), pairs).select("idx", "term", "correction")


@query("""SELECT doc_id, md5(replace(replace(replace(text, 'the', 'THE'), 'and', '&'), 'THE a', 'A')) AS digest,
  CAST(CAST(contains(text, 'the') AS INTEGER) + CAST(contains(text, 'and') AS INTEGER) + CAST(contains(text, 'THE a') AS INTEGER) AS INTEGER) AS n_terms FROM documents""")
def corrections_apply(spark, sf):
    pairs = spark.createDataFrame([(1, "the", "THE"), (2, "and", "&"), (3, "THE a", "A")], "seq int, src string, dst string")
    return fixes.replace_everywhere(table(spark, sf, "documents").select("doc_id", "text"), pairs).select("doc_id", F.md5("text").alias("digest"), "n_terms")


@query()
def fuzzy_nouns(spark, sf):
    p, s = table(spark, sf, "part").select("p_name").distinct(), table(spark, sf, "part").select("p_type").distinct()
    cands = p.select(F.col("p_name").alias("text"), T.normalise(F.col("p_name"), "en").alias("norm"))
    names = s.select(F.col("p_type").alias("name"), T.normalise(F.col("p_type"), "en").alias("name_norm"))
    some = spark.createDataFrame([("Small Ring", "small ring"), ("red widgets", "red widgets"), ("blue bolt", "blue bolt")], "name string, name_norm string")
    return similarity.fuzzy_join(cands, names.unionByName(some), 0.7).select("text", "name", "similarity", "status")


@query()
def name_spans(spark, sf):
    s = corpus(spark, sf).select("idx", F.explode(nouns.candidate_spans(F.col("text"))).alias("s")).select("idx", "s.*")
    return s.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("text").alias("n_texts"))


# sets, fixes, report


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) WHERE k = 1""")
def dedup_first_wins(spark, sf):
    return setops.first_wins(table(spark, sf, "events"), ["user_id", "event_type"], ["event_id"]).select("event_id", "user_id", "event_type")


def fix_list(spark: SparkSession, sf: str) -> DataFrame:
    e, i = table(spark, sf, "events"), F.col("event_id")
    return e.select(
        i.alias("seq"), F.when(i % 5 == 0, "replace_global").otherwise("replace_text").alias("action"), F.concat(F.lit("f"), (F.col("user_id") % 7).cast("string")).alias("file"), F.lit(None).cast("string").alias("pattern"),
        F.when(i % 3 > 0, F.concat(F.lit("t"), (i % 11).cast("string"))).otherwise("").alias("original"), (i % 13).cast("int").alias("line"),
    )


@query("""WITH f AS (SELECT event_id AS seq, CASE WHEN event_id % 5 = 0 THEN 'replace_global' ELSE 'replace_text' END AS action, 'f' || CAST(user_id % 7 AS VARCHAR) AS file, CASE WHEN event_id % 3 > 0 THEN 't' || CAST(event_id % 11 AS VARCHAR) ELSE '' END AS original, event_id % 13 AS line FROM events)
SELECT seq, action, file, original FROM (SELECT *, row_number() OVER (PARTITION BY action, CASE WHEN action = 'replace_text' THEN file END, CASE WHEN action = 'replace_global' THEN original ELSE coalesce(nullif(original, ''), CAST(line AS VARCHAR)) END ORDER BY seq) AS k FROM f) WHERE k = 1""")
def dedup_fixes(spark, sf):
    return setops.dedup_fixes(fix_list(spark, sf), ["seq"]).select("seq", "action", "file", "original")


@query(f"""WITH {TIMELINE}, a AS (SELECT DISTINCT ep, start_ms // 1000 AS s FROM cues), b AS (SELECT DISTINCT ep, start_ms // 1000 AS s FROM speech)
SELECT ep, s, 'extra' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT ep, s, 'missing' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def set_diff_timecodes(spark, sf):
    t = timeline(spark, sf).withColumn("s", F.expr("start_ms div 1000"))
    return setops.differences(cues(t), speech(t), ["ep", "s"])


@query("""WITH o AS (SELECT doc_id % 200 AS k, min(doc_id) AS d FROM documents GROUP BY 1), a AS (SELECT 's' || CAST(k AS VARCHAR) AS src, CASE WHEN k % 3 > 0 THEN 'old' ELSE '' END AS dst FROM o WHERE k < 150), b AS (SELECT 's' || CAST(k AS VARCHAR) AS src, 'new' || CAST(k AS VARCHAR) AS dst FROM o WHERE k >= 50)
SELECT src, coalesce(nullif(a.dst, ''), b.dst, a.dst) AS dst FROM a FULL JOIN b USING (src)""")
def mapping_merge(spark, sf):
    k = table(spark, sf, "documents").select((F.col("doc_id") % 200).alias("k")).distinct().withColumn("src", F.concat(F.lit("s"), F.col("k").cast("string")))
    old = k.filter("k < 150").select("src", F.when(F.col("k") % 3 > 0, "old").otherwise("").alias("dst"))
    return setops.merge_mappings(old, k.filter("k >= 50").select("src", F.concat(F.lit("new"), F.col("k").cast("string")).alias("dst")))


@query(f"""WITH {TURNS} SELECT u.file, u.idx, length(u.text) AS n_user, length(a.text) AS n_assistant FROM (SELECT * FROM cues WHERE role = 'user') u JOIN (SELECT file, idx - 1 AS idx, text FROM cues WHERE role = 'assistant') a USING (file, idx)""")
def positional_zip(spark, sf):
    t = turns(spark, sf)
    a = t.filter("role = 'assistant'").withColumn("idx", F.col("idx") - 1).select("file", "idx", "text")
    z = setops.zip_rows(t.filter("role = 'user'"), a, ["file"])
    return z.select("file", "idx", F.length("text").cast("long").alias("n_user"), F.length("r_text").cast("long").alias("n_assistant"))


@query()
def compare_verdict(spark, sf):
    t = turns(spark, sf).withColumn("_id", F.col("file") * 100 + F.col("idx"))
    u, a = t.filter("role = 'user'"), t.filter("role = 'assistant'").withColumn("start_ms", F.col("start_ms") - 5000).withColumn("end_ms", F.col("end_ms") - 5000)
    return similarity.compare(u, a, ["file"]).groupBy("verdict").agg(F.count("*").alias("n"))


@query()
def similar_runs(spark, sf):
    return similarity.similar_runs(turns(spark, sf), ["file"]).groupBy("n").agg(F.count("*").alias("n_runs"))


@query()
def similar_runs_of_edits(spark, sf):
    """Every turn three times, with another ending each: three alike cues in a row."""
    t = turns(spark, sf).select("file", "idx", "start_ms", "end_ms", "text", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    t = t.withColumn("idx", F.col("idx") * 3 + F.col("k")).withColumn("text", F.concat("text", F.lit(" "), F.col("k").cast("string"))).drop("k")
    return similarity.similar_runs(t, ["file"]).groupBy("n").agg(F.count("*").alias("n_runs"))


REPORT = """old AS (SELECT '3' AS layer, 'EP' || CAST(doc_id % 50 AS VARCHAR) AS ep, CAST(doc_id AS VARCHAR) AS time, 'o' AS original, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'c' END AS corrected, CASE WHEN quality = 1 THEN '✅' ELSE '⬜' END AS status FROM labels),
new AS (SELECT CASE WHEN doc_id % 6 = 0 THEN '2' ELSE '3' END AS layer, 'EP' || CAST(doc_id % 50 AS VARCHAR) AS ep, CAST(doc_id AS VARCHAR) AS time, 'n' AS original, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'd' END AS corrected, CASE WHEN doc_id % 3 = 0 THEN '🗑️' ELSE '⬜' END AS status FROM documents)"""


def report_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    i = F.col("doc_id")
    ep, time = F.concat(F.lit("EP"), (i % 50).cast("string")).alias("ep"), i.cast("string").alias("time")
    old = table(spark, sf, "labels").select(F.lit("3").alias("layer"), ep, time, F.lit("o").alias("original"), F.when(i % 4 == 0, "").otherwise("c").alias("corrected"), F.when(F.col("quality") == 1, "✅").otherwise("⬜").alias("status"))
    new = table(spark, sf, "documents").select(
        F.when(i % 6 == 0, "2").otherwise("3").alias("layer"), ep, time, F.lit("n").alias("original"), F.when(i % 2 == 0, "").otherwise("d").alias("corrected"), F.when(i % 3 == 0, "🗑️").otherwise("⬜").alias("status")
    )
    return old, new


RANK = "CASE {} WHEN '✅' THEN 3 WHEN '🗑️' THEN 2 ELSE 1 END"
MERGED = f"""WITH {REPORT}, n2 AS (SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.ep = n.ep AND o.time = n.time AND o.layer <> n.layer AND {RANK.format('o.status')} > {RANK.format('n.status')})),
j AS (SELECT layer, ep, time, o.original AS oo, o.corrected AS oc, o.status AS os, n.original AS nn, n.corrected AS nc, n.status AS ns FROM old o FULL JOIN n2 n USING (layer, ep, time)),
m AS (SELECT *, ns IS NOT NULL AND (os IS NULL OR {RANK.format('ns')} >= {RANK.format('os')}) AS take FROM j),
merged AS (SELECT layer, ep, time, CASE WHEN take THEN nn ELSE oo END AS original, CASE WHEN take THEN coalesce(nullif(nc, ''), oc, nc) ELSE oc END AS corrected, CASE WHEN take THEN ns ELSE os END AS status FROM m)"""


@query(f"{MERGED} SELECT * FROM merged")
def report_merge(spark, sf):
    return report.merge(*report_tables(spark, sf))


@query(f"""{MERGED} SELECT layer, count(*) AS n, count(*) FILTER (status = '✅') AS done, count(*) FILTER (status = '🗑️') AS deleted, count(*) FILTER (status NOT IN ('✅', '🗑️')) AS pending FROM merged GROUP BY ROLLUP (layer)""")
def report_rollup(spark, sf):
    return report.summary(report.merge(*report_tables(spark, sf)))


@query(f"""WITH {TURNS}, now AS (SELECT file, start_ms, CASE WHEN idx % 3 = 1 THEN text || '!' ELSE text END AS text FROM cues WHERE idx % 4 < 3)
SELECT c.file, c.idx, CASE WHEN n.text IS NULL THEN 'DELETED' WHEN n.text <> c.text THEN 'FIXED' ELSE 'STILL' END AS state FROM cues c LEFT JOIN now n USING (file, start_ms)""")
def issue_diff(spark, sf):
    t = turns(spark, sf)
    now = t.filter("idx % 4 < 3").withColumn("text", F.when(F.col("idx") % 3 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return fixes.issue_diff(t.select("file", "idx", "start_ms", "text"), now, ["file"]).select("file", "idx", "state")


@query(rf"""WITH {TURNS}, l AS (SELECT *, lag(text) OVER (PARTITION BY file ORDER BY idx) AS p FROM cues),
m AS (SELECT *, len(list_filter(regexp_extract_all(text, '[a-zA-Z]{{2,}}'), lambda w: lower(w) NOT IN ({', '.join(f"'{w}'" for w in lex.EXCLAMATION_EN)}))) AS mt,
  len(list_filter(regexp_extract_all(p, '[a-zA-Z]{{2,}}'), lambda w: lower(w) NOT IN ({', '.join(f"'{w}'" for w in lex.EXCLAMATION_EN)}))) AS mp FROM l WHERE p IS NOT NULL)
SELECT CASE WHEN mt < 2 THEN 'cut' WHEN length(trim(text)) >= 3 AND regexp_matches(text, '[a-zA-Z]') AND NOT (mp >= 2 AND length(trim(text)) / greatest(length(trim(p)), 3) > 3.0) THEN 'keep' ELSE 'review' END AS verdict, count(*) AS n FROM m GROUP BY 1""")
def triage(spark, sf):
    c = turns(spark, sf).withColumn("p", F.lag("text").over(Window.partitionBy("file").orderBy("idx"))).filter("p is not null")
    return c.groupBy(fixes.triage(F.col("p"), F.col("text"), "en").alias("verdict")).agg(F.count("*").alias("n"))


@query(f"""WITH {TURNS}, f AS (SELECT file, start_ms, idx AS seq, CASE WHEN idx % 2 = 0 THEN 'delete_line' ELSE 'replace_text' END AS action FROM cues WHERE file % 3 = 0 AND idx IN (1, 2))
SELECT c.file, c.idx, CASE WHEN f.action = 'replace_text' THEN 'new' ELSE c.text END AS text FROM cues c LEFT JOIN f USING (file, start_ms) WHERE f.action IS NULL OR f.action <> 'delete_line'""")
def apply_fixes(spark, sf):
    t = turns(spark, sf).withColumn("start_line", F.col("idx") * 5)
    f = t.filter("file % 3 = 0 and idx in (1, 2)").select(
        F.col("idx").alias("seq"), F.when(F.col("idx") % 2 == 0, "delete_line").otherwise("replace_text").alias("action"), "file", "start_ms", F.lit(None).cast("int").alias("line"), F.lit("new").alias("replacement")
    )
    f = f.withColumn("seq", F.col("seq") + F.col("file") * 10)
    return fixes.replace_texts(t, f).select("file", "idx", "text")


@query()
def fixes_in_order(spark, sf):
    t = turns(spark, sf).select("file", "idx", "start_ms", "end_ms", "text")
    f = spark.createDataFrame(
        [(1, "replace_global", None, None, None, "the", "THE", None, None), (2, "merge_cues", 0, 0, None, None, None, None, 2), (3, "replace_global_regex", None, None, None, None, "#", "[0-9]+", None), (4, "delete_line", 2, 0, None, None, None, None, None)],
        "seq long, action string, file long, start_ms long, line int, original string, replacement string, pattern string, count int",
    )
    return fixes.apply_in_order(t, f).groupBy("file").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query(f"""WITH {TURNS} SELECT file, idx, row_number() OVER (PARTITION BY file ORDER BY start_ms, idx) AS srt_index FROM cues WHERE trim(text) <> ''""")
def renumbered(spark, sf):
    return fixes.renumber(fixes.drop_empty(turns(spark, sf))).select("file", "idx", F.col("srt_index").cast("long").alias("srt_index"))


@query(f"""WITH {TIMELINE}, p AS (SELECT g.ep, g.idx, c.idx AS n_idx, row_number() OVER (PARTITION BY g.ep, g.idx ORDER BY c.is_garbled, c.idx) AS k FROM (SELECT * FROM cues WHERE is_garbled) g JOIN cues c ON g.ep = c.ep AND abs(g.start_ms - c.start_ms) BETWEEN 100 AND 5000)
SELECT ep, idx, n_idx FROM p WHERE k = 1""")
def paired_neighbours(spark, sf):
    return fixes.pair_neighbours(cues(timeline(spark, sf)).withColumn("text", F.lit("x")), ["ep"]).select("ep", "idx", "n_idx")


@query(f"""WITH {TIMELINE}, a AS (SELECT ep, idx FROM cues WHERE is_garbled AND idx % 2 = 0), b AS (SELECT ep, idx FROM cues WHERE is_garbled)
SELECT ep, idx, 1 AS tier FROM a UNION ALL SELECT ep, idx, 2 AS tier FROM b WHERE idx NOT IN (SELECT idx FROM a)""")
def tier_union(spark, sf):
    c = cues(timeline(spark, sf)).filter("is_garbled").select("ep", "idx")
    return setops.tiers(c.filter("idx % 2 = 0").withColumn("tier", F.lit(1)), c.withColumn("tier", F.lit(2)), "idx")


# review, styled lines, files


@query(f"""WITH {TIMELINE}, s AS (SELECT *, (start_ms + end_ms) // 2 AS mid FROM speech)
SELECT ep, idx, slot FROM (SELECT s.ep, s.idx, c.idx AS slot, row_number() OVER (PARTITION BY s.idx ORDER BY c.start_ms, c.idx) AS k FROM s JOIN cues c ON s.ep = c.ep AND s.mid BETWEEN c.start_ms AND c.end_ms) WHERE k = 1""")
def midpoint_slots(spark, sf):
    t = timeline(spark, sf)
    return review.midpoint_join(speech(t), cues(t), ["ep"]).select("ep", "idx", F.col("r_idx").alias("slot"))


@query(f"""WITH {TIMELINE}, p AS (SELECT c.idx, s.idx AS s, s.start_ms, row_number() OVER (PARTITION BY c.idx ORDER BY abs(s.start_ms + s.end_ms - c.start_ms - c.end_ms), s.idx) AS k
  FROM (SELECT * FROM cues WHERE is_garbled) c JOIN speech s ON c.ep = s.ep AND least(c.end_ms + 30000, s.end_ms) - greatest(c.start_ms - 30000, s.start_ms) >= 0)
SELECT idx, string_agg('s' || CAST(s AS VARCHAR), ' ' ORDER BY start_ms, s) AS heard FROM p WHERE k <= 3 GROUP BY idx""")
def heard_around(spark, sf):
    t = timeline(spark, sf)
    asr = speech(t).withColumn("text", F.concat(F.lit("s"), F.col("idx").cast("string")))
    h = review.heard_around(cues(t).filter("is_garbled"), asr, ["ep"], most=3)
    return h.filter(F.size("heard") > 0).select("idx", F.array_join("heard", " ").alias("heard"))


@query(f"""WITH {TIMELINE}, p AS (SELECT c.idx, 1 + c.idx % 3 AS n_lines, s.start_ms, s.end_ms, row_number() OVER (PARTITION BY c.idx ORDER BY s.start_ms, s.idx) AS line, count(*) OVER (PARTITION BY c.idx) AS n
  FROM (SELECT * FROM cues WHERE is_garbled) c JOIN speech s ON c.ep = s.ep AND least(c.end_ms, s.end_ms) - greatest(c.start_ms, s.start_ms) > 300)
SELECT idx, CAST(line AS INTEGER) AS line, start_ms, end_ms FROM p WHERE n = 1 OR n = n_lines""")
def align_to_speech(spark, sf):
    t = timeline(spark, sf)
    c = cues(t).filter("is_garbled").withColumn("n_lines", 1 + F.col("idx") % 3)
    return review.align_to_speech(c, speech(t), ["ep"]).select(F.col("_id").alias("idx"), "line", "start_ms", "end_ms")


@query(f"""WITH {TIMELINE}, x AS (SELECT ep, max(end_ms) AS total_ms FROM t GROUP BY ep), s AS (SELECT ep, sum(end_ms - start_ms)::BIGINT AS speech_ms FROM speech GROUP BY ep)
SELECT ep, total_ms, coalesce(speech_ms, 0) AS speech_ms, coalesce(speech_ms, 0) / greatest(total_ms, 1) AS share FROM x LEFT JOIN s USING (ep)""")
def speech_share(spark, sf):
    t = timeline(spark, sf)
    return review.speech_share(speech(t), t.groupBy("ep").agg(F.max("end_ms").alias("total_ms")), ["ep"])


@query(f"""WITH {TIMELINE} SELECT c.idx, coalesce(sum(least(c.end_ms, s.end_ms) - greatest(c.start_ms, s.start_ms)) FILTER (s.idx IS NOT NULL), 0)::BIGINT AS covered_ms
FROM cues c LEFT JOIN speech s ON c.ep = s.ep AND least(c.end_ms, s.end_ms) - greatest(c.start_ms, s.start_ms) >= 1 GROUP BY c.idx""")
def covered_time(spark, sf):
    t = timeline(spark, sf)
    return review.covered_by(cues(t), speech(t), ["ep"]).select(F.col("_id").alias("idx"), "covered_ms")


@query(f"""WITH {TURNS}, cut AS (SELECT * FROM cues WHERE file % 3 = 0 AND idx = 1), fix AS (SELECT file, start_ms, end_ms, 'fixed' AS text FROM cues WHERE file % 2 = 0 AND idx IN (0, 1)),
l AS (SELECT * FROM cues WHERE NOT (file % 3 = 0 AND idx = 1))
SELECT l.file, l.start_ms, coalesce(f.text, l.text) AS text FROM l LEFT JOIN fix f USING (file, start_ms) UNION ALL SELECT f.file, f.start_ms, f.text FROM fix f ANTI JOIN l USING (file, start_ms)""")
def apply_recognised(spark, sf):
    t = turns(spark, sf)
    fix = t.filter("file % 2 = 0 and idx in (0, 1)").withColumn("replacement", F.lit("fixed"))
    cut = t.filter("file % 3 = 0 and idx = 1")
    return review.apply_recognised(t, fix, cut, cut.limit(0), ["file"]).select("file", "start_ms", "text")


@query(f"""WITH {TURNS} SELECT review_verdict AS verdict, count(*) AS n FROM (SELECT CASE WHEN idx % 5 = 0 THEN 'delete' WHEN idx % 5 = 1 THEN 'replace'
  WHEN len(list_filter(regexp_extract_all(text, '[a-zA-Z]{{2,}}'), lambda w: lower(w) NOT IN ({', '.join(f"'{w}'" for w in lex.EXCLAMATION_EN)}))) < 2 OR idx % 2 = 0 OR file % 10 >= 6 THEN 'cut' ELSE 'mark' END AS review_verdict FROM cues) GROUP BY 1""")
def fragment_decisions(spark, sf):
    answer = F.when(F.col("idx") % 5 == 0, "__DELETE__").when(F.col("idx") % 5 == 1, "better")
    verdict = review.decision(answer, F.col("text"), F.col("idx") % 2 != 0, F.col("file") % 10 / 10.0, "en")
    return turns(spark, sf).groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


def styled_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as styled lines: the role is the style, the source of the first word the name."""
    return turns(spark, sf).select("file", F.col("idx").alias("line"), F.lit("dialogue").alias("kind"), F.col("role").alias("style"), F.split_part("text", F.lit(" "), F.lit(1)).alias("name"), "start_ms", "idx", "text")


@query(r"""SELECT role AS style, count(*) AS n, count(DISTINCT conv_id) AS n_files, arg_min(substr(regexp_replace(text, '^\s+|\s+$', '', 'g'), 1, 30), (conv_id, turn)) FILTER (trim(text) <> '') AS sample FROM conversations GROUP BY role""")
def style_statistics(spark, sf):
    return styled.statistics(styled_lines(spark, sf), "style")


@query("""WITH n AS (SELECT DISTINCT split_part(text, ' ', 1) AS name FROM conversations) SELECT CASE WHEN regexp_matches(name, '[a-zA-Z]') THEN 'latin' ELSE 'other' END AS language, count(*) AS n FROM n GROUP BY 1""")
def name_languages(spark, sf):
    return styled.name_languages(styled_lines(spark, sf))


@query("""SELECT conv_id AS file, count(*) FILTER (role = 'user') AS n_a, count(*) FILTER (role = 'assistant') AS n_b FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'user') <> count(*) FILTER (role = 'assistant')""")
def style_mismatches(spark, sf):
    return styled.count_mismatches(styled_lines(spark, sf), "user", "assistant")


@query("""WITH v AS (SELECT 6000 * turn AS start_ms, split_part(text, ' ', 1) AS text, count(*) AS n FROM conversations GROUP BY 1, 2) SELECT start_ms, text, n, n_texts FROM (SELECT *, count(*) OVER (PARTITION BY start_ms) AS n_texts FROM v) WHERE n_texts > 1""")
def variants_at_times(spark, sf):
    return styled.variants_at(styled_lines(spark, sf).withColumn("text", F.col("name")))


@query("""WITH e AS (SELECT 'EP' || lpad(CAST(conv_id AS VARCHAR), 3, '0') AS ep, conv_id AS n FROM conversations) SELECT ep, count(*) AS n FROM e WHERE n IN (1, 3) OR n BETWEEN 7 AND 40 GROUP BY ep""")
def episode_filter(spark, sf):
    c = turns(spark, sf).withColumn("ep", F.concat(F.lit("EP"), F.lpad(F.col("file").cast("string"), 3, "0")))
    return c.filter(files.episode_filter(F.col("ep"), "1, 3,7-40")).groupBy("ep").agg(F.count("*").alias("n"))


@query("""SELECT lang, CASE WHEN regexp_matches(text, '[А-Яа-яЁё]') THEN 'cyrillic' WHEN regexp_matches(text, '[぀-ヿ]') THEN 'kana' WHEN regexp_matches(text, '[一-鿿]') AND regexp_matches(text, '[a-zA-Z]{2,}') THEN 'bilingual' ELSE 'foreign' END AS issue, count(*) AS n FROM documents GROUP BY 1, 2""")
def issue_types(spark, sf):
    return table(spark, sf, "documents").groupBy("lang", files.issue_type(F.col("text")).alias("issue")).agg(F.count("*").alias("n"))


@query("""SELECT 'sub ' || CAST(c AS VARCHAR) || '.srt' AS file, CASE WHEN c % 2 = 0 THEN 'video_E' || lpad(CAST(c AS VARCHAR), 4, '0') || '.mkv' END AS video FROM (SELECT DISTINCT conv_id % 300 + 1 AS c FROM conversations)""")
def video_match(spark, sf):
    c = table(spark, sf, "conversations").select((F.col("conv_id") % 300 + 1).alias("c")).distinct()
    s = c.select(F.concat(F.lit("sub "), F.col("c").cast("string"), F.lit(".srt")).alias("file"))
    v = c.filter("c % 2 = 0").select(F.concat(F.lit("video_E"), F.lpad(F.col("c").cast("string"), 4, "0"), F.lit(".mkv")).alias("file"))
    return files.match_videos(s, v)


@query(f"""WITH {TIMELINE}, done AS (SELECT ep, start_ms FROM cues WHERE idx % 3 = 0) SELECT ep, idx FROM cues c WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.ep = c.ep AND d.start_ms = c.start_ms)""")
def resume_anti(spark, sf):
    c = cues(timeline(spark, sf))
    return c.join(c.filter("idx % 3 = 0").select("ep", "start_ms"), ["ep", "start_ms"], "left_anti").select("ep", "idx")


@query(rf"WITH {CORPUS}, f AS (SELECT term, count(*) AS n FROM w GROUP BY term) SELECT term, n FROM f ORDER BY n DESC, term LIMIT 50")
def top_terms(spark, sf):
    return nouns.term_frequencies(corpus(spark, sf)).withColumnRenamed("freq", "n").orderBy(F.col("n").desc(), "term").limit(50)

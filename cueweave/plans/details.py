"""More of the catalogue: text rules of other scripts, files and formats, reports, and the steps around fixes.

The test tables are in Latin script. `samples` has whole texts of documents carried into other scripts (see `scripts`), and in
the place of every fourth one a fixed line with what texts seldom hold, so that rules for those scripts run on whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueweave.functions import lexicon as lex
from cueweave.functions import text as T
from cueweave.functions import timecode as C
from cueweave.operators import files, fixes, nouns, oped, regions, report, review, setops, similarity, styled, summary, temporal
from cueweave.plans.catalogue import REGIONED, REPORT, TIMELINE, TURNS, WORDS, corpus, cues, query, regioned, report_tables, speech, styled_lines, table, timeline, turns
from cueweave.plans.scripts import BY_LANG, ZH, carried, carried_sql, in_any, words, words_sql
from cueweave.sources import subtitles, tables
from cueweave.streaming import incremental

SAMPLES = [
    "[音楽]", "[Music]", "[掌声]", " [BGM] ", "[Nothing]", "行くぞ", "あっ！えーっ！", "アトムさん、来て", "おい アトム 待て", "私は医者です", "これは本という物", "OK です ね", "ｶﾅ 山田 abc", "東京", "アースーナ", "カーテンー",
    "你好，先生", "我叫小明", "这是我的书", "啊啊啊啊", "花儿 真好", "那儿，好", "Lǚ ān", "Привет мир", "hello there", "Um, oh", "a", "", "ハハハハハ", "ガギグ ヴ", "シュークリーム", "キャッチ",
]
_LIST = "['" + "', '".join(SAMPLES) + "']"
SAMPLED = f"""s AS (SELECT doc_id, source, CASE WHEN doc_id % 4 = 0 THEN list_extract({_LIST}, (doc_id // 4) % {len(SAMPLES)} + 1) ELSE {carried_sql("text", "lang", BY_LANG)} END AS t FROM documents)"""


def samples(spark: SparkSession, sf: str) -> DataFrame:
    at = F.expr(f"cast((doc_id div 4) % {len(SAMPLES)} + 1 as int)")
    t = F.when(F.col("doc_id") % 4 == 0, F.element_at(F.array(*map(F.lit, SAMPLES)), at)).otherwise(carried(F.col("text"), F.col("lang"), BY_LANG))
    return table(spark, sf, "documents").select("doc_id", "source", t.alias("t"))


def _alternation(lang: str) -> str:
    return "|".join(lex.MARKERS[lang])


STRIP = r"regexp_replace(t, '^[\s　]+|[\s　]+$', '', 'g')"
PER = "SELECT t, count(*) AS n, {} FROM s GROUP BY t"


def per_sample(spark: SparkSession, sf: str, flags: dict[str, Column]) -> DataFrame:
    return samples(spark, sf).groupBy("t").agg(F.count("*").alias("n"), *[F.count_if(v).alias(k) for k, v in flags.items()])


def count_of(sql: dict[str, str]) -> str:
    return f"WITH {SAMPLED} " + PER.format(", ".join(f"count(*) FILTER ({v}) AS {k}" for k, v in sql.items()))


# rules for scripts


@query(count_of({f"m_{lang}": rf"regexp_full_match(t, '\[({_alternation(lang)})\]')" for lang in ("ja", "zh", "en")} | {"music": rf"regexp_full_match({STRIP}, '\[[^\]]+\]')"}))
def markers(spark, sf):
    c = F.col("t")
    return per_sample(spark, sf, {f"m_{lang}": T.is_marker(c, lang) for lang in ("ja", "zh", "en")} | {"music": T.is_music_marker(c)})


N = f"length({STRIP})"
LATIN_N, KANA_N, HAN_N = ("len(regexp_extract_all(t, '[a-zA-Z]'))", "len(regexp_extract_all(t, '[ぁ-ヿ]'))", "len(regexp_extract_all(t, '[一-鿿]'))")


@query(count_of({
    "v_ja": f"{N} >= 2 AND ({KANA_N} > 0 OR {HAN_N} > 0) AND {LATIN_N} / greatest({N}, 1) <= 0.5", "v_zh": f"{N} >= 2 AND {HAN_N} > 0", "v_en": f"{N} >= 2 AND regexp_matches(t, '[a-zA-Z]{{2,}}') AND {HAN_N} = 0",
    "g_ja": f"t <> '' AND regexp_matches(t, '[a-zA-Z]{{2,}}|[А-Яа-яЁё]')", "g_zh": f"t <> '' AND regexp_matches(t, '[a-zA-Z]{{2,}}|[А-Яа-яЁё]|[぀-ヿ]')",
    "p_ja": f"{N} >= 3 AND (regexp_matches(t, '[぀-ヿ]') OR {HAN_N} > 0) AND {LATIN_N} = 0 AND NOT regexp_matches(t, '[А-яЁё]')",
}))
def votes_and_shapes(spark, sf):
    c = F.col("t")
    return per_sample(spark, sf, {f"v_{lang}": T.is_valid_for_votes(c, lang) for lang in ("ja", "zh", "en")} | {f"g_{lang}": T.is_garbled(c, lang) for lang in ("ja", "zh")} | {"p_ja": T.is_plausible(c, "ja")})


@query(count_of({
    "s_ja": f"{N} > 0 AND regexp_matches(t, '[぀-ヿ一-鿿]') AND {LATIN_N} <= 5 AND {N} <= 15", "s_zh": f"{N} > 0 AND {N} <= 8 AND {HAN_N} = 0", "f_ja": f"regexp_matches(t, '[぀-ヿ一-鿿]') AND {LATIN_N} > 0 AND {N} <= 80",
    "f_zh": f"{HAN_N} > 0 AND {LATIN_N} > 0 AND {N} <= 80", "name_ja": "regexp_full_match(t, '[゠-ヿ]{2,}|[一-鿿]{2,4}') OR regexp_matches(t, '[゠-ヿ]') AND regexp_matches(t, '[a-zA-Z]')", "name_zh": "regexp_full_match(t, '[一-鿿]{2,4}')",
}))
def fragment_flags(spark, sf):
    c = F.col("t")
    flags = {"s_ja": T.is_short_fragment(c, "ja"), "s_zh": T.is_short_fragment(c, "zh"), "f_ja": T.is_fixable(c, "ja"), "f_zh": T.is_fixable(c, "zh"), "name_ja": T.is_name_shape(c, "ja"), "name_zh": T.is_name_shape(c, "zh")}
    return per_sample(spark, sf, flags)


@query(f"""WITH {SAMPLED} SELECT doc_id, len(regexp_extract_all(t, '[ぁ-ヿ一-鿿]')) - len(regexp_extract_all(t, '[{lex.EXCLAMATION_KANA}]')) AS ja, greatest(0, {HAN_N} - len(regexp_extract_all(t, '[{lex.EXCLAMATION_HAN}]'))) AS zh,
  len(regexp_extract_all(t, '[぀-ヿ一-鿿]')) AS plain_ja, {HAN_N} AS plain_zh, regexp_matches(t, '[぀-ヿ一-鿿]') AS cjk FROM s""")
def meaningful_scripts(spark, sf):
    c = F.col("t")
    counts = {"ja": T.meaningful_count(c, "ja"), "zh": T.meaningful_count(c, "zh"), "plain_ja": T.plain_count(c, "ja"), "plain_zh": T.plain_count(c, "zh")}
    return samples(spark, sf).select("doc_id", *[v.cast("long").alias(k) for k, v in counts.items()], T.has(c, T.KANA + T.HAN).alias("cjk"))


@query(f"""WITH {SAMPLED}, k AS (SELECT t, {KANA_N} AS k, {HAN_N} AS h, len(regexp_extract_all(t, '[Ѐ-ӿ]')) AS y, {LATIN_N} AS a FROM s),
w AS (SELECT *, CASE WHEN h > greatest(k, y, a) THEN 'zh' WHEN k > greatest(h, y, a) THEN 'ja' WHEN y > greatest(h, k, a) THEN 'ru' WHEN a > 0 THEN 'en' ELSE '??' END AS lang FROM k)
SELECT lang, count(*) AS n, count(*) FILTER (lang IN ('zh', 'ja')) AS fits_ja FROM w GROUP BY lang""")
def script_languages(spark, sf):
    s = samples(spark, sf).withColumn("script", T.script(F.col("t")))
    return s.groupBy(T.script_language(F.col("script")).alias("lang")).agg(F.count("*").alias("n"), F.count_if(T.scripts_match(F.col("script"), "ja")).alias("fits_ja"))


JA, ZH = nouns.NAME_CONTEXT["ja"], nouns.NAME_CONTEXT["zh"]


@query(f"""WITH {SAMPLED} SELECT doc_id, CASE WHEN regexp_matches(t, 'アトム\\s*({JA['honorific']})') THEN 'honorific_suffix' WHEN regexp_matches(t, '{JA['before']}') THEN 'intro_before' WHEN regexp_matches(t, '{JA['after']}') THEN 'intro_after'
  WHEN regexp_matches(t, '({JA['calling']})\\s*アトム') THEN 'calling' END AS ja, CASE WHEN regexp_matches(t, '{ZH['title']}') THEN 'title_suffix' WHEN regexp_matches(t, '{ZH['intro']}') THEN 'intro_pattern'
  WHEN regexp_matches(t, '{ZH['possessive']}') THEN 'possessive' END AS zh FROM s""")
def name_contexts(spark, sf):
    return samples(spark, sf).select("doc_id", nouns.name_context(F.col("t"), F.lit("アトム"), "ja").alias("ja"), nouns.name_context(F.col("t"), F.lit("x"), "zh").alias("zh"))


_STRICT = f"regexp_replace(t, '([{T.LENGTHENED}])ー', '\\1', 'g')"
_MEDIUM = f"translate({_STRICT}, '{T.SMALL_KATAKANA}', '{T.LARGE_KATAKANA}')"
_TONES = f"translate(replace(t, '你', '妳'), '{T.TONES}', '{T.VOWELS}')"


@query(f"""WITH {SAMPLED} SELECT DISTINCT t, {_STRICT} AS strict, {_MEDIUM} AS medium, translate({_MEDIUM}, '{T.VOICED_KATAKANA}', '{T.CLEAR_KATAKANA}') AS lenient, replace(t, '你', '妳') AS zh_strict, {_TONES} AS zh_medium,
  regexp_replace({_TONES}, '儿($|[ ，])', '\\1', 'g') AS zh_lenient, translate(replace(t, 'ー', ''), '{T.SMALL}', '{T.LARGE}') AS grouped FROM s""")
def normalised(spark, sf):
    c = F.col("t")
    ja = [T.normalise(c, "ja", level).alias(level) for level in ("strict", "medium", "lenient")]
    zh = [T.normalise(c, "zh", level, "你", "妳").alias(f"zh_{level}") for level in ("strict", "medium", "lenient")]
    return samples(spark, sf).select("t", *ja, *zh, T.grouping_key(c).alias("grouped")).distinct()


@query(f"""WITH {SAMPLED}, f AS (SELECT t AS term, count(*) AS freq FROM s WHERE regexp_full_match(t, '[゠-ヿ]+') GROUP BY t), g AS (SELECT *, translate(replace(term, 'ー', ''), '{T.SMALL}', '{T.LARGE}') AS key FROM f)
SELECT key, arg_min(term, (-freq, term)) AS canonical, sum(freq)::BIGINT AS total_freq, count(*) AS n_words FROM g GROUP BY key""")
def katakana_groups(spark, sf):
    f = samples(spark, sf).filter("t rlike '^[゠-ヿ]+$'").groupBy(F.col("t").alias("term")).agg(F.count("*").alias("freq"))
    return nouns.variant_groups(f).select("key", "canonical", "total_freq", F.col("n_words").cast("long").alias("n_words"))


@query(f"""WITH {TIMELINE} SELECT idx, start_ms // 10 * 10 / 1000.0 AS dots, start_ms / 1000.0 AS dashes, 0.0::DOUBLE AS nothing FROM t""")
def seconds_of(spark, sf):
    srt = C.srt_time(F.col("start_ms"))
    return timeline(spark, sf).select("idx", C.to_seconds(F.translate(F.substring(srt, 1, 11), ",", ".")).alias("dots"), C.to_seconds(F.translate(srt, ":", "-")).alias("dashes"), C.to_seconds(F.concat(srt, F.lit("x"))).alias("nothing"))


@query("""SELECT doc_id, md5(regexp_replace(regexp_replace(text, '(^|[^A-Za-z0-9_])the ([A-Za-z0-9_]+)', '\\1\\2 THE', 'g'), 'and', '&', 'g')) AS digest, md5(translate(text, 'abc', 'xyz')) AS simple,
  array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[^mnlbspcMNLBSPC0-9.\\-\\s]'))), '') AS bad FROM documents""")
def patterns_and_drawings(spark, sf):
    d = table(spark, sf, "documents")
    rules = [("(^|[^A-Za-z0-9_])the ([A-Za-z0-9_]+)", "$1$2 THE"), ("and", "&")]
    d = d.select("doc_id", T.replace_patterns(F.col("text"), rules).alias("replaced"), T.bad_drawing_chars(F.col("text")).alias("bad"), "text")
    return styled.simplified(d, "abc", "xyz").select("doc_id", F.md5("replaced").alias("digest"), F.md5("text").alias("simple"), F.array_join(F.array_sort("bad"), "").alias("bad"))


# time lines


@query(f"""WITH {TIMELINE}, bad AS (SELECT * FROM cues WHERE is_garbled), near AS (SELECT s.ep, s.seg_idx, c._id, c.idx, c.start_ms, c.end_ms FROM speech s JOIN bad c ON s.ep = c.ep AND least(s.end_ms + 1000, c.end_ms) - greatest(s.start_ms - 1000, c.start_ms) >= 0),
high AS (SELECT ep, seg_idx, min(start_ms) AS start_ms, arg_max(end_ms, (start_ms, idx)) AS end_ms, string_agg('cue ' || CAST(idx AS VARCHAR), ' | ' ORDER BY start_ms, idx) AS original, 'said ' || CAST(seg_idx AS VARCHAR) AS replacement, 'high' AS confidence FROM near GROUP BY ep, seg_idx),
lft AS (SELECT * FROM bad WHERE _id NOT IN (SELECT _id FROM near)),
far AS (SELECT c._id, min(s.seg_idx) AS seg_idx FROM lft c JOIN speech s ON s.ep = c.ep AND least(c.end_ms + 4000, s.end_ms) - greatest(c.start_ms - 4000, s.start_ms) >= 0 GROUP BY c._id)
SELECT * FROM high UNION ALL SELECT ep, f.seg_idx, start_ms, end_ms, 'cue ' || CAST(idx AS VARCHAR), CASE WHEN f.seg_idx IS NULL THEN '' ELSE 'said ' || CAST(f.seg_idx AS VARCHAR) END, CASE WHEN f.seg_idx IS NULL THEN 'none' ELSE 'retry' END FROM lft LEFT JOIN far f USING (_id)""")
def fix_rows(spark, sf):
    t = timeline(spark, sf)
    said = speech(t).withColumn("text", F.concat(F.lit("said "), F.col("seg_idx").cast("string")))
    return regions.fix_rows(said, cues(t).filter("is_garbled").withColumn("text", F.concat(F.lit("cue "), F.col("idx").cast("string"))), ["ep"])


@query(f"""WITH {TIMELINE}, ok AS (SELECT * FROM cues WHERE NOT is_garbled AND idx % 7 > 0)
SELECT s.ep, s.idx, arg_max(c.idx, (c.start_ms, c.idx)) FILTER (c.end_ms <= s.start_ms + 2000) AS left_idx, arg_min(c.idx, (c.start_ms, c.idx)) FILTER (c.start_ms >= s.end_ms - 2000) AS right_idx
FROM speech s LEFT JOIN ok c ON s.ep = c.ep GROUP BY s.ep, s.idx""")
def clean_neighbours(spark, sf):
    t = timeline(spark, sf)
    c = cues(t).withColumn("text", F.when(F.col("idx") % 7 > 0, "some text").otherwise("[Music]"))
    return regions.clean_neighbours(speech(t), c, ["ep"], "en").select("ep", "idx", "left_idx", "right_idx")


@query(f"""WITH {TIMELINE}, n AS (SELECT *, row_number() OVER (PARTITION BY ep ORDER BY start_ms, idx) AS k FROM cues WHERE idx % 5 > 0), c AS (SELECT * FROM cues WHERE is_garbled),
p AS (SELECT c._id, coalesce(max(n.k) FILTER (n.start_ms < c.start_ms - 1000), 0) AS b, coalesce(max(n.k) FILTER (n.start_ms <= c.end_ms + 1000), 0) AS a FROM c LEFT JOIN n ON c.ep = n.ep GROUP BY c._id),
x AS (SELECT c._id AS idx, string_agg('c' || CAST(n.idx AS VARCHAR), ' ' ORDER BY n.k) FILTER (n.k BETWEEN p.b - 5 AND p.b) AS before, string_agg('c' || CAST(n.idx AS VARCHAR), ' ' ORDER BY n.k) FILTER (n.k BETWEEN p.a + 1 AND p.a + 6) AS after
  FROM c JOIN p USING (_id) LEFT JOIN n ON c.ep = n.ep AND (n.k BETWEEN p.b - 5 AND p.b OR n.k BETWEEN p.a + 1 AND p.a + 6) GROUP BY c._id)
SELECT idx, coalesce(before, '') AS before, coalesce(after, '') AS after FROM x""")
def fragment_context(spark, sf):
    t = timeline(spark, sf)
    c = cues(t).withColumn("text", F.when(F.col("idx") % 5 > 0, F.concat(F.lit("c"), F.col("idx").cast("string"))).otherwise(" "))
    f = review.fragment_context(cues(t).filter("is_garbled"), c, ["ep"])
    return f.select("idx", F.array_join("before", " ").alias("before"), F.array_join("after", " ").alias("after"))


@query(f"WITH {TIMELINE} SELECT ep, idx FROM speech WHERE start_ms <= 200000 AND end_ms >= 100000")
def spot_filter(spark, sf):
    s = speech(timeline(spark, sf))
    spots = s.select("ep").distinct().withColumn("start_ms", F.lit(100_000).cast("long")).withColumn("end_ms", F.lit(200_000).cast("long"))
    return temporal.range_join(s, spots, ["ep"], how="left_semi").select("ep", "idx")


@query(f"""WITH {TIMELINE} SELECT start_ms // 60000 * 60000 AS start_ms, count(*) AS n, count(*) FILTER (is_garbled) AS n_garbled FROM cues GROUP BY 1""")
def tumbling_rates(spark, sf):
    """The streaming aggregate, run on a table."""
    t = cues(timeline(spark, sf)).withColumn("text", F.when(F.col("is_garbled"), "Привет").otherwise("hello"))
    rates = incremental.garbled_rates(t.withColumn("ts", incremental.event_time()), lang="en")
    return rates.select((F.unix_millis("window_start") - F.unix_millis(F.timestamp_seconds(F.lit(1_704_067_200)))).alias("start_ms"), "n", "n_garbled")


# openings and endings


@query(f"""WITH {REGIONED} SELECT region, bucket_ms, text FROM (SELECT *, row_number() OVER (PARTITION BY region, bucket_ms ORDER BY file, idx) AS k FROM b) WHERE k = 1""")
def reference_texts(spark, sf):
    return oped.reference_texts(oped.grid_buckets(regioned(spark, sf)))


@query(f"""WITH {REGIONED}, c AS (SELECT DISTINCT region, bucket_ms FROM b), f AS (SELECT region, bucket_ms + 1000 AS at, text FROM (SELECT *, row_number() OVER (PARTITION BY region, bucket_ms ORDER BY file, idx) AS k FROM b WHERE bucket_ms % 4000 = 0) WHERE k = 1)
SELECT c.region, c.bucket_ms, arg_min(f.text, f.at) AS reference FROM c LEFT JOIN f ON c.region = f.region AND abs(c.bucket_ms - f.at) <= 2000 GROUP BY c.region, c.bucket_ms""")
def near_references(spark, sf):
    b = oped.grid_buckets(regioned(spark, sf))
    refs = oped.reference_texts(b.filter("bucket_ms % 4000 = 0")).withColumn("bucket_ms", F.col("bucket_ms") + 1000)
    return oped.near_reference(b.select("region", "bucket_ms").distinct(), refs)


@query(f"""WITH {REGIONED}, e AS (SELECT file, idx, region, bucket_ms, CASE WHEN idx % 2 = 0 THEN '♪' ELSE text END AS t FROM b), w AS (SELECT *, CASE WHEN bucket_ms % 6000 = 0 THEN 'instrumental' ELSE 'vocal' END AS kind,
  CASE WHEN bucket_ms % 10000 = 0 THEN '__INSTRUMENTAL__' WHEN bucket_ms % 10000 = 2000 THEN 'sung' END AS answer FROM e),
x AS (SELECT *, CASE WHEN answer = '__INSTRUMENTAL__' THEN '[音楽]' WHEN answer IS NOT NULL THEN answer WHEN kind = 'instrumental' AND t = '♪' THEN '[音楽]' END AS replacement FROM w)
SELECT file, idx, t AS original, replacement, CASE WHEN answer IS NOT NULL THEN 'decision' ELSE 'rule' END AS by FROM x WHERE replacement <> t""")
def oped_auto_fixes(spark, sf):
    b = oped.grid_buckets(regioned(spark, sf)).withColumn("text", F.when(F.col("idx") % 2 == 0, "♪").otherwise(F.col("text")))
    keys = b.select("region", "bucket_ms").distinct()
    kinds = keys.withColumn("kind", F.when(F.col("bucket_ms") % 6000 == 0, "instrumental").otherwise("vocal"))
    m = F.col("bucket_ms") % 10000
    return oped.auto_fixes(b, kinds, keys.withColumn("answer", F.when(m == 0, "__INSTRUMENTAL__").when(m == 2000, "sung")), "en")


# terms


@query(f"""WITH d AS (SELECT conv_id AS file, turn AS idx, text FROM conversations), w AS (SELECT file, idx, unnest(list_distinct({WORDS.format('text')})) AS term FROM d), p AS (SELECT * FROM (VALUES ('The', 'the'), ('And', 'zzz'), ('The', 'Da')) v(term, correction))
SELECT w.file, w.idx, term, correction, coalesce(contains(s.text, correction), false) AS confirmed FROM w JOIN p USING (term) LEFT JOIN (SELECT file, idx - 1 AS idx, text FROM d) s USING (file, idx)""")
def confirmed_corrections(spark, sf):
    pairs = spark.createDataFrame([("The", "the"), ("And", "zzz"), ("The", "Da")], "term string, correction string")
    t = turns(spark, sf).select("file", "idx", "text")
    return nouns.confirmed_corrections(t, pairs, t.withColumn("idx", F.col("idx") - 1), ["file"]).select("file", "idx", "term", "correction", "confirmed")


@query("""WITH w AS (SELECT conv_id AS file, turn AS idx, split_part(text, ' ', 1) AS token FROM conversations), k AS (SELECT DISTINCT split_part(text, ' ', 1) AS token FROM conversations WHERE turn = 0)
SELECT a.token, b.token AS r_token, count(*) AS n, count(DISTINCT a.file) AS n_eps FROM w a JOIN (SELECT file, idx - 1 AS idx, token FROM w) b USING (file, idx) WHERE b.token IN (SELECT token FROM k) GROUP BY 1, 2""")
def co_occurring(spark, sf):
    w = turns(spark, sf).select("file", "idx", F.split_part("text", F.lit(" "), F.lit(1)).alias("token"))
    known = w.filter("idx = 0").select("token").distinct()
    return nouns.co_occurring(w, w.withColumn("idx", F.col("idx") - 1), known, ["file"])


@query(f"""WITH d AS (SELECT doc_id AS idx, source AS ep, text FROM documents), w AS (SELECT idx, ep, unnest({WORDS.format('text')}) AS term FROM d), h AS (SELECT lower(substr(term, 1, 4)) AS reading, term, ep, idx FROM w),
c AS (SELECT reading, term, count(*) AS n, min({{'ep': ep, 'idx': idx}}) AS first FROM h GROUP BY ALL)
SELECT reading, sum(n)::BIGINT AS n, count(*) AS n_terms, arg_min(term, (-n, term)) AS top, arg_min(first.idx, (-n, term)) AS top_idx FROM c GROUP BY reading HAVING count(*) > 1""")
def reading_groups(spark, sf):
    c = corpus(spark, sf).select("ep", "idx", F.explode(nouns.terms(F.col("text"))).alias("term")).withColumn("reading", F.lower(F.substring("term", 1, 4)))
    g = nouns.reading_groups(c)
    return g.select("reading", "n", "n_terms", F.col("terms")[0]["term"].alias("top"), F.col("terms")[0]["places"][0]["idx"].alias("top_idx"))


@query("""SELECT p_type AS term, max(p_size)::BIGINT AS freq FROM part GROUP BY 1""")
def most_frequent(spark, sf):
    return nouns.most_frequent(table(spark, sf, "part").select(F.col("p_type").alias("term"), F.col("p_size").cast("long").alias("freq")))


@query("""SELECT term FROM (SELECT DISTINCT p_type AS term FROM part UNION SELECT DISTINCT upper(event_type) FROM events UNION SELECT p_type FROM part)""")
def term_union(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_type").alias("term"))
    return setops.union_by_priority([p, table(spark, sf, "events").select(F.upper("event_type").alias("term")), p]).select("term").distinct()


# summaries


@query(rf"""WITH {TURNS}, g AS (SELECT *, regexp_matches(text, '[А-Яа-яЁё]|[぀-ヿ]|[一-鿿]') OR file % 3 = 0 AS bad FROM cues), w AS (SELECT DISTINCT unnest({WORDS.format('text')}) AS term FROM cues)
SELECT count(DISTINCT file) AS n_files, count(*) AS n_cues, count(*) FILTER (bad) AS n_garbled, (SELECT count(*) FROM cues WHERE idx > 2) AS n_repeats, (SELECT count(*) FROM w) AS n_terms, count(DISTINCT ep) FILTER (bad) AS n_eps_with_issues FROM g""")
def scan_summary(spark, sf):
    t = turns(spark, sf)
    c = t.withColumn("is_garbled", T.is_garbled(F.col("text"), "en") | (F.col("file") % 3 == 0))
    return summary.scan(c, t.select(F.explode(nouns.terms(F.col("text"))).alias("term")), t.filter("idx > 2"))


@query("""SELECT ep, count(*) AS n, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS idxs FROM (SELECT CASE WHEN conv_id % 9 = 0 THEN '???' WHEN conv_id % 9 = 1 THEN '' ELSE 'EP' || CAST(conv_id AS VARCHAR) END AS ep, turn AS idx FROM conversations) WHERE ep NOT IN ('', '???') GROUP BY ep""")
def issues_by_episode(spark, sf):
    k = F.col("file") % 9
    t = turns(spark, sf).select(F.when(k == 0, "???").when(k == 1, "").otherwise(F.concat(F.lit("EP"), F.col("file").cast("string"))).alias("ep"), "idx", "text")
    return summary.by_episode(t, ["idx"]).select("ep", F.size("issues").cast("long").alias("n"), F.array_join(F.transform("issues", lambda x: x["idx"].cast("string")), ",").alias("idxs"))


@query("""SELECT user_id, count(*) AS n_fixed, coalesce(sum(event_id % 5) FILTER (event_id % 4 > 0), 0)::BIGINT AS n_cut FROM events GROUP BY user_id""")
def merged_counters(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.lit(1).alias("n_fixed"), F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 5).alias("n_cut"))
    return summary.merged_counters(e, ["user_id"], ["n_fixed", "n_cut"])


@query("""WITH c AS (SELECT split_part(text, ' ', 1) AS text, CASE turn % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'mismatch' ELSE 'exact' END AS status, conv_id AS file, turn AS idx FROM conversations)
SELECT text, status, count(*) AS n, arg_min(file, (file, idx)) AS file, arg_min(idx, (file, idx)) AS idx FROM c WHERE status <> 'exact' GROUP BY text, status ORDER BY n DESC, text, status LIMIT 50""")
def verdict_tops(spark, sf):
    k = F.col("idx") % 3
    c = turns(spark, sf).select(F.split_part("text", F.lit(" "), F.lit(1)).alias("text"), F.when(k == 0, "unknown").when(k == 1, "mismatch").otherwise("exact").alias("status"), "file", "idx")
    return summary.verdict_tops(c)


@query("""SELECT '3' AS layer, '' AS ep, '' AS time, p_name AS original, coalesce(c, '') AS corrected, '⬜' AS status FROM (SELECT p_name, CASE WHEN min(p_partkey) % 2 = 0 THEN upper(p_name) END AS c FROM part GROUP BY p_name)""")
def candidate_layer(spark, sf):
    p = table(spark, sf, "part").groupBy(F.col("p_name").alias("term")).agg(F.min("p_partkey").alias("k"))
    return summary.layer_of_candidates(p.select("term", F.when(F.col("k") % 2 == 0, F.upper("term")).alias("correction")))


@query(f"""WITH {TURNS}, g AS (SELECT file, count(*) FILTER (regexp_matches(text, '[a-zA-Z]{{2,}}') AND idx % 3 = 0) AS n FROM cues WHERE file % 4 > 0 GROUP BY file)
SELECT file, coalesce(n, 0) AS problem_count, coalesce(n, 0) = 0 AS is_clean FROM (SELECT DISTINCT file FROM cues) LEFT JOIN g USING (file)""")
def still_garbled(spark, sf):
    t = turns(spark, sf)
    c = t.filter("file % 4 > 0").withColumn("is_garbled", T.is_garbled(F.col("text")) & (F.col("idx") % 3 == 0))
    return review.still_garbled(t.select("file").distinct(), c)


# names of Japanese and Chinese lines

NAMED = ["御茶水博士が来た", "ああ山田先生", "おい アトム！", "アトムさん、コバルトくん", "これはウランという", "我叫小明", "喂、王明！", "「铁臂」来了", "王小姐你好", "我们老师"]


def dealt(spark: SparkSession, sf: str, lines: list[str]) -> DataFrame:
    """doc_id, k, t: the lines dealt over all documents."""
    k = (F.col("doc_id") % len(lines)).cast("int")
    return table(spark, sf, "documents").select("doc_id", k.alias("k"), F.get(F.array(*map(F.lit, lines)), k).alias("t"))


@query("""WITH e AS (SELECT * FROM (VALUES (0, 0, '御茶水博士', 'name_kanji_suffix', '御茶水'), (2, 3, 'アトム', 'calling', 'アトム'), (3, 0, 'アトムさん', 'name_katakana_suffix', 'アトム'), (3, 6, 'コバルトくん', 'name_katakana_suffix', 'コバルト'),
  (4, 0, 'これはウラン', 'introduction', 'これはウラン'), (5, 2, '小明', 'introduction', '小明'), (6, 2, '王明', 'calling', '王明'), (7, 1, '铁臂', 'quoted', '铁臂'), (8, 0, '王小姐', 'name_suffix', '王')) v(k, start, text, kind, name))
SELECT doc_id, start, e.text, kind, name FROM documents JOIN e ON doc_id % 10 = k""")
def name_rules(spark, sf):
    """The expected names of each line are written out; the rules themselves are tested against loops."""
    s = F.when(F.col("k") < 5, nouns.named_spans(F.col("t"), "ja")).otherwise(nouns.named_spans(F.col("t"), "zh"))
    return dealt(spark, sf, NAMED).select("doc_id", F.inline(s)).drop("len")


@query(f"""WITH {words_sql(ZH)}, t AS (SELECT term AS t, count(*) AS n FROM (SELECT term FROM w UNION ALL SELECT unnest(['12', '，。', '我们', '一']) FROM documents) GROUP BY term)
SELECT t, n, CASE WHEN regexp_full_match(t, '[，。！？、；：\"（）…—　 ]*') THEN 'empty/punctuation' WHEN regexp_full_match(t, '[0-9０-９]+') THEN 'pure number' WHEN length(t) = 1 THEN 'single char fragment'
  WHEN regexp_matches(t, '[A-Za-z]') AND regexp_matches(t, '[一-鿿]') THEN 'bilingual fragment' WHEN t IN {in_any(nouns.STOP_ZH)} THEN 'stop word' WHEN length(t) > 6 THEN 'sentence fragment (>6 chars)'
  WHEN regexp_matches(t, '^[{nouns.PARTICLES_ZH}]|[{nouns.PARTICLES_ZH}]$') THEN 'starts/ends with particle' END AS reason FROM t""")
def glossary_zh(spark, sf):
    fixed = table(spark, sf, "documents").select(F.explode(F.array(*map(F.lit, ["12", "，。", "我们", "一"]))).alias("t"))
    t = words(spark, sf, ZH).select(F.col("term").alias("t")).union(fixed).groupBy("t").agg(F.count("*").alias("n"))
    return t.select("t", "n", nouns.glossary_reject_reason_zh(F.col("t")).alias("reason"))


@query()
def replaced_runs(spark, sf):
    """Runs of alike turns: a third get nothing new, a third one cue, a third two that are alike again."""
    t = turns(spark, sf).select("file", "idx", "start_ms", "end_ms", "text")
    runs = similarity.similar_runs(t, ["file"])
    n = F.col("file") % 3
    new = runs.filter(n > 0).select("file", "run", F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("at")).select("file", "run", F.col("at").cast("long").alias("start_ms"), F.col("at").cast("long").alias("end_ms"), F.lit("heard anew").alias("text"))
    return similarity.replace_runs(t, runs, new, ["file"]).select("file", "idx", "text")


# fixes


@query(f"""WITH {TURNS}, f AS (SELECT file * 100 + idx AS seq, file, CASE WHEN idx % 5 = 4 THEN 999 ELSE start_ms END AS start_ms, CASE WHEN idx % 2 = 0 THEN 'replace_text' ELSE 'delete_line' END AS action, CASE WHEN idx % 4 = 0 THEN text ELSE 'new' END AS replacement FROM cues
  UNION ALL SELECT 1000000 + file, file, start_ms, 'replace_text', 'last' FROM cues WHERE idx = 0)
SELECT seq, CASE WHEN c.idx IS NULL THEN CASE WHEN action = 'replace_text' THEN 'missing' ELSE 'already' END WHEN lead(seq) OVER (PARTITION BY f.file, c.idx ORDER BY seq) IS NOT NULL THEN 'skipped' WHEN action = 'replace_text' AND replacement = c.text THEN 'already' ELSE 'applied' END AS outcome
FROM f LEFT JOIN cues c ON f.file = c.file AND f.start_ms = c.start_ms""")
def fix_outcomes(spark, sf):
    t = turns(spark, sf).withColumn("start_line", F.col("idx") * 5)
    i = F.col("idx")
    f = t.select((F.col("file") * 100 + i).alias("seq"), "file", F.when(i % 5 == 4, 999).otherwise(F.col("start_ms")).alias("start_ms"), F.when(i % 2 == 0, "replace_text").otherwise("delete_line").alias("action"), F.when(i % 4 == 0, F.col("text")).otherwise("new").alias("replacement"))
    again = t.filter("idx = 0").select((1_000_000 + F.col("file")).alias("seq"), "file", "start_ms", F.lit("replace_text").alias("action"), F.lit("last").alias("replacement"))
    return fixes.outcomes(f.unionByName(again).withColumn("line", F.lit(None).cast("int")), t).select("seq", "outcome")


@query(f"""WITH {TURNS}, k AS (SELECT file, idx, CASE WHEN idx % 2 = 0 THEN text ELSE 'other' END AS text FROM cues WHERE file % 2 = 0) SELECT c.file, c.idx, CASE WHEN k.text IS NULL THEN c.text ELSE 'known' END AS text, k.text IS NOT NULL AS replaced FROM cues c LEFT JOIN k USING (file, idx, text)""")
def pre_replaced(spark, sf):
    t = turns(spark, sf).select("file", "idx", "text")
    known = t.filter("file % 2 = 0").withColumn("text", F.when(F.col("idx") % 2 == 0, F.col("text")).otherwise("other")).withColumn("replacement", F.lit("known"))
    return fixes.pre_replace(t, known)


@query(f"""WITH {TURNS} SELECT file, idx, CASE WHEN idx IN (1, 2) AND file % 3 > 0 THEN 'second' ELSE text END AS text FROM cues""")
def corrected_by_index(spark, sf):
    t = turns(spark, sf).select("file", "idx", "text")
    f = t.filter("idx in (1, 2)").withColumnRenamed("text", "original")
    first, second = f.withColumn("seq", F.lit(1)).withColumn("replacement", F.lit("first")), f.withColumn("seq", F.lit(2)).withColumn("replacement", F.lit("second"))
    return fixes.by_index(t, first.unionByName(second.withColumn("original", F.when(F.col("file") % 3 > 0, F.col("original")).otherwise("stale"))))


@query(f"""WITH {TURNS} SELECT file, idx, CASE WHEN idx % 3 = 0 THEN CASE WHEN file % 2 = 0 THEN 'la la' ELSE ' ' END ELSE text END AS text FROM cues""")
def filled_blanks(spark, sf):
    t = turns(spark, sf).select("file", "idx", F.when(F.col("idx") % 3 == 0, " ").otherwise(F.col("text")).alias("text"))
    return fixes.fill_blank(t, t.filter("file % 2 = 0").select("file", "idx", F.lit("la la").alias("dst")))


@query(f"""WITH {TURNS} SELECT file, max(n) AS n, CASE WHEN max(n) > 3 OR max(u) > 3 THEN 2 ELSE 1 END AS tier FROM (SELECT file, count(*) OVER (PARTITION BY file) AS n, count(*) FILTER (role = 'user') OVER (PARTITION BY file) AS u FROM cues) GROUP BY file""")
def whisper_tier(spark, sf):
    t = turns(spark, sf).groupBy("file").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "user").alias("u"))
    return t.select("file", "n", review.tier(F.col("n"), F.col("u"), 3).alias("tier"))


@query(f"""WITH {TURNS} SELECT file, idx, CASE idx % 3 WHEN 0 THEN substr('ref ' || text, 1, 200) WHEN 1 THEN '[???]' ELSE text END AS text FROM cues""")
def adopted_reference(spark, sf):
    k = F.col("idx") % 3
    t = turns(spark, sf).withColumn("r_text", F.concat(F.lit("ref "), F.col("text"))).withColumn("verdict", F.when(k == 0, "mismatch").when(k == 1, "suspicious").otherwise("match"))
    return review.adopt_reference(t).select("file", "idx", "text")


@query("""SELECT user_id, start_ms FROM (SELECT user_id, event_id % 50 AS start_ms, row_number() OVER (PARTITION BY user_id, event_id % 50 ORDER BY event_id) AS k FROM events) WHERE k = 1""")
def cleared_once(spark, sf):
    return setops.first_wins(table(spark, sf, "events").withColumn("start_ms", F.col("event_id") % 50), ["user_id", "start_ms"], ["event_id"]).select("user_id", "start_ms")


@query("""SELECT file, line, style, CASE WHEN name = 'The' THEN 'Die' ELSE name END AS name FROM (SELECT conv_id AS file, turn AS line, role AS style, split_part(text, ' ', 1) AS name, text FROM conversations) WHERE style <> 'user'""")
def styled_edits(spark, sf):
    names = spark.createDataFrame([("The", "Die")], "src string, dst string")
    return styled.replace_names(styled.delete_style(styled_lines(spark, sf), "user"), names).select("file", "line", "style", "name")


@query(f"""WITH {REPORT}, a AS (SELECT layer, ep, time, original, corrected, CASE WHEN ep = 'EP3' AND time = '3' THEN '✅' ELSE status END AS status FROM old WHERE NOT (ep = 'EP4' AND time = '4'))
SELECT * FROM a WHERE layer <> '2' UNION ALL SELECT * FROM new WHERE layer = '2'""")
def report_edits(spark, sf):
    old, new = report_tables(spark, sf)
    key = lambda n: old.filter(F.col("time") == str(n)).select(report.entry_key(F.col("ep"), F.col("time"), F.col("original"))).first()
    r = report.set_status(old, "3", key(3)[0], "✅") if key(3) else old
    r = report.delete_entry(r, "3", key(4)[0]) if key(4) else r
    return report.replace_layer(r, "2", new.filter("layer = '2'")).select("layer", "ep", "time", "original", "corrected", "status")


# files and formats


@query("""SELECT file, count(*) AS n, md5(string_agg(CAST(start_ms AS VARCHAR) || '-' || CAST(end_ms AS VARCHAR) || ':' || text, chr(10) ORDER BY idx)) AS digest FROM
  (SELECT CAST(conv_id AS VARCHAR) || '.srt' AS file, turn AS idx, 6000 * turn AS start_ms, 6000 * turn + least(5500, greatest(500, 50 * length(text))) AS end_ms,
    trim(regexp_replace(regexp_replace(text, '[\\s]+', ' ', 'g'), '^ | $', '', 'g')) AS text FROM conversations) WHERE text <> '' GROUP BY file""")
def srt_roundtrip(spark, sf):
    """Cues written as SRT text and read back."""
    t = turns(spark, sf).withColumn("file", F.concat(F.col("file").cast("string"), F.lit(".srt"))).withColumn("text", F.trim(F.regexp_replace("text", "\\s+", " "))).filter("text != ''")
    back = subtitles.parse_srt(subtitles.render_srt(t))
    one = F.concat(F.col("start_ms").cast("string"), F.lit("-"), F.col("end_ms").cast("string"), F.lit(":"), F.col("text"))
    return back.groupBy("file").agg(F.count("*").alias("n"), F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", one.alias("v")))), lambda x: x["v"]), "\n")).alias("digest"))


ASS_LINE = "Dialogue: 0,0:0:%02d.00,0:0:%02d.50,%s,%s,0,0,0,,{\\i1}%s<b>x</b>"


@query("""SELECT CAST(conv_id AS VARCHAR) || '.ass' AS file, turn AS idx, turn * 1000 AS start_ms, turn * 1000 + 500 AS end_ms, md5('{\\i1}' || w || 'x') AS plain, md5(w || 'x') AS legacy FROM (SELECT *, regexp_replace(split_part(text, ' ', 1), '[^A-Za-z]', '', 'g') AS w FROM conversations)""")
def ass_lines(spark, sf):
    """Dialogue lines of ASS files, in the plain and in the older reading."""
    word = F.regexp_replace(F.split_part("text", F.lit(" "), F.lit(1)), "[^A-Za-z]", "")
    line = F.format_string(ASS_LINE, F.col("idx").cast("int"), F.col("idx").cast("int"), F.col("role"), F.lit("n"), word)
    f = turns(spark, sf).groupBy(F.concat(F.col("file").cast("string"), F.lit(".ass")).alias("file")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", line.alias("v")))), lambda x: x["v"]), "\n").alias("content"))
    parsed = subtitles.parse_ass(f)
    legacy = subtitles.ass_cues(parsed, legacy=True).select("file", "start_line", F.md5("text").alias("legacy"))
    new = subtitles.ass_cues(parsed).join(legacy, ["file", "start_line"], "left")
    return new.select("file", F.col("start_line").cast("long").alias("idx"), "start_ms", "end_ms", F.md5("text").alias("plain"), "legacy")


@query("""SELECT source AS file, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) + 2 AS INTEGER) AS line, 'Terms' AS section, CAST(doc_id AS VARCHAR) || '/' || lang || '/' || CAST(n_chars AS VARCHAR) AS cells FROM documents""")
def markdown_tables(spark, sf):
    """A Markdown table a source, read back."""
    d = table(spark, sf, "documents")
    row = F.concat_ws(" | ", F.lit("").cast("string"), F.col("doc_id").cast("string"), "lang", F.col("n_chars").cast("string"), F.lit(""))
    n = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    rows = d.select(F.col("source").alias("file"), (n + 2).alias("line"), F.trim(row).alias("s"))
    heads = d.select(F.col("source").alias("file")).distinct().withColumn("_h", F.explode(F.array(*[F.struct(F.lit(i).alias("line"), F.lit(s).alias("s")) for i, s in enumerate(["## Terms", "| id | lang | n |", "|---|:-:|--|"])])))
    lines = rows.unionByName(heads.select("file", "_h.line", "_h.s"))
    return tables.markdown_rows(lines).select("file", "line", "section", F.array_join("cells", "/").alias("cells"))


@query("""SELECT CAST(user_id AS VARCHAR) AS ep, event_id AS id, event_id * 10 AS start_ms, event_id * 10 + 250 AS end_ms, 'said ' || CAST(event_id AS VARCHAR) AS text, CASE WHEN event_id % 3 = 1 THEN 0.5 ELSE -1.0 END::DOUBLE AS no_speech_prob FROM events""")
def recogniser_json(spark, sf):
    """Segments from the three shapes of recogniser output, one a row."""
    e, i = table(spark, sf, "events"), F.col("event_id")
    said = F.concat(F.lit(' said '), i.cast("string"))
    offsets = F.to_json(F.struct(F.array(F.struct(F.struct((i * 10).alias("from"), (i * 10 + 250).alias("to")).alias("offsets"), said.alias("text"))).alias("transcription")))
    seconds = F.to_json(F.struct(F.array(F.struct((i / 100.0).alias("start"), (i / 100.0 + 0.25).alias("end"), said.alias("text"), F.lit(0.5).alias("no_speech_prob"))).alias("segments")))
    strings = F.to_json(F.struct(F.array(F.struct((i / 100.0).cast("decimal(20,3)").cast("string").alias("start"), (i / 100.0 + 0.25).cast("decimal(20,3)").cast("string").alias("end"), said.alias("text"))).alias("result")))
    raw = e.select(F.col("user_id").cast("string").alias("ep"), i.alias("id"), F.when(i % 3 == 0, offsets).when(i % 3 == 1, seconds).otherwise(strings).alias("value"))
    s = tables.asr_segments(raw)
    return s.select("ep", F.regexp_extract("text", "(\\d+)", 1).cast("long").alias("id"), "start_ms", "end_ms", "text", "no_speech_prob")


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN lang END AS status, CASE WHEN doc_id % 7 > 0 THEN CAST(doc_id AS VARCHAR) ELSE 'x' END AS n FROM documents)
SELECT doc_id, 'status' AS column, 'required' AS rule FROM d WHERE status IS NULL UNION ALL SELECT doc_id, 'status', 'enum' FROM d WHERE status NOT IN ('en', 'de') UNION ALL SELECT doc_id, 'n', 'type int' FROM d WHERE n = 'x'""")
def contract_violations(spark, sf):
    i = F.col("doc_id")
    d = table(spark, sf, "documents").select("doc_id", F.when(i % 5 > 0, F.col("lang")).alias("status"), F.when(i % 7 > 0, i.cast("string")).otherwise("x").alias("n"))
    v = tables.violations(d, {"status": "string", "n": "int"}, {"status": ["en", "de"]})
    return v.select(F.get_json_object("row", "$.doc_id").cast("long").alias("doc_id"), "column", "rule")


@query("""SELECT 'EP0' || CAST(k AS VARCHAR) AS ep, 'show EP0' || CAST(k AS VARCHAR) || '.srt' AS target, 'orig EP0' || CAST(k AS VARCHAR) || ' b.srt' AS source FROM (SELECT DISTINCT conv_id % 90 + 10 AS k FROM conversations) WHERE k % 2 = 0""")
def episode_join(spark, sf):
    k = table(spark, sf, "conversations").select((F.col("conv_id") % 90 + 10).alias("k")).distinct()
    name = lambda a, b: F.concat(F.lit(a), F.col("k").cast("string"), F.lit(b)).alias("file")
    even = k.filter("k % 2 = 0")
    joined = files.by_episode(k.select(name("show EP0", ".srt")), even.select(name("orig EP0", " a.srt")).unionByName(even.select(name("orig EP0", " b.srt"))))
    return joined.select("ep", F.col("file").alias("target"), F.col("r_file").alias("source"))


#: A nested contract: entries with a place that is text or null, a status of a list, and nothing else.
CONTRACT = {
    "type": "object", "required": ["id", "entries"], "additionalProperties": False,
    "properties": {"id": {"type": "integer"}, "entries": {"type": "array", "items": {"$ref": "#/$defs/entry"}}},
    "$defs": {"entry": {"type": "object", "required": ["status"], "properties": {"place": {"type": ["string", "null"]}, "status": {"enum": ["done", "open"]}}}},
}


@query("""WITH d AS (SELECT doc_id AS id FROM documents)
SELECT id, '$.entries[0].status' AS path, 'enum' AS rule FROM d WHERE id % 3 = 0 UNION ALL SELECT id, '$.entries[1].place', 'type' FROM d WHERE id % 4 = 0 UNION ALL SELECT id, '$.entries[1].status', 'required' FROM d WHERE id % 5 = 0
UNION ALL SELECT id, '$.more', 'additional' FROM d WHERE id % 7 = 0""")
def nested_contract(spark, sf):
    i = F.col("doc_id")
    one = F.concat(F.lit('{"place": null, "status": "'), F.when(i % 3 == 0, "odd").otherwise("done"), F.lit('"}'))
    two = F.concat(F.lit('{"place": '), F.when(i % 4 == 0, "7").otherwise('"x"'), F.when(i % 5 == 0, "").otherwise(', "status": "open"'), F.lit("}"))
    value = F.concat(F.lit('{"id": '), i.cast("string"), F.lit(', "entries": ['), one, F.lit(", "), two, F.lit("]"), F.when(i % 7 == 0, ', "more": 1').otherwise(""), F.lit("}"))
    return tables.schema_violations(table(spark, sf, "documents").select(i.alias("id"), value.alias("value")), "value", CONTRACT).select("id", "path", "rule")


@query("""SELECT CASE WHEN page_id % 3 = 0 THEN 'ass' WHEN page_id % 3 = 1 THEN 'srt' END AS by_content, count(*) AS n FROM pages GROUP BY 1""")
def format_by_content(spark, sf):
    k = F.col("page_id") % 3
    content = F.when(k == 0, F.concat(F.lit("[Script Info]\r\n"), F.lit("x"))).when(k == 1, F.lit("1\n00:00:01,000 --> 00:00:02,000\nx")).otherwise(F.lit("plain"))
    return subtitles.format_by_content(table(spark, sf, "pages").select(content.alias("content"))).groupBy("by_content").agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT page_id % 5 > 0 AS srt FROM pages) SELECT count(*) FILTER (srt) AS n_srt, count(*) FILTER (NOT srt) AS n_ass, CASE WHEN bool_and(srt) THEN 'srt' WHEN NOT bool_or(srt) THEN 'ass' ELSE 'mixed' END AS primary FROM f""")
def format_counts(spark, sf):
    return subtitles.formats(table(spark, sf, "pages").select(F.when(F.col("page_id") % 5 > 0, "srt").otherwise("ass").alias("format")))


@query("""SELECT doc_id, 'a' || CAST(doc_id AS VARCHAR) AS first, CASE WHEN doc_id % 4 = 3 THEN 1 ELSE 2 END AS n FROM documents""")
def model_answers(spark, sf):
    """Lists in answers that are fenced, have a comma too many, or are cut off."""
    i = F.col("doc_id")
    a = F.concat(F.lit('["a'), i.cast("string"), F.lit('", "b'))
    answer = F.when(i % 4 == 0, F.concat(F.lit("```json\n"), a, F.lit('"]\n```'))).when(i % 4 == 1, F.concat(a, F.lit('",]'))).when(i % 4 == 2, F.concat(F.lit("Here: "), a, F.lit('"]'))).otherwise(a)
    d = table(spark, sf, "documents").select("doc_id", tables.answers(answer).alias("a"))
    return d.select("doc_id", F.col("a")[0].alias("first"), F.size("a").alias("n"))

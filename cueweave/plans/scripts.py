"""Queries over the tables' own texts carried into other scripts.

The test tables are in Latin script. `carried` puts a letter of the script in the place of every small Latin letter, the same in
Spark and in SQL, so that whole texts of all rows flow through the rules for Japanese and Chinese. Letters are chosen so that
words have the endings, titles and marks that rules look for; capitals and accents stay and make mixed words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueweave.functions import lexicon as lex
from cueweave.functions import text as T
from cueweave.operators import nouns, report, review, segmentation, summary, verdicts
from cueweave.plans.catalogue import TIMELINE, corpus, cues, query, table, timeline

LETTERS = "abcdefghijklmnopqrstuvwxyz"
KATAKANA = "アバツヒンフガハイジカラマーオパキリストウヴワョヤズ"
HIRAGANA = "あばつひんふがはいじからまなおぱきりすとうぶわもやず"
KANJI = "行市号田今全時長井僕国村大山川君駅士前来店立林番野水"
MIXED = "ア市さ様んフガ号イ僕カラ村ー川前君リ今ト全ッワョヤ時"
HANZI = "的小山田他明国王一我可里木安海平全士是天大中文心月水"
CYRILLIC = "абцдефгхийклмнопярстувшщыз"

BY_LANG = {"en": KATAKANA, "de": KANJI, "fr": MIXED, "es": HIRAGANA}


def carried_sql(c: str, by: str, scripts: dict[str, str]) -> str:
    return f"CASE {by} " + " ".join(f"WHEN '{k}' THEN translate({c}, '{LETTERS}', '{v}')" for k, v in scripts.items()) + f" ELSE {c} END"


def carried(c: Column, by: Column, scripts: dict[str, str]) -> Column:
    out = None
    for k, v in scripts.items():
        out = (F if out is None else out).when(by == k, F.translate(c, LETTERS, v))
    return out.otherwise(c)


#: words of a carried text
SEP = "[^ \\n\\t\\r.,]+"


def words(spark: SparkSession, sf: str, scripts: dict[str, str]) -> DataFrame:
    """ep, idx, term: all words of all documents in the script of their language."""
    d = table(spark, sf, "documents").select(F.col("source").alias("ep"), F.col("doc_id").alias("idx"), carried(F.col("text"), F.col("lang"), scripts).alias("text"))
    return d.select("ep", "idx", F.explode(F.regexp_extract_all("text", F.lit(SEP), F.lit(0))).alias("term"))


def words_sql(scripts: dict[str, str]) -> str:
    return f"w AS (SELECT source AS ep, doc_id AS idx, unnest(regexp_extract_all({carried_sql('text', 'lang', scripts)}, '{SEP}')) AS term FROM documents)"


def listed(spark: SparkSession, sf: str, script: str) -> DataFrame:
    """term: the words of every other benchmark item in a script, as a list of common words."""
    b = table(spark, sf, "benchmark").filter("item_id % 2 = 0")
    return b.select(F.explode(F.regexp_extract_all(F.translate("text", LETTERS, script), F.lit(SEP), F.lit(0))).alias("term"))


def listed_sql(*scripts: str) -> str:
    parts = " UNION ".join(f"SELECT unnest(regexp_extract_all(translate(text, '{LETTERS}', '{s}'), '{SEP}')) AS term FROM benchmark WHERE item_id % 2 = 0" for s in scripts)
    return f"k AS (SELECT DISTINCT term FROM ({parts}))"


def in_any(values: list[str]) -> str:
    return "('" + "', '".join(values) + "')"


SAME = "(length(term) >= 3 AND replace(term, substr(term, 1, 1), '') = '')"


def non_word_sql(lang: str) -> str:
    sounds, least = verdicts.SOUNDS[lang]
    return f"(regexp_matches(term, '^[{verdicts.DASHES[lang]}]{{2,}}$') OR {SAME} OR regexp_matches(term, '^({sounds}){{{least},}}$'))"


SOUND = (
    "(regexp_matches(term, '^[ア-ヾ]{1,3}[ッっ]$|^[ア-ヾ]{1,3}ー[ッツ]$|^[ア-ヾ]{2,3}ーン$|^[ア-ヾ]{2,3}ョン$') OR (regexp_matches(term, '^[ア-ヾ]{4,}$') AND (term = repeat(substr(term, 1, 2), length(term) // 2) AND length(term) % 2 = 0"
    " OR length(term) % 2 = 1 AND length(term) >= 5 AND term = repeat(substr(term, 1, 2), length(term) // 2) || 'ン')))"
)


# F16: verdicts on candidates

VERDICT_JA = f"""CASE WHEN {non_word_sql("ja")} THEN 'REJECT non-word' WHEN length(term) = 1 AND n_eps = 1 THEN 'REJECT lone character' WHEN regexp_matches(term, '^[ぁ-ゟ]+$') THEN 'REJECT hiragana' WHEN regexp_matches(term, '^[a-zA-Z\\s]+$') THEN 'REJECT latin'
  WHEN common THEN 'REJECT common word' WHEN shown AND regexp_matches(term, '(さん|くん|ちゃん|様|殿|博士|警部|殿下|先生|総統|団長|伯爵|署長|所長|船長|部長|社長)$') THEN 'ACCEPT title' WHEN introduced THEN 'ACCEPT introduced'
  WHEN regexp_matches(term, '[゠-ヿ]') AND n_eps >= 2 THEN 'ACCEPT katakana in episodes' WHEN regexp_matches(term, '^[一-鿿]{{2,4}}$') AND n_eps >= 2 THEN 'ACCEPT kanji in episodes' ELSE 'NEEDS_AI unclear' END"""


def split_verdict(df: DataFrame, verdict: Column) -> DataFrame:
    return df.withColumn("v", verdict).select("*", "v.verdict", "v.reason").drop("v")


@query(f"""WITH {words_sql(BY_LANG)}, {listed_sql(KATAKANA, KANJI)}, c AS (SELECT term, count(DISTINCT ep) AS n_eps FROM w GROUP BY term),
v AS (SELECT term, n_eps, {VERDICT_JA.replace("shown AND", "false AND").replace("WHEN introduced", "WHEN false")} AS v FROM (SELECT c.*, k.term IS NOT NULL AS common FROM c LEFT JOIN k USING (term)))
SELECT term, n_eps, split_part(v, ' ', 1) AS verdict, substr(v, strpos(v, ' ') + 1) AS reason FROM v""")
def candidate_verdicts_ja(spark, sf):
    c = words(spark, sf, BY_LANG).groupBy("term").agg(F.countDistinct("ep").alias("n_eps"))
    c = verdicts.flagged(c, listed(spark, sf, KATAKANA).union(listed(spark, sf, KANJI)), "term", "common")
    return split_verdict(c, verdicts.candidate_verdict(F.col("term"), F.lit(None).cast("string"), F.col("n_eps"), F.col("common"))).drop("common")


TURN_SCRIPTS = {"user": KATAKANA, "assistant": MIXED}
TURN = f"(CASE WHEN turn % 2 = 0 THEN regexp_replace({carried_sql('text', 'role', TURN_SCRIPTS)}, '[.]$', '') || 'という' ELSE {carried_sql('text', 'role', TURN_SCRIPTS)} END)"


@query(f"""WITH x AS (SELECT conv_id, turn, {TURN} AS text FROM conversations), w AS (SELECT conv_id, turn, text, unnest(regexp_extract_all(regexp_replace(text, 'という$', ''), '{SEP}')) AS term FROM x),
c AS (SELECT term, count(DISTINCT conv_id) AS n_eps, arg_min(text, (conv_id, turn)) AS cue FROM w GROUP BY term), {listed_sql(KATAKANA)},
v AS (SELECT term, n_eps, {VERDICT_JA} AS v FROM (SELECT c.*, k.term IS NOT NULL AS common, cue <> '' AS shown, regexp_matches(cue, regexp_escape(c.term) || '({verdicts.INTRODUCES})') AS introduced FROM c LEFT JOIN k USING (term)))
SELECT term, n_eps, split_part(v, ' ', 1) AS verdict, substr(v, strpos(v, ' ') + 1) AS reason FROM v""")
def candidate_verdicts_in_context(spark, sf):
    t = carried(F.col("text"), F.col("role"), TURN_SCRIPTS)
    x = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.concat(F.regexp_replace(t, "[.]$", ""), F.lit("という"))).otherwise(t).alias("text"))
    w = x.select("conv_id", "turn", F.explode(F.array_distinct(F.regexp_extract_all(F.regexp_replace("text", "という$", ""), F.lit(SEP), F.lit(0)))).alias("term"))
    c = w.groupBy("term").agg(F.countDistinct("conv_id").alias("n_eps"), F.min(F.struct("conv_id", "turn")).alias("p"))
    c = c.select("term", "n_eps", "p.*").join(x, ["conv_id", "turn"])  # only the first cue of each word travels
    c = verdicts.flagged(c, listed(spark, sf, KATAKANA), "term", "common")
    return split_verdict(c, verdicts.candidate_verdict(F.col("term"), F.col("text"), F.col("n_eps"), F.col("common"))).select("term", "n_eps", "verdict", "reason")


ZH = dict.fromkeys(("en", "de", "fr"), HANZI) | {"es": HIRAGANA}


@query(f"""WITH {words_sql(ZH)}, {listed_sql(HANZI)}, c AS (SELECT term, count(DISTINCT ep) AS n_eps FROM w GROUP BY term),
v AS (SELECT term, n_eps, CASE WHEN {non_word_sql("zh")} THEN 'REJECT non-word' WHEN length(term) = 1 AND n_eps = 1 THEN 'REJECT lone character' WHEN k.term IS NOT NULL THEN 'REJECT common word' WHEN regexp_matches(c.term, '^[ぁ-ヿ]+$') THEN 'REJECT kana'
  WHEN regexp_matches(c.term, '^[一-鿿]{{2,4}}$') AND n_eps >= 2 THEN 'ACCEPT hanzi in episodes' WHEN regexp_matches(c.term, '^[一-鿿]$') THEN 'NEEDS_AI single hanzi' ELSE 'NEEDS_AI unclear' END AS v FROM c LEFT JOIN k USING (term))
SELECT term, n_eps, split_part(v, ' ', 1) AS verdict, substr(v, strpos(v, ' ') + 1) AS reason FROM v""")
def candidate_verdicts_zh(spark, sf):
    c = words(spark, sf, ZH).groupBy("term").agg(F.countDistinct("ep").alias("n_eps"))
    c = verdicts.flagged(c, listed(spark, sf, HANZI), "term", "common")
    return split_verdict(c, verdicts.candidate_verdict(F.col("term"), F.lit(None).cast("string"), F.col("n_eps"), F.col("common"), "zh")).drop("common")


EN = "[A-Z][a-z]+ [A-Z][a-z]+|[A-Za-z]+|[-]{2,}"


@query(f"""WITH w AS (SELECT source AS ep, unnest(regexp_extract_all(text, '{EN}')) AS term FROM documents), c AS (SELECT term, count(DISTINCT ep) AS n_eps FROM w GROUP BY term),
k AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS low FROM benchmark WHERE item_id % 2 = 0),
v AS (SELECT CASE WHEN {non_word_sql("en")} THEN 'REJECT non-word' WHEN length(term) = 1 AND n_eps = 1 THEN 'REJECT lone character' WHEN low IS NOT NULL THEN 'REJECT common word' WHEN regexp_matches(term, '^[A-Z][a-z]{{2,}}$') AND n_eps >= 2 THEN 'ACCEPT capitalised in episodes'
  WHEN regexp_matches(term, '^[A-Z][a-z]{{2,}}$') THEN 'NEEDS_AI capitalised once' WHEN regexp_matches(term, '^[A-Z][a-z]+ [A-Z][a-z]+$') THEN 'ACCEPT full name' ELSE 'NEEDS_AI unclear' END AS v FROM c LEFT JOIN k ON lower(term) = low)
SELECT split_part(v, ' ', 1) AS verdict, substr(v, strpos(v, ' ') + 1) AS reason, count(*) AS n FROM v GROUP BY v""")
def candidate_verdicts(spark, sf):
    c = corpus(spark, sf).select("ep", F.explode(F.regexp_extract_all("text", F.lit(EN), F.lit(0))).alias("term")).groupBy("term").agg(F.countDistinct("ep").alias("n_eps"))
    low = table(spark, sf, "benchmark").filter("item_id % 2 = 0").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w"))
    c = verdicts.flagged(c.withColumn("low", F.lower("term")), low.select(F.lower("w")), "low", "common")
    v = split_verdict(c, verdicts.candidate_verdict(F.col("term"), F.lit(None).cast("string"), F.col("n_eps"), F.col("common"), "en"))
    return v.groupBy("verdict", "reason").agg(F.count("*").alias("n"))


# F18, X11: cleaning of a glossary; F23, U6: what is appended to it

ENTRIES = f"{words_sql(BY_LANG)}, e AS (SELECT term, min(idx) AS seq, regexp_matches(term, '^[゠-ヿ]+$') AS katakana FROM w GROUP BY term)"


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """word, seq, katakana: all words, each with its first document, as entries of a glossary."""
    return words(spark, sf, BY_LANG).groupBy(F.col("term").alias("word")).agg(F.min("idx").alias("seq")).withColumn("katakana", F.col("word").rlike("^[゠-ヿ]+$"))


@query(f"""WITH {ENTRIES}, {listed_sql(KANJI, MIXED)}, v AS (SELECT term, seq, CASE WHEN term IN {in_any(verdicts.KNOWN_NAMES)} OR regexp_matches(term, '{verdicts.TITLE}|{verdicts.SURNAME}|({verdicts.PLACE_END}|{verdicts.VEHICLE_END})$') THEN 'name'
  WHEN katakana AND term IN {in_any(verdicts.KATAKANA_COMMON)} THEN 'common word' WHEN katakana AND {SOUND} THEN 'sound' WHEN katakana AND term IN {in_any(verdicts.KATAKANA_CRIES)} THEN 'cry' WHEN katakana AND regexp_matches(term, '^ー[ア-ヾ]') THEN 'fragment'
  WHEN katakana THEN NULL WHEN regexp_matches(term, '({verdicts.STEM_END})$') THEN 'verb stem' WHEN regexp_matches(term, '[今前後日時分秒年月何億万千]') AND length(term) <= 4 AND NOT regexp_matches(term, '{verdicts.SURNAME}') THEN 'time or number'
  WHEN regexp_matches(term, '^({verdicts.MODIFIER})') AND length(term) <= 4 THEN 'modifier' WHEN regexp_matches(term, '{verdicts.PRONOUN}') AND length(term) <= 4 THEN 'pronoun' END AS reason FROM e WHERE term NOT IN (SELECT term FROM k))
SELECT term AS word, seq, CASE WHEN reason IS NULL OR reason = 'name' THEN 'keep' ELSE 'reject' END AS verdict, reason FROM v""")
def reject_reasons(spark, sf):
    common = listed(spark, sf, KANJI).union(listed(spark, sf, MIXED))
    return verdicts.clean_glossary(entries(spark, sf), common).select("word", "seq", "verdict", "reason")


def append_sql(lang: str, rules: str) -> str:
    return f"""WITH {words_sql(BY_LANG)}, {listed_sql(KANJI)}, h AS (SELECT DISTINCT unnest(regexp_extract_all(translate(text, '{LETTERS}', '{MIXED}'), '{SEP}')) AS term FROM benchmark WHERE item_id % 2 = 1)
SELECT min(idx) AS seq, term AS name FROM w WHERE term NOT IN (SELECT term FROM h) AND NOT (length(term) < 2 OR term IN (SELECT term FROM k) OR {rules}) GROUP BY term"""


def appended(spark, sf, lang):
    there = table(spark, sf, "benchmark").filter("item_id % 2 = 1").select(F.explode(F.regexp_extract_all(F.translate("text", LETTERS, MIXED), F.lit(SEP), F.lit(0))).alias("name"))
    w = words(spark, sf, BY_LANG).select(F.col("idx").alias("seq"), F.col("term").alias("name"), F.lit(1).alias("n"))
    return verdicts.append_names(w, there, listed(spark, sf, KANJI), lang).select("seq", "name")


@query(append_sql("ja", f"{SOUND} OR regexp_matches(term, '^ー[ア-ヾ]')"))
def append_names_ja(spark, sf):
    return appended(spark, sf, "ja")


@query(append_sql("zh", "regexp_matches(term, '^[ぁ-ヿ]+$')"))
def append_names_zh(spark, sf):
    return appended(spark, sf, "zh")


@query(f"""WITH {words_sql(BY_LANG)}, {listed_sql(KANJI)}, t AS (SELECT term, count(*) AS n FROM w GROUP BY term)
SELECT zh, en, count(*) AS n_terms, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN length(term) < 2 THEN 'short' WHEN k.term IS NOT NULL THEN 'common word' WHEN regexp_matches(t.term, '^[ぁ-ヿ]+$') THEN 'kana' END AS zh,
  CASE WHEN length(term) < 2 THEN 'short' WHEN k.term IS NOT NULL THEN 'common word' WHEN NOT regexp_matches(t.term, '[a-zA-Z]') THEN 'no latin' END AS en, n FROM t LEFT JOIN k USING (term)) GROUP BY zh, en""")
def append_reasons(spark, sf):
    t = verdicts.flagged(words(spark, sf, BY_LANG).groupBy("term").agg(F.count("*").alias("n")), listed(spark, sf, KANJI), "term", "common")
    why = lambda lang: verdicts.append_reason(F.col("term"), F.col("common"), lang).alias(lang)
    return t.select(why("zh"), why("en"), "n").groupBy("zh", "en").agg(F.count("*").alias("n_terms"), F.sum("n").alias("n"))


# A6: the language of a file

NUMBER = "CAST(coalesce(nullif(regexp_extract(source, '[0-9]+'), ''), '0') AS INTEGER) % 5"
FILE_SCRIPT = {"0": MIXED, "1": CYRILLIC, "2": HANZI, "3": HIRAGANA}


@query(f"""WITH x AS (SELECT source, doc_id, {carried_sql('text', f'CAST({NUMBER} AS VARCHAR)', FILE_SCRIPT)} AS t FROM documents), h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM x) WHERE k <= 20),
c AS (SELECT source, sum(len(regexp_extract_all(t, '[぀-ヿ]'))) AS k, sum(len(regexp_extract_all(t, '[Ѐ-ӿ]'))) AS y, sum(len(regexp_extract_all(t, '[一-鿿]'))) AS h, sum(length(t)) AS a FROM h GROUP BY source)
SELECT source, CASE WHEN coalesce(a, 0) = 0 THEN 'other' WHEN k / a >= 0.05 THEN 'ja' WHEN y / a >= 0.05 THEN 'ru' WHEN h / a >= 0.3 THEN 'zh' ELSE 'other' END AS lang FROM c""")
def language_shares(spark, sf):
    n = F.expr("cast(cast(coalesce(nullif(regexp_extract(source, '[0-9]+', 0), ''), '0') as int) % 5 as string)")
    d = table(spark, sf, "documents").select("source", F.col("doc_id").alias("idx"), carried(F.col("text"), n, FILE_SCRIPT).alias("text"))
    return summary.language_by_share(d, ["source"])


# X7: what stands beside a cue, at any distance


@query(f"""WITH {TIMELINE}, c AS (SELECT * FROM cues WHERE is_garbled) SELECT c.idx, arg_max(n.idx, (n.start_ms, n.idx)) FILTER (n.start_ms < c.start_ms - 1000) AS before, arg_min(n.idx, (n.start_ms, n.idx)) FILTER (n.start_ms > c.start_ms + 1000) AS after
FROM c JOIN cues n ON c.ep = n.ep GROUP BY c.idx""")
def review_context(spark, sf):
    t = timeline(spark, sf)
    return review.beside(cues(t).filter("is_garbled"), cues(t), ["ep"]).select("idx", "before", "after")


# 2.12: words of scripts without spaces


@query()
def segmented_terms(spark, sf):
    """Words of all turns in Chinese script, whose lexicon is seeded and estimated from the turns themselves."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", F.translate("text", LETTERS, HANZI).alias("text"))
    lexicon = segmentation.estimate(t, segmentation.seed_lexicon(t, least=20), rounds=1)
    w = segmentation.segment(t, lexicon, ["conv_id", "turn"])
    return w.groupBy("term").agg(F.count("*").alias("freq"), F.countDistinct("conv_id").alias("n_eps"))


# U8: groups whose readings hold each other


@query()
def related_readings(spark, sf):
    """Words of all documents in katakana, grouped by the word without long marks; related groups join the first of them."""
    w = words(spark, sf, dict.fromkeys(BY_LANG, KATAKANA)).select("term", F.regexp_replace("term", "ー", "").alias("key")).filter("key rlike '^[゠-ヿ]+$'").distinct()
    return nouns.merge_related(w.groupBy("key").agg(F.sort_array(F.collect_set("term")).alias("words"))).select("key", F.size("words").alias("n_words"), F.md5(F.array_join("words", "|")).alias("digest"))


# J15: source words that a mapping speaks of, by reading or by what holds what

SYLLABLES = dict.fromkeys(BY_LANG, KATAKANA)


@query(f"""WITH {words_sql(SYLLABLES)}, t AS (SELECT DISTINCT term AS token, replace(term, 'ー', '') AS reading FROM w), v AS (SELECT * FROM t WHERE length(reading) >= 2),
b AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{LETTERS}', '{KATAKANA}'), '{SEP}')) AS term FROM benchmark), k AS (SELECT DISTINCT replace(term, 'ー', '') AS key FROM b WHERE item_id % 4 = 0), n AS (SELECT DISTINCT term FROM b WHERE item_id % 4 = 1)
SELECT token, reading FROM v WHERE reading IN (SELECT key FROM k) OR token IN (SELECT term FROM n) OR length(reading) >= 4 AND EXISTS (SELECT 1 FROM k WHERE length(key) >= 4 AND (contains(reading, key) OR contains(key, reading)))""")
def mapped_tokens(spark, sf):
    t = words(spark, sf, SYLLABLES).select(F.col("term").alias("token"), F.replace("term", F.lit("ー"), F.lit("")).alias("reading"))
    b = table(spark, sf, "benchmark").select("item_id", F.explode(F.regexp_extract_all(F.translate("text", LETTERS, KATAKANA), F.lit(SEP), F.lit(0))).alias("term"))
    keys = b.filter("item_id % 4 = 0").select(F.replace("term", F.lit("ー"), F.lit("")).alias("key"))
    return nouns.mapped_tokens(t, keys, b.filter("item_id % 4 = 1").select("term"))


@query(f"""WITH x AS (SELECT conv_id, turn, unnest(list_distinct(regexp_extract_all(translate(text, '{LETTERS}', '{HANZI}'), '{SEP}'))) AS token FROM conversations WHERE role = 'user'),
y AS (SELECT conv_id, turn - 1 AS turn, unnest(list_distinct(regexp_extract_all(translate(text, '{LETTERS}', '{KATAKANA}'), '{SEP}'))) AS surface FROM conversations WHERE role = 'assistant'), z AS (SELECT *, replace(surface, 'ー', '') AS reading FROM y)
SELECT reading, token, array_to_string(list_sort(list(DISTINCT surface)), '|') AS surfaces, count(*) AS n, min(conv_id * 100 + turn) AS first FROM x JOIN z USING (conv_id, turn) WHERE length(reading) <= 3 GROUP BY reading, token""")
def variants_by_source(spark, sf):
    """Words of a user's turn beside the short words of the answer in katakana, as a translation beside its source."""
    c = table(spark, sf, "conversations")
    said = lambda script: F.explode(F.array_distinct(F.regexp_extract_all(F.translate("text", LETTERS, script), F.lit(SEP), F.lit(0)))).alias("token")
    left = c.filter("role = 'user'").select("conv_id", F.col("turn").cast("long").alias("idx"), said(HANZI))
    right = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).cast("long").alias("idx"), said(KATAKANA))
    v = nouns.variants_by_source(left, right.withColumn("reading", F.replace("token", F.lit("ー"), F.lit(""))).filter(F.length("reading") <= 3), ["conv_id"])
    first = F.col("places")[0]
    return v.select("reading", "token", F.array_join("surfaces", "|").alias("surfaces"), "n", (first["conv_id"] * 100 + first["idx"]).alias("first"))


# C19: turns of phrase of translations

PHRASES = [(" the ", "进行了"), (" and ", "他的朋友"), (" of ", "对于你来说"), (" in ", "是否可以"), (" is ", "正在"), (" to ", "具有"), (" a ", "的重要性"), (" der ", "如何做"), (" de ", "迅速地"), (" la ", "非常地")]


def phrased_sql(c: str) -> str:
    for a, b in PHRASES:
        c = f"replace({c}, '{a}', '{b}')"
    return f"translate({c}, '{LETTERS}', '{HANZI}')"


def natural_sql() -> str:
    steps, t = [], phrased_sql("text")
    steps.append(f"n0 AS (SELECT doc_id, {t} AS t, 0 AS n FROM documents)")
    for k, (pattern, new) in enumerate(lex.NATURAL_ZH):
        to = new.replace("$1", "\\1")
        steps.append(f"n{k + 1} AS (SELECT doc_id, regexp_replace(t, '{pattern}', '{to}', 'g') AS t, n + len(regexp_extract_all(t, '{pattern}')) AS n FROM n{k})")
    return f"WITH {', '.join(steps)} SELECT doc_id, md5(t) AS digest, CAST(n AS BIGINT) AS n FROM n{len(lex.NATURAL_ZH)}"


@query(natural_sql())
def natural_lines(spark, sf):
    c = F.col("text")
    for a, b in PHRASES:
        c = F.replace(c, F.lit(a), F.lit(b))
    d = table(spark, sf, "documents").select("doc_id", F.translate(c, LETTERS, HANZI).alias("t"))
    return d.select("doc_id", T.natural_zh(F.col("t")).alias("x")).select("doc_id", F.md5("x.text").alias("digest"), F.col("x.n").cast("long").alias("n"))


# the chain that leads from frequencies to a glossary


def chain_sql(lang: str) -> str:
    known = "term IN (SELECT term FROM d)" if lang == "ja" else "term IN (SELECT term FROM d WHERE freq > 10)"
    katakana = "regexp_matches(term, '[゠-ヿ]') AND NOT regexp_matches(term, '[一-鿿]')" if lang == "ja" else "false"
    listed_too = "AND term NOT IN (SELECT term FROM k)" if lang == "ja" else ""
    return f"""WITH {words_sql(BY_LANG)}, {listed_sql(KANJI, KATAKANA)}, t AS (SELECT term, count(*) AS freq FROM w GROUP BY term HAVING count(*) >= 3),
b AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{LETTERS}', '{KANJI}'), '{SEP}')) AS term FROM benchmark), l AS (SELECT DISTINCT term FROM b WHERE item_id % 4 = 0), d AS (SELECT term, count(*) AS freq FROM b WHERE item_id % 2 = 1 GROUP BY term),
x AS (SELECT * FROM t WHERE NOT {non_word_sql(lang)} AND (term IN (SELECT term FROM l) OR NOT (term IN (SELECT term FROM k) OR {known})))
SELECT term, freq, kind FROM (SELECT *, CASE WHEN {katakana} THEN CASE WHEN length(term) >= 2 {listed_too} THEN 'katakana' END WHEN regexp_matches(term, '[一-鿿]') AND length(term) >= 2 {listed_too} THEN 'kanji' END AS kind FROM x) WHERE kind IS NOT NULL"""


def chained(spark, sf, lang):
    freqs = words(spark, sf, BY_LANG).groupBy("term").agg(F.count("*").alias("freq"))
    b = table(spark, sf, "benchmark").select("item_id", F.explode(F.regexp_extract_all(F.translate("text", LETTERS, KANJI), F.lit(SEP), F.lit(0))).alias("term"))
    dictionary = b.filter("item_id % 2 = 1").groupBy("term").agg(F.count("*").alias("freq"))
    common = listed(spark, sf, KANJI).union(listed(spark, sf, KATAKANA))
    return verdicts.glossary_terms(freqs, common, b.filter("item_id % 4 = 0").select("term"), dictionary, lang=lang)


@query(chain_sql("ja"))
def glossary_terms_ja(spark, sf):
    return chained(spark, sf, "ja")


@query(chain_sql("zh"))
def glossary_terms_zh(spark, sf):
    return chained(spark, sf, "zh")


# S14: kinds of foreign lines


@query(f"""WITH x AS (SELECT doc_id, {carried_sql('text', f'CAST({NUMBER} AS VARCHAR)', FILE_SCRIPT)} AS t FROM documents)
SELECT CASE WHEN regexp_matches(t, '[Ѐ-ӿ]') THEN 'cyrillic' WHEN regexp_matches(t, '[぀-ヿ]') THEN 'kana' WHEN regexp_matches(t, '[a-zA-Z]') AND regexp_matches(t, '[一-鿿]') THEN 'mixed' ELSE 'foreign' END AS kind, count(*) AS n FROM x GROUP BY 1""")
def foreign_kinds(spark, sf):
    n = F.expr("cast(cast(coalesce(nullif(regexp_extract(source, '[0-9]+', 0), ''), '0') as int) % 5 as string)")
    d = table(spark, sf, "documents").select(carried(F.col("text"), n, FILE_SCRIPT).alias("t"))
    return d.groupBy(report.foreign_kind(F.col("t")).alias("kind")).agg(F.count("*").alias("n"))

"""Terms and names: frequencies, suspects, spelling variants, candidates, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.functions import lexicon as lex
from cueweave.functions import text
from cueweave.operators.independent import containing, first_independent, parts, stored

#: runs that count as terms; they do not overlap
TERMS = {"en": ["(?U)\\b[A-Z][a-z]{2,}\\b"], "ja": ["[\\u30A0-\\u30FF]{2,6}", "[\\u4E00-\\u9FFF]{2,4}"], "zh": ["[\\u4E00-\\u9FFF]{2,4}"]}

# fixed values: what stands around names
NAME_CONTEXT = {
    "ja": {
        "honorific": "さん|くん|ちゃん|様|殿|博士", "calling": "おい|なあ|ねえ",
        "before": "俺は|私は|僕は|わしは|それが|こちらが|この方が|紹介する|紹介します",
        "after": "って言う|っていう|って呼ぶ|って呼ばれ|という|と言う|と呼ぶ|と呼ばれ|といいます|とは",
    },
    "zh": {
        "title": "先生|小姐|女士|老师|同学|博士|教授|局长|部长|社长|队长|团长|市长|县长|老板|总[统裁理监]|主席|书记|主任|经理|所长|处长|科长|警[官察长]|殿下|陛下",
        "intro": "叫|名叫|叫作|叫做|就是|那就是|这位是|我是|我叫|人称|被称为|大家都叫[我他她]",
        "possessive": "我的|你的|他的|她的|我们的|你们的|他们的|小|老|大|阿",
    },
}


def terms(c: Column, lang: str = "en") -> Column:
    """Array of the terms of a text."""
    return F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in TERMS.get(lang, TERMS["zh"])])


def term_frequencies(cues: DataFrame, lang: str = "en", least: int = 1) -> DataFrame:
    """term, freq of all terms; each map task sums its own rows before the shuffle."""
    return cues.select(F.explode(terms(F.col("text"), lang)).alias("term")).groupBy("term").agg(F.count("*").alias("freq")).filter(F.col("freq") >= least)


def grams(c: Column, lang: str = "zh", sizes: tuple[int, ...] = (2, 3)) -> Column:
    """Distinct character n-grams within runs of the language's script, for when no tokenizer is at hand."""
    runs = F.regexp_extract_all(c, F.lit(f"[{text.HAN}]+" if lang == "zh" else f"[{text.KATAKANA}{text.HAN}]+"), F.lit(0))

    def of_size(n: int) -> Column:
        cut = lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - (n - 1)), lambda i: F.substring(r, i, F.lit(n)))
        return F.flatten(F.transform(runs, lambda r: F.when(F.length(r) >= n, cut(r)).otherwise(F.array().cast("array<string>"))))

    every = [of_size(n) for n in sizes]
    return F.array_distinct(F.concat(*every))


def without(df: DataFrame, known: DataFrame, column: str = "term") -> DataFrame:
    """Rows whose term is in none of the known ones."""
    return df.join(known.select(F.col(known.columns[0]).alias(column)).distinct(), column, "left_anti")


def suspects(cues: DataFrame, lang: str = "en", min_eps: int = 2, min_count: int = 3, n_contexts: int = 5, by: str = "ep") -> DataFrame:
    """Terms with count, number of episodes and first contexts, if they are seen often enough in enough episodes."""
    th = F.xxhash64("text").alias("_th")
    rows = cues.select(by, "idx", th, F.explode(terms(F.col("text"), lang)).alias("term"))  # places travel, texts do not
    agg = rows.groupBy("term").agg(F.count("*").alias("n"), F.countDistinct(by).alias("n_eps")).filter((F.col("n") >= min_count) & (F.col("n_eps") >= min_eps))
    # Spark keeps a task's first rows of a term before it shuffles them, so a frequent term is no hot key
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("term").orderBy(by, "idx", "_th"))).filter(F.col("_n") <= n_contexts).join(agg.select("term"), "term", "left_semi")
    on = [by, "idx", "_th"]
    shown = cues.select(by, "idx", th, "text").join(first.select(*on).distinct(), on, "left_semi").dropDuplicates(on)
    placed = first.join(shown, on)
    contexts = placed.groupBy("term").agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", by, "text"))), lambda x: F.struct(x[by].alias(by), x["text"].alias("text"))).alias("contexts"))
    return agg.join(contexts, "term")


def variant_groups(freqs: DataFrame, key: Column | None = None) -> DataFrame:
    """Terms that share a key: canonical is the most frequent one, ties to the smallest; variants hold the others."""
    k = text.grouping_key(F.col("term")) if key is None else key
    grouped = freqs.withColumn("_key", k).groupBy("_key").agg(F.sort_array(F.collect_list(F.struct((-F.col("freq")).alias("f"), "term"))).alias("l"), F.sum("freq").alias("total_freq"))
    rest = F.transform(F.slice("l", F.lit(2), F.greatest(F.size("l") - 1, F.lit(0))), lambda x: F.struct(x["term"].alias("word"), (-x["f"]).alias("freq")))
    return grouped.select("_key", F.col("l")[0]["term"].alias("canonical"), "total_freq", rest.alias("variants"), F.size("l").alias("n_words")).withColumnRenamed("_key", "key")


def glossary(freqs: DataFrame, common: DataFrame, keep: DataFrame | None = None, least: int = 3) -> DataFrame:
    """Terms of `least` occurrences that are no common words, whitelisted ones aside, grouped by spelling and classed:
    character for five characters at most seen five times or more, else other."""
    often = freqs.filter(F.col("freq") >= least)
    unknown = without(often, common)
    rows = unknown if keep is None else unknown.unionByName(often.join(keep.select(F.col(keep.columns[0]).alias("term")), "term", "left_semi")).distinct()
    return variant_groups(rows).withColumn("category", F.when((F.length("canonical") <= 5) & (F.col("total_freq") >= 5), "character").otherwise("other"))


def name_context(c: Column, token: Column, lang: str = "ja") -> Column:
    """Why a text may treat the token as a name, by the first rule that holds, else null. ja: honorific_suffix (after the
    token), intro_before, intro_after (anywhere), calling (before it); zh, anywhere: title_suffix, intro_pattern, possessive;
    en: title before the token."""
    exact = F.concat(F.lit("\\Q"), token, F.lit("\\E"))
    if lang == "en":
        return F.when(F.regexp_like(c, F.concat(F.lit(f"(?i)\\b(?:{'|'.join(lex.HONORIFICS['en'])})\\.? "), exact)), "title")
    p = NAME_CONTEXT["zh" if lang == "zh" else "ja"]
    if lang == "zh":
        return F.when(c.rlike(p["title"]), "title_suffix").when(c.rlike(p["intro"]), "intro_pattern").when(c.rlike(p["possessive"]), "possessive")
    return (
        F.when(F.regexp_like(c, F.concat(exact, F.lit(f"(?U)\\s*(?:{p['honorific']})"))), "honorific_suffix").when(c.rlike(p["before"]), "intro_before")
        .when(c.rlike(p["after"]), "intro_after").when(F.regexp_like(c, F.concat(F.lit(f"(?U)(?:{p['calling']})\\s*"), exact)), "calling")
    )


def in_name_context(c: Column, token: Column, lang: str = "ja") -> Column:
    """The text treats the token, or somebody, as a name."""
    return name_context(c, token, lang).isNotNull()


def _folded(items: Column, empty: Column, at: Column, step) -> Column:
    """Array of what `step` keeps, in order: step(at, item) gives (keep, out, next at); empty is an empty array of outs.
    What is kept fills chunks that are joined at the end, so that a long array is not copied for each item."""
    size = 128

    def merge(a: Column, x: Column) -> Column:
        keep, out, after = step(a["at"], x)
        room = F.size(a["part"]) < size
        full, part = F.when(room, a["full"]).otherwise(F.array_append(a["full"], a["part"])), F.when(room, F.array_append(a["part"], out)).otherwise(F.array(out))
        return F.when(keep, F.struct(after.alias("at"), full.alias("full"), part.alias("part"))).otherwise(a)

    zero = F.struct(at.alias("at"), F.slice(F.array(empty), 1, 0).alias("full"), empty.alias("part"))
    return F.aggregate(items, zero, merge, lambda a: F.concat(F.flatten(a["full"]), a["part"]))


def _once(c: Column, f) -> Column:
    """f(c), with c evaluated once however often f names it."""
    return F.transform(F.array(c), f)[0]


def keep_disjoint(spans: Column) -> Column:
    """Of an array of spans (start, len, ...) those that overlap none kept before, in the order of start and then falling
    length; one fold inside the JVM. Starts rise, so the end of the last kept span decides."""
    in_order = lambda xs: F.array_sort(xs, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["len"] - a["len"]))
    return _once(spans, lambda xs: _folded(in_order(xs), F.slice(xs, 1, 0), F.lit(None).cast("int"), lambda end, s: (end.isNull() | (s["start"] >= end), s, (s["start"] + s["len"]).cast("int"))))


def candidate_spans(c: Column, lang: str = "en") -> Column:
    """Spans (start, len, text, kind) that look like names, without overlaps. Starts are found by cutting the text at each
    match and adding up the lengths, so that no position is lost to the array of matches."""
    patterns = {"en": [("full_name", "(?U)\\b[A-Z][a-z]+ [A-Z][a-z]+\\b"), ("name", "(?U)\\b[A-Z][a-z]{2,}\\b")], "ja": [("katakana", "[\\u30A0-\\u30FF]{2,}"), ("han", "[\\u4E00-\\u9FFF]{2,4}")], "zh": [("han", "[\\u4E00-\\u9FFF]{2,4}")]}

    def spans(kind: str, p: str) -> Column:
        def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
            start = at + F.length(x["before"])
            return F.lit(True), F.struct(start.alias("start"), F.length(x["hit"]).alias("len"), x["hit"].alias("text"), F.lit(kind).alias("kind")), start + F.length(x["hit"])

        hits, between = F.regexp_extract_all(c, F.lit(p), F.lit(0)), F.split(c, p)
        pairs = F.filter(F.arrays_zip(between.alias("before"), hits.alias("hit")), lambda x: x["hit"].isNotNull())  # after the last hit there is only text
        return _folded(pairs, F.array().cast("array<struct<start:int,len:int,text:string,kind:string>>"), F.lit(0), step)

    found = [spans(kind, p) for kind, p in patterns.get(lang, patterns["zh"])]
    return keep_disjoint(F.concat(*found))


def corrections(cues: DataFrame, pairs: DataFrame, lang: str = "en") -> DataFrame:
    """Cues that hold a wrong term: each hit with the term's corrections (pairs: term, correction)."""
    tokens = cues.select("*", F.explode(F.array_distinct(terms(F.col("text"), lang))).alias("term"))
    return tokens.join(pairs, "term")


def confirmed_corrections(cues: DataFrame, pairs: DataFrame, source: DataFrame, keys: list[str], lang: str = "en") -> DataFrame:
    """corrections with confirmed: the source cue of the same place (keys, idx) holds the correction, which has two characters
    at least. A cue without a source is not confirmed."""
    hits = corrections(cues, pairs, lang)
    src = source.select(*keys, "idx", F.col("text").alias("_src"))
    seen = (F.length("correction") >= 2) & F.coalesce(F.contains(F.col("_src"), F.col("correction")), F.lit(False))
    return hits.join(src, [*keys, "idx"], "left").withColumn("confirmed", seen).drop("_src")


def reading_groups(hits: DataFrame, most: int = 20) -> DataFrame:
    """Spellings under one reading: hits (reading, term, ep, idx) give one row a reading with two terms or more: n, n_terms, and
    terms, an array of (term, n, first places, up to `most`), the most common first."""
    placed = hits.withColumn("_n", F.row_number().over(Window.partitionBy("reading", "term").orderBy("ep", "idx")))
    per = placed.groupBy("reading", "term").agg(
        F.count("*").alias("n"), F.transform(F.sort_array(F.collect_list(F.when(F.col("_n") <= most, F.struct("_n", "ep", "idx")))), lambda x: F.struct(x["ep"].alias("ep"), x["idx"].alias("idx"))).alias("places")
    )
    out = per.groupBy("reading").agg(F.sum("n").alias("n"), F.count("*").alias("n_terms"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "term", "places"))).alias("_l"))
    return out.filter("n_terms > 1").select("reading", "n", "n_terms", F.transform("_l", lambda x: F.struct(x["term"].alias("term"), (-x["less"]).alias("n"), x["places"].alias("places"))).alias("terms"))


def most_frequent(freqs: DataFrame) -> DataFrame:
    """Terms once, with their greatest frequency."""
    return freqs.groupBy("term").agg(F.max("freq").alias("freq"))


def co_occurring(left: DataFrame, right: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Tokens side by side in aligned rows (keys, idx): pairs of a left and a known right token with their counts."""
    r = right.join(known.select(F.col(known.columns[0]).alias("token")), "token", "left_semi").select(*keys, "idx", F.col("token").alias("r_token"))
    return left.join(r, [*keys, "idx"]).groupBy("token", "r_token").agg(F.count("*").alias("n"), F.countDistinct(*keys).alias("n_eps"))


def mapped_tokens(tokens: DataFrame, keys: DataFrame, known: DataFrame, least: int = 4) -> DataFrame:
    """Distinct (token, reading) that a mapping speaks of: the reading (two characters at least) is one of its keys (first column), or the token is
    in known (first column), or reading and a key hold one another, both of `least` characters or more.

    What holds what is found by equi-joins on substrings: on those of the readings for keys inside them, on those of the keys for
    readings inside these. Neither list is compared with the other one whole, so a million keys are no cross join.
    """
    words = tokens.select("token", "reading").filter(F.length("reading") >= 2).distinct()
    k = keys.select(F.col(keys.columns[0]).alias("key")).filter("key is not null").distinct()
    long = words.filter(F.length("reading") >= least).select("reading").distinct()
    holding = parts(long, "reading", least).join(k.select(F.col("key").alias("b")), "b", "left_semi").select(F.col("a").alias("reading"))
    held = parts(k.filter(F.length("key") >= least), "key", least).select(F.col("b").alias("reading")).distinct().join(long, "reading", "left_semi")
    near = holding.union(held).union(k.select(F.col("key").alias("reading"))).distinct()
    listed = known.select(F.col(known.columns[0]).alias("token")).distinct()
    return words.join(near, "reading", "left_semi").select("token", "reading").union(words.join(listed, "token", "left_semi").select("token", "reading")).distinct()


def variants_by_source(left: DataFrame, right: DataFrame, keys: list[str], most: int = 20) -> DataFrame:
    """Suspects (left: keys, idx, token) by the reading of the mapped source token (right: keys, idx, token, reading) in the same aligned
    row: reading, surfaces, token, n and the first `most` places, one row a reading and suspect."""
    pairs = left.alias("l").join(right.withColumnRenamed("token", "surface"), [*keys, "idx"])
    spot = F.struct(*keys, "idx")
    placed = pairs.withColumn("_n", F.row_number().over(Window.partitionBy("reading", "token").orderBy(*keys, "idx", "surface")))
    return placed.groupBy("reading", "token").agg(
        F.array_sort(F.collect_set("surface")).alias("surfaces"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("_n") <= most, spot))).alias("places")
    )


def merge_related(groups: DataFrame, least: int = 2) -> DataFrame:
    """Groups (key, words) whose key holds the key of an earlier group that stays, or is held by it, join the first such group, in
    order of falling number of words, then key: key and words, each word once, the group's own first. Keys under `least` characters are
    related to none; null keys go, of equal keys the words pool. Related keys are found by an equi-join on substrings, and
    who stays is settled in rounds, so no task sees all groups."""
    pooled = groups.filter("key is not null").groupBy("key").agg(F.array_distinct(F.flatten(F.sort_array(F.collect_list(F.coalesce("words", F.array().cast("array<string>")))))).alias("words"))
    ranked = stored(pooled.withColumn("rank", F.struct((-F.size("words")).alias("less"), "key")))
    homes = first_independent(ranked.select(F.col("key").alias("node"), "rank"), containing(ranked.filter(F.length("key") >= least), "key", least))
    parts = ranked.join(homes, F.col("key") == F.col("node")).select("root", (F.col("key") != F.col("root")).alias("moved"), "rank", "words")
    return parts.groupBy(F.col("root").alias("key")).agg(F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("moved", "rank", "words"))), lambda x: x["words"]))).alias("words"))


# fixed values: words that no name rule takes for a name
NO_NAMES_ZH = (
    "我们 你们 他们 她们 这个 那个 什么 怎么 为什么 可以 可能 应该 因为 所以 但是 虽然 如果 然后 "
    "已经 没有 还是 或者 而且 不过 只是 一定 非常 今天 明天 昨天 现在 以后 以前 正在 一直"
).split()

# fixed values: (kind, what comes before, the name, what of the rest belongs to the text, what must follow)
NAME_RULES = {
    "ja": [
        ("name_kanji_suffix", "", "[一-鿿]{1,4}", "博士|警部|殿下|先生|総統|団長|伯爵|署長|所長|船長|部長|社長", ""),
        ("name_katakana_suffix", "", "[゠-ヿ]{2,6}", "さん|くん|ちゃん|様|殿", ""),
        ("calling", "(?:おい|なあ|ねえ|もしもし)[、\\s]*", "[゠-ヿ]{2,6}", "", "[!！〜～\\s]|$"),
        ("introduction", "", "[一-鿿぀-ゟ゠-ヿ]{2,8}", "", "って|という|と言う|と呼ぶ|って言う|といいます|って呼ばれ"),
        ("known_katakana", "", "[゠-ヿ]{2,}", "", ""),
    ],
    "zh": [
        ("name_suffix", "", "[一-鿿]{1,4}", "先生|小姐|女士|老师|同学|医生|大夫|队长|警长|校长|部长|经理|总[监裁]?|董[事长]?|局长|处长|科长|主任|教授|师傅", ""),
        ("calling", "(?:喂|诶|嘿)[、\\s,!！]*", "[一-鿿]{1,4}", "", "[!！啊呀啦呢哦～~\\s]|$"),
        ("introduction", "叫|名叫|叫作|叫做|就是|那就是|这位是", "[一-鿿A-Za-z]{1,8}", "", ""),
        ("quoted", "「", "[一-鿿]{1,6}", "", "」"),
        ("known_hanzi", "", "[一-鿿]{2,4}", "", ""),
    ],
}


def named_spans(c: Column, lang: str = "ja", known: list[str] | tuple[str, ...] = (), common: list[str] | tuple[str, ...] | None = None) -> Column:
    """Spans (start, len, text, kind, name) that the language's rules take for names: with a title, called, introduced,
    quoted, or in the list of known ones; none overlap. text has the title, name has not. Words of `common` (by default the
    fixed Chinese ones for zh, none for ja) are no names, but with a kanji title, quoted or known. A kanji name with a title
    does not count right after hiragana. Null text gives null, a text without names an empty array."""
    lang = "zh" if lang == "zh" else "ja"
    no_names = list((NO_NAMES_ZH if lang == "zh" else ()) if common is None else common)

    def spans(kind: str, lead: str, name: str, tail: str, after: str) -> Column:
        p = f"(?U)({lead})({name})({tail})(?:{after})"

        def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
            start, found = at + F.length(x["before"]), x["name"]
            ok = F.lit(True)
            if kind.startswith("known"):
                ok = found.isin(list(known))
            elif kind == "name_kanji_suffix":
                ok = ~x["before"].rlike("[ぁ-ゟ]\\z")
            elif kind != "quoted" and no_names:
                ok = ~found.isin(no_names)
            whole = F.concat(found, x["tail"])
            span = F.struct((start + F.length(x["lead"])).alias("start"), F.length(whole).alias("len"), whole.alias("text"), F.lit(kind).alias("kind"), found.alias("name"))
            return ok, span, start + F.length(x["hit"])

        part = lambda i: F.regexp_extract_all(c, F.lit(p), F.lit(i))
        pairs = F.arrays_zip(F.split(c, p).alias("before"), part(0).alias("hit"), part(1).alias("lead"), part(2).alias("name"), part(3).alias("tail"))
        return _passed(F.filter(pairs, lambda x: x["hit"].isNotNull()), step)

    rules = [r for r in NAME_RULES[lang] if known or not r[0].startswith("known")]
    return keep_disjoint(F.concat(*[spans(*r) for r in rules]))


def _passed(items: Column, step) -> Column:
    """Outs of the items that step lets pass; the place moves on with every item."""

    def both(at: Column, x: Column) -> tuple[Column, Column, Column]:
        ok, out, after = step(at, x)
        return F.lit(True), F.struct(ok.alias("ok"), out.alias("out")), after

    kind = "array<struct<ok:boolean,out:struct<start:int,len:int,text:string,kind:string,name:string>>>"
    marked = _folded(items, F.array().cast(kind), F.lit(0), both)
    return F.transform(F.filter(marked, lambda x: x["ok"]), lambda x: x["out"])


# fixed values: Chinese words and particles that make no entry of a glossary
STOP_ZH = (
    "什么 怎么 为什么 怎么样 这是 那是 不是 可以 没有 一个 这个 那个 我们 你们 他们 她们 它们 现在 已经 还是 但是 因为 所以 如果 虽然 "
    "非常 真的 就是 的话 而且 或者 不过 了吧 了吗 了啊 吧 呢 吗 啊 哦 嗯 好的 好吧 行了 好了 对了 是吧 对吧 等等 然后 接着 最后 首先 前面 后面 "
    "里面 外面 上面 下面 旁边 中间 很多 很少 一些 一点 快点 一定 必须 应该 需要 可能 知道 看到 听到 找到 觉得 以为 来说 来看 来讲 "
    "全部 所有 这里 那里 哪里 今天 明天 昨天 每天 那天 她的 他的 它的 我的 你的 说话 过来 回去 起来 出来 进去 只是 可是 倒是 还有 "
    "真的吗 怎么办 太好了 没问题"
).split()
PARTICLES_ZH = "的了着过在是不很都也就还和与被把让给"


def glossary_reject_reason_zh(term: Column) -> Column:
    """Why an entry of a Chinese glossary is no name, by the first rule that holds, null if none does."""
    t = text.strip(term)
    return (
        F.when(F.coalesce(t, F.lit("")).rlike("^[，。！？、；：\"（）…—　 ]*$"), "empty/punctuation").when(t.rlike("^[0-9０-９]+$"), "pure number")
        .when(F.length(t) == 1, "single char fragment").when(t.rlike(f"[{text.HAN}]") & t.rlike("[A-Za-z]"), "bilingual fragment").when(t.isin(STOP_ZH), "stop word")
        .when(F.length(t) > 6, "sentence fragment (>6 chars)").when(t.rlike(f"^[{PARTICLES_ZH}]|[{PARTICLES_ZH}]$"), "starts/ends with particle")
    )

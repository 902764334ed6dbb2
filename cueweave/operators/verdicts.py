"""Decision lists over candidates and glossary entries: what is a name, what is not, and why.

Every list is a chain of `when`s, so the first rule that holds decides; dictionaries come in as boolean columns, which a join
with a lexicon table of any length makes (`flagged`). Reasons are short codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.functions import lexicon as lex
from cueweave.operators.setops import first_wins

# fixed values: runs that are sounds, not words, and how often they come at least
DASHES = {"ja": "-ー―", "zh": "-—", "en": "-—"}
SOUNDS = {"ja": ("ハァ|フー|ウー|アー|エー|オー|へへ|ふふ|わあ|ああ|ええ|おお", 1), "zh": ("啊|呀|哦|嗯|哎|嘿|哟|哇|哈", 2), "en": ("um|uh|oh|ah|eh|hmm|er|hmph|ugh|ack", 1)}

# fixed values: what introduces the word before it
INTRODUCES = "って言う|っていう|って呼ぶ|って呼ばれ|という|と言う|と呼ぶ|と呼ばれ|といいます|とは"

# fixed values: signs of names in Japanese glossaries
SURNAME = "田|藤|井|村|木|林|森|山|川|谷|沼|瀬|崎|島|湾|沢|坂|原|野|池|浦|塚|畑|岡"
PLACE_END = "市|区|町|県|国|都|道|府|京|駅|港|空港"
TITLE = "博士|君|様|さん|ちゃん|殿下|警部|総統|団長|伯爵|署長|所長|船長|部長|社長"
VEHICLE_END = "号"
KNOWN_NAMES = "科学省 科学省長 科学省庁 幽霊製造 電子相撲 風船雲 次元装置 電磁銃 地球連邦 三銃士 黄金如来 火星銀行 日立 日本亭 日本".split()

# fixed values: signs of common words among kanji entries
STEM_END = (
    "行|来|出|入|見|言|思|取|持|待|通|違|守|助|探|許|頼|騒|急|知|動|揃|遅|鳴|経|過|儲|隠|殺|捨|回|直|替|聞|切|焼|改|造|払|戻|覚|失|逃|去|帰|歩|走|飛|乗|泳|渡|曲|止|始|終|残|進|向|付|着|続|開|閉|治|落|流|組|張|越|減|増|足|引|押|倒|消|壊|割|育|死|当|打|負|勝|戦|闘"
)
TIME_OR_NUMBER = "今前後日時分秒年月何億万千"
MODIFIER = "全|一|大|最|不|非|無|未|随|絶|随分|全然|絶対"
PRONOUN = "僕|私|俺|君|お前|我|彼|誰"

# fixed values: sounds, exclamations and broken words among katakana entries
KATAKANA_SOUND = ["^([ア-ヾ]{2})\\1+ン?$", "^[ア-ヾ]{1,3}[ッっ]$", "^[ア-ヾ]{1,3}ー[ッツ]$", "^[ア-ヾ]{2,3}ーン$", "^[ア-ヾ]{2,3}ョン$"]
KATAKANA_COMMON = "パパ ママ パパママ バイキン アイスクリー アイスクリーム バイバイ バイバーイ パパー エネルギ ネルギー エネルギータ プロダクショ リボリュー".split()
KATAKANA_CRIES = "ハッハー ハハハ アハハ イェーイ ワーイ エーッ アーッ キャー ウワー ヤッター ハーイ ニャー ニャーニャー チャー モー モーモー ワンワン".split()
KATAKANA_BROKEN = "^ー[ア-ヾ]"


def flagged(df: DataFrame, words: DataFrame, column: str, flag: str) -> DataFrame:
    """df with a boolean column: its `column` is among the words (first column). An equi-join, whatever the size of the list."""
    listed = words.select(F.col(words.columns[0]).alias(column)).distinct().withColumn(flag, F.lit(True))
    return df.join(listed, column, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def is_non_word(term: Column, lang: str = "ja") -> Column:
    """Dashes, a character three times or more, or nothing but sounds."""
    sounds, least = SOUNDS.get(lang, SOUNDS["ja"])
    return term.rlike(f"^[{DASHES.get(lang, DASHES['ja'])}]{{2,}}$") | term.rlike("^(.)\\1{2,}$") | term.rlike(f"^(?:{sounds}){{{least},}}$")


def candidate_verdict(term: Column, context: Column, n_eps: Column, common: Column, lang: str = "ja", dictionary: Column | None = None, names: Column | None = None) -> Column:
    """(verdict, reason) of a candidate: ACCEPT, REJECT or NEEDS_AI.

    context is the cue that holds it (null: unknown), n_eps the number of episodes it is in; common, dictionary and names say
    whether it is a listed common word (en: in lower case), a word or a name of a dictionary. A null term counts as empty.
    """
    t, n = F.coalesce(text.strip(term), F.lit("")), F.coalesce(n_eps, F.lit(1))
    no, shown = F.lit(False), F.coalesce(context, F.lit("")) != ""
    rules: list[tuple[Column, str, str]] = [(t == "", "REJECT", "empty"), (is_non_word(t, lang), "REJECT", "non-word"), ((F.length(t) == 1) & (n == 1), "REJECT", "lone character")]
    if lang == "ja":
        introduced = F.regexp_like(F.coalesce(context, F.lit("")), F.concat(F.lit("\\Q"), t, F.lit(f"\\E(?:{INTRODUCES})")))
        rules += [
            (t.rlike("^[ぁ-ゟ]+$"), "REJECT", "hiragana"), (t.rlike("^[a-zA-Z\\s]+$"), "REJECT", "latin"), (no if dictionary is None else dictionary, "REJECT", "dictionary"), (no if names is None else names, "ACCEPT", "name dictionary"),
            (common, "REJECT", "common word"), (shown & t.rlike(f"(?:{'|'.join(lex.HONORIFICS['ja'])})$"), "ACCEPT", "title"), (shown & introduced, "ACCEPT", "introduced"),
            (text.has(t, text.KATAKANA) & (n >= 2), "ACCEPT", "katakana in episodes"), (t.rlike(f"^[{text.HAN}]{{2,4}}$") & (n >= 2), "ACCEPT", "kanji in episodes"),
        ]
    elif lang == "zh":
        rules += [(common, "REJECT", "common word"), (t.rlike("^[ぁ-ヿ]+$"), "REJECT", "kana"), (t.rlike(f"^[{text.HAN}]{{2,4}}$") & (n >= 2), "ACCEPT", "hanzi in episodes"), ((F.length(t) == 1) & text.has(t, text.HAN), "NEEDS_AI", "single hanzi")]
    elif lang == "en":
        capital = t.rlike("^[A-Z][a-z]{2,}$")
        rules += [(common, "REJECT", "common word"), (capital & (n >= 2), "ACCEPT", "capitalised in episodes"), (capital, "NEEDS_AI", "capitalised once"), (t.rlike("^[A-Z][a-z]+ [A-Z][a-z]+$"), "ACCEPT", "full name")]
    return _first(rules, ("NEEDS_AI", "unclear"), "verdict")


def _first(rules: list[tuple[Column, str, str]], rest: tuple[str | None, str | None], name: str) -> Column:
    pair = lambda a, b: F.struct(F.lit(a).cast("string").alias(name), F.lit(b).cast("string").alias("reason"))
    out = F.when(rules[0][0], pair(*rules[0][1:]))
    for holds, a, b in rules[1:]:
        out = out.when(holds, pair(a, b))
    return out.otherwise(pair(*rest))


def is_likely_name(term: Column) -> Column:
    """A Japanese glossary entry that stays whatever else it looks like: a known name, or one with a title, a part of surnames,
    the end of a place or of a vehicle."""
    return term.isin(KNOWN_NAMES) | term.rlike(f"{TITLE}|{SURNAME}|(?:{PLACE_END}|{VEHICLE_END})$")


def glossary_verdict(term: Column, katakana: Column, common: Column, dictionary: Column | None = None) -> Column:
    """(verdict, reason) of an entry of a Japanese glossary: 'known' for listed common words, which are passed over, 'keep' with
    reason 'name' for what looks like one, 'reject', or 'keep' without a reason. katakana says in which kind of section it stands."""
    short = F.length(term) <= 4
    in_dictionary = F.lit(False) if dictionary is None else dictionary
    kanji = [
        (in_dictionary, "dictionary"), (term.rlike(f"(?:{STEM_END})$"), "verb stem"), (term.rlike(f"[{TIME_OR_NUMBER}]") & short & ~term.rlike(SURNAME), "time or number"),
        (term.rlike(f"^(?:{MODIFIER})") & short, "modifier"), (term.rlike(PRONOUN) & short, "pronoun"),
    ]
    kana = [(in_dictionary, "dictionary"), (term.isin(KATAKANA_COMMON), "common word"), (is_sound(term), "sound"), (term.isin(KATAKANA_CRIES), "cry"), (term.rlike(KATAKANA_BROKEN), "fragment")]
    rules = [(common, "known", None), (is_likely_name(term), "keep", "name")]
    rules += [(katakana & holds, "reject", why) for holds, why in kana] + [(~katakana & holds, "reject", why) for holds, why in kanji]
    return _first(rules, ("keep", None), "verdict")


def is_sound(term: Column) -> Column:
    """Katakana onomatopoeia: a doubled pair, a short burst, a drawn-out end."""
    return term.rlike("|".join(KATAKANA_SOUND))


def clean_glossary(entries: DataFrame, common: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Entries (seq, word, katakana, ...) with verdict and reason. Of a word that is rejected in several sections only the first row
    (by seq) stays; kept ones stay in each of theirs, known common words go."""
    rows = flagged(entries, common, "word", "_common")
    rows = flagged(rows, dictionary, "word", "_dictionary") if dictionary is not None else rows.withColumn("_dictionary", F.lit(False))
    rows = rows.withColumn("_v", glossary_verdict(F.col("word"), F.col("katakana"), F.col("_common"), F.col("_dictionary"))).filter("_v.verdict != 'known'")
    rows = rows.select(*entries.columns, "_v.verdict", "_v.reason")
    return rows.filter("verdict = 'keep'").unionByName(first_wins(rows.filter("verdict = 'reject'"), ["word"], ["seq"]))


def append_reason(name: Column, common: Column, lang: str = "zh") -> Column:
    """Why a name must not be appended to a glossary, null if it may: too short, a common word, a sound or a fragment (ja), kana
    only (zh), without Latin letters (en)."""
    rules = [(F.length(name) < 2, "short"), (common, "common word")]
    if lang == "ja":
        rules += [(is_sound(name), "sound"), (name.rlike(KATAKANA_BROKEN), "fragment")]
    elif lang == "zh":
        rules += [(name.rlike("^[ぁ-ヿ]+$"), "kana")]
    elif lang == "en":
        rules += [(~text.has(name, text.LATIN), "no latin")]
    out = F.when(rules[0][0], rules[0][1])
    for holds, why in rules[1:]:
        out = out.when(holds, why)
    return out


def append_names(candidates: DataFrame, existing: DataFrame, common: DataFrame, lang: str = "ja") -> DataFrame:
    """What is appended to a glossary: candidates (seq, name, n) that are valid and not in it (existing: names in the first column), each
    name once, by its first row in the order of seq. Null and empty names go."""
    new = candidates.filter("name is not null and name != ''").join(existing.select(F.col(existing.columns[0]).alias("name")).distinct(), "name", "left_anti")
    valid = flagged(new, common, "name", "_common").filter(append_reason(F.col("name"), F.col("_common"), lang).isNull())
    return first_wins(valid.drop("_common"), ["name"], ["seq"]).select("seq", "name", "n")


def glossary_terms(freqs: DataFrame, common: DataFrame, whitelist: DataFrame | None = None, dictionary: DataFrame | None = None, labels: DataFrame | None = None, lang: str = "ja", least: int = 3, rare: int = 10, shortest: int = 2) -> DataFrame:
    """(term, freq, kind) of the terms that a glossary takes from (term, freq), kind katakana or kanji.

    Terms of `least` occurrences that are words, no labels, and, unless whitelisted, neither common nor in the dictionary (term, and for zh
    freq: only entries more frequent than `rare` count). ja: katakana without kanji of `shortest` characters, kanji terms of two; a common word
    is none even if whitelisted. Other languages: kanji terms of two characters. Word lists of any length are joined by equality; of
    repeated dictionary entries the most frequent counts.
    """
    words = lambda df: df.select(F.col(df.columns[0]).alias("term"))
    rows = freqs.select("term", "freq").filter((F.col("freq") >= least) & ~is_non_word(F.col("term"), lang))
    if labels is not None:
        rows = rows.join(words(labels), "term", "left_anti")
    rows = flagged(rows, words(common), "term", "_common")
    rows = flagged(rows, words(whitelist), "term", "_listed") if whitelist is not None else rows.withColumn("_listed", F.lit(False))
    if dictionary is not None and lang in ("ja", "zh"):
        entries = words(dictionary) if lang == "ja" else dictionary.filter(F.col("freq") > rare).select("term")
        rows = flagged(rows, entries, "term", "_known")
    else:
        rows = rows.withColumn("_known", F.lit(False))
    katakana, kanji, n = text.has(F.col("term"), text.KATAKANA), text.has(F.col("term"), text.HAN), F.length("term")
    ja = F.lit(lang == "ja")
    kind = F.when(ja & katakana & ~kanji, F.when(~F.col("_common") & (n >= shortest), "katakana")).when(kanji & (n >= 2) & ~(ja & F.col("_common")), "kanji")
    kept = rows.filter(F.col("_listed") | ~(F.col("_common") | F.col("_known"))).withColumn("kind", kind)
    return kept.filter("kind is not null").select("term", "freq", "kind")

"""Text predicates, counts and normalisers as Column expressions. Languages are 'ja', 'zh' and 'en'; others count as 'ja'.

Character classes differ from operator to operator on purpose and are named by their ranges. A null text gives null unless
said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cueweave.functions import lexicon as lex

KANA, KANA_FROM_A, KATAKANA, HAN, HAN_EXT = "\\u3040-\\u30FF", "\\u3041-\\u30FF", "\\u30A0-\\u30FF", "\\u4E00-\\u9FFF", "\\u4E00-\\u9FFF\\u3400-\\u4DBF"
CYRILLIC, CYRILLIC_WIDE, CYRILLIC_BLOCK, LATIN = "А-Яа-яЁё", "А-яЁё", "\\u0400-\\u04FF", "a-zA-Z"


def has(c: Column, chars: str, least: int = 1) -> Column:
    """True if a run of `least` characters of the class is in the text."""
    return c.rlike(f"[{chars}]" if least == 1 else f"[{chars}]{{{least},}}")


def count_chars(c: Column, chars: str) -> Column:
    return F.regexp_count(c, F.lit(f"[{chars}]"))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def characters(c: Column) -> Column:
    """The characters of a text as an array, empty for an empty text."""
    return F.filter(F.split(c, ""), lambda x: x != "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def strip_ass_tags(c: Column) -> Column:
    return strip_tags(F.regexp_replace(c, "\\{[^}]*\\}", ""))


def is_garbled(c: Column, lang: str = "ja") -> Column:
    """Script that does not belong to the language: ja Latin runs or Cyrillic; zh those or kana; en Cyrillic, kana or han."""
    latin, cyrillic, kana = has(c, LATIN, 2), has(c, CYRILLIC), has(c, KANA)
    hit = latin | cyrillic | kana if lang == "zh" else cyrillic | kana | has(c, HAN) if lang == "en" else latin | cyrillic
    return F.when(c == "", F.lit(False)).otherwise(hit)


def garbled_type(c: Column, lang: str = "ja") -> Column:
    return F.when(is_garbled(c, lang), "garbled").otherwise("clean")


def is_valid(c: Column, lang: str = "ja") -> Column:
    """A usable line of the language, not noise or romanised guesswork."""
    t = strip(c)
    if lang == "zh":
        return has(t, HAN) & ~has(t, CYRILLIC_WIDE) & (F.length(t) >= 2)
    if lang == "en":
        return has(t, LATIN, 2) & ~has(t, CYRILLIC_WIDE) & (F.length(t) >= 3)
    return (has(t, KANA) | has(t, HAN)) & ~t.rlike("^[a-zA-Z\\s\\d.,!?'\"\\-]+$")


def is_plausible(c: Column, lang: str = "ja") -> Column:
    """A readable line, with mistakes allowed."""
    t = strip(c)
    kana, han, latin, cyrillic, han_ext = has(t, KANA), has(t, HAN), has(t, LATIN), has(t, CYRILLIC_WIDE), has(t, HAN_EXT)
    if lang == "zh":
        ok = (han_ext & ~cyrillic) | (latin & ~cyrillic & (F.length(t) <= 10))
    elif lang == "en":
        ok = ~cyrillic & latin
    else:
        ok = (kana | han) & ~latin & ~cyrillic
    return (F.length(t) >= 3) & ok


def is_short_fragment(c: Column, lang: str = "ja") -> Column:
    t = strip(c)
    if lang == "ja":
        ok = has(t, KANA + HAN) & (count_chars(t, LATIN) <= 5) & (F.length(t) <= 15)
    elif lang == "en":
        ok = (F.length(t) <= 20) & has(t, LATIN)
    else:
        ok = (F.length(t) <= 8) & ~has(t, HAN)
    return (t != "") & ok


def is_fixable(c: Column, lang: str = "ja") -> Column:
    t = strip(c)
    if lang == "ja":
        ok = has(t, KANA + HAN) & has(t, LATIN) & (F.length(t) <= 80)
    elif lang == "en":
        ok = has(t, LATIN) & (F.length(t) <= 120)
    else:
        ok = has(t, HAN) & has(t, LATIN) & (F.length(t) <= 80)
    return (t != "") & ok


def is_name_shape(c: Column, lang: str = "ja") -> Column:
    """The whole text looks like a proper noun."""
    if lang == "zh":
        return c.rlike(f"^[{HAN}]{{2,4}}$")
    if lang == "en":
        return c.rlike("^[A-Z][a-z]{2,}$|^[A-Z][a-z]+ [A-Z][a-z]+$")
    return c.rlike(f"^[{KATAKANA}]{{2,}}$|^[{HAN}]{{2,4}}$") | (has(c, KATAKANA) & has(c, LATIN))


def meaningful_count(c: Column, lang: str = "ja") -> Column:
    """Characters (en: words of two letters or more) that are no exclamation. ja may be negative: '〜' is only taken away."""
    t = strip(c)
    if lang == "zh":
        return F.greatest(F.lit(0), count_chars(t, HAN) - count_chars(t, lex.EXCLAMATION_HAN))
    if lang == "en":
        sounds = "|".join(sorted(lex.EXCLAMATION_EN, key=len, reverse=True))
        return F.regexp_count(t, F.lit("[a-zA-Z]{2,}")) - F.regexp_count(t, F.lit(f"(?i)(?<![a-z])(?:{sounds})(?![a-z])"))
    return count_chars(t, KANA_FROM_A + HAN) - count_chars(t, lex.EXCLAMATION_KANA)


def plain_count(c: Column, lang: str = "ja") -> Column:
    """Characters of the script, exclamations too; en counts runs of Latin letters."""
    if lang == "zh":
        return count_chars(c, HAN)
    if lang == "en":
        return F.regexp_count(c, F.lit("[a-zA-Z]+"))
    return count_chars(c, KANA + HAN)


def is_length_anomaly(original: Column, new: Column, ratio: float = 3.0) -> Column:
    """The new text is more than `ratio` times as long as the original, which counts as three characters at least."""
    return F.length(strip(new)) / F.greatest(F.length(strip(original)), F.lit(3)) > ratio


def is_marker(c: Column, lang: str = "ja") -> Column:
    """A bracketed editorial marker of the language."""
    return c.rlike("^\\[(" + "|".join(lex.MARKERS.get(lang, lex.MARKERS["ja"])) + ")\\]$")


def is_music_marker(c: Column) -> Column:
    return strip(c).rlike("^\\[[^\\]]+\\]$")


def is_one_char(c: Column, share: float = 0.7) -> Column:
    """One character makes up more than `share` (over a half) of the text; such a character is the middle of the sorted text."""
    chars = F.sort_array(characters(c))
    n = F.length(c)
    middle = F.get(chars, F.floor(n / 2).cast("int"))
    return (n - F.length(F.replace(c, middle, F.lit("")))) / F.greatest(n, F.lit(1)) > share


def is_noise(c: Column, lang: str = "ja") -> Column:
    """Recogniser noise: too short, the wrong script, or one character over and over."""
    t = strip(c)
    n = F.length(t)
    kana, han, latin = has(t, KANA_FROM_A), has(t, HAN), has(t, LATIN)
    mostly_latin = count_chars(t, LATIN) / F.greatest(n, F.lit(1)) > 0.5
    over = (n >= 4) & is_one_char(t)
    if lang == "zh":
        out = F.when(n <= 1, ~han).when(latin & ~han & mostly_latin, F.lit(True)).otherwise(over)
    elif lang == "en":
        out = F.when(n <= 1, ~latin).when(han & ~latin, F.lit(True)).otherwise(over)
    else:
        none = ~kana & ~han
        out = F.when(n <= 3, none | ((n <= 1) & kana)).when(latin & none & mostly_latin, F.lit(True)).otherwise(over)
    return F.when(t == "", F.lit(True)).otherwise(out)


def is_valid_for_votes(c: Column, lang: str = "ja") -> Column:
    """A line that may vote on what an opening or ending says."""
    t = strip(c)
    if lang == "zh":
        ok = has(t, HAN)
    elif lang == "en":
        ok = has(t, LATIN, 2) & ~has(t, HAN)
    else:
        ok = (has(t, KANA_FROM_A) | has(t, HAN)) & (count_chars(t, LATIN) / F.greatest(F.length(t), F.lit(1)) <= 0.5)
    return (F.length(t) >= 2) & ok


def is_unvoiced(c: Column) -> Column:
    """No use for finding out the language: under two characters, a marker, or without letters."""
    t = strip(c)
    return (F.length(t) < 2) | is_music_marker(c) | ~has(t, KANA_FROM_A + HAN + CYRILLIC_BLOCK + LATIN)


def script(c: Column) -> Column:
    """The script with most characters if it beats all others (kana, cjk, cyrillic), else latin if there is any, else unknown."""
    t = strip(c)
    k, h, y, a = count_chars(t, KANA_FROM_A), count_chars(t, HAN), count_chars(t, CYRILLIC_BLOCK), count_chars(t, LATIN)
    return F.when(h > F.greatest(k, y, a), "cjk").when(k > F.greatest(h, y, a), "kana").when(y > F.greatest(h, k, a), "cyrillic").when(a > 0, "latin").otherwise("unknown")


def script_language(c: Column) -> Column:
    return F.when(c == "cjk", "zh").when(c == "kana", "ja").when(c == "cyrillic", "ru").when(c == "latin", "en").otherwise("??")


def scripts_match(c: Column, lang: str) -> Column:
    return c.isin({"zh": ["cjk"], "ja": ["cjk", "kana"], "ru": ["cyrillic"]}.get(lang, [])) if lang in ("zh", "ja", "ru") else F.lit(False)


def char_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the character sets, 0 if either is empty."""
    x, y = characters(strip(a)), characters(strip(b))
    union = F.size(F.array_union(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(union, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Share of a's characters, spaces aside, that b has."""
    x, y = (F.array_distinct(characters(F.regexp_replace(c, " ", ""))) for c in (a, b))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.lit(1)))


def repeats(c: Column, length: int, least: int = 8) -> Column:
    """Array of runs in which `length` characters stand `least` times or more in a row, found from left to right."""
    return F.regexp_extract_all(c, F.lit(f"((.{{{length}}})\\2{{{least - 1},}})"), F.lit(1))


def is_excluded_repeat(sequence: Column, sounds: list[str]) -> Column:
    """A repeat that means nothing: a known sound, or two different characters at most."""
    bare = F.regexp_replace(F.lower(sequence), "[!！?？ \\-~～]", "")
    return sequence.isin(sounds) | (F.size(F.array_distinct(characters(bare))) <= 2)


def episode_number(name: Column) -> Column:
    """'EPnnn' from a file name, by the first rule that gives a valid number; '???' if none does.

    Rules: S01E05; 031 EP; #193; EP031 or Episode 5; 第5話; a number between separators; any number. Resolutions, years and
    numbers beyond 1 to 9999 don't count.
    """
    base = F.regexp_extract(name, "([^/\\\\]*)$", 1)
    clean = F.regexp_replace(base, "\\.[^.]*$", "")
    # fixed values: encoding tags
    tags = "1080p|720p|480p|2160p|4K|1080i|x264|x265|H\\.?264|H\\.?265|HEVC|AVC|AV1|BluRay|Blu-ray|WEB-DL|WEBRip|BDRip|DVDRip|HDTVRip|HDTV|DVD|NF|AMZN|AAC|FLAC|DTS|AC3|MP3|Opus|8bit|10bit|Hi10p|Hi444PP"
    clean = F.regexp_replace(clean, f"(?i)\\b(?:{tags})\\b", " ")
    clean = F.regexp_replace(F.regexp_replace(clean, "\\[[0-9A-Fa-f]{8}\\]", ""), "\\[[^\\]]+\\]", " ")
    clean = F.trim(F.regexp_replace(F.regexp_replace(clean, "[_.]", " "), "\\s+", " "))
    sized = F.concat(*[F.regexp_extract_all(c, F.lit("\\b(\\d{3,4})\\s*[x×]\\s*\\d{3,4}\\b"), F.lit(1)) for c in (clean, base)])
    rules = [
        (base, "[Ss]\\d{1,3}[\\s.]*[Ee](\\d{1,4})"), (base, "(?U)(?<!\\d)(\\d{1,4})(?:\\s*\\w+)?\\s*[Ee][Pp]\\b"), (base, "(?U)#\\s*(\\d{1,4})\\b"),
        (base, "(?U)[Ee][Pp](?:isode)?\\s*\\.?\\s*(\\d{1,4})\\b"), (base, "第\\s*(\\d{1,4})\\s*[話话集回]"),
    ]
    firsts = [F.regexp_extract(c, p, 1) for c, p in rules]
    lists = [F.regexp_extract_all(clean, F.lit(p), F.lit(1)) for p in ("(?:^|[\\s\\-\\[\\]#])(\\d{1,4})(?=[\\s\\-\\[\\]#]|$)", "(?U)\\b(\\d{1,4})\\b")]
    picks = [F.get(F.filter(xs, lambda x: valid_episode(x.cast("int")) & ~F.array_contains(sized, x)), F.lit(0)) for xs in lists]
    numbers = [F.when(valid_episode(x.try_cast("int")), x.try_cast("int")) for x in firsts] + [p.cast("int") for p in picks]
    found = F.coalesce(*numbers)
    return F.when(found.isNull(), "???").otherwise(F.concat(F.lit("EP"), F.when(found < 1000, F.lpad(found.cast("string"), 3, "0")).otherwise(found.cast("string"))))


def valid_episode(n: Column) -> Column:
    return n.between(1, 9999) & ~n.between(1900, 2099) & ~n.isin(360, 480, 540, 720, 1080, 1440, 2160, 4320)


def file_id(name: Column) -> Column:
    """The episode, or the file's stem where it has none."""
    ep = episode_number(name)
    return F.when(ep == "???", F.regexp_replace(F.regexp_extract(name, "([^/\\\\]*)$", 1), "\\.[^.]*$", "")).otherwise(ep)


# fixed values: small and large kana; vowels with tones and without
SMALL, LARGE = "ァィゥェォッャュョヮぁぃぅぇぉっゃゅょゎ", "アイウエオツヤユヨワあいうえおつやゆよわ"
TONES, VOWELS = "āáǎàēéěèīíǐìōóǒòūúǔùǖǘǚǜ", "aaaaeeeeiiiioooouuuuvvvv"


# fixed values: katakana after which a long mark is dropped, their small forms, and voiced against clear ones
LENGTHENED = "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモラリルレロガギグゲゴザジズゼゾダバビブベボパピプペポ"
SMALL_KATAKANA, LARGE_KATAKANA = "ァィゥェォャュョッヵヶ", "アイウエオヤユヨツカケ"
VOICED_KATAKANA, CLEAR_KATAKANA = "ガギグゲゴザジズゼゾダヂヅデドバビブベボパピプペポ", "カキクケコサシスセソタチツテトハヒフヘホハヒフヘホ"


def normalise(c: Column, lang: str = "ja", level: str = "medium", traditional: str = "", simple: str = "") -> Column:
    """Spelling variants made alike. ja: strict drops a long mark after a katakana that can be lengthened, medium also enlarges
    small katakana, lenient also clears voiced ones. zh: strict simplifies by the given characters, medium also drops
    tones, lenient also a 儿 at a word's end. en: lower case without outer spaces."""
    if lang == "en":
        return F.lower(strip(c))
    if lang == "zh":
        t = F.translate(c, traditional, simple) if traditional else c
        t = F.translate(t, TONES, VOWELS) if level != "strict" else t
        return F.regexp_replace(t, "(?U)儿\\b", "") if level == "lenient" else t
    t = F.regexp_replace(c, f"([{LENGTHENED}])ー", "$1")
    t = F.translate(t, SMALL_KATAKANA, LARGE_KATAKANA) if level != "strict" else t
    return F.translate(t, VOICED_KATAKANA, CLEAR_KATAKANA) if level == "lenient" else t


def grouping_key(c: Column) -> Column:
    """The key under which katakana variants meet."""
    return F.translate(F.regexp_replace(c, "ー", ""), SMALL, LARGE)


def replace_all(c: Column, pairs: Column) -> Column:
    """Literal replacements from an array of (src, dst), one after the other in its order."""
    return F.aggregate(pairs, c, lambda t, p: F.replace(t, p["src"], p["dst"]))


def replace_patterns(c: Column, rules: list[tuple[str, str]]) -> Column:
    """A cascade of regular-expression replacements."""
    for pattern, new in rules:
        c = F.regexp_replace(c, pattern, new)
    return c


def counted_patterns(c: Column, rules: list[tuple[str, str]]) -> Column:
    """(text, n): the cascade of replace_patterns, and how many places it changed."""
    n = F.lit(0)
    for pattern, new in rules:
        n = n + F.regexp_count(c, F.lit(pattern))
        c = F.regexp_replace(c, pattern, new)
    return F.struct(c.alias("text"), n.alias("n"))


def natural_zh(c: Column) -> Column:
    """(text, n) of a Chinese line without the turns of phrase of translations."""
    return counted_patterns(c, lex.NATURAL_ZH)


def name_class(c: Column) -> Column:
    """Which script a speaker's name is in: the class with most characters, ties to the first; punctuation and digits last."""
    t = strip(c)
    kinds = [("ja", KANA), ("han", HAN), ("latin", LATIN), ("cyrillic", CYRILLIC_BLOCK), ("hangul", "\\uAC00-\\uD7AF")]
    best = F.array_max(F.array(*[F.struct(count_chars(t, chars).alias("n"), F.lit(-i).alias("turn"), F.lit(name).alias("name")) for i, (name, chars) in enumerate(kinds)]))
    return F.when(best["n"] > 0, best["name"]).otherwise("other")


def bad_drawing_chars(c: Column) -> Column:
    """Characters that no drawing command has, without repeats."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit("[^mnlbspcMNLBSPC0-9.\\-\\s]"), F.lit(0)))

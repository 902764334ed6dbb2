"""Decision lists over names, with expected rows written by hand from the documented rules."""

import pytest
from pyspark.sql import functions as F

from cueweave.operators import review, summary, verdicts

# (term, context, episodes, common, dictionary, names) -> verdict, reason
CASES = {
    "ja": [
        (("", None, 1, False, False, False), ("REJECT", "empty")), (("  ", "x", 9, False, False, False), ("REJECT", "empty")), ((None, None, None, False, False, False), ("REJECT", "empty")),
        (("ーー", None, 5, False, False, False), ("REJECT", "non-word")), (("アアア", None, 5, False, False, True), ("REJECT", "non-word")), (("ハァハァ", None, 5, False, False, False), ("REJECT", "non-word")),
        (("猫", None, 1, False, False, False), ("REJECT", "lone character")), (("猫", None, 2, False, False, False), ("NEEDS_AI", "unclear")),
        (("ありがとう", None, 7, False, False, True), ("REJECT", "hiragana")), (("New York", None, 7, False, False, False), ("REJECT", "latin")),
        (("時計", None, 7, False, True, True), ("REJECT", "dictionary")), (("山田", None, 1, True, False, True), ("ACCEPT", "name dictionary")), (("ロボット", None, 9, True, False, False), ("REJECT", "common word")),
        (("健太くん", "健太くん、待って", 1, False, False, False), ("ACCEPT", "title")), (("健太くん", None, 1, False, False, False), ("NEEDS_AI", "unclear")), (("健太くん", "", 1, False, False, False), ("NEEDS_AI", "unclear")),
        (("鉄腕", "鉄腕という男", 1, False, False, False), ("ACCEPT", "introduced")), (("鉄腕", "鉄腕って何", 1, False, False, False), ("NEEDS_AI", "unclear")), (("a.b", "axbという", 1, False, False, False), ("NEEDS_AI", "unclear")),
        (("アトム", None, 2, False, False, False), ("ACCEPT", "katakana in episodes")), (("アトム", None, 1, False, False, False), ("NEEDS_AI", "unclear")),
        (("鉄腕", None, 2, False, False, False), ("ACCEPT", "kanji in episodes")), (("国際宇宙局", None, 9, False, False, False), ("NEEDS_AI", "unclear")),
    ],
    "zh": [
        (("啊啊", None, 3, False, None, None), ("REJECT", "non-word")), (("啊", None, 3, False, None, None), ("NEEDS_AI", "single hanzi")), (("山", None, 1, False, None, None), ("REJECT", "lone character")),
        (("今天", None, 9, True, None, None), ("REJECT", "common word")), (("アトム", None, 9, False, None, None), ("REJECT", "kana")), (("小明", None, 2, False, None, None), ("ACCEPT", "hanzi in episodes")),
        (("小明", None, 1, False, None, None), ("NEEDS_AI", "unclear")), (("中华人民共和国", None, 9, False, None, None), ("NEEDS_AI", "unclear")),
    ],
    "en": [
        (("hmmhmm", None, 3, False, None, None), ("REJECT", "non-word")), (("Astro", None, 2, True, None, None), ("REJECT", "common word")), (("Astro", None, 2, False, None, None), ("ACCEPT", "capitalised in episodes")),
        (("Astro", None, 1, False, None, None), ("NEEDS_AI", "capitalised once")), (("Astro Boy", None, 1, False, None, None), ("ACCEPT", "full name")), (("robot", None, 9, False, None, None), ("NEEDS_AI", "unclear")), (("Al", None, 9, False, None, None), ("NEEDS_AI", "unclear")),
    ],
}


@pytest.mark.parametrize("lang", ["ja", "zh", "en"])
def test_candidate_verdicts(spark, lang):
    df = spark.createDataFrame([c for c, _ in CASES[lang]], "t string, c string, n int, common boolean, d boolean, names boolean")
    v = verdicts.candidate_verdict(F.col("t"), F.col("c"), F.col("n"), F.col("common"), lang, F.col("d") if lang == "ja" else None, F.col("names") if lang == "ja" else None)
    assert [tuple(r["v"]) for r in df.select(v.alias("v")).collect()] == [v for _, v in CASES[lang]]


def test_glossary_is_cleaned(spark):
    rows = [
        ("走行", False, "reject", "verb stem"), ("行走", False, "reject", "verb stem"), ("田中", False, "keep", "name"), ("三時間", False, "reject", "time or number"), ("今日", False, "reject", "time or number"),
        ("宇宙時間計画", False, "keep", None), ("全員", False, "reject", "modifier"), ("彼女", False, "reject", "pronoun"), ("東京都", False, "keep", "name"), ("宇宙号", False, "keep", "name"), ("幽霊製造", False, "keep", "name"),
        ("科学", False, "keep", None), ("パパ", True, "reject", "common word"), ("ワンワンワン", True, "reject", "sound"), ("キュッ", True, "reject", "sound"), ("ポカーン", True, "reject", "sound"), ("アハハ", True, "reject", "cry"),
        ("ートム", True, "reject", "fragment"), ("アーサー", True, "keep", None), ("今日", True, "keep", None), ("アハハ", True, None, None), ("ロボット", True, None, None), ("時計", False, "reject", "dictionary"),
    ]
    df = spark.createDataFrame([(i, w, k, 7) for i, (w, k, _, _) in enumerate(rows)], "seq int, word string, katakana boolean, freq int")
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "w string")
    got = verdicts.clean_glossary(df, words("ロボット", "ロボット"), words("時計"))
    assert sorted(tuple(r) for r in got.select("seq", "word", "freq", "verdict", "reason").collect()) == [(i, w, 7, v, r) for i, (w, _, v, r) in enumerate(rows) if v]
    assert verdicts.clean_glossary(df.limit(0), words("x")).count() == 0


def test_append_skips_what_is_there_or_no_name(spark):
    names = ["アトム", "アトム", "猫", "", None, "ワンワン", "ートム", "ロボット", "お茶", "天馬", "abc", "アトム"]
    df = spark.createDataFrame([(i, n, 2) for i, n in enumerate(names)], "seq int, name string, n int")
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "w string")
    got = lambda lang: sorted(tuple(r) for r in verdicts.append_names(df, words("天馬"), words("ロボット"), lang).collect())
    assert got("ja") == [(0, "アトム", 2), (8, "お茶", 2), (10, "abc", 2)]
    assert got("zh") == [(8, "お茶", 2), (10, "abc", 2)]
    assert got("en") == [(10, "abc", 2)]


def test_language_of_a_file(spark):
    rows = [("a", 0, "これは x"), ("b", 0, "Привет abcdef"), ("c", 0, "你好吗 abc"), ("d", 0, "你好 abcdefgh"), ("e", 0, ""), ("f", 0, None), ("g", 0, "plain English")] + [("h", i, "plain" if i < 20 else "これは") for i in range(40)]
    df = spark.createDataFrame(rows, "file string, idx int, text string")
    assert {r["file"]: r["lang"] for r in summary.language_by_share(df, ["file"]).collect()} == {"a": "ja", "b": "ru", "c": "zh", "d": "other", "e": "other", "f": "other", "g": "other", "h": "other"}


def test_neighbours_at_any_distance(spark):
    cues = spark.createDataFrame([("e", 0, 0), ("e", 1, 500), ("e", 2, 1_000_000), ("e", 3, 1_000_900), ("e", 4, 1_001_001), ("e", 5, 9_000_000), ("e", 6, 9_000_000), ("f", 0, 5)], "ep string, idx int, start_ms long")
    clusters = spark.createDataFrame([("e", 1, 1_000_000), ("e", 2, 0), ("e", 3, 9_000_000), ("f", 4, 5), ("g", 5, 5)], "ep string, _id long, start_ms long")
    got = {r["_id"]: (r["before"], r["after"]) for r in review.beside(clusters, cues, ["ep"]).collect()}
    assert got == {1: (1, 4), 2: (None, 2), 3: (4, None), 4: (None, None), 5: (None, None)}


def test_chain_to_a_glossary(spark):
    freqs = spark.createDataFrame([("アトム", 9), ("ア", 9), ("ロボット", 9), ("鉄腕", 5), ("今日", 9), ("天馬", 3), ("猫", 9), ("少", 2), ("ーー", 9), ("abc", 9), ("音楽", 9), ("アトム博士", 4), ("希少", 8)], "term string, freq int")
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "w string")
    dictionary = spark.createDataFrame([("今日", 100), ("天馬", 100), ("希少", 3), ("希少", 4)], "term string, freq int")
    args = (freqs, words("ロボット", "鉄腕", "鉄腕"), words("天馬", "鉄腕"), dictionary, words("音楽"))
    assert {tuple(r) for r in verdicts.glossary_terms(*args, lang="ja").collect()} == {("アトム", 9, "katakana"), ("天馬", 3, "kanji"), ("アトム博士", 4, "kanji")}
    assert {tuple(r) for r in verdicts.glossary_terms(*args, lang="zh").collect()} == {("天馬", 3, "kanji"), ("アトム博士", 4, "kanji"), ("鉄腕", 5, "kanji"), ("希少", 8, "kanji")}


def test_degraded_reports(spark):
    from cueweave.operators import report

    rows = [("EP1", "a.srt", 7, 61_000, "Привет | x"), ("EP1", "a.srt", 3, 1_000, "你好 hello\nyou"), ("EP2", "b.srt", None, None, None), ("EP2", "b.srt", 1, 5, "こんにちは" * 30)]
    got = {r["file"]: r["content"] for r in report.degraded(spark.createDataFrame(rows, "ep string, file string, line int, start_ms long, text string"), "2024-05-01 10:00").collect()}
    assert got["EP1_degraded.md"].split("\n")[4] == "> 乱码总数: 2" and got["EP1_degraded.md"].endswith("| 1 | a.srt | 3 | 00:00:01,000 | 你好 hello you | 双语混合 |\n| 2 | a.srt | 7 | 00:01:01,000 | Привет \\| x | 俄语残留 |\n")
    assert "| 1 | b.srt | ? | ? |  | 纯外语 |\n| 2 | b.srt | 1 | 00:00:00,005 | " + ("こんにちは" * 30)[:60] + " | 日语残留 |\n" in got["EP2_degraded.md"]


def test_visible_texts_and_names(spark):
    from cueweave.sources import subtitles

    ass = "[Events]\nDialogue: 0,0:00:01.50,0:00:02.00,Default,Bob,0,0,0,,{\\i1}Hi\nDialogue: 0,0:00:01.50,0:00:02.00,Sign,,0,0,0,,{\\p1}\nDialogue: 0,0:00:01.50,0:00:02.00,Sign,Bob,0,0,0,,Shop\nComment: 0,0:00:01.50,0:00:02.00,Sign,Eve,0,0,0,,no\n"
    lines = subtitles.parse_ass(spark.createDataFrame([("a.ass", ass)], "file string, content string"))
    assert sorted(r["text"] for r in subtitles.visible_texts(lines).collect()) == ["Hi", "Shop"] and [r["text"] for r in subtitles.visible_texts(lines, ["Sign"]).collect()] == ["Shop"]
    assert [r["name"] for r in subtitles.speaker_names(lines).collect()] == ["Bob"]

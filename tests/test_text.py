import pytest
from pyspark.sql import functions as F

from cueweave.functions import text as T
from cueweave.functions import timecode as C


def values(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def test_garbled(spark):
    assert values(spark, ["こんにちは", "konnichiwa こんにちは", ""], lambda c: T.garbled_type(c, "ja")) == ["clean", "garbled", "clean"]
    assert values(spark, ["你好世界", "こんにちは"], lambda c: T.garbled_type(c, "zh")) == ["clean", "garbled"]
    assert values(spark, ["Hello world", "Привет мир"], lambda c: T.garbled_type(c, "en")) == ["clean", "garbled"]


def test_meaningful(spark):
    assert values(spark, ["行くぞ", "あっ！えーっ！", ""], lambda c: T.meaningful_count(c, "ja")) == [3, 0, 0]
    assert values(spark, ["oh hello there", "um"], lambda c: T.meaningful_count(c, "en")) == [2, 0]
    assert values(spark, ["啊你好", "啊啊"], lambda c: T.meaningful_count(c, "zh")) == [2, 0]


def test_anomaly_names_noise(spark):
    df = spark.createDataFrame([("abc", "x" * 31), ("short", "brief"), ("a", "")], "a string, b string")
    assert [r[0] for r in df.select(T.is_length_anomaly(F.col("a"), F.col("b"))).collect()] == [True, False, False]
    assert values(spark, ["アトム", "あとむ", "日本"], lambda c: T.is_name_shape(c, "ja")) == [True, False, True]
    assert values(spark, ["", "aaaaaa", "ああああああ", "行くぞみんな"], lambda c: T.is_noise(c, "ja")) == [True, True, True, False]
    assert values(spark, ["[音楽]", "音楽", "[Music]"], lambda c: T.is_marker(c, "ja")) == [True, False, False]


def test_script_and_similarity(spark):
    assert values(spark, ["你好", "こんにちは", "Привет", "abc", "123"], T.script) == ["cjk", "kana", "cyrillic", "latin", "unknown"]
    df = spark.createDataFrame([("abc", "abd"), ("", "a"), (" ab ", "ab")], "a string, b string")
    assert [r[0] for r in df.select(T.char_jaccard(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 1.0]


def test_repeats(spark):
    got = values(spark, ["abc" * 9 + "x", "abc" * 7], lambda c: T.repeats(c, 3))
    assert got == [["abc" * 9], []]


def test_episode_numbers(spark):
    names = ["show_064.srt", "a/S01E05.srt", "031 EP.srt", "#193.srt", "第5話.srt", "movie 1080p.srt", "x 1999.ass", "[grp] Show - 12 [1080p][ABCDEF12].mkv", "Episode 7.srt", "1234.srt"]
    assert values(spark, names, T.episode_number) == ["EP064", "EP005", "EP031", "EP193", "EP005", "???", "???", "EP012", "EP007", "EP1234"]
    assert values(spark, ["movie.srt"], T.file_id) == ["movie"]


def test_normalisers(spark):
    assert values(spark, ["アトムー", "アァ"], lambda c: T.normalise(c, "ja", "medium")) == ["アトム", "アア"]
    assert values(spark, ["ガギ"], lambda c: T.normalise(c, "ja", "lenient")) == ["カキ"]
    assert values(spark, ["アスーナ", "キャー", "ヴー"], lambda c: T.normalise(c, "ja", "strict")) == ["アスナ", "キャー", "ヴー"]  # only after listed kana
    assert values(spark, ["nǐ hǎo", "個儿"], lambda c: T.normalise(c, "zh", "lenient", "個", "个")) == ["ni hao", "个"]


@pytest.mark.parametrize(("t", "ms"), [("00:01:23,456", 83456), ("1:00:00.5", 3600500), ("01:02", 62000), ("x", None)])
def test_to_ms(spark, t, ms):
    assert values(spark, [t], lambda c: C.to_ms(c)) == [ms]


def test_times_back(spark):
    df = spark.createDataFrame([(3661500,)], "ms long")
    assert list(df.select(C.srt_time(F.col("ms")), C.ass_time(F.col("ms"))).first()) == ["01:01:01,500", "1:1:01.50"]
    assert values(spark, ["1:1:01.50", "0:00:01.5"], C.ass_to_ms) == [3661500, 1500]

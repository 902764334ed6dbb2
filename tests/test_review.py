from pyspark.sql import functions as F

from cueweave.operators import files, nouns, review, styled, temporal
from cueweave.streaming import incremental


def frame(spark, rows):
    return spark.createDataFrame(rows, "ep string, idx long, start_ms long, end_ms long").withColumn("_id", F.col("idx")).withColumn("seg_idx", F.col("idx"))


def test_align_to_speech(spark):
    clusters = frame(spark, [("a", 0, 0, 5000), ("a", 1, 10_000, 20_000), ("a", 2, 30_000, 31_000)]).withColumn("n_lines", F.lit(2))
    speech = frame(spark, [("a", 0, 1000, 2000), ("a", 1, 11_000, 12_000), ("a", 2, 13_000, 14_000), ("a", 3, 30_900, 31_100)])
    got = sorted((r["_id"], r["line"], r["start_ms"]) for r in review.align_to_speech(clusters, speech, ["ep"]).collect())
    assert got == [(0, 1, 1000), (1, 1, 11_000), (1, 2, 13_000)]


def test_decisions(spark):
    df = spark.createDataFrame(
        [("good", "x", True, 0.0), ("删除", "x", True, 0.0), (None, "some real text", True, 0.0), ("", "some real text", False, 0.0), (None, "some real text", True, 0.7)], "a string, o string, s boolean, n double"
    )
    assert [r[0] for r in df.select(review.decision(F.col("a"), F.col("o"), F.col("s"), F.col("n"), "en")).collect()] == ["replace", "delete", "mark", "cut", "cut"]


def test_apply_recognised_restores_cleared_cues(spark):
    cues = spark.createDataFrame([("f", 0, 0, 10, "a"), ("f", 1, 20, 30, "b"), ("f", 2, 40, 50, "c")], "file string, idx int, start_ms long, end_ms long, text string")
    fix = spark.createDataFrame([("f", 1, 20, 33, "B")], "file string, idx int, start_ms long, end_ms long, replacement string")
    got = review.apply_recognised(cues, fix, cues.filter("idx = 0"), cues.filter("idx = 1"), ["file"])
    assert sorted((r["start_ms"], r["end_ms"], r["text"]) for r in got.collect()) == [(20, 33, "B"), (40, 50, "c")]


def test_styled(spark):
    lines = spark.createDataFrame([("f", 0, "dialogue", "A", "Bob", 0, 0, "hi"), ("f", 1, "dialogue", "B", "Боб", 100, 1, "{\\p1}m 0 0 l 5 Ж"), ("f", 2, "comment", "A", "", 0, 2, "note me")], "file string, line int, kind string, style string, name string, start_ms long, idx int, text string")
    assert styled.bad_drawings(lines).first()["bad"] == ["Ж"]
    assert styled.delete_style(lines, "A").count() == 2 and styled.delete_comments(lines, "note").count() == 2
    assert {r["language"]: r["n"] for r in styled.name_languages(lines).collect()} == {"latin": 1, "cyrillic": 1, "other": 1}
    names = spark.createDataFrame([("Bob", "Rob")], "src string, dst string")
    assert {r["name"] for r in styled.replace_names(lines, names).collect()} == {"Rob", "Боб", ""}
    a, b = (lines.filter(F.col("style") == s).filter("kind = 'dialogue'").withColumn("_id", F.col("line")) for s in "AB")
    assert [(r["text"], r["r_text"][:5]) for r in styled.track_differences(a, b).collect()] == [("hi", "{\\p1}")]
    assert styled.simplified(lines, "h", "H").filter("text = 'Hi'").count() == 1


def test_files(spark, tmp_path):
    s = spark.createDataFrame([("Show 05.srt",), ("movie.srt",), ("x EP1000.srt",)], "file string")
    v = spark.createDataFrame([("b EP005.mkv",), ("a 5.mkv",), ("1000.mp4",)], "file string")
    assert {r["file"]: r["video"] for r in files.match_videos(s, v).collect()} == {"Show 05.srt": "a 5.mkv", "movie.srt": None, "x EP1000.srt": "1000.mp4"}
    eps = spark.createDataFrame([("EP001",), ("EP999",), ("EP1000",), ("???",)], "ep string")
    assert {r["ep"] for r in eps.filter(files.from_episode(F.col("ep"), "EP999")).collect()} == {"EP999", "EP1000"}
    issues = eps.withColumn("text", F.lit("t"))
    files.write_issues(issues, str(tmp_path / "issues"))
    back = files.read_issues(spark, str(tmp_path / "issues"), "text string, ep string")
    assert {r["ep"] for r in back.collect()} == {"EP001", "EP999", "EP1000"}
    g = spark.createDataFrame([("character", "A", 9, [("AA", 2)]), ("character", "B", 5, [])], "category string, canonical string, total_freq long, variants array<struct<word:string,freq:long>>")
    assert files.glossary_markdown(g).first()["section"] == "## character\n\nA | 9 | AA\nB | 5 | "


def test_evenly_sampled_and_frames(spark):
    df = spark.createDataFrame([(f"f{i:02d}",) for i in range(10)], "file string")
    assert sorted(r["file"] for r in temporal.evenly_sampled(df, 3, "file").collect()) == [f"f{int(i * 10 / 3):02d}" for i in range(3)]
    frames = spark.createDataFrame([("a", i * 30, 3 <= i < 20 or i == 25) for i in range(30)], "ep string, start_ms long, voiced boolean")
    assert [(r["start_ms"], r["end_ms"]) for r in temporal.flags_to_segments(frames, ["ep"], "voiced").collect()] == [(90, 600)]


def test_name_context_and_grams(spark):
    df = spark.createDataFrame([("アトムさんが来た", "アトム"), ("アトムが来た", "アトム")], "t string, n string")
    assert [r[0] for r in df.select(nouns.in_name_context(F.col("t"), F.col("n"), "ja")).collect()] == [True, False]
    assert sorted(df.limit(1).select(F.lit("你好吗 ab 好").alias("t")).select(nouns.grams(F.col("t"))).first()[0]) == ["你好", "你好吗", "好吗"]


def test_stream_rates_and_unseen(spark, tmp_path):
    spark.createDataFrame([("e", 0, "hello"), ("e", 0, "again"), ("e", 61_000, "привет")], "ep string, start_ms long, text string").write.parquet(str(tmp_path / "in"))
    stream = incremental.cue_stream(spark, str(tmp_path / "in"), "ep string, start_ms long, text string")
    for name, df in (("rates", incremental.garbled_rates(stream)), ("unseen", incremental.unseen(stream))):
        df.writeStream.format("memory").queryName(name).outputMode("complete" if name == "rates" else "append").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["n"], r["n_garbled"]) for r in spark.table("rates").collect()) == [(1, 1), (2, 0)]
    assert spark.table("unseen").count() == 2

from pyspark.sql import functions as F

from cueweave.sources import providers, subtitles, tables
from cueweave.streaming import incremental

SRT = "1\n00:00:01,000 --> 00:00:05,000\nHello <i>world</i>\nline two\n\nx\n2\n00:00:06.5 --> 00:00:07.000\nbad time\n\n3\n00:00:11,00 --> 00:00:15,000\n你好\n4\n00:00:20,000 --> 00:00:21,000\nswallowed\n\n5\n00:00:30,000 --> 00:00:31,000\n\n"
ASS = "[Events]\nFormat: Layer\nDialogue: 0,0:00:01.50,0:00:02.00,Default,Bob,0,0,0,,Hi, <b>there</b>\\Nyou\nComment: 0,0:00:03.00,0:00:04.00,Default,,0,0,0,,note\nDialogue: short\n"


def test_srt(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "show_01.srt").write_bytes(b"\xef\xbb\xbf" + SRT.encode())
    (src / "ru.SRT").write_bytes("1\r\n00:00:01,000 --> 00:00:02,000\r\nПривет\r\n".encode("cp1251"))
    (src / "empty.srt").write_bytes(b"")
    (src / "show_02.ass").write_text(ASS)
    cues = subtitles.read_subtitles(spark, str(src))
    rows = {f: [(r["idx"], r["start_line"], r["srt_index"], r["start_ms"], r["end_ms"], r["text"]) for r in cues.filter(F.col("file") == f).orderBy("idx").collect()] for f in ("show_01.srt", "ru.SRT", "empty.srt", "show_02.ass")}
    assert rows["show_01.srt"] == [(0, 0, 1, 1000, 5000, "Hello <i>world</i>\nline two"), (1, 10, 3, 11000, 15000, "你好\n4\n00:00:20,000 --> 00:00:21,000\nswallowed"), (2, 17, 5, 30000, 31000, "")]
    assert rows["ru.SRT"] == [(0, 0, 1, 1000, 2000, "Привет")]
    assert rows["empty.srt"] == []
    assert [r[5] for r in rows["show_02.ass"]] == ["Hi, there\\Nyou"]
    assert {r["ep"] for r in cues.collect()} == {"EP001", "ru", "EP002"}
    back = subtitles.parse_srt(subtitles.render_srt(cues.filter("file = 'show_01.srt'")))
    assert [r["text"].split("\n")[0] for r in back.orderBy("idx").collect()] == ["Hello <i>world</i>", "你好", ""]
    out = str(tmp_path / "out")
    subtitles.write_text(subtitles.render_srt(cues.filter("file != 'show_02.ass'")), out)
    assert spark.read.text(out).count() > 3
    assert tuple(subtitles.formats(subtitles.read_files(spark, str(src))).first()) == (2, 1, "mixed")  # Spark reads no files without bytes


def test_ass_round_trip(spark):
    lines = subtitles.parse_ass(spark.createDataFrame([("a.ass", ASS)], "file string, content string"))
    assert [r["kind"] for r in lines.orderBy("line").collect()] == ["other", "other", "dialogue", "comment", "other", "other"]
    cues = subtitles.ass_cues(lines).withColumn("text", F.lit("new\ntext"))
    got = subtitles.render_ass(lines, cues).first()["content"].split("\n")
    assert got[2] == "Dialogue: 0,0:00:01.50,0:00:02.00,Default,Bob,0,0,0,,new\\Ntext" and got[3].startswith("Comment: 0,")
    assert subtitles.ass_cues(lines, styles=["Other"]).count() == 0
    assert [tuple(r) for r in subtitles.ass_statistics(lines, "name").collect()] == [("Bob", 1, 1, "Hi, there\\Nyou")]


def test_markdown_and_answers(spark):
    md = "# L2\n\n| ep | text |\n| --- | --- |\n| EP1 | a\\|b |\n\n## L3\n| h |\n|---|\n| x |\n"
    rows = tables.markdown_rows(subtitles.lines_of(spark.createDataFrame([("r.md", md)], "file string, content string")))
    assert [(r["section"], r["cells"]) for r in rows.orderBy("line").collect()] == [("L2", ["EP1", "a|b"]), ("L3", ["x"])]
    assert tables.parse_answer('```json\n["a", "b",]\n```') == ["a", "b"]
    assert tables.parse_answer('["a", "b') == ["a"] and tables.parse_answer('[{"zh": "x"}]') == ["x"] and tables.parse_answer("no") is None


def test_asr_json(spark):
    raw = spark.createDataFrame([("e", '{"segments":[{"start":1.5,"end":2,"text":" hi ","avg_logprob":-0.2}]}'), ("f", '{"transcription":[{"offsets":{"from":10,"to":20},"text":"x"}]}')], "ep string, value string")
    got = {r["ep"]: (r["start_ms"], r["end_ms"], r["text"], r["no_speech_prob"]) for r in tables.asr_segments(raw).collect()}
    assert got == {"e": (1500, 2000, "hi", -1.0), "f": (10, 20, "x", -1.0)}


def test_violations(spark):
    df = spark.createDataFrame([("a", "1"), (None, "x"), ("c", "2")], "k string, n string")
    got = sorted((r["column"], r["rule"]) for r in tables.violations(df, {"k": "string", "n": "int"}, {"k": ["a", "b"]}).collect())
    assert got == [("k", "enum"), ("k", "required"), ("n", "type int")]


def test_providers(spark):
    cues = spark.createDataFrame([("f", i, t) for i, t in enumerate(["a", "b", "c"])], "file string, idx int, text string")
    from cueweave.operators.temporal import batches

    asked = providers.translation_prompts(batches(cues, ["file"], 2, 1), "German")
    answered = providers.ask(asked, lambda: lambda ps: ['["x", "y"]'] * len(ps))
    assert [r["text"] for r in providers.merge_answers(cues, answered, ["file"], 2).orderBy("idx").collect()] == ["x", "y", "x"]
    replayed = providers.replay(asked, answered.select("prompt", "answer"))
    assert replayed.filter("answer is null").count() == 0


def test_streams(spark, tmp_path):
    cues = spark.createDataFrame([("e", 0, 1000, True), ("e", 1000, 2000, True), ("e", 900_000, 901_000, True), ("e", 5000, 6000, False)], "ep string, start_ms long, end_ms long, is_garbled boolean")
    cues.write.parquet(str(tmp_path / "in"))
    stream = incremental.cue_stream(spark, str(tmp_path / "in"), "ep string, start_ms long, end_ms long, is_garbled boolean")
    q = incremental.session_clusters(stream).writeStream.format("memory").queryName("clusters").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["start_ms"], r["n"]) for r in spark.table("clusters").collect()) == [(0, 2), (900_000, 1)]


def test_report_stream(spark, tmp_path):
    schema = "layer string, ep string, time string, original string, corrected string, status string"
    spark.createDataFrame([("2", "E", "1", "a", "b", "✅")], schema).write.parquet(str(tmp_path / "in"))
    for rows in ([("2", "E", "1", "a", "", "⬜")], [("2", "E", "2", "c", "", "⬜")]):
        incremental.merge_into_report(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
    incremental.merge_into_report(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    n = max(i for i in range(5) if incremental.snapshot(spark, str(tmp_path / "out"), i) is not None)
    assert {(r["time"], r["status"]) for r in incremental.snapshot(spark, str(tmp_path / "out"), n).collect()} == {("1", "✅"), ("2", "⬜")}

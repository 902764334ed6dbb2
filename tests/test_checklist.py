"""A checklist goes out, is filled in and comes back."""

from cueweave.functions import lexicon as lex
from cueweave.functions import text
from cueweave.operators import checklist
from cueweave.sources import sinks, subtitles
from pyspark.sql import functions as F

ITEMS = "ep string, start_ms long, end_ms long, texts array<string>, left_text string, right_text string, clip string"
CUES = "ep string, idx int, start_ms long, end_ms long, text string"


def test_round_trip(spark, tmp_path):
    items = [("EP001", 61_500, 63_000, ["garbled\none", "two"], "what came\nbefore", None, "c.mp4"), ("EP001", 5_000, 6_000, [], "", "after", None), ("EP001", 90_000, 91_000, None, None, None, None), ("EP002", 1_000, 2_000, ["x"], None, None, None)]
    out = checklist.render(spark.createDataFrame(items, ITEMS), "2024-05-01")
    sinks.write_files(out, str(tmp_path / "lists"))
    one = (tmp_path / "lists" / "EP001_checklist.md").read_text()
    assert one.startswith("# 人工审查清单 — EP001\n> 导出: 2024-05-01\n> 共 3 条待审查\n") and "残留: garbled one | two\n" in one and "上文: what came before\n下文" not in one
    assert one.index("00:00:05,000") < one.index("00:01:01,500") < one.index("00:01:30,000")
    parts = one.split("修正:")
    (tmp_path / "lists" / "EP001_checklist.md").write_text(parts[0] + "修正: 删除" + parts[1] + "修正: new\nlines" + parts[2] + "修正:" + parts[3])
    two = (tmp_path / "lists" / "EP002_checklist.md").read_text()
    (tmp_path / "lists" / "EP002_checklist.md").write_text(two.replace("修正:", "修正:\nbelow the mark"))
    files = spark.read.format("binaryFile").load(str(tmp_path / "lists")).select(F.regexp_extract("path", "([^/]*)$", 1).alias("file"), F.decode("content", "UTF-8").alias("content"))
    said = checklist.answers(subtitles.lines_of(files))
    assert sorted(tuple(r)[1:] for r in said.collect()) == [("EP001", 5_000, "删除"), ("EP001", 61_500, "new\nlines"), ("EP002", 1_000, "below the mark")]

    cues = spark.createDataFrame([("EP001", 0, 5_000, 6_000, "a"), ("EP001", 1, 5_000, 6_000, "b"), ("EP001", 2, 61_500, 63_000, "c"), ("EP001", 3, 90_000, 91_000, "d"), ("EP003", 0, 1_000, 2_000, "e")], CUES)
    aligned = spark.createDataFrame([("EP001", 61_500, 61_700, 62_800)], "ep string, at_ms long, start_ms long, end_ms long")
    left, outcomes = checklist.apply_answers(cues, said, aligned)
    assert sorted(map(tuple, left.collect())) == [("EP001", 1, 5_000, 6_000, "b"), ("EP001", 2, 61_700, 62_800, "new\nlines"), ("EP001", 3, 90_000, 91_000, "d"), ("EP003", 0, 1_000, 2_000, "e")]
    assert sorted(map(tuple, outcomes.collect())) == [("EP001", 5_000, "deleted"), ("EP001", 61_500, "aligned"), ("EP002", 1_000, "missing")]
    left, outcomes = checklist.apply_answers(cues, said)
    assert ("EP001", 2, 61_500, 63_000, "new\nlines") in set(map(tuple, left.collect())) and {r["outcome"] for r in outcomes.collect()} == {"deleted", "replaced", "missing"}


def test_answers_of_odd_lists(spark):
    rows = [("a", "no entry\n修正: lost\n---\nE | 00:00:01,000 ~ ?\n修正: first\n---\nE | 00:00:01.000 ~ ?\n修正: second\n---\nF | 1:00:00,5 ~ ?\nno mark\n---\n"), ("b", None), ("c", "")]
    lines = subtitles.lines_of(spark.createDataFrame(rows, "file string, content string"))
    assert [tuple(r) for r in checklist.answers(lines).collect()] == [("a", "E", 1_000, "second")]
    assert checklist.answers(lines.limit(0)).count() == 0


def test_markers_and_costs(spark):
    files = spark.createDataFrame([("a", "x [???] y [???]"), ("b", "[?]"), ("c", None), ("d", "[???]")], "file string, content string")
    assert {r["file"]: r["n"] for r in checklist.markers(files).collect()} == {"a": 2, "d": 1}
    done = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", None)] * 10, "text string, polished string")
    assert tuple(checklist.polish_summary(done, 10, 0.27, 1.10).first()) == (30, 10, 10, 4, round(4 * (800 * 0.27 + 200 * 1.10) / 1e6, 6))
    assert tuple(checklist.polish_summary(done.limit(0), 10, 0.27, 1.10).first())[:4] == (0, 0, 0, 0)


def test_natural_chinese(spark):
    cases = {
        "他进行了调查": ("他调查了", 1), "给予帮助": ("给帮助", 1), "她的老师和他的狗": ("她老师和他的狗", 1), "对于你来说": ("对你来说", 1), "当我的时候": ("我...的时候", 1), "是否知道": ("知道吗", 1),
        "如何解决": ("怎么解决", 1), "非常地好": ("非常好", 1), "正在看着": ("在看", 1), "他的重要性": ("他很重要", 1), "具有代表性": ("很代表", 1), "你好": ("你好", 0), "": ("", 0),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: tuple(r["x"]) for r in df.select("t", text.natural_zh(F.col("t")).alias("x")).collect()} == cases
    assert len(lex.NATURAL_ZH) == 15

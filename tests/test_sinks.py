"""Files as they are written, byte for byte, and reports that are merged bucket by bucket."""

import os

import pytest
from pyspark.sql import functions as F

from cueweave.sources import sinks, subtitles
from cueweave.streaming import incremental


def there(folder):
    return {n: (folder / n).read_bytes() for n in os.listdir(folder)} if folder.exists() else {}


def test_srt_files_have_the_expected_bytes(spark, tmp_path):
    cues = spark.createDataFrame([("b c.srt", 1, 2500, 3000, "zwei\ndrei"), ("b c.srt", 0, 0, 1500, "こんにちは"), ("a.srt", 0, 3_600_000, 3_600_001, "")], "file string, idx int, start_ms long, end_ms long, text string")
    out = tmp_path / "out"
    sinks.write_files(subtitles.render_srt(cues), str(out), bom=True)
    assert there(out) == {
        "b c.srt": b"\xef\xbb\xbf" + "1\n00:00:00,000 --> 00:00:01,500\nこんにちは\n\n2\n00:00:02,500 --> 00:00:03,000\nzwei\ndrei\n".encode(),
        "a.srt": b"\xef\xbb\xbf1\n01:00:00,000 --> 01:00:00,001\n\n",
    }
    back = subtitles.read_subtitles(spark, str(out)).filter("file = 'b c.srt'").orderBy("idx").collect()
    assert [(r["start_ms"], r["text"]) for r in back] == [(0, "こんにちは"), (2500, "zwei\ndrei")]


def test_append_replaces_by_name_and_overwrite_clears(spark, tmp_path):
    files = lambda *rows: spark.createDataFrame(list(rows), "file string, content string").repartition(3)
    out = tmp_path / "out"
    sinks.write_files(files(("a", "1"), ("b", None), ("c", "3")), str(out))
    assert there(out) == {"a": b"1", "b": b"", "c": b"3"}
    sinks.write_files(files(("b", "two"), ("d", "4")), f"file://{out}")
    assert there(out) == {"a": b"1", "b": b"two", "c": b"3", "d": b"4"}
    sinks.write_files(files(("d", "5")), str(out), mode="overwrite")
    assert there(out) == {"d": b"5"}
    sinks.write_files(files(("x", "y")).limit(0), str(out))
    assert there(out) == {"d": b"5"}


def test_a_failed_job_leaves_the_folder_as_it_was(spark, tmp_path):
    out = tmp_path / "out"
    sinks.write_files(spark.createDataFrame([("a", "1")], "file string, content string"), str(out))
    for bad in ([("b", "2"), ("../c", "3")], [("b", "2"), ("b", "3")], [("b", "2"), ("", "3")], [("b", "2"), (None, "3")]):
        with pytest.raises(Exception):  # noqa: B017
            sinks.write_files(spark.createDataFrame(bad, "file string, content string").repartition(2), str(out), mode="overwrite")
        assert there(out) == {"a": b"1"}


def test_new_ass_files(spark, tmp_path):
    cues = spark.createDataFrame([("a.ass", 1, 61_230, 62_000, "two\nlines"), ("a.ass", 0, 0, 1500, "one, more"), ("b.ass", 0, 0, 10, "x")], "file string, idx int, start_ms long, end_ms long, text string")
    old = spark.createDataFrame([("b.ass", "[Script Info]\nTitle: B\n\n[Events]\nFormat: Layer\nDialogue: 0,0:00:00.00,0:00:01.00,Default,,0,0,0,,old\n")], "file string, content string")
    template = sinks.ass_heads(subtitles.parse_ass(old))
    sinks.write_files(sinks.new_ass(cues, template), str(tmp_path / "out"), bom=True)
    got = there(tmp_path / "out")
    assert got["b.ass"] == b"\xef\xbb\xbf[Script Info]\nTitle: B\n\n[Events]\nFormat: Layer\nDialogue: 0,0:0:00.00,0:0:00.01,Default,,0,0,0,,x\n"
    assert got["a.ass"].decode("utf-8-sig") == sinks.ASS_HEAD + "Dialogue: 0,0:0:00.00,0:0:01.50,Default,,0,0,0,,one, more\nDialogue: 0,0:1:01.23,0:1:02.00,Default,,0,0,0,,two\\Nlines\n"
    back = subtitles.ass_cues(subtitles.parse_ass(subtitles.decoded(subtitles.read_files(spark, str(tmp_path / "out"))))).filter("file = 'a.ass'")
    assert [(r["start_ms"], r["text"]) for r in back.orderBy("idx").collect()] == [(0, "one, more"), (61_230, "two\\Nlines")]


SCHEMA = "layer string, ep string, time string, original string, corrected string, status string"


def size_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    out = str(tmp_path / "report")
    rows = [("2", f"EP{i % 40}", str(i), f"o{i}", "", "⬜") for i in range(2000)]
    incremental.merge_batch(spark.createDataFrame(rows, SCHEMA), out, 0, 64)
    first = size_of(f"{out}/rows")
    incremental.merge_batch(spark.createDataFrame([("2", "EP7", "7", "o7", "fixed", "✅"), ("2", "EP1", "9999", "new", "", "⬜")], SCHEMA), out, 1, 64)
    assert size_of(f"{out}/rows") - first < 0.25 * first
    state = incremental.snapshot(spark, out, 1)
    assert state.count() == 2001 and {tuple(r)[3:] for r in state.filter("time in ('7', '9999')").collect()} == {("o7", "fixed", "✅"), ("new", "", "⬜")}
    assert incremental.snapshot(spark, out, 0).count() == 2000
    # a replay of the batch, then a lower status, which changes nothing
    incremental.merge_batch(spark.createDataFrame([("2", "EP7", "7", "o7", "fixed", "✅"), ("2", "EP1", "9999", "new", "", "⬜")], SCHEMA), out, 1, 64)
    incremental.merge_batch(spark.createDataFrame([("2", "EP7", "7", "o7", "", "⬜"), ("3", "EP7", "7", "o7", "", "⬜")], SCHEMA), out, 2, 64)
    state = incremental.snapshot(spark, out, 9)
    assert state.count() == 2001 and [tuple(r)[4:] for r in state.filter("time = '7'").collect()] == [("fixed", "✅")]
    assert incremental.snapshot(spark, str(tmp_path / "none"), 3) is None


def test_buckets_give_what_one_table_gives(spark, tmp_path):
    from cueweave.operators import report

    batches = [[(str(i % 3), f"EP{i % 5}", str(i % 11), f"o{i}", "c" if i % 2 else "", ["✅", "🗑️", "⬜"][(i * k) % 3]) for i in range(60)] for k in (1, 2, 4)]
    whole = spark.createDataFrame([], SCHEMA)
    for n, rows in enumerate(batches):
        incremental.merge_batch(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "r"), n, 8)
        whole = report.merge(whole, spark.createDataFrame(rows, SCHEMA))
    cols = [F.col(c) for c in ("layer", "ep", "time", "original", "corrected", "status")]
    assert sorted(map(tuple, incremental.snapshot(spark, str(tmp_path / "r"), 2).select(*cols).collect())) == sorted(map(tuple, whole.select(*cols).collect()))

"""A second run takes changed files only."""

import os

from cueweave.sources import subtitles, watched


def test_changed_files_come_again(spark, tmp_path):
    folder, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    folder.mkdir()

    def put(name, text, at):
        (folder / name).write_text(text)
        os.utime(folder / name, (at, at))

    def run():
        q = watched.watch(spark, str(folder), 40).writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start()
        q.awaitTermination()
        q.exception()
        return sorted((r["file"], bytes(r["raw"]).decode()) for r in spark.read.parquet(out).collect())

    put("a.srt", "1\n00:00:01,000 --> 00:00:02,000\nhello\n", 1_000)
    put("b.ass", "[Events]", 1_001)
    put("notes.txt", "no", 1_002)
    first = run()
    assert [n for n, _ in first] == ["a.srt", "b.ass"]
    assert run() == first
    put("a.srt", "1\n00:00:01,000 --> 00:00:02,000\nchanged\n", 1_010)
    put("c.SRT", "", 1_011)
    assert [n for n, _ in run()] == ["a.srt", "a.srt", "b.ass", "c.SRT"]
    files = spark.read.parquet(out).filter("format = 'srt' and mtime_ns > 1005000000000").select("file", "format", "raw")
    assert [r["text"] for r in subtitles.parse_srt(subtitles.decoded(files)).collect()] == ["changed"]


def test_partitions_hold_about_as_many_bytes(tmp_path):
    for k, n in enumerate((10, 60, 30, 30, 5)):
        (tmp_path / f"f{k}.srt").write_text("x" * n)
        os.utime(tmp_path / f"f{k}.srt", (k, k))
    reader = watched.ChangedFiles({"path": f"file://{tmp_path}", "partitionbytes": "60"})
    assert reader.latestOffset() == {"newest": 4_000_000_000}
    names = lambda parts: [[p.rsplit("/", 1)[1][:2] for p, _ in g.paths] for g in parts]
    assert names(reader.partitions({"newest": -1}, {"newest": 4_000_000_000})) == [["f1"], ["f2", "f3"], ["f0", "f4"]]
    assert names(reader.partitions({"newest": 1_000_000_000}, {"newest": 3_000_000_000})) == [["f2", "f3"]]
    assert watched.ChangedFiles({"path": str(tmp_path / "none")}).latestOffset() == {"newest": -1}

"""Subtitle files: SRT and ASS in and out. Files are rows of bytes; lines are rows; parsing is windows over lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.functions.timecode import ass_time, ass_to_ms, srt_time, to_ms
from cueweave.operators.oped import exempt

ENCODINGS = ("utf-8-sig", "utf-8", "cp1251", "koi8-r", "shift-jis", "gbk")  # the first that decodes a file counts
TIMES = "^\\s*(\\d{1,2}:\\d{2}:\\d{2}[,.]\\d{2,3})\\s*-->\\s*(\\d{1,2}:\\d{2}:\\d{2}[,.]\\d{2,3})"
ASS_FIELDS = ("layer", "start", "end", "style", "name", "margin_l", "margin_r", "margin_v", "effect", "text")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """file (name), format (srt or ass), raw of all subtitle files in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{srt,SRT,ass,ASS}").load(folder)
    name = F.url_decode(F.regexp_extract("path", "([^/]*)$", 1))
    return files.select(name.alias("file"), F.lower(F.regexp_extract("path", "\\.([^.]*)$", 1)).alias("format"), F.col("content").alias("raw"))


def decoded(files: DataFrame, encodings: tuple[str, ...] = ENCODINGS) -> DataFrame:
    """Adds content (text) and encoding of raw bytes, by the first encoding that fits."""

    @F.pandas_udf("content string, encoding string")
    def decode(raw: pd.Series) -> pd.DataFrame:
        def one(b: bytes) -> tuple[str | None, str | None]:
            for e in encodings:
                try:
                    return b.decode(e), e
                except UnicodeDecodeError:
                    pass
            return b.decode("utf-8", "replace"), None

        return pd.DataFrame([one(b) for b in raw], columns=["content", "encoding"])

    return files.withColumn("_d", decode("raw")).select("*", "_d.*").drop("_d", "raw")


def format_by_content(files: DataFrame) -> DataFrame:
    """Adds by_content of files (file, content) from their first 20 lines: ass for a section head or a dialogue line, srt for a
    time line, else null."""
    head = F.slice(F.split(F.regexp_replace("content", "\\r\\n?", "\n"), "\n"), 1, 20)
    ass = F.exists(head, lambda s: s.rlike("^\\uFEFF?\\[(?:Script Info|V4\\+? Styles|Events)\\]|^Dialogue:"))
    return files.withColumn("by_content", F.when(ass, "ass").when(F.exists(head, lambda s: s.rlike(TIMES)), "srt"))


def lines_of(files: DataFrame) -> DataFrame:
    """file, line (from 0), s."""
    clean = F.regexp_replace(F.regexp_replace("content", "^\\uFEFF", ""), "\\r\\n?", "\n")
    return files.select("file", F.posexplode(F.split(clean, "\n")).alias("line", "s"))


def parse_srt(files: DataFrame) -> DataFrame:
    """Cues of SRT files (file, content). In each block between blank lines the first index line that a time line follows
    opens a cue, and the rest of the block is its text; what comes before is skipped, so a damaged block costs only itself."""
    w = Window.partitionBy("file").orderBy("line")
    rows = lines_of(files).withColumn("_blank", F.when(text.strip(F.col("s")) == "", 1).otherwise(0)).withColumn("_block", F.sum("_blank").over(w)).filter("_blank = 0")
    inside = Window.partitionBy("file", "_block").orderBy("line")
    head = F.col("s").rlike(TIMES) & F.coalesce(F.lag("s").over(inside).rlike("^\\s*\\d{1,6}\\s*$"), F.lit(False))
    rows = rows.withColumn("_index", F.lag("s").over(inside)).withColumn("_at", F.min(F.when(head, F.col("line"))).over(inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    blocks = rows.filter("line >= _at").groupBy("file", "_block").agg(
        F.min("_at").alias("_at"), F.min_by("s", "line").alias("_times"), F.min_by("_index", "line").alias("_index"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("line") > F.col("_at"), F.struct("line", "s")))), lambda x: text.strip(x["s"])).alias("_text"),
    )
    return blocks.select(
        "file", text.file_id(F.col("file")).alias("ep"), (F.row_number().over(Window.partitionBy("file").orderBy("_at")) - 1).alias("idx"), (F.col("_at") - 1).alias("start_line"),
        F.trim("_index").cast("int").alias("srt_index"), to_ms(F.regexp_extract("_times", TIMES, 1)).alias("start_ms"), to_ms(F.regexp_extract("_times", TIMES, 2)).alias("end_ms"), F.array_join("_text", "\n").alias("text"),
    )


def parse_ass(files: DataFrame) -> DataFrame:
    """All lines of ASS files: kind dialogue, comment or other, and the ten fields of the first two."""
    rows = lines_of(files)
    kind = F.when(F.col("s").startswith("Dialogue:"), "dialogue").when(F.col("s").startswith("Comment:"), "comment")
    fields = F.split(F.regexp_replace("s", "^(?:Dialogue|Comment):\\s*", ""), ",", 10)
    rows = rows.withColumn("_f", fields).withColumn("kind", F.when(F.size("_f") == 10, kind))
    cols = [F.when(F.col("kind").isNotNull(), F.trim(F.get("_f", F.lit(i))) if n != "text" else F.get("_f", F.lit(i))).alias(n) for i, n in enumerate(ASS_FIELDS)]
    return rows.select("file", "line", F.coalesce("kind", F.lit("other")).alias("kind"), "s", *cols)


def ass_cues(ass: DataFrame, styles: list[str] | None = None, legacy: bool = False) -> DataFrame:
    """Cues of dialogue lines. legacy also strips {...}, turns \\N into a space and drops empty texts."""
    rows = ass.filter("kind = 'dialogue'")
    rows = rows.filter(F.col("style").isin(styles)) if styles else rows
    t = text.strip_ass_tags(F.regexp_replace("text", "\\\\[Nn]", " ")) if legacy else text.strip_tags(F.col("text"))
    cues = rows.select("file", text.file_id(F.col("file")).alias("ep"), F.col("line").alias("start_line"), ass_to_ms(F.col("start")).alias("start_ms"), ass_to_ms(F.col("end")).alias("end_ms"), text.strip(t).alias("text"))
    cues = cues.filter("text != ''") if legacy else cues
    return cues.withColumn("idx", F.row_number().over(Window.partitionBy("file").orderBy("start_line")) - 1).withColumn("srt_index", F.col("idx") + 1)


def with_garbled(cues: DataFrame, lang: str = "ja", exempt_oped: bool = True) -> DataFrame:
    """Marks garbled cues; those of openings and endings of SRT files are exempt."""
    marked = cues.withColumn("is_garbled", text.is_garbled(F.col("text"), lang)).withColumn("garbled_type", text.garbled_type(F.col("text"), lang))
    return exempt(marked, ["file"]) if exempt_oped else marked


def read_subtitles(spark: SparkSession, folder: str, lang: str = "ja") -> DataFrame:
    """Cues of all SRT and ASS files of a folder."""
    files = decoded(read_files(spark, folder))
    srt = with_garbled(parse_srt(files.filter("format = 'srt'")), lang)
    ass = with_garbled(ass_cues(parse_ass(files.filter("format = 'ass'"))), lang, exempt_oped=False)  # the older reader exempts these too: ass_cues(legacy=True), then with_garbled
    return srt.unionByName(ass)


def render_srt(cues: DataFrame) -> DataFrame:
    """file, content: cues in order, numbered from 1."""
    n = F.row_number().over(Window.partitionBy("file").orderBy("start_ms", "idx"))
    one = F.concat_ws("\n", n.cast("string"), F.concat(srt_time(F.col("start_ms")), F.lit(" --> "), srt_time(F.col("end_ms"))), F.col("text"))
    rows = cues.select("file", n.alias("_n"), one.alias("_one"))
    return rows.groupBy("file").agg((F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_n", "_one"))), lambda x: x["_one"]), "\n\n")).alias("content")).withColumn("content", F.concat("content", F.lit("\n")))


def render_ass(ass: DataFrame, cues: DataFrame) -> DataFrame:
    """file, content: the lines of ASS files with the texts of changed cues (by file and start_line); other lines stay."""
    new = cues.select("file", F.col("start_line").alias("line"), F.replace("text", F.lit("\n"), F.lit("\\N")).alias("_new"), ass_time(F.col("start_ms")).alias("_start"))
    joined = ass.join(new, ["file", "line"], "left")
    kept = F.concat_ws(",", *[F.col(c) for c in ASS_FIELDS[:-1]], F.col("_new"))
    prefix = F.when(F.col("kind") == "dialogue", F.lit("Dialogue: ")).otherwise(F.lit("Comment: "))
    line = F.when(F.col("_new").isNotNull() & (F.col("kind") != "other"), F.concat(prefix, kept)).otherwise(F.col("s"))
    return joined.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", line.alias("v")))), lambda x: x["v"]), "\n").alias("content"))


def write_text(rendered: DataFrame, folder: str) -> None:
    """One folder a file below `folder`, written by Spark, so that it works on any store."""
    rendered.write.partitionBy("file").mode("overwrite").text(folder)


def formats(files: DataFrame) -> DataFrame:
    """Counts by format and the primary one: srt, ass, mixed, or null without files."""
    c = files.agg(F.count_if(F.col("format") == "srt").alias("n_srt"), F.count_if(F.col("format") == "ass").alias("n_ass"))
    return c.withColumn("primary", F.when((F.col("n_srt") > 0) & (F.col("n_ass") > 0), "mixed").when(F.col("n_srt") > 0, "srt").when(F.col("n_ass") > 0, "ass"))


def visible_texts(ass: DataFrame, styles: list[str] | None = None) -> DataFrame:
    """file, line, text of dialogue lines (of these styles, if any are given) that show something, without tags."""
    rows = ass.filter("kind = 'dialogue'")
    rows = rows.filter(F.col("style").isin(styles)) if styles else rows
    return rows.select("file", "line", text.strip_ass_tags(F.col("text")).alias("text")).filter(text.strip(F.col("text")) != "")


def speaker_names(ass: DataFrame) -> DataFrame:
    """The distinct names of dialogue lines."""
    return ass.filter("kind = 'dialogue' and name != ''").select("name").distinct()


def ass_statistics(ass: DataFrame, by: str = "style", shown: int | None = 30) -> DataFrame:
    """Dialogue lines by style or name: n, n_files, and the first `shown` characters (None: all) of the first text that is not empty."""
    t = text.strip_ass_tags(F.col("text"))
    return ass.filter("kind = 'dialogue'").groupBy(by).agg(
        F.count("*").alias("n"), F.countDistinct("file").alias("n_files"), F.min_by(F.when(t != "", t if shown is None else F.substring(t, 1, shown)), F.when(t != "", F.struct("file", "line"))).alias("sample")
    )

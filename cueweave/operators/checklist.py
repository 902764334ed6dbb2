"""Checklists for people: stretches that need an ear go out as Markdown, filled-in answers come back as decisions on cues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.functions.timecode import srt_time, to_ms

# fixed values: the words of the checklist format
HEAD, DUE, COUNT, SOURCE, BEFORE, LEFT, AFTER, CLIP, ANSWER = "# 人工审查清单 — ", "> 导出: ", "> 共 ", "来源: ", "上文: ", "残留: ", "下文: ", "片段: ", "修正:"
NOTHING, DELETE, END = "(无)", "删除", "---"
_TIME = "\\d{1,2}:\\d{2}:\\d{2}[,.]\\d{1,3}"


def file_name(ep: Column) -> Column:
    return F.concat(ep, F.lit("_checklist.md"))


def render(items: DataFrame, day: str, source: str = "Whisper unfixable") -> DataFrame:
    """file, content: one Markdown checklist an episode from items (ep, start_ms, end_ms, texts, left_text, right_text, clip), in order
    of time. Nulls and empty texts are shown as nothing; line breaks in texts become spaces, so that an entry keeps its lines."""
    flat = lambda c: F.regexp_replace(c, "\\s*[\\r\\n]+\\s*", " ")
    shown = lambda c: F.when(F.coalesce(text.strip(F.col(c)), F.lit("")) == "", F.lit(NOTHING)).otherwise(flat(F.col(c)))
    entry = F.concat_ws(
        "\n", F.concat(F.col("ep"), F.lit(" | "), srt_time(F.col("start_ms")), F.lit(" ~ "), srt_time(F.col("end_ms"))), F.concat(F.lit(SOURCE), F.lit(source)), F.concat(F.lit(BEFORE), shown("left_text")),
        F.concat(F.lit(LEFT), flat(F.array_join(F.coalesce("texts", F.array().cast("array<string>")), " | "))), F.concat(F.lit(AFTER), shown("right_text")), F.concat(F.lit(CLIP), shown("clip")), F.lit(ANSWER), F.lit(""), F.lit(END),
    )
    per = items.groupBy("ep").agg(F.sort_array(F.collect_list(F.struct("start_ms", "end_ms", entry.alias("entry")))).alias("l"))
    head = F.concat(F.lit(HEAD), F.col("ep"), F.lit(f"\n{DUE}{day}\n{COUNT}"), F.size("l").cast("string"), F.lit(f" 条待审查\n> version: 2\n>\n{END}\n\n"))
    return per.select(file_name(F.col("ep")).alias("file"), F.concat(head, F.array_join(F.transform("l", lambda x: x["entry"]), "\n"), F.lit("\n")).alias("content"))


def answers(lines: DataFrame) -> DataFrame:
    """file, ep, start_ms, answer of the filled-in entries of checklists (file, line, s). The answer is what follows its mark up to the
    entry's end, over several lines too; entries that are left empty give no row, of two for one time the later one counts."""
    w = Window.partitionBy("file").orderBy("line")
    cut = lines.withColumn("_part", F.sum(F.when(F.trim("s") == END, 1).otherwise(0)).over(w)).filter(F.trim("s") != END)
    inside = Window.partitionBy("file", "_part").orderBy("line")
    title = F.regexp_extract("s", f"^\\s*(.+?)\\s*\\|\\s*({_TIME})\\s*~", 1)
    time = F.regexp_extract("s", f"^\\s*.+?\\s*\\|\\s*({_TIME})\\s*~", 1)
    rows = cut.withColumn("_ep", F.first(F.when(title != "", title), ignorenulls=True).over(inside)).withColumn("_time", F.first(F.when(time != "", time), ignorenulls=True).over(inside))
    rows = rows.withColumn("_mark", F.min(F.when(F.col("s").startswith(ANSWER), F.col("line"))).over(inside)).filter("_time is not null and line >= _mark")
    said = F.when(F.col("line") == F.col("_mark"), F.substring("s", F.lit(len(ANSWER) + 1), F.length("s"))).otherwise(F.col("s"))
    whole = rows.groupBy("file", "_part", "_ep", "_time").agg(text.strip(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", said.alias("v")))), lambda x: text.strip(x["v"])), "\n")).alias("answer"))
    found = whole.filter("answer != ''").select("file", F.col("_ep").alias("ep"), to_ms(F.col("_time")).alias("start_ms"), "answer", "_part")
    last = Window.partitionBy("file", "ep", "start_ms").orderBy(F.col("_part").desc())
    return found.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n", "_part")


def apply_answers(cues: DataFrame, said: DataFrame, aligned: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(cues, outcomes): cues (ep, idx, start_ms, end_ms, text, ...) after the answers (ep, start_ms, answer), and what became of each
    answer: deleted, replaced, aligned or missing.

    The delete mark removes the cue that starts at the time, other answers replace its text; aligned (ep, at_ms, start_ms, end_ms), by
    the cue's old start, gives it the times of its speech. Of several cues at a time the first (by idx) is meant.
    """
    marks = said.select("ep", "start_ms", F.col("answer").alias("_answer")).dropDuplicates(["ep", "start_ms"])
    first = cues.groupBy("ep", "start_ms").agg(F.min("idx").alias("idx"))
    marks = marks.join(first, ["ep", "start_ms"], "left")
    times = None if aligned is None else aligned.select("ep", F.col("at_ms").alias("start_ms"), F.col("start_ms").alias("_start"), F.col("end_ms").alias("_end")).dropDuplicates(["ep", "start_ms"])
    empty = F.lit(None).cast("long")
    marks = marks.withColumn("_start", empty).withColumn("_end", empty) if times is None else marks.join(times, ["ep", "start_ms"], "left")
    gone = F.col("_answer") == DELETE
    outcome = F.when(F.col("idx").isNull(), "missing").when(gone, "deleted").when(F.col("_start").isNotNull(), "aligned").otherwise("replaced")
    new = cues.join(marks.filter("idx is not null").select("ep", "idx", "_answer", "_start", "_end"), ["ep", "idx"], "left").filter(F.col("_answer").isNull() | ~gone)
    new = new.withColumn("text", F.coalesce("_answer", "text")).withColumn("start_ms", F.coalesce("_start", "start_ms")).withColumn("end_ms", F.coalesce("_end", "end_ms"))
    return new.select(*cues.columns), marks.select("ep", "start_ms", outcome.alias("outcome"))


def markers(files: DataFrame, mark: str = "[???]") -> DataFrame:
    """file, n: how often the mark of open places stands in each file (file, content) that has it."""
    n = F.size(F.split("content", F.lit("\\Q" + mark + "\\E"))) - 1
    return files.select("file", n.cast("long").alias("n")).filter("n > 0")


def polish_summary(results: DataFrame, size: int, price_in: float, price_out: float, tokens_in: int = 800, tokens_out: int = 200) -> DataFrame:
    """One row of results (text, polished; null where the model failed): n, n_polished (changed), n_failed, batches, cost. A batch takes size lines and
    costs tokens_in and tokens_out at prices a million tokens; one more is counted for the remainder."""
    changed = F.col("polished").isNotNull() & (F.col("polished") != F.col("text"))
    c = results.agg(F.count("*").alias("n"), F.count_if(changed).alias("n_polished"), F.count_if(F.col("polished").isNull()).alias("n_failed"))
    batches = F.when(F.col("n") > 0, F.floor(F.col("n") / size) + 1).otherwise(0)
    return c.withColumn("batches", batches.cast("long")).withColumn("cost", F.round(F.col("batches") * (tokens_in * price_in + tokens_out * price_out) / 1e6, 6))

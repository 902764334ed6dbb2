"""The status report as a table: upserts that never downgrade, summaries, and rewrites of a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.functions.timecode import srt_time
from cueweave.schema import STATUSES


def rank(status: Column) -> Column:
    """✅ 3, 🗑️ 2, ⬜ and everything else 1."""
    return F.when(status == STATUSES[2], 3).when(status == STATUSES[1], 2).otherwise(1)


def entry_key(ep: Column, time: Column, original: Column) -> Column:
    """(ep, time), or the word itself for entries without either."""
    return F.when((F.coalesce(ep, F.lit("")) == "") & (F.coalesce(time, F.lit("")) == ""), F.concat(F.lit("noun:"), original)).otherwise(F.concat_ws("|", ep, time))


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert `new` into `old` by (layer, key). A status is never lowered, equal ones are replaced; a filled corrected text
    stays where the new one is empty; a new entry is skipped if another layer holds the key at a higher status. Of several
    new rows for one key the last of the highest status counts. Merging the same rows again changes nothing."""
    cols = ["layer", "ep", "time", "original", "corrected", "status"]
    key = entry_key(F.col("ep"), F.col("time"), F.col("original"))
    o = old.select(*cols, key.alias("key"))
    n = new.select(*cols, key.alias("key"))
    pick = Window.partitionBy("layer", "key").orderBy(rank(F.col("status")).desc(), F.col("corrected").desc_nulls_last(), F.col("original"))
    n = n.withColumn("_n", F.row_number().over(pick)).filter("_n = 1").drop("_n")
    tops = o.groupBy("key", "layer").agg(F.max(rank(F.col("status"))).alias("r"))
    others = n.select("key", "layer", rank(F.col("status")).alias("nr")).alias("n").join(tops.alias("t"), (F.col("n.key") == F.col("t.key")) & (F.col("n.layer") != F.col("t.layer")) & (F.col("t.r") > F.col("nr")))
    n = n.join(others.select("n.key", "n.layer").distinct(), ["key", "layer"], "left_anti")
    both = o.alias("o").join(n.alias("n"), ["layer", "key"], "full")
    take = F.col("n.status").isNotNull() & (F.col("o.status").isNull() | (rank(F.col("n.status")) >= rank(F.col("o.status"))))
    side = lambda c: F.when(take, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    corrected = F.when(take, F.coalesce(F.nullif("n.corrected", F.lit("")), F.col("o.corrected"), F.col("n.corrected"))).otherwise(F.col("o.corrected"))
    return both.select("layer", *[side(c).alias(c) for c in ("ep", "time", "original")], corrected.alias("corrected"), side("status").alias("status"))


def summary(report: DataFrame) -> DataFrame:
    """Counts by layer and in total (layer null): n, done, deleted, pending; an unknown status is pending."""
    r = rank(F.col("status"))
    return report.rollup("layer").agg(F.count("*").alias("n"), F.count_if(r == 3).alias("done"), F.count_if(r == 2).alias("deleted"), F.count_if(r == 1).alias("pending"))


def set_status(report: DataFrame, layer: str, key: str, status: str) -> DataFrame:
    hit = (F.col("layer") == layer) & (entry_key(F.col("ep"), F.col("time"), F.col("original")) == key)
    return report.withColumn("status", F.when(hit, F.lit(status)).otherwise(F.col("status")))


def delete_entry(report: DataFrame, layer: str, key: str) -> DataFrame:
    return report.filter(~((F.col("layer") == layer) & (entry_key(F.col("ep"), F.col("time"), F.col("original")) == key)))


def replace_layer(report: DataFrame, layer: str, rows: DataFrame) -> DataFrame:
    return report.filter(F.col("layer") != layer).unionByName(rows.withColumn("layer", F.lit(layer)).select(*report.columns))


def markdown(report: DataFrame) -> DataFrame:
    """One row a layer: its section as a Markdown table, in the order of (ep, time, original)."""
    cell = lambda c: F.coalesce(F.replace(F.col(c), F.lit("|"), F.lit("\\|")), F.lit(""))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", cell("ep"), cell("time"), cell("original"), cell("corrected"), cell("status")), F.lit(" |"))
    rows = report.groupBy("layer").agg(F.transform(F.sort_array(F.collect_list(F.struct("ep", "time", "original", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    head = F.concat(F.lit("## L"), F.col("layer"), F.lit("\n\n| ep | time | original | corrected | status |\n| --- | --- | --- | --- | --- |\n"))
    return rows.select("layer", F.concat(head, F.array_join("lines", "\n"), F.lit("\n")).alias("section"))


def foreign_kind(c: Column) -> Column:
    """What is wrong with a garbled Chinese line: cyrillic, kana, mixed (Latin beside han), or foreign."""
    return F.when(text.has(c, text.CYRILLIC_BLOCK), "cyrillic").when(text.has(c, text.KANA), "kana").when(text.has(c, text.LATIN) & text.has(c, text.HAN), "mixed").otherwise("foreign")


# fixed values: how the kinds are called in reports, and their heads
KINDS = {"cyrillic": "俄语残留", "kana": "日语残留", "mixed": "双语混合", "foreign": "纯外语"}
DEGRADED_HEAD = "# 问题解决报告\n\n> 生成时间: {day}\n> 模式: 残血运行（无 Whisper）— 以下问题需手动/AI 处理\n> 乱码总数: "
DEGRADED_TABLE = "\n\n---\n\n## ⬜ 未修复乱码（扫描发现，待手动处理）\n\n| # | 文件 | 行号 | 时间码 | 原文 | 问题类型 |\n|---|------|------|--------|------|---------|\n"


def degraded(garbled: DataFrame, day: str, shown: int | None = 60) -> DataFrame:
    """file, content: a Markdown report an episode of garbled cues (ep, file, line, start_ms, text) that nobody can hear again, for
    people to mend. Texts are cut to `shown` characters (None: whole), their bars escaped and line breaks made spaces."""
    cut = F.col("text") if shown is None else F.substring("text", 1, shown)
    names = F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), foreign_kind(cut))
    clean = F.replace(F.regexp_replace(F.coalesce(cut, F.lit("")), "[\\r\\n]+", " "), F.lit("|"), F.lit("\\|"))
    row = F.struct("start_ms", "file", "line", F.concat_ws(" | ", F.coalesce("file", F.lit("?")), F.coalesce(F.col("line").cast("string"), F.lit("?")), F.when(F.col("start_ms").isNull(), "?").otherwise(srt_time(F.col("start_ms"))), clean, F.coalesce(names, F.lit(KINDS["foreign"]))).alias("cells"))
    per = garbled.groupBy("ep").agg(F.sort_array(F.collect_list(row)).alias("l"))
    lines = F.array_join(F.transform("l", lambda x, i: F.concat(F.lit("| "), (i + 1).cast("string"), F.lit(" | "), x["cells"], F.lit(" |"))), "\n")
    content = F.concat(F.lit(DEGRADED_HEAD.format(day=day)), F.size("l").cast("string"), F.lit(DEGRADED_TABLE), lines, F.lit("\n"))
    return per.select(F.concat("ep", F.lit("_degraded.md")).alias("file"), content.alias("content"))

"""Files and episodes: filters, joins of files that belong together, and JSON artefacts by episode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.operators.setops import first_wins, last_wins


def episode_filter(ep: Column, wanted: str) -> Column:
    """Episodes of a list such as '1,3,7-9', by number, so that EP1000 comes after EP999."""
    n = F.regexp_extract(ep, "(\\d+)$", 1).try_cast("int")
    out = F.lit(False)
    for part in filter(None, (p.strip() for p in wanted.split(","))):
        lo, _, hi = part.partition("-")
        out = out | n.between(int(lo), int(hi or lo))
    return out


def from_episode(ep: Column, start: str) -> Column:
    return F.regexp_extract(ep, "(\\d+)$", 1).try_cast("int") >= int("".join(ch for ch in start if ch.isdigit()) or 0)


def by_episode(targets: DataFrame, sources: DataFrame) -> DataFrame:
    """Target and source files of one episode; of several files the last by name counts."""
    t = last_wins(targets.withColumn("ep", text.episode_number(F.col("file"))).filter("ep != '???'"), ["ep"], "file")
    s = last_wins(sources.withColumn("ep", text.episode_number(F.col("file"))).filter("ep != '???'"), ["ep"], "file")
    return t.join(s.select("ep", F.col("file").alias("r_file")), "ep")


def match_videos(subtitles: DataFrame, videos: DataFrame) -> DataFrame:
    """Each subtitle file with its video: by episode, else by a number that both names hold between other characters; the
    first by name."""
    s, v = subtitles.withColumn("ep", text.episode_number(F.col("file"))), videos.select(F.col("file").alias("video"), text.episode_number(F.col("file")).alias("_ep"))
    by_ep = first_wins(s.filter("ep != '???'").join(v.filter("_ep != '???'"), F.col("ep") == F.col("_ep")), ["file"], ["video"])
    rest = s.join(by_ep.select("file"), "file", "left_anti")
    numbers = lambda c: F.explode(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit("(?<!\\d)(\\d{1,4})(?!\\d)"), F.lit(1)), lambda x: x.cast("int"))))
    near = rest.withColumn("_k", numbers(F.col("file"))).join(v.withColumn("_k", numbers(F.col("video"))), "_k")
    found = by_ep.select("file", "video").unionByName(first_wins(near, ["file"], ["video"]).select("file", "video"))
    return subtitles.join(found, "file", "left")


def issue_type(c: Column) -> Column:
    """Why a line is reported when nothing could be heard again: Cyrillic, kana, two scripts at once, or foreign text."""
    return F.when(text.has(c, text.CYRILLIC), "cyrillic").when(text.has(c, text.KANA), "kana").when(text.has(c, text.HAN) & text.has(c, text.LATIN, 2), "bilingual").otherwise("foreign")


def write_issues(issues: DataFrame, folder: str) -> None:
    """JSON by episode; rows without a usable episode are left out."""
    issues.filter("ep is not null and ep not in ('', '???')").write.partitionBy("ep").mode("overwrite").json(folder)


def read_issues(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Issues of all or, with a filter on ep, of some episodes: only their folders are read."""
    return spark.read.schema(schema).json(folder)


def glossary_markdown(glossary: DataFrame, characters: int = 80, others: int = 60) -> DataFrame:
    """One row a category: its section, the most frequent entries first, with up to three variants each."""
    limit = F.when(F.col("category") == "character", characters).otherwise(others)
    shown = F.array_join(F.transform(F.slice("variants", 1, 3), lambda v: v["word"]), ", ")
    line = F.concat_ws(" | ", F.col("canonical"), F.col("total_freq").cast("string"), shown)
    rows = glossary.groupBy("category").agg(F.sort_array(F.collect_list(F.struct((-F.col("total_freq")).alias("f"), "canonical", line.alias("line")))).alias("l"), F.first(limit).alias("most"))
    return rows.select("category", F.concat(F.lit("## "), F.col("category"), F.lit("\n\n"), F.array_join(F.transform(F.slice("l", F.lit(1), F.col("most")), lambda x: x["line"]), "\n")).alias("section"))

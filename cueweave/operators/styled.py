"""Styled (ASS) lines: names, styles, comments, drawings, and tracks of one style against another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.operators.temporal import nearest


def statistics(lines: DataFrame, by: str) -> DataFrame:
    """Lines by style or name: n, n_files and the first text that is not empty, cut to 30 characters."""
    t = text.strip(text.strip_ass_tags(F.col("text")))
    seen = t != ""
    return lines.groupBy(by).agg(F.count("*").alias("n"), F.countDistinct("file").alias("n_files"), F.min_by(F.when(seen, F.substring(t, 1, 30)), F.when(seen, F.struct("file", "line"))).alias("sample"))


def name_languages(lines: DataFrame) -> DataFrame:
    """Distinct speakers by the script of their name."""
    return lines.select("name").distinct().groupBy(text.name_class(F.col("name")).alias("language")).agg(F.count("*").alias("n"))


def is_drawing(c: Column) -> Column:
    return c.rlike("\\\\p[1-9]")


def bad_drawings(lines: DataFrame) -> DataFrame:
    """Drawing lines with characters that no drawing command has."""
    body = text.strip_ass_tags(F.col("text"))
    return lines.filter(is_drawing(F.col("text"))).withColumn("bad", text.bad_drawing_chars(body)).filter(F.size("bad") > 0)


def delete_style(lines: DataFrame, style: str) -> DataFrame:
    return lines.filter(~((F.col("kind") == "dialogue") & (F.col("style") == style)))


def delete_comments(lines: DataFrame, keyword: str) -> DataFrame:
    return lines.filter(~((F.col("kind") == "comment") & F.contains("text", F.lit(keyword))))


def replace_names(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Speakers renamed by (src, dst)."""
    return lines.join(names.select(F.col("src").alias("name"), "dst"), "name", "left").withColumn("name", F.coalesce("dst", "name")).drop("dst")


def simplified(lines: DataFrame, traditional: str, simple: str) -> DataFrame:
    """Character for character, in styled and plain lines alike."""
    return lines.withColumn("text", F.translate("text", traditional, simple))


def track_differences(source: DataFrame, reference: DataFrame, tolerance_ms: int = 500) -> DataFrame:
    """Lines of one track whose nearest line of the other says something else."""
    pairs = nearest(source, reference, ["file"], tolerance_ms)
    return pairs.filter(F.col("text") != F.col("r_text"))


def count_mismatches(lines: DataFrame, a: str, b: str) -> DataFrame:
    """Files in which two styles have different numbers of lines."""
    n = lines.groupBy("file").agg(F.count_if(F.col("style") == a).alias("n_a"), F.count_if(F.col("style") == b).alias("n_b"))
    return n.filter("n_a != n_b")


def variants_at(lines: DataFrame) -> DataFrame:
    """Start times at which files say different things: each text with its number of lines."""
    n = lines.groupBy("start_ms", "text").agg(F.count("*").alias("n"))
    many = n.groupBy("start_ms").agg(F.count("*").alias("n_texts")).filter("n_texts > 1")
    return n.join(many, "start_ms")

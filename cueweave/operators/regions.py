"""Speech against cues: what speech is not covered, what needs a fix, and which recognised text belongs to which cue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.functions.timecode import overlap_ratio
from cueweave.operators.temporal import merge_islands, range_join


def non_speech(cues: DataFrame, speech: DataFrame, keys: list[str], lang: str = "ja", short_ms: int = 3000) -> DataFrame:
    """Cues (by `_id`) with has_speech and verdict: markers go, and short implausible cues that touch no speech."""
    hits = range_join(cues, speech, keys, how="left_semi").select("_id", F.lit(True).alias("has_speech"))
    c = cues.join(hits, "_id", "left").withColumn("has_speech", F.coalesce("has_speech", F.lit(False)))
    gone = text.is_marker(F.col("text"), lang) | (~F.col("has_speech") & ~text.is_plausible(F.col("text"), lang) & (F.col("end_ms") - F.col("start_ms") < short_ms))
    return c.withColumn("verdict", F.when(gone, "delete").otherwise("keep"))


def speech_classes(speech: DataFrame, cues: DataFrame, keys: list[str], min_overlap_ms: int = 300, min_gap_ms: int = 3000, max_gap_ms: int = 45_000) -> DataFrame:
    """Each speech segment (by `_id`) with kind: garbled if a garbled cue overlaps it, missing if no cue does, partial_overlap
    if the overlapping cues leave min_gap_ms of it bare before the first and after the last of them, else covered.

    cues have is_garbled. Segments are cut to the time from the first cue's start to the last one's end; what lies outside,
    as the music of openings and endings, is left out, and so are segments longer than max_gap_ms after the cut.
    """
    bounds = cues.groupBy(*keys).agg(F.min("start_ms").alias("_first"), F.max("end_ms").alias("_last"))
    inside = speech.join(bounds, keys).filter((F.col("end_ms") > F.col("_first")) & (F.col("start_ms") < F.col("_last")))
    cut = inside.withColumn("start_ms", F.greatest("start_ms", "_first")).withColumn("end_ms", F.least("end_ms", "_last")).drop("_first", "_last")
    pairs = range_join(cut.filter(F.col("end_ms") - F.col("start_ms") <= max_gap_ms), cues, keys, least_ms=min_overlap_ms, how="left")
    per = pairs.groupBy("_id", *keys, "start_ms", "end_ms").agg(
        F.count_if("r_is_garbled").alias("n_garbled"), F.count("r_start_ms").alias("n_cues"), F.min("r_start_ms").alias("_from"), F.max("r_end_ms").alias("_to")
    )
    length, zero = F.col("end_ms") - F.col("start_ms"), F.lit(0)
    bare = F.when(F.col("n_cues") == 0, length).otherwise(F.greatest(F.col("_from") - F.col("start_ms"), zero) + F.greatest(F.col("end_ms") - F.col("_to"), zero))
    kind = F.when(F.col("n_garbled") > 0, "garbled").when(F.col("n_cues") == 0, "missing").when(F.col("bare_ms") >= min_gap_ms, "partial_overlap").otherwise("covered")
    return per.withColumn("bare_ms", bare).withColumn("kind", kind).drop("_from", "_to")


def fix_regions(speech: DataFrame, cues: DataFrame, keys: list[str], slack_ms: int = 2000, **limits: int) -> DataFrame:
    """Regions that need a fix: segments of a kind other than covered, merged with a slack; the strongest kind counts."""
    rank = F.when(F.col("kind") == "garbled", 3).when(F.col("kind") == "partial_overlap", 2).otherwise(1)
    found = speech_classes(speech, cues, keys, **limits).filter("kind != 'covered'").withColumn("_rank", rank)
    w = Window.partitionBy(*keys).orderBy("start_ms", "_id")
    before = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start_ms") > before + slack_ms), 1).otherwise(0)
    marked = found.withColumn("_new", new).withColumn("region", F.sum("_new").over(w))
    out = marked.groupBy(*keys, "region").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.max("_rank").alias("_rank"), F.sum("n_garbled").alias("n_garbled"), F.count("*").alias("n_segments"))
    return out.withColumn("kind", F.when(F.col("_rank") == 3, "garbled").when(F.col("_rank") == 2, "partial_overlap").otherwise("missing")).drop("_rank")


def match_rounds(asr: DataFrame, cues: DataFrame, keys: list[str], near_ms: int = 1000, far_ms: int = 3000) -> DataFrame:
    """One row a cue (by `_id`) with confidence and seg_idx. A cue within near_ms of a segment is 'high', one within far_ms of
    a later look is 'retry' with the first such segment, any other is 'none'."""
    near = range_join(cues, asr, keys, slack_ms=near_ms)
    first = near.groupBy("_id").agg(F.min("r_seg_idx").alias("seg_idx")).withColumn("confidence", F.lit("high"))
    rest = cues.join(first, "_id", "left_anti")
    far = range_join(rest, asr, keys, slack_ms=far_ms).groupBy("_id").agg(F.min("r_seg_idx").alias("seg_idx")).withColumn("confidence", F.lit("retry"))
    return cues.join(first.unionByName(far), "_id", "left").withColumn("confidence", F.coalesce("confidence", F.lit("none")))


def aligned(cues: DataFrame, asr: DataFrame, keys: list[str], accept: float = 0.3, high: float = 0.5, lang: str = "ja", shown: int | None = 80) -> DataFrame:
    """Garbled cues with the recognised text of most overlap: replacement, cut to `shown` characters (None: whole), and
    confidence high, retry or none."""
    pairs = range_join(cues, asr, keys, least_ms=1).withColumn("ratio", overlap_ratio(F.col("start_ms"), F.col("end_ms"), F.col("r_start_ms"), F.col("r_end_ms")))
    top = pairs.withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy(F.col("ratio").desc(), "r_seg_idx"))).filter("_n = 1")
    good = top.filter((F.col("ratio") >= accept) & text.is_valid(F.col("r_text"), lang)).select("_id", "ratio", (F.col("r_text") if shown is None else F.substring("r_text", 1, shown)).alias("replacement"))
    return cues.join(good, "_id", "left").withColumn("confidence", F.when(F.col("ratio").isNull(), "none").when(F.col("ratio") >= high, "high").otherwise("retry"))


def confident(asr: DataFrame, no_speech: float = 0.6, logprob: float = -1.5, compression: float = 2.4) -> DataFrame:
    """Recogniser segments with reason (null: kept). An unknown no-speech probability is -1; unknown others are null."""
    return asr.withColumn(
        "reason",
        F.when((F.col("no_speech_prob") >= 0) & (F.col("no_speech_prob") > no_speech), "no_speech").when(F.col("avg_logprob") < logprob, "low_logprob").when(F.col("compression_ratio") > compression, "compression"),
    )


def garbled_clusters(cues: DataFrame, keys: list[str], slack_ms: int = 60_000) -> DataFrame:
    """Garbled cues whose starts are within slack_ms of each other, as one row a cluster."""
    return merge_islands(cues.filter("is_garbled"), keys, slack_ms, by="start")


def clean_neighbours(regions: DataFrame, cues: DataFrame, keys: list[str], lang: str = "ja", slack_ms: int = 2000) -> DataFrame:
    """Regions (by `_id`) with left_idx and right_idx: of clean cues with a text that is no marker, the last by start that ends
    by slack_ms after a region's start, and the first that starts slack_ms before its end or later.

    Cues that a region clears are the caller's to leave out. Both sides are as-of joins: one union and one window each.
    """
    ok = cues.filter(~F.col("is_garbled") & (text.strip(F.col("text")) != "") & ~text.is_marker(F.col("text"), lang))
    none = F.lit(None).cast("struct<start_ms:bigint,idx:bigint>")
    place = F.struct(F.col("start_ms").cast("long").alias("start_ms"), F.col("idx").cast("long").alias("idx"))

    def as_of(at_cue: str, at_region: Column, left: bool) -> DataFrame:
        rows = ok.select(*keys, F.col(at_cue).alias("_at"), F.lit(0 if left else 1).alias("_turn"), place.alias("_p"), F.lit(None).cast("long").alias("_id"))
        rows = rows.unionByName(regions.select(*keys, at_region.alias("_at"), F.lit(1 if left else 0).alias("_turn"), none.alias("_p"), F.col("_id").cast("long").alias("_id")))
        w = Window.partitionBy(*keys).orderBy("_at", "_turn")
        best = F.max("_p").over(w.rowsBetween(Window.unboundedPreceding, 0)) if left else F.min("_p").over(w.rowsBetween(0, Window.unboundedFollowing))
        return rows.withColumn("_b", best).filter("_id is not null").select("_id", F.col("_b.idx").alias("left_idx" if left else "right_idx"))

    sides = as_of("end_ms", F.col("start_ms") + slack_ms, True).join(as_of("start_ms", F.col("end_ms") - slack_ms, False), "_id")
    return regions.join(sides, "_id")


def fix_rows(asr: DataFrame, cues: DataFrame, keys: list[str], near_ms: int = 1000, far_ms: int = 4000, shown: int = 30) -> DataFrame:
    """Fixes from recognised segments (seg_idx, text) for garbled cues (by `_id`): keys, seg_idx, start_ms, end_ms, original,
    replacement, confidence.

    A segment with cues within near_ms makes one 'high' fix for all of them, from the first one's start to the last one's end,
    their texts cut to `shown` characters (None: whole) and joined by ' | '. Cues that no segment reached take the first
    segment within far_ms as 'retry', unless it says what a clean neighbour says (columns left_text and right_text, if
    cues have them). The rest are 'none' without a replacement.
    """
    said = F.struct("r_start_ms", "r_idx", "r_end_ms", (F.col("r_text") if shown is None else F.substring("r_text", 1, shown)).alias("t"))
    near = range_join(asr, cues, keys, slack_ms=near_ms)
    per = near.groupBy(*keys, "seg_idx", "text").agg(F.sort_array(F.collect_list(said)).alias("_l"))
    high = per.select(
        *keys, "seg_idx", F.col("_l")[0]["r_start_ms"].alias("start_ms"), F.element_at("_l", -1)["r_end_ms"].alias("end_ms"),
        F.array_join(F.transform("_l", lambda x: x["t"]), " | ").alias("original"), F.col("text").alias("replacement"), F.lit("high").alias("confidence"),
    )
    left = cues.join(near.select(F.col("r__id").alias("_id")).distinct(), "_id", "left_anti")
    far = range_join(left, asr, keys, slack_ms=far_ms)
    for side in ("left_text", "right_text"):
        if side in cues.columns:
            far = far.filter(~F.coalesce((F.col(side) != "") & (text.containment(F.col("r_text"), F.col(side)) >= 0.5), F.lit(False)))
    best = far.groupBy("_id").agg(F.min(F.struct("r_seg_idx", "r_text")).alias("_b"))
    rest = left.join(best, "_id", "left").select(
        *keys, F.col("_b.r_seg_idx").alias("seg_idx"), "start_ms", "end_ms", F.col("text").alias("original"), F.coalesce("_b.r_text", F.lit("")).alias("replacement"),
        F.when(F.col("_b").isNull(), "none").otherwise("retry").alias("confidence"),
    )
    return high.unionByName(rest)

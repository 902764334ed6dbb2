"""Interval and time-line operators: range joins, nearest neighbours, islands, gaps, batches.

A range join on (key, time) is an equi-join on (key, bin) after each interval has been cut into bins, so that the work of a
hot key spreads over its bins; a pair that shares several bins is kept in the first one only, which needs no distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.functions.timecode import overlap_ms, overlap_ratio


def _binned(df: DataFrame, start: str, end: str, width: int, slack: int) -> DataFrame:
    lo, hi = F.floor((F.col(start) - slack) / width), F.floor((F.greatest(F.col(start), F.col(end)) + slack) / width)
    return df.withColumn("_lo", lo).withColumn("_bin", F.explode(F.sequence(lo, hi)))


def range_join(left: DataFrame, right: DataFrame, keys: list[str], least_ms: int = 0, slack_ms: int = 0, bin_ms: int = 60_000, how: str = "inner", start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Pairs whose intervals, widened by slack_ms, have an overlap of least_ms or more (0: touching counts).

    Right columns other than the keys get the prefix r_. how: inner, left, left_semi or left_anti. A null key or time
    matches nothing. For left joins the left rows must have an `_id` column that tells them apart.
    """
    other = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys])
    a, b = _binned(left, start, end, bin_ms, slack_ms).alias("a"), _binned(other, f"r_{start}", f"r_{end}", bin_ms, 0).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_bin"]]
    touching = overlap_ms(F.col(start) - slack_ms, F.col(end) + slack_ms, F.col(f"r_{start}"), F.col(f"r_{end}")) >= least_ms
    first = F.col("a._bin") == F.greatest(F.col("a._lo"), F.col("b._lo"))
    cond = touching
    for c in on:
        cond = cond & c
    if how in ("inner", "left"):
        pairs = a.join(b, cond & first, "inner").select(*[F.col(f"a.{c}") for c in left.columns], *[F.col(c) for c in other.columns if c not in keys])
        if how == "inner":
            return pairs
        rest = left.join(pairs.select("_id").distinct(), "_id", "left_anti")
        return pairs.unionByName(rest, allowMissingColumns=True)
    hits = a.join(b, cond, "left_semi").select("_id").distinct()
    return left.join(hits, "_id", how)


def best_overlap(left: DataFrame, right: DataFrame, keys: list[str], order: str = "seg_idx", bin_ms: int = 60_000) -> DataFrame:
    """For each left row (by `_id`) the right row with the greatest share of overlap, ties to the smallest `order`; ratio is
    that share of the left interval. Rows that overlap nothing keep nulls."""
    pairs = range_join(left, right, keys, least_ms=1, bin_ms=bin_ms).withColumn("ratio", overlap_ratio(F.col("start_ms"), F.col("end_ms"), F.col("r_start_ms"), F.col("r_end_ms")))
    top = pairs.withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy(F.col("ratio").desc(), f"r_{order}"))).filter("_n = 1").drop("_n")
    rest = left.join(top.select("_id"), "_id", "left_anti")
    return top.unionByName(rest, allowMissingColumns=True)


def nearest(left: DataFrame, right: DataFrame, keys: list[str], tolerance_ms: int, order: str = "idx") -> DataFrame:
    """For each left row (by `_id`) the right row whose start is nearest within the tolerance, ties to the smallest `order`."""
    l, r = left.withColumn("_at", F.col("start_ms")), right.withColumn("_at", F.col("start_ms"))
    pairs = range_join(l, r, keys, slack_ms=tolerance_ms, bin_ms=max(1000, 4 * tolerance_ms), start="_at", end="_at")
    pairs = pairs.withColumn("dist_ms", F.abs(F.col("start_ms") - F.col("r_start_ms")))
    top = Window.partitionBy("_id").orderBy("dist_ms", f"r_{order}")
    return pairs.withColumn("_n", F.row_number().over(top)).filter("_n = 1").drop("_n", "_at", "r__at")


def gaps(cues: DataFrame, keys: list[str]) -> DataFrame:
    """gap_ms from the end of the cue before, in order of start."""
    w = Window.partitionBy(*keys).orderBy("start_ms", "idx")
    return cues.withColumn("gap_ms", F.col("start_ms") - F.lag("end_ms").over(w))


def gap_statistics(cues: DataFrame, keys: list[str], large_ms: int = 20_000) -> DataFrame:
    """n_gaps, max_gap_ms and n_large of the positive gaps; keys without gaps have 0."""
    g = gaps(cues, keys)
    pos = F.col("gap_ms") > 0
    return g.groupBy(*keys).agg(
        F.count_if(pos).alias("n_gaps"), F.coalesce(F.max(F.when(pos, F.col("gap_ms"))), F.lit(0)).alias("max_gap_ms"), F.count_if(F.col("gap_ms") > large_ms).alias("n_large")
    )


def islands(df: DataFrame, keys: list[str], slack_ms: int, by: str = "running_end", order: str = "idx") -> DataFrame:
    """Number the islands of each key in a column `island` (from 1).

    running_end: a row further than slack_ms beyond every earlier end starts one; last_end: beyond the end just before;
    start: beyond the start just before.
    """
    w = Window.partitionBy(*keys).orderBy("start_ms", order)
    before = {
        "running_end": F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "last_end": F.lag("end_ms").over(w),
        "start": F.lag("start_ms").over(w),
    }[by]
    new = F.when(before.isNull() | (F.col("start_ms") - before > slack_ms), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("island", F.sum("_new").over(w)).drop("_new")


def merge_islands(df: DataFrame, keys: list[str], slack_ms: int, by: str = "running_end", order: str = "idx") -> DataFrame:
    """One row an island: start_ms, end_ms (the greatest, or the last one's for last_end), n."""
    end = F.max_by("end_ms", F.struct("start_ms", order)) if by == "last_end" else F.max("end_ms")
    return islands(df, keys, slack_ms, by, order).groupBy(*keys, "island").agg(F.min("start_ms").alias("start_ms"), end.alias("end_ms"), F.count("*").alias("n"))


def flags_to_segments(frames: DataFrame, keys: list[str], flag: str, frame_ms: int = 30, least_ms: int = 300) -> DataFrame:
    """Runs of flagged frames (start_ms each) of least_ms or more as start_ms, end_ms."""
    w = Window.partitionBy(*keys).orderBy("start_ms")
    turn = F.when(F.lag(flag).over(w).eqNullSafe(F.col(flag)), 0).otherwise(1)
    runs = frames.withColumn("_turn", turn).withColumn("_run", F.sum("_turn").over(w))
    segments = runs.filter(flag).groupBy(*keys, "_run").agg(F.min("start_ms").alias("start_ms"), (F.max("start_ms") + frame_ms).alias("end_ms"))
    return segments.filter(F.col("end_ms") - F.col("start_ms") >= least_ms).drop("_run")


def speech_from_silence(silences: DataFrame, totals: DataFrame, keys: list[str], pad_ms: int = 150, least_ms: int = 300) -> DataFrame:
    """The complement of silences (start_ms, end_ms) within total_ms, padded on both sides, short pieces left out."""
    w = Window.partitionBy(*keys).orderBy("start_ms")
    s = silences.select(*keys, "start_ms", "end_ms")
    ends = totals.select(*keys, F.col("total_ms").alias("start_ms"), F.col("total_ms").alias("end_ms"))
    pieces = s.unionByName(ends).withColumn("_from", F.coalesce(F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = pieces.filter(F.col("start_ms") - F.col("_from") >= least_ms).join(totals, keys)
    return out.select(*keys, F.greatest(F.lit(0), F.col("_from") - pad_ms).alias("start_ms"), F.least(F.col("total_ms"), F.col("start_ms") + pad_ms).alias("end_ms"))


def neighbours(cues: DataFrame, keys: list[str], clean: Column, value: str = "text") -> DataFrame:
    """left_<value> and right_<value>: of the last clean row before and the first clean row after, in order of start."""
    w = Window.partitionBy(*keys).orderBy("start_ms", "idx")
    kept = F.when(clean, F.col(value))
    return cues.withColumn(f"left_{value}", F.last(kept, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        f"right_{value}", F.first(kept, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    )


def context(cues: DataFrame, keys: list[str], before: int = 6, after: int = 6, value: str = "text") -> DataFrame:
    """Arrays context_before and context_after of up to so many non-empty values around each row."""
    w = Window.partitionBy(*keys).orderBy("start_ms", "idx")
    some = F.when(F.col(value) != "", F.col(value))
    return cues.withColumn("context_before", F.collect_list(some).over(w.rowsBetween(-before, -1))).withColumn("context_after", F.collect_list(some).over(w.rowsBetween(1, after)))


def batches(cues: DataFrame, keys: list[str], size: int = 10, lead: int = 3, value: str = "text") -> DataFrame:
    """Batches of `size` rows in order of idx: batch, texts, and the `lead` values before it as context."""
    w = Window.partitionBy(*keys).orderBy("idx")
    rows = cues.withColumn("_n", F.row_number().over(w) - 1).withColumn("batch", F.floor(F.col("_n") / size))
    rows = rows.withColumn("_before", F.collect_list(value).over(w.rowsBetween(-lead, -1)))
    return rows.groupBy(*keys, "batch").agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", F.col(value).alias("v")))), lambda x: x["v"]).alias("texts"), F.min_by("_before", "_n").alias("context"))


def concat_offsets(clips: DataFrame, keys: list[str], silence_ms: int = 2000, order: str = "idx") -> DataFrame:
    """offset_ms of each clip in a file that plays all of them with silence between."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return clips.withColumn("offset_ms", F.coalesce(F.sum(F.col("end_ms") - F.col("start_ms") + silence_ms).over(w), F.lit(0)))


def evenly_sampled(files: DataFrame, k: int, order: str) -> DataFrame:
    """k rows at even steps of the order; all of them if they are fewer. One row a file is ranked in one task."""
    w = Window.orderBy(order)
    ranked = files.withColumn("_n", F.row_number().over(w) - 1).withColumn("_all", F.count("*").over(Window.partitionBy()))
    step = F.greatest(F.col("_all") / F.lit(k), F.lit(1.0))
    near = F.ceil(F.col("_n") / step)
    return ranked.filter((near < k) & (F.floor(near * step) == F.col("_n"))).drop("_n", "_all")


def clip_bounds(clusters: DataFrame, speech: DataFrame, keys: list[str], pad_ms: int = 2000, bare_ms: int = 500) -> DataFrame:
    """Clips for clusters (by `_id`, with the bounds lo_ms and hi_ms that a clip must keep, if they have them): clip_start_ms,
    clip_end_ms, and speech_ms, the overlap with speech.

    A clip is pad_ms wider than its cluster on both sides; silence of more than pad_ms at an edge is cut down to pad_ms. A
    cluster that no speech overlaps has no clip (nulls). Without any speech for its keys it is bare_ms wider.
    """
    lo, hi = (F.col(c) if c in clusters.columns else F.lit(v).cast("long") for c, v in (("lo_ms", 0), ("hi_ms", (1 << 62))))
    c = clusters.withColumn("_low", lo).withColumn("_high", hi)
    pairs = range_join(c, speech, keys, slack_ms=pad_ms, how="left")
    start, end, s, e = F.col("start_ms"), F.col("end_ms"), F.col("r_start_ms"), F.col("r_end_ms")
    first, last = F.greatest("_low", start - pad_ms), F.least("_high", end + pad_ms)
    per = pairs.groupBy("_id", *keys, "start_ms", "end_ms", "_low", "_high").agg(
        F.coalesce(F.sum(F.when(s.isNotNull(), F.greatest(overlap_ms(start, end, s, e), F.lit(0)))), F.lit(0)).alias("speech_ms"),
        F.min(F.when(e >= first, s)).alias("_first"), F.max_by(e, F.when(s <= last, F.struct(s, e))).alias("_last"),
    )
    some = speech.select(*keys).distinct().withColumn("_some", F.lit(True))
    per = per.join(some, keys, "left")
    cut_start, cut_end = F.when(F.col("_first") - first > pad_ms, F.col("_first") - pad_ms).otherwise(first), F.when(last - F.col("_last") > pad_ms, F.col("_last") + pad_ms).otherwise(last)
    bare, heard = F.col("_some").isNull(), F.col("speech_ms") > 0
    return per.select(
        "_id", *keys, "start_ms", "end_ms", F.when(bare, F.greatest("_low", start - bare_ms)).when(heard, cut_start).alias("clip_start_ms"),
        F.when(bare, F.least("_high", end + bare_ms)).when(heard, cut_end).alias("clip_end_ms"), "speech_ms",
    )

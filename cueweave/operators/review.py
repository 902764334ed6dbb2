"""What a reviewer of garbled stretches needs, and what their answers do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.functions.timecode import overlap_ms
from cueweave.operators.setops import first_wins
from cueweave.operators.temporal import range_join


def midpoint_join(segments: DataFrame, slots: DataFrame, keys: list[str]) -> DataFrame:
    """Segments with the slot that holds their midpoint, bounds included; the first slot wins. Right columns get r_."""
    at = segments.withColumn("_mid", F.floor((F.col("start_ms") + F.col("end_ms")) / 2))
    slots_at = slots.withColumn("_mid", F.col("start_ms")).withColumn("_mid_end", F.col("end_ms"))
    pairs = range_join(at.withColumn("_mid_end", F.col("_mid")), slots_at, keys, start="_mid", end="_mid_end")
    return first_wins(pairs, ["_id"], ["r_start_ms", "r_idx"]).drop("_mid", "_mid_end", "r__mid", "r__mid_end")


def heard_around(clusters: DataFrame, asr: DataFrame, keys: list[str], reach_ms: int = 30_000, most: int = 20) -> DataFrame:
    """heard: texts of the `most` segments within reach whose middles are nearest, in order of time."""
    pairs = range_join(clusters, asr, keys, slack_ms=reach_ms)
    far = F.abs(F.col("r_start_ms") + F.col("r_end_ms") - F.col("start_ms") - F.col("end_ms"))
    near = pairs.withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy(far, "r_seg_idx"))).filter(F.col("_n") <= most)
    heard = near.groupBy("_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("r_start_ms", "r_seg_idx", "r_text"))), lambda x: x["r_text"]).alias("heard"))
    return clusters.join(heard, "_id", "left").withColumn("heard", F.coalesce("heard", F.array().cast("array<string>")))


def beside(clusters: DataFrame, cues: DataFrame, keys: list[str], gap_ms: int = 1000) -> DataFrame:
    """before and after: idx of the last cue that starts more than gap_ms before a cluster's start, and of the first that starts
    more than gap_ms after it, however far away; null where there is none.

    One as-of pass a side: cues and clusters of a key stand in one order of time, and a running maximum (or minimum, from the
    end) carries the cue's place, so nothing is paired.
    """
    rows = cues.select(*keys, "start_ms", F.struct("start_ms", "idx").alias("_p"), F.lit(None).cast("long").alias("_id"))
    rows = rows.unionByName(clusters.select(*keys, "start_ms", F.lit(None).cast(rows.schema["_p"].dataType).alias("_p"), F.col("_id").cast("long").alias("_id")))
    upto = lambda order: Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, -gap_ms - 1)
    rows = rows.withColumn("before", F.max("_p").over(upto(F.col("start_ms").cast("long")))).withColumn("after", F.min("_p").over(upto(-F.col("start_ms").cast("long"))))
    found = rows.filter("_id is not null").select("_id", F.col("before.idx").alias("before"), F.col("after.idx").alias("after"))
    return clusters.join(found, "_id", "left")


def fragment_context(clusters: DataFrame, cues: DataFrame, keys: list[str], n: int = 6, gap_ms: int = 1000) -> DataFrame:
    """before and after: up to n texts of cues that are not empty, the last that start more than gap_ms before a cluster's start
    and the first that start more than gap_ms after its end (clusters by `_id`).

    Cues are numbered; one as-of pass finds where a cluster stands in the numbering, and an equi-join fetches n numbers on
    each side, so no window reaches further than it has to.
    """
    numbered = cues.filter(text.strip(F.col("text")) != "").withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("start_ms", "idx")))

    def side(at: Column, left: bool) -> DataFrame:
        rows = numbered.select(*keys, F.col("start_ms").alias("_at"), F.lit(1).alias("_turn"), "_k", F.lit(None).cast("long").alias("_id"))
        rows = rows.unionByName(clusters.select(*keys, at.alias("_at"), F.lit(0 if left else 2).alias("_turn"), F.lit(None).cast("int").alias("_k"), F.col("_id").cast("long").alias("_id")))
        w = Window.partitionBy(*keys).orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
        here = rows.withColumn("_n", F.coalesce(F.max("_k").over(w), F.lit(0))).filter("_id is not null")
        numbers = F.sequence(F.col("_n") - (n - 1), F.col("_n")) if left else F.sequence(F.col("_n") + 1, F.col("_n") + n)
        hits = here.select("_id", *keys, F.explode(numbers).alias("_k")).join(numbered.select(*keys, "_k", "text"), [*keys, "_k"])
        return hits.groupBy("_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("_k", "text"))), lambda x: x["text"]).alias("before" if left else "after"))

    none = F.array().cast("array<string>")
    out = clusters.join(side(F.col("start_ms") - gap_ms, True), "_id", "left").join(side(F.col("end_ms") + gap_ms, False), "_id", "left")
    return out.withColumn("before", F.coalesce("before", none)).withColumn("after", F.coalesce("after", none))


def align_to_speech(clusters: DataFrame, speech: DataFrame, keys: list[str], least_ms: int = 300) -> DataFrame:
    """Where corrected lines of a cluster (n_lines of them) go: one row a line with start and end of its speech. One segment
    takes all lines, as many segments as lines take one each; other clusters give no row."""
    pairs = range_join(clusters, speech, keys, least_ms=least_ms + 1)
    w = Window.partitionBy("_id")
    ranked = pairs.withColumn("line", F.row_number().over(w.orderBy("r_start_ms", "r_seg_idx"))).withColumn("_all", F.count("*").over(w))
    return ranked.filter((F.col("_all") == 1) | (F.col("_all") == F.col("n_lines"))).select("_id", *keys, "line", F.col("r_start_ms").alias("start_ms"), F.col("r_end_ms").alias("end_ms"))


def decision(answer: Column, original: Column, has_speech: Column, noisy_share: Column, lang: str = "ja") -> Column:
    """What becomes of a fragment: its answer's text, 'delete' for the delete mark, and without an answer a cut if it means
    too little, nobody speaks or 60 % of the context is noise; else it stays marked."""
    empty = answer.isNull() | (answer == "")
    cut = (text.meaningful_count(original, lang) < 2) | ~has_speech | (noisy_share >= 0.6)
    return F.when(~empty & answer.isin("删除", "__DELETE__"), "delete").when(~empty, "replace").when(cut, "cut").otherwise("mark")


def adopt_reference(compared: DataFrame, shown: int | None = 200) -> DataFrame:
    """Texts after comparison with a reference: a mismatch takes the reference's first `shown` characters (None: all), a
    suspicious line the mark [???], all others stay. One pass, so no write undoes another."""
    new = F.when(F.col("verdict") == "mismatch", F.col("r_text") if shown is None else F.substring("r_text", 1, shown)).when(F.col("verdict") == "suspicious", "[???]").otherwise(F.col("text"))
    return compared.withColumn("text", new)


def apply_recognised(cues: DataFrame, fixes: DataFrame, cuts: DataFrame, clear: DataFrame, keys: list[str]) -> DataFrame:
    """Cues after a recogniser run: cuts and cleared cues go (by start), kept fixes replace texts or, where their cue went,
    come back as cues of their own."""
    on = [*keys, "start_ms"]
    gone = cuts.select(*on).unionByName(clear.select(*on)).distinct()
    left = cues.join(gone, on, "left_anti")
    best = first_wins(fixes, on, ["idx"]).select(*on, F.col("end_ms").alias("_end"), "replacement")
    changed = left.join(best, on, "left").withColumn("text", F.coalesce("replacement", "text")).drop("_end", "replacement")
    new = best.join(left.select(*on), on, "left_anti").select(*on, F.col("_end").alias("end_ms"), F.col("replacement").alias("text"))
    return changed.unionByName(new, allowMissingColumns=True)


def pending(report: DataFrame, ep: str) -> DataFrame:
    """Report rows of an episode that still wait."""
    return report.filter((F.col("ep") == ep) & (F.col("status") == "⬜"))


def tier(n_garbled: Column, n_unmatched: Column, most: int = 15) -> Column:
    """2 if a whole file has to be heard again, else 1."""
    return F.when((n_garbled > most) | (n_unmatched > most), 2).otherwise(1)


def speech_share(speech: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """speech_ms and its share of total_ms."""
    s = speech.groupBy(*keys).agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"))
    return totals.join(s, keys, "left").withColumn("speech_ms", F.coalesce("speech_ms", F.lit(0))).withColumn("share", F.col("speech_ms") / F.greatest("total_ms", F.lit(1)))


def still_garbled(files: DataFrame, cues: DataFrame) -> DataFrame:
    """problem_count and is_clean of each file; a file without cues is clean."""
    n = cues.groupBy("file").agg(F.count_if("is_garbled").alias("problem_count"))
    return files.join(n, "file", "left").withColumn("problem_count", F.coalesce("problem_count", F.lit(0))).withColumn("is_clean", F.col("problem_count") == 0)


def covered_by(cues: DataFrame, speech: DataFrame, keys: list[str]) -> DataFrame:
    """covered_ms of each cue (by `_id`) by speech that does not overlap itself."""
    pairs = range_join(cues, speech, keys, least_ms=1, how="left")
    part = overlap_ms(F.col("start_ms"), F.col("end_ms"), F.col("r_start_ms"), F.col("r_end_ms"))
    return pairs.groupBy("_id").agg(F.coalesce(F.sum(part), F.lit(0)).alias("covered_ms"))

"""Applying fixes to cues, deciding about recognised text, and comparing before with after."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.operators.setops import first_wins, last_wins


def locate(fixes: DataFrame, cues: DataFrame) -> DataFrame:
    """Each fix (by seq) with the idx of its cue: by (file, start_ms), else by a line within four of the cue's first; the
    first cue wins. Fixes without a cue keep null."""
    by_time = first_wins(fixes.join(cues.select("file", "start_ms", "idx"), ["file", "start_ms"]), ["seq"], ["idx"])
    rest = fixes.join(by_time.select("seq"), "seq", "left_anti")
    c = cues.select(F.col("file").alias("_f"), F.col("start_line"), F.col("idx"))
    by_line = rest.join(c, (F.col("file") == F.col("_f")) & F.col("line").between(F.col("start_line"), F.col("start_line") + 4)).drop("_f", "start_line")
    found = by_time.select(*fixes.columns, "idx").unionByName(first_wins(by_line, ["seq"], ["idx"]).select(*fixes.columns, "idx"))
    return fixes.join(found.select("seq", "idx"), "seq", "left")


def replace_texts(cues: DataFrame, fixes: DataFrame) -> DataFrame:
    """Independent replace_text and delete_line fixes, located and joined; the last fix of a cue wins."""
    hits = last_wins(locate(fixes.filter("action in ('replace_text', 'delete_line')"), cues).filter("idx is not null"), ["file", "idx"], "seq")
    joined = cues.join(hits.select("file", "idx", "action", "replacement"), ["file", "idx"], "left").filter("action is null or action != 'delete_line'")
    return joined.withColumn("text", F.when(F.col("action") == "replace_text", F.coalesce("replacement", "text")).otherwise(F.col("text"))).drop("action", "replacement")


def replace_everywhere(cues: DataFrame, pairs: DataFrame) -> DataFrame:
    """Literal replacements (src, dst, seq) in all texts, one after the other; n_terms counts the pairs that hit. The pairs
    travel as one array, so they must be a glossary, not a corpus."""
    table = pairs.agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "src", "dst"))), lambda p: F.struct(p["src"].alias("src"), p["dst"].alias("dst"))).alias("_pairs"))
    hit = F.size(F.filter("_pairs", lambda p: F.contains(F.col("text"), p["src"])))
    out = cues.join(table, F.lit(True), "left").withColumn("n_terms", F.coalesce(hit, F.lit(0)))
    return out.withColumn("text", F.coalesce(text.replace_all(F.col("text"), F.col("_pairs")), "text")).drop("_pairs")


def apply_in_order(cues: DataFrame, fixes: DataFrame) -> DataFrame:
    """Fixes whose order matters, one file at a time in the order of seq: replace_text, delete_line, merge_cues (joined by a
    space), replace_global and replace_global_regex (file null: every file). A file is the unit of work."""
    schema = cues.schema

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = left.sort_values("idx").to_dict("records")
        for f in right.sort_values("seq").to_dict("records"):
            act, new = f["action"], f["replacement"] or ""
            if act == "replace_global":
                for r in rows:
                    r["text"] = r["text"].replace(f["original"], new)
            elif act == "replace_global_regex":
                for r in rows:
                    r["text"] = re.sub(f["pattern"], new, r["text"])
            else:
                at = next((k for k, r in enumerate(rows) if r["start_ms"] == f["start_ms"]), None)
                if at is None:
                    continue
                if act == "replace_text":
                    rows[at]["text"] = new
                elif act == "delete_line":
                    del rows[at]
                elif act == "merge_cues":
                    part = rows[at : at + int(f["count"] or 2)]
                    rows[at] = part[0] | {"text": " ".join(r["text"] for r in part), "end_ms": part[-1]["end_ms"]}
                    del rows[at + 1 : at + len(part)]
        return pd.DataFrame(rows, columns=left.columns)

    # fixes for every file are a list that a person made; each file gets it as one array, by an equi-join on a constant that is broadcast
    columns = F.struct(*fixes.columns)
    own = fixes.filter("file is not null").groupBy("file").agg(F.collect_list(columns).alias("_own"))
    every = fixes.filter("file is null").agg(F.collect_list(columns).alias("_every"))
    lists = cues.select("file").distinct().join(own, "file", "left").join(F.broadcast(every), F.lit(True), "left")
    all_ = F.concat(F.coalesce("_own", F.array().cast(every.schema["_every"].dataType)), F.coalesce("_every", F.array().cast(every.schema["_every"].dataType)))
    mine = lists.select(F.col("file").alias("file"), F.explode(all_).alias("f")).select("file", *[F.col(f"f.{c}").alias(c) for c in fixes.columns if c != "file"])
    return cues.groupBy("file").cogroup(mine.groupBy("file")).applyInPandas(work, schema)


def outcomes(fixes: DataFrame, cues: DataFrame) -> DataFrame:
    """What each fix (by seq) of replace_text or delete_line would do: idx of its cue and outcome.

    applied: its cue is there and changes; already: the cue has the text, or the cue to delete is gone; missing: no cue to
    replace; skipped: a later fix of the same cue wins. Running the fixes and asking again gives 'already' for all applied.
    """
    found = locate(fixes, cues).join(cues.select("file", "idx", F.col("text").alias("_now")), ["file", "idx"], "left")
    later = F.lead("seq").over(Window.partitionBy("file", "idx").orderBy("seq")).isNotNull() & F.col("idx").isNotNull()
    gone, replace = F.col("idx").isNull(), F.col("action") == "replace_text"
    outcome = F.when(gone, F.when(replace, "missing").otherwise("already")).when(later, "skipped").when(replace & (F.col("_now") == F.col("replacement")), "already").otherwise("applied")
    return found.withColumn("outcome", outcome).drop("_now")


def by_index(cues: DataFrame, fixes: DataFrame) -> DataFrame:
    """Corrections (seq, file, idx, original, replacement) of cues that still say `original`; the last of a cue wins."""
    last = last_wins(fixes, ["file", "idx"], "seq").select("file", "idx", F.col("original").alias("_old"), F.col("replacement").alias("_new"))
    joined = cues.join(last, ["file", "idx"], "left")
    return joined.withColumn("text", F.when(F.col("text") == F.col("_old"), F.col("_new")).otherwise(F.col("text"))).drop("_old", "_new")


def pre_replace(cues: DataFrame, known: DataFrame) -> DataFrame:
    """Cues whose (file, idx, text) has a known replacement take it; replaced tells which."""
    joined = cues.join(known.select("file", "idx", "text", "replacement"), ["file", "idx", "text"], "left")
    return joined.withColumn("replaced", F.col("replacement").isNotNull()).withColumn("text", F.coalesce("replacement", "text")).drop("replacement")


def fill_blank(cues: DataFrame, lyrics: DataFrame) -> DataFrame:
    """Empty cues take the lyric (file, idx, dst) that was matched to them."""
    joined = cues.join(lyrics.select("file", "idx", "dst"), ["file", "idx"], "left")
    return joined.withColumn("text", F.when(text.strip(F.col("text")) == "", F.coalesce("dst", "text")).otherwise(F.col("text"))).drop("dst")


def triage(original: Column, replacement: Column, lang: str = "ja") -> Column:
    """cut, keep or review: too little meaning is cut, plausible text is kept unless it is far longer than a meaningful
    original, all else is for review."""
    value = F.coalesce(F.nullif(replacement, F.lit("")), original)
    long = replacement.isNotNull() & (replacement != "") & (text.meaningful_count(original, lang) >= 2) & text.is_length_anomaly(original, replacement)
    return F.when(text.meaningful_count(value, lang) < 2, "cut").when(text.is_plausible(value, lang) & ~F.coalesce(long, F.lit(False)), "keep").otherwise("review")


def issue_diff(issues: DataFrame, cues: DataFrame, keys: list[str]) -> DataFrame:
    """Each issue (keys, start_ms, text) as DELETED, FIXED or STILL there in the cues of now."""
    now = first_wins(cues.select(*keys, "start_ms", F.col("text").alias("now"), "idx"), [*keys, "start_ms"], ["idx"]).drop("idx")
    return issues.join(now, [*keys, "start_ms"], "left").withColumn("state", F.when(F.col("now").isNull(), "DELETED").when(F.col("now") != F.col("text"), "FIXED").otherwise("STILL"))


def renumber(cues: DataFrame) -> DataFrame:
    """srt_index from 1 in the order of start."""
    return cues.withColumn("srt_index", F.row_number().over(Window.partitionBy("file").orderBy("start_ms", "idx")))


def drop_empty(cues: DataFrame) -> DataFrame:
    return cues.filter(text.strip(F.col("text")) != "")


def pair_neighbours(cues: DataFrame, keys: list[str], low_ms: int = 100, high_ms: int = 5000) -> DataFrame:
    """For each garbled cue the best neighbour whose start is 0.1 to 5 s away: clean ones first, then the shortest text."""
    a = cues.filter("is_garbled").select(*keys, "idx", "start_ms", "text")
    b = cues.select(*keys, F.col("idx").alias("n_idx"), F.col("start_ms").alias("n_start"), F.col("text").alias("n_text"), F.col("is_garbled").alias("n_garbled"))
    wide = a.withColumn("_bin", F.explode(F.sequence(F.floor((F.col("start_ms") - high_ms) / high_ms), F.floor((F.col("start_ms") + high_ms) / high_ms))))
    near = wide.join(b.withColumn("_bin", F.floor(F.col("n_start") / high_ms)), [*keys, "_bin"]).filter(F.abs(F.col("start_ms") - F.col("n_start")).between(low_ms, high_ms))
    return first_wins(near, [*keys, "idx"], ["n_garbled", F.length("n_text"), "n_idx"]).drop("_bin")

"""Openings and endings: lines that recur at the same time in several episodes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.functions import text
from cueweave.operators.setops import first_wins
from cueweave.operators.similarity import reaches

REGION_MS = 180_000  # the first and last three minutes
BLOCK = 4096  # character sets that are compared in one matrix


def with_region(cues: DataFrame, keys: list[str], lead_ms: int = REGION_MS, tail_ms: int = REGION_MS, lang: str = "ja") -> DataFrame:
    """region 'OP', 'ED' or null by the distance from the start and the last end of the file."""
    last = F.max("end_ms").over(Window.partitionBy(*keys))
    return cues.withColumn("region", F.when(F.col("start_ms") < lead_ms, "OP").when(F.col("start_ms") > last - tail_ms, "ED"))


def exempt(cues: DataFrame, keys: list[str], **bounds: int) -> DataFrame:
    """Garbled cues of openings and endings count as clean."""
    r = with_region(cues, keys, **bounds)
    garbled = F.col("is_garbled") & F.col("region").isNull()
    return r.withColumn("is_garbled", garbled).withColumn("garbled_type", F.when(garbled, "garbled").otherwise("clean")).drop("region")


def grid_buckets(cues: DataFrame, width_ms: int = 2000) -> DataFrame:
    """bucket_ms by a fixed grid: set-based, but neighbours across a grid line part."""
    return cues.withColumn("bucket_ms", F.floor(F.col("start_ms") / width_ms) * width_ms)


def greedy_buckets(cues: DataFrame, tolerance_ms: int = 2000, by: str = "region") -> DataFrame:
    """bucket_ms by anchors: in the order of (file, idx) a cue joins the first anchor of its region within the tolerance, or
    becomes one. Later cues of a start get what its first one got, so only (region, start, first (file, idx)) is dealt out,
    a row a millisecond of a region at most, and joined back. Order matters, so each (region, stretch) is one pandas group,
    where a stretch is a run of starts without a gap wider than the tolerance: no anchor reaches across such a gap, so the
    parts are independent."""
    w = Window.partitionBy("_by").orderBy("_at")
    starts = cues.groupBy(F.col(by).alias("_by"), F.col("start_ms").alias("_at")).agg(F.min(F.struct("file", "idx")).alias("_first"))
    jump = F.when(F.col("_at") - F.lag("_at").over(w) > tolerance_ms, 1).otherwise(0)
    starts = starts.withColumn("_jump", jump).withColumn("_stretch", F.sum("_jump").over(w)).select("_by", "_at", "_stretch", "_first.file", "_first.idx")

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["file", "idx", "_at"], kind="stable")
        cells: dict[int, tuple[int, int]] = {}  # (rank, anchor) by cell; anchors are wider apart than a cell
        out = []
        for s in pdf["_at"]:
            c = s // (tolerance_ms + 1)
            near = [cells[k] for k in (c - 1, c, c + 1) if k in cells and abs(cells[k][1] - s) <= tolerance_ms]
            if not near:
                near = [cells.setdefault(c, (len(cells), s))]
            out.append(min(near)[1])
        return pdf.assign(bucket_ms=out)[["_by", "_at", "bucket_ms"]]

    schema = starts.select("_by", "_at").withColumn("bucket_ms", F.lit(0).cast("long")).schema
    found = starts.groupBy("_by", "_stretch").applyInPandas(work, schema)
    return cues.join(found, F.col(by).eqNullSafe(F.col("_by")) & (F.col("start_ms") == F.col("_at"))).drop("_by", "_at")


def clusters(bucketed: DataFrame, min_eps: int = 3, lang: str = "ja") -> DataFrame:
    """One row a (region, bucket) seen in min_eps episodes: n_entries, n_eps, noise and valid counts, texts with counts."""
    keys = ["region", "bucket_ms"]
    noise = text.is_noise(F.col("text"), lang) | text.is_music_marker(F.col("text"))
    per = bucketed.groupBy(*keys).agg(
        F.count("*").alias("n_entries"), F.countDistinct("ep").alias("n_eps"), F.count_if(noise).alias("n_noise"), F.count_if(~noise & text.is_valid_for_votes(F.col("text"), lang)).alias("n_valid")
    )
    texts = bucketed.groupBy(*keys, "text").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("text", "n")))).alias("variants"))
    return per.filter(F.col("n_eps") >= min_eps).join(texts, keys)


def pairwise_jaccard(bucketed: DataFrame, keys: list[str]) -> DataFrame:
    """Mean character-set similarity of the distinct texts of each key; 1.0 where there is one text.

    Texts of one character set are one row with a count. The sets of a key are dealt by hash into blocks of about `BLOCK`;
    each two blocks are one group, whose similarities are added up in matrices, so that no row is made for a pair of texts.
    """
    d = bucketed.select(*keys, "text").distinct()
    chars = F.array_join(F.array_sort(F.array_distinct(text.characters(text.strip(F.col("text"))))), "")
    sets = d.filter(F.col("text").isNotNull()).groupBy(*keys, chars.alias("_set")).agg(F.count("*").alias("_n"))
    sizes = sets.groupBy(*keys).agg(F.sum("_n").alias("_texts"), F.ceil(F.count("*") / BLOCK).alias("_blocks"))
    dealt = sets.join(sizes, keys).withColumn("_block", F.pmod(F.xxhash64("_set"), F.col("_blocks")))
    blocks = dealt.groupBy(*keys, "_texts", "_blocks", "_block").agg(F.sort_array(F.collect_list(F.struct("_set", "_n"))).alias("_l"))
    other = blocks.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    tiles = other.select(*keys, "_texts", F.least("_block", "_other").alias("_lo"), F.greatest("_block", "_other").alias("_hi"), F.col("_l._set").alias("_sets"), F.col("_l._n").alias("_ns"))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[:1]
        inner = one["_lo"].iloc[0] == one["_hi"].iloc[0]
        total = similarity_sum(pdf["_sets"].iloc[0], pdf["_ns"].iloc[0], pdf["_sets"].iloc[-1], pdf["_ns"].iloc[-1], inner) if inner or len(pdf) == 2 else 0.0
        return one[[*keys, "_texts"]].assign(_sum=total)

    schema = tiles.select(*keys, "_texts", F.lit(0.0).alias("_sum")).schema
    sums = tiles.groupBy(*keys, "_lo", "_hi").applyInPandas(work, schema).groupBy(*keys, "_texts").agg(F.sum(F.col("_sum").cast("decimal(38,6)")).cast("double").alias("_sum"))
    sims = sums.filter("_texts > 1").select(*keys, (F.col("_sum") * 2 / (F.col("_texts") * (F.col("_texts") - 1))).alias("mean_jaccard"))
    return d.select(*keys).distinct().join(sims, keys, "left").withColumn("mean_jaccard", F.coalesce("mean_jaccard", F.lit(1.0)))


def similarity_sum(a: list[str], n_a: list[int], b: list[str], n_b: list[int], inner: bool, slab: int = 256) -> float:
    """Sum of the Jaccard similarities of all pairs of texts, given as character sets with counts; 0 if a set is empty.
    inner: a and b are the same sets, and each pair of different texts counts once."""
    place = {c: i for i, c in enumerate(sorted(set().union(*a, *b)))}

    def ones(sets: list[str]) -> np.ndarray:
        x = np.zeros((len(sets), len(place)), np.float32)
        for row, s in zip(x, sets, strict=True):
            row[[place[c] for c in s]] = 1
        return x

    x, y, n, m = ones(a), ones(b), np.asarray(n_a, float), np.asarray(n_b, float)
    size, total = y.sum(1), 0.0
    for i in range(0, len(x), slab):
        shared = x[i : i + slab] @ y.T
        alike = shared.astype(float) / np.maximum(x[i : i + slab].sum(1)[:, None] + size - shared, 1)
        total += float(n[i : i + slab] @ alike @ m)
    return (total - float(n[x.any(1)].sum())) / 2 if inner else total


def cluster_kind(c: DataFrame) -> DataFrame:
    """kind from n_noise, n_valid, variants and mean_jaccard: instrumental, dialogue, vocal or none."""
    share, one = F.col("n_noise") / F.greatest(F.col("n_noise") + F.col("n_valid"), F.lit(1)), F.size(F.map_keys("variants")) <= 1
    kind = (
        F.when(share >= 0.8, "instrumental").when(one & (F.col("n_noise") > 0), "instrumental").when(one, "none").when(F.col("mean_jaccard") < 0.4, "dialogue")
        .when(F.col("n_valid") > 0, "vocal").otherwise("instrumental")
    )
    return c.withColumn("kind", kind)


def majority(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The most common value of each key, ties to the one seen first: value, n, n_distinct."""
    counts = df.withColumn("_pos", F.struct(*order)).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min("_pos").alias("_first"))
    counts = counts.withColumn("n_distinct", F.count("*").over(Window.partitionBy(*keys)))
    return first_wins(counts, keys, [F.col("n").desc(), F.col("_first")]).drop("_first")


def consistency(bucketed: DataFrame, lang: str = "ja", threshold: float = 0.7) -> DataFrame:
    """Entries that differ from the majority of their bucket and are alike enough to be slips: file, idx, original, replacement."""
    keys = ["region", "bucket_ms"]
    top = majority(bucketed, keys, "text", ["file", "idx"]).filter((F.col("n_distinct") >= 2) & text.is_valid_for_votes(F.col("text"), lang)).select(*keys, F.col("text").alias("replacement"))
    rows = bucketed.join(top, keys).filter(F.col("text") != F.col("replacement"))
    alike = (text.normalise(F.col("text"), lang) == text.normalise(F.col("replacement"), lang)) | reaches(F.lower("text"), F.lower("replacement"), threshold)
    return rows.filter(alike).select("file", "idx", F.col("text").alias("original"), "replacement")


def auto_fixes(bucketed: DataFrame, kinds: DataFrame, decisions: DataFrame, lang: str = "ja", mark: str = "[音楽]") -> DataFrame:
    """Fixes for openings and endings: file, idx, original, replacement, by.

    Noise in an instrumental bucket takes the mark (by 'rule'). decisions (region, bucket_ms, answer) go over that: the answer
    __INSTRUMENTAL__ puts the mark on all entries of the bucket, any other text replaces those that differ (by 'decision').
    """
    keys = ["region", "bucket_ms"]
    rows = bucketed.join(kinds.select(*keys, "kind"), keys, "left").join(decisions.select(*keys, "answer"), keys, "left")
    noise = text.is_noise(F.col("text"), lang) | text.is_music_marker(F.col("text"))
    said = F.col("answer").isNotNull() & (F.col("answer") != "")
    new = F.when(said, F.when(F.col("answer") == "__INSTRUMENTAL__", F.lit(mark)).otherwise(F.col("answer"))).when((F.col("kind") == "instrumental") & noise, F.lit(mark))
    fixed = rows.withColumn("replacement", new).filter(F.col("replacement").isNotNull() & (F.col("replacement") != F.col("text")))
    return fixed.select("file", "idx", F.col("text").alias("original"), "replacement", F.when(said, "decision").otherwise("rule").alias("by"))


def reference_texts(cues: DataFrame) -> DataFrame:
    """The first text (by file and idx) of each (region, bucket) of reference cues."""
    return first_wins(cues, ["region", "bucket_ms"], ["file", "idx"]).select("region", "bucket_ms", "text")


def near_reference(clusters: DataFrame, references: DataFrame, tolerance_ms: int = 2000) -> DataFrame:
    """Clusters (region, bucket_ms) with the text of the first reference of their region within the tolerance."""
    lo = F.floor(F.col("bucket_ms") / tolerance_ms)
    a = clusters.withColumn("_bin", F.explode(F.sequence(lo - 1, lo + 1)))
    b = references.select("region", F.col("bucket_ms").alias("_at"), F.col("text").alias("reference")).withColumn("_bin", F.floor(F.col("_at") / tolerance_ms))
    near = a.join(b, ["region", "_bin"]).filter(F.abs(F.col("bucket_ms") - F.col("_at")) <= tolerance_ms)
    best = near.groupBy("region", "bucket_ms").agg(F.min(F.struct("_at", "reference")).getField("reference").alias("reference"))
    return clusters.join(best, ["region", "bucket_ms"], "left")


def match_lyrics(cues: DataFrame, lyrics: DataFrame, tolerance_ms: int = 3000) -> DataFrame:
    """Cues of a region and episode number with the nearest-listed lyric within the tolerance; the first by song and time."""
    step = 2 * tolerance_ms
    c = cues.withColumn("_bin", F.explode(F.sequence(F.floor((F.col("start_ms") - tolerance_ms) / step), F.floor((F.col("start_ms") + tolerance_ms) / step)))).alias("c")
    y = lyrics.withColumn("_bin", F.floor(F.col("time_ms") / step)).alias("y")
    on = (F.col("c.region") == F.col("y.region")) & (F.col("c._bin") == F.col("y._bin")) & F.col("ep_no").between(F.col("ep_lo"), F.col("ep_hi")) & (F.abs(F.col("start_ms") - F.col("time_ms")) <= tolerance_ms)
    pairs = c.join(y, on).select(*[f"c.{x}" for x in cues.columns], "song_id", "time_ms", "src", "dst")
    return first_wins(pairs, ["file", "idx"], ["song_id", "time_ms"])


def language_vote(cues: DataFrame, sample: int = 100, order: list[str] | None = None) -> DataFrame:
    """The language of a corpus from its first voiced cues: kana 15 % ja, cjk 30 % zh, Cyrillic 30 % ru, Latin 50 % en, else ja."""
    order = order or ["file", "idx"]
    head = cues.filter(~text.is_unvoiced(F.col("text"))).orderBy(*order).limit(sample).withColumn("script", text.script(F.col("text")))
    share = lambda s: F.count_if(F.col("script") == s) / F.greatest(F.count("*"), F.lit(1))
    lang: Column = F.when(share("kana") >= 0.15, "ja").when(share("cjk") >= 0.3, "zh").when(share("cyrillic") >= 0.3, "ru").when(share("latin") >= 0.5, "en").otherwise("ja")
    return head.agg(lang.alias("lang"), F.count("*").alias("n"))

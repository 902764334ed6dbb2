"""Summaries of scans and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueweave.functions import text


def scan(cues: DataFrame, terms: DataFrame, repeats: DataFrame) -> DataFrame:
    """One row: n_files, n_cues, n_garbled, n_repeats, n_terms (distinct), n_eps_with_issues. terms: term; repeats: one row each."""
    c = cues.agg(
        F.countDistinct("file").alias("n_files"), F.count("*").alias("n_cues"), F.count_if("is_garbled").alias("n_garbled"), F.countDistinct(F.when(F.col("is_garbled"), F.col("ep"))).alias("n_eps_with_issues")
    )
    r, t = repeats.agg(F.count("*").alias("n_repeats")), terms.agg(F.countDistinct("term").alias("n_terms"))
    return c.join(F.broadcast(r), F.lit(True)).join(F.broadcast(t), F.lit(True))  # one row each


def by_episode(issues: DataFrame, order: list[str]) -> DataFrame:
    """Issues of each episode in order, as an array of whole rows; rows without a usable episode ('' or '???') are left out."""
    some = issues.filter(F.col("ep").isNotNull() & ~F.col("ep").cast("string").isin("", "???"))
    rest = [c for c in issues.columns if c != "ep" and c not in order]
    return some.groupBy("ep").agg(F.sort_array(F.collect_list(F.struct(*order, *rest))).alias("issues"))


def merged_counters(reports: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    """Counters of several runs added up; a missing one counts as 0."""
    return reports.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters])


def verdict_tops(checked: DataFrame, most: int = 50) -> DataFrame:
    """Candidates (text, status, file, idx) that are unknown or mismatch: text, status, n, first context place, the `most` most common."""
    some = checked.filter("status in ('unknown', 'mismatch')").groupBy("text", "status").agg(F.count("*").alias("n"), F.min(F.struct("file", "idx")).alias("first"))
    return some.orderBy(F.col("n").desc(), "text", "status").limit(most).select("text", "status", "n", "first.file", "first.idx")


def language_by_share(cues: DataFrame, keys: list[str], first: int = 20, kana: float = 0.05, cyrillic: float = 0.05, han: float = 0.3) -> DataFrame:
    """The language of each file from the character shares of its first cues: ja, ru or zh by the first share
    reached, else 'other'."""
    from pyspark.sql import Window

    head = cues.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("idx"))).filter(F.col("_n") <= first)
    count = lambda chars: F.sum(text.count_chars(F.col("text"), chars))
    per = head.groupBy(*keys).agg(count(text.KANA).alias("_k"), count(text.CYRILLIC_BLOCK).alias("_y"), count(text.HAN).alias("_h"), F.sum(F.length("text")).alias("_all"))
    share: dict[str, Column] = {c: F.col(c) / F.greatest("_all", F.lit(1)) for c in ("_k", "_y", "_h")}
    lang = F.when(share["_k"] >= kana, "ja").when(share["_y"] >= cyrillic, "ru").when(share["_h"] >= han, "zh").otherwise("other")
    return per.select(*keys, lang.alias("lang"))


def layer_of_candidates(candidates: DataFrame, layer: str = "3") -> DataFrame:
    """Report rows of suspects (term, correction may be null): pending, without a place."""
    return candidates.select(
        F.lit(layer).alias("layer"), F.lit("").alias("ep"), F.lit("").alias("time"), F.col("term").alias("original"), F.coalesce("correction", F.lit("")).alias("corrected"), F.lit("⬜").alias("status")
    )

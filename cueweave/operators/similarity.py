"""Text similarity beyond what expressions offer, in Arrow batches, and the joins and runs built on it."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from cueweave.functions import text
from cueweave.operators.temporal import best_overlap


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def ratio(a: Column, b: Column, mode: str = "plain") -> Column:
    """Ratcliff-Obershelp similarity. plain: as it is; lower: without case; tidy: without case and outer spaces, 0 if empty."""
    if mode == "lower":
        return _ratio(F.lower(a), F.lower(b))
    if mode == "tidy":
        x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
        return F.when((x == "") | (y == ""), F.lit(0.0)).otherwise(_ratio(x, y))
    return _ratio(a, b)


def reaches(a: Column, b: Column, threshold: float) -> Column:
    """Whether the ratio reaches the threshold; difflib's two upper bounds go first."""

    @F.pandas_udf(BooleanType())
    def reached(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str | None, y: str | None) -> bool | None:
            if x is None or y is None:
                return None
            m = difflib.SequenceMatcher(None, x, y)
            return m.real_quick_ratio() >= threshold and m.quick_ratio() >= threshold and m.ratio() >= threshold

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="object")

    return reached(a, b)


def compare(left: DataFrame, right: DataFrame, keys: list[str], threshold: float = 0.4) -> DataFrame:
    """Each left cue (by `_id`) against the right cue it overlaps most: similarity and verdict match, suspicious, mismatch,
    or unmatched where nothing overlaps."""
    pairs = best_overlap(left, right, keys, order="idx").withColumn("similarity", F.coalesce(ratio(F.col("text"), F.col("r_text"), "tidy"), F.lit(0.0)))
    verdict = F.when(F.col("r_text").isNull(), "unmatched").when(F.col("similarity") >= threshold + 0.2, "match").when(F.col("similarity") >= threshold, "suspicious").otherwise("mismatch")
    return pairs.withColumn("verdict", verdict)


def similar_runs(cues: DataFrame, keys: list[str], threshold: float = 0.85, least: int = 2) -> DataFrame:
    """Maximal runs of neighbouring cues that are alike: run (from 1), first_idx, last_idx, n."""
    w = Window.partitionBy(*keys).orderBy("idx")
    alike = cues.withColumn("_next", F.lead("text").over(w)).withColumn("_same", F.coalesce(reaches(F.col("text"), F.col("_next"), threshold), F.lit(False)))
    linked = alike.withColumn("_prev", F.coalesce(F.lag("_same").over(w), F.lit(False)))
    runs = linked.withColumn("run", F.sum(F.when(F.col("_prev"), 0).otherwise(1)).over(w))
    return runs.groupBy(*keys, "run").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.count("*").alias("n")).filter(F.col("n") >= least)


def blocked(texts: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """Pairs (text, name) of which the ratio of the lower-case strings can reach the threshold; each once, from distinct
    texts and names.

    A ratio of t needs M >= t * (len a + len b) / 2 characters in common, counted as often as they occur, and as M is at most
    the shorter length, neither is shorter than t / (2 - t) times the other. So M >= len * t / (2 - t) for both, and in any
    order of (character, occurrence number) their first len - M + 1 meet. The order is rare first, and a pair is taken at the
    first one that meets.
    """
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold {threshold} is not above 0 and at most 1")
    least, eps = threshold / (2 - threshold), 1e-9

    def tokens(df: DataFrame, column: str) -> DataFrame:
        low = F.lower(F.col(column))
        times = lambda c: F.length(low) - F.length(F.replace(low, c, F.lit("")))
        every = F.flatten(F.transform(F.array_distinct(text.characters(low)), lambda c: F.transform(F.sequence(F.lit(1), times(c)), lambda i: F.concat(c, i.cast("string")))))
        return df.select(column, F.length(low).alias("_len"), F.explode(every).alias("_t"))

    a, b = tokens(texts, "text"), tokens(names, "name")
    often = a.select("_t").unionAll(b.select("_t")).groupBy("_t").agg(F.count("*").alias("_often"))

    def prefixes(t: DataFrame, column: str, as_: str) -> DataFrame:
        ordered = F.transform(F.sort_array(F.collect_list(F.struct("_often", "_t"))), lambda x: x["_t"])
        g = t.join(often, "_t").groupBy(column).agg(F.max("_len").alias(f"_len{as_}"), ordered.alias(f"_all{as_}"))
        g = g.withColumn(f"_first{as_}", F.slice(f"_all{as_}", F.lit(1), (F.col(f"_len{as_}") - F.ceil(F.col(f"_len{as_}") * least - eps) + 1).cast("int")))
        return g.withColumn("_t", F.explode(f"_first{as_}"))

    both = prefixes(a, "text", "a").join(prefixes(b, "name", "b"), "_t")
    near = F.least("_lena", "_lenb") >= F.greatest("_lena", "_lenb") * least - eps
    once = F.array_intersect("_firsta", "_firstb")[0] == F.col("_t")
    enough = F.size(F.array_intersect("_alla", "_allb")) >= (F.col("_lena") + F.col("_lenb")) * (threshold / 2) - eps
    return both.filter(near & once & enough).select("text", "name")


def fuzzy_join(candidates: DataFrame, nouns: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Each candidate (text, norm) with its best noun (name, name_norm): exact 1.0, equal after normalising 0.95, else the
    ratio if it reaches the threshold; status exact, variant, mismatch or unknown.

    The equal cases are equi-joins. What is left is compared in the blocks of `blocked`, which lose no pair of the threshold.
    """
    names = nouns.select(F.col("name"), F.col("name_norm")).distinct()
    exact = candidates.join(names, candidates.text == names.name).select(candidates["*"], "name", F.lit(1.0).alias("similarity"))
    rest = candidates.join(exact.select("text"), "text", "left_anti")
    same = rest.join(names, rest.norm == names.name_norm).groupBy(*rest.columns).agg(F.min("name").alias("name")).withColumn("similarity", F.lit(0.95))
    rest = rest.join(same.select("text"), "text", "left_anti")
    pairs = blocked(rest.select("text").distinct(), names.select("name").distinct(), threshold)
    scored = pairs.withColumn("similarity", ratio(F.col("text"), F.col("name"), "lower")).filter(F.col("similarity") >= threshold)
    best = scored.withColumn("_n", F.row_number().over(Window.partitionBy("text").orderBy(F.col("similarity").desc(), "name"))).filter("_n = 1").drop("_n")
    best = rest.distinct().join(best, "text")
    found = exact.unionByName(same.select(*exact.columns)).unionByName(best.select(*exact.columns))
    unknown = candidates.join(found.select("text"), "text", "left_anti")
    status = F.when(F.col("similarity") == 1.0, "exact").when(F.col("similarity") >= 0.95, "variant").when(F.col("similarity").isNotNull(), "mismatch").otherwise("unknown")
    return found.unionByName(unknown, allowMissingColumns=True).withColumn("status", status)


def replace_runs(cues: DataFrame, runs: DataFrame, new: DataFrame, keys: list[str], alike: float = 0.6) -> DataFrame:
    """Cues (keys, idx, start_ms, end_ms, text) in which runs of alike cues (keys, run, first_idx, last_idx) give way to what
    was recognised anew for them (new: keys, run, start_ms, end_ms, text), renumbered from 0.

    A run stays as it is if its new cues are alike again: two at least, and half as many pairs of neighbours as cues reach
    `alike`. A run without new cues goes. Null and blank new texts are none. Further columns of cues are null in new ones.
    """
    heard = new.select(*keys, "run", "start_ms", "end_ms", text.strip(F.col("text")).alias("text")).filter("text != ''")
    w = Window.partitionBy(*keys, "run").orderBy("start_ms", "end_ms", "text")
    pairs = heard.withColumn("_next", F.lead("text").over(w)).withColumn("_like", F.coalesce(ratio(F.col("text"), F.col("_next"), "tidy"), F.lit(0.0)) >= alike)
    judged = pairs.groupBy(*keys, "run").agg(F.count("*").alias("n_new"), F.count_if("_like").alias("n_like"))
    action = F.when(F.col("n_new").isNull(), "gone").when((F.col("n_new") >= 2) & (F.col("n_like") >= F.col("n_new") * 0.5), "kept").otherwise("replaced")
    settled = runs.join(judged, [*keys, "run"], "left").withColumn("action", action)
    out = settled.filter("action <> 'kept'").select(*keys, F.explode(F.sequence("first_idx", "last_idx")).alias("idx"))
    fresh = heard.join(settled.filter("action = 'replaced'").select(*keys, "run", F.col("first_idx").alias("idx")), [*keys, "run"]).drop("run")
    rows = cues.join(out, [*keys, "idx"], "left_anti").unionByName(fresh, allowMissingColumns=True)
    return rows.withColumn("idx", F.row_number().over(Window.partitionBy(*keys).orderBy("idx", "start_ms", "end_ms", "text")) - 1)

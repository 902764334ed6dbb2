"""First-wins deduplication, unions by priority, differences, and merges of kept values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key in a stated order; dropDuplicates would leave the choice open. Null keys are one key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return first_wins(df, keys, [F.col(order).desc()])


def union_by_priority(sources: list[DataFrame]) -> DataFrame:
    """All rows with src_prio, the place of their source in the list (from 0)."""
    out = None
    for k, s in enumerate(sources):
        s = s.withColumn("src_prio", F.lit(k))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    return out


def dedup_fixes(fixes: DataFrame, order: list[str]) -> DataFrame:
    """First fix of each (action, pattern or original) for global ones, else of each (action, file, original or line)."""
    everywhere = F.col("action").startswith("replace_global")
    file = F.when(everywhere, F.lit(None)).otherwise(F.col("file"))
    what = F.when(everywhere, F.coalesce("pattern", "original")).otherwise(F.coalesce(F.nullif("original", F.lit("")), F.col("line").cast("string")))
    return first_wins(fixes.withColumn("_file", file).withColumn("_what", what), ["action", "_file", "_what"], order).drop("_file", "_what")


def differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys in one table only, with side 'extra' (in a) or 'missing' (in b)."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.join(y, keys, "left_anti").withColumn("side", F.lit("extra")).unionByName(y.join(x, keys, "left_anti").withColumn("side", F.lit("missing")))


def merge_mappings(old: DataFrame, new: DataFrame) -> DataFrame:
    """(src, dst) rows of both; a filled old value stays, an empty one takes the new."""
    o, n = old.select("src", F.col("dst").alias("_old")), new.select("src", F.col("dst").alias("_new"))
    return o.join(n, "src", "full").select("src", F.coalesce(F.nullif("_old", F.lit("")), "_new", "_old").alias("dst"))


def tiers(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of the first tier and those of the second whose key it lacks."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"), allowMissingColumns=True)


def zip_rows(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows side by side by (keys, idx); right columns get the prefix r_."""
    on = [*keys, "idx"]
    other = right.select(*on, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in on])
    return left.join(other, on, how)

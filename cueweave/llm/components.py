"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueweave.llm.common import discard, materialize


SALTS = 16  # parts that the rows of a node with many neighbours are dealt into


def _beside(rows: DataFrame, least: DataFrame) -> DataFrame:
    """rows (a, b) with the m of their a in least (a, m); a hot node's rows are dealt over SALTS tasks by their b."""
    salted = rows.withColumn("_s", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    return salted.join(least.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["a", "_s"]).drop("_s")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) from edges (a, b) of any orderable type; root is the least node of the component.

    Every step is one aggregation and one join, its result written to the shared folder; a node with many neighbours is
    reduced to its least neighbour in each map task, and joined in parts. Rounds end when no edge changes, which takes about
    the logarithm of the longest path; `rounds` of them without an end are an error. Loops only name their node.
    """
    e = materialize(edges.select("a", "b").distinct(), "cc")
    before = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = _beside(both.filter("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.select("a", F.col("m").alias("b"))).distinct()
        down = large.filter("b <= a")
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = _beside(down, low).select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        e, old = materialize(small.distinct(), "cc"), e
        discard(old)
        now = tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
        if now == before:
            return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        before = now
    raise ValueError(f"components are not settled after {rounds} rounds")

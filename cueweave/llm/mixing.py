"""Mixing sources to target weights by entropy balancing.

Each source j has a target t_j in words. Among all rates 0 <= r_d <= cap with sum(r_d * size_d) = t_j over its
documents, the ones nearest to 1 in relative entropy are r_d = min(cap, exp(lambda_j * size_d / mean_j)). The
multiplier lambda_j minimises a convex dual in one dimension; guarded Newton steps find it, each one aggregation over
the (source, size) histogram for all sources at once. The rates are then rounded into whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueweave.llm.common import discard, materialize, packed, with_prefix

WORD = r"[^\x20\x09-\x0D]+"
AT_ONCE = 3  # Newton steps in a job
_FIXED = 1 << 20  # rates are summed as whole numbers of this unit, so that no order of addition changes a result


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Targets of sources from (source, source_size): source, source_size, target.

    Sources in code-point order, null last, take the weights in turn and share `share` of all sizes by weight. A target
    stops at `cap` times its source's size; what is above is shared again by weight until none is above. One row a
    source meets in one task.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    to_here, from_here = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    k = F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), k.cast("int")))
    s = s.withColumn("top", cap * F.col("source_size")).withColumn("room", F.col("top") / F.col("weight"))
    s = s.withColumn("level", (share * F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("top").over(to_here), F.lit(0.0))) / F.sum("weight").over(from_here))
    # the first source with room for the level that is left sets it for all after it
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "source", "level"))).over(Window.partitionBy()).getField("level"))
    return s.select("source", "source_size", F.least("top", F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight")).alias("target"))


def _rate(lam: Column, x: Column, cap: float) -> Column:
    return F.least(F.lit(cap), F.exp(F.least(lam * x, F.lit(50.0))))


def _exact(c: Column) -> Column:
    """A sum that no order of addition changes."""
    return F.sum(c.cast("decimal(30,6)")).cast("double")


def multipliers(hist: DataFrame, cap: float, tolerance: float = 1e-5, steps: int = 60) -> DataFrame:
    """Newton iterations on the dual of every source: adds lam to (source, source_size, target) of `hist`'s sources."""
    state = materialize(
        hist.groupBy("source").agg(
            F.first("source_size").alias("source_size"), F.first("target").alias("target"),
            (F.first("source_size") / F.sum("n")).alias("mean"),
        ).select("*", F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                 (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).alias("full"), F.lit(1.0).alias("gap")),
        "mix-state",
    )
    stored = state
    for step in range(steps):
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("lam"), x, cap)
        h = hist.select("source", "size", "n").alias("h").join(state.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")))
        sums = h.groupBy(F.col("s.source").alias("source")).agg(
            F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("mean").alias("mean"), F.first("lam").alias("lam"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("full").alias("full"),
            _exact(F.col("n") * F.col("size") * rate).alias("f"),
            _exact(F.when(rate < cap, F.col("n") * F.col("size") * x * rate).otherwise(F.lit(0.0))).alias("df"),
        )
        above = F.col("f") > F.col("target")
        sums = sums.withColumn("hi", F.when(above, F.col("lam")).otherwise(F.col("hi"))).withColumn("lo", F.when(above, F.col("lo")).otherwise(F.col("lam")))
        newton = F.col("lam") + F.when(F.col("df") > 0, (F.col("target") - F.col("f")) / F.col("df"))
        half = F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2).otherwise(F.when(above, F.col("lam") - 1).otherwise(F.col("lam") * 2 + 1))
        inside = newton.isNotNull() & (newton > F.coalesce(F.col("lo"), F.col("lam") - 4)) & (newton < F.coalesce(F.col("hi"), F.col("lam") + 4))
        gap = F.when(F.col("full"), F.lit(0.0)).otherwise(F.abs(F.col("f") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0)))
        sums = sums.withColumn("gap", gap).withColumn("lam", F.when(F.col("gap") <= tolerance, F.col("lam")).otherwise(F.when(inside, newton).otherwise(half)))
        state = sums.drop("f", "df")
        if (step + 1) % AT_ONCE and step + 1 < steps:
            continue  # sources that have settled stay as they are, so a few steps make one job
        state, old = materialize(state, "mix-state"), stored
        discard(old)
        stored = state
        if (state.agg(F.max("gap")).first()[0] or 0.0) <= tolerance:
            return state
    raise ValueError(f"after {steps} Newton steps a source is still off its target by more than {tolerance} of it")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: doc_id, size (words), source_size, target (of its source, in words), taken, rate, copies, key.

    copies is 0 to `cap`; taken = copies * size; key is a hash of id, text and source. Null and empty texts have size 0,
    rate 1 and one copy, and take no words. A null source is a source of its own. Repeated rows count each. Extra columns
    are dropped. An empty table gives no row. Reruns agree: all sums are exact and ties go by key.

    Rounding: along the order (source, size, key) a document gets the whole numbers that the running sum of rates
    passes, so each range of sizes gets its share; what a source still lacks is mended by moving at most one copy up and
    one down for each power of two of the size.
    """
    text = F.col(text_col)
    slim = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.col(id_col), text, F.col(source_col)).alias("key"),
        ),
        "mix-docs",
    )
    counts = slim.groupBy("source", "size").agg(F.count("*").alias("n"))
    aims = materialize(targets(counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size")), weights, share, cap), "mix-targets")
    hist = materialize(
        counts.filter("size > 0").alias("c").join(aims.alias("a"), F.col("c.source").eqNullSafe(F.col("a.source"))).select("c.source", "size", "n", "source_size", "target"),
        "mix-hist",
    )
    found = multipliers(hist, cap).select("source", "lam", "mean", "full")

    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("full"), F.lit(float(cap))).otherwise(_rate(F.col("lam"), F.col("size") / F.col("mean"), cap))
    rated = (
        slim.alias("d").join(aims.alias("a"), F.col("d.source").eqNullSafe(F.col("a.source")), "left")
        .join(found.alias("f"), F.col("d.source").eqNullSafe(F.col("f.source")), "left")
        .select("d.doc_id", "d.source", "size", "key", "source_size", "target", rate.alias("rate"))
        .withColumn("fixed", F.round(F.col("rate") * _FIXED).cast("long"))
    )
    run = with_prefix(rated, ["source", "size", "key", "doc_id"], "fixed", "before", "mix-rates")
    steps = lambda c: F.floor((c + _FIXED // 2) / _FIXED)
    cut = materialize(run.withColumn("copies", (steps(F.col("before") + F.col("fixed")) - steps(F.col("before"))).cast("long")).drop("before", "fixed"), "mix-copies")

    moves = _moves(cut, cap).withColumnRenamed("copies", "of_copies")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in ("source", "doc_id", "key")] + [F.col("c.copies") == F.col("of_copies")]
    return (
        cut.alias("c").join(moves.alias("m"), same[0] & same[1] & same[2] & same[3], "left")
        .withColumn("copies", F.col("copies") + F.coalesce(F.col("move"), F.lit(0)))
        .select("c.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies", "c.key")
    )


def _moves(cut: DataFrame, cap: int) -> DataFrame:
    """Copies to add or take away so that each source comes nearest its target: source, doc_id, key, copies, move. Repeated rows can
    differ in copies; a move is for those of them with the copies that it names."""
    rows = cut.filter("size > 0").groupBy("source", "doc_id", "key", "size", "copies").agg(F.count("*").alias("n"))
    words = F.col("n") * F.col("size")
    both = rows.withColumn("move", F.explode(F.array(F.lit(1), F.lit(-1)))).filter((F.col("copies") + F.col("move")).between(0, cap))
    best = both.groupBy("source", F.floor(F.log2(words.cast("double"))).alias("class"), "move").agg(F.min(F.struct("n", "size", "key", "doc_id", "copies")).alias("b"))
    picks = best.groupBy("source").agg(F.sort_array(F.collect_list(F.struct((F.col("b.n") * F.col("b.size")).alias("words"), "move", F.col("b.doc_id").alias("doc_id"), F.col("b.key").alias("key"), F.col("b.copies").alias("copies"))), asc=False).alias("list"))
    lack = cut.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("lack"))
    both_ = picks.alias("p").join(lack.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")))
    # at most two rows for each power of two, from the largest down; a move is made if it brings the source nearer
    made = F.expr(
        "aggregate(list, named_struct('lack', lack, 'made', array_repeat(list[0], 0)), (a, m) -> "
        "if(abs(a.lack - m.words * m.move) < abs(a.lack), named_struct('lack', a.lack - m.words * m.move, 'made', array_append(a.made, m)), a), a -> a.made)"
    )
    moves = both_.select(F.col("p.source").alias("source"), F.explode(made).alias("m")).select("source", "m.doc_id", "m.key", "m.copies", "m.move")
    return moves.groupBy("source", "doc_id", "key", "copies").agg(F.sum("move").alias("move"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents themselves, each as often as its copies; rows that agree in id, text and source pool theirs."""
    copies = mix(docs).groupBy("doc_id", "key").agg(F.sum("copies").cast("int").alias("_copies")).filter("_copies > 0")
    keyed = docs.select(F.col("doc_id").alias("_d"), F.xxhash64("doc_id", "text", "source").alias("_key"), packed(docs)).dropDuplicates(["_d", "_key"])
    joined = keyed.join(copies, F.col("_d").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("key")))
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")

"""Line dedup with overlapping three-line windows, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueweave.llm.common import discard, materialize, packed, quoted


def _windows(docs: DataFrame, text: Column) -> DataFrame:
    """_id, _th, pos, h1, h2: one row a window of three consecutive trimmed lines; 96 bits keep chance matches away at any size.

    The lines are a column of their own, so that a text is split once.
    """
    lines = docs.select("_id", "_th", F.transform(F.split(text, "\n"), F.trim).alias("_lines"))
    n = F.greatest(F.size("_lines") - 2, F.lit(0))
    three = F.arrays_zip(*[F.slice("_lines", F.lit(1 + k), n).alias(f"l{k}") for k in range(3)])
    rows = lines.select("_id", "_th", F.posexplode(three).alias("pos", "w")).select("_id", "_th", "pos", "w.l0", "w.l1", "w.l2")
    full = rows.filter("l0 != '' or l1 != '' or l2 != ''")
    return full.select("_id", "_th", "pos", F.xxhash64("l0", "l1", "l2").alias("h1"), F.hash("l2", "l0", "l1").alias("h2"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every line that a later occurrence of a three-line window covers.

    A text is cut at newlines. Two windows are the same when their three lines are, outer spaces aside; windows of
    three blank lines don't count. The first occurrence in the order of (id, nulls last; text hash; position) stays,
    and the lines that all later ones cover, within the same text too, are merged and removed. Every line removed has
    an earlier equal one that stays. Texts under three lines stay as they are, null texts stay null, and a text all of
    whose lines go becomes empty. Rows that repeat both id and text are one document and are treated alike. All columns
    are kept; n_lines and n_removed are added (columns of those names are replaced).

    A hot window is one row in each map task after partial aggregation; in the join that finds later occurrences its
    rows lie on one side only, where adaptive execution splits them.
    """
    docs = docs.drop("n_lines", "n_removed")
    names, text = docs.columns, F.col("_text")
    docs = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).alias("_text"), packed(docs.drop(text_col))).withColumn("_th", F.xxhash64(text))
    windows = materialize(_windows(docs.select("_id", "_th", "_text"), text), "line-windows")
    place = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_th", "pos")
    firsts = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last").select("h1", "h2", "first")
    later = windows.hint("merge").join(firsts, ["h1", "h2"]).filter(place != F.col("first"))
    marks = materialize(later.groupBy("_id", "_th").agg(F.collect_set("pos").alias("_starts")), "line-marks")
    discard(windows)

    # texts are dealt by document at every size; left to a size check, a small table of marks would be broadcast and a larger one not
    joined = docs.alias("d").join(marks.hint("merge").alias("m"), F.col("d._id").eqNullSafe(F.col("m._id")) & (F.col("d._th") == F.col("m._th")), "left")
    joined = joined.withColumn("_lines", F.split(text, "\n"))
    n = F.size("_lines")
    covered = F.flatten(F.transform("m._starts", lambda p: F.array(p, p + 1, p + 2)))
    joined = joined.withColumn("_kept", F.array_except(F.sequence(F.lit(0), n - 1), covered))
    changed = F.col("_starts").isNotNull()
    new = F.when(changed, F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")).otherwise(text)
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(n)
    removed = F.when(changed, n - F.size("_kept")).otherwise(F.lit(0))
    return joined.select(
        *[new.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in names],
        n_lines.cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
    )


#: The same rows in DuckDB, for tables whose ids are unique.
SQL = """
WITH t AS (SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents),
w AS (SELECT doc_id, pos, trim(a[pos + 1], ' ') || chr(10) || trim(a[pos + 2], ' ') || chr(10) || trim(a[pos + 3], ' ') AS k
      FROM (SELECT doc_id, a, unnest(range(0, len(a) - 2)) AS pos FROM t)),
o AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS LAST, pos) AS rn FROM w WHERE length(k) > 2),
m AS (SELECT doc_id, list(DISTINCT pos + d + 1) AS gone FROM o, (VALUES (0), (1), (2)) v(d) WHERE rn > 1 GROUP BY doc_id)
SELECT t.doc_id,
       CASE WHEN gone IS NULL THEN text
            ELSE array_to_string(list_transform(list_filter(range(1, len(a) + 1), lambda i: NOT list_contains(gone, i)), lambda i: a[i]), chr(10)) END AS text,
       CAST(coalesce(len(a), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed
FROM t LEFT JOIN m USING (doc_id)
"""

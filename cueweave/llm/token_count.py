"""Token counts: heap-and-linked-list byte-pair merging, no ids emitted."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueweave.llm import bpe
from cueweave.llm.common import sliced, small_batches

_COUNTERS: dict[tuple[str, str], bpe.Counter] = {}  # lives as long as the Python worker; each holds a bounded cache


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    Null and empty texts count 0. Repeated rows stay repeated; null ids stay null; other columns are dropped. A special
    string inside a text counts as one token, as the library does by default. Nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    schema = docs.select(F.col(id_col)).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, pattern)
        counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, bpe.Counter(path, pattern))
        for b in sliced(batches):
            n = [counter.count(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("_text"), F.octet_length(text).cast("long").alias("_bytes"))
    return rows.mapInArrow(count, schema)

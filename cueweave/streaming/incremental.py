"""The same operators over growing inputs, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cueweave.functions import text
from cueweave.operators import report


def cue_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    """Cues from Parquet files as they come in."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def event_time(ms_col: str = "start_ms", epoch: str = "2024-01-01 00:00:00"):
    """Media time as a timestamp, for watermarks and windows."""
    return F.timestamp_millis(F.unix_millis(F.lit(epoch).cast("timestamp")) + F.col(ms_col))


def session_clusters(cues: DataFrame, gap: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    """Clusters of garbled cues by session windows; rows later than the watermark are dropped."""
    at = cues.filter("is_garbled").withColumn("at", event_time()).withWatermark("at", late)
    return at.groupBy("ep", F.session_window("at", gap).alias("w")).agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("n")).drop("w")


def garbled_rates(cues: DataFrame, window: str = "60 seconds", late: str = "10 minutes", lang: str = "en") -> DataFrame:
    """Cues and garbled cues in tumbling windows of media time."""
    at = cues.withColumn("at", event_time()).withWatermark("at", late)
    return at.groupBy(F.window("at", window).alias("w")).agg(F.count("*").alias("n"), F.count_if(text.is_garbled(F.col("text"), lang)).alias("n_garbled")).select(F.col("w.start").alias("window_start"), "n", "n_garbled")


def unseen(cues: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Each (ep, start_ms) once, within the watermark: what a resumed run still has to do."""
    return cues.withColumn("at", event_time()).withWatermark("at", late).dropDuplicatesWithinWatermark(["ep", "start_ms"]).drop("at")


BUCKETS = 256


def merge_into_report(entries: DataFrame, folder: str, checkpoint: str, once: bool = True, buckets: int = BUCKETS) -> StreamingQuery:
    """Merge a stream of report rows into the report below `folder`.

    Rows lie in buckets by key, and what decides about a row, in whichever layer, lies in its bucket. A batch reads and writes the
    buckets it has rows for and no others; a manifest (one line a bucket) then says where each bucket's rows of that state are.
    A batch that runs again starts from the manifest before it, so a replay gives the same result; statuses never fall.
    """

    def step(batch: DataFrame, n: int) -> None:
        merge_batch(batch, folder, n, buckets)

    writer = entries.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def merge_batch(batch: DataFrame, folder: str, n: int, buckets: int = BUCKETS) -> None:
    """Merge report rows as batch n into the state after batch n - 1 (the latest one before n that is there)."""
    spark = batch.sparkSession
    key = report.entry_key(F.col("ep"), F.col("time"), F.col("original"))
    of = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    rows = batch.select("layer", "ep", "time", "original", "corrected", "status")
    touched = sorted(r["bucket"] for r in rows.select(of).distinct().collect())  # at most one a bucket
    before = _manifest(spark, folder, n - 1)
    paths = [before[b] for b in touched if b in before]
    old = spark.read.parquet(*paths) if paths else rows.limit(0)
    target = f"{folder}/rows/batch={n}"
    report.merge(old, rows).withColumn("bucket", of).repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(target)
    now = before | {b: f"{target}/bucket={b}" for b in touched}
    _write(spark, f"{folder}/manifest/{n:012d}", "".join(f"{b}\t{p}\n" for b, p in sorted(now.items())))


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _write(spark: SparkSession, path: str, content: str) -> None:
    """A small file, whole or not at all."""
    p, fs = _store(spark, path)
    draft, _ = _store(spark, f"{path}.writing")
    out = fs.create(draft, True)
    out.write(bytearray(content.encode()))
    out.close()
    fs.delete(p, False)
    fs.rename(draft, p)


def _manifest(spark: SparkSession, folder: str, n: int) -> dict[int, str]:
    """Where the buckets of the latest state up to batch n are."""
    p, fs = _store(spark, f"{folder}/manifest")
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    known = [x for x in names if x.isdigit() and int(x) <= n]
    if not known:
        return {}
    lines = spark.read.text(f"{folder}/manifest/{max(known)}").collect()  # one a bucket
    return {int(b): path for b, path in (r["value"].split("\t") for r in lines)}


def snapshot(spark: SparkSession, folder: str, n: int) -> DataFrame | None:
    """The report after batch n, or None before the first one."""
    paths = _manifest(spark, folder, n)
    return spark.read.parquet(*[paths[b] for b in sorted(paths)]) if paths else None

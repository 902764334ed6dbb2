"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import threading
import time
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset a local session gets a temporary
    one; on a cluster no folder of the driver's would do, so that is an error."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    there = spark.sparkContext._jsc.sc().getCheckpointDir()
    if there.isDefined():
        return there.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
    folder = tempfile.mkdtemp(prefix="cueweave-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class _Scratch(threading.local):
    """Tables of the scopes that are open in this thread."""

    def __init__(self) -> None:
        self.open: list[list[DataFrame]] = []


_scratch = _Scratch()
_left: dict[str, SparkSession] = {}  # folders that lazy results may still read


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Tables materialized inside (by this thread) are deleted at the end, once their readers are done. Operators give lazy
    results that read such tables, so what shall stay is written inside and read again: `materialize(result, name, keep=True)`."""
    _scratch.open.append([])
    try:
        yield
    finally:
        discard(*_scratch.open.pop())


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which `tidy` deletes."""
    path = f"{shared_dir(spark)}/cueweave/{name}-{uuid.uuid4().hex}"
    _left[path.rsplit("/", 1)[1]] = spark
    return path


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and lost executors cost only reads."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    if _scratch.open and not keep:
        _scratch.open[-1].append(stored)
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for df in stored:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/cueweave/" in folder:
                _delete(df.sparkSession, folder)


def tidy(spark: SparkSession) -> int:
    """Delete all tables and files in the shared folder that operators of this session have left for their lazy results; to be called when these have
    been written or shown. Returns how many there were."""
    names = [n for n, s in list(_left.items()) if s.sparkContext is spark.sparkContext]
    for n in names:
        _delete(spark, f"{shared_dir(spark)}/cueweave/{n}")
    return len(names)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _left.pop(folder.rstrip("/").rsplit("/", 1)[1], None)


def release(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a finished job once nothing holds its plan any more; have both collectors look now, so
    that the files of earlier steps do not lie beside those of later ones. What Python lets go reaches the JVM a moment later,
    so they look twice, with a pause."""
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark._jvm.System.gc()


def added(df: DataFrame, ddl: str) -> StructType:
    """The schema of df with more fields."""
    return StructType(df.schema.fields + StructType.fromDDL(ddl).fields)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, name: str = "_row") -> Column:
    """All columns as one struct: rows travel whole and no name of theirs can clash with an operator's own."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in df.columns]).alias(name)


BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of one Arrow batch, so that very long texts do not add up in a Python worker.

    Lazy plans read the setting when they run, so it stays; every operator sets the same value and never raises a lower one.
    How many rows a function takes at a time is its own matter: see `sliced`.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def with_prefix(df: DataFrame, order: list[str], value: str, out: str, name: str) -> DataFrame:
    """Add `out`: the sum of the long column `value` over all rows before this one in the order of `order`.

    The rows are dealt into ranges of `order`, which must be unique enough that no single key is hot; each range adds
    up its own rows and starts at the total of the ranges before it. Only one row a range meets in one task.
    """
    ranged = materialize(
        df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), name
    )
    totals = ranged.groupBy("_pid").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_pid", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(starts), "_pid")  # one row a partition
        .withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_pid", "_start")
    )

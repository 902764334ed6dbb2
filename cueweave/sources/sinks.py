"""Subtitle files out: one object a file, with a byte order mark if wanted, through a Spark data source with task commits.

A task writes each of its files below a folder of its own attempt and tells the driver their names; only when all tasks have
succeeded do the files move to their places, many at a time. A failed or repeated task leaves nothing behind. Stores are reached by
pyarrow's file systems (local and mounted paths, hdfs, s3, gs).
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from cueweave.functions.timecode import ass_time

MOVES = 32  # at a time


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class FileWriter(DataSourceWriter):
    """Rows (file, content) to files of those names below a folder."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.encoding = "utf-8-sig" if options.get("bom", "false").lower() == "true" else "utf-8"
        self.job = uuid.uuid4().hex

    def _store(self) -> tuple[pafs.FileSystem, str]:
        if "://" not in self.path and not self.path.startswith("file:"):
            return pafs.LocalFileSystem(), self.path
        return pafs.FileSystem.from_uri(self.path)

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        fs, root = self._store()
        folder, names = f"{root}/_writing/{self.job}/{uuid.uuid4().hex}", []
        fs.create_dir(folder, recursive=True)
        for row in rows:
            name = row["file"]
            if not name or "/" in name or name in (".", "..") or name.startswith("_"):
                raise ValueError(f"not a file name: {name!r}")
            with fs.open_output_stream(f"{folder}/{name}") as out:
                out.write((row["content"] or "").encode(self.encoding))
            names.append(name)
        return Written(folder, names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = self._store()
        moves = [(f"{m.folder}/{n}", f"{root}/{n}") for m in messages if m for n in m.names]
        double = [n for n, k in Counter(to for _, to in moves).items() if k > 1]
        if double:
            self._clear()
            raise ValueError(f"several rows for one file: {sorted(double)[:3]}")
        if self.overwrite:
            new = {to for _, to in moves}
            old = [x.path for x in fs.get_file_info(pafs.FileSelector(root)) if x.type == pafs.FileType.File and x.path not in new]
            with ThreadPoolExecutor(MOVES) as pool:
                list(pool.map(fs.delete_file, old))
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda m: fs.move(*m), moves))
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, root = self._store()
        for folder in (f"{root}/_writing/{self.job}", f"{root}/_writing"):
            there = fs.get_file_info(folder).type == pafs.FileType.Directory
            if there and (folder.endswith(self.job) or not fs.get_file_info(pafs.FileSelector(folder))):
                fs.delete_dir(folder)


class NamedFiles(DataSource):
    """format("named_files"): option path, and bom for a byte order mark."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options, overwrite)


def write_files(rendered: DataFrame, folder: str, bom: bool = False, mode: str = "append") -> None:
    """Write rows (file, content), each as one file of that name in the folder. append replaces files of the same names; overwrite
    also removes all others of the folder. Two rows for one file and names with a slash are errors that leave the folder as it was."""
    rendered.sparkSession.dataSource.register(NamedFiles)
    rendered.select("file", "content").write.format("named_files").option("path", folder).option("bom", str(bom).lower()).mode(mode).save()


# fixed values: what an ASS file begins with
ASS_HEAD = (
    "[Script Info]\nScriptType: v4.00+\nPlayResX: 384\nPlayResY: 288\n\n[V4+ Styles]\n"
    "Format: Name, Fontname, Fontsize, PrimaryColour, SecondaryColour, OutlineColour, BackColour, Bold, Italic, Underline, StrikeOut, ScaleX, ScaleY, Spacing, Angle, BorderStyle, Outline, Shadow, Alignment, MarginL, MarginR, MarginV, Encoding\n"
    "Style: Default,Arial,16,&Hffffff,&Hffffff,&H0,&H0,0,0,0,0,100,100,0,0,1,1,0,2,10,10,10,0\n\n[Events]\nFormat: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text\n"
)


def new_ass(cues: DataFrame, template: DataFrame | None = None) -> DataFrame:
    """file, content of new ASS files from cues (file, idx, start_ms, end_ms, text). template (file, head) gives a file its head up to the
    Format line of its events; others take the common one."""
    n = F.row_number().over(Window.partitionBy("file").orderBy("start_ms", "idx"))
    line = F.concat(F.lit("Dialogue: 0,"), ass_time(F.col("start_ms")), F.lit(","), ass_time(F.col("end_ms")), F.lit(",Default,,0,0,0,,"), F.replace("text", F.lit("\n"), F.lit("\\N")))
    body = cues.select("file", n.alias("_n"), line.alias("_line")).groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_n", "_line"))), lambda x: x["_line"]), "\n").alias("_body"))
    head = F.lit(ASS_HEAD)
    if template is not None:
        body = body.join(template.select("file", "head"), "file", "left")
        head = F.coalesce(F.concat(F.rtrim("head"), F.lit("\n")), head)
    return body.select("file", F.concat(head, "_body", F.lit("\n")).alias("content"))


def ass_heads(ass: DataFrame) -> DataFrame:
    """file, head of parsed ASS files: all lines before the first dialogue or comment line."""
    first = ass.withColumn("_first", F.min(F.when(F.col("kind") != "other", F.col("line"))).over(Window.partitionBy("file")))
    rows = first.filter("_first is null or line < _first")
    return rows.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "s"))), lambda x: x["s"]), "\n").alias("head"))


def registered(spark: SparkSession) -> SparkSession:
    """The session, with format("named_files")."""
    spark.dataSource.register(NamedFiles)
    return spark

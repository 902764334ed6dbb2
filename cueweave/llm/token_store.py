"""Token-id store: independent zstandard frames with a trailing seek table and per-frame checksums.

One file holds a run of documents in ascending id order. Layout, all integers little-endian:

    one zstandard frame a document       its ids as unsigned 32-bit integers
    skippable frame 0x184D2A50           one byte (1: id present) and a signed 64-bit id for each document
    skippable frame 0x184D2A5E           seek table: (compressed size, size, low 32 bits of XXH64) for each frame,
                                         then the number of frames, 0x80, and 0x8F92EAB1

The seek table follows the published zstandard seekable format, so other readers open the files too; the id index is
itself a frame of that table with size 0. A reader takes the end of a file, its index and the frames that it is asked for,
and no other byte; `open_file` does so on any store that pyarrow knows.

Files are written by Spark's own writer, so they go to any store of the cluster and tasks that are lost or run twice leave
no half files: a file is one row of the text writer, whose line end is the four bytes that end a seek table.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueweave.llm import bpe
from cueweave.llm.common import new_folder, sliced, small_batches

# fixed values of the file format
SEEK_MAGIC, SKIP_MAGIC, FOOT_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
FOOT = struct.pack("<I", FOOT_MAGIC)
FILE_BYTES = 4 << 20

_ENCODERS: dict[str, bpe.Encoder] = {}  # lives as long as the Python worker; each holds a bounded cache


def checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FileWriter:
    """Gathers the frames of one file."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.table: list[bytes] = []
        self.ids: list[bytes] = []
        self.size = self.tokens = 0

    def add(self, doc_id: int | None, frame: bytes, size: int, check: int) -> None:
        self.frames.append(frame)
        self.table.append(struct.pack("<III", len(frame), size, check))
        self.ids.append(struct.pack("<?q", doc_id is not None, doc_id or 0))
        self.size += len(frame)
        self.tokens += size // 4

    def body(self) -> bytes:
        """The file without the four bytes that end it."""
        index = b"".join(self.ids)
        index = struct.pack("<II", SKIP_MAGIC, len(index)) + index
        table = b"".join(self.table) + struct.pack("<III", len(index), 0, checksum(b""))
        seek = struct.pack("<II", SEEK_MAGIC, len(table) + 9) + table + struct.pack("<IB", len(self.frames) + 1, 0x80)
        return b"".join([*self.frames, index, seek])


class FileReader:
    """Opens a file from its end; frames are fetched and decompressed only when asked for. source: bytes or a seekable file."""

    def __init__(self, source: bytes | io.RawIOBase):
        import zstandard

        self.file, self.unzip = io.BytesIO(source) if isinstance(source, bytes) else source, zstandard.ZstdDecompressor()
        size = self.file.seek(0, io.SEEK_END)
        if size < 9:
            raise ValueError("not a seekable file with checksums")
        frames, flags, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != FOOT_MAGIC or not flags & 0x80:
            raise ValueError("not a seekable file with checksums")
        self.entries, place = [], 0
        for packed, n, check in struct.iter_unpack("<III", self._bytes(size - 9 - 12 * frames, 12 * frames)):
            self.entries.append((place, packed, n, check))
            place += packed
        start, packed, _, _ = self.entries.pop()
        self.ids = [i if there else None for there, i in struct.iter_unpack("<?q", self._bytes(start + 8, packed - 8))]
        self.tokens = sum(e[2] for e in self.entries) // 4

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def read(self, k: int) -> bytes:
        place, packed, size, check = self.entries[k]
        ids = self.unzip.decompress(self._bytes(place, packed), max_output_size=size) if size else b""
        if len(ids) != size or checksum(ids) != check:
            raise ValueError(f"frame {k} is damaged")
        return ids

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(id, tokens before it in this file, id bytes) of all documents, or of those wanted."""
        keep, before = None if wanted is None else set(wanted), 0
        for k, doc_id in enumerate(self.ids):
            if keep is None or doc_id in keep:
                yield doc_id, before, self.read(k)
            before += self.entries[k][2] // 4


def open_file(uri: str) -> FileReader:
    """A file of the store for reading single documents; only the ranges that are needed are fetched."""
    from pyarrow.fs import FileSystem

    store, path = FileSystem.from_uri(uri)
    return FileReader(store.open_input_file(path))


def write_files(docs: DataFrame, path: str, folder: str | None = None, end_id: int = 2, file_bytes: int = FILE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode whole texts and write them as files in ascending id order to a new folder, which is returned.

    The folder is in the shared one unless it is given, and is the caller's to delete (`common.tidy`). File names rise with the ids
    (`file_place`). Rows are dealt into ranges of (id, text hash, row number), so that repeated rows need not stay together;
    each task encodes its range and closes a file whenever it holds file_bytes. Null ids come first. Only whole texts are
    shuffled, once, and nothing but the files is written.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        coder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, bpe.Encoder(path))
        end, zip_ = struct.pack("<I", end_id), zstandard.ZstdCompressor(level=1)
        w = FileWriter()
        done = lambda: pa.RecordBatch.from_arrays([pa.array([w.body()], pa.binary())], names=["file"])
        for b in sliced(batches, 1024):
            for doc_id, raw in zip(b.column(0).to_pylist(), coder.encode(b.column(1).to_pylist()), strict=True):
                ids = raw + end
                w.add(doc_id, zip_.compress(ids), len(ids), checksum(ids))
                if w.size >= file_bytes:
                    yield done()
                    w = FileWriter()
        if w.ids:
            yield done()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    order = ["doc_id", "_hash", "_row"]
    dealt = rows.withColumn("_hash", F.xxhash64("_text")).withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    folder = folder or new_folder(docs.sparkSession, "token-files")
    files = dealt.select("doc_id", "_text").mapInArrow(work, "file binary").select(F.col("file").cast("string"))
    files.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", FOOT.decode("latin-1")).text(folder)
    return folder


def file_place() -> list:
    """part, seq of the file in the column `path`: files in their order are those of part 0, then of part 1, and so on."""
    name = F.regexp_extract("path", "[^/]*$", 0)
    return [F.regexp_extract(name, p, 1).cast("int").alias(c) for c, p in (("part", "^part-(\\d+)"), ("seq", "-c(\\d+)[^-]*$"))]


def read_files(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """Documents read back from the files of a folder: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    With `wanted`, only the frames of those ids are decompressed. Only one row a file meets in one task.
    """
    small_batches(spark)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([FileReader(b.column(2)[0].as_py()).tokens], pa.int64())], names=["part", "seq", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 1):
            part, seq, data = (c[0].as_py() for c in b.columns)
            out = [(part, seq, d, before, len(ids) // 4, zlib.crc32(ids)) for d, before, ids in FileReader(data).documents(wanted)]
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    kinds, names = [pa.int32()] * 2 + [pa.int64()] * 4, ["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32"]
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select(*file_place(), "content")
    rows = files.mapInArrow(work, "part int, seq int, doc_id long, before long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.mapInArrow(totals, "part int, seq int, n long").select("part", "seq", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, ["part", "seq"]).select("doc_id", (F.col("_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def store(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Encode, write files, read them back: doc_id, start, n_tokens, ids_crc32 of every document.

    Null and empty texts hold end_id alone; null ids sort first; repeated ids stay apart, ordered by content; other
    columns are ignored; an empty table gives no row.
    """
    return read_files(docs.sparkSession, write_files(docs, path, end_id=end_id))

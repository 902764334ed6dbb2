"""Matroska media columns: EBML elements, clusters, lacing and cues, written from and parsed into packet tables.

`mux` stores bytes as the 8-bit samples of one PCM track; `demux` reads any file of this kind, with known or unknown
element sizes, simple blocks or block groups, and all four lacings, into a packet table of timestamps, tracks and byte
ranges. Both are small helpers over one value; the DataFrame operators below run them inside Arrow batches.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueweave.llm.common import added, sliced, small_batches

# fixed values of the format: element ids
EBML, VERSION, READ_VERSION, MAX_ID, MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, SCALE, DURATION, MUXER, WRITER = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, ENTRY, NUMBER, UID, KIND, LACING, CODEC, AUDIO, RATE, CHANNELS, DEPTH = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIME, SIMPLE, GROUP, BLOCK, BLOCK_DURATION = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
CUES, POINT, CUE_TIME, POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
SEGMENT_PARTS = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367}  # what may follow an unknown-size cluster

SAMPLE_RATE = 8000
FRAME, LACED, CLUSTER_SAMPLES = 1024, 8, 24_576  # block times are relative 16-bit numbers, so a cluster stays under 32,768
NO_LACING, XIPH, FIXED, EBML_LACING = range(4)


def _size(n: int, width: int = 0) -> bytes:
    """A data size as a variable-length integer; all ones is kept for unknown sizes."""
    w = max(width, next(w for w in range(1, 9) if n < (1 << 7 * w) - 1))
    return (n | 1 << 7 * w).to_bytes(w, "big")


def element(kind: int, data: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + _size(len(data)) + data


def _uint(kind: int, n: int) -> bytes:
    return element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def _lace(sizes: list[int], how: int) -> bytes:
    """The part of a block that tells frame sizes."""
    if how == NO_LACING:
        return b""
    head = bytes([len(sizes) - 1])
    if how == XIPH:
        return head + b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    if how == EBML_LACING:
        head += _size(sizes[0])
        for a, b in zip(sizes, sizes[1:-1], strict=False):
            d = b - a
            w = next(w for w in range(1, 9) if abs(d) < (1 << 7 * w - 1) - 1)
            head += (d + (1 << 7 * w - 1) - 1 | 1 << 7 * w).to_bytes(w, "big")
    return head


def block(track: int, time: int, frames: list[bytes], how: int | None = None, flags: int = 0x80) -> bytes:
    """A block's data; without `how`, equal frames use fixed lacing and others the EBML kind."""
    sizes = [len(f) for f in frames]
    if how is None:
        how = NO_LACING if len(frames) == 1 else FIXED if len(set(sizes)) == 1 else EBML_LACING
    return _size(track) + struct.pack(">hB", time, flags | how << 1) + _lace(sizes, how) + b"".join(frames)


_HEADER = element(
    EBML, _uint(VERSION, 1) + _uint(READ_VERSION, 1) + _uint(MAX_ID, 4) + _uint(MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + _uint(DOC_VERSION, 4) + _uint(DOC_READ, 2)
)
_TRACK = element(
    TRACKS,
    element(
        ENTRY,
        _uint(NUMBER, 1) + _uint(UID, 1) + _uint(KIND, 2) + _uint(LACING, 1) + element(CODEC, b"A_PCM/INT/LIT")
        + element(AUDIO, element(RATE, struct.pack(">d", SAMPLE_RATE)) + _uint(CHANNELS, 1) + _uint(DEPTH, 8)),
    ),
)


def mux(payload: bytes) -> bytes:
    """A file whose only track holds the payload as 8-bit samples, one tick a sample."""
    info = element(INFO, _uint(SCALE, 1_000_000_000 // SAMPLE_RATE) + element(DURATION, struct.pack(">d", len(payload))) + element(MUXER, b"cueweave") + element(WRITER, b"cueweave"))
    parts, place, cues = [info, _TRACK], len(info) + len(_TRACK), []
    for start in range(0, len(payload), CLUSTER_SAMPLES):
        body = [_uint(TIME, start)]
        end = min(start + CLUSTER_SAMPLES, len(payload))
        for at in range(start, end, FRAME * LACED):
            stop = min(at + FRAME * LACED, end)
            body.append(element(SIMPLE, block(1, at - start, [payload[i : min(i + FRAME, stop)] for i in range(at, stop, FRAME)])))
        cues.append(element(POINT, _uint(CUE_TIME, start) + element(POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER, place))))
        parts.append(element(CLUSTER, b"".join(body)))
        place += len(parts[-1])
    parts.append(element(CUES, b"".join(cues)))
    return _HEADER + element(SEGMENT, b"".join(parts))


@dataclass
class Media:
    """Tables of one file. Packets: (track, time in ns, first byte, bytes, key frame). Cues: (time in ns, track, cluster's byte)."""

    doc_type: str = ""
    scale: int = 1_000_000
    duration: float = 0.0
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[tuple[int, int, int, int, bool]] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    clusters: int = 0
    lacings: list[int] = field(default_factory=lambda: [0, 0, 0, 0])


def _head(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """Id, first byte of data and its end (-1: unknown) of the element at `at`."""
    if at >= end or not data[at]:
        raise ValueError(f"no element at byte {at}")
    w = 9 - data[at].bit_length()
    kind = int.from_bytes(data[at : at + w], "big")
    at += w
    if at >= end or not data[at]:
        raise ValueError(f"no size at byte {at}")
    w = 9 - data[at].bit_length()
    n = int.from_bytes(data[at : at + w], "big") & (1 << 7 * w) - 1
    at += w
    if n == (1 << 7 * w) - 1:
        return kind, at, -1
    if at + n > end:
        raise ValueError(f"element {kind:x} ends after its parent")
    return kind, at, at + n


def _children(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    while at < end:
        kind, start, stop = _head(data, at, end)
        if stop < 0:
            stop = _unknown_end(data, start, end) if kind == CLUSTER else end
        yield kind, start, stop
        at = stop


def _unknown_end(data: bytes, at: int, end: int) -> int:
    """An unknown-size cluster ends where a part of the segment starts."""
    while at < end:
        kind, _, stop = _head(data, at, end)
        if kind in SEGMENT_PARTS or stop < 0:
            return at
        at = stop
    return end


def _number(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _float(data: bytes, a: int, b: int) -> float:
    return struct.unpack(">d" if b - a == 8 else ">f", data[a:b])[0] if b > a else 0.0


def _frames(data: bytes, at: int, end: int, how: int) -> list[tuple[int, int]]:
    """(first byte, bytes) of the frames of a block whose lacing starts at `at`."""
    if how == NO_LACING:
        return [(at, end - at)]
    n, at, sizes = data[at] + 1, at + 1, []
    if how == XIPH:
        for _ in range(n - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    elif how == EBML_LACING:
        for k in range(n - 1):
            w = 9 - data[at].bit_length()
            v = _number(data, at, at + w) & (1 << 7 * w) - 1
            sizes.append(v if not k else sizes[-1] + v - ((1 << 7 * w - 1) - 1))
            at += w
    else:
        if (end - at) % n:
            raise ValueError("unequal frames under fixed lacing")
        sizes = [(end - at) // n] * (n - 1)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("frames are longer than their block")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return out


def _block(m: Media, data: bytes, at: int, end: int, base: int, key: bool | None) -> None:
    w = 9 - data[at].bit_length()
    track = _number(data, at, at + w) & (1 << 7 * w) - 1
    time, flags = struct.unpack_from(">hB", data, at + w)
    how = flags >> 1 & 3
    m.lacings[how] += 1
    ticks, rate = base + time, m.tracks.get(track, {}).get("rate")
    wide = (m.tracks[track]["depth"] // 8 or 1) * (m.tracks[track]["channels"] or 1) if rate else 1
    ns = ticks * m.scale
    for start, size in _frames(data, at + w + 3, end, how):
        m.packets.append((track, ns, start, size, bool(flags & 0x80) if key is None else key))
        if rate:  # samples tell how long a laced frame lasts
            ns += round(size // wide * 1_000_000_000 / rate)


def demux(data: bytes) -> Media:
    """Parse a file. Raises ValueError where it is damaged or cut short."""
    m = Media()
    try:
        for kind, a, b in _children(data, 0, len(data)):
            if kind == EBML:
                m.doc_type = next((data[x:y].decode("ascii", "replace") for k, x, y in _children(data, a, b) if k == DOC_TYPE), "matroska")
            elif kind == SEGMENT:
                _segment(m, data, a, b)
    except (IndexError, struct.error) as e:
        raise ValueError(f"the file is cut short: {e}") from None
    if not m.doc_type:
        raise ValueError("no EBML header")
    return m


def _segment(m: Media, data: bytes, a: int, b: int) -> None:
    for kind, x, y in _children(data, a, b):
        if kind == INFO:
            for k, p, q in _children(data, x, y):
                if k == SCALE:
                    m.scale = _number(data, p, q)
                elif k == DURATION:
                    m.duration = _float(data, p, q)
        elif kind == TRACKS:
            for k, p, q in _children(data, x, y):
                if k == ENTRY:
                    _track(m, data, p, q)
        elif kind == CLUSTER:
            m.clusters += 1
            base = 0
            for k, p, q in _children(data, x, y):
                if k == TIME:
                    base = _number(data, p, q)
                elif k == SIMPLE:
                    _block(m, data, p, q, base, None)
                elif k == GROUP:
                    inner = list(_children(data, p, q))
                    refers = any(i == 0xFB for i, _, _ in inner)
                    for i, r, s in inner:
                        if i == BLOCK:
                            _block(m, data, r, s, base, not refers)
        elif kind == CUES:
            for k, p, q in _children(data, x, y):
                if k == POINT:
                    time = track = place = 0
                    for i, r, s in _children(data, p, q):
                        if i == CUE_TIME:
                            time = _number(data, r, s) * m.scale
                        elif i == POSITIONS:
                            for j, u, v in _children(data, r, s):
                                track = _number(data, u, v) if j == CUE_TRACK else track
                                place = _number(data, u, v) if j == CUE_CLUSTER else place
                            m.cues.append((time, track, a + place))


def _track(m: Media, data: bytes, p: int, q: int) -> None:
    t = {"codec": "", "kind": 0, "rate": 0.0, "channels": 1, "depth": 0}
    number = 0
    for k, a, b in _children(data, p, q):
        if k == NUMBER:
            number = _number(data, a, b)
        elif k == CODEC:
            t["codec"] = data[a:b].decode("ascii", "replace")
        elif k == KIND:
            t["kind"] = _number(data, a, b)
        elif k == AUDIO:
            for i, x, y in _children(data, a, b):
                if i == RATE:
                    t["rate"] = _float(data, x, y)
                elif i == CHANNELS:
                    t["channels"] = _number(data, x, y)
                elif i == DEPTH:
                    t["depth"] = _number(data, x, y)
    m.tracks[number] = t


def samples(data: bytes, m: Media, track: int = 1) -> bytes:
    """A track's bytes, put together from its packets."""
    return b"".join(data[at : at + n] for t, _, at, n, _ in m.packets if t == track)


def seek(data: bytes, m: Media, ns: int, track: int = 1) -> tuple[int, int, int, int, bool] | None:
    """The packet of a track that plays at `ns`, found from the last cue before it; only that cluster and later ones are parsed."""
    start = max((c for c in m.cues if c[0] <= ns and c[1] == track), default=None)
    part = Media(scale=m.scale, tracks=m.tracks)
    if start is None:
        part.packets = m.packets
    else:
        kind, a, b = _head(data, start[2], len(data))
        if kind != CLUSTER:
            raise ValueError("a cue does not point to a cluster")
        _segment(part, data, start[2], b if b >= 0 else _unknown_end(data, a, len(data)))
    return max((p for p in part.packets if p[0] == track and p[1] <= ns), key=lambda p: p[1], default=None)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each whole text as UTF-8 (null: empty), padded with bytes 0 to a positive multiple of 64, as a file.

    Repeated rows stay repeated, null ids stay null, extra columns are dropped, an empty table gives no row.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            raw = b.column(1).to_pylist()
            media = [mux(t.ljust(max(64, -(-len(t) // 64) * 64), b"\0")) for t in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in raw], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    schema = added(docs.select(F.col(id_col).alias("doc_id")), "n_bytes long, media binary")
    return rows.mapInArrow(work, schema)


def packets(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row a packet: doc_id, packet (from 0), track, codec, time_ns, first_byte, n_bytes, key_frame, error.

    A file that is null or cannot be parsed gives one row that holds its id and error alone.
    """
    small_batches(media.sparkSession)
    schema = added(media.select(F.col(id_col).alias("doc_id")), "packet long, track long, codec string, time_ns long, first_byte long, n_bytes long, key_frame boolean, error string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for b in sliced(batches):
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    if data is None:
                        raise ValueError("null")
                    m = demux(data)
                    rows = [(i, k, t, m.tracks.get(t, {}).get("codec"), ns, at, n, key, None) for k, (t, ns, at, n, key) in enumerate(m.packets)]
                except ValueError as e:
                    rows = [(i, None, None, None, None, None, None, None, str(e))]
                cols = list(zip(*rows, strict=True)) or [()] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return media.select(F.col(id_col), F.col(media_col)).mapInArrow(work, schema)


def features(media: DataFrame) -> DataFrame:
    """Digest of stored files (doc_id, n_bytes, media), all from the bytes read back.

    doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (last 64 bytes), media_bytes, media_sha256, and feature:
    counts of packets, clusters and cues, blocks by lacing, playing time and sums over the samples.
    """
    small_batches(media.sparkSession)
    schema = added(media.select("doc_id"), "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")

    def digest(data: bytes) -> tuple:
        m = demux(data)
        payload = samples(data, m)
        x = np.frombuffer(payload, np.uint8).astype(np.int64)
        track = m.tracks[1]
        feature = (
            f"{m.doc_type};codec={track['codec']};rate={track['rate']:.0f};packets={len(m.packets)};clusters={m.clusters};cues={len(m.cues)};"
            f"blocks={','.join(map(str, m.lacings))};last_ns={m.packets[-1][1]};first_byte={m.packets[0][2]};sum={x.sum()};energy={(x * x).sum()};turns={int((np.diff(np.sign(x - 128)) != 0).sum())}"
        )
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for b in sliced(batches):
            cols = list(zip(*map(digest, b.column(2).to_pylist()), strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=schema.names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(work, schema)

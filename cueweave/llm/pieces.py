"""SentencePiece encoding and decoding with N-best segmentation.

The lattice of a text has an edge for each vocabulary piece that matches, weighed by its log-probability; a character in no piece is one edge that stands
for its byte pieces. Forward Viterbi scores give the best way from the start to every position. They are exact heuristics
for the search that runs backward from the end: the agenda is ordered by the score of the path so far plus the Viterbi
score of what is left, so complete segmentations leave it best first.

No piece of the model has a mark for a space inside it, and byte-spelled characters share no piece with others, so the
lattice falls apart at such places. The best way through each part and the loss of its second best come from the
forward pass; only the N - 1 parts of least loss can differ among the N best of the text, so the search runs on those, and
the N least sums of losses are the N best of the whole. The result is that of one search over the whole lattice.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueweave.llm.common import added, sliced, small_batches

SPACE = "▁"
CACHE_ENTRIES, SEARCHED_ENTRIES = 300_000, 30_000
KEPT_PART = 64  # longer parts are too rare to keep
UNIT = 1_000_000
ZIPF = 100  # offset of the Zipf-Mandelbrot law
_PIECE = 1 << 20  # a piece costs one unit below the scores, so that fewer pieces win ties
_NONE = np.int64(-(1 << 61))
_MASK = (1 << 64) - 1
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C55), np.uint64(0xD6E8FEB86659FD93)

_CODERS: dict[tuple[str, int], Coder] = {}  # lives as long as the Python worker; each holds a bounded cache


def log_probabilities(scores: list[float]) -> list[float]:
    """What the pieces of a model cost. A unigram model gives log-probabilities, which stay.

    The scores of a BPE model are ranks of merges with a minus, whose sum over a segmentation means nothing: two early
    pieces would beat the whole word. Pieces are ranked by how common they are, so ranks are turned into probabilities by
    the Zipf-Mandelbrot law, p ~ 1 / (rank + ZIPF). Scores under -1e8 (runs of spaces that were added by hand) rank last.
    """
    if any(s != int(s) or s > 0 for s in scores):
        return scores
    known = [-s for s in scores if s > -1e8]
    ranks = [-s if s > -1e8 else max(known) for s in scores]
    total = math.log(sum(1 / (r + ZIPF) for r in ranks))
    return [-math.log(r + ZIPF) - total for r in ranks]


class Coder:
    """N-best segmentation under one model file. Scores are log-probabilities of pieces, in whole units of 1e-6."""

    def __init__(self, path: str, n_best: int = 4):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_best = n_best
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = log_probabilities([sp.get_score(i) for i in plain])
        self.pieces = {sp.id_to_piece(i): (i, round(s * UNIT) * _PIECE - 1) for i, s in zip(plain, scores, strict=True)}
        self.longest = max(map(len, self.pieces))
        self.byte_ids = {int(sp.id_to_piece(i)[3:-1], 16): i for i in ids if sp.is_byte(i)}
        least = min(scores)
        self.unknown = round((least - 10) * UNIT) * _PIECE
        self.unknown_id = sp.unk_id()
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece has a space inside it")
        # newline is the most common character in no piece; other such characters stay inside their part
        self.cut = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if "\n" not in "".join(self.pieces) else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        self.bytes_of = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else sp.id_to_piece(i).encode() for i in ids]
        self.known = {p for p in self.pieces if len(p) == 1}
        self.cache: dict[str, tuple[bytes, int, int, int | None]] = {}
        self.searched: dict[str, list[tuple[int, bytes, int]]] = {}
        self._fill_table()

    def edges(self, text: str) -> list[list[tuple[int, int, tuple[int, ...]]]]:
        """For each end position the pieces that end there: (start, score with the cost of its pieces, ids)."""
        into: list[list] = [[] for _ in range(len(text) + 1)]
        get, longest, n = self.pieces.get, self.longest, len(text)
        for i in range(n):
            if text[i] not in self.pieces:
                raw = text[i].encode("utf-8", "replace")
                ids = tuple(self.byte_ids[b] for b in raw) if self.byte_ids else (self.unknown_id,)
                into[i + 1].append((i, self.unknown - len(ids), ids))
            for j in range(i + 1, min(n, i + longest) + 1):
                if (hit := get(text[i:j])) is not None:
                    into[j].append((i, hit[1], (hit[0],)))
        return into

    def search(self, text: str) -> list[tuple[int, tuple[int, ...]]]:
        """The N best (score with cost of pieces, ids) of one part, best first; ties go to the path that is nearer its start."""
        into = self.edges(text)
        best = [0] * (len(text) + 1)
        for j in range(1, len(text) + 1):
            best[j] = max([best[i] + s for i, s, _ in into[j]])
        agenda: list = [(-best[-1], len(text), 0, 0, None)]
        found, pushed = [], 0
        while agenda and len(found) < self.n_best:
            _, at, _, done, path = heapq.heappop(agenda)
            if not at:
                ids: list[int] = []
                while path:
                    ids += path[0]
                    path = path[1]
                found.append((done, tuple(ids)))
                continue
            for i, s, ids_ in into[at]:
                pushed += 1
                heapq.heappush(agenda, (-(done + s + best[i]), i, pushed, done + s, (ids_, path)))
        return found

    def ways(self, text: str) -> list[tuple[int, bytes, int]]:
        """The N best of one part as (score with cost, ids, pieces)."""
        if (hit := self.searched.get(text)) is None:
            hit = [(s, array("I", ids).tobytes(), len(ids)) for s, ids in self.search(text)]
            if len(text) <= KEPT_PART:
                if len(self.searched) >= SEARCHED_ENTRIES:
                    self.searched.clear()
                self.searched[text] = hit
        return hit

    def first(self, parts: list[str]) -> Iterator[tuple[bytes, int, int, int | None]]:
        """(ids, pieces, score with cost, loss of the second best or None) of short parts that are spelled in pieces.

        Two-best Viterbi over all parts at once, one vector step for each end position and piece length. Among equals the
        piece that starts first wins, as in the search.
        """
        parts = sorted(parts, key=len, reverse=True)
        lengths = np.array([len(p) for p in parts])
        n, top = len(parts), int(lengths[0])
        chars = np.zeros((n, top), np.uint64)
        chars[np.arange(top) < lengths[:, None]] = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        h = np.zeros((top + 1, n), np.uint64)
        for j in range(top):
            h[j + 1] = h[j] * _BASE + chars[:, j] + np.uint64(1)
        best = np.full((top + 1, n), _NONE)
        second, back, used = best.copy(), np.zeros((top + 1, n), np.int16), np.zeros((top + 1, n), np.int32)
        best[0] = 0
        live = np.searchsorted(-lengths, -np.arange(1, top + 1), side="right")  # parts that reach each position
        for j in range(1, top + 1):
            m = live[j - 1]
            b, c = best[j, :m], second[j, :m]
            for size in range(min(j, self.longest), 0, -1):
                i = j - size
                at = self._find(h[j, :m] - h[i, :m] * self.powers[size])
                hit = np.flatnonzero(at >= 0)
                if not len(hit):
                    continue
                at = at[hit]
                score = self.table_score[at]
                one, two = best[i, hit] + score, second[i, hit] + score
                old, second_old = b[hit], c[hit]
                c[hit] = np.maximum(np.minimum(old, one), np.maximum(second_old, two))
                better = one > old
                hit, at = hit[better], at[better]
                b[hit] = one[better]
                back[j, hit] = size
                used[j, hit] = self.table_id[at]
        rows = np.arange(n)
        ids = np.zeros((n, top), np.uint32)
        pos, count = lengths.copy(), np.zeros(n, np.int64)
        while (go := np.flatnonzero(pos > 0)).size:
            count[go] += 1
            ids[go, top - count[go]] = used[pos[go], go]
            pos[go] -= back[pos[go], go]
        score, loss = best[lengths, rows], best[lengths, rows] - second[lengths, rows]
        raw = ids.tobytes()
        for k, (p, m, s, d) in enumerate(zip(parts, count.tolist(), score.tolist(), loss.tolist(), strict=True)):
            end = (k + 1) * top * 4
            yield p, (raw[end - 4 * m : end], m, s, d if d < -_NONE // 2 else None)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes in the table of pieces, -1 where there is none."""
        h = h ^ (h >> np.uint64(31))
        slot = (h * _SPREAD) >> np.uint64(44)
        out = np.where(self.table_hash[slot] == h, slot.astype(np.int64), -1)
        for _ in range(self.probes):
            miss = np.flatnonzero((out < 0) & (self.table_hash[slot] != 0))
            if not len(miss):
                break
            slot[miss] = (slot[miss] + np.uint64(1)) & np.uint64((1 << 20) - 1)
            found = self.table_hash[slot[miss]] == h[miss]
            out[miss[found]] = slot[miss[found]].astype(np.int64)
        return out

    def _fill_table(self) -> None:
        self.table_hash = np.zeros(1 << 20, np.uint64)
        self.table_score, self.table_id = np.zeros(1 << 20, np.int64), np.zeros(1 << 20, np.int32)
        self.powers, self.probes = [np.uint64(1)], 0
        for _ in range(self.longest):
            self.powers.append(np.uint64(int(self.powers[-1]) * int(_BASE) & _MASK))
        for piece, (i, score) in self.pieces.items():
            h = 0
            for ch in piece:
                h = (h * int(_BASE) + ord(ch) + 1) & _MASK
            h ^= h >> 31
            slot, steps = (h * int(_SPREAD) & _MASK) >> 44, 0
            while self.table_hash[slot]:
                slot, steps = (slot + 1) & (1 << 20) - 1, steps + 1
            self.table_hash[slot], self.table_score[slot], self.table_id[slot] = h, score, i
            self.probes = max(self.probes, steps)

    def fill(self, parts: set[str]) -> dict[str, tuple[bytes, int, int, int | None]]:
        """Entries for parts that are not in the cache; short ones are kept there."""
        known = self.known
        plain = [p for p in parts if len(p) <= KEPT_PART and known.issuperset(p)]
        new: dict = {}
        for at in range(0, len(plain), 20_000):
            new.update(self.first(plain[at : at + 20_000]))
        for p in parts.difference(new):
            w = self.ways(p)
            new[p] = (w[0][1], w[0][2], w[0][0], w[0][0] - w[1][0] if len(w) > 1 else None)
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache.clear()
        self.cache.update((p, v) for p, v in new.items() if len(p) <= KEPT_PART)
        return new

    def encode_all(self, texts: list[str]) -> Iterator[list[tuple[float, int, bytes]]]:
        """For each text the N best (score, pieces, ids as little-endian unsigned 32-bit bytes); one empty one for no text."""
        cuts = [self.cut(self.sp.normalize(t)) if t else [] for t in texts]
        distinct = [set(c) for c in cuts]
        every = set().union(*distinct)
        old = {p: self.cache[p] for p in every if p in self.cache}
        entries = old | self.fill(every.difference(old))
        for parts, few in zip(cuts, distinct, strict=True):
            yield self._whole(parts, {p: entries[p] for p in few})

    def encode(self, text: str) -> list[tuple[float, int, bytes]]:
        return next(self.encode_all([text]))

    def _whole(self, parts: list[str], ways: dict) -> list[tuple[float, int, bytes]]:
        here = [ways[p] for p in parts]
        raws = [w[0] for w in here]
        score = sum([w[2] for w in here])
        # only the n - 1 least first losses can change among the n best
        few = self.n_best - 1
        cheap = heapq.nsmallest(few, [(w[3], p) for p, w in ways.items() if w[3] is not None])
        places: list[tuple[int, int]] = []
        for loss, p in cheap:
            at = -1
            for _ in range(few):
                try:
                    at = parts.index(p, at + 1)
                except ValueError:
                    break
                places.append((loss, at))
        sums: list[tuple[int, tuple]] = [(0, ())]
        for _, at in heapq.nsmallest(few, places):
            top, *others = self.ways(parts[at])
            more = [(top[0] - w[0], w[1]) for w in others]
            sums = heapq.nsmallest(self.n_best, [x for loss, chosen in sums for x in ((loss, chosen), *((loss + d, (*chosen, (at, raw))) for d, raw in more))], key=lambda x: x[0])
        out = []
        for loss, chosen in sums:
            now = raws if not chosen else raws[:]
            for at, raw in chosen:
                now[at] = raw
            ids = b"".join(now)
            total, n = score - loss, len(ids) // 4
            out.append(((total + n) // _PIECE / UNIT, n, ids))
        return out

    def decode(self, ids: bytes) -> str:
        """The text that ids stand for, without the space that encoding puts first."""
        text = b"".join(map(self.bytes_of.__getitem__, array("I", ids))).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def coder(path: str, n_best: int) -> Coder:
    return _CODERS.get((path, n_best)) or _CODERS.setdefault((path, n_best), Coder(path, n_best))


def encode_pieces(docs: DataFrame, path: str, n_best: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and best: array of (score, n_pieces, ids) of the n_best best segmentations, best first.

    Null and empty texts have one segmentation without pieces; a text with fewer ways has them all. Repeated rows stay
    repeated, null ids stay null, other columns are dropped. Nothing is shuffled. Ids are whole numbers in an array.
    """
    schema = added(docs.select(F.col(id_col).alias("doc_id")), "n_bytes long, best array<struct<score:double,n_pieces:long,ids:array<int>>>")
    kind = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32()))]))
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, n_best)
        for b in sliced(batches):
            for at in range(0, b.num_rows, 16):  # ids of long texts are larger than the texts
                part = b.slice(at, 16)
                best = [[{"score": s, "n_pieces": n, "ids": array("I", ids).tolist()} for s, n, ids in ways] for ways in c.encode_all(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(best, kind)], names=["doc_id", "n_bytes", "best"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), F.octet_length(text).cast("long").alias("_n")).mapInArrow(work, schema)


def decode_pieces(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of rows with an array of ids; null ids give a null text."""
    schema = rows.select(F.col(id_col).alias("doc_id")).schema.add("text", "string")
    small_batches(rows.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, 1)
        for b in sliced(batches):
            texts = [None if ids is None else c.decode(array("I", ids).tobytes()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col(id_col), F.col(ids_col).cast("array<int>")).mapInArrow(work, schema)


def piece_digest(docs: DataFrame, path: str, n_best: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest of the n_best segmentations of every whole text, the best of them decoded again.

    doc_id, n_bytes, n_pieces, score and ids_crc32 of the best (crc32 of its ids as little-endian unsigned 32-bit
    integers), same (the best decodes to the text, in which the model's space mark stands for a space), n_ways, and
    way_scores, way_pieces, way_crc32 of all of them, best first. Nulls and repeats as in encode_pieces.
    """
    schema = added(docs.select(F.col(id_col).alias("doc_id")), "n_bytes long, n_pieces long, score double, ids_crc32 long, same boolean, n_ways int, way_scores array<double>, way_pieces array<long>, way_crc32 array<long>")
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, n_best)
        for b in sliced(batches):
            cols: list[list] = [[] for _ in range(8)]
            texts = b.column(1).to_pylist()
            for t, ways in zip(texts, c.encode_all(texts), strict=True):
                crc = [zlib.crc32(ids) for _, _, ids in ways]
                plain = t.replace(SPACE, " ")
                row = (ways[0][1], ways[0][0], crc[0], c.decode(ways[0][2]) == plain, len(ways), [w[0] for w in ways], [w[1] for w in ways], crc)
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            kinds = (pa.int64(), pa.float64(), pa.int64(), pa.bool_(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *(pa.array(v, k) for v, k in zip(cols, kinds, strict=True))], names=schema.names)

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), F.octet_length(text).cast("long").alias("_n")).mapInArrow(work, schema)

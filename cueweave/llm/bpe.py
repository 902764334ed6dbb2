"""Byte-level BPE over whole texts: splitting at sure boundaries, heap merging for counts, library encoding for ids.

A text is cut before each lone white-space character that stands between two other characters. No token of the
byte-level pattern crosses such a cut, so the pieces can be counted or encoded apart and kept in a bounded cache.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPECIAL = re.compile(r"(<\|endoftext\|>)")
# fixed values: white space other than single spaces and newlines, which makes a text's cuts unsure
_RARE = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x00")
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CUT = re.compile(r"(?<=\S)(?=\s\S)")
_SHAPE = re.compile(r"([\x00\n]?)([^\W\d_]+)([^\w\s]*)")  # a head, letters, marks
CACHE_ENTRIES = 500_000


def is_sure(text: str) -> bool:
    """White space is single spaces and newlines inside the text, and nothing in it can be taken for a cut."""
    return not (text[0].isspace() or any(map(text.__contains__, _RARE)) or not text.isascii() and _WIDE.search(text))


def keys(text: str) -> list[str]:
    """Cut a text without special strings into cache keys; piece(key) gives what a key stands for.

    After \\x00 a key is literal, after a newline it is itself, and any other key had a space before it.
    """
    if not text:
        return []
    if not is_sure(text):
        return ["\x00" + p for p in _CUT.split(text) if p]
    cut = text.replace("\n", " \n").split(" ")
    cut[0] = "\x00" + cut[0]
    return cut


def piece(key: str) -> str:
    head = key[:1]
    return key[1:] if head == "\x00" else key if head == "\n" else " " + key


def all_keys(text: str) -> list[str]:
    """The keys of a text that may hold special strings, which stand apart."""
    if "<|endoftext|>" not in text:
        return keys(text)
    return [k for part in SPECIAL.split(text) for k in (["\x00" + part] if part == "<|endoftext|>" else keys(part))]


def byte_chars() -> dict[int, str]:
    """The character that stands for each byte: printable Latin-1 bytes show as themselves, others are numbered from U+0100."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=4)
def load(path: str) -> tuple[dict[tuple[str, str], int], dict[int, str]]:
    """Merge ranks of a tokenizer file and the character that stands for each byte in it."""
    with open(path, encoding="utf-8") as f:
        merges = json.load(f)["model"]["merges"]
    return {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(merges)}, byte_chars()


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after byte-pair merging: the heap gives the lowest-rank pair, a linked list keeps neighbours."""
    n = len(symbols)
    if n < 2:
        return n
    nxt = list(range(1, n + 1))
    prv = list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue  # one side has merged since
        symbols[i] = ab = a + b
        symbols[j] = ""
        merges += 1
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            if (r := ranks.get((ab, symbols[k]))) is not None:
                heapq.heappush(heap, (r, i, ab, symbols[k]))
        h = prv[i]
        if h >= 0 and (r := ranks.get((symbols[h], ab))) is not None:
            heapq.heappush(heap, (r, h, symbols[h], ab))
    return n - merges


class Counter:
    """Token counts of whole texts under one tokenizer file."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks, self.chars = load(path)
        self.find = regex.compile(pattern).findall
        self.cache: dict[str, int] = {}

    def _new(self, key: str) -> int:
        text, chars = piece(key), self.chars
        if text == "<|endoftext|>":
            return 1
        return sum(merged_count([chars[b] for b in word.encode("utf-8", "replace")], self.ranks) for word in self.find(text))

    def count(self, text: str) -> int:
        cut, cache, total = all_keys(text), self.cache, 0
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        for k in set(cut).difference(cache):
            cache[k] = self._new(k)
        total = sum(map(cache.__getitem__, cut))
        for k in [k for k in cut if len(k) > 64]:  # long rare pieces are not worth their place
            cache.pop(k, None)
        return total


class Encoder:
    """Ids of whole texts from the tokenizers library, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.heads = {"\x00": b"", "\n": array("I", self.tokenizer.encode("\n", add_special_tokens=False).ids).tobytes()}
        self.tails = {"": b""}
        self.shown = dict(enumerate(byte_chars()[b] for b in range(256)))
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.cache: dict[str, bytes] = {}

    def _fill(self, missing: set[str]) -> dict[str, bytes]:
        """Encode keys. Letters, with a space before them or not, are one pretoken, which goes to the library's model as it is;
        a newline before them and marks after them are others. Other keys that stand for a space and a word go in lines, whose
        ends are tokens of their own."""
        out: dict[str, bytes] = {}
        tokens, shown = self.tokenizer.model.tokenize, self.shown
        packed = lambda word: array("I", [t.id for t in tokens(word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(shown))]).tobytes()
        for k in missing:
            if k.isalpha():
                out[k] = packed(" " + k) if not k.isascii() else array("I", [t.id for t in tokens("Ġ" + k)]).tobytes()
            elif (m := _SHAPE.fullmatch(k)) is not None and m[2].isalpha():
                head, stem, tail = m.groups()
                if head:
                    lead = self.heads[head] + packed(stem)
                elif (lead := self.cache.get(stem)) is None:
                    lead = packed(" " + stem) if not stem.isascii() else array("I", [t.id for t in tokens("Ġ" + stem)]).tobytes()
                if tail not in self.tails:
                    if len(self.tails) > 10_000:
                        self.tails = {"": b""}
                    self.tails[tail] = packed(tail)
                out[k] = lead + self.tails[tail]
        ids = lambda text: np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        rest = missing.difference(out)
        words = [k for k in rest if k[:1] not in "\x00\n\r" and k[-1:].strip()]
        for i in range(0, len(words), 500):
            some = words[i : i + 500]
            got = ids("\n".join([" " + k for k in some]))
            raw, start = got.tobytes(), 0
            ends = [*(np.flatnonzero(got == self.line) * 4).tolist(), len(raw)]
            if len(ends) != len(some):
                raise ValueError("a line end is not a token of its own")
            for k, end in zip(some, ends, strict=True):
                out[k] = raw[start:end]
                start = end + 4
        for k in rest.difference(words):
            out[k] = ids(piece(k)).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """One byte string a text. Sure texts are cut, and their keys numbered, in Arrow; each distinct key of the batch is
        looked up once, and the ids of all texts are then gathered in numpy."""
        out = [b""] * len(texts)
        sure = [i for i, t in enumerate(texts) if t and "<|endoftext|>" not in t and is_sure(t)]
        if sure:
            lines = pc.replace_substring(pa.array(["\x00" + texts[i] for i in sure], pa.large_string()), pattern="\n", replacement=" \n")
            cut = pc.split_pattern(lines, pattern=" ")
            numbered = cut.flatten().dictionary_encode()
            found = self._look_up(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
            flat, sizes = np.frombuffer(b"".join(found), np.uint32), np.array([len(v) for v in found]) // 4
            which, bounds = numbered.indices.to_numpy(), cut.offsets.to_numpy()
            n = sizes[which]
            ends = np.cumsum(n)
            starts = (np.cumsum(sizes) - sizes)[which] - (ends - n)
            ids = flat[np.repeat(starts, n) + np.arange(ends[-1])].tobytes()
            edges = np.concatenate(([0], ends))[bounds] * 4
            for i, a, b in zip(sure, edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                out[i] = ids[a:b]
        for i in set(range(len(texts))).difference(sure):
            out[i] = b"".join(self._look_up(all_keys(texts[i])))
        return out

    def _look_up(self, wanted: list[str]) -> list[bytes]:
        found = list(map(self.cache.get, wanted))
        missing = {k for k, v in zip(wanted, found, strict=True) if v is None}
        if not missing:
            return found
        new = self._fill(missing)
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache.clear()
        self.cache.update((k, v) for k, v in new.items() if len(k) <= 64)  # long rare pieces are not worth their place
        return [new[k] if v is None else v for k, v in zip(wanted, found, strict=True)]

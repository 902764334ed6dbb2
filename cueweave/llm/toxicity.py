"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters with a word input, an embedding of the word itself, and a character input, the sum of embeddings of its
first three to seven and last three to five characters, so that forms never seen before are known by their stems. Two gated
recurrent layers, one in each direction, read a window of words; attention pools their states; a logistic unit scores the
window. All overlapping windows of a text are scored and the highest score counts.

The network and both tables of embeddings are trained by back-propagation through time on windows of a bounded sample of
labelled rows. Embeddings start at small random values, with how much more often the word or run is in texts of label 1 in
one component. Words drop out of the word input at random, so that characters have to tell what they can. Only documents
are labelled, so each document stands for some of its windows: at first for those with the most words of one label, counted
on the sample, and after each round of training for those that the network itself scores highest. A fifth of the sample is
not trained on; a logistic fit on it puts scores on one scale.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cueweave.llm.common import added, discard, materialize, sliced, small_batches

SAMPLE = 4000  # labelled rows that the model is fitted on, at most
SAMPLE_BYTES = 64 << 20  # and bytes of their texts, at most
WINDOW, STRIDE = 64, 48
WORD_DIM, CHAR_DIM, UNITS = 8, 8, 8
INPUTS = WORD_DIM + CHAR_DIM + 1
LEAST_SEEN = 2  # texts of the sample that a word or a run of characters must be in to have an embedding
CACHE_ENTRIES = 400_000

_words = re.compile(r"\w+").findall


def words(text: str) -> list[str]:
    return _words(text.lower())


def runs(word: str) -> list[str]:
    """The first 3 to 7 characters of a word and its last 3 to 5, if it is longer; ^ and $ stand for its ends."""
    n = len(word)
    return ["^" + word[:k] for k in range(3, 8) if n > k] + [word[-k:] + "$" for k in range(3, 6) if n > k]


def told(bags: Iterable[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """For each number in bags how much more often it is in texts of label 1, as cautious log-odds. Starting values, not inputs."""
    ones, all_ = np.zeros(size), np.zeros(size)
    for bag, y in zip(bags, labels, strict=True):
        all_[bag] += 1
        if y:
            ones[bag] += 1
    rest, n1, n0 = all_ - ones, max(1, int(labels.sum())), max(1, int((labels == 0).sum()))
    odds = np.log((ones + 0.5) / (n1 + 1)) - np.log((rest + 0.5) / (n0 + 1)) - np.sqrt(1 / (ones + 0.5) + 1 / (rest + 0.5))
    return np.where(ones >= LEAST_SEEN, np.maximum(odds, 0), 0)


def windows(lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of all overlapping windows; a text without words has none."""
    doc, start, size = [], [], []
    for d, n in enumerate(lengths):
        for s in range(0, max(n - (WINDOW - STRIDE), min(n, 1)), STRIDE):
            doc.append(d)
            start.append(s)
            size.append(min(WINDOW, n - s))
    return np.array(doc, np.int64), np.array(start, np.int64), np.array(size, np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def new_network(seed: int = 7) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    mat = lambda *shape: (g.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)
    net = {}
    for d in "fb":
        net |= {f"W{d}": mat(INPUTS, 3 * UNITS), f"U{d}": mat(UNITS, 3 * UNITS), f"c{d}": np.zeros(3 * UNITS, np.float32), f"k{d}": np.zeros(UNITS, np.float32)}
        net[f"c{d}"][:UNITS] = 1  # keep states at first
    return net | {"A": mat(2 * UNITS, UNITS), "a": np.zeros(UNITS, np.float32), "v": mat(UNITS), "w": mat(2 * UNITS), "o": np.zeros(1, np.float32)}


def forward(net: dict[str, np.ndarray], projected: dict[str, np.ndarray], live: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
    """Window scores before the logistic. projected: W x + c for each direction, steps x windows x gates.

    Windows are sorted by falling length; live[t] of them have a word at step t. Gates: keep, reset, new.
    """
    steps, n = projected["f"].shape[:2]
    h_all = np.zeros((steps, n, 2 * UNITS), np.float32)
    trace: dict = {"f": [], "b": []}
    for at, d in ((0, "f"), (UNITS, "b")):
        h = np.zeros((n, UNITS), np.float32)
        u, k = net[f"U{d}"], net[f"k{d}"]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            m = live[t]
            if not m:
                continue
            x, old = projected[d][t, :m], h[:m]
            hu = old @ u
            gates = _sigmoid(x[:, : 2 * UNITS] + hu[:, : 2 * UNITS])
            z, r = gates[:, :UNITS], gates[:, UNITS:]
            inner = hu[:, 2 * UNITS :] + k
            new = np.tanh(x[:, 2 * UNITS :] + r * inner)
            out = new + z * (old - new)
            if keep:
                trace[d].append((t, m, old.copy(), z, r, inner, new))
            h[:m] = out
            h_all[t, :m, at : at + UNITS] = out
    e = np.tanh(h_all @ net["A"] + net["a"])
    s = e @ net["v"]
    s[np.arange(n)[None, :] >= live[:, None]] = -np.inf
    p = np.exp(s - s.max(0))
    p /= p.sum(0)
    pooled = np.einsum("tn,tnk->nk", p, h_all)
    trace |= {"h": h_all, "e": e, "p": p, "pooled": pooled}
    return pooled @ net["w"] + net["o"][0], trace


def backward(net: dict[str, np.ndarray], x: np.ndarray, trace: dict, d_out: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of all weights and of the inputs from d_out = d loss / d score; x: steps x windows x inputs."""
    h_all, e, p = trace["h"], trace["e"], trace["p"]
    grad = {k: np.zeros_like(v) for k, v in net.items()}
    grad["w"], grad["o"][0] = trace["pooled"].T @ d_out, d_out.sum()
    d_pooled = d_out[:, None] * net["w"]
    dp = np.einsum("tnk,nk->tn", h_all, d_pooled)
    ds = p * (dp - (p * dp).sum(0))
    grad["v"] = np.einsum("tn,tnk->k", ds, e)
    de = ds[:, :, None] * net["v"] * (1 - e * e)
    grad["A"], grad["a"] = np.einsum("tni,tnk->ik", h_all, de), de.sum((0, 1))
    dh_all = p[:, :, None] * d_pooled + de @ net["A"].T
    dx = np.zeros_like(x)
    for at, d in ((0, "f"), (UNITS, "b")):
        carry = np.zeros((x.shape[1], UNITS), np.float32)
        u = net[f"U{d}"]
        for t, m, old, z, r, inner, new in reversed(trace[d]):
            dh = carry[:m] + dh_all[t, :m, at : at + UNITS]
            dz, dn = dh * (old - new) * z * (1 - z), dh * (1 - z) * (1 - new * new)
            dr = dn * inner * r * (1 - r)
            to_x = np.concatenate([dz, dr, dn], 1)
            to_h = np.concatenate([dz, dr, dn * r], 1)
            grad[f"W{d}"] += x[t, :m].T @ to_x
            dx[t, :m] += to_x @ net[f"W{d}"].T
            grad[f"c{d}"] += to_x.sum(0)
            grad[f"U{d}"] += old.T @ to_h
            grad[f"k{d}"] += (dn * r).sum(0)
            carry[:m] = dh * z + to_h @ u.T
    return grad, dx


def _stack(rows: np.ndarray, flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `rows` by step and window (0 past a window's end), and how many windows each step has; sizes must fall."""
    steps = np.arange(int(size.max()))
    place = np.minimum(first[None, :] + steps[:, None], len(flat) - 1)
    return rows[flat[place]], np.searchsorted(-size, -(steps + 1), side="right")


class Parts:
    """Which rows of the embeddings each word of a list has: its own (0: none) and those of its runs of characters."""

    def __init__(self, listed: list[str], word_at: dict[str, int], run_at: dict[str, int]):
        self.own = np.fromiter((word_at.get(w, 0) for w in listed), np.int64, len(listed))
        flat, ends = array("i"), array("q", [0])
        for w in listed:
            flat.extend([run_at[r] for r in runs(w) if r in run_at])
            ends.append(len(flat))
        self.ends, self.flat = np.array(ends, np.int64), np.array(flat, np.int32)
        self.size = np.fromiter((min(len(w), 16) / 16 for w in listed), np.float32, len(listed))

    def runs_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in words, run) of all runs of these words."""
        n = self.ends[words + 1] - self.ends[words]
        owner = np.repeat(np.arange(len(words)), n)
        return owner, self.flat[np.arange(int(n.sum())) + np.repeat(self.ends[words] - (np.cumsum(n) - n), n)]

    def inputs(self, words: np.ndarray, by_word: np.ndarray, by_run: np.ndarray) -> np.ndarray:
        out = np.zeros((len(words), INPUTS), np.float32)
        out[:, :WORD_DIM] = by_word[self.own[words]]
        owner, run = self.runs_of(words)
        np.add.at(out[:, WORD_DIM : WORD_DIM + CHAR_DIM], owner, by_run[run])
        out[:, -1] = self.size[words]
        return out

    def projected(self, net: dict[str, np.ndarray], by_word: np.ndarray, by_run: np.ndarray) -> np.ndarray:
        """W x + c of all words for both directions, a few words at a time."""
        out = np.empty((len(self.own), 6 * UNITS), np.float32)
        for at in range(0, len(out), 16_384):
            x = self.inputs(np.arange(at, min(len(out), at + 16_384)), by_word, by_run)
            for k, d in enumerate("fb"):
                out[at : at + len(x), 3 * UNITS * k : 3 * UNITS * (k + 1)] = x @ net[f"W{d}"] + net[f"c{d}"]
        return out


@dataclass
class Model:
    """A fitted scorer. Small: its tables are bounded by the sample."""

    net: dict[str, np.ndarray]
    word_at: dict[str, int]
    run_at: dict[str, int]
    by_word: np.ndarray
    by_run: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    cache: dict[str, int] = field(default_factory=dict)
    rows: np.ndarray = field(default_factory=lambda: np.zeros((1024, 6 * UNITS), np.float32))

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("net", "word_at", "run_at", "by_word", "by_run", "scale")}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def inputs(self, listed: list[str]) -> np.ndarray:
        """Word and character inputs of words."""
        return Parts(listed, self.word_at, self.run_at).inputs(np.arange(len(listed)), self.by_word, self.by_run)

    def raw(self, texts: list[str]) -> np.ndarray:
        """Highest window score before scaling; -inf for a text without words."""
        cut = [words(t) for t in texts]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        cache = self.cache
        new = list(set().union(*cut).difference(cache))
        if new:
            n = len(cache)
            while len(self.rows) < n + len(new):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            x = self.inputs(new)
            self.rows[n : n + len(new)] = np.concatenate([x @ self.net[f"W{d}"] + self.net[f"c{d}"] for d in "fb"], 1)
            cache.update(zip(new, range(n, n + len(new)), strict=True))
        lengths = [len(c) for c in cut]
        flat = np.fromiter((cache[w] for c in cut for w in c), np.int64, sum(lengths))
        return _highest(self.net, self.rows, flat, lengths)[0]

    def score(self, texts: list[str]) -> np.ndarray:
        """Scores from 0 to 1, rounded to six places; a text without words has 0."""
        raw = self.raw(texts)
        return np.where(np.isfinite(raw), np.round(_sigmoid(self.scale[0] * np.where(np.isfinite(raw), raw, 0.0) + self.scale[1]), 6), 0.0)


def _highest(net: dict[str, np.ndarray], rows: np.ndarray, flat: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Highest window score of each text (-inf without words), and the score of every window. rows: projected inputs."""
    out = np.full(len(lengths), -np.inf)
    doc, start, size = windows(lengths)
    scores = np.zeros(len(doc))
    if len(doc):
        first = start + np.concatenate(([0], np.cumsum(lengths)[:-1]))[doc]
        order = np.argsort(-size, kind="stable")
        for at in range(0, len(order), 1024):
            o = order[at : at + 1024]
            x, live = _stack(rows, flat, first[o], size[o])
            scores[o] = forward(net, {"f": x[..., : 3 * UNITS], "b": x[..., 3 * UNITS :]}, live)[0]
        np.maximum.at(out, doc, scores)
    return out, scores


def _distinct(docs: list[np.ndarray], hashes: np.ndarray) -> list[int]:
    """Places of texts that are not near copies of earlier ones. Copies tell nothing new of words and would count as so many
    witnesses; which texts the model scores is not touched by it."""
    seen: set[tuple[int, int]] = set()
    keep = []
    mults = np.array((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F), np.uint64)
    for i, d in enumerate(docs):
        k = min(5, len(d))
        if not k:
            continue
        grams = np.zeros(len(d) - k + 1, np.uint64)
        for j in range(k):
            grams = grams * np.uint64(0x100000001B3) + hashes[d[j : len(d) - k + 1 + j]]
        mins = [(m, int(x)) for m, x in enumerate(((grams[:, None] ^ (grams[:, None] >> np.uint64(29))) * mults[None, :] & np.uint64(0xFFFFFFFF)).min(0))]
        if sum(m in seen for m in mins) < 2:
            keep.append(i)
        seen.update(mins)
    return keep


class Adam:
    """Steps for dense weights."""

    def __init__(self, net: dict[str, np.ndarray]):
        self.m, self.v, self.t = {k: np.zeros_like(w) for k, w in net.items()}, {k: np.zeros_like(w) for k, w in net.items()}, 0

    def step(self, net: dict[str, np.ndarray], grad: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for k, g in grad.items():
            g = g + 1e-5 * net[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            net[k] = net[k] - (rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


class Sparse:
    """Steps for the rows of a table that a batch touched (Adagrad), with a pull to zero; row 0 stays as it is."""

    def __init__(self, table: np.ndarray):
        self.table, self.sum = table, np.zeros(len(table), np.float32)

    def step(self, rows: np.ndarray, grad: np.ndarray, rate: float, decay: float) -> None:
        used, place = np.unique(rows, return_inverse=True)
        g = np.zeros((len(used), self.table.shape[1]), np.float32)
        np.add.at(g, place, grad)
        g += decay * self.table[used]
        self.sum[used] += (g * g).mean(1)
        self.table[used] -= rate * g / (np.sqrt(self.sum[used])[:, None] + 1e-8)
        self.table[0] = 0


def fit(texts: list[str], labels: list[int], epochs: int = 9, steps: int = 300, batch: int = 64, rate: float = 0.01) -> Model:
    """Train on labelled texts; without a text of label 1, every text scores near 0."""
    import xxhash

    ids: dict[str, int] = {}
    docs = [np.fromiter((ids.setdefault(w, len(ids)) for w in words(t)), np.int32) for t in texts]
    vocabulary = list(ids)
    keep = _distinct(docs, np.fromiter((xxhash.xxh64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary)))
    cut, y = [docs[i] for i in keep], np.array([labels[i] for i in keep], np.int64)
    del docs, ids
    net = new_network()
    if not y.any():
        return Model(net, {}, {}, np.zeros((1, WORD_DIM), np.float32), np.zeros((1, CHAR_DIM), np.float32), (0.0, -8.0))
    g = np.random.default_rng(11)
    # a fifth of each label is not trained on
    aside = np.zeros(len(y), bool)
    for label in (0, 1):
        at = g.permutation(np.flatnonzero(y == label))
        aside[at[: len(at) // 5]] = True
    bags = [np.unique(c) for c in cut]
    learned = [b for b, a in zip(bags, aside, strict=True) if not a]
    seen = np.bincount(np.concatenate(learned), minlength=len(vocabulary))
    word_at = {vocabulary[i]: k for k, i in enumerate(np.flatnonzero(seen >= LEAST_SEEN).tolist(), 1)}
    # counted first by a hash in a table of fixed size, so that the many runs that are seen once are never kept as strings
    known = [(w, n) for w, n in zip(vocabulary, seen.tolist(), strict=True) if n]
    rough = np.zeros(1 << 22, np.int64)
    for at in range(0, len(known), 10_000):
        slots = [(zlib.crc32(r.encode()) & 0x3FFFFF, n) for w, n in known[at : at + 10_000] for r in runs(w)]
        np.add.at(rough, [s for s, _ in slots], [n for _, n in slots])
    of_runs: Counter = Counter()
    for w, n in known:
        of_runs.update({r: n for r in runs(w) if rough[zlib.crc32(r.encode()) & 0x3FFFFF] >= LEAST_SEEN})
    del known, rough
    run_at = {r: k for k, r in enumerate((r for r, n in of_runs.items() if n >= LEAST_SEEN), 1)}
    del of_runs
    by_word, by_run = np.zeros((len(word_at) + 1, WORD_DIM), np.float32), np.zeros((len(run_at) + 1, CHAR_DIM), np.float32)
    for table in (by_word, by_run):
        table[1:] = 0.05 * g.standard_normal(table[1:].shape)
    parts = Parts(vocabulary, word_at, run_at)

    lengths = [len(c) for c in cut]
    flat = np.concatenate(cut).astype(np.int64)
    doc, start, size = windows(lengths)
    first = start + np.concatenate(([0], np.cumsum(lengths)[:-1]))[doc]
    of_doc = np.split(np.arange(len(doc)), np.searchsorted(doc, np.arange(1, len(cut))))
    clues = told(learned, y[~aside], len(vocabulary))
    by_word[parts.own, 0] += np.where(parts.own > 0, clues / 3, 0)
    by_run[:, 0] += told((np.unique(parts.runs_of(b)[1]) for b in learned), y[~aside], len(by_run)) / 6
    sums = np.concatenate(([0.0], np.cumsum(clues[flat])))
    del bags, learned, vocabulary, seen
    high = sums[first + size] - sums[first]
    adam, words_, runs_ = Adam(net), Sparse(by_word), Sparse(by_run)
    epochs = max(epochs, -(-steps * batch // max(1, int((~aside).sum()) * 2)))
    for epoch in range(epochs):
        if epoch and epoch % (epochs // 4) == 0:
            high = _highest(net, parts.projected(net, by_word, by_run), flat, lengths)[1]
        pick = []  # the highest window of a text, and of clean ones two more
        for d, at in enumerate(of_doc):
            if not aside[d]:
                best = at[np.argsort(-high[at], kind="stable")]
                pick += best[:1].tolist() if y[d] else best[:2].tolist() + g.choice(best[2:], min(1, len(best[2:])), replace=False).tolist()
        pick = np.array(pick)
        target = y[doc[pick]].astype(np.float32)
        weight = np.where(target > 0, min(6.0, max(1.0, (1 - target.mean()) / max(target.mean(), 1e-6) / 2)), 1.0).astype(np.float32)
        order, pace = g.permutation(len(pick)), rate * 0.5 ** (3 * epoch // epochs)
        for at in range(0, len(order), batch):
            o = order[at : at + batch]
            o = o[np.argsort(-size[pick[o]], kind="stable")]
            place, live = _stack(flat, np.arange(len(flat)), first[pick[o]], size[pick[o]])
            used, where = np.unique(place, return_inverse=True)
            own = parts.inputs(used, by_word, by_run)
            heard = g.random(len(used)) < 0.5
            own[~heard, :WORD_DIM] = 0
            x = own[where.reshape(place.shape)]
            out, trace = forward(net, {d: x @ net[f"W{d}"] + net[f"c{d}"] for d in "fb"}, live, keep=True)
            grad, dx = backward(net, x, trace, ((_sigmoid(out) - target[o]) * weight[o] / len(o)).astype(np.float32))
            norm = math.sqrt(sum(float((v * v).sum()) for v in grad.values()))
            adam.step(net, {k: v * min(1.0, 1.0 / (norm + 1e-9)) for k, v in grad.items()}, pace)
            d_own = np.zeros_like(own)
            np.add.at(d_own, where.ravel(), dx.reshape(-1, INPUTS))
            words_.step(parts.own[used[heard]], d_own[heard, :WORD_DIM], 5 * pace, 1e-5)
            owner, run = parts.runs_of(used)
            runs_.step(run, d_own[owner, WORD_DIM : WORD_DIM + CHAR_DIM], 5 * pace, 1e-5)
    model = Model(net, word_at, run_at, by_word, by_run)
    raw = _highest(net, parts.projected(net, by_word, by_run), flat, lengths)[0]
    fitted = aside if aside.any() and y[aside].any() else ~aside
    model.scale = _scale(raw[fitted], y[fitted].astype(np.float64))
    return model


def _scale(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of the logistic of a * raw + b, by Newton steps with a small prior for a = 1, b = 0."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(np.clip(a * raw + b, -30, 30))
        w = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((p - y) * raw).sum() + (a - 1), (p - y).sum() + 0.1 * b])
        hess = np.array([[(w * raw * raw).sum() + 1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 0.1]])
        d = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = max(a - d[0], 0.05), b - d[1]
        if np.abs(d).max() < 1e-6:
            break
    return float(a), float(b)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from. A null id counts as an empty text, which is not held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most `sample` labelled rows of at most `sample_bytes` together, taken in the order of a hash of their id;
    held-out rows are left aside.

    Rows with a null id, text or label are left out, and so are texts of more than a sixteenth of `sample_bytes`, one of which
    could else stand for all; of labels that disagree the higher counts, of texts the least. Texts are used whole.
    """
    rows = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_id is not null and _y in (0, 1)").filter(~held_out("_id"))
    few = rows.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_text")).filter("_text is not null")
    got = texts.join(F.broadcast(few), F.col("_d") == F.col("_id")).groupBy("_id").agg(F.min(F.struct("_text", "_y")).alias("r"))  # at most `sample` rows
    stored = materialize(got.select("_id", "r._text", "r._y"), "toxic-sample")
    sizes = stored.select("_id", F.octet_length("_text").cast("long").alias("_b")).filter(F.col("_b") <= sample_bytes // 16)
    sizes = sizes.withColumn("_all", F.sum("_b").over(Window.orderBy(F.xxhash64("_id"), "_id")))  # numbers of `sample` rows, no texts
    table = stored.join(F.broadcast(sizes.filter(F.col("_all") <= sample_bytes).select("_id")), "_id").toArrow().sort_by("_id")
    discard(stored)
    return fit(table.column("_text").to_pylist(), table.column("_y").to_pylist())


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs with score (0 to 1, higher: toxic likelier) and predicted (1 if score >= threshold, else 0).

    Null, empty and wordless texts score 0. Columns of those names are replaced. Repeated rows stay repeated. The model,
    bounded by its sample, is broadcast. Nothing is shuffled.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)
    schema = added(docs, "score double, predicted int")
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in sliced(batches, 512):
            s = m.score([t or "" for t in b.column(at).to_pylist()]) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    return docs.mapInArrow(work, schema)

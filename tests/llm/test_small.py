"""Helpers of the training-data operators against brute force, without Spark."""

import itertools
import os
import random
from array import array

import numpy as np
import public_tokenizers
import pytest

from cueweave.llm import bit_codes, bpe, main_text, matroska, ngram_join, pieces, token_store, toxicity

ALPHABET = ["a", "the", " ", "\n", "\r", "\t", "  ", ",", ".", "don't", "'s", "12", "é", "日本", "<|endoftext|>", " ", "　", "\x00", "\x85", "²", "x_y", "🙂", " foo", " bar"]


def texts(n, seed, most=12):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_counts_and_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t, e, c = Tokenizer.from_file(path), bpe.Encoder(path), bpe.Counter(path, public_tokenizers.PATTERN)
    some = texts(3000, 1)
    for s, got in zip(some, e.encode(some), strict=True):
        want = t.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(got, np.uint32).tolist() == want
        assert c.count(s) == len(want)


def test_seekable_file():
    import zstandard

    w, docs = token_store.FileWriter(), [(None, b""), (3, b"\x01\0\0\0"), (3, b"\x02\0\0\0" * 9), (7, os.urandom(4000))]
    for i, d in docs:
        w.add(i, zstandard.ZstdCompressor().compress(d), len(d), token_store.checksum(d))
    data = w.body() + token_store.FOOT
    r = token_store.FileReader(data)
    assert [(i, b) for i, _, b in r.documents()] == docs
    assert [(i, n) for i, n, _ in r.documents([7])] == [(7, 10)]
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(d for _, d in docs)
    at = r.entries[3][0] + 30
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_store.FileReader(data[:at] + bytes([data[at] ^ 255]) + data[at + 1 :]).read(3)


def test_bit_codes_find_what_brute_force_finds():
    g = np.random.default_rng(0)
    for dim in (3, 64):
        x = g.standard_normal((600, dim))
        x[50:80] = x[10]
        ids = np.arange(600)
        codes, s, norms = bit_codes.encode(x, 4)
        for i, place, score in bit_codes.nearest(x[:40], ids[:40], x, ids, codes, s, norms, 20, 3.0):
            want = (x * x[i]).sum(1)
            want[i] = -np.inf
            order = np.lexsort((ids, -want))[:20]
            assert place.tolist() == order.tolist() and np.array_equal(score, want[order])


def test_minimum_cut_against_all_labellings():
    r = random.Random(2)
    for _ in range(300):
        n = r.randint(1, 8)
        odds = [r.randint(-9, 9) for _ in range(n)]
        links = [(i, j, r.randint(0, 8)) for i in range(n) for j in range(i + 1, n) if r.random() < 0.5]
        cost = lambda x: sum(abs(v) for v, k in zip(odds, x, strict=True) if (v > 0) != bool(k)) + sum(c for i, j, c in links if x[i] != x[j])  # noqa: B023, E731
        best = min(map(cost, itertools.product((0, 1), repeat=n)))
        assert cost(main_text.minimum_cut(odds, links)) == best
        near = [[(b if a == i else a, c) for a, b, c in links if i in (a, b) and c] for i in range(n)]
        assert cost(main_text._max_flow(odds, near)) == best


PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><div id="cookie-notice">We use cookies. Accept them all please now.</div>
<header class="site-header"><a href=/>Home</a> <h2>Site name</h2></header><div id=menu><ul><li><a href=x>One</a><li><a>Two</a></ul></div>
<div class="content"><div class="post"><h1>Title here</h1><p class=byline>By someone</p><p>First long paragraph with a fair number of words, so
that it looks like content to anybody.<p>Short one.<div class="ad-slot">Buy this thing now, it is great and long enough to look like content.</div>
<ul><li>point one</li><li>point two is longer.</li></ul><blockquote>Quoted text &amp; more&nbsp;text</blockquote><form><label>Mail</label><input><button>Send</button></form></div>
<section id="comments"><h3>Comments</h3><p>I think this is a very good article and I liked reading all of it, thanks.</p></section></div>
<aside>Related things to read</aside><div class="sidebar">Some sidebar text here with words.</div><footer>&copy; 2024</footer><script>var a="<p>x</p>"</script></body></html>"""


def test_page():
    want = ["Title here", "By someone", "First long paragraph with a fair number of words, so that it looks like content to anybody.", "Short one.", "point one", "point two is longer.", "Quoted text & more text"]
    assert main_text.main_text(PAGE).split("\n") == want
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<nav>x</nav>") == ""
    deep = "<div>" * 5000 + "<p>A paragraph of several words, deep down in the tree of this page.</p>"
    assert main_text.main_text(deep).startswith("A paragraph")
    for broken in ("<p", "<p class='x", "a < b and c > d, as everybody knows by now, I think.", "<!-- open", "<script>never closed"):
        main_text.main_text(broken)


def test_page_depth_and_cut():
    words = "Some words that could be an article, as there are many of them and they end like a sentence."
    for depth in (3, 300, 1000, 20_000):
        side = "<div class=sidebar>" + "<div>" * depth + f"<p>{words}</p>" + "</div>" * depth + "</div>"
        assert main_text.main_text(f"<body>{side}<article><h1>Title</h1><p>{words}</p></article>{side}</body>") == f"Title\n{words}"
        assert main_text.main_text("<div>" * depth + f"<p>{words}</p>" + "</p></nav></div>" * 3 * depth + f"<p>{words}</p>") == f"{words}\n{words}"
    page = f"<article><p>{words}</p><div>Short</div><section id=comments><p>{words}</p><p>{words}</p></section></article><nav><p>{words}</p></nav>"
    found, elements = main_text.blocks(page)
    keep = main_text.minimum_cut(*main_text.graph(found, elements))
    assert [sum(w * x for w, x in zip(main_text.PRIOR, b.features, strict=True)) > 0 for b in found] == [True, False, True, True, True]  # each block by itself
    assert keep[: len(found)] == [True, True, False, False, False]  # what the cut makes of them
    long = "<article>" + f"<p>{words}</p>" * 5000 + "</article><ul>" + "<li><a href=x>link</a>" * 5000 + "</ul>"
    assert main_text.main_text(long) == "\n".join([words] * 5000)


def test_matroska():
    for n in (64, 1024, 1088, 8192, 8256, 24576, 24640, 60_032):
        payload = os.urandom(n)
        data = matroska.mux(payload)
        m = matroska.demux(data)
        assert matroska.samples(data, m) == payload and len(m.cues) == m.clusters
        assert [p[1] for p in m.packets] == [i * 1024 * 125_000 for i in range(len(m.packets))]
        for ns in (0, 700_000_000, 4_000_000_000):
            assert matroska.seek(data, m, ns) == max((p for p in m.packets if p[1] <= ns), key=lambda p: p[1])
    for how, frames in ((matroska.NO_LACING, [b"abc"]), (matroska.XIPH, [b"a" * 300, b"", b"b" * 255, b"c"]), (matroska.FIXED, [b"ab", b"cd"]), (matroska.EBML_LACING, [b"a" * 200, b"b", b"c" * 9000, b"d"])):
        body = matroska.element(matroska.TIME, b"\0") + matroska.element(matroska.GROUP, matroska.element(matroska.BLOCK, matroska.block(1, 5, frames, how, 0)))
        live = matroska._HEADER + matroska.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + matroska.CLUSTER.to_bytes(4, "big") + b"\xff" + body + matroska._TRACK
        m = matroska.demux(live)  # sizes unknown, tracks last
        assert [live[a : a + k] for _, _, a, k, _ in m.packets] == frames and m.lacings[how] == 1
    for bad in (b"", b"\0", data[:50], data[:-5], os.urandom(40)):
        with pytest.raises(ValueError):
            matroska.demux(bad)


def test_n_best_against_all_segmentations():
    c = pieces.Coder(public_tokenizers.path("piece_bpe_32k.model"), 4)

    def every(norm):
        into = c.edges(norm)

        def ways(j):
            return [(s + v, before + ids) for i, v, ids in into[j] for s, before in ways(i)] if j else [(0, ())]

        return sorted(ways(len(norm)), key=lambda w: -w[0])

    r = random.Random(1)
    for t in ["a b", "  two  sp", "x\ny\n\nz", "aa aa aa", "日本 ①é", "▁q r", "　"] + ["".join(r.choice("ab c\nthe") for _ in range(r.randint(1, 9))) for _ in range(150)]:
        got, want = c.encode(t), every(c.sp.normalize(t))
        assert [(s, n) for s, n, _ in got] == [((s + len(i)) // pieces._PIECE / pieces.UNIT, len(i)) for s, i in want[:4]]
        assert len({i for _, _, i in got}) == len(got) and {i for _, _, i in got} <= {array("I", i).tobytes() for _, i in want}
        assert all(c.decode(i) == t.replace("▁", " ") == c.sp.decode(list(array("I", i))) for _, _, i in got)
    assert c.encode("") == [(0.0, 0, b"")]


def test_forward_pass_equals_search():
    c = pieces.Coder(public_tokenizers.path("piece_bpe_32k.model"), 4)
    r = random.Random(4)
    parts = list({"▁" + "".join(r.choice("abcdefghijklmnopqrstuvwxyzäé.,") for _ in range(r.randint(1, 30))) for _ in range(400)})
    for p, (raw, n, score, loss) in c.first(parts):
        ways = c.ways(p)
        assert (raw, n, score, loss) == (ways[0][1], ways[0][2], ways[0][0], ways[0][0] - ways[1][0] if len(ways) > 1 else None)


def test_gradients():
    net = {k: v.astype(np.float64) for k, v in toxicity.new_network().items()}
    g = np.random.default_rng(0)
    x, live, out = g.standard_normal((5, 3, toxicity.INPUTS)), np.array([3, 3, 2, 1, 1]), np.array([1, -2, 0.5])
    loss = lambda: float((toxicity.forward(net, {d: x @ net[f"W{d}"] + net[f"c{d}"] for d in "fb"}, live)[0] * out).sum())
    grad, dx = toxicity.backward(net, x, toxicity.forward(net, {d: x @ net[f"W{d}"] + net[f"c{d}"] for d in "fb"}, live, keep=True)[1], out)
    for table, slope in [(net[k], grad[k]) for k in net] + [(x, dx)] * 9:
        i = tuple(g.integers(0, n) for n in table.shape)
        was = table[i]
        table[i] = was + 1e-3
        up = loss()
        table[i] = was - 1e-3
        down = loss()
        table[i] = was
        assert abs((up - down) / 2e-3 - slope[i]) < 1e-3


def test_scores_equal_a_plain_loop():
    """The batched forward pass against one window, one word and one unit at a time."""
    m = toxicity.fit(["you idiot", "a fine day it is", "such an idiot he is", "what a fine day it is", "some other words stand here"] * 4, [1, 0, 1, 0, 0] * 4, epochs=2, steps=4)
    sig = lambda v: 1 / (1 + np.exp(-v))

    def word_input(w):
        own = m.by_word[m.word_at.get(w, 0)]
        chars = sum((m.by_run[m.run_at[r]] for r in toxicity.runs(w) if r in m.run_at), np.zeros(toxicity.CHAR_DIM))
        return np.concatenate([own, chars, [min(len(w), 16) / 16]])

    def window_score(ws):
        k, states = toxicity.UNITS, []
        for d in "fb":
            h, out = np.zeros(k), []
            for w in ws if d == "f" else ws[::-1]:
                x, hu = word_input(w) @ m.net["W" + d] + m.net["c" + d], h @ m.net["U" + d]
                z, r = sig(x[:k] + hu[:k]), sig(x[k : 2 * k] + hu[k : 2 * k])
                new = np.tanh(x[2 * k :] + r * (hu[2 * k :] + m.net["k" + d]))
                h = z * h + (1 - z) * new
                out.append(h)
            states.append(out if d == "f" else out[::-1])
        both = [np.concatenate(s) for s in zip(*states, strict=True)]
        e = np.array([np.tanh(s @ m.net["A"] + m.net["a"]) @ m.net["v"] for s in both])
        p = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
        return sum(p[i] * both[i] for i in range(len(both))) @ m.net["w"] + m.net["o"][0]

    r = random.Random(5)
    some = [" ".join(r.choice(["you", "idiot", "fine", "day", "idiots", "other", "zzz"]) for _ in range(n)) for n in (1, 5, 64, 65, 130, 300)]
    for t, got in zip(some, m.raw(some), strict=True):
        ws = t.split()
        starts = [s for s in range(0, len(ws), toxicity.STRIDE) if s == 0 or s + toxicity.WINDOW - toxicity.STRIDE < len(ws)]
        assert abs(got - max(window_score(ws[s : s + toxicity.WINDOW]) for s in starts)) < 1e-4


def test_windows_cover_all_words():
    for n in (0, 1, 63, 64, 65, 112, 113, 500):
        _, start, size = toxicity.windows([n])
        assert set().union(*(range(s, s + k) for s, k in zip(start.tolist(), size.tolist(), strict=True)), set()) == set(range(n))


def test_whole_words_beat_their_parts():
    c = pieces.Coder(public_tokenizers.path("piece_bpe_32k.model"), 4)
    text = "the quick brown fox jumps over the lazy dog and they were not happy about that"
    assert list(array("I", c.encode(text)[0][2])) == c.sp.encode(text)
    assert pieces.log_probabilities([-1.5, -2.0]) == [-1.5, -2.0]


def test_bands_serve_the_threshold():
    assert [ngram_join.band_rows(t) for t in (0.9, 0.8, 0.7, 0.5)] == [4, 4, 3, 2]
    with pytest.raises(ValueError):
        ngram_join.band_rows(0.3)


def test_least_matches_rise():
    least = ngram_join.least_matches(0.8, 1e-6)
    assert len(least) == ngram_join.HASHES + 1 and list(least) == sorted(least)



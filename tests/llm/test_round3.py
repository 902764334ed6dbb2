"""Removal of repeats, vector codes and importance resampling against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cueweave.llm import importance, queries, repeats, vector_codes
from test_queries import SF, none, odd, rows


def repeats_brute(docs, size):
    seen, out = set(), {}
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            w = b[p : p + size]
            if w in seen:
                gone[p : p + size] = b"\1" * size
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


def digests(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_op11_whole_table(spark):
    docs = rows(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id")
    want = repeats_brute(docs, 100)
    assert digests(queries.op11_repeats(spark, SF)) == want
    assert sum(w[1] for w in want.values()) > 50_000


@pytest.mark.parametrize("size", [100, 37, 16])
def test_op11_edited_copies_periods_and_passages(spark, size):
    r = random.Random(size)
    words = ["ab", "cd", "efg", "x", "é", "日本"]
    say = lambda n: "".join(r.choice(words) for _ in range(n))
    base, data = say(400), []
    for i in range(60):
        a, edited = r.randrange(300), list(base)
        for _ in range(r.randint(0, 6)):
            edited[r.randrange(len(edited))] = r.choice("qrst")
        passage = say(30) + base[a : a + r.randint(20, 300)] + say(30)
        data.append((i, ["x" * r.randint(0, 400), "ab" * r.randint(0, 200) + "x" * 150, "".join(edited), passage, "".join(r.choice("ab") for _ in range(300)) + "\n" * r.randint(0, 300), r.choice(data)[1] if data else None][i % 6]))
    assert digests(repeats.digest(repeats.remove_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(5), size))) == repeats_brute(data, size)


def test_op11_anchors_belong_to_their_windows():
    r = np.random.default_rng(3)
    for data in (r.integers(0, 3, 900), np.zeros(700, int), np.tile([1, 2, 3], 200), r.integers(0, 255, 100)):
        first, n, at, times, *_ = repeats.runs(data.astype(np.uint8), 100)
        gram, span, top = repeats.shape(100)
        h, *_ = repeats.names(data.astype(np.uint8), gram, top)
        covered = [p for a, k, t in zip(first, n, times, strict=True) for p in range(a, a + k + t - 1)]
        assert covered == list(range(len(data) - 99))
        for a, k, s in zip(first, n, at, strict=True):
            assert all(p + int(h[p : p + span].argmin()) == s for p in range(a, a + k))


def test_op11_anchors_seldom_come_again_by_chance():
    text = np.frombuffer(bytes(random.Random(5).choices(b"ab", k=400_000)), np.uint8)
    found = repeats.runs(text, 100)[4]
    assert len(found) > 5_000 and len(np.unique(found)) > 0.99 * len(found)


def test_op11_joined_texts_keep_their_own_windows():
    r = random.Random(6)
    texts = ["".join(r.choices(["ab", "c", "é"], k=n)) for n in (60, 200, 5, 0, 90, 70_000, 100)] + ["x" * 100, "x" * 300, "xy" * 50]
    one = [[np.append(x, 0) for x in repeats.runs(np.frombuffer(t.encode(), np.uint8), 100)] if 100 <= len(t.encode()) <= repeats.PIECE else None for t in texts]
    windows = set()
    for data, ends, of, before in repeats._pieces(pa.array(texts), 100):
        first, n, at, times, *named = repeats.runs(data, 100, ends)
        k = np.searchsorted(ends, first, "right")
        shift = before[k] - np.concatenate(([0], ends[:-1]))[k]
        windows |= {(int(of[d]), p) for d, a, m, t in zip(k, first + shift, n, times, strict=True) for p in range(a, a + m + t - 1)}
        for d in set(k.tolist()):
            if one[of[d]]:
                for x, y in zip([first + shift, n, at + shift, times, *named], one[of[d]], strict=True):
                    assert x[k == d].tolist() == y[:-1].tolist()
    assert windows == {(i, p) for i, t in enumerate(texts) for p in range(len(t.encode()) - 99)}


def test_op11_text_of_many_pieces(spark):
    r = random.Random(7)
    long = "".join(r.choices("abcd", k=160_000))
    data = [(0, long[1_000:1_150]), (1, long), (2, long[70_000:] + long[: repeats.PIECE + 50]), (3, "x" * 140_000)]
    assert digests(repeats.digest(repeats.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")))) == repeats_brute(data, 100)


def test_op11_odd(spark):
    got = repeats.remove_repeats(odd(spark)).collect()
    assert len(got) == 12 and set(odd(spark).columns) <= set(got[0].asDict())
    by = {(r["doc_id"], r["text"] and r["text"][:5]): r for r in got}
    assert by[1, None]["kept"] == b"" and by[1, None]["n_bytes"] == 0 and not by[1, None]["spans"]
    assert not by[5, "word0"]["kept"].endswith(by[5, "word0"]["text"].encode()[-200:])  # its words come again and again
    assert by[6, "word0"]["kept"] == b"" and [tuple(s) for s in by[6, "word0"]["spans"]] == [(0, by[6, "word0"]["n_bytes"])]
    assert len(by[7, "xxxxx"]["kept"]) == 1 and by[8, "\n" * 5]["kept"] == b"\n" * 50
    assert repeats.remove_repeats(none(spark)).count() == 0
    same = spark.createDataFrame([(None, "0123456789" * 11)] * 3, "doc_id long, text string")
    assert {len(r["kept"]) for r in repeats.remove_repeats(same).collect()} == {10}
    with pytest.raises(ValueError):
        repeats.remove_repeats(same, 8)


def codes_brute(data, parts=4, entries=256, rounds=4):
    x = np.array([v for _, v in data], np.int64)
    books = [b.copy() for b in np.split(x[:entries], parts, 1)]
    pieces = np.split(x, parts, 1)

    def assign():
        d = [((p[:, None] - b[None]) ** 2).sum(2) for p, b in zip(pieces, books, strict=True)]
        return [k.argmin(1) for k in d], sum(k.min(1) for k in d)

    for _ in range(rounds):
        for at, p, b in zip(assign()[0], pieces, books, strict=True):
            for e in set(at.tolist()):
                b[e] = p[at == e].sum(0) // (at == e).sum()
    at, error = assign()
    return ["".join(f"{k[i]:02x}" for k in at) for i in range(len(x))], error.tolist(), vector_codes.books_sha256(books)


def test_op12_equals_brute_force(spark):
    data = rows(f"select vec_id, embedding, label from '{SF}/embeddings.parquet' order by vec_id")
    codes, error, sha = codes_brute([(i, np.floor(1024 * np.array(e, np.float64))) for i, e, _ in data])
    totals = {}
    for e, (_, _, label) in zip(error, data, strict=True):
        totals[label] = totals.get(label, 0) + e
    want = {i: (c, e, totals[label], sha) for c, e, (i, _, label) in zip(codes, error, data, strict=True)}
    assert {r[0]: tuple(r)[1:] for r in queries.op12_vector_codes(spark, SF).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()} == want


def test_op12_search_is_exact_with_ties():
    r = np.random.default_rng(1)
    for high in (3, 40, 4000):
        book = r.integers(-high, high, (256, 4)).astype(np.float64)
        x = r.integers(-high, high, (500, 4)).astype(np.float64)
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        best, least = vector_codes.exponion(x, book, *vector_codes.neighbours(book), r.integers(0, 256, 500))
        assert (best == d.argmin(1)).all() and (least == d.min(1)).all()


def test_op12_odd(spark):
    schema = "vec_id long, embedding array<float>, label string, codes int, _s string"
    nan, inf = float("nan"), float("inf")
    data = [(3, [1.0, 2.0, 3.0, 4.0], None, 1, "a"), (1, [0.5, -0.001, 0.0, 9.0], "u", 1, "a"), (1, [0.5, -0.001, 0.0, 9.0], "u", 1, "a"), (None, [1.0, 1.0, 1.0, 1.0], None, 1, "a"), (5, None, "u", 1, "a"), (6, [], "u", 1, "a"), (7, [1.0, None, 1.0, 1.0], "u", 1, "a"), (8, [1.0, nan, 1.0, 1.0], "u", 1, "a"), (9, [inf, 1.0, 1.0, 1.0], "u", 1, "a"), (10, [1.0] * 8, "u", 1, "a")]
    got = vector_codes.code_digest(*vector_codes.compress(spark.createDataFrame(data, schema))).collect()
    assert sorted((r["vec_id"] or 0, r["error"]) for r in got) == [(0, 0), (1, 0), (1, 0), (3, 0)] and {r["label_error"] for r in got} == {0}
    assert vector_codes.code_digest(*vector_codes.compress(spark.createDataFrame([], schema))).count() == 0
    r = np.random.default_rng(5)
    many = [(i, [float(v) for v in r.normal(size=8)], "u" if i % 3 else None) for i in range(120)]
    codes, error, sha = codes_brute([(i, np.floor(1024 * np.array(np.float32(e), np.float64))) for i, e, _ in many], entries=7)
    got = {r["vec_id"]: (r["code"], r["error"], r["codebooks_sha256"]) for r in vector_codes.code_digest(*vector_codes.compress(spark.createDataFrame(many, "vec_id long, embedding array<float>, label string"), entries=7)).collect()}
    assert got == {i: (c, e, sha) for i, (c, e) in enumerate(zip(codes, error, strict=True))}
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [1.0, 2.0, 3.0], "u")], "vec_id long, embedding array<float>, label string"))


def importance_brute(docs, target, share, buckets, longest, least):
    def found(t):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    of = [(i, *found(x)) for i, x in docs]
    for _, _, b in of:
        for k in b:
            s[k] += 1
    for x in target:
        for k in found(x)[1]:
            t[k] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((float(b + 1) * float(S + buckets)) / (float(a + 1) * float(T + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, words, b in of:
        weight = sum(gain[k] for k in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * share // 100]):
        r[4] = k + 1
    return sorted(map(repr, map(tuple, out)))


def test_op13_equals_brute_force(spark):
    docs, target = rows(f"select doc_id, text from '{SF}/documents.parquet'"), [t for (t,) in rows(f"select text from '{SF}/benchmark.parquet'")]
    want = importance_brute(docs, target, 10, 10_000, 1, 20)
    assert sorted(repr(tuple(r)) for r in queries.op13_importance(spark, SF).collect()) == want
    two = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string"), share=33, buckets=50, longest=2, least_words=5)
    assert sorted(repr(tuple(r)) for r in two.collect()) == importance_brute(docs, target, 33, 50, 2, 5)


def test_op13_odd(spark):
    target = spark.createDataFrame([("word1 word2 ONE", 1), (None, 2), ("", 3)], "text string, item_id int")
    docs = [(r["doc_id"], r["text"]) for r in odd(spark).collect()]
    got = importance.resample(odd(spark), target, share=60, least_words=1)
    assert sorted(repr(tuple(r)) for r in got.collect()) == importance_brute(docs, ["word1 word2 ONE", None, ""], 60, 10_000, 1, 1)
    assert importance.resample(none(spark), target).count() == 0
    assert importance.resample(odd(spark), target.limit(0), least_words=1).count() == 12


def test_op3_without_queries_or_candidates(spark):
    from cueweave.llm import bit_codes

    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 1.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert bit_codes.search(df.filter("vec_id < 20")).count() == 0
    assert [tuple(r) for r in bit_codes.search(df).orderBy("rank").collect()] == [(20, 1, 1, 3.0), (20, 2, 2, 3.0)]
    assert bit_codes.search(df.filter("vec_id = 20")).count() == 0

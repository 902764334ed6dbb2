"""Segmentation against all ways to cut short lines."""

import math
import random

from pyspark.sql import functions as F

from cueweave.operators import segmentation as S


def ways(lattice, i=0):
    if i == len(lattice):
        yield []
    for j, p, known in lattice[i] if i < len(lattice) else []:
        for rest in ways(lattice, j):
            yield [(i, j, p, known), *rest]


def test_best_path_and_posteriors_against_all_paths():
    r = random.Random(4)
    for _ in range(200):
        chars = "天地玄黄アトムイーさん"
        run = "".join(r.choice(chars) for _ in range(r.randint(1, 9)))
        words = {run[i:j] for i in range(len(run)) for j in range(i + 1, len(run) + 1) if r.random() < 0.4}
        logp = {w: -round(r.uniform(1, 20), 1) for w in words}
        lattice = S.edges(run, logp, 4)
        every = list(ways(lattice))
        score = lambda w: (round(sum(p for _, _, p, _ in w), 6), -len(w), [j for _, j, _, _ in w])
        top = max(every, key=score)
        assert S.best_path(lattice) == [(i, j, known) for i, j, _, known in top]
        weight = [math.exp(sum(p for _, _, p, _ in w)) for w in every]
        want = {}
        for w, x in zip(every, weight, strict=True):
            for i, j, _, known in w:
                if known:
                    want[i, j] = want.get((i, j), 0) + x / sum(weight)
        got = {(i, j): p for i, j, p in S.posteriors(lattice)}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


LEXICON = [("鉄腕", -3.0), ("アトム", -3.0), ("が", -2.0), ("来た", -4.0), ("来", -5.0), ("robot", -6.0), ("", 0.0)]


def test_segment(spark):
    lexicon = spark.createDataFrame(LEXICON, "word string, logp double")
    cues = spark.createDataFrame([("e", 0, "鉄腕アトムが来た！ robot 12"), ("e", 1, None), ("e", 2, ""), ("f", 0, "…?!"), ("f", 1, "ロボットが来"), ("f", 1, "ロボットが来")], "ep string, idx int, text string")
    got = sorted(tuple(r) for r in S.segment(cues, lexicon, ["ep", "idx"]).collect())
    one = [("f", 1, 0, "ロボット", False), ("f", 1, 4, "が", True), ("f", 1, 5, "来", True)]
    assert got == sorted([("e", 0, 0, "鉄腕", True), ("e", 0, 2, "アトム", True), ("e", 0, 5, "が", True), ("e", 0, 6, "来た", True), ("e", 0, 10, "robot", True), ("e", 0, 16, "12", False), *one, *one])
    assert S.segment(cues.limit(0), lexicon, ["ep", "idx"]).count() == 0
    assert {r["term"]: r["freq"] for r in S.segmented_frequencies(cues, lexicon, 2).collect()} == {"ロボット": 2, "が": 3, "来": 2}


def test_estimation_finds_the_words_of_a_made_up_language(spark):
    r = random.Random(9)
    words = ["天地", "玄黄", "宇宙", "洪荒", "日", "月盈", "辰宿", "列張", "寒来", "暑往"]
    cut = [[r.choice(words) for _ in range(12)] for _ in range(200)]
    cues = spark.createDataFrame([(i, "".join(line)) for i, line in enumerate(cut)], "idx int, text string").repartition(3).cache()
    seed = S.seed_lexicon(cues, least=5, longest=4)
    dict_ = lambda lex: {r["word"]: r["logp"] for r in lex.collect()}
    fitted = S.estimate(cues, seed, rounds=2)
    assert S.estimate(cues.repartition(7), seed, rounds=1).orderBy("word").collect() == S.estimate(cues, seed, rounds=1).orderBy("word").collect()

    def likelihood(logp):
        every = [S.edges("".join(line), logp, 4) for line in cut]
        return sum(sum(max(p for j2, p, _ in lattice[i] if j2 == j) for i, j, _ in S.best_path(lattice)) for lattice in every)

    assert likelihood(dict_(fitted)) > likelihood(dict_(seed))
    found = {}
    for row in S.segment(cues, fitted, ["idx"]).collect():
        found.setdefault(row["idx"], []).append((row["start"], row["term"]))
    right = total = 0
    for i, line in enumerate(cut):
        ends = {sum(map(len, line[: k + 1])) for k in range(12)}
        assert "".join(t for _, t in sorted(found[i])) == "".join(line)
        right += sum(at + len(t) in ends for at, t in found[i])
        total += len(found[i])
    assert right > 0.97 * total  # a cut is where a word ends; some pairs of words stay together
    counts = {r["word"]: r["n"] for r in S.expected_counts(cues.limit(5), seed).collect()}
    brute = {}
    for r_ in cues.limit(5).collect():
        for i, j, p in S.posteriors(S.edges(r_["text"], dict_(seed), 4)):
            brute[r_["text"][i:j]] = brute.get(r_["text"][i:j], 0) + round(p * S.UNIT)
    assert counts == {w: n for w, n in brute.items() if n > 0}

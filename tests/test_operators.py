import random

from pyspark.sql import functions as F

from cueweave.operators import fixes, nouns, oped, regions, report, setops, similarity, temporal


def spans(n, seed):
    r = random.Random(seed)
    return [(r.choice("ab"), i, s := r.randrange(0, 60_000), s + r.randrange(0, 9000)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "ep string, idx long, start_ms long, end_ms long").withColumn("_id", F.col("idx")).withColumn("seg_idx", F.col("idx"))


def test_range_join_against_loops(spark):
    a, b = spans(60, 1), spans(50, 2)
    for least, slack in ((0, 0), (300, 0), (0, 1000)):
        got = {(r["idx"], r["r_idx"]) for r in temporal.range_join(frame(spark, a), frame(spark, b), ["ep"], least_ms=least, slack_ms=slack, bin_ms=5000).collect()}
        want = {(x[1], y[1]) for x in a for y in b if x[0] == y[0] and min(x[3] + slack, y[3]) - max(x[2] - slack, y[2]) >= least}
        assert got == want
    anti = {r["idx"] for r in temporal.range_join(frame(spark, a), frame(spark, b), ["ep"], bin_ms=5000, how="left_anti").collect()}
    assert anti == {x[1] for x in a if not any(x[0] == y[0] and min(x[3], y[3]) >= max(x[2], y[2]) for y in b)}


def test_islands_against_loop(spark):
    rows = spans(80, 3)
    got = sorted((r["ep"], r["start_ms"], r["end_ms"]) for r in temporal.merge_islands(frame(spark, rows), ["ep"], 500).collect())
    want = []
    for ep in "ab":
        end = None
        for _, i, s, e in sorted((x for x in rows if x[0] == ep), key=lambda x: (x[2], x[1])):
            if end is None or s - end > 500:
                want.append([ep, s, e])
                end = e
            else:
                end = max(end, e)
                want[-1][2] = end
    assert got == sorted(map(tuple, want))


def test_regions_of_silence(spark):
    speech = frame(spark, [("a", 0, 0, 10_000), ("a", 1, 20_000, 24_000), ("a", 2, 29_000, 90_000), ("a", 3, 40_000, 41_000), ("b", 4, 0, 1000)])
    cues = frame(spark, [("a", 0, 0, 2000), ("a", 1, 30_000, 31_000)]).withColumn("is_garbled", F.lit(False))
    got = {r["_id"]: (r["kind"], r["bare_ms"]) for r in regions.speech_classes(speech, cues, ["ep"]).collect()}
    # the third is cut at the last cue's end; the fourth lies beyond it, and b has no cues
    assert got == {0: ("partial_overlap", 8000), 1: ("missing", 4000), 2: ("covered", 1000)}


def test_clips(spark):
    clusters = frame(spark, [("a", 0, 10_000, 11_000), ("a", 1, 50_000, 51_000), ("b", 2, 1000, 2000), ("c", 3, 10_000, 16_000)])
    speech = frame(spark, [("a", 0, 9000, 10_500), ("c", 1, 13_000, 13_500)])
    got = {r["_id"]: (r["clip_start_ms"], r["clip_end_ms"]) for r in temporal.clip_bounds(clusters, speech, ["ep"]).collect()}
    # silence at the edges is cut to 2 s; no overlap gives no clip; without any speech half a second is added
    assert got == {0: (8000, 12_500), 1: (None, None), 2: (500, 2500), 3: (11_000, 15_500)}
    bounded = clusters.filter("_id = 0").withColumn("lo_ms", F.lit(9500)).withColumn("hi_ms", F.lit(11_200))
    assert temporal.clip_bounds(bounded, speech, ["ep"]).select("clip_start_ms", "clip_end_ms").first() == (9500, 11_200)


def test_fix_rows(spark):
    cues = frame(spark, [("a", 0, 0, 1000), ("a", 1, 1500, 2500), ("a", 2, 6000, 7000), ("a", 3, 60_000, 61_000)]).withColumn("text", F.concat(F.lit("c"), F.col("idx").cast("string")))
    asr = frame(spark, [("a", 7, 1000, 2000)]).withColumn("text", F.lit("said so")).withColumn("seg_idx", F.col("idx"))
    got = sorted((r["start_ms"], r["end_ms"], r["original"], r["replacement"], r["confidence"]) for r in regions.fix_rows(asr, cues, ["ep"]).collect())
    assert got == [(0, 2500, "c0 | c1", "said so", "high"), (6000, 7000, "c2", "said so", "retry"), (60_000, 61_000, "c3", "", "none")]
    known = cues.withColumn("left_text", F.lit("said so!")).withColumn("right_text", F.lit(""))
    assert regions.fix_rows(asr, known, ["ep"]).filter("confidence = 'retry'").count() == 0  # it says what the neighbour says


def test_outcomes_are_done_once(spark):
    cues = spark.createDataFrame([("f", 0, 0, 0, "old"), ("f", 1, 5, 1000, "gone")], "file string, idx int, start_line int, start_ms long, text string")
    todo = spark.createDataFrame([(1, "replace_text", "f", 0, None, "new"), (2, "delete_line", "f", 1000, None, None), (3, "replace_text", "f", 9999, None, "x")], "seq int, action string, file string, start_ms long, line int, replacement string")
    said = lambda c: {r["seq"]: r["outcome"] for r in fixes.outcomes(todo, c).collect()}
    assert said(cues) == {1: "applied", 2: "applied", 3: "missing"}
    assert said(fixes.replace_texts(cues, todo)) == {1: "already", 2: "already", 3: "missing"}


def test_match_rounds(spark):
    cues, asr = frame(spark, [("a", 0, 0, 1000), ("a", 1, 5000, 6000), ("a", 2, 60_000, 61_000)]), frame(spark, [("a", 7, 1500, 2500)])
    got = {r["idx"]: (r["confidence"], r["seg_idx"]) for r in regions.match_rounds(asr, cues.drop("seg_idx"), ["ep"]).collect()}
    assert got == {0: ("high", 7), 1: ("retry", 7), 2: ("none", None)}


def test_confidence(spark):
    df = spark.createDataFrame([(0.8, -0.5, 1.0), (0.1, -2.0, 1.0), (0.1, -0.5, 3.0), (0.1, -0.5, 1.0), (-1.0, None, None)], "no_speech_prob double, avg_logprob double, compression_ratio double")
    assert [r["reason"] for r in regions.confident(df).collect()] == ["no_speech", "low_logprob", "compression", None, None]


def test_greedy_buckets_against_loop(spark):
    r = random.Random(5)
    rows = [(f"f{r.randrange(6)}", i, r.choice(["OP", "ED"]), r.randrange(0, 40_000)) for i in range(120)]
    df = spark.createDataFrame(rows, "file string, idx long, region string, start_ms long")
    got = {(x["file"], x["idx"]): x["bucket_ms"] for x in oped.greedy_buckets(df).collect()}
    anchors, want = {}, {}
    for f, i, g, s in sorted(rows, key=lambda x: (x[0], x[1])):
        a = next((x for x in anchors.setdefault(g, []) if abs(x - s) <= 2000), None)
        if a is None:
            anchors[g].append(a := s)
        want[f, i] = a
    assert got == want


def test_greedy_buckets_deals_out_one_row_a_start(spark):
    df = spark.createDataFrame([(f, i, "OP" if i < 40 else None, (f % 3) * 700 + i * 900, "x") for f in range(30) for i in range(50)], "file long, idx long, region string, start_ms long, text string")
    out = oped.greedy_buckets(df)
    anchors, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r["file"], r["idx"])):
        here = anchors.setdefault(r["region"], [])
        want[r["file"], r["idx"]] = next((a for a in here if abs(a - r["start_ms"]) <= 2000), r["start_ms"])
        if want[r["file"], r["idx"]] not in here:
            here.append(r["start_ms"])
    assert {(r["file"], r["idx"]): r["bucket_ms"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan[plan.index("FlatMapGroupsInPandas") :].split("Project")[0]


def test_majority_and_slips(spark):
    df = spark.createDataFrame([("f1", 0, "OP", 0, "hello world"), ("f2", 0, "OP", 0, "hello world"), ("f3", 0, "OP", 0, "hello wurld"), ("f4", 0, "OP", 0, "zzzz")], "file string, idx int, region string, bucket_ms long, text string")
    assert [(r["file"], r["replacement"]) for r in oped.consistency(df, "en").collect()] == [("f3", "hello world")]


def test_keep_disjoint(spark):
    df = spark.createDataFrame([([(0, 4), (2, 5), (4, 2), (0, 2)],)], "s array<struct<start:int,len:int>>")
    assert [tuple(x) for x in df.select(nouns.keep_disjoint(F.col("s"))).first()[0]] == [(0, 4), (4, 2)]


def test_candidate_spans(spark):
    df = spark.createDataFrame([("We met Anna Smith and Bob.",)], "t string")
    got = [(x["start"], x["text"], x["kind"]) for x in df.select(nouns.candidate_spans(F.col("t"))).first()[0]]
    assert got == [(7, "Anna Smith", "full_name"), (22, "Bob", "name")]


def test_variant_groups(spark):
    df = spark.createDataFrame([("アトム", 9), ("アトムー", 3), ("ウラン", 4)], "term string, freq long")
    got = {r["canonical"]: (r["total_freq"], [v["word"] for v in r["variants"]]) for r in nouns.variant_groups(df).collect()}
    assert got == {"アトム": (12, ["アトムー"]), "ウラン": (4, [])}


def test_name_spans_against_fold(spark, tmp_path):
    import re

    from cueweave.plans import catalogue

    r = random.Random(5)
    words = ["Ann", "Bob Lee", "Al", "the", "x", "Mc", "Zoe.", "DeF", "Kim\nRoe", "a1"]
    texts = [" ".join(r.choice(words) for _ in range(n)) for n in (0, 1, 40, 300, 2500)] + ["w" * 500 + " Late Name here", "Ada " * 300]
    spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for t in texts:
        found = [(m.start(), -len(m[0]), m[0], kind) for kind, p in (("full_name", r"\b[A-Z][a-z]+ [A-Z][a-z]+\b"), ("name", r"\b[A-Z][a-z]{2,}\b")) for m in re.finditer(p, t)]
        kept = []
        for s, n, text, kind in sorted(found):
            if all(s >= b or s - n <= a for a, b in kept):
                kept.append((s, s - n))
                want.setdefault(kind, []).append(text)
    got = {x["kind"]: (x["n"], x["n_texts"]) for x in catalogue.QUERIES["name_spans"](spark, str(tmp_path)).collect()}
    assert got == {k: (len(v), len(set(v))) for k, v in want.items()}


def test_merge_related(spark):
    df = spark.createDataFrame([("ab", ["x", "y"]), ("abc", ["z"]), ("q", ["w"])], "key string, words array<string>")
    assert sorted((r["key"], sorted(r["words"])) for r in nouns.merge_related(df).collect()) == [("ab", ["x", "y", "z"]), ("q", ["w"])]


def test_fuzzy_join(spark):
    c = spark.createDataFrame([("Astro", "astro"), ("ASTRO", "astro"), ("Astra", "astra"), ("zzz", "zzz")], "text string, norm string")
    n = spark.createDataFrame([("Astro", "astro"), ("Uran", "uran")], "name string, name_norm string")
    assert {r["text"]: r["status"] for r in similarity.fuzzy_join(c, n).collect()} == {"Astro": "exact", "ASTRO": "variant", "Astra": "mismatch", "zzz": "unknown"}


def test_fuzzy_join_without_common_pair(spark):
    import difflib

    r = random.Random(2)
    some = ["ab", "山田", "abc", "abcd", "Axb", "AB"] + ["".join(r.choice("abcd ") for _ in range(r.randint(1, 9))) for _ in range(60)]
    names = ["axb", "山本田", "a b c", "axbxcxd"] + ["".join(r.choice("abcde") for _ in range(r.randint(1, 9))) for _ in range(40)]
    c = spark.createDataFrame([(x, f"c{x}") for x in sorted(set(some))], "text string, norm string")
    n = spark.createDataFrame([(x, f"n{x}") for x in names], "name string, name_norm string")
    for t in (0.3, 0.7, 0.8):
        got = {x["text"]: (x["name"], x["similarity"]) for x in similarity.fuzzy_join(c, n, t).collect()}
        for x in some:
            scored = [(-difflib.SequenceMatcher(None, x.lower(), y.lower()).ratio(), y) for y in names]
            score, name = min(scored)
            want = (x, 1.0) if x in names else (name, -score) if -score >= t else (None, None)
            assert got[x] == want


def test_first_wins_and_mappings(spark):
    df = spark.createDataFrame([(1, "a"), (0, "a"), (2, None), (3, None)], "o int, k string")
    assert sorted(r["o"] for r in setops.first_wins(df, ["k"], ["o"]).collect()) == [0, 2]
    a, b = (spark.createDataFrame(x, "src string, dst string") for x in ([("x", "1"), ("y", "")], [("x", "2"), ("y", "3"), ("z", "")]))
    assert {r["src"]: r["dst"] for r in setops.merge_mappings(a, b).collect()} == {"x": "1", "y": "3", "z": ""}


def test_apply_in_order(spark):
    cues = spark.createDataFrame([("f", 0, 0, 1, "a1"), ("f", 1, 10, 11, "b"), ("g", 0, 0, 1, "a")], "file string, idx int, start_ms long, end_ms long, text string")
    f = spark.createDataFrame(
        [(1, "replace_global", None, None, None, "a", "c", None, None), (2, "merge_cues", "f", 0, None, None, None, None, 2), (3, "replace_global_regex", None, None, None, None, "#", "[0-9]", None)],
        "seq long, action string, file string, start_ms long, line int, original string, replacement string, pattern string, count int",
    )
    assert sorted((r["file"], r["text"], r["end_ms"]) for r in fixes.apply_in_order(cues, f).collect()) == [("f", "c# b", 11), ("g", "c", 1)]


def test_locate_by_line(spark):
    cues = spark.createDataFrame([("f", 0, 0, 0), ("f", 1, 4, 5000)], "file string, idx int, start_line int, start_ms long")
    f = spark.createDataFrame([(1, "f", 5000, None), (2, "f", None, 6), (3, "f", 77, 99)], "seq long, file string, start_ms long, line int")
    assert {r["seq"]: r["idx"] for r in fixes.locate(f, cues).collect()} == {1: 1, 2: 1, 3: None}


def report_rows(spark, rows):
    return spark.createDataFrame(rows, "layer string, ep string, time string, original string, corrected string, status string")


def test_report_merge_never_downgrades(spark):
    old = report_rows(spark, [("2", "EP001", "1", "bad", "good", "✅"), ("3", "", "", "noun", "", "⬜")])
    new = report_rows(spark, [("2", "EP001", "1", "bad", "", "⬜"), ("3", "", "", "noun", "name", "⬜"), ("4", "EP001", "1", "bad", "x", "⬜")])
    once = report.merge(old, new)
    got = {(r["layer"], r["original"]): (r["corrected"], r["status"]) for r in once.collect()}
    assert got == {("2", "bad"): ("good", "✅"), ("3", "noun"): ("name", "⬜")}
    assert sorted(map(tuple, report.merge(once, new).collect())) == sorted(map(tuple, once.collect()))
    assert {r["layer"]: (r["n"], r["done"], r["pending"]) for r in report.summary(once).collect()} == {"2": (1, 1, 0), "3": (1, 0, 1), None: (2, 1, 1)}


def test_empty_tables(spark):
    none = frame(spark, []).withColumn("is_garbled", F.lit(True)).withColumn("text", F.lit("x"))
    assert temporal.gap_statistics(none, ["ep"]).count() == 0
    assert temporal.best_overlap(none, none, ["ep"]).count() == 0
    assert regions.fix_regions(none, none, ["ep"]).count() == 0
    assert temporal.batches(none, ["ep"]).count() == 0


def test_similar_runs(spark):
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(["hello there", "hello therе", "bye", "hello there!", "hello there"])], "file string, idx int, text string")
    assert [(r["first_idx"], r["last_idx"]) for r in similarity.similar_runs(df, ["file"]).orderBy("first_idx").collect()] == [(0, 1), (3, 4)]


def test_pairwise_jaccard_against_loop(spark, monkeypatch):
    r = random.Random(4)
    rows = [(k, "".join(r.choice("abcde山 ") for _ in range(r.randint(0, 7)))) for k in "xy" for _ in range(70)] + [("z", "one"), ("z", "one")]
    df = spark.createDataFrame(rows, "k string, text string")
    for block in (4096, 7):
        monkeypatch.setattr(oped, "BLOCK", block)
        got = {x["k"]: x["mean_jaccard"] for x in oped.pairwise_jaccard(df, ["k"]).collect()}
        for k in "xyz":
            some = sorted({t for g, t in rows if g == k})
            sims = [len(a & b) / len(a | b) if a and b else 0.0 for i, x in enumerate(some) for y in some[:i] for a, b in [(set(x.strip()), set(y.strip()))]]
            assert abs(got[k] - (sum(sims) / len(sims) if sims else 1.0)) < 1e-6


def test_opening_and_run_queries_read_whole_turns(spark, tmp_path):
    from cueweave.plans import catalogue

    same = "a line that is sung again "
    rows = [(f, t, "user", same + ("x" if t < 4 else str(f) * 90)) for f in range(4) for t in range(6)]
    rows = [(f, t, role, "a" + text[1:] if (f, t) != (3, 2) else "a line that is sunk again x") for f, t, role, text in rows]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    run = lambda name: catalogue.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted((x["region"], x["bucket_ms"]) for x in run("cluster_kinds")) == [("ED", 18000), ("ED", 24000), ("ED", 30000), ("OP", 0), ("OP", 6000), ("OP", 12000)]
    assert [(x["file"], x["idx"], x["original"], x["replacement"]) for x in run("oped_slips")] == [(3, 2, "a line that is sunk again x", same + "x")]
    assert sorted((x["n"], x["n_runs"]) for x in run("similar_runs")) == [(2, 4), (4, 4)]  # 4 alike, then 2 with another ending


def named_by_loop(line, lang, known, common):
    import re

    found = []
    for kind, lead, name, tail, after in nouns.NAME_RULES[lang]:
        for m in re.finditer(f"({lead})({name})({tail})(?:{after})", line):
            if kind.startswith("known") and m[2] not in known or kind == "name_kanji_suffix" and re.search("[ぁ-ゟ]$", line[: m.start()]):
                continue
            if not kind.startswith("known") and kind not in ("quoted", "name_kanji_suffix") and m[2] in common:
                continue
            found.append((m.start(2), len(m[2] + m[3]), m[2] + m[3], kind, m[2]))
    kept = []
    for s in sorted(found, key=lambda s: (s[0], -s[1])):
        if all(s[0] >= k[0] + k[1] or k[0] >= s[0] + s[1] for k in kept):
            kept.append(s)
    return kept


def test_named_spans_against_loops(spark):
    r = random.Random(5)
    bits = {
        "ja": ["おい", "、", " ", "アトム", "ウラン", "さん", "様", "御茶水", "山田", "博士", "先生", "あ", "って", "という", "！", "が", "カ"],
        "zh": ["喂", "、", " ", "王", "小明", "我们", "先生", "老师", "叫", "名叫", "「", "」", "！", "啊", "铁臂", "abc", "总监"],
    }
    for lang, parts in bits.items():
        lines = ["", *("".join(r.choices(parts, k=r.randrange(1, 12))) for _ in range(150))]
        for known, common in (((), nouns.NO_NAMES_ZH if lang == "zh" else ()), (("アトム", "铁臂", "小明"), ("ウラン", "王"))):
            df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)] + [(-1, None)], "i int, t string")
            c = nouns.named_spans(F.col("t"), lang, known, None if not known else common)
            got = {row["i"]: row["s"] for row in df.select("i", c.alias("s")).collect()}
            assert got.pop(-1) is None
            assert {i: [tuple(x) for x in s] for i, s in got.items()} == {i: named_by_loop(x, lang, known, common) for i, x in enumerate(lines)}


def test_replaced_runs(spark):
    cues = spark.createDataFrame([("a", i, i * 10, i * 10 + 5, t) for i, t in enumerate(["x", "la la", "la la", "y", "no", "no", "z", "oh", "oh"])], "file string, idx int, start_ms long, end_ms long, text string")
    runs = similarity.similar_runs(cues, ["file"])
    at = {r["first_idx"]: r["run"] for r in runs.collect()}
    assert sorted(at) == [1, 4, 7]
    new = spark.createDataFrame([("a", at[1], 12, 13, " sung "), ("a", at[1], 11, 12, "first"), ("a", at[4], 41, 42, "same"), ("a", at[4], 43, 44, "same"), ("a", at[7], 70, 71, "  "), ("a", at[7], 72, 73, None)], "file string, run long, start_ms long, end_ms long, text string")
    got = [(r["idx"], r["text"]) for r in similarity.replace_runs(cues, runs, new, ["file"]).orderBy("idx").collect()]
    assert got == list(enumerate(["x", "first", "sung", "y", "no", "no", "z"]))
    assert similarity.replace_runs(cues, runs.limit(0), new.limit(0), ["file"]).count() == 9

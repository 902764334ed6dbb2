"""Word segmentation of scripts without spaces: the most probable path through a lattice of lexicon words, and word
probabilities by expectation maximisation over the corpus.

A lexicon is a table (word, logp). It travels to the tasks as a dictionary, so it has a stated bound (`MOST_WORDS`); the corpus stays where it is, and
a round of estimation is one pass over it with one aggregation of counts. Characters that no word covers make unknown words: one
character, or a whole run of katakana, Latin letters or digits.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_WORDS, LONGEST, UNKNOWN, UNKNOWN_CHAR = 500_000, 8, -14.0, -1.0
UNIT = 1_000_000  # expected counts are added up as whole numbers of this part, so that no order of addition changes them
_RUN = re.compile("[぀-ヿ㐀-䶿一-鿿ｦ-ﾟ]+|[A-Za-z]+|[0-9]+")
_ALIKE = re.compile("[゠-ヿｦ-ﾟ]+")


def runs(text: str) -> list[tuple[int, str]]:
    """(start, run) of what is cut into words: runs of han and kana, and Latin words and numbers, which are words as they are."""
    return [(m.start(), m[0]) for m in _RUN.finditer(text)]


def edges(run: str, logp: dict[str, float], longest: int) -> list[list[tuple[int, float, bool]]]:
    """For each place the words that begin there: (end, log-probability, known). Every place has a way on."""
    if run[0] < "぀":
        return [[(len(run), logp.get(run, UNKNOWN), run in logp)]] + [[] for _ in run[1:]]
    alike = {m.start(): m.end() for m in _ALIKE.finditer(run)}
    out: list[list[tuple[int, float, bool]]] = []
    for i in range(len(run)):
        here = [(j, logp[w], True) for j in range(i + 1, min(len(run), i + longest) + 1) if (w := run[i:j]) in logp]
        ends = {j for j, _, _ in here}
        here += [(j, UNKNOWN + UNKNOWN_CHAR * (j - i), False) for j in sorted({i + 1, alike.get(i, i + 1)} - ends)]
        out.append(here)
    return out


def best_path(lattice: list[list[tuple[int, float, bool]]]) -> list[tuple[int, int, bool]]:
    """(start, end, known) of the words of the most probable path; among equals the one of fewer words, then of longer first words."""
    n = len(lattice)
    best: list[tuple[float, int, int]] = [(-math.inf, 0, 0)] * n + [(0.0, 0, 0)]  # log-probability, minus the words, end of the first
    pick: list[tuple[int, bool]] = [(0, False)] * n
    for i in range(n - 1, -1, -1):
        for j, p, known in lattice[i]:
            way = (round(p + best[j][0], 9), best[j][1] - 1, j)
            if way > best[i]:
                best[i], pick[i] = way, (j, known)
    out, i = [], 0
    while i < n:
        j, known = pick[i]
        out.append((i, j, known))
        i = j
    return out


def posteriors(lattice: list[list[tuple[int, float, bool]]]) -> Iterator[tuple[int, int, float]]:
    """(start, end, probability that a path drawn by its probability has this word) of the known words."""
    n = len(lattice)
    ahead = [-math.inf] * n + [0.0]
    for i in range(n - 1, -1, -1):
        ahead[i] = _log_sum([p + ahead[j] for j, p, _ in lattice[i]])
    reach = [0.0] + [-math.inf] * n
    arriving: dict[int, list[float]] = defaultdict(list)
    for i in range(n):
        if i:
            reach[i] = _log_sum(arriving.pop(i, []))
        if reach[i] == -math.inf:
            continue
        for j, p, known in lattice[i]:
            arriving[j].append(reach[i] + p)
            if known:
                yield i, j, math.exp(reach[i] + p + ahead[j] - ahead[0])


def _log_sum(values: list[float]) -> float:
    top = max(values, default=-math.inf)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def _dictionary(lexicon: DataFrame, most: int) -> dict[str, float]:
    rows = lexicon.select("word", "logp").filter("word != ''").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a lexicon travels to every task, so it may have {most} words at most")
    return dict(sorted((r["word"], r["logp"]) for r in rows))


def segment(cues: DataFrame, lexicon: DataFrame, keys: list[str], most: int = MOST_WORDS) -> DataFrame:
    """keys, start (from 0), term, known: the words of every cue's text. Punctuation, white space and other scripts are no words; a
    null or empty text has none. Of a word that the lexicon has twice the greater log-probability counts."""
    logp = _dictionary(lexicon, most)
    longest = min(LONGEST, max(map(len, logp), default=1))
    rows = cues.select(*keys, F.col("text").alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["start int, term string, known boolean"])

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            of, out = [], []
            for k, text in enumerate(pdf["_text"]):
                for at, run in runs(text or ""):
                    for i, j, known in best_path(edges(run, logp, longest)):
                        of.append(k)
                        out.append((at + i, run[i:j], known))
            found = pd.DataFrame(out, columns=["start", "term", "known"])
            yield pd.concat([pdf[keys].iloc[of].reset_index(drop=True), found], axis=1)

    return rows.mapInPandas(work, schema)


def seed_lexicon(cues: DataFrame, least: int = 5, longest: int = 4, most: int = 50_000) -> DataFrame:
    """(word, logp): the strings of 1 to `longest` characters within runs of han and kana that are seen `least` times or more, the `most` most common
    ones (single characters count on as unknown words otherwise); each map task adds up its own before the shuffle."""
    run = F.explode(F.regexp_extract_all("text", F.lit("[\\u3040-\\u30FF\\u3400-\\u4DBF\\u4E00-\\u9FFF]+"), F.lit(0))).alias("r")
    at = F.explode(F.sequence(F.lit(1), F.length("r"))).alias("at")
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("r") - F.col("at") + 1))).alias("n")
    grams = cues.select(run).select("r", at).select("r", "at", sizes).select(F.expr("substring(r, at, n)").alias("word"))
    counts = grams.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least).orderBy(F.col("n").desc(), "word").limit(most)
    return _probabilities(counts)


def _probabilities(counts: DataFrame) -> DataFrame:
    total = F.sum("n").over(Window.partitionBy())  # a lexicon has a bound
    return counts.withColumn("logp", F.round(F.log(F.col("n") / total), 9)).select("word", "logp")


def expected_counts(cues: DataFrame, lexicon: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """(word, n): expected occurrences of each word over all paths through all texts, in millionths; words that hardly occur go."""
    logp = _dictionary(lexicon, most)
    longest = min(LONGEST, max(map(len, logp), default=1))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for pdf in frames:
            seen = Counter(run for text in pdf["text"] for _, run in runs(text or ""))
            for run, times in seen.items():
                for i, j, p in posteriors(edges(run, logp, longest)):
                    counts[run[i:j]] += round(p * UNIT) * times
        yield pd.DataFrame({"word": list(counts), "n": list(counts.values())}).astype({"word": object, "n": "int64"})

    return cues.select("text").mapInPandas(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0")


def estimate(cues: DataFrame, lexicon: DataFrame, rounds: int = 3, most: int = MOST_WORDS) -> DataFrame:
    """The lexicon with log-probabilities by `rounds` rounds of expectation maximisation over all cues. Words that fall under one
    hundredth of an occurrence leave. At most `most` rows come to the driver, a round."""
    spark = cues.sparkSession
    for _ in range(rounds):
        rows = _probabilities(expected_counts(cues, lexicon, most).filter(F.col("n") >= UNIT // 100)).collect()
        lexicon = spark.createDataFrame([(r["word"], r["logp"]) for r in rows], "word string, logp double")
    return lexicon


def segmented_frequencies(cues: DataFrame, lexicon: DataFrame, least: int = 1) -> DataFrame:
    """term, freq of the words of all cues."""
    return segment(cues.select("text"), lexicon, []).groupBy("term").agg(F.count("*").alias("freq")).filter(F.col("freq") >= least)

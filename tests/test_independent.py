"""Choices by rounds against the ordered fold."""

import random

import pytest

from cueweave.operators import independent, nouns


def folded(ranked, conflicts):
    """The ordered fold: each node joins the first kept one it conflicts with, or is kept."""
    kept, root = [], {}
    for node in ranked:
        root[node] = next((k for k in kept if (k, node) in conflicts or (node, k) in conflicts), node)
        if root[node] == node:
            kept.append(node)
    return root


@pytest.mark.parametrize("seed", [1, 2])
def test_first_independent_is_the_ordered_fold(spark, seed):
    r = random.Random(seed)
    n = 120
    rank = {i: r.randint(0, 60) for i in range(n)}
    edges = [(r.randrange(n), r.randrange(n)) for _ in range(260)] + [(0, i) for i in range(1, n, 3)] + [(5, 5), (3, 999)]
    nodes = spark.createDataFrame([(i, k) for i, k in rank.items()], "node int, rank int")
    got = {x["node"]: x["root"] for x in independent.first_independent(nodes, spark.createDataFrame([*edges, *edges[:40], (None, 1)], "a int, b int")).collect()}
    assert got == folded(sorted(rank, key=lambda i: (rank[i], i)), {e for e in edges if e[0] != e[1]})


def test_a_chain_takes_a_round_a_link_or_fails(spark):
    nodes, edges = spark.createDataFrame([(i, i) for i in range(6)], "node int, rank int"), spark.createDataFrame([(i, i + 1) for i in range(5)], "a int, b int")
    assert {x["node"]: x["root"] for x in independent.first_independent(nodes, edges).collect()} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4}
    with pytest.raises(ValueError):
        independent.first_independent(nodes, edges, rounds=1)
    assert independent.first_independent(nodes.limit(0), edges.limit(0)).count() == 0


def test_merge_related_is_the_ordered_fold(spark):
    r = random.Random(3)
    keys = sorted({"".join(r.choice("アトムラ") for _ in range(r.randint(1, 5))) for _ in range(90)})
    groups = [(k, [f"w{r.randint(0, 40)}" for _ in range(r.randint(0, 4))]) for k in keys]
    pooled = {k: list(dict.fromkeys(w)) for k, w in groups}
    ranked = sorted(pooled, key=lambda k: (-len(pooled[k]), k))
    related = {(a, b) for a in keys for b in keys if a != b and len(a) >= 2 and len(b) >= 2 and (a in b or b in a)}
    want: dict = {}
    for node, root in folded(ranked, related).items():
        want.setdefault(root, []).append(node)
    expected = {root: set(w for m in members for w in pooled[m]) for root, members in want.items()}
    got = nouns.merge_related(spark.createDataFrame(groups, "key string, words array<string>")).collect()
    assert {x["key"]: set(x["words"]) for x in got} == expected and all(len(x["words"]) == len(set(x["words"])) for x in got)
    assert all(x["words"][: len(pooled[x["key"]])] == pooled[x["key"]] for x in got)


def test_containing(spark):
    df = spark.createDataFrame([("abab",), ("ab",), ("b",), ("ba",), (None,), ("",), ("ab",)], "key string")
    assert sorted(map(tuple, independent.containing(df).collect())) == [("abab", "ab"), ("abab", "ba")]
    assert sorted(map(tuple, independent.containing(df, least=1).collect())) == [("ab", "b"), ("abab", "ab"), ("abab", "b"), ("abab", "ba"), ("ba", "b")]


def test_mapped_tokens_against_the_loop(spark):
    r = random.Random(8)
    word = lambda a, b: "".join(r.choice("アトム") for _ in range(r.randint(a, b)))
    tokens = [(f"t{i}", word(1, 7)) for i in range(150)] + [("none", None), ("t3", "アトム")]
    keys, known = [(word(1, 9),) for _ in range(12)] + [(None,)], [("t5",), ("t9",), (None,)]
    df = nouns.mapped_tokens(spark.createDataFrame(tokens, "token string, reading string"), spark.createDataFrame(keys, "key string"), spark.createDataFrame(known, "token string"))
    ks, ts = {k for (k,) in keys if k}, {t for (t,) in known if t}
    near = lambda x: len(x) >= 4 and any(len(k) >= 4 and (k in x or x in k) for k in ks)
    assert {tuple(x) for x in df.collect()} == {(t, x) for t, x in tokens if x and len(x) >= 2 and (x in ks or t in ts or near(x))}
    assert df.count() == len({tuple(x) for x in df.collect()})

import random

import pytest

from quayside.llm import components as C


def brute(edges):
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, *_ in edges:
        if a is None or b is None or a == b:
            continue
        for x in (a, b):
            parent.setdefault(x, x)
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return sorted((x, root(x)) for x in parent)


def got(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long, u string, m int").repartition(5)
    return sorted((r.node, r.component) for r in C.components(df, "a", "b").collect())


@pytest.mark.parametrize("share", [C.HUB_SHARE, 10])
def test_matches_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(C, "HUB_SHARE", share)
    monkeypatch.setattr(C, "HUB_LEAST", 5)
    r = random.Random(share)
    ids = [r.randrange(-(2**62), 2**62) for _ in range(300)]
    # Chains, a hub with its reverse edges, loops, repeats and nulls.
    edges = [(ids[i], ids[i + 1], "x", 0) for i in range(100)]
    edges += [(ids[150], ids[i], "x", 0) for i in range(151, 250)] + [(ids[i], ids[150], "y", 1) for i in range(151, 200)]
    edges += [(r.choice(ids[250:]), r.choice(ids[250:]), "z", 2) for _ in range(30)] + [(ids[3], ids[3], "", 0), (ids[299], ids[299], "", 0), (None, ids[5], "", 0), (ids[5], None, "", 0)]
    assert got(spark, edges) == brute(edges)


def test_edges_of_a_hub_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = C._with_min(spark.createDataFrame([(0, i) for i in range(1, 2001)], "u long, v long"), 2000)
        sizes = marked.rdd.glom().map(len).collect()
        assert sum(sizes) == 2000 and max(sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_empty(spark):
    assert got(spark, []) == [] and got(spark, [(1, 1, "", 0), (None, None, "", 0)]) == []

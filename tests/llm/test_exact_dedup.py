import hashlib
from collections import defaultdict

from quayside.llm import exact_dedup as E

SCHEMA = "doc_id long, text string, digest string, n long"


def brute(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(d)
    out = []
    for d, t, *_ in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((d, keep, len(g), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(map(str, out))


def test_groups_match_brute_force(spark):
    rows = [(i, "hot", "c", 1) for i in range(300)] + [(1000 + i, f"t{i % 90}", "c", 1) for i in range(200)]
    rows += [(2000, None, "", 0), (2001, "", "", 0), (2002, "é" * 50_000, "", 0), (2002, "é" * 50_000, "", 0), (None, "n", "", 0), (None, "hot", "", 0)]
    for k in (1, 3, E.COUNTERS):
        got = E.exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(7), k).collect()
        assert sorted(str(tuple(x)) for x in got) == brute(rows)


def test_heavy_hitters_are_found_and_few(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}", "", 0) for i in range(3000)]
    for k in (2, 8, 64):
        hashed = E.digests(spark.createDataFrame(rows, SCHEMA).repartition(9))
        found = E.frequent(hashed, k).collect()
        assert len(found) <= k + 1
        if 1000 > 2 * 3000 / (k + 1):
            assert (2997, 1000) in [(x.keep_id, x.group_size) for x in found]


def test_misra_gries_bound():
    mg = E.MisraGries(3)
    for i in range(100):
        mg.add(["a", f"x{i}"], [1, 1])
    assert len(mg.counts) <= 3 and 100 - 200 / 4 <= mg.counts["a"] <= 100


def test_keep_last_and_empty(spark):
    assert E.exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "a", "p", 0), (2, "a", "q", 0), (3, "b", "r", 0)], SCHEMA)
    assert sorted(tuple(x) for x in E.keep_last(df).collect()) == [(2, "a", "q", 0), (3, "b", "r", 0)]

import random

import numpy as np
import xxhash
from test_textnum import brute

from quayside.llm import simhash as S

SCHEMA = "doc_id long, text string, a string, key long"


def brute_fp(text):
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in brute(text)]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_links_connect_what_is_within_three_bits():
    r = random.Random(5)
    for spread, n in ((2, 300), (6, 200), (3, 500)):
        base = [r.getrandbits(64) for _ in range(3)]
        fps = set()
        while len(fps) < n:
            x = r.choice(base)
            for _ in range(r.randrange(spread + 1)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
        fps = sorted(fps)
        keys = []
        for block, (lo, hi) in enumerate(S.BLOCKS):
            p = S._packed(np.array(fps, np.uint64), block).tolist()
            keys += [((block << 60) | (q ^ f), x) for q, x in zip(p, fps) for f in [0, *(1 << i for i in range(64 - hi + lo))]]
        keys.sort()
        k, f = np.array([x[0] for x in keys], np.int64), np.array([x[1] for x in keys], np.uint64)
        a, b = S.link_sorted(k, f)
        assert all((x ^ y).bit_count() <= 3 for x, y in zip(a.tolist(), b.tolist()))
        root = {x: x for x in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            root[find(x)] = find(y)
        want = brute_components(fps)
        got = [find(x) for x in fps]
        assert len(set(zip(want, got))) == len(set(want)) == len(set(got))
        assert int(np.max(np.unique(k, return_counts=True)[1])) > S.SMALL_RUN


def test_near_duplicates_against_brute_force(spark):
    r = random.Random(2)
    vocab = ["w%d" % i for i in range(500)]
    texts = [None, "", " \n", "One", "one", "one two", "x" * 100_000]
    for _ in range(25):
        w = [r.choice(vocab) for _ in range(r.choice([4, 60, 200]))]
        for _ in range(r.choice([1, 1, 3, 6])):
            v = list(w)
            for _ in range(r.randrange(3)):
                v[r.randrange(len(v))] = r.choice(vocab)
            texts.append(" ".join(v))
    rows = [(i * 3 + 1, t, "clash", 7) for i, t in enumerate(texts)] + [(4, "one", "", 1)]
    got = {(x.doc_id, x.fingerprint, x.component_id) for x in S.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    fps = [brute_fp(t) for _, t, _, _ in rows]
    groups = brute_components(fps)
    low = {g: min(rows[i][0] for i, h in enumerate(groups) if h == g) for g in set(groups)}
    assert got == {(rows[i][0], f"{fps[i]:016x}", low[groups[i]]) for i in range(len(rows))}


def test_empty_table_and_null_id(spark):
    assert S.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(None, "q r s", "", 0), (5, "q r s", "", 0), (None, "alone in here", "", 0)], SCHEMA)
    assert sorted(map(str, [(x.doc_id, x.component_id) for x in S.near_duplicates(df).collect()])) == ["(5, 5)", "(None, 5)", "(None, None)"]


def test_keep_one_keeps_columns(spark):
    df = spark.createDataFrame([(1, "q r s", "x", 0), (5, "q r s", "y", 0), (9, "t u v w", "z", 0)], SCHEMA)
    assert sorted(tuple(x) for x in S.keep_one(df).collect()) == [(1, "q r s", "x", 0), (9, "t u v w", "z", 0)]

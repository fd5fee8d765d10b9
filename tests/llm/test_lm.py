import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quayside.llm import lm as L

SCHEMA = "doc_id long, text string, key long, n long"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + [None]


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def corpus(n=400):
    r = random.Random(7)
    vocab = [f"Wort{i}é" for i in range(300)]
    rows = [(i, " ".join(r.choice(vocab[: r.choice([5, 40, 300])]) for _ in range(r.randrange(60))), 1, 2) for i in range(n)]
    return rows + [(9001, None, 0, 0), (9002, "  ", 0, 0), (None, "wort1é unseen", 0, 0), (9003, "x" * 300_000, 0, 0), (3, rows[3][1], 0, 0)]


@pytest.mark.parametrize("share, shard", [(L.HEAD_SHARE, L.SHARD_TOKENS), (20, L.SHARD_TOKENS), (20, 500), (1, 100)])
def test_base_score_is_exact(spark, monkeypatch, share, shard):
    monkeypatch.setattr(L, "HEAD_SHARE", share)
    monkeypatch.setattr(L, "SHARD_TOKENS", shard)
    rows = corpus()
    c = Counter(w for i, t, *_ in rows if not out(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    got = L.scored(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want = sorted(
        (str(i), out(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 6))
        for i, t, *_ in rows
    )
    assert sorted((str(x.doc_id), x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in got) == want


def test_filter_never_misses_and_seldom_overstates():
    r = np.random.default_rng(3)
    keys = r.integers(0, 2**63, 20_000).astype(np.uint64)
    n = np.maximum(1, r.pareto(1, len(keys)).astype(np.int64))
    top = L.level_of(n, 1)
    cells = np.zeros(int(top.sum()) * L.BITS // 64, np.uint64)
    for j in range(1, int(top.max()) + 1):
        cell, bits = L.place(keys[top >= j], j, len(cells))
        np.bitwise_or.at(cells, cell, bits)
    est = L.Filter(cells, 1).counts(keys)
    assert (est >= np.exp2(top - 1)).all() and np.mean(est > 2.0**top) < 0.08
    assert np.mean(L.Filter(cells, 1).counts(r.integers(0, 2**63, 20_000).astype(np.uint64)) > 0) < 0.08


def test_distributed_filter_equals_local(spark):
    rows = [(i * 7919, 1 + i % 9) for i in range(500)]
    f = L.build_filter(spark.createDataFrame(rows, "key long, n long").repartition(4), 2000, 1 << 20)
    k, n = np.array([x[0] for x in rows], np.uint64), np.array([x[1] for x in rows])
    assert (f.counts(k) >= np.exp2(L.level_of(n, 1) - 1)).all()
    assert L.build_filter(spark.createDataFrame(rows, "key long, n long"), 2000, 500).least == 4


def test_bigrams_help_on_held_out_text(spark):
    r = random.Random(1)
    rows = []
    for i in range(600):
        w = ["a"]
        for _ in range(80):
            w.append({"a": "b", "b": "c"}.get(w[-1], "a") if r.random() < 0.8 else r.choice("abcdefgh"))
        rows.append((i, " ".join(w), 0, 0))
    got = L.scored(spark.createDataFrame(rows, SCHEMA)).filter("held_out").collect()
    assert sum(x.score for x in got) > 0.8 * sum(x.base_score for x in got)
    assert all(x.score <= 0 for x in got)


def test_empty(spark):
    assert L.scored(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("share", [L.HEAD_SHARE, 20])
def test_pairs_of_rare_words_count(spark, monkeypatch, share):
    monkeypatch.setattr(L, "HEAD_SHARE", share)
    held = [i for i in range(3000) if out(i)][:40]
    rows = [(i, "the cat and the dog " * 5, 0, 0) for i in range(200) if not out(i)]
    rows += [(i, f"left{i} right{i}", 0, 0) for i in range(1000, 1200) if not out(i)]
    seen = [i for i in range(1000, 1200) if not out(i)][: len(held)]
    rows += [(i, f"left{k} right{k}" if j % 2 else f"left{k} right{k + 1 if not out(k + 1) else k + 2}", 0, 0) for j, (i, k) in enumerate(zip(held, seen))]
    got = {x.doc_id: x.score for x in L.scored(spark.createDataFrame(rows, SCHEMA).repartition(4)).filter("held_out").collect()}
    same, mixed = ([got[i] for j, i in enumerate(held) if j % 2 == k] for k in (1, 0))
    assert sum(same) / len(same) > sum(mixed) / len(mixed) + 0.2


def test_rare_words_are_told_from_unseen_at_any_size(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_INSERTIONS", {1: 50, 2: 50}, raising=False)
    monkeypatch.setattr(L, "HEAD_SHARE", 20)
    held = [i for i in range(3000) if out(i)][:80]
    rows = [(i, "the cat and the dog " * 5 + f"rare{i}", 0, 0) for i in range(400) if not out(i)]
    seen = [i for i in range(400) if not out(i)]
    rows += [(i, f"rare{k}" if j % 2 else f"never{k}", 0, 0) for j, (i, k) in enumerate(zip(held, seen))]
    got = {x.doc_id: x.score for x in L.scored(spark.createDataFrame(rows, SCHEMA).repartition(4)).filter("held_out").collect()}
    rare, never = (sum(got[i] for j, i in enumerate(held) if j % 2 == k) / 40 for k in (1, 0))
    assert rare > never + 0.3


def test_score_equals_brute_force_in_any_number_of_shards(spark, monkeypatch):
    monkeypatch.setattr(L, "BITS", 64)
    rows = corpus()
    train = [words(t) for i, t, *_ in rows if not out(i)]
    c1 = Counter(w for t in train for w in t)
    c2 = Counter(x for t in train for x in zip([None, *t], t))
    n, v = sum(c1.values()), len(c1)

    def quantised(x):
        return 2 ** (math.floor(math.log2(x)) + 0.5) if x else 0.0

    def score(t):
        total = 0.0
        for u, w in zip([None, *t], t):
            p1 = (quantised(c1[w]) + 0.1) / (n + 0.1 * (v + 1))
            total += math.log10((quantised(c2[u, w]) + L.PRIOR * p1) / (quantised(c1[u]) + L.PRIOR))
        return total

    want = sorted((str(i), score(words(t))) for i, t, *_ in rows)
    for share, shard in ((L.HEAD_SHARE, L.SHARD_TOKENS), (20, 500)):
        monkeypatch.setattr(L, "HEAD_SHARE", share)
        monkeypatch.setattr(L, "SHARD_TOKENS", shard)
        got = sorted((str(x.doc_id), x.score) for x in L.scored(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect())
        assert [i for i, _ in got] == [i for i, _ in want]
        # Bloom filters may overstate some counts by a level.
        off = sorted(abs(a - b) / max(1.0, abs(b)) for (_, a), (_, b) in zip(got, want))
        assert off[int(0.9 * len(off))] < 0.01 and off[-1] < 0.1

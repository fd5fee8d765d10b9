import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quayside.llm import quality as Q

DOCS, LABELS = "doc_id long, text string, n_words string, kept int", "doc_id long, quality int, toxic int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def texts():
    r = random.Random(2)
    out = ["".join(r.choice(["a", "b ", "é", "\n", " ", "#", "|x", "😀 ", "A b c ", "\x0b", "\xa0"]) for _ in range(r.randrange(120))) for _ in range(300)]
    return out + [None, "", "\n\n", "one two three one two three", "w " * 60_000, "x" * 40_000]


def test_counts_match_brute_force(monkeypatch):
    t = texts()
    for limit in (100, Q.T.CHUNK_BYTES):
        monkeypatch.setattr(Q.T.chunks, "__defaults__", (limit,))
        c = Q.rule_counts(pa.array(t))
        got = list(zip(*(c[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
        assert got == [brute(x) for x in t]


def test_query_rows_and_edges(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts())] + [(None, "a b", "", 0), (3, texts()[3], "", 0)]
    labels = [(i, i % 2, 0) for i in range(0, 200)] + [(None, 1, 0), (1, None, 0), (2, 5, 0), (4, 0, 0)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    for lab in (labels, []):
        got = Q.judged(df, spark.createDataFrame(lab, LABELS)).collect()
        want = []
        for i, t, *_ in rows:
            b = brute(t)
            want.append((str(i), *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted(want)
        assert not any(r.kept and r.base_failed for r in got)
        assert lab or all(r.kept != r.base_failed for r in got)
    assert Q.judged(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0


def test_forest_finds_what_is_odd(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(3, 8)))
    good = [" ".join(word() for _ in range(120)) + "." for _ in range(600)]
    junk = [" ".join(word() + r.choice(["###", "***", "%%%"]) for _ in range(120)) for _ in range(60)]
    rows = [(i, t, "", 0) for i, t in enumerate(good + junk)]
    labels = [(i, int(i < 600), 0) for i in range(660) if i % 2 == 0]
    got = {x.doc_id: x.kept for x in Q.judged(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert sum(got[i] for i in range(600)) > 570 and sum(got[i] for i in range(600, 660)) < 6


def test_isolated_point_scores_highest():
    x = np.random.default_rng(1).normal(size=(500, 3))
    x[0] = 9
    f = Q.grow(x, 100, 128, 1, np.ones(3))
    assert f.score(x).argmax() == 0 and len(Q.grow(x[:1], 10, 10, 1, np.ones(3)).feature) == 0


def test_cutoff_matches_brute_force():
    r = random.Random(8)
    for _ in range(200):
        good, bad = ([r.randrange(12) for _ in range(r.randrange(1, 30))] for _ in range(2))
        loss = r.choice([0.0, 0.1, 0.5])
        gain = {b: sum(x >= b for x in bad) / len(bad) - sum(x >= b for x in good) / len(good) for b in range(12) if sum(x >= b for x in good) <= loss * len(good)}
        at = Q.cutoff(Counter(good), Counter(bad), 10, loss)
        assert at == float("inf") if max(gain.values(), default=0) <= 0 else abs(gain[round(at * 10)] - max(gain.values())) < 1e-12
    assert Q.cutoff({}, {1: 3}, 10, 0.1) == Q.cutoff({1: 3}, {}, 10, 0.1) == float("inf")


def test_separation_prefers_the_column_that_tells():
    g = np.random.default_rng(3)
    x, good = g.normal(size=(400, 3)), np.arange(400) >= 40
    x[~good, 1] += 8
    w = Q.separation(x, good, 0.05)
    assert w[1] > 0.9 and w[0] < 0.2 and w[2] < 0.2 and (Q.separation(x, np.ones(400, bool), 0.05) == 1).all()

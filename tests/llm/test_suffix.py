import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quayside.llm import suffix as S

SCHEMA = "doc_id long, text string, d long, at long"


def brute(rows, length):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (i, *_), b in zip(rows, data):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k, x in enumerate(gone) if x and (not k or not gone[k - 1]))
        out.append((str(i), len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def got(df, **kw):
    return sorted((str(x.doc_id), x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in S.without_repeats(df, **kw).collect())


@pytest.mark.parametrize("length", [3, 20, 100, 400])
def test_cover_meets_every_pair_of_positions(length):
    v, d = S.difference_cover(length)
    assert v < length and {(i - j) % v for i in d.tolist() for j in d.tolist()} == set(range(v))


@pytest.mark.parametrize("length", [3, 20, 40])
def test_matches_brute_force(spark, length):
    r = random.Random(length)
    words = ["".join(r.choice("abcdé ") for _ in range(r.randrange(1, 60))) for _ in range(60)]
    rows = [(i, "".join(r.choice(words) for _ in range(r.randrange(12))), 1, 2) for i in range(70)]
    rows += [(100, rows[3][1], 0, 0), (101, None, 0, 0), (102, "", 0, 0), (103, "z" * 500, 0, 0), (104, "q" * (length + 1), 0, 0), (105, "p" * length, 0, 0), (None, "x" + rows[5][1], 0, 0), (102, "", 0, 0)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4), length=length, blocks=3) == brute(rows, length)


def test_contract_length_and_shared_passages(spark):
    r = random.Random(1)
    rand = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage, edge = rand(401), rand(399)
    rows = [(i, rand(r.randrange(900)) + passage + rand(50), 0, 0) for i in range(30)] + [(50 + i, rand(300) + edge + rand(300), 0, 0) for i in range(3)]
    rows += [(90, passage[:400] + "!" + passage[1:], 0, 0)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows, 400)


def passages(rows, length, words):
    """Maximal runs of words in windows that a different text holds too; one for a whole copy."""
    import re

    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    holds = {}
    for (_, t, *_), w in zip(rows, split):
        for k in range(len(w) - words + 1):
            holds.setdefault(tuple(w[k : k + words]), set()).add(t or "")
    copies = Counter(t or "" for _, t, *_ in rows)
    out = []
    for (i, t, *_), w in zip(rows, split):
        covered = [False] * len(w)
        for k in range(len(w) - words + 1):
            if len(holds[tuple(w[k : k + words])]) > 1:
                covered[k : k + words] = [True] * words
        n = sum(1 for k, x in enumerate(covered) if x and (not k or not covered[k - 1]))
        out.append((str(i), 1 if copies[t or ""] > 1 and len((t or "").encode()) >= length else n))
    return sorted(out)


@pytest.mark.parametrize("gather", [S.GATHER, 300])
def test_passages_match_brute_force(spark, gather, monkeypatch):
    monkeypatch.setattr(S, "GATHER", gather)
    r = random.Random(6)
    word = lambda: r.choice("ab cd ef gh é ij kl mn op qr st uv".split())
    shared = [" ".join(word() for _ in range(r.randrange(3, 30))) for _ in range(30)]
    rows = [(i, r.choice([" ", "\n", "  "]).join(r.choice(shared) if r.random() < 0.4 else word() for _ in range(r.randrange(30))), 1, 2) for i in range(80)]
    own = " ".join(f"w{i}" for i in range(15))
    rows += [(200, own + " x " + own, 0, 0), (201, rows[3][1], 0, 0), (202, None, 0, 0), (203, "p q " * 40, 0, 0), (204, "p q " * 30 + "z", 0, 0)]
    got_ = S.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4), length=60, blocks=2, words=12).collect()
    assert sorted((str(x.doc_id), x.n_passages) for x in got_) == passages(rows, 60, 12)


def test_long_texts_over_a_chunk(spark):
    r = random.Random(7)
    long = "".join(r.choice("abcdefghij klmnop") for _ in range(S.CHUNK + 300_000))
    rows = [(1, "x" + long[:700_000] + "!" + long[700_001:], 0, 0), (2, long, 0, 0), (3, "own " + long[S.CHUNK - 200 : S.CHUNK + 250], 0, 0), (4, long[5:300], 0, 0)]
    got_ = {x.doc_id: x for x in S.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got_[1].n_bytes, got_[1].n_removed, got_[1].n_spans) == (len(long) + 1, len(long) - 1, 2)
    # The changed place stands in no recurring string, but what is beside it does.
    assert (got_[2].n_removed, got_[2].n_spans) == (len(long) - 1, 2)
    assert (got_[3].n_removed, got_[3].n_spans) == (450, 1) and got_[4].n_removed == 0


def test_a_string_that_very_many_texts_share_is_sent_once_by_each_task():
    n = 5000
    place = (np.full(n, 7, np.uint64), np.full(n, 3, np.uint32), np.arange(n, dtype=np.int64), np.full(n, 9, np.int32))
    b = S._parcels(place, 8)
    sent = S.unpacked([x for x, f in zip(b["data"].to_pylist(), b["found"].to_pylist()) if not f], tuple(k for _, k in S.PLACE))
    known = S.unpacked([x for x, f in zip(b["data"].to_pylist(), b["found"].to_pylist()) if f], (np.int64, np.int32))
    assert len(sent[0]) == 1 and sorted(known[0].tolist()) == list(range(n))


def test_encoded_positions_come_back():
    r = np.random.default_rng(1)
    for high in (10, 2000, 2**31 - 1):
        p = np.unique(r.integers(-high, high, 300)).astype(np.int32)
        for x in (p, p[:1], p[:0], p[:2]):
            assert S.decoded(S.encoded(x)).tolist() == x.tolist()
    assert S.decoded(S.encoded(np.array([0, 254, 509, 765], np.int32))).tolist() == [0, 254, 509, 765]


def test_recur_matches_brute_force():
    r = np.random.default_rng(2)
    for _ in range(30):
        n = int(r.integers(0, 200))
        x = (r.integers(0, 12, n).astype(np.uint64), r.integers(0, 2, n).astype(np.uint32), r.integers(0, 4, n), r.integers(0, 3, n).astype(np.int32))
        if r.random() < 0.5:
            x = (*x[:3], -1 - x[3])
        (k, c, d, p), again, first = S.recur(x)
        rows = list(zip(k.tolist(), c.tolist(), d.tolist(), p.tolist()))
        assert sorted(rows) == sorted(zip(*(a.tolist() for a in x)))
        held = {}
        for a, b_, e, q in rows:
            held.setdefault((a, b_), set()).add((e, q) if q >= 0 else e)
        assert again.tolist() == [len(held[a, b_]) > 1 for a, b_, _, _ in rows] and first.sum() == len(held)


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []

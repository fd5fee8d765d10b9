import math
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from quayside.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, sample int, ids long"


@pytest.fixture(scope="module")
def model():
    return P.Pieces(PATH)


def all_segmentations(model, word):
    """{ids: log-probability} by brute force."""
    out = {}

    def go(i, w, ids):
        if i == len(word):
            out[ids] = w
        else:
            for v, x, n in model.arcs_from(word, i):
                go(i + n, w + v, ids + x)

    go(0, 0.0, ())
    z = math.log(sum(math.exp(w) for w in out.values()))
    return {k: w - z for k, w in out.items()}


def test_lists_are_the_best_segmentations(model):
    for word in ("▁the", "▁hello", "▁▁x", "\n", "é▒", "▁internation"):
        want = sorted(all_segmentations(model, word).values(), reverse=True)
        logs, segs, others = model.listed(word)
        assert (others > 0) == (len(want) > P.LISTED) and np.allclose(logs, want[: P.LISTED]) and len(set(segs)) == len(segs) == min(P.LISTED, len(want))
        for p, s in zip(logs, segs):
            assert math.isclose(all_segmentations(model, word)[tuple(np.frombuffer(s, np.uint32).tolist())], p, abs_tol=1e-9)


@pytest.mark.parametrize("listed", [P.LISTED, 2])
def test_sampling_frequencies_without_replacement(monkeypatch, listed):
    """Which pair of segmentations is drawn, and in which order, against the exact law of draws without replacement."""
    monkeypatch.setattr(P, "LISTED", listed)
    model = P.Pieces(PATH, alpha=0.15)
    text = "a he"
    words = P.WORD.findall(P.MARK + text.replace(" ", P.MARK))
    law = {(): 0.0}
    for w in words:
        law = {a + b: x + y for a, x in law.items() for b, y in all_segmentations(model, w).items()}
    p = {k: math.exp(v) for k, v in law.items()}
    n = 6000
    got = P.sample(model, [text] * n, P.row_seeds(list(range(n)), 3), 2)
    ids = lambda s: tuple(np.frombuffer(s[3], np.uint32).tolist())
    pairs = Counter((ids(a), ids(b)) for a, b in got)
    assert all(a != b for a, b in pairs)
    for a, b in ((x, y) for x in p for y in p if x != y):
        want = p[a] * p[b] / (1 - p[a])
        if want > 0.005:
            assert abs(pairs[a, b] / n - want) < 5 * math.sqrt(want / n), (a, b)
    # Inverse inclusion weights estimate the number of segmentations without bias.
    estimate = sum(sum(math.exp(-s[2]) for s in rows) for rows in got) / n
    assert abs(estimate - len(p)) < 0.35 * len(p)


def test_all_segmentations_come_once(model):
    want = {k: v for k, v in all_segmentations(model, "▁hey").items()}
    rows = P.sample(model, ["hey"], P.row_seeds([5], 1), 50)[0]
    got = {tuple(np.frombuffer(s[3], np.uint32).tolist()): s[0] for s in rows}
    assert got.keys() == want.keys() and len(rows) == len(want) and all(s[2] == 0 for s in rows)
    assert all(math.isclose(got[k], want[k], abs_tol=1e-6) for k in got)
    g = [s[1] for s in rows]
    assert g == sorted(g, reverse=True)


def test_draws_follow_the_law_of_what_is_not_left_out(model):
    word = "▁hey"
    law = {np.array(k, np.uint32).tobytes(): v for k, v in all_segmentations(model, word).items()}
    best = sorted(law, key=law.get, reverse=True)
    for n in (1, 4, len(best) - 2, len(best) - 1):
        without = set(best[:n])
        rest = sum(math.exp(law[k]) for k in best[n:])
        got = Counter()
        for i in range(4000):
            # Drawn from the lattice less what is left out, whether that is common or not.
            p, ids = model.draw(word, P._stream(i, n), without, 0.0)
            assert math.isclose(p, law[ids], abs_tol=1e-9)
            got[ids] += 1
        assert not set(got) & set(without)
        for k in best[n:]:
            want = math.exp(law[k]) / rest
            assert abs(got[k] / 4000 - want) < 5 * math.sqrt(want / 4000) + 1e-3
    # A long word, of which only a listed few are left out.
    _, segs, others = model.listed("▁" + "internationalisation" * 200)
    assert others > 0.5 and all(model.draw("▁" + "internationalisation" * 200, P._stream(1), set(segs), x)[1] not in segs for x in (others, 0.0))


def test_round_trip_and_edges(spark):
    texts = [(1, "Hello  world,\n\nnaïve 😀 ▒ test "), (2, None), (3, ""), (4, "x" * 30_000), (5, " lead"), (6, "the cat sat " * 2_000), (None, "null key"), (1, "Hello  world,\n\nnaïve 😀 ▒ test ")]
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in texts], SCHEMA).repartition(3)
    out = P.decoded(P.encoded(df, PATH, 3, with_ids=True), PATH).collect()
    want = {(i, t or "") for i, t in texts}
    assert {(r.doc_id, r.text) for r in out} == want
    by = Counter(r.doc_id for r in out)
    assert by[1] == 6 and by[2] == by[3] == 1 and by[4] == by[6] == by[None] == 3
    for r in out:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, np.uint32).tobytes()) and r.n_pieces == len(r.ids) and r.log_prob <= 0 and r.log_inclusion <= 0
    assert len({(r.doc_id, tuple(r.ids)) for r in out}) == len(out) - 3
    again = P.encoded(df.repartition(1), PATH, 3).collect()
    assert sorted((str(r.doc_id), r.sample, r.ids_crc32) for r in again) == sorted((str(r.doc_id), r.sample, r.ids_crc32) for r in out)
    assert P.encoded(spark.createDataFrame([], SCHEMA), PATH).count() == 0


LETTERS = "abehinrst▁\n\0é😀한中\U0010ffff"


def some_words(n, longest, letters=LETTERS):
    rng = np.random.default_rng(7)
    return ["".join(letters[i] for i in rng.integers(0, len(letters), m)) for m in rng.integers(1, longest + 1, n)]


@pytest.mark.parametrize(("short", "pairs", "listed"), [(P.SHORT, P.PAIRS, P.LISTED), (0, P.PAIRS, P.LISTED), (5, 0, 2), (P.SHORT, 0, 8)])
def test_words_listed_at_once_equal_the_lattice_of_each(monkeypatch, short, pairs, listed):
    for name, value in (("SHORT", short), ("PAIRS", pairs), ("LISTED", listed)):
        monkeypatch.setattr(P, name, value)
    model = P.Pieces(PATH)
    words = [*some_words(300, 12), *some_words(20, 100), "▁internationalisation", "x" * 64, "x" * 65]
    codes = np.array([ord(c) for w in words for c in w], np.uint32)
    lengths = np.array([len(w) for w in words])
    lists = model.lists(codes, np.cumsum(lengths) - lengths, lengths)
    for i, w in enumerate(words):
        into, mass = model.lattice(w)
        want, more = model.best(into, listed)
        assert lists.segments(i) == [ids for _, ids in want] and np.allclose(lists.logs[i, : len(want)], [x - mass[-1] for x, _ in want], atol=1e-9)
        assert np.isneginf(lists.logs[i, len(want) :]).all() and (lists.others[i] > 0) == more
    # Cuts are where words end and between characters that no piece joins.
    text = "".join(P.MARK + w.replace(" ", P.MARK) for w in words)
    joins = model.joins(model.letters(np.array([ord(c) for c in text], np.uint32)))
    pairs_of = {x[i : i + 2] for x in model.arcs for i in range(len(x) - 1)}
    assert joins.tolist() == [text[i : i + 2] in pairs_of for i in range(len(text) - 1)]
    ends = np.cumsum([len(x) for x in P.WORD.findall(text)])[:-1]
    assert not joins[ends - 1].any()


def test_words_with_one_hash_are_told_apart(model, monkeypatch):
    texts = [" ".join(some_words(30, 6)), "hello hello world", "", "\0 \0\0 \0"]
    want = P.sample(model, texts, P.row_seeds([1, 2, 3, 4], 1), 3)
    real = P.mix
    monkeypatch.setattr(P, "mix", lambda x: x * np.uint64(0) if len(x) > 1000 else real(x))
    assert P.sample(model, texts, P.row_seeds([1, 2, 3, 4], 1), 3) == want


def test_distinct_words_are_not_worked_on_one_by_one(model):
    """Python calls a distinct word: some 200 when lists were made in Python."""
    words = sorted(set(some_words(6_000, 9, "abcdehilnorstu")))
    calls = 0

    def count(*_):
        nonlocal calls
        calls += 1

    # Only the lists: draws from outside them do need a lattice.
    model.draw, draw = lambda *_: (-9.0, b"\1\0\0\0"), model.draw
    sys.setprofile(count)
    try:
        P.sample(model, [" ".join(words)], P.row_seeds([1], 1), 2)
    finally:
        sys.setprofile(None)
        model.draw = draw
    assert calls < 20 * len(words)

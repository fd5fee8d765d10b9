import random
import re

import pyarrow as pa
import xxhash

from quayside.llm import textnum as T


def brute(text, size=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def test_shingle_hashes_match_the_c_library():
    r = random.Random(1)
    texts = ["".join(r.choice("aB é\n\t xyz€\x0b\x85\xa0 ") for _ in range(r.choice([0, 1, 2, 5, 30, 300]))) for _ in range(200)]
    texts += [None, "a", "a b", "x" * 700 + " y z w", "ab", ""]
    for limit in (50, 1000, 1 << 22):
        got = []
        for c in T.chunks(pa.array(texts), limit):
            w = T.words(c, lower=True, compact=True)
            starts, lens, first = T.shingles(w, 3)
            h = T.xxh64(w.data, starts, lens)
            got += [h[first[d] : first[d + 1]].tolist() for d in range(c.n)]
        assert got == [[xxhash.xxh64_intdigest(x.encode(), 42) for x in brute(t)] for t in texts]


def test_compact_and_plain_words_agree():
    texts = pa.array(["a  bc", "", "d", "\n e\t", None, "f"])
    for c in T.chunks(texts):
        a, b = T.words(c), T.words(c, compact=True)
        assert (a.first == b.first).all() and (T.word_hashes(a) == T.word_hashes(b)).all()

import base64
import hashlib
import random
import re
import string

import pytest

from quayside.llm import secrets as S

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans_match_brute_force(spark):
    r = random.Random(3)
    bits = ["token", "Api_Key", "APIKEY", "passwd", "PassWord", "secret", ": ", "=", '"', "'", " ", "  =  ", "abc", "abcdef", "x" * 9, "AKIA", "AKIAQ7" * 4]
    bits += ["0f" * 12, "0f" * 11, "a1" * 30, "é", "😀", "", "", "", "\n", "ſecret=abcdefg", "toKen=abcdefg"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(25))), 1) for i in range(400)]
    rows += [(900, None, 1), (901, "", 1), (902, "lorem " * 30_000 + "token=abcdefgh", 1), (903, "token: token = abcdefgh", 1), (900, None, 1)]
    got = S.found(spark.createDataFrame(rows, "doc_id long, text string, base_ int").repartition(6)).collect()
    want = {}
    for i, t, _ in rows:
        b = brute(t)
        named = ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in b)
        want[i] = tuple(sum(x[1] == k for x in b) for k in range(3)) + (hashlib.sha256(named.encode()).hexdigest(), named)
    assert len(got) == len(rows)
    for x in got:
        w = want[x.doc_id]
        assert (x.n_assign, x.n_access, x.n_hex, x.base_sha256) == w[:4], x
        assert [s for s in x.spans.split(",") if s and not s.startswith("random")] == [s for s in w[4].split(",") if s]


def test_random_tokens_are_told_from_words(spark):
    r = random.Random(9)
    secret = [base64.b64encode(r.randbytes(30)).decode().rstrip("=") for _ in range(60)]
    plain = ["the-quick-brown-fox-jumps-over-the-lazy-dog", "internationalization", "some_long_identifier_name_here", "a" * 40, "abcdefghijklmnopqrstuvwxyz", "12345678901234567890123"]
    plain += ["-".join(r.choice(["data", "user", "table", "index", "value", "search"]) for _ in range(5)) for _ in range(200)]
    rows = [(i, f"see {t} for it") for i, t in enumerate(secret + plain)]
    got = {x.doc_id: x.spans for x in S.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hits = [i for i, s in got.items() if "random" in s]
    assert sum(i < len(secret) for i in hits) >= 50
    assert sum(i >= len(secret) for i in hits) <= 2
    assert all(got[i] == f"random:4:{4 + len(secret[i])}" for i in hits if i < len(secret))


@pytest.mark.parametrize(("alphabet", "least"), [(string.ascii_letters + string.digits, 0.9), (string.ascii_letters + string.digits + "+/", 0.9), ("0123456789ABCDEF", 0.9), (S.ENCODINGS["base32"][1], 0.6)])
def test_recall_by_length(spark, alphabet, least):
    r = random.Random(4)
    tokens = [(n, "".join(r.choice(alphabet) for _ in range(n))) for n in (20, 24, 32) for _ in range(60)]
    rows = [(i, f"see {t} for it") for i, (_, t) in enumerate(tokens)] + [(1000 + i, f"the {w}-{w}s-and-other-{w}-words {w}") for i, w in enumerate(["table", "value", "column", "reader"] * 50)]
    got = {x.doc_id: x.spans for x in S.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n in (20, 24, 32):
        own = [i for i, (m, _) in enumerate(tokens) if m == n]
        assert sum("random" in got[i] for i in own) >= least * len(own), n
    assert not any(got[i] for i in got if i >= 1000)


def test_redaction_and_empty(spark):
    assert S.found(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(1, "a token=0123456789abcdef0123456789 b", 5, "x"), (2, "clean", 5, "y"), (3, None, None, None)]
    got = sorted(map(tuple, S.redacted(spark.createDataFrame(rows, "doc_id long, text string, n_chars long, all_ string")).collect()))
    assert got == [(1, "a [secret] b", 12, "x"), (2, "clean", 5, "y"), (3, None, None, None)]

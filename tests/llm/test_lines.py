import hashlib
import random
from collections import Counter

import pytest

from quayside.llm import lines as L

SCHEMA = "doc_id long, text string, hit int, key long"


def brute(rows, min_docs=3):
    """By templates written out as tuples."""

    def templates(line):
        t = L.VARIABLE.sub("<*>", line.lower()).split()
        n = len(t)
        out = [(n, tuple(t))] if n else []
        for wild in range(4) if n >= L.FIELDS else ():
            out.append((n, tuple(t[:2]), wild, tuple(x for q in range(4) if q != wild for x in t[n * q // 4 : n * (q + 1) // 4])))
        return out

    docs = Counter(k for _, t, *_ in rows for k in {k for line in (t or "").split("\n") for k in templates(line)})
    least = lambda k: 2 if len(k) == 2 and k[0] > 50 else min_docs
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not any(docs[k] >= least(k) for k in templates(x))]
        out.append((str(i), sum(bool(x.strip()) for x in lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("gather", [L.GATHER, 20])
def test_matches_brute_force(spark, gather, monkeypatch):
    monkeypatch.setattr(L, "GATHER", gather)
    r = random.Random(3)
    word = lambda: r.choice(["alpha", "beta", "gamma", "delta", "x1", "mail@x", "é"])
    pool = [" ".join(word() for _ in range(r.choice([1, 3, 8, 16, 20, 60]))) for _ in range(40)]
    rows = [(i, "\n".join(r.choice(pool) if r.random() < 0.5 else " ".join(word() for _ in range(12)) for _ in range(r.randrange(8))), 0, 0) for i in range(80)]
    rows += [(200, None, 0, 0), (201, "", 0, 0), (202, "\n\n", 0, 0), (203, "w " * 100_000, 0, 0), (None, pool[0], 0, 0), (3, rows[3][1], 0, 0)]
    rows += [(300, "only these two rows are alike", 0, 0)] * 2 + [(301, "and these three rows are alike", 0, 0)] * 3
    got = L.without_recurring_lines(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted((str(x.doc_id), x.n_lines, x.n_dropped, x.kept_sha256, x.kept_text) for x in got) == brute(rows)


def test_a_line_that_most_documents_share_is_sent_by_few_of_them():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array([f"one line that all of them share\nown line {'x' * i}" for i in range(1000)])], names=["doc_id", "text"])
    shared = set(L.template_keys("one line that all of them share"))
    out = list(L._keys(3, 4)(iter([batch])))
    sent = [k for b in out for x in b.column("key").to_pylist() if x for k in L.np.frombuffer(x, L.np.uint64).tolist() if k in shared]
    assert len(sent) == 3 * len(shared)
    assert sum(len(x or ()) for b in out for x in b.column("lines").to_pylist()) >= 1000


def test_variable_fields_are_generalised(spark):
    frame = "Copyright notice for product {} issued to customer {} under licence {} all rights reserved by the owner of this text and {} others"
    own = ["the first has words of its own", "second text says something else entirely", "nothing here stands in any other row"]
    rows = [(i, frame.format(i, f"user{i}@x", i * 7, "many few some".split()[i % 3]) + "\n" + own[i], 0, 0) for i in range(3)]
    rows += [(9, "a plain line that nobody else has written so far", 0, 0)]
    got = {x.doc_id: x.kept_text for x in L.without_recurring_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: own[0], 1: own[1], 2: own[2], 9: rows[3][1]}


@pytest.mark.parametrize("tokens", [4, 5, 15, 16, 40])
def test_similar_templates_are_merged_at_every_length(spark, tokens):
    def line(doc, *changed):
        return " ".join(f"own{'abcde'[doc]}{'klm'[i % 3]}" if i in changed else f"w{'abcdefghij'[i % 10]}{'klmno'[i // 10]}" for i in range(tokens))

    # Three documents differ in one quarter of the line, two others in more; the leading tokens are the same.
    rows = [(d, line(d, tokens - 1), 0, 0) for d in range(3)] + [(d, line(d, *range(2, tokens)), 0, 0) for d in (3, 4)]
    got = {x.doc_id: x.n_dropped for x in L.without_recurring_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0}


def test_long_lines_recur_from_two_documents_on(spark):
    long, short = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(51)), "only eight words stand in this short line"
    rows = [(i, f"{long}\n{short}\nown line {'abc'[i]}", 0, 0) for i in range(2)] + [(2, long.replace("wak", "other", 1).replace("wjn", "other") + " more", 0, 0)]
    got = {x.doc_id: x.kept_text for x in L.without_recurring_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: f"{short}\nown line a", 1: f"{short}\nown line b", 2: rows[2][1]}


def test_empty(spark):
    assert L.without_recurring_lines(spark.createDataFrame([], SCHEMA)).count() == 0

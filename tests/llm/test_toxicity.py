import random

from quayside.llm import toxicity as X

DOCS, LABELS = "doc_id long, text string, toxic int, score int", "doc_id long, quality int, toxic int"


def corpus(n=1200):
    r = random.Random(4)
    plain = ["stone", "river", "cloud", "walk", "green", "paper", "house", "under", "slowly", "bread"]
    docs, labels = [], []
    for i in range(n):
        w = [r.choice(plain) for _ in range(r.choice([8, 40, 300]))]
        toxic = r.random() < 0.15
        if toxic:
            w[r.randrange(len(w))] = r.choice(["blarg", "bl4rg", "blаrg", "snorfing", "snorfed", "snorfly", "Snorf3r"])
        elif r.random() < 0.05:
            w[1:3] = ["blarg", "fish"]
        docs.append((i, " ".join(w), 1, 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_folding_and_exceptions(spark):
    docs, labels = corpus()
    p = X.Params(min_share=0.3, exception_share=0.2)
    rows = X.scored(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), p).collect()
    truth = {i: t for i, _, t in labels}
    out = [r for r in rows if r.held_out]
    assert 200 < len(out) < 400 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in out) / len(out) > 0.97


def test_stems_and_phrases():
    m = X.Matcher(X.Model({"blarg": 2.0}, {"snorf": 1.5}, ("blarg fish",)))
    hits = lambda t: [x for _, _, x, _ in m.hits(X.fold(t))]
    assert hits("BL4RG, snorfing unsnorf snorf blargs") == ["blarg", "snorf"]
    assert hits("blarg fish blarg fishes") == ["blarg"]
    assert X.fold("Ѕtοne 1d10t ｆｕｌｌ​x") == "stone idiot fullx"
    assert X.Matcher(X.Model()).features("anything") == (0.0, 0.0)


def test_edges(spark):
    docs, labels = corpus(300)
    extra = [(None, "blarg", 0, 0), (5000, None, 0, 0), (5001, "", 0, 0), (5002, "blarg " * 50_000, 0, 0), (5002, "x", 0, 0)]
    bad = [(1, None, None), (2, 1, 7), (None, 1, 1), (3, 1, 1), (3, 1, 0)]
    d = spark.createDataFrame(docs + extra, DOCS)
    rows = X.scored(d, spark.createDataFrame(labels + bad, LABELS)).collect()
    assert len(rows) == 305 and all(r.held_out is not None and 0 <= r.score <= 1 for r in rows)
    none = X.scored(d, spark.createDataFrame([], LABELS)).collect()
    assert len({r.score for r in none}) == 1 and not any(r.predicted for r in none)
    assert X.scored(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0
    kept = X.keep_clean(d, spark.createDataFrame(labels, LABELS))
    assert kept.columns == d.columns and kept.count() < 305


def test_training_never_sees_the_held_out_fold(spark):
    docs, labels = corpus(200)
    n = X.training_sample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), X.Params(sample_rows=50)).count()
    import zlib

    seen = X.training_sample(spark.createDataFrame([(i, str(i), 0, 0) for i, *_ in docs], DOCS), spark.createDataFrame(labels, LABELS), X.Params()).collect()
    assert n == 50 and all(zlib.crc32(r.text.encode()) % 4 != 2 for r in seen)


def brute_features(model, text):
    """By trying every entry at every place."""
    import math
    from collections import Counter

    t = X.fold(text)
    word = lambda i: 0 <= i < len(t) and (t[i].isalnum() or t[i] == "_")
    at, void = {}, []
    for s in range(len(t)):
        if word(s - 1):
            continue
        for kind, entries in enumerate((model.words, model.stems, model.exceptions)):
            for x in entries:
                if t.startswith(x, s):
                    e = s + len(x)
                    if kind == 2 and not word(e):
                        void.append((s, e))
                    elif kind == (1 if word(e) else 0):
                        at[s] = max(at.get(s, (0, "", 0.0)), (e, x, entries[x]))
    hits = [(x, w) for s, (e, x, w) in at.items() if not any(a <= s and e <= b for a, b in void)]
    if not hits:
        return 0.0, 0.0
    total = sum(w * (1 + math.log(n)) for (_, w), n in Counter(hits).items())
    return math.log1p(total), total / math.sqrt(10 + t.count(" "))


def test_matching_equals_brute_force():
    r = random.Random(12)
    m = X.Model({"ab": 2.0, "abc": 1.0, "c d": 0.5, "é": 3.0}, {"ab": 1.5, "abcd": 2.5, "d": 0.2}, ("ab c", "abc ab"))
    matcher = X.Matcher(m)
    for _ in range(600):
        text = "".join(r.choice(["a", "b", "c", "d", "A", "4", "é", "а", " ", " ", "_", ".", "​"]) for _ in range(r.randrange(40)))
        got, want = matcher.features(X.fold(text)), brute_features(m, text)
        assert all(abs(a - b) < 1e-12 for a, b in zip(got, want)), text


def test_lexicon_equals_brute_force(spark):
    """Entries, weights and scores of a whole run from counts taken with sets and loops."""
    import math
    import zlib
    from collections import Counter

    docs, labels = corpus(500)
    p = X.Params(min_share=0.3, min_g2=8.0, exception_docs=10**9)
    truth = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    count = {0: Counter(), 1: Counter()}
    for i, text, *_ in docs:
        if i in truth:
            found = set(X.WORD.findall(X.fold(text)))
            count[truth[i]].update({"=" + w for w in found} | {"^" + w[:n] for w in found for n in p.stems if len(w) > n})
    n1, n0 = sum(truth.values()), len(truth) - sum(truth.values())
    share = n1 / (n0 + n1)
    words = {}
    for k in count[1]:
        t, c = count[1][k], count[0][k]
        g2 = 2 * (t * math.log(t / ((t + c) * share)) + (c * math.log(c / ((t + c) * (1 - share))) if c else 0))
        if k[0] == "=" and t >= p.min_toxic_docs and t / (t + c) >= p.min_share and g2 >= p.min_g2:
            words[k[1:]] = math.log((t + 0.5) / (n1 + 1)) - math.log((c + 0.5) / (n0 + 1))
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    model = X.fit(d, lab, p)
    assert words and model.words.keys() == words.keys() and all(abs(model.words[k] - words[k]) < 1e-9 for k in words)
    b0, b1, b2 = model.coef
    text = {i: t for i, t, *_ in docs}
    for r in X.scored(d, lab, p).collect():
        x, y = brute_features(model, text[r.doc_id])
        assert abs(r.score - 1 / (1 + math.exp(-(b0 + b1 * x + b2 * y)))) < 1e-9 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_keep_clean_with_clashing_columns(spark):
    docs, labels = corpus(300)
    d = spark.createDataFrame([(i, t, 1, 2, None, 3.0) for i, t, *_ in docs] + [(None, None, None, None, "n", None)], "doc_id long, text string, toxic int, x int, id_ string, y double")
    kept = X.keep_clean(d, spark.createDataFrame(labels, LABELS))
    assert kept.schema == d.schema and 200 < kept.count() < 301 and kept.filter("id_ = 'n'").count() == 1

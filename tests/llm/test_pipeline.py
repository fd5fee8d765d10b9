import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from test_secrets import brute as secret_spans
from test_simhash import brute_components, brute_fp
from tokenizers import Tokenizer

import corpus_pipeline
from quayside.llm import toxicity

NAMES = ["toxicity", "exact dedup", "SimHash near-dedup", "secret scan", "packing"]


def fixture(spark, path):
    r = random.Random(11)
    vocab = ["stone", "river", "cloud", "walk", "green", "paper", "house"] + [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(400):
        w = [r.choice(vocab) for _ in range(r.choice([5, 60, 200]))]
        if r.random() < 0.2:
            w.insert(0, "blarg")
        docs.append((i, " ".join(w), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int("blarg" in w)))
    for i in range(60):
        t = docs[r.randrange(400)][1].split(" ")
        if i % 2:
            t[r.randrange(len(t))] = "changed"
        docs.append((1000 + i, " ".join(t), "en", "s0", 0))
    docs += [(2000, "mail password: hunter2hunter now", "en", None, 1), (2001, None, None, None, None), (2002, "", None, None, None), (2003, "AKIA" + "Q" * 16 + " and " + "0f" * 20, "de", "s", 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return {d[0]: d[1] for d in docs}


def test_stages_against_brute_force(spark, tmp_path):
    d = str(tmp_path)
    texts = fixture(spark, d)
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept, seen = dict(texts), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        out.write.parquet(f"{d}/{len(seen)}")
        out = spark.read.parquet(f"{d}/{len(seen)}")
        seen.append(name)
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.scored(docs, spark.read.parquet(f"{d}/labels.parquet")).collect() if r.predicted}
            assert bad == {i for i, t in texts.items() if "blarg" in (t or "")}
            kept = {i: t for i, t in kept.items() if i not in bad}
        elif name == "exact dedup":
            last = {t or "": i for i, t in sorted(kept.items())}
            kept = {i: t for i, t in kept.items() if last[t or ""] == i}
        elif name == "SimHash near-dedup":
            ids = sorted(kept)
            groups = brute_components([brute_fp(kept[i]) for i in ids])
            low = {}
            for i, g in zip(ids, groups):
                low.setdefault(g, i)
            kept = {i: t for i, t in kept.items() if i in low.values()}
        elif name == "secret scan":
            for i, t in kept.items():
                new, at = "", 0
                for s, _, e in secret_spans(t):
                    if s >= at:
                        new += t[at:s] + "[secret]"
                    at = max(at, e)
                kept[i] = t if t is None else new + t[at:]
            assert "hunter2" not in kept[2000] and re.search(r"\[secret\] and \[secret\]", kept[2003])
        if name != "packing":
            assert out.columns == docs.columns
            assert {r.doc_id: r.text for r in out.collect()} == kept, name
            docs = out
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in out.collect():
        pieces[r.doc_id].append(r)
    assert pieces.keys() == kept.keys()
    for i, rows in pieces.items():
        ids = np.array([*tok.encode(kept[i] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert corpus_pipeline.run(spark, d).select("doc_id").distinct().count() == len(kept)

"""Toxicity scores from a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import keyed_texts
from quayside.session import cut

# Look-alikes of Latin letters, digits and signs that stand for letters, and invisible characters.
HOMOGLYPHS = dict(zip("аесорхуіјѕԁһӏνοαρτικυ", "aecopxyijsdhlvoaptiku", strict=True))
SUBSTITUTES = dict(zip("0134578@$!|", "oieastbasil", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
FOLD = str.maketrans(HOMOGLYPHS | SUBSTITUTES | dict.fromkeys(INVISIBLE, ""))
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Params:
    """sample_rows bounds the labelled rows that weights are learned from; all other limits say when an entry is trusted."""

    sample_rows: int = 20_000
    stems: tuple[int, ...] = (4, 5, 6)
    min_toxic_docs: int = 4
    min_share: float = 0.7
    min_g2: float = 25.0
    stem_gain: float = 1.5
    max_entries: int = 4_000
    exceptions: tuple[str, ...] = ()
    exception_docs: int = 5
    exception_share: float = 0.2
    threshold: float = 0.3


@dataclass
class Model:
    """words: whole words, stems: beginnings of longer words, exceptions: phrases that void hits inside them; coef: bias, sum, density."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    coef: tuple[float, float, float] = (-4.0, 1.0, 0.0)


def fold(text: str) -> str:
    """Lower case with look-alikes, substituted digits and compatibility forms as plain letters. A run of digits alone stays one word."""
    if not text.isascii() and not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(FOLD)


class Matcher:
    """The automaton over all entries; entries are word-anchored, which is checked at each hit."""

    def __init__(self, model: Model):
        self.model, self.auto = model, ahocorasick.Automaton()
        kinds: dict[str, list[int]] = {}
        for kind, entries in enumerate((model.words, model.stems, model.exceptions)):
            for x in entries:
                kinds.setdefault(x, []).append(kind)
        for x, k in kinds.items():
            self.auto.add_word(x, (x, k))
        if len(self.auto):
            self.auto.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, entry, weight) in a folded text, without those that an exception phrase covers; of entries that begin
        at one place the longest counts."""
        if not len(self.auto):
            return []
        found: dict[int, tuple[int, str, float]] = {}
        void = []
        n = len(text)
        for last, (x, kinds) in self.auto.iter(text):
            start, end = last + 1 - len(x), last + 1
            if start and (text[start - 1].isalnum() or text[start - 1] == "_"):
                continue
            closed = end == n or not (text[end].isalnum() or text[end] == "_")
            for k in kinds:
                if k == 2 and closed:
                    void.append((start, end))
                elif k == (0 if closed else 1) and end > found.get(start, (0,))[0]:
                    found[start] = (end, x, (self.model.words if k == 0 else self.model.stems)[x])
        return [(s, e, x, w) for s, (e, x, w) in sorted(found.items()) if not any(a <= s and e <= b for a, b in void)]

    def features(self, text: str) -> tuple[float, float]:
        """Summed weight (repeats count by their logarithm) and the same by length."""
        hits = self.hits(text)
        if not hits:
            return 0.0, 0.0
        total = sum(w * (1 + math.log(n)) for (_, w), n in Counter((x, w) for _, _, x, w in hits).items())
        return math.log1p(total), total / math.sqrt(10 + text.count(" "))


def _count_entries(stems: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                found = set(WORD.findall(fold(text)))
                entries = {"=" + w for w in found} | {"^" + w[:n] for w in found for n in stems if len(w) > n}
                counts[toxic].update(entries)
        keys = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)], names=["entry", "clean", "toxic"])

    return run


def _context_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document: its two features and the phrases of two words that hold a hit."""
        m = Matcher(model)
        for b in batches:
            one, two, phrases = [], [], []
            for text in b.column("text").to_pylist():
                t = fold(text)
                x, y = m.features(t)
                one.append(x)
                two.append(y)
                near = set()
                for s, e, _, _ in m.hits(t) if x else ():
                    left, right = WORD.findall(t[max(0, s - 40) : s]), WORD.findall(t[s : e + 40])
                    near |= {f"{left[-1]} {right[0]}"} if left and right else set()
                    near |= {f"{right[0]} {right[1]}"} if len(right) > 1 else set()
                phrases.append(sorted(near))
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(one, pa.float64()), pa.array(two, pa.float64()), pa.array(phrases, pa.list_(pa.string()))], names=["toxic", "x", "y", "phrases"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - 0.1 * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), g)
    return tuple(map(float, w))


def training_sample(docs: DataFrame, labels: DataFrame, params: Params) -> DataFrame:
    """(text, toxic) of at most sample_rows labelled documents outside the held-out fold, chosen by a hash of doc_id."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id_"), F.col("toxic").cast("int").alias("toxic"))
        .filter("toxic IN (0, 1) AND id_ IS NOT NULL AND crc32(CAST(id_ AS STRING)) % 4 <> 2")
        .groupBy("id_").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id_"), "id_").limit(params.sample_rows)
    )
    return keyed_texts(docs).join(F.broadcast(known), F.col("doc_id") == F.col("id_")).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """Learns entries, exception phrases and the calibration from the training sample. Without labelled rows the model is empty."""
    sample = cut(training_sample(docs, labels, params))
    total = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    if not n1 or not n0:
        return Model(exceptions=params.exceptions)
    share = n1 / (n0 + n1)
    t, c = F.col("toxic"), F.col("clean")
    part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(F.lit(0.0))
    chosen = (
        sample.mapInArrow(_count_entries(params.stems), "entry string, clean long, toxic long")
        .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter((t >= params.min_toxic_docs) & (t / (t + c) >= params.min_share))
        .withColumn("g2", 2 * (part(t, (t + c) * share) + part(c, (t + c) * (1 - share))))
        .filter(F.col("g2") >= params.min_g2).orderBy(F.desc("g2"), "entry").limit(params.max_entries).collect()
    )
    weight = {r.entry: math.log((r.toxic + 0.5) / (n1 + 1)) - math.log((r.clean + 0.5) / (n0 + 1)) for r in chosen}
    toxic = {r.entry: r.toxic for r in chosen}
    lead: dict[str, int] = {}
    for k, n in toxic.items():
        for size in params.stems if k[0] == "=" else ():
            lead[k[1 : size + 1]] = max(n, lead.get(k[1 : size + 1], 0))
    # A stem earns its place by standing for more than its commonest word.
    stems = {k[1:]: v for k, v in weight.items() if k[0] == "^" and toxic[k] >= params.stem_gain * lead.get(k[1:], 0)}
    model = Model({k[1:]: v for k, v in weight.items() if k[0] == "="}, stems, params.exceptions)
    seen = cut(sample.mapInArrow(_context_batches(model), "toxic int, x double, y double, phrases array<string>"))
    rare = (
        seen.select("toxic", F.explode("phrases").alias("phrase")).groupBy("phrase").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
        .filter((F.col("n") >= params.exception_docs) & (F.col("t") <= params.exception_share * F.col("n")))
        .orderBy(F.desc("n"), "phrase").limit(params.max_entries).collect()
    )
    if rare:
        model.exceptions = (*params.exceptions, *(r.phrase for r in rare))
        seen = sample.mapInArrow(_context_batches(model), "toxic int, x double, y double, phrases array<string>")
    rows = np.array([tuple(r) for r in seen.select("toxic", "x", "y").collect()], dtype=float)
    model.coef = _logistic(np.column_stack([np.ones(len(rows)), rows[:, 1:]]), rows[:, 0])
    return model


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(model)
        b0, b1, b2 = model.coef
        for b in batches:
            z = []
            for text in b.column("text").to_pylist():
                x, y = m.features(fold(text))
                z.append(b0 + b1 * x + b2 * y)
            score = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -40, 40)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs.

    Null and empty texts get the score of a text without hits. A null doc_id is not held out. Labels that are null, not 0
    or 1, or repeated (the largest counts) do no harm; without any the score is that of an empty lexicon. Repeated rows
    are scored each; an empty table gives an empty result; other columns are ignored.
    """
    model = fit(docs, labels, params)
    return (
        keyed_texts(docs).mapInArrow(_score_batches(model), "doc_id long, score double")
        .select(
            "doc_id", F.coalesce(F.expr("crc32(CAST(doc_id AS STRING)) % 4 = 2"), F.lit(False)).alias("held_out"),
            "score", (F.col("score") >= params.threshold).cast("int").alias("predicted"),
        )
    )


def keep_clean(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """The rows of docs, with all columns, whose own text is not predicted toxic."""
    model = fit(docs, labels, params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(model)
        b0, b1, b2 = model.coef
        least = math.log(params.threshold / (1 - params.threshold))
        for b in batches:
            keep = []
            for text in b.column("text").to_pylist():
                x, y = m.features(fold(text or ""))
                keep.append(b0 + b1 * x + b2 * y < least)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

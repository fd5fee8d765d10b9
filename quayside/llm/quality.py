"""Quality rules: exact rule statistics of each text, and an isolation forest over them calibrated on labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import textnum as T
from quayside.llm.tables import keyed_texts
from quayside.session import cut

SYMBOLS = b"#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_punct")
STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


IS_SYMBOL = _table(SYMBOLS)
IS_UPPER = _table(bytes(range(65, 91)))
IS_DIGIT = _table(bytes(range(48, 58)))
IS_PUNCT = _table(b"!\"'(),-./:;?@[\\]^_`{}~+=")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeat_words(w: T.Words, size: int = 3) -> np.ndarray:
    """Per text, the words that lie in a window of size words found twice or more in that text."""
    starts, lens, first = T.shingles(w, size, whole=False)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    key = T.xxh64(w.data, starts, lens) ^ (doc.astype(np.uint64) * MIX)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    word = np.arange(len(key)) - np.repeat(first[:-1], n) + np.repeat(w.first[:-1], n)
    covered = np.zeros(len(w.starts), dtype=bool)
    for i in range(size):
        covered[word[twice] + i] = True
    return _per_text(covered, w.first)


def _lines(text: str) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier one)"""
    lines = [x for x in text.split("\n") if x.strip(SEPARATORS)]
    return len(lines), len(lines) - len(set(lines))


def rule_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    out: dict[str, list[np.ndarray]] = {c: [np.zeros(0, np.int64)] for c in COUNTS}
    for c in T.chunks(texts):
        w = T.words(c, compact=True)
        d, o = c.data, c.offsets
        lines = np.array([_lines(t or "") for t in texts[c.lo : c.hi].to_pylist()], dtype=np.int64)
        found = {
            "n_words": w.counts,
            "word_chars": _per_text(~T.SPACE[d] & ((d & 0xC0) != 0x80), o),
            "n_symbols": _per_text(IS_SYMBOL[d], o),
            "n_dup_lines": lines[:, 1],
            "n_repeat_words": _repeat_words(w),
            "n_lines": lines[:, 0],
            "n_upper": _per_text(IS_UPPER[d], o),
            "n_digits": _per_text(IS_DIGIT[d], o),
            "n_punct": _per_text(IS_PUNCT[d], o),
        }
        for k, v in found.items():
            out[k].append(v)
    return {k: np.concatenate(v) for k, v in out.items()}


def _stat_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = rule_counts(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(found[c]) for c in COUNTS)], names=["doc_id", *COUNTS])


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics that do not grow with the text."""
    words, chars, lines = (np.maximum(c[k], 1).astype(float) for k in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        chars / words, np.sqrt(c["n_symbols"] / words), np.sqrt(c["n_dup_lines"] / lines), c["n_repeat_words"] / words,
        np.sqrt(c["n_upper"] / chars), np.sqrt(c["n_digits"] / chars), np.sqrt(c["n_punct"] / chars),
    ])


def _path_length(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n rows."""
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), cut, left child (right is the next), and a leaf's path length."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    norm: float
    threshold: float = float("inf")

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 to the minus mean path length over its expectation."""
        if not len(self.feature):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        for f, c, left, path in zip(self.feature, self.cut, self.left, self.path, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                k = f[at]
                go = np.flatnonzero(k >= 0)
                if not len(go):
                    break
                a = at[go]
                at[go] = left[a] + (x[go, k[go]] >= c[a])
            total += path[at]
        return np.exp2(-total / len(self.feature) / self.norm)


def separation(x: np.ndarray, good: np.ndarray, least: float) -> np.ndarray:
    """Per column, how well its distance from the median of good rows tells bad rows from good ones: 0 not at all, 1 wholly, squared
    and raised to least. Alike for all columns where rows of either kind are missing."""
    n1, n0 = int((~good).sum()), int(good.sum())
    if not n1 or not n0:
        return np.ones(x.shape[1])
    out = []
    for c in x.T:
        _, inv, n = np.unique(np.abs(c - np.median(c[good])), return_inverse=True, return_counts=True)
        rank = (np.cumsum(n) - (n - 1) / 2)[inv]
        out.append(max(0.0, 2 * (rank[~good].sum() - n1 * (n1 + 1) / 2) / n1 / n0 - 1))
    return np.maximum(out, least) ** 2


def grow(x: np.ndarray, trees: int, rows: int, seed: int, weights: np.ndarray) -> Forest:
    """Random splits of random subsets of x, columns drawn by weight, until rows are alone or the usual depth limit is reached."""
    r = np.random.default_rng(seed)
    rows = min(rows, len(x))
    if rows < 2:
        return Forest(*(np.zeros((0, 0)) for _ in range(4)), 1.0)
    limit, size = int(np.ceil(np.log2(rows))), 4 * rows
    out = [np.full((trees, size), -1, np.int64), np.zeros((trees, size)), np.zeros((trees, size), np.int64), np.zeros((trees, size))]
    for t in range(trees):
        todo, used = [(0, r.choice(len(x), rows, replace=False), 0)], 1
        while todo:
            node, own, depth = todo.pop()
            lo, hi = x[own].min(axis=0), x[own].max(axis=0)
            wide = np.flatnonzero(hi > lo)
            if depth >= limit or len(own) < 2 or not len(wide):
                out[3][t, node] = depth + _path_length(len(own))
                continue
            f = int(r.choice(wide, p=weights[wide] / weights[wide].sum()))
            c = r.uniform(lo[f], hi[f])
            right = x[own, f] >= c
            out[0][t, node], out[1][t, node], out[2][t, node] = f, c, used
            todo += [(used, own[~right], depth + 1), (used + 1, own[right], depth + 1)]
            used += 2
    return Forest(*out, float(_path_length(rows)))


@dataclass(frozen=True)
class Params:
    """sample_rows bounds the labelled rows that trees are grown from; the threshold uses every labelled row.
    good_loss: share of good labelled rows that the threshold may reject; least_weight: of a column that tells nothing apart."""

    trees: int = 100
    tree_rows: int = 64
    sample_rows: int = 8192
    good_loss: float = 0.02
    least_weight: float = 0.05
    bins: int = 2000
    min_words: int = 50
    seed: int = 7


def base_failed(params: Params) -> Column:
    return (F.col("n_words") < params.min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _score_batches(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features({c: b.column(c).to_numpy() for c in COUNTS})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forest.score(x))], names=[*b.schema.names, "anomaly"])

    return run


def cutoff(good: dict[int, int], bad: dict[int, int], bins: int, loss: float) -> float:
    """The lowest score to reject, from histograms of the scores of good and bad rows: the one with the largest share of bad rows
    less share of good rows above it, of those that reject at most loss of the good. Infinite where it gains nothing."""
    n0, n1 = sum(good.values()), sum(bad.values())
    best, at, lost, caught = 0.0, float("inf"), 0, 0
    for b in sorted(good.keys() | bad.keys(), reverse=True) if n0 and n1 else ():
        lost += good.get(b, 0)
        caught += bad.get(b, 0)
        if lost > loss * n0:
            break
        if caught / n1 - lost / n0 > best:
            best, at = caught / n1 - lost / n0, b / bins
    return at


def fit(stats: DataFrame, labels: DataFrame, params: Params = Params()) -> Forest:
    """Trees from a bounded sample of labelled rows, threshold from the score histograms of all good and bad labelled rows."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id_"), F.col("quality").cast("int").alias("quality"))
        .filter("quality IN (0, 1) AND id_ IS NOT NULL").groupBy("id_").agg(F.min("quality").alias("quality"))
    )
    # Rows that the base rules reject anyway say nothing about the rest.
    marked = cut(stats.filter(~base_failed(params)).join(known, F.col("doc_id") == F.col("id_")).drop("id_"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(params.sample_rows).select(*COUNTS, "quality").collect()
    rows = np.array([tuple(r) for r in sample], dtype=np.int64).reshape(-1, len(COUNTS) + 1)
    x = features({c: rows[:, i] for i, c in enumerate(COUNTS)})
    forest = grow(x, params.trees, params.tree_rows, params.seed, separation(x, rows[:, -1] == 1, params.least_weight))
    if not len(forest.feature):
        return forest
    hist: dict[int, dict[int, int]] = {0: {}, 1: {}}
    for r in (
        marked.mapInArrow(_score_batches(forest), f"{STATS}, quality int, anomaly double")
        .groupBy("quality", F.floor(F.col("anomaly") * params.bins).alias("bin")).agg(F.count("*").alias("n")).collect()
    ):
        hist[r.quality][r.bin] = r.n
    forest.threshold = cutoff(hist[1], hist[0], params.bins, params.good_loss)
    return forest


def judged(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, anomaly for each row of docs.

    Null texts count as empty: no words, so base_failed. Without labelled rows of both kinds the forest rejects nothing and
    kept is not base_failed. Labels that are null, not 0 or 1, or repeated (the smallest counts) do no harm. Repeated rows are judged
    each; an empty table gives an empty result; other columns are ignored.
    """
    stats = cut(keyed_texts(docs).mapInArrow(_stat_batches, STATS))
    forest = fit(stats, labels, params)
    return (
        stats.mapInArrow(_score_batches(forest), f"{STATS}, anomaly double").withColumn("base_failed", base_failed(params))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & (F.col("anomaly") < forest.threshold)).alias("kept"), "anomaly",
        )
    )

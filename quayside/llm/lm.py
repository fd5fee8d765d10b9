"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts, beside an exact unigram base.

Exact counts come from one aggregation over all training tokens. The filter holds every training unigram and bigram with
its count on a logarithmic scale: (n-gram, level) is inserted for every level up to 1 + log2(count). It is kept in shards,
whose number grows with the training tokens. A bigram after which an unfrequent word comes lies in that word's shard, any
other in one by its own hash. N-grams that make up at least 1 / HEAD_SHARE of the tokens are at most HEAD_SHARE of each order;
they are broadcast with what their shard says of them. All others of each document are sent to their shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import textnum as T
from quayside.llm.tables import keyed_texts
from quayside.session import cut

#: The end of a text as a token; no word holds this byte. It is also what stands before the first word.
END = np.uint64(xxhash.xxh64_intdigest(b"\n", T.SEED))
ADD = 0.1
HEAD_SHARE = 1 << 22
#: Training tokens for each shard of the filter.
SHARD_TOKENS = 1 << 20
#: The bits of an n-gram's key that name its shard; the others name it in the shard's filter.
TOP = np.uint64((1 << 64) - (1 << 40))
#: Bits of the filter for each insertion; all bits of an insertion lie in one 64-bit cell.
BITS = 10
PROBES = 4
#: Weight of the unigram estimate in a bigram's, in tokens.
PRIOR = 200.0
#: Hashes that a task gathers before it sums them up.
GATHER = 4_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def pair_key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(u * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) ^ w


def place(keys: np.ndarray, level: int | np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, bits) of (n-gram, level)."""
    with np.errstate(over="ignore"):
        h = mix(keys + np.asarray(level, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        bits = np.zeros(len(keys), dtype=np.uint64)
        for i in range(PROBES):
            bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
        return (mix(h) % np.uint64(cells)).astype(np.int64), bits


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (((keys >> np.uint64(40)) * np.uint64(shards)) >> np.uint64(24)).astype(np.int32)


def dealt_key(u: np.ndarray, w: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Key of each bigram (u, w); in the shard of w unless w is frequent."""
    k = pair_key(u, w)
    return np.where(frequent, k, (w & TOP) | (k & ~TOP))


def packed(x: np.ndarray, size: int) -> bytes:
    """The low bytes of whole numbers, all first bytes, then all second bytes and so on."""
    return np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def unpacked(data: np.ndarray, at: int, n: int, size: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = data[at : at + n * size].reshape(size, n).T
    return out.reshape(-1).view(np.uint64)


def runs(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, first, end) of each run of equal shards."""
    edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else np.zeros(1, np.int64)
    return zip(shard[edge[:-1]].tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True)


def in_shard(keys: np.ndarray, shards: int | np.ndarray) -> np.ndarray:
    """Names of bigrams across shards: a bigram is its shard and the low bits of its key."""
    with np.errstate(over="ignore"):
        return mix((keys & ~TOP) | (np.asarray(shards).astype(np.uint64) << np.uint64(40)))


def middle(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for: its middle on the log scale, 0 if absent."""
    return np.where(level > 0, np.exp2(level - 0.5), 0.0)


def level_of(count: np.ndarray, least: int) -> np.ndarray:
    return 1 + np.floor(np.log2(np.maximum(count / least, 1))).astype(np.int64)


@dataclass
class Filter:
    """A blocked Bloom filter over (n-gram, level)."""

    cells: np.ndarray
    least: int

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each n-gram, 0 if absent. Never misses; may overstate."""
        level = np.zeros(len(keys), np.int64)
        live, j = np.arange(len(keys)), 1
        while len(live) and j < 64:
            cell, bits = place(keys[live], j, len(self.cells))
            live = live[(self.cells[cell] & bits) == bits]
            level[live] = j
            j += 1
        return level

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Estimated count of each n-gram."""
        return self.least * middle(self.levels(keys))


def at_of(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted known, whether it is there) of each key."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def looked_up(known: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The value of each key, 0 if it is not in the sorted known."""
    at, there = at_of(known, keys)
    return np.where(there, values[at], 0) if len(known) else np.zeros(len(keys), np.int64)


@dataclass
class Model:
    """What all tasks need for scoring: totals, exact counts of the head words, levels of the head n-grams (both sorted by key)."""

    tokens: int
    types: int
    shards: int
    head: np.ndarray
    head_counts: np.ndarray
    heavy: np.ndarray
    heavy_levels: np.ndarray

    @property
    def total(self) -> float:
        return self.tokens + ADD * (self.types + 1)

    def base(self, exact: np.ndarray) -> np.ndarray:
        return np.log10((exact + ADD) / self.total)

    def p1(self, level: np.ndarray) -> np.ndarray:
        return (middle(level) + ADD) / self.total

    def alone(self, level: np.ndarray) -> np.ndarray:
        """What a token adds to the score whatever its neighbours: PRIOR * p1 as the second of a pair, count + PRIOR as the first."""
        return np.log10(PRIOR * self.p1(level)) - np.log10(middle(level) + PRIOR)

    def paired(self, pair: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the pairs of these levels add: log10 of (c2 + PRIOR * p1) / (PRIOR * p1). u is -1 where it is not known."""
        # A pair cannot be commoner than its words, whatever the filter says.
        c2 = middle(np.minimum(np.minimum(pair, w), np.where(u < 0, pair, u)))
        return np.log10(1 + c2 / (PRIOR * self.p1(w)))


def held_out(ids: list) -> np.ndarray:
    """crc32 of doc_id as text, modulo 10, is 0; a null doc_id is in training."""
    import zlib

    return np.array([i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in ids], dtype=bool)


def tokens(c: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words and ends in order, first token of each text)."""
    w = T.words(c, lower=True)
    first = w.first + np.arange(len(w.first))
    out = np.full(first[-1], END)
    at = np.arange(len(w.starts)) + np.repeat(np.arange(c.n), w.counts)
    out[at] = T.word_hashes(w)
    return out, first


def before(tok: np.ndarray, first: np.ndarray) -> np.ndarray:
    prev = np.empty_like(tok)
    prev[1:] = tok[:-1]
    prev[first[:-1]] = END
    return prev


def _by_shard(k: np.ndarray, n: np.ndarray, shards: int, word: bool) -> pa.RecordBatch:
    """A row (shard, word, size, data) for each shard of the sorted n-grams; data holds keys and counts, packed."""
    got = [(s, hi - lo, packed(k[lo:hi], 8 if word else 5) + packed(n[lo:hi], 8)) for s, lo, hi in runs(shard_of(k, shards))]
    columns = list(zip(*got, strict=True)) or [[]] * 3
    kinds = (pa.int32(), pa.int32(), pa.binary())
    a, b, c = (pa.array(list(x), t) for x, t in zip(columns, kinds, strict=True))
    return pa.RecordBatch.from_arrays([a, pa.array([word] * len(a), pa.bool_()), b, c], names=["shard", "word", "size", "data"])


def _words_by_shard(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches, pa.schema([("key", pa.int64()), ("n", pa.int64())]))
        key, n = t["key"].to_numpy().view(np.uint64), t["n"].to_numpy()
        order = np.argsort(key)
        yield _by_shard(key[order], n[order], shards, True)

    return run


def _counted(keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray], shards: int = 0):
    """Batches of (key, n), or by shard: training n-grams, summed up in each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0

        def out() -> pa.RecordBatch:
            k, n = np.unique(np.concatenate(gathered), return_counts=True)
            if shards:
                return _by_shard(k, n, shards, False)
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["key", "n"])

        for b in batches:
            rows = b.filter(pa.array(~held_out(b.column("doc_id").to_pylist())))
            for c in T.chunks(rows.column("text")) if rows.num_rows else ():
                k = keys_of(*tokens(c))
                gathered.append(k)
                size += len(k)
                if size > GATHER:
                    yield out()
                    gathered, size = [], 0
        if gathered:
            yield out()

    return run


def inserted(keys: np.ndarray, top: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, bits) of all (n-gram, level) up to each n-gram's top level, each cell once."""
    k = np.repeat(keys, top)
    j = np.arange(len(k)) - np.repeat(np.cumsum(top) - top, top) + 1
    cell, bits = place(k, j, cells)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    head = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    return cell[head], np.bitwise_or.reduceat(bits[order], head) if len(head) else np.zeros(0, np.uint64)


def _cells(least: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, bits = inserted(b.column(0).to_numpy().view(np.uint64), level_of(b.column(1).to_numpy(), least), cells)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bits.view(np.int64))], names=["cell", "bits"])

    return run


def build_filter(counts: DataFrame, training_tokens: int, max_insertions: int, least: int = 1) -> Filter:
    """One filter of all (key, n) with n of least or more; least grows so that insertions stay below max_insertions. Scoring uses shards instead."""
    least = max(least, -(-training_tokens // max_insertions))
    kept = counts.filter(F.col("n") >= least)
    size = kept.agg(F.sum(1 + F.floor(F.log2(F.col("n") / least)))).first()[0] or 0
    cells = max(64, -(-int(size) * BITS // 64))
    found = kept.mapInArrow(_cells(least, cells), "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(cells, dtype=np.uint64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Filter(out, least)


def _sorted_counts(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    got = counts.filter(F.col("n") >= least).toArrow()
    key, n = got["key"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(key)
    return key[order], n[order]


GRAMS = "shard int, word boolean, size int, data binary"
SHARD = "shard int, cells array<long>, words array<long>, n array<long>, heavy array<long>, levels array<long>"
DOC = "doc struct<doc_id:long,held_out:boolean,n_tokens:long,known:long,base:double,score:double>"
PART = f"chunk long, size int, tail int, data binary, {DOC}"
PROBE = f"shard int, {PART}"
SUMS = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double"


def _shard(head_least: int):
    """A shard's filter, the exact counts of its words outside the head, and the levels of its n-grams in the head."""

    def run(shard: tuple, t: pa.Table) -> pa.Table:
        found = {True: [], False: []}
        for word, size, data in zip(*(t[c].to_pylist() for c in ("word", "size", "data")), strict=True):
            d, wide = np.frombuffer(data, np.uint8), 8 if word else 5
            found[word].append((unpacked(d, 0, size, wide), unpacked(d, wide * size, size, 8).astype(np.int64)))
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        (words, n), (pairs, m) = (tuple(map(np.concatenate, zip(none, *found[w], strict=True))) for w in (True, False))
        order = np.argsort(words)
        words, n = words[order], n[order]
        pairs, inv = np.unique(pairs, return_inverse=True)
        m = np.bincount(inv, m, len(pairs)).astype(np.int64)
        keys, total = np.r_[words & ~TOP, pairs], np.r_[n, m]
        top = level_of(total, 1)
        f = Filter(np.zeros(max(64, -(-int(top.sum()) * BITS // 64)), np.uint64), 1)
        cell, bits = inserted(keys, top, len(f.cells))
        f.cells[cell] = bits
        tail, often = n < head_least, m >= head_least
        heavy = np.r_[words[~tail], in_shard(pairs[often], shard[0].as_py())]
        levels = f.levels(np.r_[words[~tail] & ~TOP, pairs[often]])
        parts = (f.cells.view(np.int64), words[tail].view(np.int64), n[tail], heavy.view(np.int64), levels)
        return pa.table([pa.array([shard[0].as_py()], pa.int32()), *(pa.array([x], pa.list_(pa.int64())) for x in parts)], names=["shard", "cells", "words", "n", "heavy", "levels"])

    return run


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the shards of its filter over all training tokens, of keyed texts."""
    spark = docs.sparkSession
    counts = cut(docs.mapInArrow(_counted(lambda tok, first: tok), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))
    n, v = (int(x or 0) for x in counts.agg(F.sum("n"), F.count("*")).first())
    least, shards = max(1, -(-n // HEAD_SHARE)), max(1, -(-n // SHARD_TOKENS))
    head, head_counts = _sorted_counts(counts, least)
    shared = spark.sparkContext.broadcast(head)

    def pairs(tok: np.ndarray, first: np.ndarray) -> np.ndarray:
        return dealt_key(before(tok, first), tok, at_of(shared.value, tok)[1])

    every = docs.mapInArrow(_counted(pairs, shards), GRAMS).unionAll(counts.mapInArrow(_words_by_shard(shards), GRAMS))
    built = cut(every.groupBy("shard").applyInArrow(_shard(least), SHARD))
    got = built.select("heavy", "levels").toArrow()
    heavy, levels = (got[c].combine_chunks().flatten().to_numpy() for c in ("heavy", "levels"))
    order = np.argsort(heavy.view(np.uint64))
    return Model(n, v, shards, head, head_counts, heavy.view(np.uint64)[order], levels[order].astype(np.int8)), built


def _score_batches(shared):
    """A row with doc for each text, with its place in its chunk as size and what the head says of it, and for each shard a row
    with those tokens of the chunk that it must settle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, chunk = shared.value, TaskContext.get().partitionId() << 36
        names = ["shard", "chunk", "size", "tail", "data", "doc"]
        for b in batches:
            for c in T.chunks(b.column("text")):
                tok, first = tokens(c)
                uniq, inv = np.unique(tok, return_inverse=True)
                exact, level = looked_up(m.head, m.head_counts, uniq)[inv], looked_up(m.heavy, m.heavy_levels, uniq)[inv].astype(np.int64)
                known = exact > 0
                level[~known] = -1
                u = np.empty_like(level)
                u[1:] = level[:-1]
                u[first[:-1]] = level[first[1:] - 1]
                key = dealt_key(before(tok, first), tok, known)
                shard = shard_of(key, m.shards)
                pair = looked_up(m.heavy, m.heavy_levels, in_shard(key, shard)).astype(np.int64)
                base = np.where(known, m.base(exact), 0.0)
                score = np.where(known, m.alone(level) + m.paired(pair, u, level), 0.0)
                ids = b.column("doc_id")[c.lo : c.hi]
                sums = [np.add.reduceat(x, first[:-1]) for x in (known.astype(np.int64), base, score)]
                doc = pa.StructArray.from_arrays(
                    [ids, pa.array(held_out(ids.to_pylist())), pa.array(np.diff(first)), *map(pa.array, sums)],
                    names=["doc_id", "held_out", "n_tokens", "known", "base", "score"],
                )
                at = np.arange(c.n)
                columns = (((chunk + at) % m.shards).astype(np.int32), np.full(c.n, chunk), at.astype(np.int32), np.zeros(c.n, np.int32))
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(c.n, pa.binary()), doc], names=names)
                left = np.flatnonzero(~known | (pair == 0))
                # By shard, words outside the head first.
                left = left[np.argsort(shard[left].astype(np.int64) * 2 + known[left], kind="stable")]
                of = np.repeat(at, np.diff(first))[left]
                got = []
                for s, lo, hi in runs(shard[left]):
                    x = left[lo:hi]
                    tails = int((~known[x]).sum())
                    data = packed(of[lo:hi], 4) + packed(level[x] + 1, 1) + packed(u[x] + 1, 1) + packed(key[x], 5) + packed(tok[x[:tails]], 8)
                    got.append((s, chunk, hi - lo, tails, data))
                yield _part_rows(got, ("shard", "chunk", "size", "tail", "data"), doc.type)
                chunk += 1

    return run


def _part_rows(got: list[tuple], names: tuple[str, ...], doc: pa.DataType) -> pa.RecordBatch:
    """Rows without doc."""
    kinds = {"shard": pa.int32(), "chunk": pa.int64(), "size": pa.int32(), "tail": pa.int32(), "data": pa.binary()}
    columns = list(zip(*got, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([*(pa.array(list(x), kinds[k]) for x, k in zip(columns, names, strict=True)), pa.nulls(len(got), doc)], names=[*names, "doc"])


def _fields(data: bytes, kinds: tuple[tuple[int, int], ...]) -> list[np.ndarray]:
    """What packed() made of several (number, bytes each), one behind the other."""
    d, at, out = np.frombuffer(data, np.uint8), 0, []
    for n, wide in kinds:
        out.append(unpacked(d, at, n, wide))
        at += n * wide
    return out


def _settle(shared):
    """What a shard adds to the texts of each chunk, a row for each chunk: of all texts that probe it their places and scores, then
    of those with words outside the head their places, known tokens and base scores. Rows with doc pass."""

    def run(probes: pa.Table, shard: pa.Table) -> pa.Table:
        m, names = shared.value, ["chunk", "size", "tail", "data", "doc"]
        if shard.num_rows:
            cells, words, n = (shard[c].combine_chunks().flatten().to_numpy() for c in ("cells", "words", "n"))
        else:
            cells, words, n = np.zeros(64, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        f = Filter(cells.view(np.uint64), 1)
        is_doc = probes["doc"].is_valid()
        docs, sent = probes.filter(is_doc).select(names), probes.filter(pa.compute.invert(is_doc))
        chunks = sent["chunk"].to_pylist()
        parts = []
        for i, (size, tails, data) in enumerate(zip(*(sent[c].to_pylist() for c in ("size", "tail", "data")), strict=True)):
            of, w, u, key, word = _fields(data, ((size, 4), (size, 1), (size, 1), (size, 5), (tails, 8)))
            parts.append((of.astype(np.int64) + (i << 32), w.astype(np.int64) - 1, u.astype(np.int64) - 1, key, word))
        none = (*[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 2)
        row, w, u, key, word = map(np.concatenate, zip(none, *parts, strict=True))
        tail = np.flatnonzero(w < 0)
        exact = looked_up(words.view(np.uint64), n, word)
        w[tail] = f.levels(word & ~TOP)
        score = m.paired(f.levels(key), u, w)
        score[tail] += m.alone(w[tail])
        rows, inv = np.unique(row, return_inverse=True)
        score = np.bincount(inv, score, len(rows)).astype(float)
        tail_rows, inv = np.unique(row[tail], return_inverse=True)
        known, base = (np.bincount(inv, x, len(tail_rows)).astype(float) for x in (exact > 0, m.base(exact)))
        edge = np.searchsorted(tail_rows, np.arange(len(chunks) + 1) << 32)
        got = []
        for i, lo, hi in runs(rows >> 32):
            a, b = edge[i], edge[i + 1]
            data = packed(rows[lo:hi], 4) + packed(score[lo:hi].view(np.uint64), 8)
            data += packed(tail_rows[a:b], 4) + packed(known[a:b], 4) + packed(base[a:b].view(np.uint64), 8)
            got.append((chunks[i], hi - lo, int(b - a), data))
        return pa.concat_tables([docs, pa.Table.from_batches([_part_rows(got, tuple(names[:-1]), probes.schema.field("doc").type)])])

    return run


def _summed(t: pa.Table) -> pa.Table:
    """A row for each text of a chunk: what the head says of it and what all shards add."""
    is_doc = t["doc"].is_valid()
    docs = t.filter(is_doc).sort_by("size")["doc"].combine_chunks()
    ids, held, tokens_, *sums = docs.flatten()
    known, base, score = (x.to_numpy(zero_copy_only=False).copy() for x in sums)
    sent = t.filter(pa.compute.invert(is_doc))
    for size, tails, data in zip(*(sent[c].to_pylist() for c in ("size", "tail", "data")), strict=True):
        # A text has one place in a row of a shard.
        of, x, tail, k, b = _fields(data, ((size, 4), (size, 8), (tails, 4), (tails, 4), (tails, 8)))
        score[of.astype(np.int64)] += x.view(np.float64)
        known[tail.astype(np.int64)] += k.astype(np.int64)
        base[tail.astype(np.int64)] += b.view(np.float64)
    return pa.table([ids, held, tokens_, *map(pa.array, (known, base, score))], names=["doc_id", "held_out", "n_tokens", "known", "base", "score"])


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    Null and empty texts are one end token. A null doc_id is in training. Repeated rows are counted and scored each. Where no
    row is in training (an empty table, or all held out) counts are zero and the scores of a token are log10(0.1 / 0.1).
    Other columns are ignored.
    """
    own = keyed_texts(docs)
    model, shards = train(own)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    probes = own.mapInArrow(_score_batches(shared), PROBE)
    parts = probes.groupBy("shard").cogroup(shards.select("shard", "cells", "words", "n").groupBy("shard")).applyInArrow(_settle(shared), PART)
    return parts.groupBy("chunk").applyInArrow(_summed, SUMS).select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score"
    )

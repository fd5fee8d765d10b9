"""SimHash fingerprints and exact near-duplicate linking by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import textnum as T
from quayside.llm.components import components
from quayside.llm.tables import keyed_texts
from quayside.session import cut

LANES = np.uint64(0x0101010101010101)


def majority_bits(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the fingerprint whose bit i is 1 if bit i is set in over half of its hashes h[first[d]:first[d+1]]; 0 without any.

    Eight byte-wide counters are summed at once, over at most 255 hashes before they are widened.
    """
    n = np.diff(first)
    out = np.zeros(len(n), dtype=np.uint64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    parts = -(-n[some] // 255)
    base = np.zeros(len(some) + 1, dtype=np.int64)
    np.cumsum(parts, out=base[1:])
    seg = np.repeat(first[:-1][some], parts) + 255 * (np.arange(base[-1]) - np.repeat(base[:-1], parts))
    counts = np.empty((len(seg), 64), dtype=np.int64)
    for j in range(8):
        lanes = np.add.reduceat((h >> np.uint64(j)) & LANES, seg)
        counts[:, j::8] = lanes.view(np.uint8).reshape(-1, 8)
    counts = np.add.reduceat(counts, base[:-1], axis=0)
    bits = 2 * counts > n[some, None]
    out[some] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(texts: pa.Array, shingle_words: int = 3, seed: int = T.SEED) -> np.ndarray:
    """64-bit SimHash of each text: A-Z lower-cased, word shingles with repeats, XXH64 votes."""
    out = [np.zeros(0, dtype=np.uint64)]
    for c in T.chunks(texts):
        w = T.words(c, lower=True, compact=True)
        starts, lens, first = T.shingles(w, shingle_words)
        out.append(majority_bits(T.xxh64(w.data, starts, lens, seed), first))
    return np.concatenate(out)


# ---- linking ------------------------------------------------------------------------------------------------------
#
# Two fingerprints at 3 or fewer differing bits: of three blocks of about 21 bits at least one holds a differing bit or
# none differs, so with that block left out at most 2 bits differ and the two balls of radius 1 (half the radius of what
# is left) meet. Every distinct fingerprint therefore emits, for each block left out, the 43 or 44 variants of the other
# bits within radius 1: 131 keys of 42 to 43 bits, where whole 64-bit balls of radius 2 would be 2,081. Fingerprints that
# share a key are candidates and are verified on all bits.

BITS, RADIUS = 64, 3
BLOCKS = ((0, 21), (21, 42), (42, 64))
#: Up to so many members every pair of a key is compared; beyond, members are linked by sub-keys in linear time.
SMALL_RUN = 32


def _packed(fp: np.ndarray, block: int) -> np.ndarray:
    """The bits of fp outside the block, moved together."""
    lo, hi = BLOCKS[block]
    low = fp & np.uint64((1 << lo) - 1)
    return low if hi == 64 else low | ((fp >> np.uint64(hi)) << np.uint64(lo))


def _inner(fp: np.ndarray, block: int) -> np.ndarray:
    lo, hi = BLOCKS[block]
    return (fp >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)


def _star(keys: np.ndarray, fp: np.ndarray) -> list[np.ndarray]:
    """Links each fingerprint to the first that has the same key."""
    order = np.argsort(keys, kind="stable")
    k, f = keys[order], fp[order]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    lead = np.repeat(f[head], np.diff(np.r_[head, len(k)]))
    differs = lead != f
    return [lead[differs], f[differs]]


def link_run(fp: np.ndarray, key: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct fingerprints of one key, in time linear in their number; connects all that are within RADIUS.

    All members are within 1 of the key outside the block, so any two differ there in 2 bits at most: those that agree
    inside the block but for one bit are linked without a comparison. A pair that differs in 2 bits inside and 1 outside
    has the same key with another block left out. There remain pairs that agree outside and differ in 3 bits inside:
    for members whose outside is the key itself, radius-1 variants of the inside meet radius-2 variants.
    """
    lo, hi = BLOCKS[block]
    inner = _inner(fp, block)
    out = [_star(inner & ~np.uint64(1 << i), fp) for i in range(hi - lo)]
    same = fp[_packed(fp, block) == np.uint64(key)]
    if len(same) > 1:
        x = _inner(same, block)
        one = [np.uint64(1 << i) for i in range(hi - lo)]
        near = np.concatenate([x ^ m for m in one])
        owner = np.tile(same, len(one))
        order = np.argsort(near, kind="stable")
        near, owner = near[order], owner[order]
        out.append(_star(near, owner))
        for i in range(hi - lo):
            for j in range(i):
                at = np.searchsorted(near, two := x ^ one[i] ^ one[j])
                hit = (at < len(near)) & (near[np.minimum(at, len(near) - 1)] == two)
                out.append([owner[at[hit]], same[hit]])
    a, b = (np.concatenate(x) for x in zip(*out, strict=True))
    return a, b


def link_sorted(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal key; fp is distinct in a run."""
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[head, len(key)])
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    some = (size > 1) & (size <= SMALL_RUN)
    rows = np.arange(len(key))
    end = np.repeat(head + size, size)
    live = rows[np.repeat(some, size)]
    for k in range(1, int(size[some].max(initial=1))):
        live = live[live + k < end[live]]
        x = fp[live] ^ fp[live + k]
        close = np.bitwise_count(x) <= RADIUS
        a.append(fp[live[close]])
        b.append(fp[live[close] + k])
    for r in np.flatnonzero(size > SMALL_RUN):
        x, y = link_run(fp[head[r] : head[r] + size[r]], int(key[head[r]] & ((1 << 60) - 1)), int(key[head[r]] >> 60))
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by key; the last run of a batch waits for the next batch."""
    key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    names = ["a", "b"]

    def out(k, f):
        x, y = link_sorted(k, f)
        x, y = np.minimum(x, y), np.maximum(x, y)
        pair = np.unique(np.stack([x, y], axis=1), axis=0) if len(x) else np.zeros((0, 2), np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(pair[:, i].astype(np.int64)) for i in (0, 1)], names=names)

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        k = batch.column(0).to_numpy()
        waiting.append((k, batch.column(1).to_numpy().view(np.uint64)))
        rows += len(k)
        if rows < 200_000:
            continue
        key, fp = (np.concatenate(x) for x in zip(*waiting, strict=True))
        last = int(np.searchsorted(key, key[-1]))
        if last:
            yield out(key[:last], fp[:last])
        waiting, rows = [(key[last:], fp[last:])], len(key) - last
    if rows:
        yield out(*(np.concatenate(x) for x in zip(*waiting, strict=True)))


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): every variant of each fingerprint, with the number of the block left out in the key's top bits."""
    flips = []
    for block, (lo, hi) in enumerate(BLOCKS):
        width = BITS - (hi - lo)
        flips += [f"named_struct('b', {block}, 'x', {(block << 60) | f}L)" for f in [0, *(1 << i for i in range(width))]]
    packed = [f"shiftrightunsigned(fp, {BLOCKS[0][1]})"]
    packed.append(f"(fp & {(1 << BLOCKS[1][0]) - 1}L) | shiftleft(shiftrightunsigned(fp, {BLOCKS[1][1]}), {BLOCKS[1][0]})")
    packed.append(f"fp & {(1 << BLOCKS[2][0]) - 1}L")
    return (
        fps.selectExpr("fp", *(f"{p} AS p{i}" for i, p in enumerate(packed)))
        .selectExpr("fp", "p0", "p1", "p2", f"explode(array({', '.join(flips)})) AS v")
        .selectExpr("(CASE v.b WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END) ^ v.x AS key", "fp")
    )


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprints(b.column(1)).view(np.int64))], names=["doc_id", "fp"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (doc_id, text, ...).

    Null and empty texts, and texts of separators only, have fingerprint zero and are linked like any other; texts of one
    or two words have one shingle; repeated rows and repeated doc_ids give one row each, in one component; a null doc_id is
    kept as a row and never names a component unless it is alone in it; an empty table gives an empty result; columns
    other than doc_id and text are ignored, whatever their names.
    """
    prints = cut(keyed_texts(docs).mapInArrow(_fingerprint_batches, "doc_id long, fp long"))
    fps = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    keys = variants(fps)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = cut(keys.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_link_batches, "a long, b long").distinct())
    ids = fps.filter("first_id IS NOT NULL")
    edges = (
        links.join(ids.selectExpr("fp AS a", "first_id AS ia"), "a")
        .join(ids.selectExpr("fp AS b", "first_id AS ib"), "b")
        .select("ia", "ib")
    )
    groups = components(edges, "ia", "ib")
    named = fps.join(groups, F.col("first_id") == F.col("node"), "left").select(F.col("fp").alias("fp_"), F.coalesce("component", "first_id").alias("component_id"))
    return prints.join(named, F.col("fp") == F.col("fp_")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its near-duplicate component (rows without doc_id stay); all columns."""
    firsts = near_duplicates(docs).filter("doc_id = component_id OR doc_id IS NULL").select(F.col("doc_id").alias("keep_")).distinct()
    return docs.join(firsts, F.col("doc_id").eqNullSafe(F.col("keep_")), "left_semi")

"""Removal of long strings that recur anywhere in the corpus, by a difference cover and blockwise suffix buckets.

A perfect difference cover D modulo v has, for any two positions, exactly one shift below v that takes both into D. If equal
strings of `length` units start at i and j, some cover samples i + s and j + s therefore agree on what is left of the strings,
length - v + 1 units or more. The names of the samples are computed first, for 6 % of all positions of bytes. Only starts in front
of a sample whose name recurs can recur themselves. Those suffixes are then dealt into buckets by the name of their first
`length` units, one block of buckets after the other, so that memory and disk hold one block; a bucket is sorted at a time, and
equal neighbours at different places recur.

Where the usual construction orders suffixes and settles long ties by the ranks of their samples, names do it here: a name is a
polynomial hash of 64 bits with a check of 32 bits more from another polynomial. Only equality is asked for, and a rank that tells
of equal strings at every depth would have to travel with each suffix 18 times, once for each sample in reach.

Units are bytes for what is removed. Passages of words are found in the same passes, with words as units.

Rows travel packed: a task gathers samples or starts, sorts them, and sends one parcel to each bucket. Of places with one name in
a parcel one stands for all, and the others are sent on as found, so that a string that very many texts share makes no long bucket.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import textnum as T
from quayside.llm.lm import mix
from quayside.llm.tables import keyed_texts
from quayside.session import cut

LENGTH = 400
#: Words of a passage that counts if it stands in another text too.
WORDS = 51
BLOCKS = 6
#: Texts to look at are sent to all tasks as a list of keys up to so many, and joined by a shuffle beyond.
LISTED = 2_000_000
CHUNK = 1 << 20
#: Places that a task gathers before it sends them.
GATHER = 2_000_000
#: Bytes of texts for each bucket, and texts for each parcel of what was found.
BUCKET_BYTES = 16 << 20
TEXTS = 4096


@lru_cache
def difference_cover(length: int) -> tuple[int, np.ndarray]:
    """(v, D): a perfect difference set from a line of the projective plane of the largest prime order whose period
    v = p * p + p + 1 is at most 4/5 of length; (1, {0}) for very short strings."""
    p = max((p for p in range(2, length) if p * p + p + 1 <= 4 * length // 5 and all(p % q for q in range(2, p))), default=0)
    if not p:
        return 1, np.zeros(1, np.int64)
    v = p * p + p + 1
    for code in range(p**3):
        a, b, c = code % p, code // p % p, code // p**2
        x, found = (1, 0, 0), []
        for i in range(v):
            if not x[2]:
                found.append(i)
            # times x, with x^3 = a x^2 + b x + c
            x = (x[2] * c % p, (x[0] + x[2] * b) % p, (x[1] + x[2] * a) % p)
        if len(found) == p + 1 and len({(i - j) % v for i in found for j in found}) == v:
            return v, np.array(found)
    raise AssertionError(f"no cover for {length}")


class Rolling:
    """Names of all windows of a sequence from prefix sums; both polynomials are over 64-bit integers."""

    def __init__(self):
        r = np.random.default_rng(20240601)
        #: Values of bytes; words have their hash.
        self.values = [r.integers(1, 2**63, 256).astype(np.uint64) for _ in range(2)]
        self.bases = [int(r.integers(2**40, 2**62)) * 4 + 1 + 2 * k for k in range(2)]
        self.bases = [b | 1 for b in self.bases]
        self.size = 0

    def _grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, CHUNK + 64)
            self.up, self.down = [], []
            for b in self.bases:
                for to, step in ((self.up, b % 2**64), (self.down, pow(b, -1, 2**64))):
                    x = np.full(self.size, step, np.uint64)
                    x[0] = 1
                    to.append(np.multiply.accumulate(x))

    def load(self, units: tuple[np.ndarray, np.ndarray]) -> None:
        """Values of the units in both polynomials."""
        n = len(units[0])
        self._grow(n + 1)
        self.sums = []
        for values, up in zip(units, self.up, strict=True):
            s = np.zeros(n + 1, np.uint64)
            np.cumsum(values * up[:n], out=s[1:])
            self.sums.append(s)

    def at(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(64-bit name, 32-bit check) of the windows of length units at starts."""
        a, b = ((s[starts + length] - s[starts]) * down[starts] for s, down in zip(self.sums, self.down, strict=True))
        return mix(a), (mix(b) >> np.uint64(32)).astype(np.uint32)


#: A place: the 64-bit name of its string, the check, the key of its text, and the position; -1 - position for words.
PLACE = (("key", np.uint64), ("check", np.uint32), ("d", np.int64), ("pos", np.int32))
Places = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def packed(x: tuple[np.ndarray, ...], lo: int, hi: int) -> bytes:
    return b"".join(c[lo:hi].tobytes() for c in x)


def unpacked(parcels: list[bytes], kinds: tuple[type, ...]) -> tuple[np.ndarray, ...]:
    wide = sum(np.dtype(k).itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[np.zeros(0, k)] for k in kinds]
    for p in parcels:
        n, at = len(p) // wide, 0
        for to, k in zip(parts, kinds, strict=True):
            to.append(np.frombuffer(p, k, n, at))
            at += n * np.dtype(k).itemsize
    return tuple(map(np.concatenate, parts))


def encoded(pos: np.ndarray) -> bytes:
    """Sorted positions: their number, the first, and a byte for each distance to the next; from 255 on the distance stands behind."""
    gap = np.diff(pos.astype(np.int64))
    far = gap >= 255
    return np.array([len(pos), *pos[:1]], np.int32).tobytes() + np.where(far, 255, gap).astype(np.uint8).tobytes() + gap[far].astype(np.uint32).tobytes()


def decoded(data: bytes) -> np.ndarray:
    n, *first = np.frombuffer(data, np.int32, 2 if len(data) > 4 else 1).tolist()
    if not n:
        return np.zeros(0, np.int64)
    gap = np.frombuffer(data, np.uint8, n - 1, 8).astype(np.int64)
    gap[gap == 255] = np.frombuffer(data, np.uint32, -1, 8 + n - 1)
    return np.cumsum(np.r_[first[0], gap])


def runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of each run of equal values."""
    edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True]) if len(x) else np.zeros(1, np.int64)
    return zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)


def recur(x: Places) -> tuple[Places, np.ndarray, np.ndarray]:
    """Places sorted by string; whether each one's string recurs, for words in another text; whether it is the first of its string."""
    key, check, d, pos = x
    order = np.argsort(key, kind="stable")
    k = key[order]
    tied = np.flatnonzero(k[1:] == k[:-1])
    if len(tied):
        # Only places with equal names need be put in order of the rest.
        some = np.zeros(len(k), bool)
        some[tied] = some[tied + 1] = True
        at = np.flatnonzero(some)
        own = order[at]
        order[at] = own[np.lexsort((pos[own], d[own], check[own], key[own]))]
    key, check, d, pos = (c[order] for c in x)
    same = (key[1:] == key[:-1]) & (check[1:] == check[:-1])
    first = np.r_[True, ~same] if len(key) else np.zeros(0, bool)
    number = np.cumsum(first) - 1
    # A string recurs if two places of it differ: in text, or for bytes in position.
    differ = same & ((d[1:] != d[:-1]) | ((pos[1:] >= 0) & (pos[1:] != pos[:-1])))
    many = np.zeros(len(key), bool)
    many[number[1:][differ]] = True
    return (key, check, d, pos), many[number], first


PARCEL = "bucket int, found boolean, data binary"
FOUND = "parcel int, data binary"


def _parcels(x: Places, buckets: int) -> pa.RecordBatch:
    x, again, first = recur(x)
    key, _, d, pos = x
    # Texts of words are told apart only where they are, so all of one text go on if no other text has the string here.
    sent = first | (~again & (np.r_[False, (d[1:] != d[:-1]) | (pos[1:] != pos[:-1])] if len(d) else first))
    out: list[tuple[int, bool, bytes]] = []
    send = tuple(c[sent] for c in x)
    bucket = ((send[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    out += [(int(bucket[lo]), False, packed(send, lo, hi)) for lo, hi in runs(bucket)]
    # What is found needs no bucket of its string: it goes to any.
    known = (d[again], pos[again])
    out += [(int(mix(key[:1] + np.uint64(1))[0] % np.uint64(buckets)), True, packed(known, 0, len(known[0])))] if len(known[0]) else []
    columns = list(zip(*out, strict=True)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.bool_(), pa.binary()), strict=True)], names=["bucket", "found", "data"])


def _sent(places: Iterator[Places], buckets: int) -> Iterator[pa.RecordBatch]:
    waiting, size = [], 0
    for x in places:
        waiting.append(x)
        size += len(x[0])
        if size > GATHER:
            yield _parcels(tuple(map(np.concatenate, zip(*waiting, strict=True))), buckets)
            waiting, size = [], 0
    if waiting:
        yield _parcels(tuple(map(np.concatenate, zip(*waiting, strict=True))), buckets)


def _named(roll: Rolling, keys: np.ndarray, offsets: np.ndarray, parts: list[np.ndarray], length: int, words: bool) -> Places:
    """Places of the windows at positions `parts` of each text."""
    n = [len(p) for p in parts]
    pos = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    key, check = roll.at(pos + np.repeat(offsets, n), length)
    if words:
        key = mix(key ^ np.uint64(0x5BF03635D1A2B3C7))
    return key, check, np.repeat(keys, n), (-1 - pos if words else pos).astype(np.int32)


def _units(c: T.Chunk, roll: Rolling, words: bool) -> np.ndarray:
    """Loads the units of a chunk; returns where each text begins among them, and the end."""
    if not words:
        data = c.data[:-8]
        roll.load((roll.values[0][data], roll.values[1][data]))
        return c.offsets
    w = T.words(c)
    h = T.word_hashes(w)
    roll.load((h, mix(h ^ np.uint64(0x9E3779B97F4A7C15))))
    return w.first


def _sample_places(batches: Iterator[pa.RecordBatch], lengths: tuple[int, int]) -> Iterator[Places]:
    roll = Rolling()
    grids = [np.zeros(0, np.int64)] * 2
    for b in batches:
        keys = b.column("d").to_numpy()
        for c in T.chunks(b.column("text"), CHUNK):
            own = keys[c.lo : c.hi]
            # A copy in the same chunk is the same text.
            once = np.zeros(c.n, bool)
            once[np.unique(own, return_index=True)[1]] = True
            for words, length in enumerate(lengths):
                v, cover = difference_cover(length)
                first = _units(c, roll, bool(words))
                sizes = np.diff(first)
                if not len(grids[words]) or grids[words][-1] < sizes.max():
                    grids[words] = (np.arange(0, int(sizes.max()) + v, v)[:, None] + cover).ravel()
                todo = np.flatnonzero(once & (sizes >= length))
                parts = [grids[words][: np.searchsorted(grids[words], sizes[i] - (length - v + 1), "right")] for i in todo]
                yield _named(roll, own[todo], first[todo], parts, length - v + 1, bool(words))


def _starts(samples: np.ndarray, size: int, length: int, v: int) -> np.ndarray:
    """Starts from which a recurring sample is less than v away and a whole string fits."""
    s = np.unique(samples)
    lo, hi = np.maximum(s - v + 1, 0), np.minimum(s, size - length)
    lo[1:] = np.maximum(lo[1:], s[:-1] + 1)
    n = np.maximum(hi - lo + 1, 0)
    return np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _start_places(batches: Iterator[pa.RecordBatch], lengths: tuple[int, int], block: int, blocks: int) -> Iterator[Places]:
    roll = Rolling()
    for b in batches:
        keys, samples = b.column("d").to_numpy(), b.column("samples")
        for c in T.chunks(b.column("text"), CHUNK):
            own = [decoded(samples[c.lo + i].as_py()) for i in range(c.n)]
            for words, length in enumerate(lengths):
                v, _ = difference_cover(length)
                mine = [-1 - s[s < 0] if words else s[s >= 0] for s in own]
                todo = [i for i, s in enumerate(mine) if len(s)]
                if not todo:
                    continue
                first = _units(c, roll, bool(words))
                sizes = np.diff(first)
                parts = [_starts(mine[i], int(sizes[i]), length, v) for i in todo]
                x = _named(roll, keys[c.lo + np.array(todo)], first[todo], parts, length, bool(words))
                here = x[0] % np.uint64(blocks) == np.uint64(block)
                yield tuple(a[here] for a in x)


def _bucket(parcels: int) -> Callable[[pa.Table], pa.Table]:
    """One bucket: its places are sorted, and those whose string recurs go on by text."""

    def run(t: pa.Table) -> pa.Table:
        known = t["found"].to_pylist()
        data = t["data"].to_pylist()
        (_, _, d, pos), again, _ = recur(unpacked([x for x, k in zip(data, known, strict=True) if not k], tuple(k for _, k in PLACE)))
        d0, pos0 = unpacked([x for x, k in zip(data, known, strict=True) if k], (np.int64, np.int32))
        d, pos = np.r_[d[again], d0], np.r_[pos[again], pos0]
        to = (mix(d.view(np.uint64)) % np.uint64(parcels)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        to, x = to[order], (d[order], pos[order])
        out = [(int(to[lo]), packed(x, lo, hi)) for lo, hi in runs(to)]
        columns = list(zip(*out, strict=True)) or [[]] * 2
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.binary()), strict=True)], names=["parcel", "data"])

    return run


def _lists(t: pa.Table) -> pa.Table:
    """(d, pos) of a parcel: a row for each text with its places, each once, words first, encoded."""
    d, pos = unpacked(t["data"].to_pylist(), (np.int64, np.int32))
    order = np.lexsort((pos, d))
    d, pos = d[order], pos[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (pos[1:] != pos[:-1])] if len(d) else np.zeros(0, bool)
    d, pos = d[new], pos[new]
    own = list(runs(d))
    return pa.table([pa.array(d[[lo for lo, _ in own]]), pa.array([encoded(pos[lo:hi]) for lo, hi in own], pa.binary())], names=["d", "pos"])


def recurring(places: DataFrame, parcels: int) -> DataFrame:
    """(d, pos) of all places, sent as parcels, whose string occurs at another place too."""
    found = places.groupBy("bucket").applyInArrow(_bucket(parcels), FOUND)
    return found.groupBy("parcel").applyInArrow(_lists, "d long, pos binary")


def _cut_batches(lengths: tuple[int, int]):
    def spans(p: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        heads = np.flatnonzero(np.r_[True, np.diff(p) > length]) if len(p) else np.zeros(0, np.int64)
        return p[heads], p[np.r_[heads[1:], len(p)] - 1] + length if len(p) else p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, lists in zip(b.column("text").to_pylist(), b.column("found").to_pylist(), strict=True):
                data = text.encode()
                p = np.unique(np.concatenate([decoded(x) for x in lists]))
                lo, hi = spans(p[p >= 0], lengths[0])
                kept, at = hashlib.sha256(), 0
                for x, y in zip(lo.tolist(), hi.tolist(), strict=True):
                    kept.update(data[at:x])
                    at = y
                kept.update(data[at:])
                rows.append((hashlib.sha256(data).digest(), int((hi - lo).sum()), len(lo), kept.hexdigest(), len(spans(np.sort(-1 - p[p < 0]), lengths[1])[0])))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["digest", "removed", "spans", "kept_sha", "passages"])

    return run


def release(spark) -> None:
    """Lets Spark drop the shuffle files of a block that is done with; it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def without_repeats(docs: DataFrame, length: int = LENGTH, blocks: int = BLOCKS, words: int = WORDS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages for each row of docs.

    n_passages counts the maximal passages of `words` words or more that stand in a different text too, whatever their length in
    bytes; they are not removed unless they hold a string of `length` bytes. Null texts count as empty. Rows with equal texts of
    length bytes or more lose everything, and their text is one passage; shorter texts lose nothing. Repeated rows count as copies of
    each other; a null doc_id stays null; an empty table gives an empty result; other columns are ignored, whatever their names.
    """
    spark, lengths = docs.sparkSession, (length, words)
    hexed = F.sha2("text", 256)
    own = keyed_texts(docs).withColumns({"h": hexed, "n_bytes": F.octet_length("text").cast("long")})
    hashed = cut(own.select("doc_id", "n_bytes", F.unhex("h").alias("digest")))
    n, size = hashed.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    buckets, parcels = 1 + size // BUCKET_BYTES, 1 + n // TEXTS
    copies = hashed.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("digest").alias("g"))
    texts = own.filter(F.col("n_bytes") >= min(length, 2 * words - 1)).select(F.conv(F.substring("h", 1, 16), 16, -10).cast("long").alias("d"), "text")
    samples = cut(recurring(texts.mapInArrow(lambda b: _sent(_sample_places(b, lengths), buckets), PARCEL), parcels).withColumnRenamed("pos", "samples"))
    release(spark)
    listed = samples.select(F.col("d").alias("k"))
    listed = F.broadcast(listed) if samples.count() <= LISTED else listed
    once = texts.join(listed, F.col("d") == F.col("k"), "left_semi").groupBy("d").agg(F.first("text").alias("text"))
    suspects = cut(once.join(samples.withColumnRenamed("d", "k"), F.col("d") == F.col("k")).select("d", "text", "samples"))
    release(spark)
    parts = []
    for block in range(blocks):
        places = suspects.mapInArrow(lambda b, i=block: _sent(_start_places(b, lengths, i, blocks), buckets), PARCEL)
        parts.append(cut(recurring(places, parcels)))
        del places
        release(spark)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    found = found.groupBy(F.col("d").alias("k")).agg(F.collect_list("pos").alias("found"))
    result = suspects.select("d", "text").join(found, F.col("d") == F.col("k")).select("text", "found").mapInArrow(_cut_batches(lengths), "digest binary, removed long, spans long, kept_sha string, passages long")
    empty = hashlib.sha256(b"").hexdigest()
    whole = F.col("g").isNotNull() & (F.col("n_bytes") >= length)
    return (
        hashed.join(copies, F.col("digest") == F.col("g"), "left").join(result.withColumnRenamed("digest", "r"), F.col("digest") == F.col("r"), "left")
        .select(
            "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
            F.when(whole, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, empty).otherwise(F.coalesce("kept_sha", F.lower(F.hex("digest")))).alias("kept_sha256"),
            F.when(whole, 1).otherwise(F.coalesce("passages", F.lit(0))).cast("long").alias("n_passages"),
        )
    )

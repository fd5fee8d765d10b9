"""Line dedup by log templates: lines whose template recurs across documents are dropped.

The template tree has fixed depth. A line goes by its number of tokens, then by its leading tokens, with tokens that hold
digits, addresses or links as wildcards. Below stand the line's own template and, for lines of FIELDS or more tokens, four
merged templates, in each of which one quarter of the line is a wildcard whatever it holds: lines of one length that agree
in three quarters meet in one of them. Templates are addressed by hash, so that no leaf gathers its lines and the result
does not depend on their order.

Addresses are dealt by a shuffle, packed by shard, and each shard counts the documents of its templates. Before that every
task counts what it has read: a template that recurs within the task is settled there, and of its lines the shard gets no
more than it needs to know so. Lines found come back by a shuffle on the document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import keyed_texts
from quayside.session import cut

LEADING = 2
QUARTERS = 4
#: Lines of fewer tokens have their own template only.
FIELDS = 4
#: A template recurs from so many documents on; a line of more than LONG_TOKENS, as a whole, from two on.
MIN_DOCS = 3
LONG_TOKENS = 50
#: Addresses that a task gathers before it counts them.
GATHER = 1_000_000
SHARD_DOCS = 4096
VARIABLE = re.compile(r"\S*[0-9@]\S*|\S+://\S*")
#: What every variable field holds; a line without it need not be searched for fields.
HINT = re.compile(r"[0-9@]|://")
WILD = "<*>"
MASK = 2**64 - 1


def template_keys(line: str) -> list[int]:
    """64-bit addresses of the templates that a line belongs to, odd for a long line as a whole only; none for a line without tokens."""
    line = line.lower()
    tokens = (VARIABLE.sub(WILD, line) if HINT.search(line) else line).split()
    n = len(tokens)
    if not n:
        return []
    h = xxhash.xxh64_intdigest
    node = h(f"{n} {' '.join(tokens[:LEADING])}")
    if n < FIELDS:
        return [h(" ".join(tokens), node) & ~1]
    parts = [h(" ".join(tokens[n * i // QUARTERS : n * (i + 1) // QUARTERS]), node + i & MASK) for i in range(QUARTERS)]
    total = sum(p * 0x9E3779B97F4A7C15 for p in parts)
    return [(total ^ node) & MASK & ~1 | (n > LONG_TOKENS), *((total - p * 0x9E3779B97F4A7C15 + i + 1 << 1) & MASK for i, p in enumerate(parts))]


def _owned(keys: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all addresses, the number of the line of each)"""
    return np.array([k for x in keys for k in x], dtype=np.uint64), np.repeat(np.arange(len(keys)), [len(x) for x in keys])


def least(keys: np.ndarray, min_docs: int) -> np.ndarray:
    """Documents from which on each template recurs."""
    return np.where(keys & np.uint64(1), min(2, min_docs), min_docs)


def places(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key and doc, distinct keys, number of each row's key among them, in that order)"""
    order = np.lexsort((doc, keys))
    k = keys[order]
    new = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
    return order, k[new], np.cumsum(new) - 1


def documents(doc: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    """Distinct docs of each number; both in order."""
    new = np.r_[True, (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])] if len(doc) else np.zeros(0, bool)
    return np.bincount(number[new], minlength=n)


HITS = pa.list_(pa.int32())
NAMES = ["shard", "id", "h", "lines", "key", "row", "line"]
FOUND = "shard int, id long, h long, lines array<int>, key binary, row binary, line binary"
#: A document as shards know it: its number in the batch that sent it, and what names it elsewhere.
ROWS = np.dtype([("at", "<i4"), ("null", "?"), ("id", "<i8"), ("h", "<i8")])


def _keys(min_docs: int, shards: int):
    """Rows with lines: what a task has settled, for each document (id, h). Rows with a shard: addresses, with document and line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        hs: list[int] = []
        keys: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        nums: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            names = np.array([(n, i is None, i or 0, h) for n, (i, h) in enumerate(zip(ids, hs, strict=True))], dtype=ROWS)
            k, d, x = map(np.concatenate, (keys, docs, nums))
            order, distinct, at = places(k, d)
            d, x = d[order], x[order]
            n = documents(d, at, len(distinct))
            often = (n >= least(distinct, min_docs))[at]
            # Of a template that recurs here, the shard is told by the lines of as many documents as make it recur.
            new = np.r_[True, (d[1:] != d[:-1]) | (at[1:] != at[:-1])] if len(d) else np.zeros(0, bool)
            nth = np.cumsum(new)
            first = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
            nth = nth - np.maximum.accumulate(np.where(first, nth, 0)) if len(d) else nth
            sent = ~often | (new & (nth < least(distinct[at], min_docs)))
            got: list[tuple] = []
            done = np.unique(np.stack([d[often], x[often]], axis=1), axis=0)
            for lo, hi in _runs(done[:, 0]):
                r = names[done[lo, 0]]
                got.append((None, None if r["null"] else int(r["id"]), int(r["h"]), done[lo:hi, 1].tolist(), None, None, None))
            k, d, x = distinct[at][sent], d[sent], x[sent]
            shard = ((k >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            for lo, hi in _runs(shard):
                got.append((int(shard[lo]), None, None, None, k[lo:hi].tobytes(), names[d[lo:hi]].tobytes(), x[lo:hi].astype(np.int32).tobytes()))
            columns = list(zip(*got, strict=True)) or [[]] * len(NAMES)
            types = (pa.int32(), pa.int64(), pa.int64(), HITS, pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=NAMES)

        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                k, x = _owned([template_keys(line) for line in text.split("\n")])
                keys.append(k)
                nums.append(x)
                docs.append(np.full(len(k), len(ids)))
                ids.append(i)
                hs.append(xxhash.xxh64_intdigest(text) - (1 << 63))
                size += len(k)
                if size > GATHER:
                    yield out()
                    ids, hs, keys, docs, nums, size = [], [], [], [], [], 0
        if ids:
            yield out()

    return run


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of each run of equal values."""
    edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True]) if len(x) else np.zeros(1, np.int64)
    return zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)


def _count(min_docs: int):
    """Of one shard, the lines of the templates that recur, for each document."""

    def run(t: pa.Table) -> pa.Table:
        k, r, x, part = [np.zeros(0, np.uint64)], [np.zeros(0, ROWS)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i, (a, b, c) in enumerate(zip(*(t[n].to_pylist() for n in ("key", "row", "line")), strict=True)):
            k.append(np.frombuffer(a, np.uint64))
            r.append(np.frombuffer(b, ROWS))
            x.append(np.frombuffer(c, np.int32))
            part.append(np.full(len(k[-1]), i))
        k, r, x, part = map(np.concatenate, (k, r, x, part))
        own = (part << 32) | r["at"]
        order, distinct, at = places(k, own)
        hit = order[(documents(own[order], at, len(distinct)) >= least(distinct, min_docs))[at]]
        hit = hit[np.lexsort((x[hit], own[hit]))]
        ids, hs, lines = [], [], []
        for lo, hi in _runs(own[hit]):
            y = r[hit[lo]]
            ids.append(None if y["null"] else int(y["id"]))
            hs.append(int(y["h"]))
            lines.append(np.unique(x[hit[lo:hi]]).tolist())
        return pa.table([pa.array(ids, pa.int64()), pa.array(hs, pa.int64()), pa.array(lines, HITS)], names=["id", "h", "lines"])

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for key, text, found in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("found").to_pylist(), strict=True):
            lines = text.split("\n")
            gone = {i for x in found or () for i in x}
            kept = "\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else text
            rows.append((key, sum(1 for x in lines if x.strip()), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*rows, strict=True)) or [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h = np.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in b.column("text").to_pylist()], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h)], names=[*b.schema.names, "h"])


def without_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines (with a token), n_dropped, kept_sha256 and kept_text for each row of docs.

    All lines of a recurring template go, the first too. Lines without tokens stay. Null texts count as empty; each row is
    a document of its own, repeated rows too; a null doc_id stays null; an empty table gives an empty result; other columns
    are ignored.
    """
    own = keyed_texts(docs)
    # Enough shards for each to hold the addresses of some thousand documents.
    shards = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), own.count() // SHARD_DOCS)
    dealt = cut(own.mapInArrow(_keys(min_docs, shards), FOUND))
    counted = dealt.filter("shard IS NOT NULL").select("shard", "key", "row", "line").groupBy("shard").applyInArrow(_count(min_docs), "id long, h long, lines array<int>")
    found = dealt.filter("shard IS NULL").select("id", "h", "lines").unionAll(counted).groupBy("id", "h").agg(F.collect_list("lines").alias("found"))
    texts = own.mapInArrow(_hashed, "doc_id long, text string, h long").withColumnRenamed("h", "h_")
    # A document is its id and the hash of its text: rows alike in both have the same lines.
    joined = texts.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h_") == F.col("h")), "left").select("doc_id", "text", "found")
    return joined.mapInArrow(_without, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string")

"""Vectorised text kernels: word boundaries, shingles and XXH64 over Arrow string batches.

Texts are handled as UTF-8 bytes. The separators are the ASCII bytes 0x20 and 0x09-0x0D, which never occur inside a
multi-byte UTF-8 sequence, so splitting bytes and splitting code points give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SEED = 42
# Fixed values of the public XXH64 specification.
P1, P2, P3, P4, P5 = (
    np.uint64(11400714785074694791),
    np.uint64(14029467366897019727),
    np.uint64(1609587929392839161),
    np.uint64(9650029242287828579),
    np.uint64(2870177450012600261),
)
#: Longer substrings are hashed one by one by the C library.
VECTOR_MAX = 256
#: Bytes of text that are vectorised at once; a longer text makes a chunk of its own.
CHUNK_BYTES = 4 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc, lane):
    return rotl(acc + lane * P2, 31) * P1


def xxh64_fixed(buf: np.ndarray, starts: np.ndarray, length: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of buf[s:s+length] for each s. buf must go on for 8 bytes behind the last substring."""
    raw = buf.data
    words = np.ndarray((len(buf) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    seed_ = np.uint64(seed)
    n = len(starts)
    with np.errstate(over="ignore"):
        at = 0
        if length >= 32:
            v = [np.full(n, s, dtype=np.uint64) for s in (seed_ + P1 + P2, seed_ + P2, seed_, seed_ - P1)]
            while length - at >= 32:
                for i in range(4):
                    v[i] = _round(v[i], words[starts + (at + 8 * i)])
                at += 32
            h = rotl(v[0], 1) + rotl(v[1], 7) + rotl(v[2], 12) + rotl(v[3], 18)
            for x in v:
                h = (h ^ _round(np.uint64(0), x)) * P1 + P4
        else:
            h = np.full(n, seed_ + P5, dtype=np.uint64)
        h += np.uint64(length)
        while length - at >= 8:
            h = rotl(h ^ _round(np.uint64(0), words[starts + at]), 27) * P1 + P4
            at += 8
        if length - at >= 4:
            h = rotl(h ^ ((words[starts + at] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
            at += 4
        while at < length:
            h = rotl(h ^ (buf[starts + at].astype(np.uint64) * P5), 11) * P1
            at += 1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    return h


def xxh64(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many substrings of buf, one length class at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    short = np.minimum(lens, VECTOR_MAX + 1).astype(np.uint16)
    order = np.argsort(short, kind="stable")
    classes, first = np.unique(short[order], return_index=True)
    for k, (length, lo) in enumerate(zip(classes.tolist(), first.tolist(), strict=True)):
        rows = order[lo : first[k + 1] if k + 1 < len(first) else len(order)]
        if length <= VECTOR_MAX:
            out[rows] = xxh64_fixed(buf, starts[rows], length, seed)
        else:
            data = buf.data
            out[rows] = [xxhash.xxh64_intdigest(data[s : s + n], seed) for s, n in zip(starts[rows].tolist(), lens[rows].tolist(), strict=True)]
    return out


@dataclass
class Chunk:
    """Some texts, one after the other. rows: the slice of the batch; offsets: len(texts) + 1 byte offsets into data."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return self.hi - self.lo


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Null texts count as empty. data has 8 zero bytes behind the texts, for the hash kernel."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off_buf, data_buf = texts.buffers()
    if not len(texts):
        return
    off = np.frombuffer(off_buf, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, len(texts))
        part = np.zeros(off[hi] - off[lo] + 8, dtype=np.uint8)
        part[:-8] = data[off[lo] : off[hi]]
        yield Chunk(lo, hi, part, off[lo : hi + 1] - off[lo])
        lo = hi


@dataclass
class Words:
    """Words of a chunk in order: byte ranges in data, and first[d]:first[d + 1] are those of text d."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(chunk: Chunk, lower: bool = False, compact: bool = False) -> Words:
    """lower: A-Z only. compact: the words are laid out anew with one space between, as shingles need them."""
    n = int(chunk.offsets[-1])
    data = LOWER[chunk.data] if lower else chunk.data
    inside = ~SPACE[data]
    inside[n:] = False
    edge = np.unique(chunk.offsets[chunk.offsets < n])
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    joint = before[edge].copy()
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    # A word ends where the next byte is a separator or belongs to the next text.
    stop = np.flatnonzero(~inside & before)
    cut = edge[joint]
    ends = np.sort(np.concatenate([stop, cut])) if len(cut) else stop
    first = np.searchsorted(starts, chunk.offsets)
    if compact:
        lens = ends - starts
        at = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(lens + 1, out=at[1:])
        keep = inside.copy()
        # The byte behind a word becomes its space; where the next text follows at once there is none to keep.
        keep[stop] = True
        if len(cut):
            body = np.insert(data, cut, 0x20)
            kept = np.insert(keep, cut, True)
        else:
            body, kept = data, keep
        packed = body[kept]
        packed[SPACE[packed]] = 0x20
        buf = np.zeros(len(packed) + 16, dtype=np.uint8)
        buf[: len(packed)] = packed
        return Words(buf, at[:-1], at[:-1] + lens, first)
    return Words(data, starts, ends, first)


def shingles(w: Words, size: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lens, first): windows of size words of a compact Words; a text of fewer words gives all it has (whole) or none."""
    counts = w.counts
    n = np.maximum(counts - size + 1, 0)
    if whole:
        n = np.where((n == 0) & (counts > 0), 1, n)
    first = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(n, out=first[1:])
    index = np.arange(first[-1]) - np.repeat(first[:-1], n) + np.repeat(w.first[:-1], n)
    last = np.minimum(index + size, np.repeat(w.first[1:], n)) - 1
    return w.starts[index], w.ends[last] - w.starts[index], first


def word_hashes(w: Words, seed: int = SEED) -> np.ndarray:
    return xxh64(w.data, w.starts, w.ends - w.starts, seed)

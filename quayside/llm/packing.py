"""Packing token sequences by minimum bin slack: bitset subset sums choose what fills each window closest to its capacity."""

from __future__ import annotations

import json
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quayside.llm.tables import keyed_texts

WINDOW = 2048
END_ID = 1
#: Remainders wait until POOL of them are there, and packing stops while LEAVE are left to choose from; both bound memory.
POOL, LEAVE = 20_000, 2_000
#: One remainder in so many is held back with its ids, to fill what the subset sums leave open. At most RESERVE tokens of them,
#: and as many ids of pooled ones, are kept at a time: those can be cut when the reserve is used up.
HELD_SHARE = 16
RESERVE = 64 * WINDOW
#: Distinct words whose ids are remembered at a time.
CACHE = 250_000
#: A longer text is split for the pattern, at a place where the pattern always splits.
SPLIT = 1 << 20
# Fixed value: the public pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAFE = regex.compile(r"\p{L} (?=\p{L})")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ids(dict):
    """Word -> its ids as little-endian unsigned 32-bit numbers. Encodes each distinct word once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
        if any(x[k] for x in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only added tokens that are matched as they stand are known")
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        self.bpe = tiktoken.Encoding("from_file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PATTERN).findall
        self.special = {k: array("I", [v]).tobytes() for k, v in special.items()}
        #: Longer added tokens first, as the longest that begins at a place counts.
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.bpe._encode_single_piece(word.encode("utf-8"))).tobytes()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of the text as the tokenizer gives them: a string of an added token is that token, what stands between is split."""
        if any(x in text for x in self.special):
            return b"".join(self.special.get(x) or self.encode_plain(x) for x in self.at_special.split(text))
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        if len(self) > CACHE:
            self.clear()
        if len(text) <= SPLIT:
            return b"".join(map(self.__getitem__, self.split(text)))
        out, at = [], 0
        while at < len(text):
            m = SAFE.search(text, at + SPLIT)
            to = m.start() + 1 if m else len(text)
            out.append(b"".join(map(self.__getitem__, self.split(text[at:to]))))
            at = to
        return b"".join(out)


def best_fill(lengths: list[int], counts: list[int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, at most counts[x] of x, whose sum is closest to capacity from below.

    Bit s of a set is 1 if sum s can be reached; counts are added in doubling parts. The walk back through the sets takes as
    few as possible of the later lengths. It stops early at a perfect fill.
    """
    mask, reach, steps = (2 << capacity) - 1, 1, []
    for x in lengths:
        before, left, part = reach, min(counts[x], capacity // x), 1
        while left:
            take = min(part, left)
            reach |= (reach << (x * take)) & mask
            left -= take
            part *= 2
        steps.append((x, before))
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for x, before in reversed(steps):
        n = 0
        while not before >> at & 1:
            at -= x
            n += 1
        if n:
            used[x] = n
    return used


def pack_lengths(counts: list[int], window: int, leave: int = 0) -> Iterator[tuple[dict[int, int], int]]:
    """(multiset of lengths, times) until at most leave items are left; counts[x] is used up, and may be lowered between. Each fill
    holds the longest left; one that leaves slack comes alone."""
    while sum(counts) > leave:
        top = next(x for x in range(window, 0, -1) if counts[x])
        counts[top] -= 1
        rest = window - top
        used = best_fill([x for x in range(min(rest, top), 0, -1) if counts[x]], counts, rest) if rest else {}
        counts[top] += 1
        used[top] = used.get(top, 0) + 1
        times = min(counts[x] // n for x, n in used.items()) if sum(x * n for x, n in used.items()) == window else 1
        for x, n in used.items():
            counts[x] -= n * times
        yield used, times


class Packer:
    """Packs the documents of one task. Takes (key, ids) and gives piece rows; rows of a document may come at different times."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.rows: list[tuple] = []
        self.pool: list[list[tuple]] = [[] for _ in range(window + 1)]
        self.pooled = self.kept = 0
        self.reserve: deque = deque()
        self.reserved = self.remainders = 0

    def add(self, key, ids: bytes) -> None:
        n, w = len(ids) // 4, self.window
        for start in range(0, n - w + 1, w):
            self.rows.append((key, start, w, zlib.crc32(ids[4 * start : 4 * (start + w)]), n, self.sequence, 0))
            self.sequence += 1
        x = n % w
        if x:
            part = ids[4 * (n - x) :]
            if self.remainders % HELD_SHARE == 0 and self.reserved + x <= RESERVE:
                self.reserve.append((key, n - x, part, n))
                self.reserved += x
            else:
                keep = self.kept + x <= RESERVE
                self.kept += x * keep
                self.pool[x].append(((key, n - x, x, zlib.crc32(part), n), part if keep else None))
                self.pooled += 1
            self.remainders += 1
        if self.pooled > POOL:
            self._flush(LEAVE)

    def _flush(self, leave: int) -> None:
        counts = [len(x) for x in self.pool]
        for used, times in pack_lengths(counts, self.window, leave):
            for _ in range(times):
                fill = [self.pool[x].pop() for x, n in used.items() for _ in range(n)]
                at = sum(row[2] for row, _ in fill)
                self.pooled -= len(fill)
                self.kept -= sum(row[2] for row, part in fill if part)
                while self.reserved < self.window - at and self.kept:
                    self._hold_back(counts)
                if self.reserved < self.window - at and all(part for _, part in fill):
                    # Nothing is left to fill it up with; finish() deals with what is in the reserve.
                    for row, part in fill:
                        self.reserve.append((row[0], row[1], part, row[4]))
                        self.reserved += row[2]
                    continue
                at = 0
                for row, _ in fill:
                    self.rows.append((*row, self.sequence, at))
                    at += row[2]
                self._top_up(at, self.window - at)
                self.sequence += 1

    def _hold_back(self, counts: list[int]) -> None:
        """Moves the longest pooled piece whose ids are kept to the reserve."""
        x, i = next((x, i) for x in range(self.window, 0, -1) for i, (_, part) in enumerate(self.pool[x]) if part)
        row, part = self.pool[x].pop(i)
        counts[x] -= 1
        self.pooled -= 1
        self.kept -= x
        self.reserve.append((row[0], row[1], part, row[4]))
        self.reserved += x

    def _top_up(self, at: int, room: int) -> int:
        """Fills room tokens of the current sequence from at on, cutting held-back documents; returns where it ends."""
        while room and self.reserve:
            key, start, part, n = self.reserve.popleft()
            x = min(room, len(part) // 4)
            self.rows.append((key, start, x, zlib.crc32(part[: 4 * x]), n, self.sequence, at))
            if 4 * x < len(part):
                self.reserve.appendleft((key, start + x, part[4 * x :], n))
            self.reserved -= x
            at += x
            room -= x
        return at

    def finish(self) -> None:
        """Packs the rest; the last tokens go to sequences of a power of two each, which need no padding."""
        self._flush(0)
        while self.reserved:
            size = self.window if self.reserved >= self.window else 1 << (self.reserved.bit_length() - 1)
            self._top_up(0, size)
            self.sequence += 1

    def take(self) -> list[tuple]:
        out, self.rows = self.rows, []
        return out


NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
SCHEMA = ", ".join(f"{c} long" for c in NAMES)


def _pack_batches(path: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packer = Ids(path), Packer(window, TaskContext.get().partitionId() << 36)
        end = array("I", [END_ID]).tobytes()

        def batch() -> pa.RecordBatch:
            rows = packer.take()
            columns = zip(*rows, strict=True) if rows else [[] for _ in NAMES]
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=list(NAMES))

        for b in batches:
            for key, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                packer.add(key, ids.encode(text.as_py()) + end)
            yield batch()
        packer.finish()
        yield batch()

    return run


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each task packs the documents that it reads, so nothing is shuffled and a lost task is done again alone; sequence ids
    hold the number of the task and repeat only if its input comes in another order (cut the lineage of docs that come from
    a shuffle). A text longer than a window gives whole windows first; remainders are packed by minimum bin slack, in tasks
    of every size; what slack is left is filled by cutting documents held back for it, one in HELD_SHARE, and then others
    whose ids are kept. Only where a task has none of either does a sequence end early and is padded. A null or empty text
    is its end id alone. Repeated rows
    are packed each; a null doc_id stays null; an empty table gives an empty result; other columns are ignored.
    """
    return keyed_texts(docs).mapInArrow(_pack_batches(tokenizer, window), SCHEMA)

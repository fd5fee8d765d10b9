"""SentencePiece encoding by Gumbel top-k sampling of segmentations without replacement, and decoding.

A text is a chain of words (a run of space marks with what follows), which no piece crosses; the lattice of a word gives all
its segmentations, with log-probabilities that sum to 1 over the word. The k segmentations of the whole text with the largest
Gumbel-perturbed log-probability are a sample of k without replacement. They are found by a best-first search whose bounds
are exact: a set of segmentations with log-mass m has as its maximum one Gumbel variable with location m, so a set is split
into the drawn segmentation of the next word (which keeps the maximum) and the rest (whose maximum is drawn below it).
Following the drawn part to the end gives one segmentation; the open rests wait in the queue, and the best is next.

The best segmentations of all distinct words of a block of texts are listed together, in arrays; lattices of single words are built
for long words, and for draws from outside the lists.

Random numbers are hashes of seed, row key, round and word, so a row gives the same sample wherever it is computed.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Collection, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.lm import mix
from quayside.llm.tables import keyed_texts

MARK = "▁"
#: Words; texts are cut at all their ends, and within them between characters that no piece joins.
WORD = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
#: Segmentations of a word that are listed, best first (a power of two); the others are drawn from the lattice when their turn comes.
LISTED = 4
#: Words of at most so many characters are listed all at once, position by position; longer ones one after the other.
SHORT = 64
#: Side of the largest table of pairs of characters that is held whole.
PAIRS = 8192
#: Tokens that are worked on at once.
BLOCK = 400_000


class Lists(NamedTuple):
    """The LISTED best segmentations of words, best first: log-probabilities, the probability of all others, and where their ids are."""

    logs: np.ndarray
    others: np.ndarray
    ids: np.ndarray
    at: np.ndarray
    size: np.ndarray

    def segments(self, word: int) -> list[bytes]:
        """Ids (32-bit) of those that there are."""
        return [self.ids[a : a + n].tobytes() for a, n in zip(self.at[word].tolist(), self.size[word].tolist(), strict=True) if n]


def _merged(a: np.ndarray, from_a: np.ndarray, b: np.ndarray, from_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest of two falling lists a column, falling, with what belongs to them; of equals those with the larger from (a bitonic merge)."""
    k = len(a)
    b, from_b = b[::-1], from_b[::-1]
    take = (a > b) | ((a == b) & (from_a > from_b))
    x, y = np.where(take, a, b), np.where(take, from_a, from_b)
    half = k // 2
    while half:
        x, y = x.reshape(-1, 2, half, a.shape[1]), y.reshape(-1, 2, half, a.shape[1])
        (x0, x1), (y0, y1) = (x[:, 0], x[:, 1]), (y[:, 0], y[:, 1])
        keep = (x0 > x1) | ((x0 == x1) & (y0 > y1))
        x = np.stack([np.maximum(x0, x1), np.minimum(x0, x1)], axis=1)
        y = np.stack([np.where(keep, y0, y1), np.where(keep, y1, y0)], axis=1)
        half //= 2
    return x.reshape(k, -1), y.reshape(k, -1)


def _numbered(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, first word of each number); words are told apart by a hash, and then compared."""
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    power = np.full(int(lengths.max()), 0xD1B54A32D192ED03, np.uint64)
    power[0] = 1
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(power)
        name = np.add.reduceat(mix(np.arange(int(codes.max()) + 1, dtype=np.uint64))[codes] * power[place], starts)
    number, _ = pd.factorize(name)
    number = number.astype(np.int64)
    first = np.zeros(int(number.max()) + 1, np.int64)
    first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
    same = lengths[first][number] == lengths
    if not same.all() or not (codes[np.repeat(starts[first][number], lengths) + place] == codes).all():
        # Two words with one hash.
        index: dict[bytes, int] = {}
        number = np.array([index.setdefault(codes[a : a + n].tobytes(), len(index)) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)], np.int64)
        first = np.zeros(len(index), np.int64)
        first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
    return number, first


class Pieces:
    """Lattices of one model. Weights are the model's scores, or of a BPE model (whose scores are minus ranks) -log(1 + rank), times alpha."""

    def __init__(self, path: str, alpha: float = 1.0):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = {i: sp.get_score(i) for i in plain}
        ranked = all(s <= 0 and s == int(s) for s in scores.values())
        weight = {i: alpha * (-math.log1p(-s) if ranked else s) for i, s in scores.items()}
        self.arcs = {sp.id_to_piece(i): (weight[i], i) for i in plain}
        if crossing := [p for p in self.arcs if re.search(f"[^{MARK}]{MARK}", p) or ("\n" in p and len(p) > 1)]:
            raise ValueError(f"pieces cross words: {crossing[:3]}")
        self.prefixes = {x[:n] for x in self.arcs for n in range(1, len(x) + 1)}
        self.bytes = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.unknown = sp.unk_id()
        self.worst = min(weight.values()) - 1
        self._index()

    def _index(self) -> None:
        """The pieces as a trie in arrays: characters as numbers from 1, nodes by (node, character) in a hash table."""
        letters = sorted({c for x in self.arcs for c in x})
        self.size = len(letters) + 1
        self.letter = np.zeros(ord(letters[-1]) + 2, np.int64)
        self.letter[[ord(c) for c in letters]] = np.arange(1, self.size)
        number = {c: i for i, c in enumerate(letters, 1)}
        joined = np.array(sorted({number[x[n]] * self.size + number[x[n + 1]] for x in self.arcs for n in range(len(x) - 1)} or {0}), np.int64)
        self.pairs = joined
        self.pair_table = None
        if self.size <= PAIRS:
            self.pair_table = np.zeros(self.size * self.size, bool)
            self.pair_table[joined] = True
        nodes = {x: n for n, x in enumerate(sorted(self.prefixes, key=lambda x: (len(x), x)), 1)}
        self.longest = max(map(len, self.arcs))
        self.node_weight = np.full(len(nodes) + 1, -np.inf)
        self.node_id = np.zeros(len(nodes) + 1, np.int64)
        for x, (w, i) in self.arcs.items():
            self.node_weight[nodes[x]], self.node_id[nodes[x]] = w, i
        self.root = np.zeros(self.size, np.int64)
        self.root[[number[c] for c in letters]] = [nodes[c] for c in letters]
        deep = [x for x in nodes if len(x) > 1]
        keys = np.array([nodes[x[:-1]] * self.size + number[x[-1]] for x in deep], np.int64)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.slot_key, self.slot_node = np.full(1 << self.bits, -1), np.zeros(1 << self.bits, np.int64)
        values, slots = np.array([nodes[x] for x in deep], np.int64), self._slots(keys)
        while len(keys):
            empty = self.slot_key[slots] < 0
            self.slot_key[slots[empty]] = keys[empty]
            self.slot_node[slots[empty]] = values[empty]
            # Of several that met in one slot, the last is there; the others go on to the next.
            wait = self.slot_key[slots] != keys
            keys, values, slots = keys[wait], values[wait], (slots[wait] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _children(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """0 where there is none."""
        keys = node * self.size + letter
        slots = self._slots(keys)
        there = self.slot_key[slots]
        out = np.where(there == keys, self.slot_node[slots], 0)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            there = self.slot_key[slots[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.slot_node[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def letters(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of characters; 0 for those in no piece."""
        return self.letter[np.minimum(codes, len(self.letter) - 1)]

    def joins(self, letters: np.ndarray) -> np.ndarray:
        """Whether each character but the first stands beside the one before in some piece. Words are cut where it does not."""
        key = letters[:-1] * self.size + letters[1:]
        if self.pair_table is not None:
            return self.pair_table[key]
        return self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key

    def arcs_from(self, word: str, i: int) -> list[tuple[float, tuple[int, ...], int]]:
        """(weight, ids, length) of what may begin at i; a character that is no piece is its bytes (or unknown)."""
        out, single = [], False
        for j in range(i + 1, len(word) + 1):
            part = word[i:j]
            if part not in self.prefixes:
                break
            if (x := self.arcs.get(part)) is not None:
                out.append((x[0], (x[1],), j - i))
                single = single or j == i + 1
        if not single:
            out.append((self.worst * len(word[i].encode()), self.spelled(ord(word[i])), 1))
        return out

    def lattice(self, word: str) -> tuple[list, list[float]]:
        """(arcs into each position, log-mass of all ways to it)."""
        into: list[list] = [[] for _ in range(len(word) + 1)]
        mass = [0.0] + [-math.inf] * len(word)
        exp, log = math.exp, math.log
        for i in range(len(word)):
            for w, ids, n in self.arcs_from(word, i):
                into[i + n].append((i, w, ids))
            if t := [mass[j] + w for j, w, _ in into[i + 1]]:
                top = max(t)
                mass[i + 1] = top + log(sum([exp(x - top) for x in t])) if len(t) > 1 else top
        return into, mass

    def best(self, into: list, n: int) -> tuple[list[tuple[float, bytes]], bool]:
        """The n best ways through a lattice as (weight, ids), and whether there are more."""
        best: list[list] = [[(0.0, -1, 0, ())]]
        more = [False]
        for arcs in into[1:]:
            if len(arcs) == 1:
                i, w, ids = arcs[0]
                c = [(x[0] - w, i, r, ids) for r, x in enumerate(best[i])]
            else:
                c = [(x[0] - w, i, r, ids) for i, w, ids in arcs for r, x in enumerate(best[i])]
                c.sort()
            more.append(len(c) > n or any([more[i] for i, _, _ in arcs]))
            best.append(c[:n])
        out = []
        for x in best[-1]:
            ids, step = [], x
            while step[1] >= 0:
                ids.append(step[3])
                step = best[step[1]][step[2]]
            out.append((-x[0], array("I", [k for own in reversed(ids) for k in own]).tobytes()))
        return out, more[-1]

    def spelled(self, code: int) -> tuple[int, ...]:
        """Ids of a character that is no piece: its bytes, or unknown."""
        ids = tuple(self.bytes[b] for b in chr(code).encode())
        return ids if self.unknown not in ids else (self.unknown,)

    def lists(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Lists:
        """The best segmentations of words, given as places in an array of code points."""
        n = len(starts)
        logs, others = np.full((n, LISTED), -np.inf), np.zeros(n)
        at, size = np.zeros((n, LISTED), np.int64), np.zeros((n, LISTED), np.int64)
        flat, end = [], 0
        short = np.flatnonzero(lengths <= SHORT)
        if len(short):
            short = short[np.argsort(-lengths[short], kind="stable")]
            logs[short], others[short], ids, size[short] = self._short(codes, starts[short], lengths[short])
            ends = np.cumsum(size[short].ravel()).reshape(-1, LISTED)
            at[short] = ends - size[short]
            flat.append(ids)
            end = len(ids)
        for w in np.flatnonzero(lengths > SHORT).tolist():
            into, mass = self.lattice(codes[starts[w] : starts[w] + lengths[w]].astype("<u4").tobytes().decode("utf-32-le"))
            best, more = self.best(into, LISTED)
            for r, (x, seg) in enumerate(best):
                logs[w, r], at[w, r], size[w, r] = min(0.0, x - mass[-1]), end, len(seg) // 4
                flat.append(np.frombuffer(seg, np.uint32))
                end += len(seg) // 4
            others[w] = max(1e-17, 1.0 - float(np.exp(logs[w]).sum())) if more else 0.0
        return Lists(logs, others, np.concatenate(flat) if flat else np.zeros(0, np.uint32), at, size)

    def _short(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(log-probabilities, probability of all others, ids one after the other, their numbers) of words from the longest to the shortest.

        Place j of word w is cell off[j] + w, so the words that reach j stand side by side. Arcs are numbered by length and start."""
        k, top = LISTED, int(lengths[0])
        reach = np.searchsorted(-lengths, -np.arange(top + 2), side="right")  # words of at least j characters
        off = np.concatenate([[0], np.cumsum(reach)])
        char = np.concatenate([[0], np.cumsum(reach[1:])])
        places = np.concatenate([starts[: reach[i + 1]] + i for i in range(top)])
        letter = self.letters(codes[places])
        # Arcs of one character are everywhere: a piece, or the character spelled out.
        node = self.root[letter]
        weight, ident = self.node_weight[node], self.node_id[node]
        odd = np.flatnonzero(np.isneginf(weight))
        own, back_to = np.unique(codes[places[odd]], return_inverse=True)
        spelled = [self.spelled(int(c)) for c in own]
        if len(odd):
            weight[odd] = self.worst * np.array([len(chr(int(c)).encode()) for c in own])[back_to]
            ident[odd] = -1 - back_to
        arcs, idents, bases = [], [ident], [0, 0, len(ident)]
        i, w = np.repeat(np.arange(top), reach[1 : top + 1]), np.concatenate([np.arange(reach[j + 1]) for j in range(top)])
        for n in range(2, min(self.longest, top) + 1):
            on = np.flatnonzero((node > 0) & (reach[np.minimum(i + n, top + 1)] > w))
            i, w = i[on], w[on]
            node = self._children(node[on], letter[char[i + n - 1] + w])
            on = np.flatnonzero(node)
            i, w, node = i[on], w[on], node[on]
            is_piece = np.flatnonzero(np.isfinite(self.node_weight[node]))
            arcs.append((w[is_piece], self.node_weight[node[is_piece]], np.searchsorted(i[is_piece], np.arange(top + 2)).tolist()))
            idents.append(self.node_id[node[is_piece]])
            bases.append(bases[-1] + len(is_piece))
        ident = np.concatenate(idents)
        span = np.repeat(np.arange(1, len(idents) + 1), [len(x) for x in idents])
        # Best ways to each cell and how they end (arc and rank there), log-mass and number of all ways, up to more than are listed.
        cells = int(off[top + 1])
        best, back = np.full((k, cells), -np.inf), np.zeros((k, cells), np.int64)
        mass, ways = np.zeros(cells), np.ones(cells, np.int64)
        best[0, : reach[0]] = 0.0
        # Of equal ways the one with the longest last arc comes first, then the one that is better up to there.
        rank = k - 1 - np.arange(k)[:, None]
        for j in range(1, top + 1):
            m, prev, here = int(reach[j]), int(off[j - 1]), int(off[j])
            one = slice(int(char[j - 1]), int(char[j - 1]) + m)
            v, p = best[:, prev : prev + m] + weight[one], np.arange(one.start, one.stop) * k + rank
            total, number = mass[prev : prev + m] + weight[one], ways[prev : prev + m].copy()
            for n, (who, x, bounds) in enumerate(arcs[: j - 1], 2):
                lo, hi = bounds[j - n], bounds[j - n + 1]
                if lo == hi:
                    continue
                who, x = who[lo:hi], x[lo:hi]
                src = off[j - n] + who
                get = lambda table, at: table.take(at, axis=1, mode="clip")
                v[:, who], p[:, who] = _merged(get(v, who), get(p, who), get(best, src) + x, np.arange(bases[n] + lo, bases[n] + hi) * k + rank)
                total[who] = np.logaddexp(total[who], mass[src] + x)
                number[who] += ways[src]
            best[:, here : here + m], back[:, here : here + m] = v, p
            mass[here : here + m], ways[here : here + m] = total, np.minimum(number, k + 1)
        ends = off[lengths] + np.arange(len(lengths))
        logs = np.minimum(0.0, best[:, ends] - mass[ends]).T
        others = np.where(ways[ends] > k, np.maximum(1e-17, 1.0 - np.exp(logs).sum(axis=1)), 0.0)
        # All ways backwards at once; a way's arcs come last first.
        way = np.flatnonzero(np.isfinite(logs).ravel())
        at, r = lengths[way // k].copy(), way % k
        who, steps, sizes = way // k, [], np.zeros(logs.size, np.int64)
        odd_sizes = np.array([len(x) for x in spelled] or [1])
        while len(way):
            code = back[r, off[at] + who]
            arc = code // k
            ids = ident[arc]
            many = np.where(ids < 0, odd_sizes[np.clip(-1 - ids, 0, len(odd_sizes) - 1)], 1) if len(odd) else np.ones(len(ids), np.int64)
            sizes[way] += many
            steps.append((way, ids, sizes[way]))
            on = np.flatnonzero(at > span[arc])
            way, who, at, r = way[on], who[on], (at - span[arc])[on], (k - 1 - code % k)[on]
        upto = np.cumsum(sizes)
        flat = np.zeros(int(upto[-1]), np.uint32)
        for way, ids, done in steps:
            plain = np.flatnonzero(ids >= 0)
            flat[upto[way[plain]] - done[plain]] = ids[plain]
            for t in np.flatnonzero(ids < 0).tolist():
                to, x = int(upto[way[t]] - done[t]), spelled[-1 - int(ids[t])]
                flat[to : to + len(x)] = x
        return logs, others, flat, sizes.reshape(-1, k)

    def listed(self, word: str) -> tuple[list[float], list[bytes], float]:
        """Log-probabilities and ids (32-bit) of the best segmentations, best first, and the probability of all others."""
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        x = self.lists(codes, np.zeros(1, np.int64), np.array([len(codes)]))
        n = int(np.isfinite(x.logs[0]).sum())
        return x.logs[0, :n].tolist(), x.segments(0)[:n], float(x.others[0])

    def draw(self, word: str, uniform: Iterator[float], without: Collection[bytes], rest: float) -> tuple[float, bytes]:
        """A segmentation drawn from all but without, whose ids those are; rest is about the probability of all others. A common rest
        is drawn from the lattice until it fits, a rare one from the lattice less the ways left out. Either is exact."""
        into, mass = self.lattice(word)
        steps = lambda j: [(math.exp(mass[i] + w - mass[j]), i, w, own) for i, w, own in into[j]]

        def back(j: int, p: float, ids: list) -> tuple[float, bytes]:
            while j > 0:
                u, at = next(uniform), 0.0
                for x, i, w, own in steps(j):  # noqa: B007
                    at += x
                    if u < at:
                        break
                p += mass[i] + w - mass[j]
                ids.append(own)
                j = i
            return min(0.0, p), array("I", [x for own in reversed(ids) for x in own]).tobytes()

        if rest > 0.05:
            while (found := back(len(word), 0.0, []))[1] in without:
                pass
            return found
        # Nodes of the tree of what is left out, read from the end: (place in the lattice, ways left out and how much of each is left).
        nodes: list[tuple[int, list[tuple[bytes, int]]]] = [(len(word), [(seg, len(seg)) for seg in without])]
        arcs: list[list[tuple]] = []
        for j, barred in nodes:
            own_arcs = []
            for x, i, w, own in steps(j):
                tail = array("I", own).tobytes()
                left = [(seg, end - len(tail)) for seg, end in barred if seg.endswith(tail, 0, end) and (i > 0) == (end > len(tail))]
                child = None if not left else -1 if i == 0 else len(nodes)
                if child is not None and child >= 0:
                    nodes.append((i, left))
                own_arcs.append((x, i, w, own, child))
            arcs.append(own_arcs)
        # Share of a node's mass that is not left out: sums of what is there, no differences.
        free = [0.0] * (len(nodes) + 1)
        for n in range(len(nodes) - 1, -1, -1):
            free[n] = sum([x * (1.0 if c is None else free[c]) for x, _, _, _, c in arcs[n]])
        n, p, ids = 0, 0.0, []
        while True:
            u, chosen = next(uniform) * free[n], None
            for arc in arcs[n]:
                x = arc[0] * (1.0 if arc[4] is None else free[arc[4]])
                if x > 0:
                    chosen = arc
                    u -= x
                    if u < 0:
                        break
            if chosen is None:
                raise ValueError("every segmentation is left out")
            _, i, w, own, child = chosen
            p += mass[i] + w - mass[nodes[n][0]]
            ids.append(own)
            if child is None:
                return back(i, p, ids)
            n = child


def uniforms(seed: np.ndarray, round_: int, pos: np.ndarray) -> np.ndarray:
    """In (0, 1), by (seed, round, position)."""
    with np.errstate(over="ignore"):
        x = mix(mix(seed + np.uint64(0x9E3779B97F4A7C15) * np.uint64(2 * round_ + 1)) + pos.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _stream(seed: int, *where: int) -> Iterator[float]:
    """Uniform numbers one after the other, for the places where single draws are made."""
    m = 2**64 - 1
    for w in (*where, 0):
        seed = (seed + 0x9E3779B97F4A7C15 * (w + 1)) & m
        seed = ((seed ^ (seed >> 30)) * 0xBF58476D1CE4E5B9) & m
    while True:
        seed = (seed + 0x9E3779B97F4A7C15) & m
        x = ((seed ^ (seed >> 30)) * 0xBF58476D1CE4E5B9) & m
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
        yield (((x ^ (x >> 31)) >> 11) + 0.5) / 2.0**53


def _below(mass: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables with location mass, given that they are below top; minus infinity for no mass."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        g = mass - np.log(np.exp(mass - top) - np.log(u))
    return np.where(np.isfinite(mass), np.minimum(g, top), -np.inf)


def _difference(a: float, b: float) -> float:
    """a - b, 0 where it is rounding."""
    return a - b if a - b > 1e-9 * a else 0.0


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x))), the probability that a Gumbel variable at location x is above 0."""
    return x if x < -30 else 0.0 if x > 30 else math.log(-math.expm1(-math.exp(x)))


def sample(model: Pieces, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple[float, float, float, bytes]]]:
    """For each text its k segmentations, or all if there are fewer: (log-probability, perturbed, log of inclusion, ids)."""
    # Words, cut where no piece holds both sides (which is also where words end), as numbers of distinct ones.
    text = "".join([MARK + t.replace(" ", MARK) for t in texts if t])
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 if t else 0 for t in texts], out=begins[1:])
    cut = np.ones(len(codes) + 1, bool)
    cut[1:-1] = ~model.joins(model.letters(codes)) if len(codes) else cut[1:-1]
    cut[begins] = True
    starts = np.flatnonzero(cut)
    first = np.searchsorted(starts, begins)
    lengths, starts = np.diff(starts), starts[:-1]
    word, names = _numbered(codes, starts, lengths) if len(codes) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    name = lambda w: text[starts[names[w]] : starts[names[w]] + lengths[names[w]]]
    lists = model.lists(codes, starts[names], lengths[names])
    table, others, sizes = lists.logs, lists.others, np.isfinite(lists.logs).sum(axis=1)
    chance = np.exp(table)
    edges = np.cumsum(chance, axis=1)
    # Log of all that is not a word's segmentation c, as a sum of the others: 1 - p would lose what is rare.
    with np.errstate(divide="ignore"):
        spared = np.log(np.stack([np.delete(chance, c, axis=1).sum(axis=1) + others for c in range(LISTED)], axis=1)) if len(names) else table
    size = np.diff(first)
    doc, pos = np.repeat(np.arange(len(texts)), size), np.arange(len(word)) - np.repeat(first[:-1], size)
    seed = seeds[doc]
    own: dict[tuple[int, int], bytes] = {}  # segmentations that are not in the lists, by (round, token)

    def drawn(r: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in the list or LISTED, log-probability) of a fresh draw for tokens."""
        u = uniforms(seed[at], 2 * r, pos[at])
        c = np.zeros(len(at), np.int64)
        over = np.arange(len(at))
        for j in range(LISTED):
            over = over[u[over] >= edges[word[at[over]], j]]
            c[over] = j + 1
        # Where every segmentation is listed, rounding may leave a gap at the top.
        c = np.where((others[word[at]] == 0) & (c >= sizes[word[at]]), sizes[word[at]] - 1, c)
        p = table[word[at], np.minimum(c, LISTED - 1)]
        for j in np.flatnonzero(c >= LISTED).tolist():
            t = int(at[j])
            w = int(word[t])
            p[j], own[r, t] = model.draw(name(w), _stream(int(seed[t]), r, int(pos[t])), set(lists.segments(w)), float(others[w]))
        return c, p

    rounds = []  # (choice, log-probability, bound of the rest at each token), whole arrays
    out: list[list[tuple]] = [[] for _ in texts]
    top = -np.log(-np.log(uniforms(seeds, 1, np.zeros(len(texts)))))
    live = np.ones(len(texts), bool)
    start, prior = np.zeros(len(texts), np.int64), np.full(len(texts), -1)
    gone: dict[int, dict[bytes, float]] = {}  # what is excluded at the token of an open rest, by (token of its last round)
    for r in range(k + 1):
        if r:
            # Each text's best open rest: over all rounds and tokens.
            stack = np.stack([b for _, _, b in rounds])
            which = stack.argmax(axis=0) if len(word) else np.zeros(0, np.int64)
            value = stack.max(axis=0) if len(word) else np.zeros(0)
            for d in range(len(texts)):
                lo, hi = first[d], first[d + 1]
                if not live[d] or lo == hi:
                    live[d] = False
                    continue
                t = lo + int(value[lo:hi].argmax())
                top[d], prior[d], start[d] = value[t], which[t], t - lo
                live[d] = np.isfinite(value[t])
            if r == k:
                break
        at = np.flatnonzero(live[doc] & (pos >= (start[doc] + (1 if r else 0))))
        choice, logp, bound = np.full(len(word), -1), np.zeros(len(word)), np.full(len(word), -np.inf)
        choice[at], logp[at] = drawn(r, at)
        forced = np.full(len(texts), np.nan)
        if r:
            head = np.flatnonzero(live[doc] & (pos < start[doc]))
            for q in range(r):
                mine = head[prior[doc[head]] == q]
                choice[mine], logp[mine] = rounds[q][0][mine], rounds[q][1][mine]
                for t in mine[choice[mine] >= LISTED].tolist():
                    own[r, t] = own[q, t]
            for d in np.flatnonzero(live).tolist():
                t, q = int(first[d] + start[d]), int(prior[d])
                w = int(word[t])
                segs, logs = lists.segments(w), table[w, : sizes[w]].tolist()
                taken = gone.setdefault(t * (k + 1) + q, {})
                c = int(rounds[q][0][t])
                taken.setdefault(own[q, t] if c >= LISTED else segs[c], float(rounds[q][1][t]))
                left = [(x, s, i) for i, (x, s) in enumerate(zip(logs, segs, strict=True)) if s not in taken]
                listed_left = sum(math.exp(x) for x, _, _ in left)
                unlisted = max(0.0, float(others[w]) - sum(math.exp(x) for s, x in taken.items() if s not in segs))
                if others[w] > 0 and unlisted < 1e-6:
                    # So little is left that the difference above is noise; a short lattice can be summed up instead.
                    found, endless = model.best(model.lattice(name(w))[0], 256)
                    if not endless:
                        mass = model.lattice(name(w))[1][-1]
                        unlisted = sum(math.exp(x - mass) for x, s in found if s not in taken and s not in segs)
                uni = _stream(int(seeds[d]), 1000 + r, int(start[d]))
                u = next(uni) * (listed_left + unlisted)
                for x, s, i in left:
                    u -= math.exp(x)
                    if u < 0:
                        choice[t], logp[t] = i, x
                        break
                else:
                    if unlisted > 0:
                        logp[t], own[r, t] = model.draw(name(w), uni, {*segs, *taken}, unlisted)
                        choice[t] = LISTED
                    else:
                        choice[t], logp[t] = left[-1][2], left[-1][0]
                more = dict(taken) | {(own[r, t] if choice[t] >= LISTED else segs[choice[t]]): float(logp[t])}
                gone[t * (k + 1) + r] = more
                rest = sum(math.exp(x) for x, _, i in left if i != choice[t]) + (unlisted if choice[t] < LISTED else _difference(unlisted, math.exp(logp[t])))
                forced[d] = math.log(rest) if rest > 0 else -math.inf
                rounds[q][2][t] = -np.inf
        total = np.zeros(len(word) + 1)
        np.cumsum(logp, out=total[1:])
        before = total[:-1] - total[first[:-1]][doc] if len(word) else total[:-1]
        span = np.flatnonzero(live[doc] & (pos >= start[doc])) if len(word) else np.zeros(0, np.int64)
        c = choice[span]
        rest = spared[word[span], np.minimum(c, LISTED - 1)] if len(word) else np.zeros(0)
        for j in np.flatnonzero(c >= LISTED).tolist():
            t = span[j]
            left_over = float(chance[word[t]].sum()) + _difference(float(others[word[t]]), math.exp(logp[t]))
            rest[j] = math.log(left_over) if left_over > 0 else -math.inf
        if r:
            here = pos[span] == start[doc[span]]
            rest = np.where(here, forced[doc[span]], rest)
        bound[span] = _below(before[span] + rest, top[doc[span]], uniforms(seed[span], 2 * r + 1, pos[span]))
        rounds.append((choice, logp, bound))
        # Ids of the live texts, one after the other; those that are in no list stand behind the lists.
        on = np.flatnonzero(live[doc])
        c = choice[on]
        new = np.flatnonzero(c >= LISTED)
        extra = [own[r, t] for t in on[new].tolist()]
        at, many = lists.at[word[on], np.minimum(c, LISTED - 1)], lists.size[word[on], np.minimum(c, LISTED - 1)]
        many[new] = [len(x) // 4 for x in extra]
        at[new] = len(lists.ids) + np.cumsum(many[new]) - many[new]
        upto = np.zeros(len(on) + 1, np.int64)
        np.cumsum(many, out=upto[1:])
        pool = np.concatenate([lists.ids, np.frombuffer(b"".join(extra), np.uint32)])
        ids, lo = pool[np.repeat(at - upto[:-1], many) + np.arange(upto[-1])].tobytes(), 0
        for d in np.flatnonzero(live).tolist():
            hi = lo + int(size[d])
            out[d].append((float(total[first[d + 1]] - total[first[d]]), float(top[d]), ids[4 * int(upto[lo]) : 4 * int(upto[hi])]))
            lo = hi
    done = []
    for d, rows in enumerate(out):
        # The bound of the best that was left out, or nothing if all are in.
        kappa = top[d] if live[d] else -math.inf
        done.append([(p, g, _log_inclusion(p - kappa), ids) for p, g, ids in rows])
    return done


OUT = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, log_inclusion double"


def row_seeds(keys: list, seed: int) -> np.ndarray:
    """A null key is a key of its own."""
    x = np.array([0 if k is None else (int(k) & (2**64 - 1)) for k in keys], dtype=np.uint64)
    null = np.array([k is None for k in keys], dtype=np.uint64)
    return mix(mix(x) + np.uint64(seed) * np.uint64(2) + null)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > 4 * BLOCK:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


@lru_cache(2)
def _pieces(path: str, alpha: float) -> Pieces:
    return Pieces(path, alpha)


def _sample_batches(path: str, k: int, alpha: float, seed: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(path, alpha)
        for b in batches:
            keys, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            seeds = row_seeds(keys, seed)
            for lo, hi in _blocks(texts):
                rows = [(key, i, s) for key, got in zip(keys[lo:hi], sample(model, texts[lo:hi], seeds[lo:hi], k), strict=True) for i, s in enumerate(got)]
                ids = [s[3] for _, _, s in rows]
                columns = [
                    pa.array([x for x, _, _ in rows], pa.int64()), pa.array([i for _, i, _ in rows], pa.int32()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()), *(pa.array([s[j] for _, _, s in rows], pa.float64()) for j in range(3)),
                ]
                names = [x.split()[0] for x in OUT.split(", ")]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, np.uint32).astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encoded(docs: DataFrame, model: str, samples: int = 2, alpha: float = 1.0, seed: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per row of docs and sample: doc_id, sample (0 is the best), n_pieces, ids_crc32 (of 32-bit ids), log_prob,
    perturbed, log_inclusion (log of the probability to be in the sample), and with_ids the ids.

    The samples of a row are distinct; a text with fewer segmentations gives all of them, with log_inclusion 0. Null and empty
    texts have one, without pieces. Rows with one doc_id and text give one result; a null doc_id has a seed of its own. An
    empty table gives an empty result; other columns are ignored. The mark U+2581 in a text counts as a space.
    """
    return keyed_texts(docs).mapInArrow(_sample_batches(model, samples, alpha, seed, with_ids), OUT + (", ids array<int>" if with_ids else ""))


def decoded(df: DataFrame, model: str, ids: str = "ids", to: str = "text") -> DataFrame:
    """df with the text of its ids; null where they are null."""
    names = [c for c in df.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for b in batches:
            texts = [None if x is None else sp.decode(x) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, to])

    fields = [f for f in df.schema.fields if f.name != to]
    from pyspark.sql.types import StringType, StructField, StructType

    return df.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(run, StructType([*fields, StructField(to, StringType())]))

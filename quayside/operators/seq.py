"""Operators with feedback, as ordered folds per group: strategies, zig-zag labels, book reconstruction, throttling and the
original's volume clock. Each group is one instrument (and day where given); groups run in parallel."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEYS = ("exchange", "symbol")


def fold(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], new: dict[str, str], keys=KEYS, order=("ms", "seq")) -> DataFrame:
    """df with the columns that fn adds to each group, which it sees in order."""
    schema = T.StructType([*df.schema.fields, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in new.items())])
    names = [*df.columns, *new]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(pdf.sort_values(list(order), kind="stable").reset_index(drop=True))[names]

    return df.groupBy(*keys).applyInPandas(run, schema)


def _machine(n: int, enter: Callable[[int], int], leave: Callable[[int, int, int], bool], ready: Callable[[int, int], bool]) -> np.ndarray:
    """Positions of a machine that may leave and, in the same row, enter again. leave(i, entry, position); ready(i, last exit)."""
    out = np.zeros(n, dtype=np.int64)
    position = entry = 0
    left = -(10**9)
    for i in range(n):
        if position and leave(i, entry, position):
            position, left = 0, i
        if not position and ready(i, left):
            position = enter(i)
            entry = i if position else entry
        out[i] = position
    return out


@dataclass(frozen=True)
class Threshold:
    """Enter beyond +-entry_z (against the signal if contrary), leave within exit_z or after max_hold rows."""

    entry_z: float = 1.5
    exit_z: float = 0.5
    max_hold: int = 30
    contrary: bool = False

    def positions(self, s: np.ndarray) -> np.ndarray:
        s = -s if self.contrary else s
        enter = lambda i: 1 if s[i] > self.entry_z else -1 if s[i] < -self.entry_z else 0
        leave = lambda i, e, p: i >= e + self.max_hold or (s[i] < self.exit_z if p == 1 else s[i] > -self.exit_z)
        return _machine(len(s), enter, leave, lambda i, x: True)


def imbalance(entry_z: float = 1.5, exit_z: float = 0.5, max_hold: int = 30) -> Threshold:
    return Threshold(entry_z, exit_z, max_hold)


def mean_reversion(entry_z: float = 2.0, exit_z: float = 0.5, max_hold: int = 300) -> Threshold:
    return Threshold(entry_z, exit_z, max_hold, contrary=True)


@dataclass(frozen=True)
class Regression:
    """Enter beyond +-threshold, hold for hold rows, then wait cooldown rows."""

    threshold: float = 0.0005
    hold: int = 60
    cooldown: int = 30

    def positions(self, s: np.ndarray) -> np.ndarray:
        enter = lambda i: 1 if s[i] > self.threshold else -1 if s[i] < -self.threshold else 0
        return _machine(len(s), enter, lambda i, e, p: i >= e + self.hold, lambda i, x: i >= x + self.cooldown)


@dataclass(frozen=True)
class Direction:
    """Long at or above one probability, short at or below another, for hold rows."""

    long_above: float = 0.6
    short_below: float = 0.4
    hold: int = 1

    def positions(self, s: np.ndarray) -> np.ndarray:
        enter = lambda i: 1 if s[i] >= self.long_above else -1 if s[i] <= self.short_below else 0
        return _machine(len(s), enter, lambda i, e, p: i >= e + self.hold, lambda i, x: True)


@dataclass(frozen=True)
class Selective:
    """Enter only at the signal's extreme percentiles; hold rows, then gap rows of pause."""

    percentile: float = 99.5
    hold: int = 10
    gap: int = 10

    def positions(self, s: np.ndarray) -> np.ndarray:
        if not np.isfinite(s).any():
            return np.zeros(len(s), dtype=np.int64)
        hi, lo = np.nanpercentile(s, self.percentile), np.nanpercentile(s, 100 - self.percentile)
        enter = lambda i: 1 if s[i] >= hi else -1 if s[i] <= lo else 0
        return _machine(len(s), enter, lambda i, e, p: i >= e + self.hold, lambda i, x: i >= x + self.gap)


STRATEGIES = {"imbalance": imbalance, "mean_reversion": mean_reversion, "regression": Regression, "direction": Direction, "ultra_selective": Selective}


def positions(df: DataFrame, strategy, signal: str, keys=KEYS) -> DataFrame:
    return fold(df, lambda p: p.assign(position=strategy.positions(p[signal].to_numpy(float))), {"position": "long"}, keys)


def params(strategy) -> dict:
    return asdict(strategy)


def zigzag_labels(price: np.ndarray, min_profit: float = 0.002, fee: float = 0.001) -> np.ndarray:
    """1 at lows before a rise and -1 at highs before a fall of more than min_profit + 2 fee."""
    out, move = np.zeros(len(price), dtype=np.int64), min_profit + 2 * fee
    if not len(price):
        return out
    seek, at, best = 1, 0, price[0]
    for i, p in enumerate(price):
        if seek * (p - best) < 0:
            best, at = p, i
        if seek * (p - best * (1 + seek * move)) > 0:
            out[at] = seek
            seek, at, best = -seek, i, p
    return out


def optimal_trades(df: DataFrame, price: str, keys=KEYS, **kw) -> DataFrame:
    return fold(df, lambda p: p.assign(label=zigzag_labels(p[price].to_numpy(float), **kw)), {"label": "long"}, keys)


def volatility_regime(df: DataFrame, log_return: str, window: int = 300, keys=KEYS) -> DataFrame:
    """rv of the window rows before, and regime 0, 1, 2 by the 33rd and 67th percentile of all earlier rv: a sorted insert."""
    import bisect

    def run(p: pd.DataFrame) -> pd.DataFrame:
        rv = p[log_return].astype(float).rolling(window).std(ddof=0).shift(1).to_numpy()
        regime, seen = np.ones(len(p), dtype=np.int64), []
        for i, x in enumerate(rv):
            if np.isnan(x):
                continue
            if len(seen) >= 2:
                at = lambda q: seen[int(q * (len(seen) - 1))] * (1 - (f := q * (len(seen) - 1) % 1)) + seen[min(len(seen) - 1, int(q * (len(seen) - 1)) + 1)] * f
                regime[i] = 0 if x <= at(0.33) else 2 if x >= at(0.67) else 1
            bisect.insort(seen, x)
        return p.assign(rv=rv, vol_regime=regime)

    return fold(df, run, {"rv": "double", "vol_regime": "long"}, keys)


def throttle(df: DataFrame, least_ms: int = 1000, keys=KEYS) -> DataFrame:
    """Adds emit: true for rows at least least_ms after the last that was emitted."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        out, last = np.zeros(len(p), dtype=bool), None
        for i, t in enumerate(p["ms"].to_numpy()):
            if last is None or t - last >= least_ms:
                out[i], last = True, t
        return p.assign(emit=out)

    return fold(df, run, {"emit": "boolean"}, keys)


def vpin_parity(df: DataFrame, bucket: float, buckets: int = 50, keys=KEYS) -> DataFrame:
    """The volume clock as the original loop has it, which loses volume when a trade spans buckets. One row per trade."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        out, full, cur, last = [], [], [0.0, 0.0, 0.0], None
        for price, volume, side in zip(p["price"], p["amount"], p["side"], strict=True):
            share = (1.0 if str(side).lower() == "buy" else 0.0) if side is not None else 0.5 if last is None or price == last else float(price > last)
            flows, left, last = [volume * share, volume * (1 - share)], volume, price
            while left > 0:
                take = min(left, bucket - cur[0])
                ratio, done = take / volume, left >= bucket - cur[0]
                cur = [cur[0] + take, cur[1] + flows[0] * ratio, cur[2] + flows[1] * ratio]
                left -= take
                if done:
                    full.append(abs(cur[1] - cur[2]) / bucket)
                    cur, flows = [0.0, 0.0, 0.0], [x * (1 - ratio) for x in flows]
            out.append(float(np.mean(full[-buckets:])) if full else 0.0)
        return p.assign(vpin=out)

    return fold(df, run, {"vpin": "double"}, keys)


def rebuild_book(updates: DataFrame, keys=("product_id",)) -> DataFrame:
    """Best prices and sizes after each L2 update (side, price_level, new_quantity, event_type), in (sequence_num, event_ms) order.

    A quantity of 0 removes a level on update; a snapshot adds to the book and removes nothing.
    """
    new = {c: "double" for c in ("best_bid_price", "best_bid_size", "best_ask_price", "best_ask_size", "mid_price", "spread", "spread_bps")}

    def run(p: pd.DataFrame) -> pd.DataFrame:
        book: dict[str, dict] = {"b": {}, "a": {}}
        rows = []
        for side, price, qty, kind in zip(p["side"].str.lower(), p["price_level"], p["new_quantity"], p["event_type"], strict=True):
            own = book["b" if side in ("bid", "bids") else "a"] if side in ("bid", "bids", "ask", "asks", "offer") else {}
            if qty > 0 and kind in ("snapshot", "update"):
                own[price] = qty
            elif kind == "update":
                own.pop(price, None)
            if book["b"] and book["a"]:
                b, a = max(book["b"]), min(book["a"])
                mid = (a + b) / 2
                rows.append((b, book["b"][b], a, book["a"][a], mid, a - b, (a - b) / mid * 10000))
            else:
                rows.append((np.nan,) * 7)
        return p.assign(**dict(zip(new, np.array(rows, dtype=float).reshape(-1, 7).T, strict=True)))

    return fold(updates, run, new, keys, ("sequence_num", "event_ms"))

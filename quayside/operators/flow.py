"""Path-dependent features per instrument as window expressions: order flow, realised volatility, regimes, price impact."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.functions.exprs import sdiv, sln
from quayside.operators.windows import KEYS, interleave, last_seconds, ordered, spread_percentile, tie_corrected_sum

GAP_MS = 300_000


def _prev(x: str | Column, gap_ms: int, keys=KEYS) -> Column:
    """The value of the row before, null after a gap."""
    w = ordered(keys)
    return F.when(F.col("ms") - F.lag("ms").over(w) <= gap_ms, F.lag(x).over(w))


def _side_flow(price: Column, size: Column, price0: Column, size0: Column, bid: bool) -> Column:
    up, down = (size, -size0) if bid else (-size0, size)
    return F.when(price > price0, up).when(price < price0, down).otherwise(size - size0)


def order_flow(df: DataFrame, levels: int = 10, alpha: float = 0.5, gap_ms: int = GAP_MS, keys=KEYS) -> DataFrame:
    """Adds ofi, mlofi (levels weighted by exp(-alpha i)), ofi_multi (weights 1), log_return; 0 without a previous snapshot.
    Snapshots with an empty side are left out. Keys with a day start anew each day instead of carrying the last snapshot over."""
    d = df.filter("size(bids) > 0 AND size(asks) > 0")
    d = d.withColumns({"_b": F.slice("bids", 1, levels), "_a": F.slice("asks", 1, levels)})
    d = d.withColumns({"_pb": _prev("_b", gap_ms, keys), "_pa": _prev("_a", gap_ms, keys), "_pm": _prev("mid_price", gap_ms, keys)})
    b, a = (F.col(c) for c in ("_b", "_a"))

    def flow(weight: str) -> Column:
        def side(cur: str, prev: str, up: str, down: str) -> str:
            n = f"least(size({cur}), size({prev}))"
            return f"""zip_with(slice({cur}, 1, {n}), slice({prev}, 1, {n}), (x, y) ->
                CASE WHEN x.price > y.price THEN {up} WHEN x.price < y.price THEN {down} ELSE x.size - y.size END)"""

        total = lambda s: f"aggregate(transform({s}, (v, i) -> v * {weight}), 0D, (t, v) -> t + v)"
        bid, ask = side("_b", "_pb", "x.size", "-y.size"), side("_a", "_pa", "-y.size", "x.size")
        return F.coalesce(F.expr(f"{total(bid)} - {total(ask)}"), F.lit(0.0))

    top = [F.get(c, F.lit(0)) for c in (b, a, F.col("_pb"), F.col("_pa"))]
    bid = _side_flow(top[0]["price"], top[0]["size"], top[2]["price"], top[2]["size"], True)
    ask = _side_flow(top[1]["price"], top[1]["size"], top[3]["price"], top[3]["size"], False)
    return d.withColumns({
        "ofi": F.coalesce(F.when(F.col("_pm").isNotNull(), bid - ask), F.lit(0.0)),
        "mlofi": flow(f"exp(-{alpha}D * i)"), "ofi_multi": flow("1D"),
        "log_return": F.coalesce(sln("mid_price") - sln("_pm"), F.lit(0.0)),
    }).drop("_b", "_a", "_pb", "_pa", "_pm")


def motion(df: DataFrame, x: str = "mid_price") -> DataFrame:
    """Velocity and acceleration from the last three rows, per second; they survive gaps."""
    w = ordered()
    t, p = ([F.lag(c, k).over(w) if k else F.col(c) for k in range(3)] for c in ("ms", x))
    v1, v0 = sdiv((p[0] - p[1]) * 1000, t[0] - t[1]), sdiv((p[1] - p[2]) * 1000, t[1] - t[2])
    return df.withColumns({"mid_velocity": v1, "mid_accel": sdiv((v1 - v0) * 1000, t[0] - t[1])})


def rolling_flow(df: DataFrame, seconds: tuple[int, ...] = (5, 15, 60, 300, 900)) -> DataFrame:
    out = {}
    for h in seconds:
        w = last_seconds(h)
        out |= {
            f"ofi_sum_{h}s": tie_corrected_sum(F.col("ofi"), h), f"mlofi_sum_{h}s": tie_corrected_sum(F.col("mlofi"), h),
            f"rv_{h}s": F.coalesce(F.stddev_samp("log_return").over(w), F.lit(0.0)),
        }
    return df.withColumns(out)


def trade_flow(snapshots: DataFrame, trades: DataFrame, seconds: tuple[int, ...] = (60, 300), per_event: bool = False) -> DataFrame:
    """Adds tfi_{h}s and trade_vol_{h}s: trades count at the first snapshot at or after them. per_event: also tfi, buy_volume,
    sell_volume and trade_volume of the trades since the snapshot before."""
    buy = F.lower("side") == "buy"
    at = interleave(trades.select(*KEYS, "ms", "seq", "amount", "side"), snapshots).groupBy(*KEYS, F.col("snapshot_seq").alias("seq")).agg(
        F.sum(F.when(buy, F.col("amount")).otherwise(0.0)).alias("_buy"), F.sum(F.when(~buy, F.col("amount")).otherwise(0.0)).alias("_sell")
    )
    d = snapshots.join(at, [*KEYS, "seq"], "left").fillna(0.0, ["_buy", "_sell"])
    out = {}
    for h in seconds:
        w = last_seconds(h)
        b, s = F.sum("_buy").over(w), F.sum("_sell").over(w)
        out |= {f"tfi_{h}s": F.coalesce(sdiv(b - s, b + s), F.lit(0.0)), f"trade_vol_{h}s": b + s}
    if per_event:
        b, s = F.col("_buy"), F.col("_sell")
        out |= {"tfi": F.coalesce(sdiv(b - s, b + s), F.lit(0.0)), "buy_volume": b, "sell_volume": s, "trade_volume": b + s}
    return d.withColumns(out).drop("_buy", "_sell")


def near_depth(df: DataFrame, seconds: int = 300) -> DataFrame:
    """Adds variance and deviation of the size at both best prices over the window; 0 for fewer than two snapshots."""
    var = F.coalesce(F.var_samp(F.col("top_bid_size") + F.col("top_ask_size")).over(last_seconds(seconds)), F.lit(0.0))
    return df.withColumns({"depth_variance_5m": var, "depth_sigma_5m": F.sqrt(var)})


def book_statistics(df: DataFrame, seconds: int = 60, depth_seconds: int = 300) -> DataFrame:
    """Adds rolling mean and deviation of both slopes and of the centre of gravity against mid, and the deviation of the depth within
    5 basis points. Columns that df lacks are left out; nulls do not count; an empty window gives 0."""
    w, out = last_seconds(seconds), {}
    for c, name in (("bid_slope_regression", "bid_slope"), ("ask_slope_regression", "ask_slope"), ("cog_vs_mid", "cog_momentum")):
        if c in df.columns:
            out |= {f"{name}_mean_{seconds}s": F.coalesce(F.avg(c).over(w), F.lit(0.0)), f"{name}_std_{seconds}s": F.coalesce(F.stddev_samp(c).over(w), F.lit(0.0))}
    for bid, ask in (("bid_vol_band_0_5bps", "ask_vol_band_0_5bps"), ("bid_volume_0_5bps", "ask_volume_0_5bps")):
        if bid in df.columns and ask in df.columns:
            depth = F.coalesce(bid, F.lit(0.0)) + F.coalesce(ask, F.lit(0.0))
            out["depth_0_5bps_sigma"] = F.coalesce(F.stddev_samp(depth).over(last_seconds(depth_seconds)), F.lit(0.0))
            break
    return df.withColumns(out)


def spread_regime(df: DataFrame, seconds: int = 300, tight: float = 0.2, wide: float = 0.8) -> DataFrame:
    """Adds spread_percentile, spread_regime and the share of time in tight and wide regimes over the window. A duration is
    credited to the regime that held before."""
    w = ordered()
    d = df.withColumn("spread_percentile", F.coalesce(spread_percentile("relative_spread", seconds), F.lit(0.5)))
    p = F.col("spread_percentile")
    d = d.withColumn("spread_regime", F.when(p <= tight, "tight").when(p >= wide, "wide").otherwise("normal"))
    d = d.withColumns({"_r": F.lag("spread_regime").over(w), "_d": (F.col("ms") - F.lag("ms").over(w)) / 1000})
    win = last_seconds(seconds)
    share = lambda r: F.coalesce(sdiv(F.sum(F.when(F.col("_r") == r, F.col("_d")).otherwise(0.0)).over(win), F.sum("_d").over(win)), F.lit(0.0))
    return d.withColumns({"tight_spread_pct": share("tight"), "wide_spread_pct": share("wide")}).drop("_r", "_d")


def static_regime(df: DataFrame, threshold: float = 1e-4) -> DataFrame:
    return df.withColumn("spread_regime", F.when(F.col("relative_spread") <= threshold, "tight").otherwise("wide"))


def kyle_lambda(df: DataFrame, seconds: int = 300, least_var: float = 1e-10) -> DataFrame:
    """Slope of log_return on ofi over the window, and its r squared; 0 where the flow does not vary."""
    w = last_seconds(seconds)
    n, cov, vx, vy = F.count("ofi").over(w), F.covar_pop("log_return", "ofi").over(w), F.var_pop("ofi").over(w), F.var_pop("log_return").over(w)
    d = df.withColumns({"_n": n, "_c": cov, "_x": vx, "_y": vy})
    ok = (F.col("_n") >= 2) & (F.col("_x") >= least_var)
    return d.withColumns({
        "kyle_lambda": F.when(ok, F.col("_c") / F.col("_x")).otherwise(0.0),
        "kyle_lambda_r2": F.when(ok & (F.col("_y") >= least_var), F.col("_c") * F.col("_c") / F.col("_x") / F.col("_y")).otherwise(0.0),
    }).drop("_n", "_c", "_x", "_y")


def rolling_stats(df: DataFrame, x: str, name: str, seconds: int) -> DataFrame:
    w = last_seconds(seconds)
    return df.withColumns({f"{name}_mean_{seconds}s": F.avg(x).over(w), f"{name}_std_{seconds}s": F.coalesce(F.stddev_samp(x).over(w), F.lit(0.0))})


def vpin(trades: DataFrame, bucket: float, buckets: int = 50) -> DataFrame:
    """exchange, symbol, bucket, buy_volume, sell_volume, vpin of each full bucket of the volume clock, in closed form.

    Trades are laid end to end on the axis of cumulative volume; a trade that spans buckets is split by where they end, so
    volume is conserved. A missing side follows the tick rule, half and half where the price did not move.
    """
    w = ordered()
    prev = F.lag("price").over(w)
    tick = F.when(F.col("price") > prev, 1.0).when(F.col("price") < prev, 0.0).otherwise(0.5)
    d = trades.filter("amount > 0").withColumns({
        "_buy": F.when(F.col("side").isNull(), tick).when(F.lower("side") == "buy", 1.0).otherwise(0.0), "_hi": F.sum("amount").over(w),
    })
    d = d.withColumn("_lo", F.col("_hi") - F.col("amount"))
    first, last = F.floor(F.col("_lo") / bucket), F.floor(F.col("_hi") / bucket)
    d = d.withColumn("bucket", F.explode(F.sequence(first, last)))
    part = F.least(F.col("_hi"), (F.col("bucket") + 1) * bucket) - F.greatest(F.col("_lo"), F.col("bucket") * bucket)
    b = d.withColumn("_v", part).groupBy(*KEYS, "bucket").agg(F.sum(F.col("_v") * F.col("_buy")).alias("buy_volume"), F.sum("_v").alias("_t"))
    b = b.filter(F.col("_t") >= bucket * (1 - 1e-9)).withColumn("sell_volume", F.col("_t") - F.col("buy_volume"))
    recent = Window.partitionBy(*KEYS).orderBy("bucket").rowsBetween(-(buckets - 1), 0)
    return b.withColumn("vpin", F.avg(F.abs(F.col("buy_volume") - F.col("sell_volume")) / bucket).over(recent)).drop("_t")


def volume_bars(trades: DataFrame, threshold: float) -> DataFrame:
    """One bar per threshold of cumulative volume, trades split at its ends, in the closed form of vpin."""
    w = ordered()
    d = trades.filter("amount > 0").withColumn("_hi", F.sum("amount").over(w)).withColumn("_lo", F.col("_hi") - F.col("amount"))
    d = d.withColumn("bar", F.explode(F.sequence(F.floor(F.col("_lo") / threshold), F.floor(F.col("_hi") / threshold))))
    d = d.withColumn("_v", F.least(F.col("_hi"), (F.col("bar") + 1) * threshold) - F.greatest(F.col("_lo"), F.col("bar") * threshold)).filter("_v > 0")
    key = F.struct("ms", "seq")
    return d.groupBy(*KEYS, "bar").agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", key).alias("close"),
        F.sum("_v").alias("volume"), F.count("*").alias("trade_count"), F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms"),
        sdiv(F.sum(F.col("price") * F.col("_v")), F.sum("_v")).alias("vwap"),
        sdiv(F.sum(F.when(F.lower("side") == "buy", F.col("_v")).otherwise(0.0)), F.sum("_v")).alias("buy_ratio"),
    ).filter(F.col("volume") >= threshold * (1 - 1e-9)).withColumn("duration", (F.col("end_ms") - F.col("start_ms")) / 1000)


def hit_count(df: DataFrame, seconds: int = 300) -> DataFrame:
    return df.withColumn("hits", F.count("*").over(last_seconds(seconds)))


def annualised(variance: Column, bar_seconds: int) -> Column:
    return F.sqrt(variance) * math.sqrt(86400 / bar_seconds)

"""Snapshot features over price-level arrays, without exploding levels to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.exprs import level, sdiv, top_sum

#: Levels that stand for a band of basis points in the index form of bands.
BAND_LEVELS = {(0, 5): (0, 2), (5, 10): (2, 4), (10, 25): (4, 7), (25, 50): (7, 12), (50, 100): (12, 20)}
DECAY = 100.0


def _imbalance(b: Column, a: Column) -> Column:
    return sdiv(b - a, b + a)


def top_of_book(df: DataFrame) -> DataFrame:
    """Best prices and sizes, mid, spreads and the size-weighted mid; null on an empty side."""
    best = lambda side, what: F.get(F.col(side), F.lit(0)).getField(what)
    d = df.withColumns({
        "best_bid": best("bids", "price"), "best_ask": best("asks", "price"), "top_bid_size": best("bids", "size"), "top_ask_size": best("asks", "size"),
    })
    b, a, bs, az = (F.col(c) for c in ("best_bid", "best_ask", "top_bid_size", "top_ask_size"))
    d = d.withColumns({"mid_price": (b + a) / 2, "spread": a - b})
    return d.withColumns({
        "relative_spread": sdiv("spread", "mid_price"), "spread_bps": sdiv(F.col("spread") * 10000, "mid_price"),
        "microprice": sdiv(b * az + a * bs, bs + az), "imbalance_L1": _imbalance(bs, az),
        "micro_minus_mid": sdiv(b * az + a * bs, bs + az) - F.col("mid_price"),
    })


def structural(df: DataFrame, levels: int = 20, parity: bool = False) -> DataFrame:
    """All structural features of each snapshot. parity: level 1 carries level 0's size, as the original computes it."""
    d = df
    if parity:
        fix = "transform({s}, (x, i) -> CASE WHEN i = 1 THEN named_struct('price', x.price, 'size', {s}[0].size) ELSE x END)"
        d = d.withColumns({s: F.expr(fix.format(s=s)) for s in ("bids", "asks")})
    d = top_of_book(d)
    n5, n20 = min(5, levels), min(20, levels)
    near = f"x.size * exp(-{DECAY}D * abs(x.price - mid_price) / mid_price)"
    sums: dict[str, Column] = {}
    for side, s in (("bid", "bids"), ("ask", "asks")):
        sums |= {
            f"total_{side}_depth": top_sum(s, levels), f"total_{side}_volume": top_sum(s, levels, "x.price * x.size"),
            f"smart_{side}_depth": top_sum(s, n20, near), f"_{side}_pv5": top_sum(s, n5, "x.price * x.size"),
            f"_{side}_sq": top_sum(s, levels, "x.size * x.size"),
        } | {f"_{side}_{n}": top_sum(s, n) for n in (3, 5, 6, 10)}
    d = d.withColumns(sums)
    c = F.col
    out = {"total_imbalance": _imbalance(c("total_bid_depth"), c("total_ask_depth")), "smart_depth_imbalance": _imbalance(c("smart_bid_depth"), c("smart_ask_depth"))}
    out["book_pressure"] = out["total_imbalance"]
    for side, s in (("bid", "bids"), ("ask", "asks")):
        out |= {
            f"vwap_{side}_5": sdiv(f"_{side}_pv5", f"_{side}_5"),
            f"{side}_slope": sdiv(F.abs(level(s, 0, "price") - level(s, 4, "price")), f"_{side}_5") if levels >= 5 else F.lit(None).cast("double"),
            f"{side}_depth_decay_5": sdiv(level(s, 4, "size"), level(s, 0, "size")) if levels >= 5 else F.lit(None).cast("double"),
            f"{side}_concentration": sdiv(f"_{side}_sq", c(f"total_{side}_depth") * c(f"total_{side}_depth")),
        }
    out |= {
        "vwap_spread": out["vwap_ask_5"] - out["vwap_bid_5"], "avg_depth_decay_5": (out["bid_depth_decay_5"] + out["ask_depth_decay_5"]) / 2,
        "center_of_gravity": sdiv(c("total_bid_volume") + c("total_ask_volume"), c("total_bid_depth") + c("total_ask_depth")),
        "lambda_like": sdiv("spread", c("_bid_3") + c("_ask_3")), "amihud_like": sdiv("spread", c("_bid_6") + c("_ask_6")),
    }
    out["cog_vs_mid"] = sdiv((out["center_of_gravity"] - c("mid_price")) * 10000, "mid_price")
    out |= {f"imbalance_L{n}": _imbalance(c(f"_bid_{n}"), c(f"_ask_{n}")) for n in (3, 5, 10) if n <= levels}
    return d.withColumns(out).drop(*(x for x in sums if x[0] == "_"))


def level_columns(df: DataFrame, levels: int, missing: float | None = 0.0) -> DataFrame:
    """Prices and sizes of the first levels as columns; a level that is not there is 0, or null where missing is None."""
    at = (lambda s, i, what: F.get(F.col(s), F.lit(i)).getField(what)) if missing is None else level
    return df.withColumns({f"{side}_{what}_L{i}": at(s, i, what) for side, s in (("bid", "bids"), ("ask", "asks")) for what in ("price", "size") for i in range(levels)})


def index_bands(df: DataFrame, bands: tuple[int, ...] = (5, 10, 25, 50, 100)) -> DataFrame:
    """Volume of the levels that stand for each adjacent pair of bands, and its imbalance."""
    out = {}
    for a, b in zip((0, *bands), bands):
        if (a, b) in BAND_LEVELS:
            lo, hi = BAND_LEVELS[a, b]
            v = [F.expr(f"aggregate(slice({s}, {lo + 1}, {hi - lo}), 0D, (a, x) -> a + coalesce(x.size, 0D))") for s in ("bids", "asks")]
            out |= {f"bid_vol_band_{a}_{b}bps": v[0], f"ask_vol_band_{a}_{b}bps": v[1], f"imb_band_{a}_{b}bps": _imbalance(*v)}
    return df.withColumns(out)


def exact_bands(df: DataFrame, bands: tuple[int, ...] = (5, 10, 25, 50, 100)) -> DataFrame:
    """Volume whose distance from mid_price lies in [a, b) basis points. Needs mid_price."""
    dist = "abs(x.price - mid_price) / mid_price * 10000"
    out = {}
    for a, b in zip((0, *bands), bands):
        v = [F.expr(f"aggregate(filter({s}, x -> {dist} >= {a} AND {dist} < {b}), 0D, (a, x) -> a + coalesce(x.size, 0D))") for s in ("bids", "asks")]
        out |= {f"bid_volume_{a}_{b}bps": v[0], f"ask_volume_{a}_{b}bps": v[1], f"imbalance_{a}_{b}bps": _imbalance(*v)}
    return df.withColumns(out)


def convexity(df: DataFrame) -> DataFrame:
    """Volume within 5 basis points over volume within 50."""
    dist = "abs(x.price - mid_price) / mid_price * 10000"
    within = lambda b: F.expr(f"aggregate(filter(concat(bids, asks), x -> {dist} <= {b}), 0D, (a, x) -> a + coalesce(x.size, 0D))")
    return df.withColumn("book_convexity", sdiv(within(5), within(50)))


def half_depth_levels(df: DataFrame) -> DataFrame:
    """Number of levels that hold half of a side's size."""
    n = "size(filter(sequence(1, size({s})), i -> aggregate(slice({s}, 1, i), 0D, (a, x) -> a + x.size) < 0.5D * aggregate({s}, 0D, (a, x) -> a + x.size))) + 1"
    return df.withColumns({f"{side}_50pct_depth_levels": F.expr(f"CASE WHEN size({s}) > 0 THEN {n.format(s=s)} ELSE 0 END") for side, s in (("bid", "bids"), ("ask", "asks"))})


def slope_regression(df: DataFrame, levels: int = 10) -> DataFrame:
    """Least-squares slope of cumulative size on distance in basis points over the first levels; null under 3 levels."""
    d = df
    for side, s in (("bid", "bids"), ("ask", "asks")):
        top = f"slice({s}, 1, {levels})"
        xy = f"transform({top}, (x, i) -> named_struct('x', abs(x.price - mid_price) / mid_price * 10000, 'y', aggregate(slice({s}, 1, i + 1), 0D, (a, v) -> a + v.size)))"
        total = lambda t: f"aggregate(xy, 0D, (a, p) -> a + {t})"  # noqa: E731, B023
        d = d.withColumn("xy", F.expr(xy))
        n = F.size("xy")
        sx, sy, sxy, sxx = (F.expr(total(t)) for t in ("p.x", "p.y", "p.x * p.y", "p.x * p.x"))
        d = d.withColumn(f"{side}_slope_regression", F.when(n >= 3, sdiv(n * sxy - sx * sy, n * sxx - sx * sx))).drop("xy")
    return d.withColumn("slope_asymmetry", F.col("bid_slope_regression") - F.col("ask_slope_regression"))

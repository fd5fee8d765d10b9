"""Row features of tickers and trades, their rolling aggregates, vendor variants and engineered interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.exprs import date_parts, day_of_week, from_ms, sdiv
from quayside.operators.windows import hopping, log_return, trailing

WINDOWS = (60, 300, 900)


def calendar(df: DataFrame) -> DataFrame:
    """Parts of the time; is_weekend counts Friday too, as the original does, is_weekend_iso does not."""
    dow = day_of_week("ms")
    return df.withColumns({**date_parts("ms"), "day_of_week": dow, "is_weekend": (dow >= 5).cast("int"), "is_weekend_iso": (dow >= 6).cast("int")})


def ticker_features(df: DataFrame) -> DataFrame:
    d = df.withColumns({"spread": F.col("ask") - F.col("bid"), "mid_price": (F.col("bid") + F.col("ask")) / 2})
    vol = F.col("bid_volume") + F.col("ask_volume")
    return calendar(d.withColumns({
        "relative_spread": sdiv("spread", "mid_price"),
        "volume_imbalance": F.when(vol > 0, (F.col("bid_volume") - F.col("ask_volume")) / vol).otherwise(0.0),
    }))


def trade_features(df: DataFrame) -> DataFrame:
    buy = F.lower("side") == "buy"
    return calendar(df.withColumns({
        "is_buy": buy.cast("tinyint"), "dollar_volume": F.col("price") * F.col("amount"),
        "signed_volume": F.when(buy, F.col("amount")).otherwise(-F.col("amount")), "log_return": log_return("price"),
    }))


def _rolling(df: DataFrame, aggs: dict[str, tuple[str, str]], seconds: int, mode: str) -> DataFrame:
    """aggs: name -> (aggregate, column)."""
    named = {k.format(h=seconds): v for k, v in aggs.items()}
    if mode == "continuous":
        return trailing(df, named, seconds)
    return hopping(df, {k: getattr(F, how)(x) for k, (how, x) in named.items()}, seconds, only_on_second=mode == "parity")


def ticker_rolling(df: DataFrame, windows=WINDOWS, mode: str = "hopping") -> DataFrame:
    """mode: hopping (whole seconds before), parity (the same, only at whole seconds), continuous (up to the row)."""
    for h in windows:
        df = _rolling(df, {
            "mean_mid_{h}s": ("avg", "mid_price"), "std_mid_{h}s": ("stddev_samp", "mid_price"), "mean_spread_{h}s": ("avg", "spread"),
            "mean_imbalance_{h}s": ("avg", "volume_imbalance"),
        }, h, mode)
    return df


def trade_rolling(df: DataFrame, windows=WINDOWS, mode: str = "hopping") -> DataFrame:
    for h in windows:
        df = _rolling(df, {
            "_pv_{h}s": ("sum", "dollar_volume"), "volume_{h}s": ("sum", "amount"), "trade_count_{h}s": ("count", "price"),
            "_b_{h}s": ("avg", "is_buy"), "realized_var_{h}s": ("var_samp", "log_return"),
        }, h, mode)
        df = df.withColumns({f"vwap_{h}s": sdiv(f"_pv_{h}s", f"volume_{h}s"), f"dollar_volume_{h}s": F.col(f"_pv_{h}s"), f"buy_ratio_{h}s": F.col(f"_b_{h}s")}).drop(f"_pv_{h}s", f"_b_{h}s")
    return df


def book_rolling(df: DataFrame, horizons=(5, 15, 60, 300, 900)) -> DataFrame:
    """Hopping volatility and spread; needs mid_price and relative_spread. Named apart from the continuous rv."""
    df = df.withColumn("_lr", log_return("mid_price"))
    for h in horizons:
        df = hopping(df, {f"rv_hop_{h}s": F.stddev_samp("_lr"), f"mean_log_return_{h}s": F.avg("_lr"), f"mean_spread_{h}s": F.avg("relative_spread")}, h)
    return df.drop("_lr")


def vendor_ticker(df: DataFrame) -> DataFrame:
    """high, low, last, bid and ask -> ranges and spreads in basis points."""
    mid = (F.col("bid") + F.col("ask")) / 2
    return df.withColumns({
        "mid_price": mid, "spread_bps": sdiv((F.col("ask") - F.col("bid")) * 10000, mid),
        "range_24h": F.col("high") - F.col("low"), "range_24h_pct": sdiv((F.col("high") - F.col("low")) * 100, "low"),
    })


def vendor_trades(df: DataFrame) -> DataFrame:
    side = F.lower("side")
    return df.withColumns({
        "value": F.col("price") * F.col("amount"), "side_normalized": F.when(side.isin("buy", "bid"), "buy").when(side.isin("sell", "ask", "offer"), "sell").otherwise(side),
        "direction": F.when(side.isin("buy", "bid"), 1).when(side.isin("sell", "ask", "offer"), -1).otherwise(0),
    })


def interactions(df: DataFrame) -> DataFrame:
    """Products and quotients of features; denominators that are not positive count as 1e-10."""
    pos = lambda c: F.when(F.col(c) > 0, F.col(c)).otherwise(1e-10)
    c = F.col
    return df.withColumns({
        "imb_over_rv": c("total_imbalance") / pos("rv_60s"), "imb_times_rv": c("total_imbalance") * c("rv_60s"), "ofi_over_spread": c("ofi_sum_5s") / pos("relative_spread"),
        "momentum_imb": c("log_return") * c("total_imbalance"), "depth_asymmetry": (c("total_bid_depth") - c("total_ask_depth")) / pos("total_ask_depth"),
        "smart_depth_ratio": c("smart_bid_depth") / pos("smart_ask_depth"), "imb_gradient_1_3": c("imbalance_L1") - c("imbalance_L3"),
        "imb_gradient_3_5": c("imbalance_L3") - c("imbalance_L5"), "imb_gradient_5_10": c("imbalance_L5") - c("imbalance_L10"),
        "micro_over_spread": c("micro_minus_mid") / pos("spread"), "cog_imb": c("cog_vs_mid") * c("total_imbalance"),
        "ofi_accel": c("ofi_sum_5s") - c("ofi_sum_15s") / 3, "vol_regime_ratio": c("rv_60s") / pos("rv_300s"),
    })


def add_date_columns(df: DataFrame, ms: str = "ms", hour: bool = True) -> DataFrame:
    return df.withColumns(date_parts(ms, hour))


def capture_time(df: DataFrame) -> DataFrame:
    return df.withColumn("capture_ts", from_ms("ms"))

"""Exact values on small inputs, and the cases that the driver tables do not hold."""

import math
import re

import pytest
from pyspark.sql import functions as F

from quayside.functions import exprs as E
from quayside.operators import bars, book, features, filters, flow, research, seq
from quayside.operators import windows as W

L = "array<struct<price:double,size:double>>"
BOOK = f"exchange string, symbol string, ms long, seq long, bids {L}, asks {L}"
TRADE = "exchange string, symbol string, ms long, seq long, price double, amount double, side string"


def books(spark, *rows):
    return spark.createDataFrame([("x", "A", t, i, b, a) for i, (t, b, a) in enumerate(rows)], BOOK)


@pytest.mark.parametrize(
    ("bid", "ask", "want"),
    [((100, 15), (101, 10), 5.0), ((101, 7), (102, 10), 7.0 + 10.0), ((99, 7), (101, 10), -10.0), ((100, 10), (102, 3), 10.0), ((100, 10), (100.5, 3), -3.0)],
)
def test_order_flow_cases(spark, bid, ask, want):
    d = book.top_of_book(books(spark, (0, [(100.0, 10.0)], [(101.0, 10.0)]), (1000, [tuple(map(float, bid))], [tuple(map(float, ask))])))
    got = [r.ofi for r in flow.order_flow(d).orderBy("ms").collect()]
    assert got == [0.0, want]


def test_gap_resets_flow_and_empty_sides_are_left_out(spark):
    d = book.top_of_book(books(spark, (0, [(1.0, 1.0)], [(2.0, 1.0)]), (300_001, [(1.0, 5.0)], [(2.0, 1.0)]), (300_002, [], [(2.0, 1.0)])))
    assert [r.ofi for r in flow.order_flow(d).orderBy("ms").collect()] == [0.0, 0.0]


def test_multi_level_flow_weights(spark):
    a = [(10.0, 1.0), (9.0, 1.0)]
    d = book.top_of_book(books(spark, (0, a, a), (1, [(10.0, 2.0), (9.0, 3.0)], a)))
    r = flow.order_flow(d, alpha=0.5).orderBy("ms").collect()[1]
    assert math.isclose(r.mlofi, 1 + 2 * math.exp(-0.5)) and r.ofi_multi == 3.0


def test_structural_bounds_and_one_sided_books(spark):
    d = book.structural(books(spark, (0, [(100.0, 10.0), (99.0, 20.0)], [(101.0, 10.0), (102.0, 20.0)]), (1, [], [(5.0, 0.0)]), (2, [(1.0, 0.0)], [(2.0, 0.0)])))
    r = d.orderBy("ms").collect()
    assert r[0].microprice == 100.5 and r[0].total_imbalance == 0 and 0.5 <= r[0].bid_concentration <= 1 and r[0].best_bid <= r[0].microprice <= r[0].best_ask
    assert r[1].mid_price is None and r[1].total_imbalance is None and r[2].microprice is None


def test_parity_counts_the_top_twice(spark):
    d = books(spark, (0, [(100.0, 10.0), (99.0, 20.0)], [(101.0, 10.0), (102.0, 20.0)]))
    assert book.structural(d).first().total_bid_depth == 30 and book.structural(d, parity=True).first().total_bid_depth == 20


def trades(spark, *rows):
    return spark.createDataFrame([("x", "A", t, i, float(p), float(v), s) for i, (t, p, v, s) in enumerate(rows)], TRADE)


def test_vpin_splits_trades_and_conserves_volume(spark):
    d = trades(spark, (0, 1, 4, "buy"), (1, 1, 25, "sell"), (2, 1, 1, "buy"))
    got = [(r.bucket, round(r.buy_volume, 9), round(r.sell_volume, 9)) for r in flow.vpin(d, 10.0).orderBy("bucket").collect()]
    assert got == [(0, 4.0, 6.0), (1, 0.0, 10.0), (2, 1.0, 9.0)]


def test_tick_rule(spark):
    d = trades(spark, (0, 1, 10, None), (1, 2, 10, None), (2, 1, 10, None))
    assert [round(r.buy_volume, 6) for r in flow.vpin(d, 10.0).orderBy("bucket").collect()] == [5.0, 10.0, 0.0]


def test_volume_bars(spark):
    d = trades(spark, (0, 10, 5, "buy"), (1, 12, 10, "sell"), (2, 11, 4, "buy"))
    r = flow.volume_bars(d, 10.0).orderBy("bar").collect()
    assert len(r) == 1 and (r[0].open, r[0].close, r[0].buy_ratio, r[0].vwap) == (10.0, 12.0, 0.5, 11.0)


def test_tied_times_count_only_rows_before(spark):
    d = trades(spark, (0, 1, 1, "b"), (0, 1, 2, "b"), (0, 1, 4, "b"))
    got = d.withColumn("s", W.tie_corrected_sum(F.col("amount"), 5)).orderBy("seq").collect()
    assert [r.s for r in got] == [1.0, 3.0, 7.0]


def test_window_is_half_open(spark):
    d = trades(spark, (0, 1, 1, "b"), (4999, 1, 1, "b"), (5000, 1, 1, "b"))
    assert [r.hits for r in flow.hit_count(d, 5).orderBy("ms").collect()] == [1, 2, 2]


def test_weekend_rules(spark):
    friday, saturday = 1704456000000, 1704542400000
    r = features.calendar(spark.createDataFrame([(friday,), (saturday,)], "ms long")).orderBy("ms").collect()
    assert [(x.day_of_week, x.is_weekend, x.is_weekend_iso) for x in r] == [(5, 1, 0), (6, 1, 1)]


def test_symbols_times_durations(spark):
    r = spark.createDataFrame([("A-USDT",), ("A-EUR",), ("AB",), (None,)], "symbol string").select(E.normalize_symbol().alias("n"), E.base_currency().alias("b"), E.is_usd_quoted().alias("u")).collect()
    assert [tuple(x) for x in r] == [("A-USD", "A", True), ("A-EUR", "A", False), ("AB", None, False), (None, None, False)]
    assert len(E.symbol_variants("A-USDC")) == 12 and E.symbol_variants("A-EUR") == ["A-EUR"]
    assert E.duration_ms("5m") == 300_000
    for bad in ("5mx", "1ms", "", "m"):
        with pytest.raises(ValueError):
            E.duration_ms(bad)
    t = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("1704067200",), ("1704067200000",), ("junk",)], "s string").select(F.unix_millis(E.parse_utc("s"))).collect()
    assert [x[0] for x in t] == [1704067200000] * 3 + [None]


def test_predicates():
    with pytest.raises(ValueError):
        filters.predicate([("a", "like", 1)])
    with pytest.raises(ValueError):
        filters.predicate([("a", "between", (1,))])
    spec = filters.FilterSpec("x", "A-USD", year=2024, day=3)
    assert filters.FilterSpec.from_dict(spec.to_dict()) == spec
    assert ("year", "=", 2024) in spec.partition_tuples()


def test_fill_gaps_and_single_row_variance(spark):
    d = trades(spark, (0, 5, 1, "buy"), (200_000, 6, 1, "buy"))
    r = bars.resample(d, "1m", {"price": "last"}, fill_gaps=True).orderBy("label_ms").collect()
    assert [(x.label_ms, x.price, x.n_rows) for x in r] == [(60000, 5.0, 1), (120000, 5.0, 0), (180000, 5.0, 0), (240000, 6.0, 1)]
    assert bars.trade_bars(features.trade_features(d), 60).filter("bar_ms = 0").first().realized_variance is None


def loop_positions(s, entry, exit_, hold):
    out, p, e = [], 0, 0
    for i, z in enumerate(s):
        if p and (i >= e + hold or (p == 1 and z < exit_) or (p == -1 and z > -exit_)):
            p = 0
        if not p and abs(z) > entry:
            p, e = (1 if z > 0 else -1), i
        out.append(p)
    return out


def test_strategies(spark):
    import random

    r = random.Random(1)
    s = [r.gauss(0, 1.5) for _ in range(300)]
    import numpy as np

    assert seq.imbalance(1.5, 0.5, 7).positions(np.array(s)).tolist() == loop_positions(s, 1.5, 0.5, 7)
    assert seq.mean_reversion(1.5, 0.5, 7).positions(np.array(s)).tolist() == loop_positions([-x for x in s], 1.5, 0.5, 7)
    assert seq.Regression(1, 3, 2).positions(np.array([2, 0, 0, 5, 5, 5, -2, 0.0])).tolist() == [1, 1, 1, 0, 0, 1, 1, 1]
    assert seq.Direction(0.6, 0.4, 1).positions(np.array([0.7, 0.5, 0.3])).tolist() == [1, 0, -1]
    assert seq.zigzag_labels(np.array([1.0, 0.9, 1.2, 1.0, 1.3])).tolist() == [0, 1, -1, 1, 0]


def test_backtest(spark):
    d = trades(spark, (0, 100, 1, "b"), (1, 110, 1, "b"), (2, 121, 1, "b"), (3, 110, 1, "b")).withColumn("position", F.element_at(F.array(*map(F.lit, (1, 1, -1, -1))), (F.col("seq") + 1).cast("int")))
    t = research.trade_log(d, "price", fee=0.0).orderBy("entry_idx").collect()
    assert [(x.entry_idx, x.exit_idx, x.direction, round(x.gross_return, 9)) for x in t] == [(0, 2, 1, 0.21), (2, 3, -1, 0.1)]
    last = research.equity_curve(d, "price", 0.0).orderBy("ms").collect()[-1]
    assert math.isclose(last.equity, 10_000 * 1.21 * 1.1)
    s = research.summary(research.trade_log(d, "price", 0.0), 0.0).first()
    assert s.n_trades == 2 and s.win_rate == 1 and math.isclose(s.total_return_pct, 33.1)


def test_rebuild_book(spark):
    rows = [("p", 1, 0, "bid", 10.0, 1.0, "snapshot"), ("p", 1, 1, "offer", 11.0, 2.0, "snapshot"), ("p", 2, 2, "bid", 10.5, 3.0, "update"), ("p", 3, 3, "bid", 10.5, 0.0, "update")]
    d = spark.createDataFrame(rows, "product_id string, sequence_num long, event_ms long, side string, price_level double, new_quantity double, event_type string")
    r = seq.rebuild_book(d).orderBy("sequence_num", "event_ms").collect()
    assert [x.best_bid_price for x in r][1:] == [10.0, 10.5, 10.0] and r[2].best_bid_size == 3.0


def test_sign_flip_and_bootstrap(spark):
    d = spark.createDataFrame([(i, float(i % 7 + 1)) for i in range(100)], "k long, x double")
    b = research.bootstrap_mean(d, "x", ["k"]).first()
    assert b.low < b.mean < b.high and abs(b.mean - 3.95) < 0.3
    assert research.sign_flip_test(d, "x", ["k"]).first().p_value < 0.02


def test_resampling_of_equal_values(spark):
    import numpy as np

    ones = spark.createDataFrame([(i, 1.0) for i in range(400)], "k long, x double")
    assert research.sign_flip_test(ones, "x", ["k"]).first().p_value < 0.01
    b = research.bootstrap_mean(ones, "x", ["k"]).first()
    assert (b.mean, b.low, b.high) == (1.0, 1.0, 1.0)
    x = np.repeat([0.0, 1.0], 200)
    b = research.bootstrap_mean(spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "k long, x double"), "x", ["k"], 1000).first()
    r = np.random.default_rng(1)
    low, high = np.percentile([r.choice(x, 400).mean() for _ in range(1000)], [2.5, 97.5])
    assert abs(b.low - low) < 0.015 and abs(b.high - high) < 0.015
    balanced = spark.createDataFrame([(i, float(1 - 2 * (i % 2))) for i in range(400)], "k long, x double")
    assert research.sign_flip_test(balanced, "x", ["k"]).first().p_value > 0.9


def test_total_loss_leaves_nothing(spark):
    # A short position at a price that doubles and more loses all; what comes after cannot bring it back.
    d = trades(spark, (0, 100, 1, "b"), (1, 1e-300, 1, "b"), (2, 5, 1, "b")).withColumn("position", F.lit(1))
    r = research.equity_curve(d.withColumn("price", F.when(F.col("seq") == 2, 0.0).otherwise(F.col("price"))), "price", 0.0).orderBy("ms").collect()
    assert [round(x.equity, 6) for x in r] == [10_000.0, 10_000.0, 0.0]


def test_chained_curves(spark):
    rows = [(1, 0, 2.0), (1, 1, 3.0), (2, 2, 10.0), (2, 3, 5.0), (3, 4, -1.0), (3, 5, 7.0), (4, 6, 4.0), (4, 7, 8.0)]
    d = spark.createDataFrame(rows, "day long, ms long, equity double")
    got = [round(r.equity, 9) for r in research.chained(d, "day", order=("ms",)).orderBy("ms").collect()]
    assert got == [1.0, 1.5, 1.5, 0.75, -1.0, 7.0, 0.75, 1.5]


def test_hindsight_profit(spark):
    d = trades(spark, (0, 100, 1, "b"), (1, 110, 1, "b"), (2, 50, 1, "b"), (3, 40, 1, "b"), (4, 10, 1, "b")).withColumn("label", F.element_at(F.array(*map(F.lit, (1, -1, 1, -1, 1))), (F.col("seq") + 1).cast("int")))
    r = research.hindsight_profit(d, "price").first()
    a, b = 1.1 - 0.002, 0.8 - 0.002
    assert r.n_trades == 2 and math.isclose(r.total_return, (a * b - 1) * 100) and r.win_rate == 50 and math.isclose(r.total_fees, 0.3)
    assert research.hindsight_profit(d.withColumn("label", F.lit(0)), "price").first().n_trades == 0


def test_walk_forward_learns_and_never_sees_later_days(spark):
    import random

    r = random.Random(2)
    rows = []
    for i in range(1200):
        x = r.random()
        rows.append((i, i // 200, x, r.random(), int(x + r.gauss(0, 0.1) > 0.5)))
    d = spark.createDataFrame(rows, "seq long, day long, x double, y double, up int").repartition(2)
    folds = research.expanding(list(range(6)), 4)
    assert folds == [([0, 1, 2, 3], [4]), ([0, 1, 2, 3, 4], [5])]
    p = research.walk_forward(d, ["x", "y"], "up", "day", folds, trees=5, depth=3).cache()
    assert p.count() == 400 and all(q.auc > 0.9 for q in research.auc(p, "probability", "up", ("fold",)).collect())
    mi = {q.feature: q.mutual_information for q in research.mutual_information(d.withColumn("up", F.col("up").cast("double")), ["x", "y"], "up", 8).collect()}
    assert mi["x"] > 0.3 > 0.05 > mi["y"] >= 0


def test_sessions_percentiles_and_running_stats(spark):
    d = trades(spark, (0, 1, 1, "b"), (10, 5, 1, "b"), (5_000, 3, 1, "b"), (5_001, 9, 1, "b"))
    s = W.sessions(d, 4_990).orderBy("ms").collect()
    assert [(x.session, x.session_ms) for x in s] == [(0, 0), (0, 0), (1, 5000), (1, 5000)]
    q = d.withColumn("q", W.rolling_percentile("price", 10, 0.5)).orderBy("ms").collect()
    assert [x.q for x in q] == [1.0, 1.0, 3.0, 3.0]
    r = W.running_stats(d, "price", "p").orderBy("ms").collect()
    assert [x.p_var for x in r][:2] == [0.0, 8.0] and r[3].p_mean == 4.5


def test_closed_bars_leave_out_the_last(spark):
    d = trades(spark, (0, 1, 1, "b"), (500, 3, 1, "b"), (70_000, 2, 1, "b")).withColumns({"mid_price": F.col("price"), "spread": F.lit(1.0), "relative_spread": F.lit(None).cast("double"), "imbalance_L1": F.lit(0.5), "ofi": F.lit(2.0), "log_return": F.lit(0.0)})
    assert [(x.bar_ms, x.open, x.close, x["count"], x.mean_relative_spread, x.sum_ofi) for x in bars.closed_bars(d, 60).collect()] == [(0, 1.0, 3.0, 2, 0.0, 4.0)]
    assert bars.closed_bars(d, 60, flush=True).count() == 2 and bars.durations_of(["bars_60s", "x", "bars_900s"]) == (60, 900)


def test_asset_matrix(spark):
    d = spark.createDataFrame([(1, "A-USD", 1.0, 2.0), (1, "B-USD", 3.0, 4.0), (2, "A-USD", 5.0, 6.0)], "t long, s string, v double, w double")
    assert [tuple(x) for x in research.asset_matrix(d, "t", "s", ["v", "w"], ["A-USD", "B-USD"]).collect()] == [(1, 1.0, 2.0, 3.0, 4.0)]


def test_trailing_equals_the_range_frame_without_growing_with_it(spark):
    inf = float("inf")
    rows = [("x", "A", i // 2 * 700, i, {5: inf, 30: -inf, 31: inf, 50: None, 60: float("nan")}.get(i, 1e6 + (i * 7919 % 101) / 10)) for i in range(120)]
    d = spark.createDataFrame(rows, "exchange string, symbol string, ms long, seq long, v double")
    hows = ("sum", "count", "avg", "var_samp", "stddev_samp")
    want = d.select("seq", *(getattr(F, h)("v").over(W.last_seconds(4)).alias(h) for h in hows)).orderBy("seq").collect()
    got = W.trailing(d, {h: (h, "v") for h in hows}, 4).select("seq", *hows).orderBy("seq").collect()
    same = lambda a, b: a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-6)))
    assert all(same(a[h], b[h]) for a, b in zip(got, want, strict=True) for h in hows)
    # A tenth has no exact double: running sums as they come would be off in the ninth digit.
    t = spark.range(60_000).select(F.lit("x").alias("exchange"), F.lit("A").alias("symbol"), F.col("id").alias("ms"), F.lit(0.1).alias("v"))
    r = W.trailing(t, {"s": ("sum", "v")}, 30).filter("ms >= 30000").agg(F.min("s"), F.max("s")).first()
    assert tuple(r) == (3000.0, 3000.0) or all(abs(x - 3000.0) < 1e-11 for x in r)
    # Frames that only grow cost a step a row; one that shrinks as well would be summed anew for each row.
    r = features.trade_rolling(features.trade_features(t.withColumns({"seq": F.col("ms"), "price": F.col("v"), "amount": F.col("v"), "side": F.lit("buy")})), (30,), "continuous")
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+), ", r._jdf.queryExecution().optimizedPlan().toString())
    assert frames and all(low == "unboundedpreceding$()" or kind == "RowFrame" for kind, low in frames)
    assert r.filter("ms = 59999").first().trade_count_30s == 30_000

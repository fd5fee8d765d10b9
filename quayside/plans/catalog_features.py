"""More queries of features, joins, windows and research operators, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions import exprs as E
from quayside.operators import bars, book, features, flow, research, seq, tables
from quayside.operators import windows as W
from quayside.plans.catalog import _FLOW, _LOG, _R, _TF, _TOP, _W, _flow, _held, _log, _sum, nudged, pick, query, rounded
from quayside.sources import views

# ---- joins, sets, order


@query("j2_equal_time", "SELECT t.seq, q.mean FROM trades_v t LEFT JOIN (SELECT exchange, symbol, ms, any_value(bid) AS mean FROM ticker_v WHERE ms % 2 = 0 GROUP BY 1, 2, 3) q ON t.exchange = q.exchange AND t.symbol = q.symbol AND t.ms = q.ms")
def _(s, d):
    q = views.ticker(s, d).filter("ms % 2 = 0").groupBy("exchange", "symbol", "ms").agg(F.first("bid").alias("mean"))
    return W.equal_time_join(views.trades(s, d), q, ["mean"]).select("seq", "mean")


@query("j9_resume", "SELECT exchange, symbol, ms // 86400000 AS day FROM trades_v GROUP BY ALL HAVING max(CASE WHEN side = 'buy' THEN 1 ELSE 0 END) = 0")
def _(s, d):
    parts = views.trades(s, d).select("exchange", "symbol", F.floor(F.col("ms") / 86_400_000).alias("day"), "side")
    return tables.not_done(parts.drop("side").distinct(), parts.filter("side = 'buy'"), ["exchange", "symbol", "day"])


@query("j10_cross_quote", "SELECT t.seq, count(q.seq) AS quotes FROM trades_v t LEFT JOIN ticker_v q ON t.exchange = q.exchange AND t.ms = q.ms AND replace(t.symbol, 'USDC', 'USD') = replace(q.symbol, 'USDC', 'USD') GROUP BY 1")
def _(s, d):
    norm = lambda df, *c: df.select("exchange", "ms", E.normalize_symbol().alias("n"), *c)
    q = norm(views.ticker(s, d), F.col("seq").alias("q"))
    return norm(views.trades(s, d), "seq").join(q, ["exchange", "ms", "n"], "left").groupBy("seq").agg(F.count("q").alias("quotes"))


@query("u2_distinct_pairs", "SELECT DISTINCT exchange, symbol, side FROM trades_v")
def _(s, d):
    return views.trades(s, d).select("exchange", "symbol", "side").distinct()


@query("u4_except", "SELECT ms FROM trades_v WHERE side = 'buy' EXCEPT SELECT ms FROM trades_v WHERE side = 'sell'")
def _(s, d):
    t = views.trades(s, d)
    return t.filter("side = 'buy'").select("ms").exceptAll(t.filter("side = 'sell'").select("ms")).distinct().join(t.filter("side = 'sell'").select("ms"), "ms", "left_anti")


@query("u5_split", "SELECT exchange, side, count(*) AS n, max(price) AS high FROM trades_v GROUP BY 1, 2")
def _(s, d):
    out = None
    for key, part in tables.split(views.trades(s, d), ["exchange", "side"]):
        r = part.agg(F.lit(key[0]).alias("exchange"), F.lit(key[1]).alias("side"), F.count("*").alias("n"), F.max("price").alias("high"))
        out = r if out is None else out.unionAll(r)
    return out


@query("o1_order", f"SELECT seq, row_number() OVER ({_W}) AS place FROM trades_v")
def _(s, d):
    return views.trades(s, d).select("seq", F.row_number().over(W.ordered()).cast("long").alias("place"))


# ---- scalar functions


@query("f4_time_parts", """SELECT seq, CAST(year(make_timestamp(ms * 1000)) AS INT) AS year, CAST(minute(make_timestamp(ms * 1000)) AS INT) AS minute, CAST(second(make_timestamp(ms * 1000)) AS INT) AS second,
    strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS date FROM trades_v""")
def _(s, d):
    t = E.from_ms("ms")
    return views.trades(s, d).select("seq", F.year(t).alias("year"), F.minute(t).alias("minute"), F.second(t).alias("second"), F.date_format(t, "yyyy-MM-dd").alias("date"))


@query("f6_identifiers", "SELECT DISTINCT symbol, lower(replace(symbol, '-', '_')) AS name FROM trades_v")
def _(s, d):
    return views.trades(s, d).select("symbol", E.identifier("symbol").alias("name")).distinct()


@query("f7_durations", "SELECT seq, ms // 900000 * 900000 AS quarter, ms // 172800000 * 172800000 AS two_days FROM trades_v")
def _(s, d):
    return views.trades(s, d).select("seq", bars.bucket("ms", E.duration_ms("15m")).alias("quarter"), bars.bucket("ms", E.duration_ms("2d")).alias("two_days"))


@query("f10_guarded_math", "SELECT seq, CASE WHEN price > 50 THEN round(ln(price - 50), 7) END AS log, round(amount / nullif(floor(price) % 3, 0), 7) AS ratio FROM trades_v WHERE price <> 50")
def _(s, d):
    t = views.trades(s, d).filter("price <> 50")
    return rounded(t.select("seq", E.sln(F.col("price") - 50).alias("log"), E.sdiv("amount", F.floor("price") % 3).alias("ratio")))


# ---- bars and windows


@query("a4_bars_by_name", f""", {_TF} SELECT 3600 AS seconds, ms // 3600000 * 3600000 AS bar_ms, exchange, symbol, max(price) AS high, count(*) AS trade_count FROM tf GROUP BY ALL
    UNION ALL SELECT 86400, ms // 86400000 * 86400000, exchange, symbol, max(price), count(*) FROM tf GROUP BY ALL""")
def _(s, d):
    made = bars.bars(features.trade_features(views.trades(s, d)), "trades", bars.durations_of(["silver", "bars_3600s", "bars_86400s"]))
    out = [b.select(F.lit(n).alias("seconds"), "bar_ms", "exchange", "symbol", "high", "trade_count") for n, b in made.items()]
    return out[0].unionAll(out[1])


@query("a14_screen", f""", r AS (SELECT symbol, exchange, ms // 86400000 AS day, ms, seq, amount, CAST(side = 'buy' AS DOUBLE) AS b, price FROM trades_v),
    f AS (SELECT symbol, day, amount, b, (lead(price, 2) OVER w - price) / price AS f2, (lead(price, 5) OVER w - price) / price AS f5 FROM r WINDOW w AS (PARTITION BY exchange, symbol, day ORDER BY ms, seq)),
    c AS (SELECT symbol, day, 'amount' AS feature, 2 AS horizon, corr(amount, f2) AS c FROM f GROUP BY 1, 2 HAVING count(f2) >= 8 UNION ALL SELECT symbol, day, 'amount', 5, corr(amount, f5) FROM f GROUP BY 1, 2 HAVING count(f5) >= 8
      UNION ALL SELECT symbol, day, 'buy', 2, corr(b, f2) FROM f GROUP BY 1, 2 HAVING count(f2) >= 8 UNION ALL SELECT symbol, day, 'buy', 5, corr(b, f5) FROM f GROUP BY 1, 2 HAVING count(f5) >= 8),
    m AS (SELECT feature, horizon, symbol, avg(c) AS c FROM c WHERE c IS NOT NULL AND NOT isnan(c) GROUP BY ALL)
    SELECT feature, horizon, round(avg(abs(c)), 6) AS avg_abs_corr, round(max(abs(c)), 6) AS max_abs_corr, count(*) AS n_assets FROM m GROUP BY 1, 2""")
def _(s, d):
    t = views.trades(s, d).withColumns({"day": F.floor(F.col("ms") / 86_400_000), "buy": (F.col("side") == "buy").cast("double")})
    return rounded(research.screen(t, ["amount", "buy"], "price", (2, 5), least=8), 6)


@query("a15_daily_summary", f", {_LOG}, r AS (SELECT greatest(gross - 0.0001, -0.5) / 100 AS r, entry_idx // 100 AS day FROM tl) SELECT day, round(product(1 + least(r, 0.05)) - 1, 6) AS compounded, count(*) AS n_trades, round(avg((r > 0)::INT), 7) AS win_rate FROM r GROUP BY 1")
def _(s, d):
    r = F.least(F.greatest("net_return", F.lit(-0.5)) / 100, F.lit(0.05))
    t = research.trade_log(_held(s, d), "price").withColumns({"net_return": r, "day": F.floor(F.col("entry_idx") / 100)})
    r = research.daily_summary(t)
    return r.select("day", nudged("compounded", 6).alias("compounded"), "n_trades", nudged("win_rate", 7).alias("win_rate"))


@query("a16_closed_bars", f""", {_FLOW}, g AS (SELECT exchange, symbol, ms // 60000 * 60000 AS bar_ms, round(min_by(mid, ms), 7) AS open, round(max_by(mid, ms), 7) AS close, round(avg(sp), 7) AS mean_spread, round(sum(ofi), 6) AS sum_ofi,
    round(min(sp), 7) AS min_spread, round(coalesce(var_samp(lr), 0), 9) AS realized_variance, count(*) AS "count" FROM fl GROUP BY exchange, symbol, ms // 60000)
    SELECT * EXCLUDE (l) FROM (SELECT *, lead(bar_ms) OVER (PARTITION BY exchange, symbol ORDER BY bar_ms) AS l FROM g) WHERE l IS NOT NULL""")
def _(s, d):
    b = bars.closed_bars(_flow(s, d), 60)
    return b.select("exchange", "symbol", "bar_ms", *(nudged(c, 7).alias(c) for c in ("open", "close", "mean_spread", "min_spread")), nudged("sum_ofi", 6).alias("sum_ofi"), nudged("realized_variance", 9).alias("realized_variance"), "count")


@query("w1_log_return", f"SELECT seq, round(ln(mid) - ln(lag(mid) OVER ({_W})), 9) AS log_return FROM (SELECT *, (bid + ask) / 2 AS mid FROM ticker_v)")
def _(s, d):
    return rounded(features.ticker_features(views.ticker(s, d)).select("seq", W.log_return("mid_price").alias("log_return")), 9)


@query("w4_on_the_second", """, q AS (SELECT seq, exchange, symbol, ms // 7 * 7 * 1000 // 1000 AS ms, (bid + ask) / 2 AS mid FROM ticker_v)
    SELECT seq, CASE WHEN ms % 1000 = 0 THEN round(avg(mid) OVER x, 9) END AS mean_mid FROM q WINDOW x AS (PARTITION BY exchange, symbol ORDER BY ms // 1000 RANGE BETWEEN 36000 PRECEDING AND 1 PRECEDING)""")
def _(s, d):
    # Times cut to sevens of milliseconds, so that some fall on whole seconds.
    t = features.ticker_features(views.ticker(s, d).withColumn("ms", F.floor(F.col("ms") / 7) * 7))
    return pick(W.hopping(t, {"mean_mid": F.avg("mid_price")}, 36000, only_on_second=True), "seq", "mean_mid", digits=9)


@query("st4_sessions_batch", f"""SELECT seq, sum(new) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT *, CASE WHEN ms - lag(ms) OVER ({_W}) >= 7200000 THEN 1 ELSE 0 END AS new FROM trades_v)""")
def _(s, d):
    return W.sessions(views.trades(s, d), 7_200_000).select("seq", "session")


# ---- books and path-dependent features


@query("m13_micro_minus_mid", f", {_TOP} SELECT seq, round((bb * az[1] + ba * bs[1]) / (bs[1] + az[1]) - mid, 6) + 0 AS micro_minus_mid FROM top")
def _(s, d):
    return pick(book.top_of_book(views.books(s, d)), "seq", "micro_minus_mid", digits=6).withColumn("micro_minus_mid", F.col("micro_minus_mid") + 0.0)


@query("m18_level_columns", "SELECT seq, round(bp[1], 6) AS bid_price_l0, CASE WHEN len(bs) >= 4 THEN round(bs[4], 6) END AS bid_size_l3, CASE WHEN len(ap) >= 4 THEN round(ap[4], 6) END AS ask_price_l3 FROM books_v")
def _(s, d):
    t = book.level_columns(views.books(s, d), 4, missing=None)
    return rounded(t.select("seq", F.col("bid_price_L0").alias("bid_price_l0"), F.col("bid_size_L3").alias("bid_size_l3"), F.col("ask_price_L3").alias("ask_price_l3")), 6)


@query("m19_null_safe_top", "SELECT seq, CASE WHEN seq % 4 = 0 THEN NULL ELSE round(bp[1], 6) END AS best_bid, round(ap[1], 6) AS best_ask, CASE WHEN seq % 4 = 0 THEN NULL ELSE round((bp[1] + ap[1]) / 2, 6) END AS mid_price FROM books_v")
def _(s, d):
    t = views.books(s, d).withColumn("bids", F.when(F.col("seq") % 4 != 0, F.col("bids")))
    return pick(book.top_of_book(t), "seq", "best_bid", "best_ask", "mid_price", digits=6)


@query("d1_gap_reset", f", {_FLOW.replace('300000', '4000')} SELECT seq, round(ofi, 6) AS ofi FROM fl")
def _(s, d):
    return pick(flow.order_flow(book.top_of_book(views.books(s, d)), gap_ms=4000), "seq", "ofi", digits=6)


_COG = f"(({_sum('b', 20, 'pv')} + {_sum('a', 20, 'pv')}) / ({_sum('b', 20)} + {_sum('a', 20)}) - mid) * 10000 / mid"


@query("d12_book_statistics", f""", {_TOP}, x AS (SELECT seq, unnest(range(1, least(10, len(bs)) + 1)) AS i, bp, bs, mid FROM top),
    sl AS (SELECT seq, CASE WHEN count(*) >= 3 THEN regr_slope(list_sum(bs[1:i]), abs(bp[i] - mid) / mid * 10000) END AS bsl FROM x GROUP BY seq),
    t AS (SELECT top.*, bsl, {_COG} AS cog FROM top JOIN sl ON top.seq = sl.seq)
    SELECT seq, round(coalesce(avg(bsl) {_R.format(59999)}, 0), 4) AS bid_slope_mean_60s, round(coalesce(stddev_samp(bsl) {_R.format(59999)}, 0), 3) AS bid_slope_std_60s,
      round(coalesce(avg(cog) {_R.format(59999)}, 0), 5) AS cog_momentum_mean_60s, round(coalesce(stddev_samp(cog) {_R.format(59999)}, 0), 4) AS cog_momentum_std_60s FROM t""")
def _(s, d):
    t = flow.book_statistics(book.slope_regression(book.structural(views.books(s, d))))
    digits = {"bid_slope_mean_60s": 4, "bid_slope_std_60s": 3, "cog_momentum_mean_60s": 5, "cog_momentum_std_60s": 4}
    return t.select("seq", *(nudged(c, n).alias(c) for c, n in digits.items()))


@query("d13_depth_sigma", f", t AS (SELECT seq, exchange, symbol, ms, coalesce(list_sum(bs[1:2]), 0) + coalesce(list_sum(az[1:2]), 0) AS v FROM books_v) SELECT seq, round(coalesce(stddev_samp(v) {_R.format(299999)}, 0), 6) AS depth_0_5bps_sigma FROM t")
def _(s, d):
    return pick(flow.book_statistics(book.index_bands(views.books(s, d))), "seq", "depth_0_5bps_sigma", digits=6)


@query("d15_static_regime", f", {_TOP} SELECT seq, CASE WHEN rs <= 0.001 THEN 'tight' ELSE 'wide' END AS spread_regime FROM (SELECT seq, bs[1] / 25000 AS rs FROM top)")
def _(s, d):
    t = book.top_of_book(views.books(s, d)).withColumn("relative_spread", F.col("top_bid_size") / 25000)
    return flow.static_regime(t, 0.001).select("seq", "spread_regime")


@query("d16_running_stats", f"SELECT seq, count(price) OVER x AS price_count, round(avg(price) OVER x, 7) AS price_mean, round(coalesce(var_samp(price) OVER x, 0), 5) AS price_var FROM trades_v WINDOW x AS ({_W} ROWS UNBOUNDED PRECEDING)")
def _(s, d):
    t = W.running_stats(views.trades(s, d), "price", "price")
    return t.select("seq", "price_count", nudged("price_mean", 7).alias("price_mean"), nudged("price_var", 5).alias("price_var"))


@query("d17_rolling_percentile", f", l AS (SELECT seq, list_sort(list(bs[1]) {_R.format(299999)}) AS w FROM books_v) SELECT seq, w[CAST(floor(0.8::DOUBLE * (len(w) - 1)) AS BIGINT) + 1] AS p80 FROM l")
def _(s, d):
    return book.top_of_book(views.books(s, d)).select("seq", W.rolling_percentile("top_bid_size", 300, 0.8).alias("p80"))


@query("d20_event_flow", f""", att AS (SELECT b.seq, sum(CASE WHEN l.side = 'buy' THEN l.amount ELSE 0 END) AS bv, sum(CASE WHEN l.side = 'sell' THEN l.amount ELSE 0 END) AS sv
      FROM lob_v l ASOF JOIN books_v b ON l.exchange = b.exchange AND l.symbol = b.symbol AND l.ms <= b.ms GROUP BY b.seq),
    q AS (SELECT b.*, coalesce(bv, 0) AS bv, coalesce(sv, 0) AS sv, bs[1] + az[1] AS near FROM books_v b LEFT JOIN att ON b.seq = att.seq)
    SELECT seq, round(coalesce((bv - sv) / nullif(bv + sv, 0), 0), 8) AS tfi, round(bv, 6) AS buy_volume, round(sv, 6) AS sell_volume, round(bv + sv, 6) AS trade_volume,
      round(coalesce(var_samp(near) {_R.format(299999)}, 0), 5) AS depth_variance_5m FROM q""")
def _(s, d):
    t = flow.near_depth(book.top_of_book(flow.trade_flow(views.books(s, d), views.book_trades(s, d), (60,), per_event=True)))
    return t.select("seq", nudged("tfi", 8).alias("tfi"), *(nudged(c, 6).alias(c) for c in ("buy_volume", "sell_volume", "trade_volume")), nudged("depth_variance_5m", 5).alias("depth_variance_5m"))


_LEVELS = 12


def _book_sql() -> str:
    """Best prices after each update, from the last quantity of each price level of each side."""
    last = lambda side, k: f"last_value(CASE WHEN side = '{side}' AND price = {k} THEN qty END IGNORE NULLS) OVER w"
    side = lambda side, f: f"{f}({', '.join(f'CASE WHEN {last(side, k)} > 0 THEN {k} END' for k in range(_LEVELS))})"
    return f"""SELECT seq, CASE WHEN b IS NOT NULL AND a IS NOT NULL THEN b END AS best_bid_price, CASE WHEN b IS NOT NULL AND a IS NOT NULL THEN a END AS best_ask_price
      FROM (SELECT seq, CAST({side('bid', 'greatest')} AS DOUBLE) AS b, CAST({side('offer', 'least')} AS DOUBLE) AS a FROM u WINDOW w AS (PARTITION BY symbol ORDER BY seq ROWS UNBOUNDED PRECEDING))"""


@query("d21_rebuild_book", f""", u AS (SELECT seq, symbol, CASE WHEN seq % 3 = 0 THEN 'bid' ELSE 'offer' END AS side, (seq * 7 + CAST(floor(price) AS BIGINT)) % {_LEVELS} AS price, CASE WHEN seq % 5 = 0 THEN 0 ELSE amount END AS qty FROM trades_v)
    {_book_sql()}""")
def _(s, d):
    u = views.trades(s, d).select(
        "seq", F.col("symbol").alias("product_id"), F.col("seq").alias("sequence_num"), F.col("ms").alias("event_ms"), F.when(F.col("seq") % 3 == 0, "bid").otherwise("offer").alias("side"),
        ((F.col("seq") * 7 + F.floor("price")) % _LEVELS).cast("double").alias("price_level"), F.when(F.col("seq") % 5 == 0, 0.0).otherwise(F.col("amount")).alias("new_quantity"), F.lit("update").alias("event_type"),
    )
    r = seq.rebuild_book(u)
    null = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return r.select("seq", null("best_bid_price"), null("best_ask_price"))


# ---- research


@query("u7_chained_equity", f""", t AS (SELECT seq, exchange, symbol, ms // 604800000 AS wk, ms, price FROM trades_v),
    e AS (SELECT exchange, symbol, wk, min_by(price, ms * 1000000 + seq) AS a, max_by(price, ms * 1000000 + seq) AS b FROM t GROUP BY 1, 2, 3),
    f AS (SELECT exchange, symbol, wk, a, coalesce(exp(sum(ln(b / a)) OVER (PARTITION BY exchange, symbol ORDER BY wk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS f FROM e)
    SELECT seq, round(ln(price / a * f), 6) AS log_equity FROM t JOIN f USING (exchange, symbol, wk)""")
def _(s, d):
    t = views.trades(s, d).withColumns({"wk": F.floor(F.col("ms") / 604_800_000), "equity": F.col("price")})
    c = research.chained(t, "wk", by=("exchange", "symbol"), guard=False)
    return rounded(c.select("seq", E.log("equity").alias("log_equity")), 6)


@query("r6_comparison", f""", {_LOG}, n AS (SELECT 'all' AS strategy, gross - 0.0001 AS r FROM tl UNION ALL SELECT 'long', gross - 0.0001 FROM tl WHERE direction = 1)
    SELECT strategy, count(*) AS n_trades, round(avg((r > 0)::INT), 7) AS win_rate, round(sum(r) FILTER (r > 0) / -sum(r) FILTER (r < 0), 5) AS profit_factor,
      round(avg(r) / stddev_pop(r) FILTER (r < 0), 4) AS sortino FROM n GROUP BY 1""")
def _(s, d):
    t = research.trade_log(_held(s, d), "price").withColumn("g", F.lit(1))
    r = research.comparison({"all": research.report(t, ("g",)), "long": research.report(t.filter("direction = 1"), ("g",))}, ("n_trades", "win_rate", "profit_factor", "sortino"))
    return r.select("strategy", "n_trades", nudged("win_rate", 7).alias("win_rate"), nudged("profit_factor", 5).alias("profit_factor"), nudged("sortino", 4).alias("sortino"))


_ABOVE = _log(f"SELECT *, CASE WHEN side = 'buy' THEN 1 WHEN amount > 1.5 THEN -1 ELSE 0 END AS pos, row_number() OVER ({_W}) - 1 AS i FROM trades_v WHERE price > 5")


@query("r7_performance", f""", {_ABOVE}, n AS (SELECT *, gross - 0.0001 AS r, exit_idx - entry_idx AS hold FROM tl),
    p AS (SELECT exchange, symbol, i, sum(l) AS l FROM (SELECT exchange, symbol, entry_idx AS i, ln(1 - 0.0001::DOUBLE) AS l FROM n UNION ALL SELECT exchange, symbol, exit_idx, ln(1 + r::DOUBLE) FROM n) GROUP BY 1, 2, 3),
    q AS (SELECT h.exchange, h.symbol, h.i, coalesce(sum(l) OVER (PARTITION BY h.exchange, h.symbol ORDER BY h.i ROWS UNBOUNDED PRECEDING), 0) AS l FROM h LEFT JOIN p ON h.exchange = p.exchange AND h.symbol = p.symbol AND h.i = p.i),
    k AS (SELECT *, exp(l - max(l) OVER (PARTITION BY exchange, symbol ORDER BY i ROWS UNBOUNDED PRECEDING)) - 1 AS dd FROM q),
    dn AS (SELECT exchange, symbol, round(min(dd) * 100, 4) AS max_drawdown_pct, round(max_by(l, i) + ln(10000), 5) AS log_final FROM k GROUP BY 1, 2),
    m AS (SELECT exchange, symbol, count(*) AS n_trades, round(avg(CASE WHEN direction = 1 THEN (r > 0)::INT END), 7) AS long_win_rate, round(quantile_cont(hold, 0.5), 5) AS median_holding, round(sum(gross - r), 7) AS total_fees FROM n GROUP BY 1, 2)
    SELECT * FROM dn JOIN m USING (exchange, symbol)""")
def _(s, d):
    held = _held(s, d).filter("price > 5")
    p = research.performance(research.equity_curve(held, "price"), research.trade_log(held, "price"))
    out = {"max_drawdown_pct": 4, "long_win_rate": 7, "median_holding": 5, "total_fees": 7}
    return p.select("exchange", "symbol", nudged(F.ln("final_equity"), 5).alias("log_final"), "n_trades", *(nudged(c, n).alias(c) for c, n in out.items()))


@query("r7_by_day", f", {_LOG}, n AS (SELECT gross - 0.0001 AS r, entry_idx // 50 AS day FROM tl), g AS (SELECT day, sum(r) AS r FROM n GROUP BY 1) SELECT count(*) AS n_trading_days, CAST(sum((r > 0)::INT) AS BIGINT) AS profitable_days, round(avg((r > 0)::INT), 7) AS daily_win_rate, round(max(r), 5) AS best_day FROM g")
def _(s, d):
    t = research.trade_log(_held(s, d), "price").withColumn("day", F.floor(F.col("entry_idx") / 50))
    r = research.by_day(t)
    return r.select("n_trading_days", "profitable_days", nudged("daily_win_rate", 7).alias("daily_win_rate"), nudged("best_day", 5).alias("best_day"))


@query("r12_hindsight", """, l AS (SELECT *, CASE WHEN price < 20 THEN 1 WHEN price > 60 THEN -1 ELSE 0 END AS label FROM trades_v WHERE price > 15 OR side = 'buy'),
    i AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, label ORDER BY ms, seq) AS i FROM l WHERE label <> 0),
    p AS (SELECT b.exchange, b.symbol, b.price AS b, s.price / b.price - 0.002::DOUBLE AS n FROM i b JOIN i s ON b.exchange = s.exchange AND b.symbol = s.symbol AND b.i = s.i AND b.label = 1 AND s.label = -1)
    SELECT exchange, symbol, count(*) AS n_trades, round((exp(sum(ln(n)) / count(*)) - 1) * 100, 4) AS avg_return_per_trade, round(avg((n > 1)::INT) * 100, 5) AS win_rate, round(sum(b * 0.002::DOUBLE), 6) AS total_fees FROM p GROUP BY 1, 2""")
def _(s, d):
    t = views.trades(s, d).filter("price > 15 OR side = 'buy'").withColumn("label", F.expr("CASE WHEN price < 20 THEN 1 WHEN price > 60 THEN -1 ELSE 0 END"))
    r = research.hindsight_profit(t, "price").filter("n_trades > 0")
    return r.select("exchange", "symbol", "n_trades", nudged("avg_return_per_trade", 4).alias("avg_return_per_trade"), nudged("win_rate", 5).alias("win_rate"), nudged("total_fees", 6).alias("total_fees"))


@query("r12_by_hour", f", {_LOG}, n AS (SELECT tl.*, h.ms FROM tl JOIN h ON tl.exchange = h.exchange AND tl.symbol = h.symbol AND tl.entry_idx = h.i) SELECT ms // 3600000 % 24 AS hour, count(*) AS n_trades, round(avg((gross - 0.0001 > 0)::INT), 7) AS win_rate FROM n GROUP BY 1")
def _(s, d):
    h = _held(s, d)
    at = h.select("exchange", "symbol", (F.row_number().over(W.ordered()) - 1).alias("entry_idx"), F.col("ms").alias("entry_ms"))
    t = research.trade_log(h, "price").join(at, ["exchange", "symbol", "entry_idx"])
    return research.by_hour(t).select("hour", "n_trades", nudged("win_rate", 7).alias("win_rate"))


_CUTS = [i / 8 for i in range(1, 8)]


@query("r14_mutual_information", f""", {_TF}, t AS (SELECT price, amount, log_return FROM tf WHERE log_return IS NOT NULL),
    c AS (SELECT quantile_cont(price, {_CUTS}) AS cp, quantile_cont(amount, {_CUTS}) AS ca, quantile_cont(log_return, {_CUTS}) AS cy FROM t),
    b AS (SELECT len(list_filter(list_distinct(cp), lambda v: price > v)) AS p, len(list_filter(list_distinct(ca), lambda v: amount > v)) AS a, len(list_filter(list_distinct(cy), lambda v: log_return > v)) AS y FROM t, c),
    n AS (SELECT 'price' AS feature, p AS x, y, count(*) AS n FROM b GROUP BY ALL UNION ALL SELECT 'amount', a, y, count(*) FROM b GROUP BY ALL),
    m AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, x) AS nx, sum(n) OVER (PARTITION BY feature, y) AS ny FROM n)
    SELECT feature, round(sum(n / t * ln(n * t / nx / ny)), 6) AS mutual_information FROM m GROUP BY 1""")
def _(s, d):
    t = features.trade_features(views.trades(s, d)).filter("log_return IS NOT NULL")
    return rounded(research.mutual_information(t, ["price", "amount"], "log_return", 8), 6)


@query("r14_auc", f", r AS (SELECT exchange, CAST(side = 'buy' AS INT) AS y, rank() OVER (PARTITION BY exchange ORDER BY price) + (count(*) OVER (PARTITION BY exchange, price) - 1) / 2 AS r FROM trades_v) SELECT exchange, round((sum(r * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 7) AS auc FROM r GROUP BY 1")
def _(s, d):
    t = views.trades(s, d).withColumn("up", (F.col("side") == "buy").cast("int"))
    return rounded(research.auc(t, "price", "up", ("exchange",)))


@query("r14_walk_forward")
def _(s, d):
    t = features.trade_features(views.trades(s, d)).withColumns({"span": F.floor(F.col("ms") / 864_000_000) % 3, "up": (W.forward_return("price", 1) > 0).cast("int")})
    t = t.select("seq", "span", "price", "amount", "up")
    days = sorted(r.span for r in t.select("span").distinct().collect())
    p = research.walk_forward(t, ["price", "amount"], "up", "span", research.expanding(days, max(1, len(days) - 1)), trees=5, depth=3)
    return p.select("seq", "fold", "probability")

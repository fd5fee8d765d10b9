"""One query for each operator family over the driver tables, with an equivalent in DuckDB SQL where there is one."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import exprs as E
from quayside.operators import bars, book, features, filters, flow, research, seq, tables
from quayside.operators import windows as W
from quayside.session import ensure_checkpoint_dir
from quayside.sources import views
from quayside.sources.views import DUCK

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
HOUR = 3600


def _shift(digits: int) -> float:
    return 10.0**-digits / 300


def nudged(x: str | Column, digits: int) -> Column:
    """Rounds a little above the value, in both engines: sums in another order then agree even where they end on a tie."""
    return F.round(E.col(x) + _shift(digits), digits)


def _nudge_sql(sql: str) -> str:
    """round(x, d) -> round(x + shift, d)"""
    out, at = [], 0
    for m in re.finditer(r"\bround\(", sql):
        depth, i = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            i += 1
        digits = re.search(r", (\d+)\)$", sql[m.end() : i])
        out.append((m.end() + digits.start(), f" + {_shift(int(digits[1]))!r}"))
    parts = []
    for pos, text in sorted(out):
        parts += [sql[at:pos], text]
        at = pos
    return "".join([*parts, sql[at:]])


def query(name: str, sql: str | None = None, recursive: bool = False):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = f"WITH {'RECURSIVE ' * recursive}{DUCK} {_nudge_sql(sql)}"
        return fn

    return put


def scratch(s: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, for queries that change a table."""
    return f"{ensure_checkpoint_dir(s)}/{name}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int = 7) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show."""
    return df.select(*(nudged(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`").alias(c) for c, t in df.dtypes))


def pick(df: DataFrame, *names: str, digits: int = 7) -> DataFrame:
    return rounded(df.select(*names), digits)


# ---- scans, projections, filters, symbols, times


@query("s5_projection", "SELECT count(*) AS n, CAST(sum(k) AS BIGINT) AS k FROM (SELECT seq % 7 AS k FROM trades_v)")
def _(s, d):
    return views.trades(s, d).select((F.col("seq") % 7).alias("k")).agg(F.count("*").alias("n"), F.sum("k").alias("k"))


@query("p1_predicates", "SELECT seq, symbol, price FROM trades_v WHERE price BETWEEN 10 AND 50 AND side = 'buy' AND exchange IN ('x0') AND amount >= 1.5 AND symbol <> 'S1-USD'")
def _(s, d):
    where = [("price", "between", (10, 50)), ("side", "=", "buy"), ("exchange", "in", ["x0"]), ("amount", ">=", 1.5), ("symbol", "!=", "S1-USD")]
    return views.trades(s, d).filter(filters.predicate(where)).select("seq", "symbol", "price")


@query("p2_filter_spec", """SELECT seq, symbol, price FROM trades_v WHERE symbol IN ('S3-USD', 'S3-USDC') AND exchange = 'x1'
    AND ms >= epoch_ms(TIMESTAMP '2024-01-05') AND ms < epoch_ms(TIMESTAMP '2024-01-12')""")
def _(s, d):
    spec = filters.FilterSpec("x1", "S3-USD", start_date="2024-01-05", end_date="2024-01-11")
    return spec.apply(views.trades(s, d)).select("seq", "symbol", "price")


@query("p9_date_parts", """SELECT seq, CAST(year(make_timestamp(ms * 1000)) AS INT) AS year, CAST(month(make_timestamp(ms * 1000)) AS INT) AS month,
    CAST(day(make_timestamp(ms * 1000)) AS INT) AS day, CAST(hour(make_timestamp(ms * 1000)) AS INT) AS hour FROM trades_v""")
def _(s, d):
    return features.add_date_columns(views.trades(s, d)).select("seq", "year", "month", "day", "hour")


@query("p11_sanitize", "SELECT DISTINCT symbol, regexp_replace(replace(symbol, '-', '/'), '[/:]', '-', 'g') AS safe FROM trades_v")
def _(s, d):
    return views.trades(s, d).select("symbol", E.sanitize(F.translate("symbol", "-", "/")).alias("safe")).distinct()


@query("f1_normalize_symbol", "SELECT regexp_replace(symbol, '-(USDC|USDT)$', '-USD') AS symbol, count(*) AS n FROM trades_v GROUP BY 1")
def _(s, d):
    return views.trades(s, d).groupBy(E.normalize_symbol().alias("symbol")).agg(F.count("*").alias("n"))


@query("f2_currencies", "SELECT DISTINCT symbol, split_part(symbol, '-', 1) AS base, split_part(symbol, '-', 2) AS quote, true AS usd FROM trades_v")
def _(s, d):
    return views.trades(s, d).select("symbol", E.base_currency().alias("base"), E.quote_currency().alias("quote"), E.is_usd_quoted().alias("usd")).distinct()


@query("f5_parse_time", "SELECT seq, ms FROM trades_v")
def _(s, d):
    t = views.trades(s, d)
    text = F.when(F.col("seq") % 3 == 0, F.date_format(E.from_ms("ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(F.col("ms").cast("string"))
    return t.select("seq", F.unix_millis(E.parse_utc(text)).alias("ms"))


_CAL = """CAST(isodow(make_timestamp(ms * 1000)) AS INT) AS day_of_week, CAST(isodow(make_timestamp(ms * 1000)) >= 5 AS INT) AS is_weekend,
    CAST(isodow(make_timestamp(ms * 1000)) >= 6 AS INT) AS is_weekend_iso"""


@query("f13_ticker_features", f"""SELECT seq, round(ask - bid, 7) AS spread, round((bid + ask) / 2, 7) AS mid_price, round((ask - bid) / ((bid + ask) / 2), 9) AS relative_spread,
    round((bid_volume - ask_volume) / (bid_volume + ask_volume), 7) AS volume_imbalance, {_CAL} FROM ticker_v""")
def _(s, d):
    t = features.ticker_features(views.ticker(s, d))
    return t.select("seq", *(nudged(c, 7).alias(c) for c in ("spread", "mid_price", "volume_imbalance")), nudged("relative_spread", 9).alias("relative_spread"), "day_of_week", "is_weekend", "is_weekend_iso")


_TF = """tf AS (SELECT *, CAST(side = 'buy' AS TINYINT) AS is_buy, price * amount AS dollar_volume,
    ln(price) - ln(lag(price) OVER (PARTITION BY exchange, symbol ORDER BY ms, seq)) AS log_return FROM trades_v)"""


@query("f14_trade_features", f", {_TF} SELECT seq, is_buy, round(dollar_volume, 7) AS dollar_volume, CASE WHEN is_buy = 1 THEN amount ELSE -amount END AS signed_volume, round(log_return, 9) AS log_return FROM tf")
def _(s, d):
    t = features.trade_features(views.trades(s, d))
    return t.select("seq", "is_buy", nudged("dollar_volume", 7).alias("dollar_volume"), "signed_volume", nudged("log_return", 9).alias("log_return"))


@query("f15_vendor_trades", "SELECT seq, round(price * amount, 7) AS value, side AS side_normalized, CASE side WHEN 'buy' THEN 1 ELSE -1 END AS direction FROM trades_v")
def _(s, d):
    return pick(features.vendor_trades(views.trades(s, d)), "seq", "value", "side_normalized", "direction")


# ---- bars and resampling


@query("a3_trade_bars", f""", {_TF} SELECT exchange, symbol, ms // 3600000 * 3600000 AS bar_ms, min_by(price, ms * 1000000 + seq) AS open, max(price) AS high, min(price) AS low,
    max_by(price, ms * 1000000 + seq) AS close, round(sum(amount), 7) AS volume, round(sum(dollar_volume), 7) AS dollar_volume, count(*) AS trade_count,
    round(coalesce(sum(amount) FILTER (is_buy = 1), 0), 7) AS buy_volume, round(coalesce(sum(amount) FILTER (is_buy = 0), 0), 7) AS sell_volume,
    round(var_samp(log_return), 9) AS realized_variance, round(sum(dollar_volume) / sum(amount), 9) AS vwap,
    round((coalesce(sum(amount) FILTER (is_buy = 1), 0) - coalesce(sum(amount) FILTER (is_buy = 0), 0)) / sum(amount), 9) AS trade_imbalance,
    round((max_by(price, ms * 1000000 + seq) - min_by(price, ms * 1000000 + seq)) / min_by(price, ms * 1000000 + seq), 9) AS "return"
    FROM tf GROUP BY ALL""")
def trade_bars_hourly(s, d):
    b = bars.trade_bars(features.trade_features(views.trades(s, d)), HOUR)
    nine = ("realized_variance", "vwap", "trade_imbalance", "return")
    return b.select("exchange", "symbol", "bar_ms", "open", "high", "low", "close", "trade_count", *(nudged(c, 7).alias(c) for c in ("volume", "dollar_volume", "buy_volume", "sell_volume")), *(nudged(c, 9).alias(c) for c in nine))


@query("a1_mid_bars", """, t AS (SELECT *, (bid + ask) / 2 AS mid, ask - bid AS sp FROM ticker_v)
    SELECT exchange, symbol, ms // 3600000 * 3600000 AS bar_ms, round(min_by(mid, ms * 1000000 + seq), 7) AS open, round(max(mid), 7) AS high, round(min(mid), 7) AS low,
    round(max_by(mid, ms * 1000000 + seq), 7) AS close, count(*) AS tick_count, round(avg(sp), 7) AS mean_spread, round(min(sp), 7) AS min_spread, round(max(sp), 7) AS max_spread,
    3600 AS bar_duration_sec FROM t GROUP BY exchange, symbol, ms // 3600000""")
def _(s, d):
    b = bars.mid_bars(features.ticker_features(views.ticker(s, d)), HOUR)
    return pick(b, "exchange", "symbol", "bar_ms", "open", "high", "low", "close", "tick_count", "mean_spread", "min_spread", "max_spread", "bar_duration_sec")


_TOP = """top AS (SELECT seq, exchange, symbol, ms, bp, bs, ap, az, bp[1] AS bb, ap[1] AS ba, (bp[1] + ap[1]) / 2 AS mid, ap[1] - bp[1] AS sp,
    (ap[1] - bp[1]) / ((bp[1] + ap[1]) / 2) AS rs FROM books_v)"""
_FLOW = f"""{_TOP}, pv AS (SELECT *, lag(ms) OVER w AS pms, lag(bb) OVER w AS pbb, lag(bs[1]) OVER w AS pbs, lag(ba) OVER w AS pba, lag(az[1]) OVER w AS paz, lag(mid) OVER w AS pmid
    FROM top WINDOW w AS (PARTITION BY exchange, symbol ORDER BY ms, seq)),
  fl AS (SELECT *, CASE WHEN pms IS NULL OR ms - pms > 300000 THEN 0.0 ELSE
      (CASE WHEN bb > pbb THEN bs[1] WHEN bb < pbb THEN -pbs ELSE bs[1] - pbs END) - (CASE WHEN ba > pba THEN -paz WHEN ba < pba THEN az[1] ELSE az[1] - paz END) END AS ofi,
    CASE WHEN pms IS NULL OR ms - pms > 300000 THEN 0.0 ELSE ln(mid) - ln(pmid) END AS lr FROM pv)"""


def _flow(s, d):
    return flow.order_flow(book.top_of_book(views.books(s, d)))


@query("a2_book_bars", f""", {_FLOW} SELECT exchange, symbol, ms // 900000 * 900000 AS bar_ms, round(min_by(mid, ms), 7) AS open, round(max(mid), 7) AS high, round(min(mid), 7) AS low,
    round(max_by(mid, ms), 7) AS close, round(avg(sp), 7) AS mean_spread, round(sum(ofi), 6) AS sum_ofi, round(var_samp(lr), 9) AS realized_variance, count(*) AS snapshot_count,
    round(sqrt(var_samp(lr)) * sqrt(96), 7) AS annualized_vol FROM fl GROUP BY exchange, symbol, ms // 900000""")
def _(s, d):
    b = bars.book_bars(_flow(s, d), 900)
    return b.select("exchange", "symbol", "bar_ms", *(nudged(c, 7).alias(c) for c in ("open", "high", "low", "close", "mean_spread", "annualized_vol")), nudged("sum_ofi", 6).alias("sum_ofi"), nudged("realized_variance", 9).alias("realized_variance"), "snapshot_count")


@query("a5_resample_book", f""", {_TOP} SELECT exchange, symbol, ms // 60000 * 60000 + 60000 AS label_ms, max_by(bb, ms) AS best_bid, max_by(len(bp), ms) AS levels, count(*) AS n_rows,
    ms // 60000 * 60000 + 60000 - max(ms) AS staleness_ms, ms // 60000 * 60000 + 60000 - max(ms) > 30000 AS is_stale FROM top GROUP BY exchange, symbol, ms // 60000""")
def _(s, d):
    r = bars.resample(views.books(s, d), "1m", {"bids": "last", "asks": "last"}, max_staleness="30s")
    return r.select("exchange", "symbol", "label_ms", F.get("bids", F.lit(0))["price"].alias("best_bid"), F.size("bids").cast("long").alias("levels"), "n_rows", "staleness_ms", "is_stale")


@query("a6_resample_series", """SELECT exchange, symbol, ms // 3600000 * 3600000 + 3600000 AS label_ms, min_by(price, ms * 1000000 + seq) AS price, round(sum(amount), 7) AS amount,
    count(*) AS n_rows FROM trades_v GROUP BY exchange, symbol, ms // 3600000""")
def _(s, d):
    return pick(bars.resample(views.trades(s, d), "1h", {"price": "first", "amount": "sum"}), "exchange", "symbol", "label_ms", "price", "amount", "n_rows")


@query("a7_resample_stats", """, r AS (SELECT ms // 3600000 * 3600000 + 3600000 - max(ms) AS st FROM trades_v GROUP BY exchange, symbol, ms // 3600000)
    SELECT count(*) AS n_buckets, round(avg(st), 5) AS avg_staleness, max(st) AS max_staleness, min(st) AS min_staleness, round(median(st), 5) AS median_staleness,
    CAST(count(*) FILTER (st > 1800000) AS BIGINT) AS stale_rows, round(count(*) FILTER (st > 1800000) * 100 / count(*), 5) AS stale_pct FROM r""")
def _(s, d):
    return rounded(bars.resample_stats(bars.resample(views.trades(s, d), "1h", {"price": "last"}, max_staleness="30m")), 5)


@query("w13_fill_gaps", """, g AS (SELECT exchange, symbol, ms // 3600000 * 3600000 + 3600000 AS l, max_by(price, ms * 1000000 + seq) AS price, count(*) AS n FROM trades_v GROUP BY ALL),
  a AS (SELECT exchange, symbol, unnest(range(min(l), max(l) + 1, 3600000)) AS l FROM g GROUP BY exchange, symbol)
  SELECT a.exchange, a.symbol, a.l AS label_ms, last_value(price IGNORE NULLS) OVER (PARTITION BY a.exchange, a.symbol ORDER BY a.l ROWS UNBOUNDED PRECEDING) AS price,
    coalesce(n, 0) AS n_rows FROM a LEFT JOIN g ON a.exchange = g.exchange AND a.symbol = g.symbol AND a.l = g.l""")
def _(s, d):
    return bars.resample(views.trades(s, d), "1h", {"price": "last"}, fill_gaps=True).select("exchange", "symbol", "label_ms", "price", "n_rows")


@query("a8_duplicates", "SELECT symbol, ms // 3600000 AS hour, count(*) AS n FROM trades_v GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    return views.trades(s, d).groupBy("symbol", F.floor(F.col("ms") / 3_600_000).alias("hour")).agg(F.count("*").alias("n")).filter("n > 1")


@query("a9_size_estimate", """SELECT CAST(sum(r) AS BIGINT) AS total_rows, count(*) AS partitions, round(avg(r), 7) AS avg_rows, round(sum(r) * 1024 / 1e6, 7) AS est_mb
    FROM (SELECT count(*) AS r FROM trades_v GROUP BY exchange, symbol)""")
def _(s, d):
    return rounded(tables.size_estimate(views.trades(s, d), ["exchange", "symbol"]))


@query("a10_top_groups", "SELECT symbol, count(*) AS n, round(avg(price), 7) AS avg_price, min(price) AS low, max(price) AS high FROM trades_v WHERE side = 'buy' GROUP BY symbol ORDER BY n DESC, symbol LIMIT 10")
def _(s, d):
    g = views.trades(s, d).filter("side = 'buy'").groupBy("symbol").agg(F.count("*").alias("n"), F.avg("price").alias("avg_price"), F.min("price").alias("low"), F.max("price").alias("high"))
    return rounded(g.orderBy(F.desc("n"), "symbol").limit(10))


@query("a11_count_bars", """, n AS (SELECT *, (row_number() OVER (PARTITION BY exchange, symbol ORDER BY ms, seq) - 1) // 50 AS bar FROM trades_v),
  g AS (SELECT exchange, symbol, bar, min_by(price, ms * 1000000 + seq) AS o, max_by(price, ms * 1000000 + seq) AS c, max(price) AS h, min(price) AS l, stddev_pop(price) / avg(price) AS v FROM n GROUP BY ALL HAVING count(*) = 50),
  r AS (SELECT *, (c - o) / o AS ret FROM g),
  x AS (SELECT exchange, symbol, bar, o AS open, c AS close, round(v, 7) AS volatility, round(ret, 7) AS return_pct, round(lead(ret) OVER w, 7) AS forward_return, round(lag(ret, 3) OVER w, 7) AS return_lag_3,
    round((c - lag(c, 3) OVER w) / lag(c, 3) OVER w, 7) AS momentum_3 FROM r WINDOW w AS (PARTITION BY exchange, symbol ORDER BY bar))
  SELECT * FROM x WHERE forward_return IS NOT NULL AND return_lag_3 IS NOT NULL""")
def _(s, d):
    return pick(bars.count_bars(views.trades(s, d), "price", 50), "exchange", "symbol", "bar", "open", "close", "volatility", "return_pct", "forward_return", "return_lag_3", "momentum_3")


# ---- windows and joins

_W = "PARTITION BY exchange, symbol ORDER BY ms, seq"


@query("w5_forward_return", f"SELECT seq, round(coalesce((lead(price, 10) OVER w - price) / price, 0), 7) AS fwd, round(coalesce(ln(lead(price, 10) OVER w) - ln(price), 0), 7) AS fwd_log FROM trades_v WINDOW w AS ({_W})")
def _(s, d):
    return rounded(views.trades(s, d).select("seq", W.forward_return("price", 10).alias("fwd"), W.forward_return("price", 10, log=True).alias("fwd_log")))


@query("w6_zscore", f""", z AS (SELECT seq, price, row_number() OVER ({_W}) AS rn, avg(price) OVER ({_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS m,
    stddev_pop(price) OVER ({_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS sd FROM trades_v) SELECT seq, round(CASE WHEN rn > 20 AND sd > 0 THEN (price - m) / sd ELSE 0 END, 6) AS z FROM z""")
def _(s, d):
    return rounded(views.trades(s, d).select("seq", W.zscore("price", 20).alias("z")), 6)


def _z_sql(x: str) -> str:
    w = f"OVER ({_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN row_number() OVER ({_W}) > 20 AND stddev_pop({x}) {w} > 0 THEN ({x} - avg({x}) {w}) / stddev_pop({x}) {w} ELSE 0 END"


@query("w7_composite", f"SELECT seq, round(({_z_sql('price')}) * (2 / 3) - ({_z_sql('amount')}) * (1 / 3), 6) AS signal FROM trades_v")
def _(s, d):
    return rounded(views.trades(s, d).select("seq", W.composite({"price": 2.0, "amount": -1.0}, 20).alias("signal")), 6)


@query("w9_rolling", f"SELECT seq, round(CASE WHEN row_number() OVER ({_W}) >= 10 THEN avg(price) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END, 7) AS mean_10 FROM trades_v")
def _(s, d):
    return rounded(views.trades(s, d).select("seq", W.rolling(F.avg("price"), 10).alias("mean_10")))


@query("w3_hopping", f""", q AS (SELECT *, (bid + ask) / 2 AS mid, ask - bid AS sp FROM ticker_v) SELECT seq, round(avg(mid) OVER x, 9) AS mean_mid, count(mid) OVER x AS n
    FROM q WINDOW x AS (PARTITION BY exchange, symbol ORDER BY ms // 1000 RANGE BETWEEN 36000 PRECEDING AND 1 PRECEDING)""")
def _(s, d):
    t = features.ticker_features(views.ticker(s, d))
    return pick(W.hopping(t, {"mean_mid": F.avg("mid_price"), "n": F.count("mid_price")}, 36000), "seq", "mean_mid", "n", digits=9)


@query("w4_trade_rolling", f""", {_TF} SELECT seq, round(sum(amount) OVER x, 9) AS volume, count(*) OVER x AS n, round(sum(dollar_volume) OVER x / sum(amount) OVER x, 9) AS vwap, round(avg(is_buy) OVER x, 9) AS buy_ratio
    FROM tf WINDOW x AS (PARTITION BY exchange, symbol ORDER BY ms RANGE BETWEEN 86399999 PRECEDING AND CURRENT ROW)""")
def _(s, d):
    t = features.trade_rolling(features.trade_features(views.trades(s, d)), (86400,), "continuous")
    return rounded(t.select("seq", F.col("volume_86400s").alias("volume"), F.col("trade_count_86400s").alias("n"), F.col("vwap_86400s").alias("vwap"), F.col("buy_ratio_86400s").alias("buy_ratio")), 9)


@query("w10_drawdown", f"SELECT seq, round(price - max(price) OVER ({_W} ROWS UNBOUNDED PRECEDING), 7) AS dd, round((price - max(price) OVER ({_W} ROWS UNBOUNDED PRECEDING)) / max(price) OVER ({_W} ROWS UNBOUNDED PRECEDING), 7) AS dd_pct FROM trades_v")
def _(s, d):
    a, b = W.drawdown("price", W.ordered())
    return rounded(views.trades(s, d).select("seq", a.alias("dd"), b.alias("dd_pct")))


@query("w11_runs", f""", f AS (SELECT seq, exchange, symbol, ms, side, row_number() OVER ({_W}) - row_number() OVER (PARTITION BY exchange, symbol, side ORDER BY ms, seq) AS g FROM trades_v)
    SELECT seq, row_number() OVER (PARTITION BY exchange, symbol, side, g ORDER BY ms, seq) AS run FROM f""")
def _(s, d):
    return W.runs(views.trades(s, d), F.col("side")).select("seq", F.col("run").cast("long").alias("run"))


@query("w14_every_nth", f"SELECT seq FROM (SELECT seq, row_number() OVER ({_W}) AS n FROM trades_v) WHERE (n - 1) % 5 = 0")
def _(s, d):
    return W.every_nth(views.trades(s, d), 5).select("seq")


@query("w15_cumulative", f"SELECT seq, round(sum(amount) OVER ({_W} ROWS UNBOUNDED PRECEDING), 6) AS cum FROM trades_v")
def _(s, d):
    w = W.ordered().rowsBetween(W.Window.unboundedPreceding, 0)
    return rounded(views.trades(s, d).select("seq", F.sum("amount").over(w).alias("cum")), 6)


@query("j1_asof", """SELECT t.seq, k.bid AS asof_bid FROM trades_v t ASOF LEFT JOIN (SELECT exchange, symbol, ms + 1234567 AS ms, max_by(bid, seq) AS bid FROM ticker_v GROUP BY 1, 2, 3) k
    ON t.exchange = k.exchange AND t.symbol = k.symbol AND t.ms >= k.ms""")
def _(s, d):
    # Quotes come some twenty minutes late; of quotes of one instrument at one time the last counts.
    k = views.ticker(s, d).groupBy("exchange", "symbol", (F.col("ms") + 1_234_567).alias("ms")).agg(F.max_by("bid", "seq").alias("bid"))
    return W.asof(views.trades(s, d), k, ["bid"]).select("seq", "asof_bid")


@query("j4_interleave", f""", {_TOP} SELECT l.seq, coalesce(b.seq, -1) AS snapshot_seq FROM lob_v l ASOF LEFT JOIN books_v b ON l.exchange = b.exchange AND l.symbol = b.symbol AND l.ms <= b.ms""")
def _(s, d):
    return W.interleave(views.book_trades(s, d), views.books(s, d)).select("seq", F.coalesce("snapshot_seq", F.lit(-1)).alias("snapshot_seq"))


@query("j5_upsert", """SELECT coalesce(n.exchange, o.exchange) AS exchange, coalesce(n.seq, o.seq) AS seq, coalesce(n.price, o.price) AS price, coalesce(o.amount, n.amount) AS amount
    FROM trades_v o FULL JOIN (SELECT exchange, seq + 500 AS seq, CASE WHEN seq % 5 = 0 THEN NULL ELSE price + 1 END AS price, amount FROM trades_v) n ON o.seq = n.seq AND o.exchange = n.exchange""")
def _(s, d):
    t, path = views.trades(s, d).select("exchange", "seq", "price", "amount"), scratch(s, "upsert")
    tables.write(t, path, ["exchange"])
    new = t.withColumns({"seq": F.col("seq") + 500, "price": F.when(F.col("seq") % 5 != 0, F.col("price") + 1)})
    tables.upsert(s, path, new, ["seq"], ["exchange"], ["price"])
    return tables.read(s, path).select("exchange", "seq", "price", "amount")


@query("j6_anti_join", "SELECT seq FROM trades_v WHERE seq NOT IN (SELECT seq FROM trades_v WHERE side = 'buy')")
def _(s, d):
    t = views.trades(s, d).select("seq", "side")
    return tables.not_done(t, t.filter("side = 'buy'"), ["seq"]).select("seq")


@query("j8_asset_matrix", """, h AS (SELECT ms // 14400000 AS t, replace(symbol, 'USDC', 'USD') AS s, avg(price) AS p FROM trades_v GROUP BY ALL)
    SELECT a.t, round(a.p, 7) AS s1_usd_p, round(b.p, 7) AS s2_usd_p, round(c.p, 7) AS s3_usd_p FROM (SELECT * FROM h WHERE s = 'S1-USD') a JOIN (SELECT * FROM h WHERE s = 'S2-USD') b ON a.t = b.t JOIN (SELECT * FROM h WHERE s = 'S3-USD') c ON a.t = c.t""")
def _(s, d):
    h = views.trades(s, d).groupBy(F.floor(F.col("ms") / 14_400_000).alias("t"), E.normalize_symbol().alias("s")).agg(F.avg("price").alias("p"))
    m = h.groupBy("t").pivot("s", ["S1-USD", "S2-USD", "S3-USD"]).agg(F.first("p")).dropna()
    return rounded(m.select("t", *(F.col(f"`{x}`").alias(f"{x.lower().replace('-', '_')}_p") for x in ("S1-USD", "S2-USD", "S3-USD"))))


@query("u3_keep_first", "SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY symbol, side ORDER BY ms, seq) AS n FROM trades_v) WHERE n = 1")
def _(s, d):
    return W.keep_first(views.trades(s, d), ["symbol", "side"], ["ms", "seq"]).select("seq")


@query("u1_union_distinct", "SELECT DISTINCT exchange, symbol FROM (SELECT exchange, symbol FROM trades_v UNION ALL SELECT exchange, symbol FROM books_v)")
def _(s, d):
    return views.trades(s, d).select("exchange", "symbol").unionByName(views.books(s, d).select("exchange", "symbol")).distinct()


@query("u6_explode_levels", "SELECT seq, lvl AS i, round(p * (1 - 0.0005 * (lvl + 1)), 6) AS price, q AS size FROM levels_v")
def _(s, d):
    return rounded(views.books(s, d).select("seq", F.posexplode("bids").alias("p", "l")).select("seq", F.col("p").cast("long").alias("i"), "l.price", "l.size"), 6)


@query("x1_delete", "SELECT seq, side FROM trades_v WHERE NOT coalesce(price > 50, false)")
def _(s, d):
    path = scratch(s, "delete")
    tables.write(views.trades(s, d), path, ["exchange", "side"])
    tables.delete(s, path, F.col("price") > 50)
    return tables.read(s, path).select("seq", "side")


@query("x2_update", "SELECT seq, CASE WHEN side = 'buy' THEN price * 2 ELSE price END AS price, CASE WHEN side = 'buy' THEN price * 2 + amount ELSE amount END AS amount FROM trades_v")
def _(s, d):
    path = scratch(s, "update")
    tables.write(views.trades(s, d), path, ["exchange", "symbol"])
    tables.update(s, path, F.col("side") == "buy", {"price": F.col("price") * 2, "amount": F.col("price") + F.col("amount")})
    return tables.read(s, path).select("seq", "price", "amount")


@query("s12_manifest", "SELECT exchange, symbol, count(DISTINCT ms // 3600000) AS hours, min(ms) // 3600000 * 3600000 AS first_ms, max(ms) // 3600000 * 3600000 AS last_ms FROM trades_v GROUP BY 1, 2")
def _(s, d):
    return tables.manifest(views.trades(s, d))


# ---- book features


def _sum(side: str, n: int, what: str = "s") -> str:
    p, q = ("bp", "bs") if side == "b" else ("ap", "az")
    x = {"s": f"{q}[1:{n}]", "pv": f"list_transform(range(1, least({n}, len({q})) + 1), lambda i: {p}[i] * {q}[i])", "sq": f"list_transform({q}[1:{n}], lambda x: x * x)"}[what]
    return f"coalesce(list_sum({x}), 0)"


@query("m1_top_of_book", f""", {_TOP} SELECT seq, round(bb, 6) AS best_bid, round(ba, 6) AS best_ask, round(mid, 6) AS mid_price, round(sp, 6) AS spread, round(rs, 9) AS relative_spread,
    round((bb * az[1] + ba * bs[1]) / (bs[1] + az[1]), 6) AS microprice, round((bs[1] - az[1]) / (bs[1] + az[1]), 9) AS imbalance_l1 FROM top""")
def _(s, d):
    t = book.top_of_book(views.books(s, d))
    return t.select("seq", *(nudged(c, 6).alias(c) for c in ("best_bid", "best_ask", "mid_price", "spread", "microprice")), nudged("relative_spread", 9).alias("relative_spread"), nudged("imbalance_L1", 9).alias("imbalance_l1"))


@query("m3_structural", f""", {_TOP} SELECT seq, round({_sum('b', 20)}, 6) AS total_bid_depth, round({_sum('a', 20)}, 6) AS total_ask_depth,
    round(({_sum('b', 20)} - {_sum('a', 20)}) / ({_sum('b', 20)} + {_sum('a', 20)}), 8) AS total_imbalance,
    round({_sum('b', 5, 'pv')} / {_sum('b', 5)}, 5) AS vwap_bid_5, round({_sum('a', 5, 'pv')} / {_sum('a', 5)}, 5) AS vwap_ask_5,
    round(({_sum('b', 20, 'pv')} + {_sum('a', 20, 'pv')}) / ({_sum('b', 20)} + {_sum('a', 20)}), 5) AS center_of_gravity,
    round({_sum('b', 20, 'sq')} / ({_sum('b', 20)} * {_sum('b', 20)}), 8) AS bid_concentration,
    round(coalesce(bs[5], 0) / bs[1], 8) AS bid_depth_decay_5, round(abs(bp[1] - coalesce(bp[5], 0)) / {_sum('b', 5)}, 5) AS bid_slope,
    round(sp / ({_sum('b', 3)} + {_sum('a', 3)}), 6) AS lambda_like, round(sp / ({_sum('b', 6)} + {_sum('a', 6)}), 6) AS amihud_like,
    round(({_sum('b', 10)} - {_sum('a', 10)}) / ({_sum('b', 10)} + {_sum('a', 10)}), 8) AS imbalance_l10 FROM top""")
def book_structural(s, d):
    t = book.structural(views.books(s, d))
    digits = {"total_bid_depth": 6, "total_ask_depth": 6, "total_imbalance": 8, "vwap_bid_5": 5, "vwap_ask_5": 5, "center_of_gravity": 5, "bid_concentration": 8, "bid_depth_decay_5": 8, "bid_slope": 5, "lambda_like": 6, "amihud_like": 6}
    return t.select("seq", *(nudged(c, n).alias(c) for c, n in digits.items()), nudged("imbalance_L10", 8).alias("imbalance_l10"))


@query("m5_smart_depth", f""", {_TOP} SELECT seq, round(coalesce(list_sum(list_transform(range(1, least(20, len(bs)) + 1), lambda i: bs[i] * exp(-100 * abs(bp[i] - mid) / mid))), 0), 7) AS smart_bid_depth,
    round(coalesce(list_sum(list_transform(range(1, least(20, len(az)) + 1), lambda i: az[i] * exp(-100 * abs(ap[i] - mid) / mid))), 0), 7) AS smart_ask_depth FROM top""")
def _(s, d):
    return pick(book.structural(views.books(s, d)), "seq", "smart_bid_depth", "smart_ask_depth")


@query("m12_index_bands", f"""SELECT seq, round(coalesce(list_sum(bs[1:2]), 0), 6) AS b05, round(coalesce(list_sum(bs[3:4]), 0), 6) AS b510, round(coalesce(list_sum(az[5:7]), 0), 6) AS a1025 FROM books_v""")
def _(s, d):
    t = book.index_bands(views.books(s, d))
    return rounded(t.select("seq", F.col("bid_vol_band_0_5bps").alias("b05"), F.col("bid_vol_band_5_10bps").alias("b510"), F.col("ask_vol_band_10_25bps").alias("a1025")), 6)


def _band(p: str, q: str, a: int, b: int) -> str:
    dist = f"abs({p}[i] - mid) / mid * 10000"
    return f"coalesce(list_sum(list_transform(list_filter(range(1, len({q}) + 1), lambda i: {dist} >= {a} AND {dist} < {b}), lambda i: {q}[i])), 0)"


@query("m14_exact_bands", f", {_TOP} SELECT seq, round({_band('bp', 'bs', 0, 12)}, 6) AS b12, round({_band('ap', 'az', 12, 33)}, 6) AS a33, round({_band('bp', 'bs', 33, 101)}, 6) AS b101 FROM top")
def _(s, d):
    t = book.exact_bands(book.top_of_book(views.books(s, d)), (12, 33, 101))
    return rounded(t.select("seq", F.col("bid_volume_0_12bps").alias("b12"), F.col("ask_volume_12_33bps").alias("a33"), F.col("bid_volume_33_101bps").alias("b101")), 6)


@query("m15_half_depth", """SELECT seq, CAST(len(list_filter(range(1, len(bs) + 1), lambda i: list_sum(bs[1:i]) < 0.5 * list_sum(bs))) + 1 AS INT) AS bid_levels FROM books_v""")
def _(s, d):
    return book.half_depth_levels(views.books(s, d)).select("seq", F.col("bid_50pct_depth_levels").alias("bid_levels"))


@query("m16_slope_regression", f""", {_TOP}, x AS (SELECT seq, unnest(range(1, least(10, len(bs)) + 1)) AS i, bp, bs, mid FROM top)
    SELECT seq, round(CASE WHEN count(*) >= 3 THEN regr_slope(list_sum(bs[1:i]), abs(bp[i] - mid) / mid * 10000) END, 5) AS bid_slope FROM x GROUP BY seq""")
def _(s, d):
    t = book.slope_regression(book.top_of_book(views.books(s, d)))
    return rounded(t.select("seq", F.col("bid_slope_regression").alias("bid_slope")), 5)


@query("m17_convexity", f", {_TOP} SELECT seq, round(({_band('bp', 'bs', 0, 5.0000001)} + {_band('ap', 'az', 0, 5.0000001)}) / nullif({_band('bp', 'bs', 0, 50.0000001)} + {_band('ap', 'az', 0, 50.0000001)}, 0), 8) AS book_convexity FROM top")
def _(s, d):
    t = book.top_of_book(views.books(s, d))
    dist = "abs(x.price - mid_price) / mid_price * 10000"
    n = lambda b: F.expr(f"aggregate(filter(concat(bids, asks), x -> {dist} < {b}), 0D, (a, x) -> a + x.size)")
    return rounded(t.select("seq", E.sdiv(n("5.0000001D"), n("50.0000001D")).alias("book_convexity")), 8)


# ---- path-dependent features


@query("d2_order_flow", f", {_FLOW} SELECT seq, round(ofi, 6) AS ofi, round(lr, 9) AS log_return FROM fl")
def order_flow(s, d):
    return _flow(s, d).select("seq", nudged("ofi", 6).alias("ofi"), nudged("log_return", 9).alias("log_return"))


def _levels_flow(weight: str) -> str:
    bid = "CASE WHEN bp[i] > pbp[i] THEN bs[i] WHEN bp[i] < pbp[i] THEN -pbz[i] ELSE bs[i] - pbz[i] END"
    ask = "CASE WHEN ap[i] > pap[i] THEN -paz[i] WHEN ap[i] < pap[i] THEN az[i] ELSE az[i] - paz[i] END"
    return f"coalesce(list_sum(list_transform(range(1, least(10, len(bp), len(pbp)) + 1), lambda i: ({bid}) * {weight} - ({ask}) * {weight})), 0)"


@query("d3_multi_level_flow", f""", l AS (SELECT seq, ms, bp, bs, ap, az, lag(ms) OVER w AS pms, lag(bp) OVER w AS pbp, lag(bs) OVER w AS pbz, lag(ap) OVER w AS pap, lag(az) OVER w AS paz
    FROM books_v WINDOW w AS (PARTITION BY exchange, symbol ORDER BY ms, seq))
    SELECT seq, round(CASE WHEN pms IS NULL OR ms - pms > 300000 THEN 0 ELSE {_levels_flow('exp(-0.5::DOUBLE * (i - 1))')} END, 7) AS mlofi,
      round(CASE WHEN pms IS NULL OR ms - pms > 300000 THEN 0 ELSE {_levels_flow('1')} END, 7) AS ofi_multi FROM l""")
def _(s, d):
    return pick(_flow(s, d), "seq", "mlofi", "ofi_multi")


@query("d5_motion", f""", {_TOP}, l AS (SELECT seq, ms, mid, lag(ms) OVER w AS t1, lag(ms, 2) OVER w AS t2, lag(mid) OVER w AS m1, lag(mid, 2) OVER w AS m2 FROM top WINDOW w AS ({_W}))
    SELECT seq, round((mid - m1) * 1000 / (ms - t1), 7) AS mid_velocity, round(((mid - m1) * 1000 / (ms - t1) - (m1 - m2) * 1000 / (t1 - t2)) * 1000 / (ms - t1), 7) AS mid_accel FROM l""")
def _(s, d):
    return pick(flow.motion(book.top_of_book(views.books(s, d))), "seq", "mid_velocity", "mid_accel", digits=7)


_R = "OVER (PARTITION BY exchange, symbol ORDER BY ms RANGE BETWEEN {0} PRECEDING AND CURRENT ROW)"


@query("d6_rolling_flow", f", {_FLOW} SELECT seq, round(sum(ofi) {_R.format(59999)}, 5) + 0 AS ofi_sum_60s, round(coalesce(stddev_samp(lr) {_R.format(59999)}, 0), 8) AS rv_60s FROM fl")
def rolling_flow(s, d):
    t = flow.rolling_flow(_flow(s, d), (60,))
    return t.select("seq", (nudged("ofi_sum_60s", 5) + 0.0).alias("ofi_sum_60s"), nudged("rv_60s", 8).alias("rv_60s"))


@query("d8_trade_flow", f""", att AS (SELECT b.seq, sum(CASE WHEN l.side = 'buy' THEN l.amount ELSE 0 END) AS bv, sum(CASE WHEN l.side = 'sell' THEN l.amount ELSE 0 END) AS sv
      FROM lob_v l ASOF JOIN books_v b ON l.exchange = b.exchange AND l.symbol = b.symbol AND l.ms <= b.ms GROUP BY b.seq),
    q AS (SELECT b.*, coalesce(bv, 0) AS bv, coalesce(sv, 0) AS sv FROM books_v b LEFT JOIN att ON b.seq = att.seq)
    SELECT seq, round(coalesce((sum(bv) {_R.format(59999)} - sum(sv) {_R.format(59999)}) / nullif(sum(bv) {_R.format(59999)} + sum(sv) {_R.format(59999)}, 0), 0), 8) AS tfi_60s,
      round(sum(bv) {_R.format(59999)} + sum(sv) {_R.format(59999)}, 5) AS trade_vol_60s FROM q""")
def _(s, d):
    t = flow.trade_flow(views.books(s, d), views.book_trades(s, d), (60,))
    return t.select("seq", nudged("tfi_60s", 8).alias("tfi_60s"), nudged("trade_vol_60s", 5).alias("trade_vol_60s"))


@query("d10_spread_regime", f""", l AS (SELECT seq, exchange, symbol, ms, bs[1] AS v, list(bs[1]) {_R.format(299999)} AS w FROM books_v),
    p AS (SELECT *, coalesce(len(list_filter(w, lambda x: x < v)) / len(w), 0.5) AS pct FROM l),
    r AS (SELECT *, CASE WHEN pct <= 0.2::DOUBLE THEN 'tight' WHEN pct >= 0.8::DOUBLE THEN 'wide' ELSE 'normal' END AS regime FROM p),
    d AS (SELECT *, lag(regime) OVER ({_W}) AS r0, (ms - lag(ms) OVER ({_W})) / 1000 AS dt FROM r)
    SELECT seq, round(pct, 7) AS spread_percentile, regime AS spread_regime,
      round(coalesce(sum(CASE WHEN r0 = 'tight' THEN dt ELSE 0 END) {_R.format(299999)} / nullif(sum(dt) {_R.format(299999)}, 0), 0), 7) AS tight_spread_pct,
      round(coalesce(sum(CASE WHEN r0 = 'wide' THEN dt ELSE 0 END) {_R.format(299999)} / nullif(sum(dt) {_R.format(299999)}, 0), 0), 7) AS wide_spread_pct FROM d""")
def _(s, d):
    t = book.top_of_book(views.books(s, d)).withColumn("relative_spread", F.col("top_bid_size"))
    return pick(flow.spread_regime(t), "seq", "spread_percentile", "spread_regime", "tight_spread_pct", "wide_spread_pct")


@query("d9_size_percentile", f""", l AS (SELECT seq, bs[1] AS v, list(bs[1]) {_R.format(299999)} AS w FROM books_v) SELECT seq, round(len(list_filter(w, lambda x: x < v)) / len(w), 8) AS pct FROM l""")
def _(s, d):
    t = book.top_of_book(views.books(s, d))
    return rounded(t.select("seq", W.spread_percentile("top_bid_size", 300).alias("pct")), 8)


@query("d11_kyle_lambda", f""", {_FLOW}, k AS (SELECT seq, count(*) {_R.format(299999)} AS n, covar_pop(lr, ofi) {_R.format(299999)} AS c, var_pop(ofi) {_R.format(299999)} AS vx FROM fl)
    SELECT seq, round(CASE WHEN n >= 2 AND vx >= 1e-10 THEN c / vx ELSE 0 END, 7) AS kyle_lambda FROM k""")
def _(s, d):
    return pick(flow.kyle_lambda(_flow(s, d)), "seq", "kyle_lambda")


@query("d14_vpin", """, c AS (SELECT *, sum(amount) OVER (PARTITION BY exchange, symbol ORDER BY ms, seq ROWS UNBOUNDED PRECEDING) AS hi FROM lob_v),
    e AS (SELECT *, hi - amount AS lo, unnest(range(CAST(floor((hi - amount) / 500) AS BIGINT), CAST(floor(hi / 500) AS BIGINT) + 1)) AS bucket FROM c),
    b AS (SELECT exchange, symbol, bucket, sum((least(hi, (bucket + 1) * 500) - greatest(lo, bucket * 500)) * (side = 'buy')::INT) AS bv, sum(least(hi, (bucket + 1) * 500) - greatest(lo, bucket * 500)) AS t FROM e GROUP BY ALL)
    SELECT exchange, symbol, bucket, round(bv, 6) AS buy_volume, round(t - bv, 6) AS sell_volume, round(avg(abs(bv - (t - bv)) / 500) OVER (PARTITION BY exchange, symbol ORDER BY bucket ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 8) AS vpin
    FROM b WHERE t >= 500 * (1 - 1e-9)""")
def _(s, d):
    v = flow.vpin(views.book_trades(s, d), 500.0)
    return v.select("exchange", "symbol", "bucket", nudged("buy_volume", 6).alias("buy_volume"), nudged("sell_volume", 6).alias("sell_volume"), nudged("vpin", 8).alias("vpin"))


@query("d14_vpin_parity")
def _(s, d):
    return pick(seq.vpin_parity(views.book_trades(s, d), 500.0), "seq", "vpin", digits=8)


@query("d18_volume_bars", """, c AS (SELECT *, sum(amount) OVER (PARTITION BY exchange, symbol ORDER BY ms, seq ROWS UNBOUNDED PRECEDING) AS hi FROM lob_v),
    e AS (SELECT *, unnest(range(CAST(floor((hi - amount) / 1000) AS BIGINT), CAST(floor(hi / 1000) AS BIGINT) + 1)) AS bar FROM c),
    v AS (SELECT *, least(hi, (bar + 1) * 1000) - greatest(hi - amount, bar * 1000) AS v FROM e)
    SELECT exchange, symbol, bar, round(min_by(price, seq + ms * 1000000), 6) AS open, round(max(price), 6) AS high, round(max_by(price, seq + ms * 1000000), 6) AS close, count(*) AS trade_count,
      round(sum(price * v) / sum(v), 7) AS vwap, round(sum(CASE WHEN side = 'buy' THEN v ELSE 0 END) / sum(v), 8) AS buy_ratio, (max(ms) - min(ms)) / 1000 AS duration
    FROM v WHERE v > 0 GROUP BY exchange, symbol, bar HAVING sum(v) >= 1000 * (1 - 1e-9)""")
def _(s, d):
    b = flow.volume_bars(views.book_trades(s, d), 1000.0)
    return b.select("exchange", "symbol", "bar", *(nudged(c, 6).alias(c) for c in ("open", "high", "close")), "trade_count", nudged("vwap", 7).alias("vwap"), nudged("buy_ratio", 8).alias("buy_ratio"), "duration")


_FIRST = "f AS (SELECT exchange, symbol, ms, min(seq) AS seq FROM trades_v GROUP BY 1, 2, 3)"


@query("d19_throttle", f""", {_FIRST}, nx AS MATERIALIZED (SELECT a.exchange, a.symbol, a.seq, arg_min(b.seq, b.ms) AS seq1 FROM f a JOIN f b ON a.exchange = b.exchange AND a.symbol = b.symbol AND a.ms + 3600000 <= b.ms GROUP BY 1, 2, 3),
    r AS (SELECT exchange, symbol, arg_min(seq, ms) AS seq FROM f GROUP BY 1, 2 UNION ALL SELECT nx.exchange, nx.symbol, nx.seq1 FROM r JOIN nx ON r.seq = nx.seq)
    SELECT seq FROM r""", recursive=True)
def _(s, d):
    return seq.throttle(views.trades(s, d), 3_600_000).filter("emit").select("seq")


@query("r17_hit_count", f"SELECT seq, count(*) {_R.format(299999)} AS hits FROM trades_v")
def _(s, d):
    return flow.hit_count(views.trades(s, d)).select("seq", "hits")


_B, _A = _sum("b", 20), _sum("a", 20)


@query("f16_interactions", f""", {_FLOW}, rv AS (SELECT seq, coalesce(stddev_samp(lr) {_R.format(59999)}, 0) AS rv FROM fl),
    x AS (SELECT top.*, rv, ({_B} - {_A}) / ({_B} + {_A}) AS ti, {_B} AS tb, {_A} AS ta, (bs[1] - az[1]) / (bs[1] + az[1]) AS l1,
      ({_sum('b', 3)} - {_sum('a', 3)}) / ({_sum('b', 3)} + {_sum('a', 3)}) AS l3, ({_sum('b', 20, 'pv')} + {_sum('a', 20, 'pv')}) / ({_B} + {_A}) AS cog FROM top JOIN rv ON top.seq = rv.seq)
    SELECT seq, round(ti * rv, 6) AS imb_times_rv, round((tb - ta) / CASE WHEN ta > 0 THEN ta ELSE 1e-10 END, 6) AS depth_asymmetry, round(l1 - l3, 6) AS imb_gradient_1_3,
      round((cog - mid) * 10000 / mid * ti, 6) + 0 AS cog_imb FROM x""")
def _(s, d):
    t = flow.rolling_flow(flow.order_flow(book.structural(views.books(s, d))), (5, 15, 60, 300))
    return pick(features.interactions(t), "seq", "imb_times_rv", "depth_asymmetry", "imb_gradient_1_3", "cog_imb", digits=6).withColumn("cog_imb", F.col("cog_imb") + 0.0)


# ---- research


@query("r1_percentile_extreme", """, p AS (SELECT exchange, symbol, quantile_cont(price, 0.95) AS hi, quantile_cont(price, 0.05) AS lo FROM trades_v GROUP BY 1, 2)
    SELECT seq, CASE WHEN price <= lo THEN -1 WHEN price >= hi THEN 1 ELSE 0 END AS extreme FROM trades_v JOIN p USING (exchange, symbol)""")
def _(s, d):
    return research.percentile_extreme(views.trades(s, d), "price", 95.0).select("seq", "extreme")


_MOVE = "CAST(0.004 AS DOUBLE)"


@query("r1_optimal_trades", f""", n AS (SELECT exchange, symbol, seq, price, row_number() OVER ({_W}) - 1 AS i FROM trades_v),
    st AS (SELECT exchange, symbol, i, 1 AS seek, price AS best, i AS at, CAST(NULL AS BIGINT) AS hit, 0 AS label FROM n WHERE i = 0
      UNION ALL
      SELECT e.exchange, e.symbol, e.i, CASE WHEN e.trig THEN -e.seek ELSE e.seek END, CASE WHEN e.trig THEN e.price ELSE e.b END, CASE WHEN e.trig THEN e.i ELSE e.a END,
        CASE WHEN e.trig THEN e.a END, CASE WHEN e.trig THEN e.seek ELSE 0 END
      FROM (SELECT *, seek * (price - b * (1 + seek * {_MOVE})) > 0 AS trig FROM (SELECT n.exchange, n.symbol, n.i, n.price, st.seek,
          CASE WHEN st.seek * (n.price - st.best) < 0 THEN n.price ELSE st.best END AS b, CASE WHEN st.seek * (n.price - st.best) < 0 THEN n.i ELSE st.at END AS a
        FROM st JOIN n ON n.exchange = st.exchange AND n.symbol = st.symbol AND n.i = st.i + 1)) e)
    SELECT n.seq, CAST(st.label AS BIGINT) AS label FROM st JOIN n ON n.exchange = st.exchange AND n.symbol = st.symbol AND n.i = st.hit""", recursive=True)
def _(s, d):
    return seq.optimal_trades(views.trades(s, d), "price").filter("label <> 0").select("seq", "label")


_ALL = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("w8_volatility_regime", f""", {_TF}, v AS (SELECT *, CASE WHEN count(log_return) OVER x = 20 THEN stddev_pop(log_return) OVER x END AS rv FROM tf
      WINDOW x AS ({_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
    q AS (SELECT *, count(rv) {_ALL} AS n, quantile_cont(rv, 0.33) {_ALL} AS lo, quantile_cont(rv, 0.67) {_ALL} AS hi FROM v)
    SELECT seq, round(rv, 7) AS rv, CAST(CASE WHEN rv IS NULL OR n < 2 THEN 1 WHEN rv <= lo THEN 0 WHEN rv >= hi THEN 2 ELSE 1 END AS BIGINT) AS vol_regime FROM q""")
def _(s, d):
    t = features.trade_features(views.trades(s, d))
    return pick(seq.volatility_regime(t.select("exchange", "symbol", "ms", "seq", "log_return"), "log_return", 20), "seq", "rv", "vol_regime")


def _held(s, d):
    """A position from the direction of the last trade: long after a buy, short after a sell of over 1.5, else flat."""
    return views.trades(s, d).withColumn("position", F.expr("CASE WHEN side = 'buy' THEN 1 WHEN amount > 1.5 THEN -1 ELSE 0 END"))


def _log(held: str) -> str:
    """The trade log of h: rows with pos and i."""
    return f"""h AS ({held}),
    c AS (SELECT *, coalesce(lag(pos) OVER (PARTITION BY exchange, symbol ORDER BY i), 0) AS pp, max(i) OVER (PARTITION BY exchange, symbol) AS ei FROM h),
    e AS (SELECT exchange, symbol, price AS ep FROM c WHERE i = ei),
    s AS (SELECT *, lead(i) OVER (PARTITION BY exchange, symbol ORDER BY i) AS ni, lead(price) OVER (PARTITION BY exchange, symbol ORDER BY i) AS np FROM c WHERE pos <> pp),
    tl AS (SELECT exchange, symbol, i AS entry_idx, coalesce(ni, ei) AS exit_idx, pos AS direction, CASE WHEN pos = 1 THEN coalesce(np, ep) / price - 1 ELSE price / coalesce(np, ep) - 1 END AS gross
      FROM s JOIN e USING (exchange, symbol) WHERE pos <> 0)"""


_POS = "CASE WHEN side = 'buy' THEN 1 WHEN amount > 1.5 THEN -1 ELSE 0 END AS pos"
_LOG = _log(f"SELECT *, {_POS}, row_number() OVER ({_W}) - 1 AS i FROM trades_v")


@query("r3_trade_log", f", {_LOG} SELECT exchange, symbol, entry_idx, exit_idx, direction, round(gross, 7) AS gross_return, round(gross - 0.0001, 7) AS net_return FROM tl")
def _(s, d):
    t = research.trade_log(_held(s, d), "price")
    return t.select("exchange", "symbol", F.col("entry_idx").cast("long").alias("entry_idx"), F.col("exit_idx").cast("long").alias("exit_idx"), "direction", nudged("gross_return", 7).alias("gross_return"), nudged("net_return", 7).alias("net_return"))


@query("r4_summary", f", {_LOG} SELECT exchange, symbol, count(*) AS n_trades, round(avg((gross - 0.0001 > 0)::INT), 7) AS win_rate, round(avg(gross - 0.0001) * 100, 6) AS avg_trade_return_pct FROM tl GROUP BY 1, 2")
def _(s, d):
    t = research.summary(research.trade_log(_held(s, d), "price"))
    return t.select("exchange", "symbol", "n_trades", nudged("win_rate", 7).alias("win_rate"), nudged("avg_trade_return_pct", 6).alias("avg_trade_return_pct"))


_MACHINE = f"""z AS (SELECT exchange, symbol, seq, price, row_number() OVER ({_W}) - 1 AS i, -({_z_sql('price')}) AS s FROM trades_v),
    st AS (SELECT exchange, symbol, CAST(-1 AS BIGINT) AS i, 0 AS pos, CAST(0 AS BIGINT) AS entry FROM z WHERE i = 0
      UNION ALL
      SELECT exchange, symbol, i, p, CASE WHEN p <> 0 AND (p0 = 0 OR gone) THEN i ELSE entry END
      FROM (SELECT *, CASE WHEN p0 <> 0 AND NOT gone THEN p0 WHEN s > 1 THEN 1 WHEN s < -1 THEN -1 ELSE 0 END AS p
        FROM (SELECT z.exchange, z.symbol, z.i, z.s, st.entry, st.pos AS p0,
          st.pos <> 0 AND (z.i >= st.entry + 50 OR CASE WHEN st.pos = 1 THEN z.s < 0.2::DOUBLE ELSE z.s > -(0.2::DOUBLE) END) AS gone
          FROM st JOIN z ON z.exchange = st.exchange AND z.symbol = st.symbol AND z.i = st.i + 1)))"""


def _strategy(s, d):
    t = views.trades(s, d).withColumn("z", W.zscore("price", 20))
    return seq.positions(t.select("exchange", "symbol", "ms", "seq", "price", "z"), seq.mean_reversion(1.0, 0.2, 50), "z")


@query("r2_positions", f", {_MACHINE} SELECT z.seq, CAST(st.pos AS BIGINT) AS position FROM st JOIN z ON z.exchange = st.exchange AND z.symbol = st.symbol AND z.i = st.i", recursive=True)
def _(s, d):
    return _strategy(s, d).select("seq", "position")


@query("r2_strategy_backtest", f""", {_MACHINE}, {_log('SELECT z.*, st.pos FROM st JOIN z ON z.exchange = st.exchange AND z.symbol = st.symbol AND z.i = st.i')}
    SELECT exchange, symbol, count(*) AS n_trades, round(avg((gross - 0.0001 > 0)::INT), 7) AS win_rate, round(avg(gross - 0.0001) * 100, 6) AS avg_trade_return_pct FROM tl GROUP BY 1, 2""", recursive=True)
def _(s, d):
    t = research.summary(research.trade_log(_strategy(s, d), "price"))
    return t.select("exchange", "symbol", "n_trades", nudged("win_rate", 7).alias("win_rate"), nudged("avg_trade_return_pct", 6).alias("avg_trade_return_pct"))


@query("r3_equity_curve", f""", {_log(f'SELECT *, {_POS}, row_number() OVER ({_W}) - 1 AS i FROM trades_v WHERE price > 1')},
    p AS (SELECT exchange, symbol, i, sum(l) AS l FROM (SELECT exchange, symbol, entry_idx AS i, ln(1 - 0.0001::DOUBLE) AS l FROM tl UNION ALL SELECT exchange, symbol, exit_idx, ln(1 + gross - 0.0001::DOUBLE) FROM tl) GROUP BY 1, 2, 3)
    SELECT h.seq, round(ln(10000) + coalesce(sum(l) OVER (PARTITION BY h.exchange, h.symbol ORDER BY h.i ROWS UNBOUNDED PRECEDING), 0), 5) AS log_equity
    FROM h LEFT JOIN p ON h.exchange = p.exchange AND h.symbol = p.symbol AND h.i = p.i""")
def _(s, d):
    return rounded(research.equity_curve(_held(s, d).filter("price > 1"), "price").select("seq", F.ln("equity").alias("log_equity")), 5)


@query("r5_fee_sweep", f""", {_LOG} SELECT exchange, symbol, fee_bps, count(*) AS n_trades, round(avg((gross - fee_bps / 10000 > 0)::INT), 7) AS win_rate
    FROM tl, (SELECT unnest([0.0, 1.0, 10.0])::DOUBLE AS fee_bps) GROUP BY 1, 2, 3""")
def _(s, d):
    t = research.fee_sweep(s, research.trade_log(_held(s, d), "price"), (0, 1, 10))
    return t.select("exchange", "symbol", "fee_bps", "n_trades", nudged("win_rate", 7).alias("win_rate"))


@query("r7_report", f""", {_LOG}, n AS (SELECT *, gross - 0.0001 AS r FROM tl) SELECT exchange, symbol, count(*) AS n_trades, round(avg(r), 6) AS avg_return, round(quantile_cont(r, 0.5), 6) AS median_return, round(max(r), 6) AS best,
    round(min(r), 6) AS worst, count(*) FILTER (r > 0) AS wins, round(sum(r) FILTER (r > 0) / -sum(r) FILTER (r < 0), 5) AS profit_factor, round(stddev_samp(r), 5) AS volatility, round(skewness(r), 5) AS skew,
    round(kurtosis(r), 4) AS kurtosis FROM n GROUP BY 1, 2""")
def _(s, d):
    t = research.report(research.trade_log(_held(s, d), "price"))
    six = ("avg_return", "median_return", "best", "worst")
    return t.select("exchange", "symbol", "n_trades", *(nudged(c, 6).alias(c) for c in six), "wins", *(nudged(c, 5).alias(c) for c in ("profit_factor", "volatility", "skew")), nudged("kurtosis", 4).alias("kurtosis"))


@query("w11_streaks", f""", {_LOG}, f AS (SELECT *, gross - 0.0001 > 0 AS w FROM tl), g AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY entry_idx) - row_number() OVER (PARTITION BY exchange, symbol, w ORDER BY entry_idx) AS g FROM f),
    st AS (SELECT exchange, symbol, w, count(*) AS n FROM g GROUP BY exchange, symbol, w, g) SELECT exchange, symbol, coalesce(max(n) FILTER (w), 0) AS max_wins, coalesce(max(n) FILTER (NOT w), 0) AS max_losses FROM st GROUP BY 1, 2""")
def _(s, d):
    return research.streaks(research.trade_log(_held(s, d), "price")).select("exchange", "symbol", F.col("max_wins").cast("long").alias("max_wins"), F.col("max_losses").cast("long").alias("max_losses"))


@query("w12_drawdowns", f""", a AS (SELECT exchange, symbol, ms, seq, price, max(price) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS peak FROM trades_v),
    b AS (SELECT *, CASE WHEN peak > 0 THEN (price - peak) / peak ELSE 0 END AS dd FROM a), g AS (SELECT *, sum((dd = 0)::INT) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS g FROM b),
    r AS (SELECT exchange, symbol, min(dd) AS m, CAST(sum((dd < 0)::INT) AS BIGINT) AS n FROM g GROUP BY exchange, symbol, g)
    SELECT exchange, symbol, round(min(m) * 100, 7) AS max_drawdown_pct, max(n) AS max_drawdown_rows FROM r GROUP BY 1, 2""")
def _(s, d):
    return rounded(research.drawdowns(views.trades(s, d), "price"))


@query("r8_risk", f""", {_TF}, r AS (SELECT * FROM tf WHERE log_return IS NOT NULL), a AS (SELECT exchange, symbol, quantile_cont(log_return, 0.05) AS v FROM r GROUP BY 1, 2),
    f AS (SELECT *, 1 + log_return / 100 AS f FROM r), e AS (SELECT *, exp(sum(ln(f)) OVER ({_W} ROWS UNBOUNDED PRECEDING)) AS e FROM f),
    k AS (SELECT *, max(e) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS pk FROM e), m AS (SELECT exchange, symbol, least(min(e / pk - 1), 0) * 100 AS dd, exp(sum(ln(f))) AS t, count(*) AS n FROM k GROUP BY 1, 2)
    SELECT r.exchange, r.symbol, round(avg(log_return) / stddev_pop(log_return) * sqrt(365), 6) AS sharpe, round(avg(log_return) / stddev_pop(log_return) FILTER (log_return < 0) * sqrt(365), 6) AS sortino,
      round(any_value(v) / 100, 6) AS var_5, round(avg(log_return) FILTER (log_return <= v) / 100, 6) AS cvar_5, round(any_value(dd), 5) AS max_drawdown_pct,
      round(coalesce((pow(any_value(t), 365 / any_value(n)) - 1) * 100 / nullif(abs(any_value(dd)), 0), 0), 4) AS calmar
    FROM r JOIN a ON r.exchange = a.exchange AND r.symbol = a.symbol JOIN m ON r.exchange = m.exchange AND r.symbol = m.symbol GROUP BY 1, 2""")
def _(s, d):
    t = features.trade_features(views.trades(s, d)).filter("log_return IS NOT NULL").withColumn("x", F.col("log_return") / 100)
    r = research.risk(t, "x")
    return r.select("exchange", "symbol", *(nudged(c, n).alias(c) for c, n in (("sharpe", 6), ("sortino", 6), ("var_5", 6), ("cvar_5", 6), ("max_drawdown_pct", 5), ("calmar", 4))))


@query("a12_correlations", f""", f AS (SELECT amount, CAST(side = 'buy' AS INT) AS b, coalesce((lead(price, 5) OVER w - price) / price, 0) AS f5 FROM trades_v WINDOW w AS ({_W}))
    SELECT 'amount' AS feature, 5 AS horizon, round(corr(amount, f5), 7) AS correlation FROM f UNION ALL SELECT 'is_buy', 5, round(corr(b, f5), 7) FROM f""")
def _(s, d):
    t = features.trade_features(views.trades(s, d)).withColumn("is_buy", F.col("is_buy").cast("double"))
    return rounded(research.correlations(t, ["amount", "is_buy"], "price", (5,)))


@query("a13_rank_correlation", f""", f AS (SELECT exchange, symbol, amount AS x, coalesce((lead(price, 5) OVER w - price) / price, 0) AS y FROM trades_v WINDOW w AS ({_W})),
    r AS (SELECT exchange, symbol, rank() OVER (PARTITION BY exchange, symbol ORDER BY x) + (count(*) OVER (PARTITION BY exchange, symbol, x) - 1) / 2 AS rx,
      rank() OVER (PARTITION BY exchange, symbol ORDER BY y) + (count(*) OVER (PARTITION BY exchange, symbol, y) - 1) / 2 AS ry FROM f WHERE y <> 0)
    SELECT exchange, symbol, count(*) AS n, round(corr(rx, ry), 7) AS rank_correlation FROM r GROUP BY 1, 2""")
def _(s, d):
    t = views.trades(s, d).withColumn("y", W.forward_return("price", 5))
    return rounded(research.rank_correlation(t, "amount", "y"))


@query("o5_top_k", "SELECT symbol, seq FROM (SELECT symbol, seq, row_number() OVER (PARTITION BY symbol ORDER BY abs(price - 50) DESC, seq) AS n FROM trades_v) WHERE n <= 3")
def _(s, d):
    w = W.Window.partitionBy("symbol").orderBy(F.desc(F.abs(F.col("price") - 50)), "seq")
    return views.trades(s, d).withColumn("n", F.row_number().over(w)).filter("n <= 3").select("symbol", "seq")


@query("o6_argmax", "SELECT symbol, max_by(seq, amount * 1000000000 + seq) AS seq FROM trades_v GROUP BY 1")
def _(s, d):
    return views.trades(s, d).groupBy("symbol").agg(F.max_by("seq", F.struct("amount", "seq")).alias("seq"))


@query("o8_volume_tiers", """SELECT symbol, round(v, 6) AS volume, CASE WHEN n <= 3 THEN 1 WHEN n <= 8 THEN 2 ELSE 3 END AS tier FROM (SELECT symbol, v, row_number() OVER (ORDER BY round(v, 6) DESC, symbol) AS n
    FROM (SELECT symbol, sum(price * amount) AS v FROM trades_v GROUP BY 1))""")
def _(s, d):
    g = views.trades(s, d).groupBy("symbol").agg(nudged(F.sum(F.col("price") * F.col("amount")), 6).alias("volume"))
    n = F.row_number().over(W.Window.orderBy(F.desc("volume"), "symbol"))
    return g.select("symbol", "volume", F.when(n <= 3, 1).when(n <= 8, 2).otherwise(3).alias("tier"))


def _daily(s, d):
    return views.trades(s, d).groupBy(F.floor(F.col("ms") / 86_400_000).alias("day"), E.normalize_symbol().alias("asset")).agg((F.avg("price") / 100 - 0.5).alias("r"))


_DAILY = "dy AS (SELECT ms // 86400000 AS day, replace(symbol, 'USDC', 'USD') AS asset, avg(price) / 100 - 0.5 AS r FROM trades_v GROUP BY ALL)"


def _floored(w: str, floor: str) -> str:
    return f"""x AS (SELECT day, asset, w, sum(w) OVER (PARTITION BY day) AS t, count(*) OVER (PARTITION BY day) AS n FROM ({w})),
    y AS (SELECT day, asset, greatest(CASE WHEN t > 0 THEN w / t ELSE 1 / n END, {floor}::DOUBLE) AS w FROM x) SELECT day, asset, round(w / sum(w) OVER (PARTITION BY day), 6) AS weight FROM y"""


_BEFORE = "OVER (PARTITION BY asset ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"


@query("r10_inverse_vol", f", {_DAILY}, {_floored(f'SELECT day, asset, CASE WHEN count(r) {_BEFORE} >= 3 AND stddev_pop(r) {_BEFORE} > 0 THEN 1 / stddev_pop(r) {_BEFORE} ELSE 1 END AS w FROM dy', '0.05')}")
def _(s, d):
    return pick(research.inverse_vol_weights(_daily(s, d), "r", "day", "asset"), "day", "asset", "weight", digits=6)


@query("r10_equal_weights", f", {_DAILY} SELECT day, asset, round(1 / count(*) OVER (PARTITION BY day), 7) AS weight FROM dy")
def _(s, d):
    return pick(research.equal_weights(_daily(s, d), "day"), "day", "asset", "weight")


@query("r10_momentum_weights", f", {_DAILY}, mo AS (SELECT day, asset, coalesce(avg(r) {_BEFORE}, 0) AS m FROM dy), {_floored('SELECT day, asset, m - min(m) OVER (PARTITION BY day) + 0.001::DOUBLE AS w FROM mo', '0.02')}")
def _(s, d):
    return pick(research.momentum_weights(_daily(s, d), "r", "day", "asset", floor=0.02), "day", "asset", "weight", digits=6)


@query("r10_auc_weights", f", {_DAILY}, {_floored('SELECT day, asset, greatest(r, 0.001::DOUBLE) AS w FROM dy', '0.05')}")
def _(s, d):
    return pick(research.auc_weights(_daily(s, d).withColumn("auc", F.col("r") + 0.5), "auc", "day"), "day", "asset", "weight", digits=6)


@query("r11_ensemble", """SELECT seq, round(0.5 * (price / 100) + 0.3 * (amount / 10) + 0.2 * (side = 'buy')::INT, 7) AS weighted,
    CASE WHEN (price / 100 > 0.5)::INT + (amount / 10 > 0.5)::INT + (side = 'buy')::INT >= 2 THEN 0.7 ELSE 0.5 END AS agreement FROM trades_v""")
def _(s, d):
    t = views.trades(s, d).select("seq", (F.col("price") / 100).alias("a"), (F.col("amount") / 10).alias("b"), (F.col("side") == "buy").cast("double").alias("c"))
    return pick(research.ensemble(t, {"a": 5, "b": 3, "c": 2}), "seq", "weighted", "agreement")


def _draws(source: str, x: str, first: int) -> str:
    part = lambda at: f"CAST('0x' || substr(md5(concat_ws('|', CAST(seq AS VARCHAR), '0')), {at}, 7) AS BIGINT)"
    return f"""dr AS (SELECT {x} AS x, b, ((p * b + q) % {research.PRIME} + 0.5::DOUBLE) / {research.PRIME} AS u
      FROM (SELECT *, {part(1)} AS p, {part(8)} AS q FROM {source}), (SELECT unnest(range({first}, 201)) AS b))"""


_POISSON = " + ".join(f"(u > {c!r}::DOUBLE)::INT" for c in (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.999916758850712, 0.9999897508033253))


@query("r9_bootstrap", f""", {_draws('trades_v', 'price', 1)}, k AS (SELECT x, b, {_POISSON} AS k FROM dr), m AS (SELECT b, sum(k * x) / sum(k) AS m FROM k GROUP BY b)
    SELECT round(avg(m), 7) AS mean, round(quantile_cont(m, 0.025), 7) AS low, round(quantile_cont(m, 0.975), 7) AS high FROM m""")
def _(s, d):
    return rounded(research.bootstrap_mean(views.trades(s, d), "price", ["seq"]))


@query("r9_sign_flip", f""", {_TF}, lr AS (SELECT seq, log_return FROM tf WHERE log_return IS NOT NULL), {_draws('lr', 'log_return', 0)},
    su AS (SELECT b, abs(sum(CASE WHEN b = 0 OR u < 0.5::DOUBLE THEN x ELSE -x END)) AS s FROM dr GROUP BY b)
    SELECT round((count(*) FILTER (b > 0 AND s >= (SELECT s FROM su WHERE b = 0) * (1 - 1e-12::DOUBLE)) + 1) / 201, 7) AS p_value FROM su""")
def _(s, d):
    t = features.trade_features(views.trades(s, d)).filter("log_return IS NOT NULL")
    return rounded(research.sign_flip_test(t, "log_return", ["seq"]))


@query("r9_holm", """, p AS (SELECT symbol, 1.0 / count(*) AS p FROM trades_v GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY p, symbol) AS k, count(*) OVER () AS m FROM p)
    SELECT symbol, round(max(least(1, (m - k + 1) * p)) OVER (ORDER BY p, symbol ROWS UNBOUNDED PRECEDING), 8) AS p_adjusted FROM k""")
def _(s, d):
    p = views.trades(s, d).groupBy("symbol").agg((1.0 / F.count("*")).alias("p"))
    return rounded(research.holm(p, "p", "symbol").select("symbol", "p_adjusted"), 8)


@query("r15_impact", """, v AS (SELECT *, sum(amount) OVER (PARTITION BY symbol, ms // 86400000) AS dv FROM trades_v) SELECT seq, round(amount / dv, 8) AS participation, round(0.1 * 0.02 * sqrt(amount / dv), 8) AS impact FROM v""")
def _(s, d):
    w = W.Window.partitionBy("symbol", F.floor(F.col("ms") / 86_400_000))
    t = views.trades(s, d).withColumns({"dv": F.sum("amount").over(w), "vol": F.lit(0.02)})
    return pick(research.impact(t, "amount", "dv", "vol"), "seq", "participation", "impact", digits=8)

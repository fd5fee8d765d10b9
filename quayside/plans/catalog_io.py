"""Queries for sources, sinks, table maintenance, streams and the transform surface, over tables that they write themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions import exprs as E
from quayside.operators import bars, features, filters, flow, tables
from quayside.operators import windows as W
from quayside.operators.book import top_of_book
from quayside.operators.research import trade_log
from quayside.operators.seq import Threshold
from quayside.plans import bundles, sql
from quayside.plans.catalog import _FLOW, _TF, _W, _held, _LOG, nudged, pick, query, rounded, scratch
from quayside.plans.config import Config, Features, Input, Output
from quayside.plans.pipeline import REGISTRY, Chain, run, run_stream
from quayside.sources import readers, views
from quayside.streaming import flows

_DAY = ", dt AS (SELECT *, make_timestamp(ms * 1000) AS t FROM trades_v)"
TRADES = "seq long, exchange string, symbol string, ms long, price double, amount double, side string"
_ROWS = "SELECT seq, exchange, symbol, ms, price, amount, side FROM trades_v"
_COLUMNS = [x.split()[0] for x in TRADES.split(", ")]


def _dated(s, d):
    return features.add_date_columns(views.trades(s, d))


def _stored(s, d, *keys):
    path = scratch(s, "trades")
    tables.write(_dated(s, d), path, list(keys), sanitized=False)
    return path


# ---- sources


@query("s1_scan", "SELECT count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS value FROM events")
def _(s, d):
    t = readers.read(s, f"{d}/events.parquet", columns=["user_id", "value"])
    return rounded(t.agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.sum("value").alias("value")), 4)


@query("s1_partitions", f"{_DAY} SELECT exchange, CAST(year(t) AS INT) AS year, CAST(month(t) AS INT) AS month, CAST(day(t) AS INT) AS day, count(*) AS n FROM dt GROUP BY ALL")
def _(s, d):
    t = readers.read(s, _stored(s, d, "exchange", "year", "month", "day"))
    return t.groupBy("exchange", "year", "month", "day").agg(F.count("*").alias("n"))


@query("s3_ndjson", _ROWS)
def _(s, d):
    path = scratch(s, "ndjson")
    views.trades(s, d).write.json(path)
    return readers.read(s, path, "ndjson", TRADES)


@query("s4_csv", _ROWS)
def _(s, d):
    path = scratch(s, "csv")
    views.trades(s, d).write.option("header", True).csv(path)
    return readers.read(s, path, "csv", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in views.trades(s, d).schema)).select(*_COLUMNS)


@query("s6_row_limit", "SELECT 100 AS n")
def _(s, d):
    return readers.read(s, f"{d}/events.parquet", columns=["event_id"], limit=100).agg(F.count("*").cast("int").alias("n"))


@query("s7_lenient_ndjson", "SELECT 'good' AS kind, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seq FROM trades_v UNION ALL SELECT 'bad', count(*), NULL FROM trades_v WHERE seq % 10 = 3")
def _(s, d):
    path = scratch(s, "lines")
    t = views.trades(s, d).select(F.to_json(F.struct(*_COLUMNS)).alias("value"), "seq")
    # Each tenth line comes with a broken copy of itself and a blank line.
    broken = t.filter("seq % 10 = 3").select(F.explode(F.array(F.substring("value", 1, 20), F.lit("  "))).alias("value"))
    t.select("value").unionAll(broken).write.text(path)
    good, bad = readers.read_ndjson_lenient(s, path, TRADES)
    return good.agg(F.lit("good").alias("kind"), F.count("*").alias("n"), F.sum("seq").alias("seq")).unionAll(bad.agg(F.lit("bad"), F.count("*"), F.lit(None).cast("long")))


@query("s8_batches", "SELECT CAST(ceil(count(*) / 1000) AS BIGINT) AS least_batches, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seq FROM trades_v")
def _(s, d):
    b = readers.in_batches(views.trades(s, d).coalesce(1), 1000, lambda p: [(len(p), int(p["seq"].sum()))], "n long, seq long")
    return b.agg(F.count("*").alias("least_batches"), F.sum("n").alias("n"), F.sum("seq").alias("seq"))


@query("s9_load_days", f"""{_DAY}, n AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, CAST(t AS DATE) ORDER BY ms, seq) AS i FROM dt)
    SELECT seq, price FROM n WHERE exchange = 'x0' AND symbol = 'S2-USD' AND CAST(t AS DATE) IN (DATE '2024-01-03', DATE '2024-01-04', DATE '2024-01-09') AND (i - 1) % 3 = 0""")
def _(s, d):
    t = readers.read(s, _stored(s, d, "exchange", "symbol", "year", "month", "day"))
    return readers.load_days(t, "x0", "S2-USD", [(2024, 1, 3), (2024, 1, 4), (2024, 1, 9)], ["seq", "price"], 3)


@query("s11_inventory", f"{_DAY} SELECT symbol, count(DISTINCT CAST(t AS DATE)) AS days, CAST(min(t) AS DATE) AS first_day, CAST(max(t) AS DATE) AS last_day FROM dt GROUP BY 1")
def _(s, d):
    return readers.inventory(readers.read(s, _stored(s, d, "symbol", "year", "month", "day"))).select("symbol", "days", "first_day", "last_day")


# ---- records and envelopes


def _records(s, d):
    """Producer records: a ticker and a list of two trades for each trade, and one of an unknown type for each hour."""
    t = views.trades(s, d).select("*", F.date_format(E.from_ms("ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso"))
    text = lambda *c: F.to_json(F.struct(*c))
    trade = lambda n: F.struct(F.concat("seq", F.lit(f"-{n}")).alias("id"), F.col("ms").alias("timestamp"), "side", "price", (F.col("amount") / n).alias("amount"))
    rec = lambda kind, data: t.select(F.lit(kind).alias("type"), "exchange", "symbol", F.lit("watch").alias("method"), F.col("ms").alias("collected_at"), F.col("iso").alias("capture_ts"), data.alias("data"))
    out = rec("ticker", text(F.col("price").alias("bid"), F.col("amount").alias("bidVolume"), (F.col("price") + 1).alias("last"), F.col("ms").alias("timestamp")))
    out = out.unionAll(rec("trades", F.to_json(F.array(trade(1), trade(2)))))
    books = views.books(s, d).select(
        F.lit("orderbook"), "exchange", "symbol", F.lit("watch"), F.col("ms"), F.lit(None).cast("string"),
        F.to_json(F.struct(F.col("seq").alias("nonce"), F.transform("bids", lambda x: F.array(x["price"], x["size"])).alias("bids"), F.transform("asks", lambda x: F.array(x["price"], x["size"])).alias("asks"))),
    )
    return out.unionAll(books).unionAll(rec("funding", F.lit("{}")))


@query("s19_normalize_ticker", "SELECT exchange, symbol, ms AS collected_at, price AS bid, amount AS bid_volume, round(price + 1, 7) AS last, CAST(hour(make_timestamp(ms * 1000)) AS INT) AS hour FROM trades_v")
def _(s, d):
    return pick(readers.normalize_ticker(_records(s, d)), "exchange", "symbol", "collected_at", "bid", "bid_volume", "last", "hour").withColumns({c: F.round(c, 7) for c in ("bid", "bid_volume")})


@query("s19_normalize_trades", "SELECT concat(seq, '-', n) AS trade_id, side, round(price, 7) AS price, round(amount / n, 7) AS amount FROM trades_v, (SELECT unnest([1, 2]) AS n)")
def _(s, d):
    return pick(readers.normalize_trades(_records(s, d)), "trade_id", "side", "price", "amount")


@query("s19_normalize_books", "SELECT seq AS nonce, len(bp) AS levels, round(list_sum(bs[1:3]), 6) AS top_bids, round(ap[1], 6) AS best_ask FROM books_v")
def _(s, d):
    b = readers.normalize_books(_records(s, d), 3)
    full = readers.normalize_books(_records(s, d)).select("nonce", F.size("bids").cast("long").alias("levels"))
    b = b.select("nonce", E.top_sum("bids", 3).alias("top_bids"), F.get("asks", F.lit(0))["price"].alias("best_ask")).join(full, "nonce")
    return rounded(b, 6)


@query("s20_split_channels", """SELECT 'ticker' AS channel, count(*) AS n FROM trades_v UNION ALL SELECT 'trades', 2 * count(*) FROM trades_v UNION ALL SELECT 'orderbook', count(*) FROM books_v
    UNION ALL SELECT 'generic', count(*) FROM trades_v""")
def _(s, d):
    path, out = scratch(s, "mixed"), None
    _records(s, d).write.json(path)
    for channel, df in readers.split_channels(readers.read(s, path, "ndjson", readers.RECORD)).items():
        to = scratch(s, channel)
        tables.write(df, to, ["exchange"])
        n = readers.read(s, to).agg(F.lit(channel).alias("channel"), F.count("*").alias("n"))
        out = n if out is None else out.unionAll(n)
    return out


def _envelopes(s, d):
    t = views.trades(s, d)
    row = F.create_map(*(x for k, c in (("trade_id", "seq"), ("side", "side"), ("price", "price"), ("size", "amount")) for x in (F.lit(k), F.when(F.col("seq") % 7 != 0, F.col(c).cast("string")).otherwise(F.lit("none") if k in ("price", "size") else F.col(c).cast("string")))))
    event = F.struct(F.lit("update").alias("type"), F.col("symbol").alias("product_id"), F.array(row).alias("trades"))
    return t.select(F.lit("t").alias("capture_ts"), F.struct(F.lit("market_trades").alias("channel"), F.col("seq").alias("sequence_num"), F.array(event).alias("events")).alias("data"))


@query("s21_envelopes", "SELECT symbol AS product_id, seq AS sequence_num, CAST(seq AS VARCHAR) AS trade_id, side, CASE WHEN seq % 7 = 0 THEN 0 ELSE price END AS price, CASE WHEN seq % 7 = 0 THEN 0 ELSE amount END AS size FROM trades_v")
def _(s, d):
    return readers.parse_envelope(_envelopes(s, d), "trades").select("product_id", "sequence_num", "trade_id", "side", "price", "size")


@query("s22_unified", "SELECT ms, count(*) AS n, strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS date FROM trades_v GROUP BY 1")
def _(s, d):
    return readers.parse_unified(_records(s, d).filter("type IN ('ticker')")).groupBy("ms", "date").agg(F.count("*").alias("n"))


@query("s23_route", "SELECT side, count(*) AS n FROM trades_v GROUP BY 1")
def _(s, d):
    parts = readers.route(views.trades(s, d), ["buy", "sell", "none"], "side")
    return parts["buy"].unionAll(parts["sell"]).unionAll(parts["none"]).groupBy("side").agg(F.count("*").alias("n"))


@query("f9_json", "SELECT seq, price, side FROM trades_v")
def _(s, d):
    t = views.trades(s, d).select(F.to_json(F.struct(*_COLUMNS)).alias("j"))
    return t.select(F.from_json("j", TRADES).alias("x")).select("x.seq", "x.price", "x.side")


# ---- sinks and table maintenance


@query("s14_partitioned_sink", f"{_DAY} SELECT seq, exchange, symbol, CAST(day(t) AS INT) AS day FROM dt")
def _(s, d):
    path = scratch(s, "sink")
    tables.write(tables.ensure_partition_columns(views.trades(s, d), ["exchange", "symbol", "year", "month", "day"]), path, ["exchange", "symbol", "year", "month", "day"], files_per_partition=1)
    return tables.read(s, path).select("seq", "exchange", "symbol", "day")


@query("s15_flat_sink", "SELECT seq, count(*) AS n FROM (SELECT seq FROM trades_v UNION ALL SELECT seq FROM trades_v) GROUP BY 1")
def _(s, d):
    path = scratch(s, "flat")
    for _ in range(2):
        tables.write(views.trades(s, d), path, [], "append")
    return tables.read(s, path).groupBy("seq").agg(F.count("*").alias("n"))


@query("s16_overwrite_partition", "SELECT seq, CASE WHEN side = 'buy' THEN 0 ELSE price END AS price FROM trades_v")
def _(s, d):
    path, t = scratch(s, "modes"), views.trades(s, d).select("seq", "price", "side")
    tables.write(t, path, ["side"], "overwrite")
    tables.write(t.filter("side = 'buy'").withColumn("price", F.lit(0.0)), path, ["side"], "overwrite_partition")
    return tables.read(s, path).select("seq", "price")


@query("s17_rolled_segments", "SELECT exchange, count(*) AS n FROM trades_v GROUP BY 1")
def _(s, d):
    active, ready = scratch(s, "active"), scratch(s, "ready")
    tables.write(views.trades(s, d), active, ["exchange"], max_records=500)
    flows.roll(s, active, ready, now_ms=10**15, suffix=".parquet")
    return tables.read(s, ready).groupBy("exchange").agg(F.count("*").alias("n"))


@query("s26_sync", "SELECT exchange, count(*) AS n FROM trades_v WHERE side = 'buy' GROUP BY 1")
def _(s, d):
    a, b = scratch(s, "from"), scratch(s, "to")
    tables.write(views.trades(s, d), a, ["side", "exchange"])
    tables.sync(s, a, b, pattern="side=buy")
    return tables.read(s, b).groupBy("exchange").agg(F.count("*").alias("n"))


@query("s27_broken_files", "SELECT 0 AS broken, count(*) AS n FROM trades_v")
def _(s, d):
    path = _stored(s, d, "exchange")
    return tables.read(s, path).agg(F.lit(len(tables.broken_files(s, path))).alias("broken"), F.count("*").alias("n"))


@query("x4_partition_filter", "SELECT seq FROM trades_v WHERE NOT (exchange = 'x0' AND symbol IN ('S1-USD', 'S2-USD') AND price > 20)")
def _(s, d):
    path = scratch(s, "leading")
    tables.write(views.trades(s, d), path, ["exchange", "symbol"])
    tables.delete(s, path, F.col("price") > 20, partitions=filters.predicate([("exchange", "=", "x0"), ("symbol", "in", ["S1-USD", "S2-USD"])]))
    return tables.read(s, path).select("seq")


@query("x5_repartition", f"{_DAY} SELECT CAST(day(t) AS INT) AS day, side, count(*) AS n FROM dt WHERE price > 5 GROUP BY ALL")
def _(s, d):
    a, b = _stored(s, d, "exchange", "symbol"), scratch(s, "days")
    tables.repartition(s, a, b, ["day", "side"], lambda t: t.filter("price > 5"))
    return tables.read(s, b).groupBy("day", "side").agg(F.count("*").alias("n"))


@query("x6_compaction", "SELECT exchange, 1 AS files, count(*) AS n FROM trades_v GROUP BY 1")
def _(s, d):
    path = scratch(s, "small")
    tables.write(views.trades(s, d).repartition(7), path, ["exchange"])
    tables.compact(s, path, sort_by=["ms", "none"])
    return tables.read(s, path).withColumn("f", F.col("_metadata.file_path")).groupBy("exchange").agg(F.countDistinct("f").cast("int").alias("files"), F.count("*").alias("n"))


@query("x7_migrate_symbols", "SELECT regexp_replace(symbol, '-USDC$', '-USD') AS symbol, count(*) AS n FROM trades_v GROUP BY 1")
def _(s, d):
    path = _stored(s, d, "symbol")
    tables.migrate_symbols(s, path, "USDC", "USD")
    return tables.read(s, path).groupBy("symbol").agg(F.count("*").alias("n"))


@query("x8_fix_mismatch", f"{_DAY} SELECT CAST(day(t) AS INT) AS day, count(*) AS n FROM dt GROUP BY 1")
def _(s, d):
    path = scratch(s, "wrong")
    # Rows of odd hours were filed under the day after.
    tables.write(_dated(s, d).withColumn("day", F.col("day") + F.col("hour") % 2), path, ["day"])
    tables.fix_mismatched(s, path, {"day": F.dayofmonth(E.from_ms("ms"))})
    return tables.read(s, path).groupBy("day").agg(F.count("*").alias("n"))


@query("x9_split_files", f"{_DAY} SELECT exchange, CAST(day(t) AS INT) AS day, count(*) AS n FROM dt GROUP BY ALL")
def _(s, d):
    a, b = scratch(s, "flat"), scratch(s, "split")
    tables.write(views.trades(s, d), a, [])
    tables.repartition(s, a, b, ["exchange", "year", "month", "day"], features.add_date_columns)
    return tables.read(s, b).groupBy("exchange", "day").agg(F.count("*").alias("n"))


# ---- predicates and projections


@query("p3_partition_tuples", f"{_DAY} SELECT seq FROM dt WHERE exchange = 'x1' AND symbol IN ('S3-USD', 'S3-USDC') AND day(t) = 7 AND month(t) = 1")
def _(s, d):
    spec = filters.FilterSpec("x1", "S3-USD", month=1, day=7)
    return _dated(s, d).filter(filters.predicate(spec.partition_tuples())).select("seq")


@query("p4_filter_round_trip", f"{_DAY} SELECT seq FROM dt WHERE exchange = 'x0' AND day(t) = 9")
def _(s, d):
    return filters.FilterSpec.from_dict(filters.FilterSpec("x0", day=9).to_dict()).apply(_dated(s, d)).select("seq")


@query("p6_symbol_matches", "SELECT seq, symbol IN ('S3-USD', 'S3-USDC') AS any_dollar, symbol = 'S3-USD' AS exact FROM trades_v")
def _(s, d):
    return views.trades(s, d).select("seq", E.symbol_matches("S3-USD").alias("any_dollar"), E.symbol_matches("S3-USD", normalize=False).alias("exact"))


@query("p7_optional_columns", "SELECT exchange, symbol, ms // 3600000 * 3600000 AS bar_ms, round(max(bid), 7) AS high, count(*) AS tick_count, 0 AS spreads FROM ticker_v GROUP BY 1, 2, 3")
def _(s, d):
    b = bars.mid_bars(views.ticker(s, d), 3600, "bid")
    return b.select("exchange", "symbol", "bar_ms", nudged("high", 7).alias("high"), "tick_count", F.lit(sum("spread" in c for c in b.columns)).alias("spreads"))


@query("p12_not_null", f", {_TF} SELECT seq FROM tf WHERE log_return IS NOT NULL")
def _(s, d):
    return features.trade_features(views.trades(s, d)).filter(F.col("log_return").isNotNull()).select("seq")


# ---- transforms


def _books(s, d):
    path = scratch(s, "books")
    views.books(s, d).write.parquet(path)
    return path


@query("e1_transform", f", {_FLOW} SELECT seq, round(ofi, 6) AS ofi, 0 AS raw FROM fl")
def _(s, d):
    c = Config("books", [Input("orderbook", _books(s, d))], [Output("silver", scratch(s, "silver"))], Features(("structural", "dynamic"), rolling_windows=(60,), normalize_quotes=False))
    run(s, REGISTRY.create("orderbook_features", c))
    t = tables.read(s, c.outputs[0].path)
    return t.select("seq", nudged("ofi", 6).alias("ofi"), F.lit(sum(x in t.columns for x in ("bids", "asks"))).alias("raw"))


@query("e2_registry", "SELECT unnest(['bars', 'orderbook_features', 'ticker_features', 'trades_features']) AS name")
def _(s, d):
    return s.createDataFrame([(n,) for n in REGISTRY.names()], "name string")


@query("e3_transform_fn", "SELECT symbol, count(*) AS n FROM trades_v WHERE amount > 2 GROUP BY 1")
def _(s, d):
    a, b = _stored(s, d, "exchange"), scratch(s, "by-symbol")
    tables.repartition(s, a, b, ["symbol"], lambda t: t.filter("amount > 2"))
    return tables.read(s, b).groupBy("symbol").agg(F.count("*").alias("n"))


@query("e5_chain", "SELECT symbol, side, count(*) AS n FROM trades_v WHERE price > 10 GROUP BY ALL")
def _(s, d):
    chain = Chain(lambda t: readers.normalize_trades(t), lambda t: t.filter("trade_id LIKE '%-1' AND price > 10"), lambda t: t.groupBy("symbol", "side").agg(F.count("*").alias("n")))
    return chain(_records(s, d))


@query("e7_rolling_metric", f"SELECT seq, round(CASE WHEN row_number() OVER ({_W}) >= 10 THEN max(price) OVER x - min(price) OVER x END, 7) AS spread FROM trades_v WINDOW x AS ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)")
def _(s, d):
    metric = lambda agg: W.rolling(agg("price"), 10)
    return rounded(views.trades(s, d).select("seq", (metric(F.max) - metric(F.min)).alias("spread")))


@query("e9_sql", """SELECT regexp_replace(symbol, '-USDC$', '-USD') AS symbol, ms // 14400000 * 14400000 AS bucket, round(avg(bid_volume - ask_volume), 7) AS gap,
    round(avg((bid_volume - ask_volume) / (bid_volume + ask_volume)), 7) AS imbalance FROM ticker_v GROUP BY 1, 2""")
def _(s, d):
    sql.register(s, {"ticker": views.ticker(s, d)})
    return rounded(s.sql("""SELECT normalize_symbol(symbol) AS symbol, bucket_ms(ms, 14400000) AS bucket, avg(bid_volume - ask_volume) AS gap, avg(imbalance(bid_volume, ask_volume)) AS imbalance
        FROM ticker WHERE is_usd_quoted(symbol) GROUP BY 1, 2"""))


@query("r16_bundles", f", {_LOG} SELECT 'one' AS name, 'Threshold' AS strategy, 1.5 AS entry_z, CAST(count(*) AS BIGINT) AS n_trades FROM tl")
def _(s, d):
    folder = scratch(s, "bundles")
    n = trade_log(_held(s, d), "price").count()
    path = bundles.export(s, folder, Threshold(), name="one", features=["a"], metrics={"n_trades": n}, training_days=[(2024, 1, 2)])
    config, meta = bundles.load(s, path), bundles.load(s, path, "metadata")
    return s.createDataFrame([(x, config["strategy"]["class"], config["strategy"]["params"]["entry_z"], meta["metrics"]["n_trades"]) for x in bundles.bundles(s, folder)], "name string, strategy string, entry_z double, n_trades long")


# ---- streams: what is there is processed to the end, with a row far in the future that moves the watermark past all others

FAR = 2 * 10**12


def _stream(s, d, df, schema, files=3, first=lambda stream: None):
    """A stream of df and of the far row, which is written when first has returned."""
    path = scratch(s, "stream")
    df.repartition(files).write.parquet(path)
    stream = flows.watch(s, path, schema, files_per_trigger=1)
    first(stream)
    df.limit(1).withColumn("ms", F.lit(FAR)).coalesce(1).write.mode("append").parquet(path)
    return stream


def _end(q):
    if not q.awaitTermination(3600):
        q.stop()
        raise TimeoutError("the stream has not ended")


def _run(s, stream, name):
    out = scratch(s, name)
    _end(flows.sink(stream, out, scratch(s, f"{name}-checkpoint")))
    return s.read.schema(stream.schema).parquet(out)


def _drained(s, d, df, schema, flow, name):
    """All rows of flow over a stream of df."""
    out, checkpoint = scratch(s, name), scratch(s, f"{name}-checkpoint")
    run = lambda stream: _end(flows.sink(flow(stream), out, checkpoint))
    # The far row is there only once all others have been read, and the stream goes on from its checkpoint: files come by their time,
    # which need not tell files apart, and what came after the far row would be too late.
    stream = _stream(s, d, df, schema, first=run)
    run(stream)
    return s.read.schema(flow(stream).schema).parquet(out)


@query("st2_tumbling", """SELECT exchange, symbol, ms // 3600000 * 3600000 AS bar_ms, max(price) AS high, min(price) AS low, round(sum(amount), 7) AS volume, count(*) AS trade_count
    FROM trades_v GROUP BY 1, 2, 3""")
def _(s, d):
    b = _drained(s, d, views.trades(s, d), TRADES, lambda t: flows.trade_bars(t, 3600, "60 days"), "tumbling")
    return b.select("exchange", "symbol", "bar_ms", "high", "low", nudged("volume", 7).alias("volume"), "trade_count")


@query("st3_sliding", """SELECT exchange, symbol, round(avg(price), 7) AS mean_price, count(*) AS n FROM (SELECT *, unnest([0, 1]) AS k FROM trades_v) GROUP BY exchange, symbol, ms // 3600000 - k""")
def _(s, d):
    b = _drained(s, d, views.trades(s, d), TRADES, lambda t: flows.hopping_means(t, "price", 7200, 3600, "60 days"), "sliding")
    return b.select("exchange", "symbol", nudged("mean_price", 7).alias("mean_price"), "n")


@query("st4_sessions", f"""SELECT exchange, symbol, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS n, round(sum(amount), 6) AS volume FROM
    (SELECT *, sum(new) OVER ({_W}) AS g FROM (SELECT *, CASE WHEN ms - lag(ms) OVER ({_W}) >= 1800000 THEN 1 ELSE 0 END AS new FROM trades_v)) GROUP BY exchange, symbol, g""")
def _(s, d):
    b = _drained(s, d, views.trades(s, d), TRADES, lambda t: flows.sessions(t, "30 minutes", "60 days"), "sessions")
    return b.select("exchange", "symbol", "first_ms", "last_ms", "n", nudged("volume", 6).alias("volume"))


@query("st6_keyed_state", f", {_FLOW} SELECT seq, round(ofi, 6) AS ofi FROM fl")
def _(s, d):
    s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    b = top_of_book(views.books(s, d)).select("exchange", "symbol", "ms", "seq", "best_bid", "top_bid_size", "best_ask", "top_ask_size")
    path = scratch(s, "books")
    # One file, so that all rows of an instrument come in one batch, in order.
    b.coalesce(1).write.parquet(path)
    schema = "exchange string, symbol string, ms long, seq long, best_bid double, top_bid_size double, best_ask double, top_ask_size double"
    return rounded(_run(s, flows.order_flow(flows.watch(s, path, schema)), "flow").select("seq", "ofi"), 6)


@query("st12_streaming_transform", f", {_TF} SELECT seq, is_buy, round(dollar_volume, 7) AS dollar_volume FROM tf")
def _(s, d):
    src, out = scratch(s, "src"), scratch(s, "out")
    views.trades(s, d).repartition(3).write.parquet(src)
    c = Config("trades", [Input("trades", src, schema=TRADES)], [Output("silver", out, partition_by=["exchange"])], Features(("structural",), normalize_quotes=False))
    run_stream(s, REGISTRY.create("trades_features", c), scratch(s, "checkpoint"), files_per_trigger=1).awaitTermination(600)
    return pick(tables.read(s, out), "seq", "is_buy", "dollar_volume")


@query("st11_reset_by_day", f", {_FLOW.replace('PARTITION BY exchange, symbol ORDER BY ms, seq', 'PARTITION BY exchange, symbol, ms // 600000 ORDER BY ms, seq')} SELECT seq, round(ofi, 6) AS ofi FROM fl")
def _(s, d):
    # Spans of ten minutes stand for days, as the snapshots are a second apart.
    b = top_of_book(views.books(s, d)).withColumn("span", F.floor(F.col("ms") / 600_000))
    return pick(flow.order_flow(b, keys=("exchange", "symbol", "span")), "seq", "ofi", digits=6)

"""Channel schemas, readers, record normalisers and vendor parsers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.exprs import epoch_to_ms, parse_utc
from quayside.operators.windows import every_nth

# The columns of the four channels.
_PREFIX = "collected_at long, capture_ts timestamp, exchange string, symbol string, year int, month int, day int, hour int"
_LEVELS = "array<struct<price:double,size:double>>"
SCHEMAS = {
    "ticker": f"{_PREFIX}, bid double, ask double, bid_volume double, ask_volume double, last double, open double, high double, low double, close double, "
    "vwap double, base_volume double, quote_volume double, change double, percentage double, timestamp long, info_json string",
    "trades": f"{_PREFIX}, trade_id string, timestamp long, side string, price double, amount double, cost double, info_json string",
    "orderbook": f"{_PREFIX}, timestamp long, nonce long, bids {_LEVELS}, asks {_LEVELS}",
    "generic": f"{_PREFIX}, type string, method string, data_json string",
}
RECORD = "type string, exchange string, symbol string, method string, collected_at long, capture_ts string, data string"


def schema_of(channel: str) -> str:
    return SCHEMAS.get(channel, SCHEMAS["generic"])


def read(spark: SparkSession, path: str | list[str], fmt: str = "parquet", schema: str | None = None, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Parquet (with partition discovery), NDJSON or CSV from any file system; columns and limit as asked."""
    if fmt not in ("parquet", "ndjson", "json", "csv"):
        raise ValueError(f"unsupported format: {fmt}")
    r = spark.read.schema(schema) if schema else spark.read
    paths = [path] if isinstance(path, str) else path
    df = r.parquet(*paths) if fmt == "parquet" else r.option("header", True).csv(paths) if fmt == "csv" else r.json(paths)
    df = df.select(*columns) if columns else df
    return df.limit(limit) if limit is not None else df


def read_ndjson_lenient(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines): blank lines are skipped, lines that are no JSON are kept apart and can be counted."""
    raw = spark.read.text(path).filter(F.trim("value") != "")
    d = raw.withColumn("_j", F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return d.filter("_j._bad IS NULL").select("_j.*").drop("_bad"), d.filter("_j._bad IS NOT NULL").select(F.col("value").alias("line"))


def load_days(df: DataFrame, exchange: str, symbol: str, days: list[tuple[int, int, int]], columns: list[str] | None = None, step: int = 1) -> DataFrame:
    """Rows of one instrument on the days, every step-th of each day; one scan whose date predicate prunes partitions."""
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    d = df.filter((F.col("exchange") == exchange) & (F.col("symbol") == symbol) & number.isin(*(y * 10000 + m * 100 + x for y, m, x in days)))
    d = every_nth(d, step, ("exchange", "symbol", "year", "month", "day")) if step > 1 else d
    return d.select(*columns) if columns else d


def inventory(df: DataFrame) -> DataFrame:
    """Per symbol: days with data, first and last day, stored size in MB (of a file-based df)."""
    d = df.select("symbol", F.make_date("year", "month", "day").alias("d"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    size = d.groupBy("symbol", "f").agg(F.max("s").alias("s")).groupBy("symbol").agg((F.sum("s") / 1e6).alias("mb"))
    return d.groupBy("symbol").agg(F.countDistinct("d").alias("days"), F.min("d").alias("first_day"), F.max("d").alias("last_day")).join(size, "symbol")


# ---- producer records: {type, exchange, symbol, method, collected_at, capture_ts, data}


def _common() -> list[Column]:
    t = F.coalesce(parse_utc("capture_ts"), F.timestamp_millis("collected_at")).alias("capture_ts")
    return [F.col("collected_at"), t, F.col("exchange"), F.col("symbol")]


def _with_parts(df: DataFrame) -> DataFrame:
    t = F.col("capture_ts")
    return df.withColumns({"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)})


def normalize_ticker(records: DataFrame) -> DataFrame:
    names = {"bid": "bid", "ask": "ask", "bidVolume": "bid_volume", "askVolume": "ask_volume", "last": "last", "open": "open", "high": "high", "low": "low", "close": "close", "vwap": "vwap", "baseVolume": "base_volume", "quoteVolume": "quote_volume", "change": "change", "percentage": "percentage"}
    d = F.from_json("data", ", ".join(f"`{k}` double" for k in names) + ", timestamp long, info string")
    out = records.filter("type = 'ticker'").withColumn("_d", d)
    return _with_parts(out.select(*_common(), *(F.col(f"_d.{k}").alias(v) for k, v in names.items()), F.col("_d.timestamp").alias("timestamp"), F.col("_d.info").alias("info_json")))


def normalize_trades(records: DataFrame) -> DataFrame:
    """A record holds one trade or a list of them."""
    one = "struct<id:string,timestamp:long,side:string,price:double,amount:double,cost:double,info:string>"
    data = F.when(F.ltrim("data").startswith("["), F.col("data")).otherwise(F.concat(F.lit("["), "data", F.lit("]")))
    d = records.filter("type = 'trades'").withColumn("_t", F.explode(F.from_json(data, f"array<{one}>")))
    return _with_parts(d.select(*_common(), F.col("_t.id").alias("trade_id"), *(F.col(f"_t.{c}").alias(c) for c in ("timestamp", "side", "price", "amount", "cost")), F.col("_t.info").alias("info_json")))


def normalize_books(records: DataFrame, depth: int | None = None) -> DataFrame:
    d = records.filter("type = 'orderbook'").withColumn("_d", F.from_json("data", "timestamp long, nonce long, bids array<array<double>>, asks array<array<double>>"))
    side = lambda s: F.expr(f"transform({f'slice(_d.{s}, 1, {depth})' if depth else f'_d.{s}'}, x -> named_struct('price', x[0], 'size', x[1]))").alias(s)
    return _with_parts(d.select(*_common(), F.col("_d.timestamp").alias("timestamp"), F.col("_d.nonce").alias("nonce"), side("bids"), side("asks")))


def normalize_generic(records: DataFrame) -> DataFrame:
    return _with_parts(records.select(*_common(), "type", "method", F.col("data").alias("data_json")))


def split_channels(records: DataFrame) -> dict[str, DataFrame]:
    """One DataFrame for each channel of a mixed source; unknown types go to generic."""
    return {
        "ticker": normalize_ticker(records), "trades": normalize_trades(records), "orderbook": normalize_books(records),
        "generic": normalize_generic(records.filter("type NOT IN ('ticker', 'trades', 'orderbook') OR type IS NULL")),
    }


# ---- vendor envelopes


ENVELOPE = """capture_ts string, data struct<channel:string, timestamp:string, sequence_num:long, events:array<struct<type:string, product_id:string,
  tickers:array<map<string,string>>, updates:array<map<string,string>>, trades:array<map<string,string>>, candles:array<map<string,string>>>>>"""
_VENDOR = {
    "tickers": (["product_id", "type"], ["price", "volume_24_h", "low_24_h", "high_24_h", "best_bid", "best_bid_quantity", "best_ask", "best_ask_quantity", "price_percent_chg_24_h"]),
    "updates": (["side", "event_time"], ["price_level", "new_quantity"]),
    "trades": (["product_id", "trade_id", "side", "time"], ["price", "size"]),
    "candles": (["product_id", "start"], ["open", "high", "low", "close", "volume"]),
}


def parse_envelope(df: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind (tickers, updates, trades, candles) of all events; numbers in strings, 0 where they are none."""
    texts, numbers = _VENDOR[kind]
    d = df.select("capture_ts", F.col("data.channel").alias("channel"), F.col("data.sequence_num").alias("sequence_num"), F.explode("data.events").alias("e"))
    d = d.select("capture_ts", "channel", "sequence_num", F.col("e.type").alias("event_type"), F.col("e.product_id").alias("_p"), F.explode(f"e.{kind}").alias("x"))
    get = lambda k: F.col("x")[k]
    cols = [(F.coalesce(get(k), F.col("_p")) if k == "product_id" else get(k)).alias(k) for k in texts]
    if "product_id" not in texts:
        cols.insert(0, F.col("_p").alias("product_id"))
    return d.select("capture_ts", "channel", "sequence_num", "event_type", *cols, *(F.coalesce(get(k).try_cast("double"), F.lit(0.0)).alias(k) for k in numbers))


def parse_unified(records: DataFrame) -> DataFrame:
    """Adds ms (the data's own timestamp, else collected_at), an ISO datetime and a date to producer records."""
    ms = F.coalesce(epoch_to_ms(F.get_json_object("data", "$.timestamp").try_cast("double")), F.col("collected_at"))
    d = records.withColumn("ms", ms)
    t = F.timestamp_millis("ms")
    return d.withColumns({"datetime": F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), "date": F.date_format(t, "yyyy-MM-dd")})


def route(df: DataFrame, channels: list[str], column: str = "channel") -> dict[str, DataFrame]:
    return {c: df.filter(F.col(column) == c) for c in channels}


def in_batches(df: DataFrame, rows: int, fn: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """fn over batches of at most `rows` rows of each partition, each a pandas frame; it gives rows of the schema."""
    names = [c.split()[0] for c in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in frames:
            for at in range(0, len(p), rows):
                yield pd.DataFrame(fn(p.iloc[at : at + rows]), columns=names)

    return df.mapInPandas(run, schema)

"""Structured Streaming: sources, windowed bars, keyed order-flow state and partitioned sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quayside.functions.exprs import from_ms, sdiv
from quayside.operators.tables import Files


def watch(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    """New files of a folder as a stream; files_per_trigger is the back-pressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def trade_bars(trades: DataFrame, seconds: int, late: str = "10 minutes") -> DataFrame:
    """OHLC, volume and vwap of tumbling windows; a window is final once the watermark has passed it."""
    key = F.struct("ms", "seq")
    g = trades.withColumn("ts", from_ms("ms")).withWatermark("ts", late).groupBy(F.window("ts", f"{seconds} seconds"), "exchange", "symbol")
    return g.agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", key).alias("close"),
        F.sum("amount").alias("volume"), F.count("*").alias("trade_count"), sdiv(F.sum(F.col("price") * F.col("amount")), F.sum("amount")).alias("vwap"),
    ).select("exchange", "symbol", F.unix_millis("window.start").alias("bar_ms"), "open", "high", "low", "close", "volume", "trade_count", "vwap")


def hopping_means(df: DataFrame, x: str, seconds: int, step: int, late: str = "10 minutes") -> DataFrame:
    g = df.withColumn("ts", from_ms("ms")).withWatermark("ts", late).groupBy(F.window("ts", f"{seconds} seconds", f"{step} seconds"), "exchange", "symbol")
    return g.agg(F.avg(x).alias(f"mean_{x}"), F.count("*").alias("n"))


def sessions(df: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    """First and last time, rows and volume of each session of an instrument: rows less than gap apart belong together."""
    g = df.withColumn("ts", from_ms("ms")).withWatermark("ts", late).groupBy(F.session_window("ts", gap), "exchange", "symbol")
    return g.agg(F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"), F.count("*").alias("n"), F.sum("amount").alias("volume")).drop("session_window")


class RunningStats(StatefulProcessor):
    """Count, mean and sample variance of all values of an instrument so far, after each batch; batches are merged into the state."""

    OUT = "exchange string, symbol string, n long, mean double, variance double"
    STATE = "n long, mean double, m2 double"

    def __init__(self, x: str):
        self.x = x

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("stats", self.STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, mean, m2 = self.state.get() if self.state.exists() else (0, 0.0, 0.0)
        for p in rows:
            v = p[self.x].dropna().astype(float)
            if not len(v):
                continue
            d, k = float(v.mean()) - mean, len(v)
            m2 += float(((v - v.mean()) ** 2).sum()) + d * d * n * k / (n + k)
            mean, n = mean + d * k / (n + k), n + k
        self.state.update((n, mean, m2))
        yield pd.DataFrame([(key[0], key[1], n, mean, max(m2, 0.0) / (n - 1) if n > 1 else 0.0)], columns=["exchange", "symbol", "n", "mean", "variance"])

    def close(self) -> None:
        pass


def running_stats(df: DataFrame, x: str) -> DataFrame:
    return df.groupBy("exchange", "symbol").transformWithStateInPandas(RunningStats(x), RunningStats.OUT, "Append", "none")


class OrderFlow(StatefulProcessor):
    """Order flow of the best level against the snapshot before, for each instrument; the state outlives restarts.

    Rows of a batch are taken in the order of (ms, seq); a gap of over gap_ms starts anew, and so does each span of reset_ms (a
    day, say) where one is given.
    """

    OUT = "exchange string, symbol string, ms long, seq long, ofi double"
    STATE = "ms long, bp double, bs double, ap double, az double"

    def __init__(self, gap_ms: int = 300_000, reset_ms: int | None = None):
        self.gap_ms, self.reset_ms = gap_ms, reset_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        p = pd.concat(list(rows)).sort_values(["ms", "seq"])
        last, out = self.last.get() if self.last.exists() else None, []
        for r in p.itertuples():
            now = (int(r.ms), float(r.best_bid), float(r.top_bid_size), float(r.best_ask), float(r.top_ask_size))
            flow = 0.0
            if last is not None and now[0] - last[0] <= self.gap_ms and not (self.reset_ms and now[0] // self.reset_ms != last[0] // self.reset_ms):
                bid = now[2] if now[1] > last[1] else -last[2] if now[1] < last[1] else now[2] - last[2]
                ask = now[4] if now[3] < last[3] else -last[4] if now[3] > last[3] else now[4] - last[4]
                flow = bid - ask
            out.append((key[0], key[1], now[0], int(r.seq), flow))
            last = now
        self.last.update(last)
        yield pd.DataFrame(out, columns=["exchange", "symbol", "ms", "seq", "ofi"])

    def close(self) -> None:
        pass


def order_flow(books: DataFrame, gap_ms: int = 300_000, reset_ms: int | None = None) -> DataFrame:
    """books need best_bid, top_bid_size, best_ask, top_ask_size; uses the RocksDB state store."""
    return books.groupBy("exchange", "symbol").transformWithStateInPandas(OrderFlow(gap_ms, reset_ms), OrderFlow.OUT, "Append", "none")


def sink(df: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None, fmt: str = "parquet", every: str | None = None, max_records: int = 0) -> StreamingQuery:
    """Exactly-once files; rolling by trigger and by max_records. Without every, what is there is processed and the query ends."""
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.partitionBy(*keys) if keys else w
    w = w.option("maxRecordsPerFile", max_records) if max_records else w
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def roll(spark: SparkSession, active: str, ready: str, now_ms: int, max_bytes: int = 128 << 20, max_age_ms: int = 300_000, suffix: str = "") -> int:
    """Moves the files of each folder below active to the same folder below ready once they are max_bytes together or the youngest is
    max_age_ms old; returns how many were moved. Files are taken as they were committed, so none is moved half written."""
    fs = Files(spark, active)
    folders: dict[str, list[tuple[str, int, int]]] = {}
    for name, size in fs.list(active, suffix):
        own = fs.inside(active, name)
        if not any(part[:1] in "_." for part in own.split("/")):
            age = now_ms - fs.fs.getFileStatus(fs._path(name)).getModificationTime()
            folders.setdefault(own.rpartition("/")[0], []).append((own, size, age))
    moved = 0
    for files in folders.values():
        if sum(size for _, size, _ in files) >= max_bytes or min(age for _, _, age in files) >= max_age_ms:
            for own, _, _ in files:
                fs.rename(f"{active}/{own}", f"{ready}/{own}")
                moved += 1
    return moved

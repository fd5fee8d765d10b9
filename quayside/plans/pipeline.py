"""Transforms from named inputs to named outputs, their registry, and the runner. Plans stay lazy until outputs are written."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from quayside.functions.exprs import normalize_symbol
from quayside.operators import bars, book, features, flow, tables
from quayside.operators.filters import FilterSpec, predicate
from quayside.plans.config import Config
from quayside.sources import readers
from quayside.streaming import flows


class Transform(ABC):
    """Subclasses say which inputs and outputs they have and how one comes of the other."""

    needs: tuple[str, ...] = ()
    gives: tuple[str, ...] = ()

    def __init__(self, config: Config):
        config.validate()
        self.config = config

    def start(self) -> None:
        """Called once before the inputs are read."""

    @abstractmethod
    def transform(self, inputs: dict[str, DataFrame]) -> dict[str, DataFrame]: ...

    def finish(self) -> None:
        """Called once after the outputs are written."""


class Registry:
    def __init__(self):
        self._makers: dict[str, Callable[[Config], Transform]] = {}

    def add(self, name: str, maker: Callable[[Config], Transform]) -> None:
        if name in self._makers:
            raise ValueError(f"registered already: {name}")
        self._makers[name] = maker

    def register(self, name: str):
        def put(maker):
            self.add(name, maker)
            return maker

        return put

    def remove(self, name: str) -> None:
        self._makers.pop(name)

    def names(self) -> list[str]:
        return sorted(self._makers)

    def create(self, name: str, config: Config) -> Transform:
        if name not in self._makers:
            raise KeyError(f"no such transform: {name}; there are {self.names()}")
        return self._makers[name](config)


REGISTRY = Registry()


def run(spark: SparkSession, t: Transform, where: FilterSpec | None = None, dry_run: bool = False, limit: int | None = None) -> dict[str, int]:
    """Reads, transforms and writes; returns rows written by output (of a dry run, rows that would be)."""
    t.start()
    inputs = {}
    for i in t.config.inputs:
        df = readers.read(spark, i.path, i.format, i.schema)
        df = where.apply(df) if where else df
        df = df.filter(predicate(i.filters)) if i.filters else df
        df = df.select(*i.columns) if i.columns else df
        inputs[i.name] = df.limit(limit) if limit is not None else df
    if lacking := set(t.needs) - set(inputs):
        raise ValueError(f"inputs missing: {sorted(lacking)}")
    outputs = t.transform(inputs)
    if lacking := {o.name for o in t.config.outputs} - set(outputs):
        raise ValueError(f"outputs missing: {sorted(lacking)}")
    rows = {}
    for o in t.config.outputs:
        df = outputs[o.name]
        if not dry_run:
            if o.mode == "merge":
                tables.upsert(spark, o.path, df, o.keys, o.partition_by)
            else:
                tables.write(df, o.path, o.partition_by, o.mode)
            df = tables.read(spark, o.path)
        rows[o.name] = df.count()
    t.finish()
    return rows


def run_stream(spark: SparkSession, t: Transform, checkpoint: str, every: str | None = None, files_per_trigger: int = 100) -> StreamingQuery:
    """The transform over each batch of new files of its first input, appended to its outputs; other inputs are read whole in each
    batch. Without every, what is there is processed and the query ends. What a transform carries from row to row begins anew in each
    batch; operators that must carry over are those of quayside.streaming."""
    first = t.config.inputs[0]
    if not first.schema:
        raise ValueError("a stream needs the schema of its first input")
    source = flows.watch(spark, first.path, first.schema, first.format, files_per_trigger)

    def batch(df: DataFrame, number: int) -> None:
        inputs = {first.name: df.filter(predicate(first.filters)) if first.filters else df}
        inputs |= {i.name: readers.read(spark, i.path, i.format, i.schema) for i in t.config.inputs[1:]}
        outputs = t.transform(inputs)
        for o in t.config.outputs:
            tables.write(outputs[o.name], o.path, o.partition_by, "append")

    return flows.each_batch(source, batch, checkpoint, every)


class Chain:
    """Record processors one after the other: each takes a DataFrame and gives one, with more or fewer rows as it likes."""

    def __init__(self, *steps: Callable[[DataFrame], DataFrame]):
        self.steps = steps

    def __call__(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = step(df)
        return df


@REGISTRY.register("orderbook_features")
class BookFeatures(Transform):
    """Input orderbook (ms, seq, bids, asks), optionally trades; output silver."""

    needs, gives = ("orderbook",), ("silver",)

    def transform(self, inputs):
        f, d = self.config.features, inputs["orderbook"]
        trades = inputs.get("trades")
        if f.normalize_quotes:
            d = d.withColumn("symbol", normalize_symbol())
            trades = trades.withColumn("symbol", normalize_symbol()) if trades is not None else None
        if f.resample_frequency:
            d = bars.resample(d.withColumn("snapshot_seq", d["seq"]), f.resample_frequency, {"bids": "last", "asks": "last", "seq": "last"}, max_staleness=f.max_staleness).withColumnRenamed("label_ms", "ms")
        d = book.structural(d, f.depth_levels) if f.has("structural") else book.top_of_book(d)
        if f.has("structural"):
            d = book.exact_bands(d, f.bands_bps)
        if f.has("advanced"):
            d = book.convexity(book.half_depth_levels(book.slope_regression(d)))
        if f.has("rolling"):
            d = features.book_rolling(d, f.rolling_windows)
        if f.has("dynamic"):
            d = flow.rolling_flow(flow.motion(flow.order_flow(d, f.ofi_levels, f.ofi_decay_alpha, f.max_gap_seconds * 1000)), f.rolling_windows)
            d = flow.kyle_lambda(flow.spread_regime(d, f.spread_regime_window, f.spread_tight, f.spread_wide), f.kyle_lambda_window)
            d = flow.book_statistics(d)
            d = flow.trade_flow(d, trades, f.rolling_windows) if trades is not None else d
        d = features.add_date_columns(d)
        out = {"silver": d.drop("bids", "asks") if f.drop_raw_book_arrays else d}
        if f.has("bars"):
            out |= {f"bars_{s}s": features.add_date_columns(bars.book_bars(d, s), "bar_ms", False) for s in f.bar_durations}
        return out


@REGISTRY.register("trades_features")
class TradeFeatures(Transform):
    needs, gives = ("trades",), ("silver",)

    def transform(self, inputs):
        f = self.config.features
        d = inputs["trades"]
        d = features.trade_features(d.withColumn("symbol", normalize_symbol()) if f.normalize_quotes else d)
        return {"silver": features.trade_rolling(d) if f.has("rolling") else d}


@REGISTRY.register("ticker_features")
class TickerFeatures(Transform):
    needs, gives = ("ticker",), ("silver",)

    def transform(self, inputs):
        f = self.config.features
        d = inputs["ticker"]
        d = features.ticker_features(d.withColumn("symbol", normalize_symbol()) if f.normalize_quotes else d)
        return {"silver": features.ticker_rolling(d) if f.has("rolling") else d}


@REGISTRY.register("bars")
class Bars(Transform):
    """Input silver of one channel; one output bars_{seconds}s for each duration."""

    needs = ("silver",)
    channel = "trades"

    def transform(self, inputs):
        made = bars.bars(inputs["silver"], self.channel, self.config.features.bar_durations)
        return {f"bars_{s}s": features.add_date_columns(d, "bar_ms", False) for s, d in made.items()}

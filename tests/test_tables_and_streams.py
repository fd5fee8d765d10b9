import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quayside.operators import bars, book, features, flow, tables
from quayside.operators.filters import FilterSpec
from quayside.plans.config import Config, Features, Input, Output
from quayside.plans.pipeline import REGISTRY, Registry, run
from quayside.sources import readers, views
from quayside.streaming import flows

SF = "/root/testdata/sf0.001"


def table(spark, path):
    rows = [("x", "A", i, float(i), None if i == 4 else "v") for i in range(10)] + [("x", "B", i, float(i), "v") for i in range(5)]
    tables.write(spark.createDataFrame(rows, "exchange string, symbol string, k long, p double, s string"), path, ["exchange", "symbol"])


def rows(spark, path):
    return sorted((r.symbol, r.k, r.p) for r in tables.read(spark, path).collect())


def test_delete_keeps_null_predicates_and_other_partitions(spark, tmp_path):
    p = str(tmp_path / "t")
    table(spark, p)
    before = {f for f, _ in tables.Files(spark, p).list(p) if "symbol=B" in f}
    assert tables.delete(spark, p, F.col("s").isNull() & (F.col("k") > 100), dry_run=True).changed == 0
    st = tables.delete(spark, p, (F.col("k") >= 8) | (F.col("s") == "none"), backup=str(tmp_path / "b"))
    assert (st.partitions, st.changed, st.rows_after) == (1, 2, 8) and len(rows(spark, p)) == 13
    assert ("A", 4, 4.0) in rows(spark, p) and os.path.isdir(tmp_path / "b/exchange=x/symbol=A")
    assert before == {f for f, _ in tables.Files(spark, p).list(p) if "symbol=B" in f}


def test_update_and_upsert(spark, tmp_path):
    p = str(tmp_path / "t")
    table(spark, p)
    assert tables.update(spark, p, F.col("k") == 3, {"p": F.col("p") + 100}).changed == 2
    assert ("B", 3, 103.0) in rows(spark, p)
    new = spark.createDataFrame([("x", "A", 1, None), ("x", "A", 77, 7.0), ("x", "C", 1, 1.0)], "exchange string, symbol string, k long, p double")
    st = tables.upsert(spark, p, new, ["k"], ["exchange", "symbol"])
    assert (st.inserted, st.changed) == (2, 1)
    got = rows(spark, p)
    assert ("A", 1, 1.0) in got and ("A", 77, 7.0) in got and ("C", 1, 1.0) in got and len(got) == 17
    with pytest.raises(ValueError):
        tables.upsert(spark, p, new, ["nope"], ["exchange"])


def test_repartition_compact_sync_overwrite(spark, tmp_path):
    p, q = str(tmp_path / "t"), str(tmp_path / "q")
    table(spark, p)
    table(spark, p)
    assert tables.repartition(spark, p, q, ["symbol"], lambda d: d.filter("k < 3")).rows_after == 12
    out = tables.compact(spark, p, sort_by=["k", "missing"])
    assert out["files_after"] == 2 <= out["files_before"] and len(rows(spark, p)) == 30
    assert tables.sync(spark, p, str(tmp_path / "c"))["copied"] == 2 and tables.sync(spark, p, str(tmp_path / "c"))["skipped"] == 2
    one = spark.createDataFrame([("x", "A", 1, 1.0, "v")], "exchange string, symbol string, k long, p double, s string")
    tables.write(one, p, ["exchange", "symbol"], "overwrite_partition")
    assert len(rows(spark, p)) == 11
    tables.write(one, p, ["exchange", "symbol"], "overwrite")
    assert rows(spark, p) == [("A", 1, 1.0)] and tables.broken_files(spark, p) == []


def test_readers(spark, tmp_path):
    lines = [
        {"type": "ticker", "exchange": "x", "symbol": "A", "method": "m", "collected_at": 1704067200000, "capture_ts": "2024-01-01T00:00:00Z", "data": json.dumps({"bid": 1.5, "bidVolume": 2, "timestamp": 5})},
        {"type": "trades", "exchange": "x", "symbol": "A", "method": "m", "collected_at": 1704067200000, "capture_ts": None, "data": json.dumps([{"id": "1", "price": 2.0, "amount": 1, "side": "buy"}, {"id": "2", "price": 3.0}])},
        {"type": "orderbook", "exchange": "x", "symbol": "A", "method": "m", "collected_at": 1, "capture_ts": None, "data": json.dumps({"bids": [[1, 2], [0.5, 3]], "asks": [], "nonce": 9})},
        {"type": "odd", "exchange": "x", "symbol": "A", "method": "m", "collected_at": 1, "capture_ts": None, "data": "{}"},
    ]
    f = tmp_path / "r.json"
    f.write_text("\n".join(map(json.dumps, lines)) + "\n\n{broken\n")
    good, bad = readers.read_ndjson_lenient(spark, str(f), readers.RECORD)
    assert bad.count() == 1
    by = readers.split_channels(good)
    assert by["ticker"].first().bid_volume == 2.0 and by["ticker"].first().year == 2024
    assert sorted(r.trade_id for r in by["trades"].collect()) == ["1", "2"]
    assert by["orderbook"].first().bids[1].size == 3.0 and by["generic"].first().type == "odd"
    env = {"capture_ts": "t", "data": {"channel": "l2", "sequence_num": 4, "events": [{"type": "update", "product_id": "P", "updates": [{"side": "bid", "price_level": "1.5", "new_quantity": "x", "event_time": "e"}]}]}}
    g = tmp_path / "e.json"
    g.write_text(json.dumps(env))
    r = readers.parse_envelope(readers.read(spark, str(g), "ndjson", readers.ENVELOPE), "updates").first()
    assert (r.product_id, r.price_level, r.new_quantity, r.side) == ("P", 1.5, 0.0, "bid")
    with pytest.raises(ValueError):
        readers.read(spark, str(g), "orc")


def test_runner_and_registry(spark, tmp_path):
    src, out = str(tmp_path / "books"), str(tmp_path / "silver")
    views.books(spark, SF).limit(200).write.parquet(src)
    c = Config("f", [Input("orderbook", src)], [Output("silver", out)], Features(("structural", "rolling", "dynamic", "advanced"), rolling_windows=(5, 60)))
    assert run(spark, REGISTRY.create("orderbook_features", c)) == {"silver": 200}
    cols = tables.read(spark, out).columns
    assert {"ofi_sum_60s", "rv_hop_5s", "kyle_lambda", "book_convexity", "total_imbalance", "year"} <= set(cols) and "bids" not in cols
    assert run(spark, REGISTRY.create("orderbook_features", c), FilterSpec("x0"), dry_run=True)["silver"] < 200
    r = Registry()
    r.add("a", REGISTRY.create)
    with pytest.raises(ValueError):
        r.add("a", REGISTRY.create)
    with pytest.raises(KeyError):
        r.create("b", c)
    with pytest.raises(ValueError):
        Config("f").validate()


def test_stream_equals_batch(spark, tmp_path):
    t = views.trades(spark, SF)
    src = str(tmp_path / "src")
    # A row far in the future moves the watermark past all others.
    t.unionByName(t.limit(1).withColumn("ms", F.lit(2 * 10**12))).repartition(3).write.parquet(src)
    s = flows.watch(spark, src, "seq long, exchange string, symbol string, ms long, price double, amount double, side string", files_per_trigger=1)
    q = flows.sink(flows.trade_bars(s, 3600, "60 days"), str(tmp_path / "out"), str(tmp_path / "ck"), ["exchange"])
    q.awaitTermination(120)
    cols = ["exchange", "symbol", "bar_ms", "open", "close", "trade_count"]
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select(*cols).collect()}
    want = {tuple(r) for r in bars.trade_bars(features.trade_features(t), 3600).select(*cols).collect()}
    assert got == want


@pytest.mark.parametrize("name", ["st2_tumbling", "st3_sliding", "st4_sessions"])
def test_stream_queries_do_not_hang_on_the_times_of_files(spark, monkeypatch, name):
    """Whenever a stream starts, the file written last has the earliest time, and times lie within a second."""
    paths, watch, sink = [], flows.watch, flows.sink

    def watched(s, path, *a, **k):
        paths.append(path.removeprefix("file:"))
        return watch(s, path, *a, **k)

    def started(*a, **k):
        files = sorted(glob.glob(f"{paths[-1]}/*.parquet"), key=os.path.getmtime)
        now = time.time()
        for i, f in enumerate(files):
            os.utime(f, (now, now - i / 10))
        return sink(*a, **k)

    query = __spark_entry__.queries()[name]
    monkeypatch.setattr(flows, "watch", watched)
    monkeypatch.setattr(flows, "sink", started)
    assert query(spark, SF).agg(F.sum({"st2_tumbling": "trade_count"}.get(name, "n"))).first()[0] == views.trades(spark, SF).count() * (2 if name == "st3_sliding" else 1)


def test_streaming_order_flow_equals_batch(spark, tmp_path):
    b = book.top_of_book(views.books(spark, SF)).select("exchange", "symbol", "ms", "seq", "best_bid", "top_bid_size", "best_ask", "top_ask_size")
    src = str(tmp_path / "src")
    b.filter("seq < 700").coalesce(1).write.parquet(src)
    b.filter("seq >= 700").coalesce(1).write.mode("append").parquet(src)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    s = flows.watch(spark, src, "exchange string, symbol string, ms long, seq long, best_bid double, top_bid_size double, best_ask double, top_ask_size double")
    flows.sink(flows.order_flow(s), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(180)
    got = {(r.seq, round(r.ofi, 6)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.seq, round(r.ofi, 6)) for r in flow.order_flow(book.top_of_book(views.books(spark, SF))).collect()}
    assert got == want


ODD = [("a:b", 1), ("a:b", 2), (None, 1), (None, 2), ("x/y", 1), ("x/y", 2), ("50%", 1), ("ok", 1), ("ok", 2), ("[q]*?", 1)]


def odd_table(spark, path):
    tables.write(spark.createDataFrame([(s, v, float(v)) for s, v in ODD], "symbol string, v long, p double"), path, ["symbol"], sanitized=False)


def content(spark, path):
    return sorted(((r.symbol or "-", r.v, r.p) for r in tables.read(spark, path).collect()), key=str)


def test_changes_reach_partitions_of_any_name(spark, tmp_path):
    p = str(tmp_path / "t")
    odd_table(spark, p)
    st = tables.delete(spark, p, F.col("v") == 1)
    assert (st.partitions, st.rows_before, st.rows_after, st.changed) == (6, 10, 4, 6)
    assert content(spark, p) == sorted([(s or "-", v, float(v)) for s, v in ODD if v != 1], key=str)
    assert tables.update(spark, p, F.col("v") == 2, {"p": F.col("p") * 10}).changed == 4
    assert content(spark, p) == sorted([(s or "-", v, 20.0) for s, v in ODD if v != 1], key=str)
    new = spark.createDataFrame([(None, 2, None), ("", 7, 7.0), ("a:b", 2, 5.0), ("x/y", 9, 9.0), ("new:one", 1, 1.0)], "symbol string, v long, p double")
    st = tables.upsert(spark, p, new, ["v"], ["symbol"])
    assert (st.inserted, st.changed, st.rows_before, st.rows_after) == (3, 2, 3, 6)
    assert content(spark, p) == sorted([("-", 2, 20.0), ("-", 7, 7.0), ("a:b", 2, 5.0), ("x/y", 2, 20.0), ("x/y", 9, 9.0), ("ok", 2, 20.0), ("new:one", 1, 1.0)], key=str)
    assert tables.Files(spark, p).beside(p, tables.SWAP) == []


def test_a_change_within_some_partitions_only(spark, tmp_path):
    p = str(tmp_path / "t")
    odd_table(spark, p)
    assert tables.delete(spark, p, F.col("v") == 1, partitions=F.col("symbol") == "ok").changed == 1
    assert tables.update(spark, p, F.col("v") == 2, {"p": F.lit(0.0)}, partitions=F.col("symbol") == "x/y").changed == 1
    assert len(content(spark, p)) == 9 and ("x/y", 2, 0.0) in content(spark, p)


def test_a_swap_that_was_broken_off_is_completed_or_undone(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "t")
    odd_table(spark, p)
    before = content(spark, p)
    real, calls = tables.Files.rename, []

    def breaking(after):
        def rename(self, a, b):
            calls.append(1)
            if len(calls) > after:
                raise OSError("power cut")
            return real(self, a, b)

        return rename

    monkeypatch.setattr(tables.Files, "rename", breaking(0))
    with pytest.raises(OSError):
        tables.delete(spark, p, F.col("v") == 1)
    monkeypatch.undo()
    assert content(spark, p) == before and tables.recover(spark, p) == 1 and content(spark, p) == before
    for after in (1, 2, 3, 6):
        calls.clear()
        q = str(tmp_path / f"t{after}")
        odd_table(spark, q)
        monkeypatch.setattr(tables.Files, "rename", breaking(after))
        with pytest.raises(OSError):
            tables.delete(spark, q, F.col("v") == 1)
        monkeypatch.undo()
        assert tables.recover(spark, q) == 1
        assert content(spark, q) == sorted([(s or "-", v, float(v)) for s, v in ODD if v != 1], key=str)


def test_migration_mismatch_and_layout(spark, tmp_path):
    p = str(tmp_path / "t")
    rows = [("A-USDC", 1, "A"), ("A-USD", 2, "A"), ("B-USDC", 3, "B"), ("C-EUR", 4, "C"), (None, 5, None)]
    tables.write(spark.createDataFrame(rows, "symbol string, v long, base string"), p, ["symbol"], sanitized=False)
    assert tables.migrate_symbols(spark, p, "USDC", "USD", dry_run=True).changed == 2
    assert tables.migrate_symbols(spark, p, "USDC", "USD").changed == 2
    assert sorted((r.symbol or "-", r.v) for r in tables.read(spark, p).collect()) == [("-", 5), ("A-USD", 1), ("A-USD", 2), ("B-USD", 3), ("C-EUR", 4)]
    assert tables.migrate_symbols(spark, p, "USDC", "USD").changed == 0
    expected = {"symbol": F.concat("base", F.lit("-USD"))}
    bad = tables.mismatched(spark, p, expected).collect()
    assert [(r.v, "symbol=C-EUR" in r.file) for r in bad] == [(4, True)]
    assert tables.fix_mismatched(spark, p, expected).changed == 1 and tables.mismatched(spark, p, expected).count() == 0
    assert tables.layout_problems(spark, p, ["symbol"]) == [] and len(tables.layout_problems(spark, p, ["exchange"])) == 4
    d = tables.ensure_partition_columns(spark.createDataFrame([(1704067200000,)], "ms long"), ["year", "day"]).first()
    assert (d.year, d.day) == (2024, 1)
    with pytest.raises(ValueError):
        tables.ensure_partition_columns(spark.createDataFrame([(1,)], "ms long"), ["exchange"])


def test_broken_files_are_found_and_repaired(spark, tmp_path):
    p, q = str(tmp_path / "t"), str(tmp_path / "copy")
    odd_table(spark, p)
    heard = []
    assert tables.sync(spark, p, q, pattern="symbol=(ok|50)", on_file=lambda name, size: heard.append(name))["copied"] == 2 == len(heard)
    files = [f for f, _ in tables.Files(spark, p).list(p)]
    for mark in ("symbol=ok", "symbol=a"):
        name = next(f for f in files if mark in f).removeprefix("file:")
        data = open(name, "rb").read()
        open(name, "wb").write(data[: len(data) // 2])
        os.remove(os.path.join(os.path.dirname(name), "." + os.path.basename(name) + ".crc"))
    assert len(tables.broken_files(spark, p)) == 2
    got = tables.repair(spark, p, q)
    assert [len(got[k]) for k in ("fetched", "deleted")] == [1, 1] and tables.broken_files(spark, p) == []
    assert len(content(spark, p)) == 8
    tables.write(spark.range(3).toDF("v"), str(tmp_path / "flat"), [])
    tables.write(spark.range(2).toDF("v"), str(tmp_path / "flat"), [])
    assert spark.read.parquet(str(tmp_path / "flat")).count() == 5


def test_the_row_that_ends_a_stream_comes_last(spark, monkeypatch):
    from quayside.plans import catalog_io

    paths, watch = [], flows.watch
    monkeypatch.setattr(flows, "watch", lambda s, path, *a, **k: paths.append(path) or watch(s, path, *a, **k))
    t = views.trades(spark, SF)
    catalog_io._stream(spark, SF, t, catalog_io.TRADES)
    m = F.col("_metadata")
    files = spark.read.parquet(paths[0]).groupBy(m["file_path"].alias("f"), m["file_modification_time"].alias("at")).agg(F.count("*").alias("n"), F.max("ms").alias("ms")).orderBy("at").collect()
    assert files[-1].ms == catalog_io.FAR and files[-1].n == 1 and files[-1].at > files[-2].at
    assert all(f.ms < catalog_io.FAR for f in files[:-1]) and sum(f.n for f in files) == t.count() + 1

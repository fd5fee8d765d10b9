"""Queries against their SQL where prices are 0, which sf0.1 holds and the smaller tables do not."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__

QUERIES = ["f14_trade_features", "a12_correlations", "p12_not_null", "r12_hindsight", "r2_strategy_backtest", "r3_trade_log", "r7_by_day", "r9_sign_flip", "u7_chained_equity", "w5_forward_return", "a11_count_bars", "a13_rank_correlation", "a15_daily_summary", "a3_trade_bars"]


@pytest.fixture(scope="module")
def zeros(spark, tmp_path_factory):
    """sf0.01's events with a price of 0 here and there, once in two rows on end."""
    path = str(tmp_path_factory.mktemp("zeros"))
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    e = e.withColumn("value", F.when((F.col("event_id") % 701 == 5) | (F.col("user_id") == 0) & (F.col("event_id") < 2000), 0.0).otherwise(F.col("value")))
    e.coalesce(1).write.parquet(f"{path}/events.parquet")
    return path


def _number(x):
    if isinstance(x, bool) or not isinstance(x, (int, float)):
        return x
    return "nan" if math.isnan(x) else float(x)


@pytest.mark.parametrize("name", QUERIES)
def test_zero_prices_as_in_sql(spark, zeros, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{zeros}/events.parquet/*.parquet'")
    c.execute("CREATE VIEW orders AS SELECT * FROM '/root/testdata/sf0.001/orders.parquet'")
    c.execute("CREATE VIEW lineitem AS SELECT * FROM '/root/testdata/sf0.001/lineitem.parquet'")
    got = __spark_entry__.queries()[name](spark, zeros)
    columns = sorted(got.columns)
    want = c.sql(__spark_entry__.oracle_sql()[name]).select(", ".join(f'"{x}"' for x in columns)).fetchall()
    key = lambda r: tuple(str(_number(x)) for x in r)
    assert sorted(map(key, got.select(*columns).collect())) == sorted(map(key, want))

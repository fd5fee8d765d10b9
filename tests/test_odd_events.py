"""Queries against their SQL on events with missing times or users or one price throughout, and on few rows."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__

ODD = {
    "null times": lambda e: e.withColumn("ts", F.expr("CASE WHEN event_id % 89 <> 4 THEN ts END")),
    "null users": lambda e: e.withColumn("user_id", F.expr("CASE WHEN event_id % 89 <> 4 THEN user_id END")),
    "one price": lambda e: e.withColumn("value", F.lit(10.0)),
    "fifty rows": lambda e: e.filter("event_id < 50"),
    "three hundred rows": lambda e: e.filter("event_id < 300"),
    "no rows": lambda e: e.filter("false"),
}
CASES = [
    ("a12_correlations", "one price"), ("a12_correlations", "fifty rows"), ("a12_correlations", "no rows"), ("a12_correlations", "null times"),
    ("p12_not_null", "null times"), ("r3_trade_log", "null times"), ("r3_trade_log", "null users"),
    ("w5_forward_return", "null times"),
    ("r7_by_day", "null times"),
    ("a15_daily_summary", "null times"),
    ("a13_rank_correlation", "three hundred rows"), ("a13_rank_correlation", "null times"), ("a13_rank_correlation", "null users"),
    ("r9_sign_flip", "no rows"), ("r9_sign_flip", "null times"),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("odd")

    def at(kind):
        there = path / kind.replace(" ", "_")
        if not there.exists():
            ODD[kind](spark.read.parquet("/root/testdata/sf0.01/events.parquet")).coalesce(1).write.parquet(str(there / "events.parquet"))
        return str(there)

    return at


def _text(x):
    return "nan" if isinstance(x, float) and math.isnan(x) else str(float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x)


@pytest.mark.parametrize(("name", "kind"), CASES)
def test_as_in_sql(spark, odd, name, kind):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{odd(kind)}/events.parquet/*.parquet'")
    c.execute("CREATE VIEW orders AS SELECT * FROM '/root/testdata/sf0.001/orders.parquet'")
    c.execute("CREATE VIEW lineitem AS SELECT * FROM '/root/testdata/sf0.001/lineitem.parquet'")
    got = __spark_entry__.queries()[name](spark, odd(kind))
    columns = sorted(got.columns)
    want = c.sql(__spark_entry__.oracle_sql()[name]).select(", ".join(f'"{x}"' for x in columns)).fetchall()
    key = lambda r: tuple(map(_text, r))
    assert sorted(map(key, got.select(*columns).collect())) == sorted(map(key, want))

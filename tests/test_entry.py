import importlib
import os
import subprocess
import sys

import pytest

import __spark_entry__


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q) and "a3_trade_bars" in o


def test_works_without_the_llm_subpackage(monkeypatch):
    for name in ("quayside.llm", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    m = importlib.reload(__spark_entry__)
    assert m.llm is None and not any(n.startswith("op") for n in m.queries()) and "d2_order_flow" in m.queries()
    monkeypatch.undo()
    importlib.reload(__spark_entry__)


def test_nothing_else_imports_the_subpackage():
    code = """
import importlib, pkgutil, sys
for p in ("sources", "functions", "operators", "plans", "streaming"):
    for m in pkgutil.iter_modules(importlib.import_module(f"quayside.{p}").__path__):
        importlib.import_module(f"quayside.{p}.{m.name}")
assert "quayside.plans.catalog" in sys.modules and not any(n.startswith("quayside.llm") for n in sys.modules)
"""
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=120, cwd=os.path.dirname(__spark_entry__.__file__)).returncode == 0


@pytest.mark.parametrize("name", ["a3_trade_bars", "m3_structural", "d6_rolling_flow", "j1_asof", "d18_volume_bars", "r7_report"])
def test_queries_equal_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("events", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = c.sql(__spark_entry__.oracle_sql()[name])
    got = __spark_entry__.queries()[name](spark, sf)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    number = lambda x: float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    key = lambda r: tuple(str(number(x)) for x in r)
    assert sorted(map(key, got.select(*(f"`{x}`" for x in columns)).collect())) == sorted(map(key, want.select(", ".join(f'"{x}"' for x in columns)).fetchall()))

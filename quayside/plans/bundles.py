"""Bundles: a strategy's configuration, features, metrics and model, kept in a folder of any file system."""

from __future__ import annotations

import json
from dataclasses import asdict, is_dataclass
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import SparkSession

from quayside.operators.tables import Files


def _described(x: Any) -> dict[str, Any]:
    return {"class": type(x).__name__, "params": asdict(x) if is_dataclass(x) else {k: v for k, v in vars(x).items() if k[0] != "_"}}


def export(
    spark: SparkSession, folder: str, strategy: Any, signal: Any = None, name: str | None = None, features: list[str] | None = None,
    metrics: dict[str, Any] | None = None, training_days: list[tuple[int, int, int]] | None = None, test_days: list[tuple[int, int, int]] | None = None,
    model: Any = None, exchange: str | None = None, symbol: str | None = None,
) -> str:
    """Writes config.json, metadata.json, features.json and, where given, the Spark ML model; returns the bundle's folder."""
    now = datetime.now(UTC)
    path = f"{folder.rstrip('/')}/{name or f'{type(strategy).__name__.lower()}_{now:%Y%m%d_%H%M%S}'}"
    fs = Files(spark, folder)
    days = lambda d: [f"{y}-{m:02d}-{x:02d}" for y, m, x in d]
    meta: dict[str, Any] = {"exported_at": now.isoformat(), "strategy": type(strategy).__name__}
    meta |= {"training_dates": days(training_days)} if training_days else {}
    meta |= {"test_dates": days(test_days)} if test_days else {}
    meta |= {"metrics": metrics} if metrics else {}
    if model is not None:
        model.write().overwrite().save(f"{path}/model")
    if features:
        fs.write_text(f"{path}/features.json", json.dumps(features, indent=2))
    fs.write_text(f"{path}/metadata.json", json.dumps(meta, indent=2, default=str))
    # Last, as a folder with it counts as a bundle.
    fs.write_text(f"{path}/config.json", json.dumps({"strategy": _described(strategy), "signal": _described(signal) if signal is not None else None, "data": {"exchange": exchange, "symbol": symbol}}, indent=2, default=str))
    return path


def load(spark: SparkSession, bundle: str, part: str = "config") -> Any:
    """config, metadata or features of a bundle."""
    return json.loads(Files(spark, bundle).read_text(spark, f"{bundle}/{part}.json"))


def bundles(spark: SparkSession, folder: str) -> list[str]:
    fs = Files(spark, folder)
    found = fs.fs.globStatus(fs._path(f"{folder.rstrip('/')}/*/config.json"))
    return sorted(str(x.getPath().getParent().getName()) for x in found or ())

"""Predicates from tuples and filter specifications."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import date, datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.exprs import symbol_variants

_OPS = {
    "=": lambda c, v: c == v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, "in": lambda c, v: c.isin(*v),
}


def predicate(tuples: list[tuple[str, str, Any]]) -> Column:
    """Conjunction of (column, operator, value); between takes two values, both included."""

    def one(name: str, op: str, value: Any) -> Column:
        if op == "between":
            if len(value) != 2:
                raise ValueError("between needs two values")
            return F.col(name).between(*value)
        if op not in _OPS:
            raise ValueError(f"unknown operator: {op}")
        return _OPS[op](F.col(name), value)

    return reduce(lambda a, b: a & b, (one(*t) for t in tuples), F.lit(True))


@dataclass(frozen=True)
class FilterSpec:
    """exchange, symbol, and either a date range or date parts; a range takes precedence over parts."""

    exchange: str | None = None
    symbol: str | None = None
    year: int | None = None
    month: int | None = None
    day: int | None = None
    hour: int | None = None
    start_date: str | None = None
    end_date: str | None = None
    normalize_quotes: bool = True

    @property
    def _parts(self) -> dict[str, int]:
        return {k: v for k in ("year", "month", "day", "hour") if (v := getattr(self, k)) is not None}

    def partition_tuples(self) -> list[tuple[str, str, Any]]:
        out: list[tuple[str, str, Any]] = [("exchange", "=", self.exchange)] if self.exchange else []
        if self.symbol:
            names = symbol_variants(self.symbol) if self.normalize_quotes else [self.symbol]
            out.append(("symbol", "in", names) if len(names) > 1 else ("symbol", "=", names[0]))
        return out + [(k, "=", v) for k, v in ({} if self.start_date or self.end_date else self._parts).items()]

    def to_column(self, columns: list[str], ms: str = "ms") -> Column:
        """Predicate over ms or capture_ts, and over year/month/day too where they exist, so that a date range prunes partitions."""
        out = predicate(self.partition_tuples())
        time = F.col(ms) if ms in columns else F.unix_millis(F.col("capture_ts"))
        at = lambda d: int((datetime.fromisoformat(d) - datetime(1970, 1, 1)).total_seconds() * 1000)
        number = lambda d: d.year * 10000 + d.month * 100 + d.day
        parts = F.col("year") * 10000 + F.col("month") * 100 + F.col("day") if {"year", "month", "day"} <= set(columns) else None
        if self.start_date:
            out &= time >= at(self.start_date)
            out &= parts >= number(date.fromisoformat(self.start_date)) if parts is not None else F.lit(True)
        if self.end_date:
            end = date.fromisoformat(self.end_date) + timedelta(days=1)
            out &= time < at(end.isoformat())
            out &= parts < number(end) if parts is not None else F.lit(True)
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.to_column(df.columns))

    def to_dict(self) -> dict[str, Any]:
        return {k: v for k, v in asdict(self).items() if v is not None}

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> FilterSpec:
        return cls(**{k: v for k, v in d.items() if k in cls.__dataclass_fields__})

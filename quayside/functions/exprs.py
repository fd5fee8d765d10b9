"""Scalar building blocks: guarded arithmetic, symbols, times, durations and price levels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quote currencies counted as US dollars.
STABLE = ("USDC", "USDT", "BUSD", "TUSD", "USDP", "GUSD", "DAI", "FRAX", "LUSD", "USDD", "PYUSD")
USD_LIKE = ("USD", *STABLE)
_UNITS = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sdiv(a: str | Column, b: str | Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def sln(x: str | Column) -> Column:
    """Natural logarithm, null where x is not positive."""
    return F.when(col(x) > 0, F.ln(col(x)))


def div(a: str | Column, b: str | Column) -> Column:
    """a / b as IEEE 754 has it: infinite or NaN where b is 0."""
    x, y = col(a).cast("double"), col(b).cast("double")
    return F.when(y == 0, x * F.pow(y, F.lit(-1.0))).otherwise(F.try_divide(x, y))


def log(x: str | Column) -> Column:
    """Natural logarithm as IEEE 754 has it: minus infinity of 0, NaN of what is negative."""
    y = col(x).cast("double")
    return F.when(y == 0, float("-inf")).when(y < 0, float("nan")).otherwise(F.ln(y))


# ---- symbols


def normalize_symbol(x: str | Column = "symbol") -> Column:
    return F.regexp_replace(col(x), "-(" + "|".join(STABLE) + ")$", "-USD")


def base_currency(x: str | Column = "symbol") -> Column:
    """What stands before the last separator; null without one."""
    return F.when(F.instr(col(x), "-") > 0, F.regexp_extract(col(x), "^(.*)-[^-]*$", 1))


def quote_currency(x: str | Column = "symbol") -> Column:
    return F.when(F.instr(col(x), "-") > 0, F.substring_index(col(x), "-", -1))


def is_usd_quoted(x: str | Column = "symbol") -> Column:
    return F.coalesce(quote_currency(x).isin(*USD_LIKE), F.lit(False))


def symbol_variants(symbol: str) -> list[str]:
    """All US-dollar spellings of a symbol that has one, sorted; else the symbol alone."""
    base, sep, quote = symbol.rpartition("-")
    return sorted(f"{base}-{q}" for q in USD_LIKE) if sep and quote in USD_LIKE else [symbol]


def symbol_matches(symbol: str, x: str | Column = "symbol", normalize: bool = True) -> Column:
    return col(x).isin(*symbol_variants(symbol)) if normalize else col(x) == symbol


def symbols_match(a: str | Column, b: str | Column) -> Column:
    return normalize_symbol(a) == normalize_symbol(b)


def sanitize(x: str | Column) -> Column:
    """A value that may stand in a partition path; null becomes unknown."""
    return F.coalesce(F.regexp_replace(col(x).cast("string"), r'[/\\:*?"<>|]', "-"), F.lit("unknown"))


def identifier(x: str | Column) -> Column:
    return F.lower(F.translate(col(x), "-/", "__"))


# ---- times


def from_ms(x: str | Column) -> Column:
    return F.timestamp_millis(col(x))


def date_parts(ms: str | Column, hour: bool = True) -> dict[str, Column]:
    t = from_ms(ms)
    parts = {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t)}
    return parts | ({"hour": F.hour(t)} if hour else {})


def day_of_week(ms: str | Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(from_ms(ms)) + 1


def parse_utc(x: str | Column) -> Column:
    """Timestamp of an ISO string (with Z, offset or none), or of epoch seconds or milliseconds in digits; null if neither."""
    s = col(x).cast("string")
    n = s.try_cast("double")
    return F.coalesce(F.when(n.isNotNull(), F.timestamp_millis(F.when(n > 1e12, n).otherwise(n * 1000).cast("long"))), s.try_cast("timestamp"))


def epoch_to_ms(x: str | Column) -> Column:
    """Numbers above 1e12 are milliseconds already, others seconds."""
    return F.when(col(x) > 1e12, col(x)).otherwise(col(x) * 1000).cast("long")


def duration_ms(text: str) -> int:
    """'5m' -> 300000. Units s, m, h, d."""
    m = re.fullmatch(r"(\d+)([smhd])", text.strip())
    if not m:
        raise ValueError(f"not a duration: {text!r}")
    return int(m[1]) * _UNITS[m[2]]


# ---- price levels: arrays of (price, size), best first


def level(side: str, i: int, what: str) -> Column:
    """0 where there is no such level."""
    return F.coalesce(F.get(F.col(side), F.lit(i)).getField(what), F.lit(0.0))


def top_sum(side: str, n: int, term: str = "x.size") -> Column:
    """Sum over the first n levels of a SQL term in x.price and x.size; null terms count as 0."""
    return F.expr(f"aggregate(slice({side}, 1, {n}), 0D, (a, x) -> a + coalesce({term}, 0D))")

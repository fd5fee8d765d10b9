"""SQL over the engine: temporary views of tables, and its scalar expressions as SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.exprs import STABLE, USD_LIKE

_FUNCTIONS = {
    "normalize_symbol(s STRING) RETURNS STRING": f"regexp_replace(s, '-({'|'.join(STABLE)})$', '-USD')",
    "is_usd_quoted(s STRING) RETURNS BOOLEAN": f"coalesce(instr(s, '-') > 0 AND substring_index(s, '-', -1) IN ({', '.join(repr(q) for q in USD_LIKE)}), false)",
    "sdiv(a DOUBLE, b DOUBLE) RETURNS DOUBLE": "try_divide(a, b)",
    "sln(x DOUBLE) RETURNS DOUBLE": "CASE WHEN x > 0 THEN ln(x) END",
    "bucket_ms(ms BIGINT, size_ms BIGINT) RETURNS BIGINT": "CAST(floor(ms / size_ms) * size_ms AS BIGINT)",
    "imbalance(bid DOUBLE, ask DOUBLE) RETURNS DOUBLE": "try_divide(bid - ask, bid + ask)",
}


def register(spark: SparkSession, views: dict[str, DataFrame] | None = None) -> list[str]:
    """Makes the functions and views known to spark.sql in this session; returns their names. They are SQL, so Catalyst sees through them."""
    for head, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return [h.split("(")[0] for h in _FUNCTIONS] + list(views or ())

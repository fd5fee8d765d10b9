"""Quayside: market-data analytics expressed as Spark DataFrame and SQL plans."""

"""Reading the tables of the queries, and settings of Arrow exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import ensure_checkpoint_dir

#: Rows a batch for Python; with some thousand characters a text it stays at a few MB.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches by rows, as texts are far longer than other values."""
    ensure_checkpoint_dir(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def keyed_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (doc_id long, text string), null text as empty: other columns, whatever their names, cannot clash."""
    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

"""Session helpers: configuration, and cutting lineage in storage that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build(master: str | None = None, app: str = "quayside", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app).config(map=CONF | conf)
    return (b.master(master) if master else b).getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the session names; where it names none, one beside the warehouse (local mode: a temporary one)."""
    sc = spark.sparkContext
    if (there := sc.getCheckpointDir()) is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            local = sc.master.startswith("local[") or sc.master == "local"
            named = tempfile.mkdtemp(prefix="checkpoints-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        sc.setCheckpointDir(named)
        there = sc.getCheckpointDir()
    return there


def cut(df: DataFrame) -> DataFrame:
    """df computed once, written to the checkpoint folder and read from there: a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

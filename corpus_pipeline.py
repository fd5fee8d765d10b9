"""Corpus pipeline: what survives of documents, packed into sequences.

STAGES names each stage and its function (spark, docs, sf_dir) -> DataFrame. All but the last return the columns of
documents: toxic documents go, of equal texts the largest doc_id stays, of near-duplicates the smallest doc_id stays,
secrets are replaced in the texts, and the rest is packed. run() writes each stage to the checkpoint folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import exact_dedup, packing, secrets, simhash, toxicity
from quayside.llm.tables import prepared, table
from quayside.session import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_last(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("packing", pack),
]

#: The learned lexicon, ball hashing and subset sums have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs

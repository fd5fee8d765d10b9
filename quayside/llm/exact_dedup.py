"""Exact dedup with a heavy-hitter split: Misra-Gries candidates, verified counts, broadcast winners, shuffle of the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.tables import keyed_texts
from quayside.session import cut

#: Counters of a Misra-Gries summary. At most COUNTERS + 1 digests pass the merged threshold, so as many rows are broadcast.
COUNTERS = 1024


class MisraGries:
    """Frequent-item summary of at most k counters; an item's count is low by at most rows / (k + 1). Summaries may be merged by adding."""

    def __init__(self, k: int = COUNTERS):
        self.k, self.counts = k, {}

    def add(self, values: list, counts: list) -> None:
        c = self.counts
        for x, n in zip(values, counts, strict=True):
            c[x] = c.get(x, 0) + n
        if len(c) > self.k:
            cut_off = np.partition(np.fromiter(c.values(), np.int64, len(c)), len(c) - self.k - 1)[len(c) - self.k - 1]
            self.counts = {x: n - cut_off for x, n in c.items() if n > cut_off}


def _summaries(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mg, rows = MisraGries(k), 0
        for b in batches:
            rows += b.num_rows
            found = b.column(0).value_counts()
            mg.add(found.field(0).to_pylist(), found.field(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array([*mg.counts, None], pa.binary()), pa.array([*map(int, mg.counts.values()), rows], pa.int64())], names=["digest", "n"]
        )

    return run


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of each text in UTF-8."""
    return keyed_texts(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))


def frequent(hashed: DataFrame, k: int = COUNTERS) -> DataFrame:
    """(digest, keep_id, group_size) of every digest that holds over 2 / (k + 1) of the rows, at most k + 1 of them.

    The merged counts sum to the rows at most and each is low by rows / (k + 1) at most, so the digests with a merged count
    of rows / (k + 1) are few and include all that frequent. Their true counts come from a second pass over the digests.
    """
    merged = cut(hashed.select("digest").mapInArrow(_summaries(k), "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n")))
    rows = merged.filter("digest IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    candidates = merged.filter("digest IS NOT NULL AND n > 1").join(F.broadcast(rows), F.col("n") * (k + 1) >= F.col("rows")).select(F.col("digest").alias("d_"))
    return hashed.join(F.broadcast(candidates), F.col("digest") == F.col("d_"), "left_semi").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def exact_groups(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest doc_id of equal texts is kept. Null texts equal empty ones. Should the largest doc_id itself be
    repeated, each of its rows counts in group_size and is marked kept. A group whose doc_ids are all null has keep_id null
    and is kept. An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    hashed = cut(digests(docs))
    heavy = cut(frequent(hashed, k)).select(F.col("digest").alias("h_"), F.col("keep_id").alias("hk_"), F.col("group_size").alias("hn_"))
    marked = hashed.join(F.broadcast(heavy), F.col("digest") == F.col("h_"), "left")
    known = marked.filter("h_ IS NOT NULL").select("doc_id", "digest", F.col("hk_").alias("keep_id"), F.col("hn_").alias("group_size"))
    same = Window.partitionBy("digest")
    rest = marked.filter("h_ IS NULL").select(
        "doc_id", "digest", F.max("doc_id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size")
    )
    return known.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_last(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """The rows of docs that exact_groups keeps, with all their columns; of repeated rows with the kept doc_id, all."""
    kept = exact_groups(docs, k).filter("kept").select(F.col("doc_id").alias("keep_")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("keep_")), "left_semi")

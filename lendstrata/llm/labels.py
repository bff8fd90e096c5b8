"""Labelled rows that models learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows a model is fitted on. The rows are those with the smallest id hashes.
SAMPLE_ROWS = 40_000


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def sample(labels: DataFrame, label: str, learn: Column, limit: int = SAMPLE_ROWS) -> list[tuple[int, int]]:
    """(doc_id, 0 or 1), at most ``limit`` rows, from the rows that ``learn`` admits.

    Rows without id or label are left out; an id that comes with both labels counts as 1.
    """
    rows = (
        labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    return sorted((r["doc_id"], r["label"]) for r in rows.collect())


def labelled(docs: DataFrame, rows: list[tuple[int, int]]) -> DataFrame:
    """(doc_id, label, text) of the sampled rows; the sample is bounded, so it is broadcast."""
    own = docs.sparkSession.createDataFrame(rows or [(-1, -1)], "doc_id long, label int")
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").where("label >= 0")

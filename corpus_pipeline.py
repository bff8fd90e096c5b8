"""From raw documents to token ids: a pipeline of the operators in ``lendstrata.llm``.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and but for the
last returns the columns of documents. Between stages the rows are a Parquet table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendstrata.llm import bpe, lines, mixing, simhash, toxicity
from lendstrata.sources.sinks import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a large share of their source's documents have."""
    return lines.clean_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of fingerprints of three-word shingles that are at most three bits apart."""
    return simhash.keep_one(docs, simhash.BITS, simhash.SHINGLE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of sources below their weight more than once."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of what they decode to."""
    return bpe.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: Toxicity is learned from labels, which SQL cannot express; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

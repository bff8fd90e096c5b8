"""Histories stored by their keys, for builds that are repeated.

A bucketed table keeps each key's rows together, sorted. Aggregations by that key and joins of tables that have the same key and
number of buckets read them as they lie: the shuffle is paid for once, when they are stored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession

#: The key each history is stored by.
KEYS = {
    "bureau": "SK_ID_BUREAU",
    "bureau_balance": "SK_ID_BUREAU",
    "previous_app": "SK_ID_PREV",
    "pos_cash": "SK_ID_PREV",
    "installments": "SK_ID_PREV",
    "credit_card": "SK_ID_PREV",
}
#: Rows of the longest history that a bucket holds on average at most, and buckets that even short histories get.
BUCKET_ROWS = 250_000
LEAST_BUCKETS = 8


def bucket_count(tables: dict[str, DataFrame]) -> int:
    """Buckets for the histories of a build, as many as the longest one needs; Parquet footers tell its rows."""
    longest = max((tables[name].count() for name in KEYS if name in tables), default=0)
    return max(LEAST_BUCKETS, ceil(longest / BUCKET_ROWS))


def store_histories(tables: dict[str, DataFrame], folder: str, prefix: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """The tables, histories read from bucketed ones under ``folder`` that the session's catalog knows by ``prefix``.

    All keys are stored as long, so that they meet without a cast. ``buckets`` is the number of tasks a history is worked on by, by
    default as the rows need (``bucket_count``). Rows are dealt to their buckets first, so that each bucket is one file.
    """
    buckets = buckets or bucket_count(tables)
    out = dict(tables)
    for name, key in KEYS.items():
        if name not in tables:
            continue
        df = tables[name].withColumn(key, tables[name][key].cast("long"))
        writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{folder}/{name}").saveAsTable(f"{prefix}_{name}")
        out[name] = df.sparkSession.table(f"{prefix}_{name}")
    return out


def open_histories(spark: SparkSession, tables: dict[str, DataFrame], prefix: str) -> dict[str, DataFrame]:
    """The tables, with the histories that were stored by ``prefix`` in place of the given ones."""
    return tables | {name: spark.table(f"{prefix}_{name}") for name in KEYS if spark.catalog.tableExists(f"{prefix}_{name}")}


def drop_histories(spark: SparkSession, prefix: str) -> None:
    """Takes the names out of the catalog; the files stay with their folder."""
    for name in KEYS:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")

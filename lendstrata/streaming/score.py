"""Scoring of a stream of JSON requests: parse, default, validate, score, tier.

Every step is row by row, so the stream keeps no state and needs no watermark; the file sink with
its checkpoint writes each request once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lendstrata.operators.quality import UNREADABLE, Field, apply_defaults, raw_schema, validate_rules

Scorer = Callable[[DataFrame], DataFrame]


def read_requests(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Text lines of arriving files."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)


def parse_requests(lines: DataFrame, fields: dict[str, Field], id_column: str = "SK_ID_CURR") -> DataFrame:
    """One JSON request per line as typed, validated rows, with the line; unknown fields are ignored.

    Values are read as text and typed as in bulk requests. A line that is no request is one violation.
    """
    options = {"columnNameOfCorruptRecord": UNREADABLE}
    parsed = F.from_json("value", raw_schema(fields, id_column), options)
    rows = lines.select(F.col("value").alias("request"), parsed.alias("r")).select("request", "r.*")
    own = rows.withColumn(id_column, F.col(id_column).try_cast("long"))
    checked = validate_rules(apply_defaults(own, fields, [id_column, "request", f"`{UNREADABLE}`"]), fields)
    unreadable = F.col(UNREADABLE).isNotNull()
    return (
        checked.withColumn("violations", F.when(unreadable, F.array(F.lit(UNREADABLE))).otherwise(F.col("violations")))
        .withColumn("valid", F.col("valid") & ~unreadable)
        .drop(UNREADABLE)
    )


def score_stream(
    lines: DataFrame,
    fields: dict[str, Field],
    scorer: Scorer,
    out: str,
    id_column: str = "SK_ID_CURR",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Score what is available and stop. Rejected requests are kept with their violations and their line.

    ``scorer`` adds ``default_probability`` and ``risk_tier`` to valid request rows. The checkpoint belongs to
    the output: by default it is a folder beside it.
    """
    parsed = parse_requests(lines, fields, id_column)
    scored = scorer(parsed).select(
        id_column,
        F.when(F.col("valid"), F.col("default_probability")).alias("default_probability"),
        F.when(F.col("valid"), F.col("risk_tier")).alias("risk_tier"),
        "valid",
        "violations",
        F.when(~F.col("valid"), F.col("request")).alias("request"),
    )
    return (
        scored.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint or f"{out.rstrip('/')}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )

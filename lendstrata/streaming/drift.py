"""Drift of a stream of rows, such as scored requests: counts per feature and event window, kept exactly once.

The stream counts every feature's values per window of event time: numbers by the bins of a reference, texts by value. State is one
count per open window, feature and bin; a watermark closes windows, after which they are written and their state goes. The file sink and
the checkpoint write each window once, also when the query is stopped and started again. Windows are then compared
with the reference's counts in bulk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendstrata.functions.nulls import flag
from lendstrata.operators.drift import DISTANCE, chi2_p
from lendstrata.operators.sketches import merge_sketches, numeric_sketches

BINS = 20
WINDOW = "1 day"
WATERMARK = "1 hour"
#: Distinct texts of a feature are unbounded in a stream; beyond the reference's they share this bin.
OTHER = "other"
MISSING = "missing"


def bin_edges(reference: DataFrame, columns: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Rising inner edges of each numeric feature's bins, at evenly spaced quantiles of the reference."""
    levels = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    merged = merge_sketches(numeric_sketches(reference, columns, F.lit(0)))
    rows = merged.select("feature", F.kll_sketch_get_quantile_double("sketch", levels).alias("edges")).collect()
    found = {r["feature"]: sorted(set(r["edges"])) for r in rows}
    return {c: found.get(c, []) for c in columns}


def known_texts(reference: DataFrame, columns: list[str], most: int = 200) -> dict[str, list[str]]:
    """The ``most`` frequent texts of each text feature; of equally frequent ones the first in order."""
    out = {}
    for c in columns:
        counts = reference.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("text")).count()
        out[c] = [r["text"] for r in counts.orderBy(F.desc("count"), "text").limit(most).collect()]
    return out


def _bin(c: str, edges: list[float]) -> Column:
    """Number of the bin: how many edges lie below the value."""
    x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    below = F.size(F.filter(F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<double>"), lambda e: e < x))
    return F.when(x.isNull(), F.lit(MISSING)).otherwise(below.cast("string"))


def _text(c: str, known: list[str]) -> Column:
    return F.when(F.col(c).isNull(), F.lit(MISSING)).when(F.col(c).isin(known), F.concat(F.lit("="), F.col(c))).otherwise(F.lit(OTHER))


def binned(rows: DataFrame, edges: dict[str, list[float]], texts: dict[str, list[str]], *keep: Column) -> DataFrame:
    """Rows (keep..., feature, bin): one per row and feature, which only ever meets a count that combines in its task."""
    parts = [F.struct(F.lit(c).alias("feature"), _bin(c, e).alias("bin")) for c, e in edges.items()]
    parts += [F.struct(F.lit(c).alias("feature"), _text(c, known).alias("bin")) for c, known in texts.items()]
    return rows.select(*keep, F.inline(F.array(*parts)))


def window_counts(
    rows: DataFrame, time: str, edges: dict[str, list[float]], texts: dict[str, list[str]], window: str = WINDOW, watermark: str = WATERMARK
) -> DataFrame:
    """(window_start, window_end, feature, bin, n) of a stream or a table; in a stream, rows later than the watermark are left out."""
    if isinstance(rows.schema[time].dataType, T.TimestampNTZType):  # taken as UTC, whatever the session's zone
        rows = rows.withColumn(time, F.concat(F.col(time).cast("string"), F.lit("Z")).cast("timestamp"))
    watched = rows.withWatermark(time, watermark) if rows.isStreaming else rows
    long = binned(watched, edges, texts, F.col(time))
    counts = long.groupBy(F.window(time, window).alias("w"), "feature", "bin").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "feature", "bin", "n")


def count_stream(counts: DataFrame, out: str, checkpoint: str | None = None) -> StreamingQuery:
    """Writes the closed windows that are available and stops. Started again with the same output, it goes on where it was."""
    return (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint or f"{out.rstrip('/')}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def reference_counts(reference: DataFrame, edges: dict[str, list[float]], texts: dict[str, list[str]]) -> DataFrame:
    """(feature, bin, n) of the reference."""
    return binned(reference, edges, texts).groupBy("feature", "bin").agg(F.count("*").alias("n"))


def window_drift(counts: DataFrame, reference: DataFrame, threshold: float = DISTANCE) -> DataFrame:
    """Per window and feature: rows, chi-square against the scaled reference and its p, Jensen-Shannon distance, drifted.

    A bin that the reference doesn't have makes the chi-square infinite.
    """
    sizes = reference.groupBy("feature").agg(F.sum("n").alias("n_ref"))
    windows = counts.groupBy("window_start", "feature").agg(F.sum("n").alias("n_cur"))
    # A row per window, feature and bin; the reference has a row per feature and bin.
    expected = windows.join(reference.select("feature", "bin", F.col("n").alias("ref")), "feature")
    cells = (
        expected.drop("n_cur")
        .join(counts.select("window_start", "feature", "bin", F.col("n").alias("cur")), ["window_start", "feature", "bin"], "full")
        .join(windows, ["window_start", "feature"])
        .join(sizes, "feature", "left")
        .fillna(0, ["ref", "cur", "n_ref"])
    )
    p, q = F.try_divide("ref", "n_ref"), F.try_divide("cur", "n_cur")
    want = F.col("ref") * F.try_divide("n_cur", "n_ref")

    def divergence(a: Column) -> Column:
        return F.when(a > 0, a * F.ln(F.nullif(2 * a / (p + q), F.lit(0.0)))).otherwise(0.0)

    found = cells.groupBy("window_start", "feature", "n_ref", "n_cur").agg(
        F.count("*").alias("bins"),
        F.when(F.max((F.col("ref") == 0) & (F.col("cur") > 0)), F.lit(float("inf")))
        .otherwise(F.sum(F.when(want > 0, (F.col("cur") - want) * (F.col("cur") - want) / want)))
        .alias("chi_square"),
        F.when(F.col("n_ref") > 0, F.sqrt(F.greatest(F.lit(0.0), F.sum(divergence(p) + divergence(q)) / 2))).alias("jensen_shannon"),
    )
    return found.select(
        "window_start", "feature", "n_ref", "n_cur", "chi_square", chi2_p(F.col("chi_square"), F.col("bins") - 1).alias("chi_square_p"), "jensen_shannon",
        flag((F.col("n_ref") == 0) | (F.col("jensen_shannon") >= threshold)).alias("drifted"),
    )

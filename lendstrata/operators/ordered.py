"""Order-dependent work that stays distributed: lag per key, prefix sums, exact quantiles.

A window over one key or over a whole table runs in one task. Here the rows of hot keys, and tables of values, are
dealt to ranges of their order, as many as the counted rows need; only the summaries of the ranges are chained.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendstrata.sources.sinks import materialize

BROADCAST_BYTES = 10_000_000
HOT_ROWS = 1_000_000
#: Places that keys are hashed to before hot ones are counted, at least, and for each key that may be hot.
HOT_PLACES = 65_536
PLACES_EACH = 64


@dataclass
class Lookup:
    """A table to join with, stored once; ``small`` says that its measured size is in the bound."""

    table: DataFrame
    small: bool
    rows: int

    def side(self, part: DataFrame | None = None) -> DataFrame:
        """The join side: broadcast if small, else shuffled, where adaptive execution splits hot keys."""
        part = self.table if part is None else part
        return F.broadcast(part) if self.small else part


def lookup(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> Lookup:
    """Stored and measured: the bytes of its rows as text stand for its size in memory."""
    stored = materialize(df, "lookup")
    size = F.sum(F.octet_length(F.to_json(F.struct(*stored.columns))))
    rows, total = stored.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return Lookup(stored, total <= max_bytes, rows)


def hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS) -> Lookup:
    """Rows (key, hot_rows) of the keys with more than ``rows`` rows, by an exact count.

    A table of no more than ``rows`` rows has none, which the row counts in Parquet footers tell. Else rows are counted by a hash
    of the key, a small table in each task; only keys in places with more than ``rows`` rows are counted by themselves. Both counts combine
    on the map side; a table of n rows has fewer than n / ``rows`` such keys. The missing key may be one of them.
    """
    none = Lookup(df.select(key).limit(0).withColumn("hot_rows", F.lit(0).cast("long")), True, 0)
    total = df.count()
    if total <= rows:
        return none
    place = F.pmod(F.xxhash64(key), F.lit(max(HOT_PLACES, PLACES_EACH * ceil(total / max(1, rows))))).alias("_place")
    full = lookup(df.select(place).groupBy("_place").agg(F.count("*").alias("n")).where(F.col("n") > rows).select("_place"))
    if not full.rows:
        return none
    counts = df.select(key, place).join(full.side(), "_place", "left_semi").groupBy(key).agg(F.count("*").alias("hot_rows"))
    return lookup(counts.where(F.col("hot_rows") > rows))


def in_ranges(df: DataFrame, parts: int, order: list[str], name: str) -> DataFrame:
    """The rows dealt to ``parts`` ranges of the order, stored with the number of their range as ``_part``.

    Ranges come from a sample that Spark takes; what is stored doesn't move any more, so later steps may rely on it.
    """
    return materialize(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)


def lag_within(
    df: DataFrame, key: str, order: list[str], value: str, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Previous value per key in the given total order; missing for rows without a key.

    Normally one window. The rows of keys beyond ``hot_rows``, and only they, are dealt to ranges of (key, order) of about that many;
    the first row of a range takes the last value of its key in the range before. The result does not depend on where
    ranges end. Rows without a key are not moved.
    """
    before = F.lag(value).over(Window.partitionBy(key).orderBy(*order))
    hot = hot_keys(df, key, hot_rows)
    if not hot.rows:
        return df.withColumn(out, F.when(F.col(key).isNotNull(), before))

    keyed, keyless = df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
    known = hot.table.where(F.col(key).isNotNull())
    rows = known.agg(F.sum("hot_rows")).first()[0] or 0
    keys = hot.side(known.select(key))
    cold = keyed.join(keys, key, "left_anti").withColumn(out, before)
    warm = _lag_in_ranges(keyed.join(keys, key, "left_semi"), key, order, value, out, max(1, ceil(rows / hot_rows)))
    missing = keyless.withColumn(out, F.lit(None).cast(df.schema[value].dataType))
    return cold.select(*df.columns, out).unionByName(warm).unionByName(missing)


def _lag_in_ranges(rows: DataFrame, key: str, order: list[str], value: str, out: str, parts: int) -> DataFrame:
    placed = in_ranges(rows, parts, [key, *order], "hot-rows")
    in_part = Window.partitionBy(key, "_part").orderBy(*order)
    # A row per hot key and range, from which the ranges' last values are chained.
    tails = (
        placed.groupBy(key, "_part")
        .agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_tail"))
        .withColumn("_before", F.lag("_tail").over(Window.partitionBy(key).orderBy("_part"))["v"])
        .select(key, "_part", "_before")
    )
    lagged = placed.select("*", F.lag(value).over(in_part).alias("_lag"), F.row_number().over(in_part).alias("_rank"))
    return lagged.join(lookup(tails).side(), [key, "_part"]).select(
        *rows.columns, F.when(F.col("_rank") == 1, F.col("_before")).otherwise(F.col("_lag")).alias(out)
    )


# ---- prefix sums ----------------------------------------------------------

BUCKET_ROWS = 1_000_000


def running(
    by_value: DataFrame,
    group: list[str],
    value: str,
    measures: list[str],
    bucket_rows: int = BUCKET_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``<measure>_before``, the sum over smaller values of the group, and ``next_value``.

    ``by_value`` has one row per group and value, so a value that fills the table is one row. Two passes: rows are dealt to ranges of
    (group, value) of about ``bucket_rows`` and stored; totals per range then give each range what lies before it. One range is a
    window per group.
    """
    stored = materialize(by_value, "by-value")
    buckets = buckets or max(1, ceil(stored.count() / bucket_rows))
    if buckets == 1:
        return _running_in(stored, group, value, measures)

    placed = in_ranges(stored, buckets, [*group, value], "by-range")
    # At most a row per range and one more per group from here on.
    totals = placed.groupBy(*group, "_part").agg(*[F.sum(m).alias(m) for m in measures], F.min(value).alias("_first"))
    by_part = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part")
    offsets = totals.select(
        *group,
        "_part",
        *[_before(m, by_part).alias(f"_{m}_offset") for m in measures],
        F.lead("_first").over(by_part).alias("_next_first"),
    )
    local = _running_in(placed, [*group, "_part"], value, measures)
    return local.join(lookup(offsets).side(), [*group, "_part"]).select(
        *by_value.columns,
        *[(F.col(f"{m}_before") + F.col(f"_{m}_offset")).alias(f"{m}_before") for m in measures],
        F.coalesce("next_value", "_next_first").alias("next_value"),
    )


def _before(measure: str, window) -> Column:
    return F.coalesce(F.sum(measure).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _running_in(df: DataFrame, group: list[str], value: str, measures: list[str]) -> DataFrame:
    window = Window.partitionBy(*(group or [F.lit(0)])).orderBy(value)
    return df.select(
        "*",
        *[_before(m, window).alias(f"{m}_before") for m in measures],
        F.lead(value).over(window).alias("next_value"),
    )


def value_counts(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Counts per (feature, value) of numeric columns, all in one pass; missing values left out."""
    keep = keep or []
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(keep, columns, "feature", "value").where(F.col("value").isNotNull())
    return long.groupBy(*keep, "feature", "value").agg(F.count("*").alias("n"))


def quantiles(df: DataFrame, columns: list[str], q: float, **options) -> DataFrame:
    """Exact quantile with linear interpolation per column, as rows (feature, quantile)."""
    ranked = running(value_counts(df, columns), ["feature"], "value", ["n"], **options)
    # one row per column name
    sizes = ranked.groupBy("feature").agg(F.sum("n").alias("rows"))
    at = F.lit(q) * (F.col("rows") - 1)

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n")), F.col("value")))

    return (
        ranked.join(F.broadcast(sizes), "feature")
        .groupBy("feature", "rows")
        .agg(value_at(F.floor(at)).alias("low"), value_at(F.ceil(at)).alias("high"))
        .select("feature", (F.col("low") + (F.col("high") - F.col("low")) * (at - F.floor(at))).alias("quantile"))
    )

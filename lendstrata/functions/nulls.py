"""Null-correct column expressions.

Every helper returns a plain ``Column`` built from Spark functions, so it stays
inside whole-stage code generation and is usable in ``select`` and in ``agg``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_low(c: Column | str, low: float) -> Column:
    """Raise small values to ``low``; a missing value stays missing (``greatest`` would hide it)."""
    c = col(c)
    return F.when(c < low, F.lit(low)).otherwise(c)


def clip_high(c: Column | str, high: float) -> Column:
    c = col(c)
    return F.when(c > high, F.lit(high)).otherwise(c)


def ratio(a: Column | str, b: Column | str, low: float = 1) -> Column:
    """``a / max(b, low)``; safe under ANSI mode because the divisor is never zero."""
    return col(a) / clip_low(b, low)


def flag(pred: Column) -> Column:
    """0/1 flag where a comparison with a missing value counts as 0."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def sentinel_to_null(c: Column | str, *sentinels) -> Column:
    c = col(c)
    return reduce(lambda acc, s: F.nullif(acc, F.lit(s)), sentinels, c)


def sentinel_flag(c: Column | str, *sentinels) -> Column:
    """1 where the cleaned value is missing, either by sentinel or from the start."""
    return sentinel_to_null(c, *sentinels).isNull().cast("int")


def map_codes(c: Column | str, mapping: dict) -> Column:
    """Code to number; codes that are not listed, or mapped to None, become missing."""
    c = col(c)
    chain = None
    for code, number in mapping.items():
        if number is None:
            continue
        chain = F.when(c == code, F.lit(number)) if chain is None else chain.when(c == code, F.lit(number))
    return chain if chain is not None else F.lit(None).cast("int")


def days_to_years(c: Column | str) -> Column:
    return -col(c) / 365


def row_mean(*cols: Column | str) -> Column:
    """Mean of the present values of a row; missing only if all are missing."""
    cols = [col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return F.when(present > 0, total / present)


def row_min(*cols: Column | str) -> Column:
    cols = [col(c) for c in cols]
    return F.least(*cols) if len(cols) > 1 else cols[0]


def row_product(*cols: Column | str) -> Column:
    return reduce(lambda a, b: a * b, [col(c) for c in cols])


def row_sum(*cols: Column | str) -> Column:
    """Sum of the present values of a row; 0 if there is none."""
    if not cols:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in cols])


# ---- aggregates -----------------------------------------------------------


def sum0(c: Column | str) -> Column:
    """Sum that is 0, not missing, for a group without present values."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def any_flag(pred: Column) -> Column:
    """1 if the predicate held on at least one row of the group, else 0."""
    return F.coalesce(F.bool_or(pred), F.lit(False)).cast("int")


def only(pred: Column, c: Column | str) -> Column:
    """The value on rows of a subset, missing elsewhere: feeds mean/min/max of the subset."""
    return F.when(pred, col(c))


def of_subset(pred: Column, aggregate: Column) -> Column:
    """Keep an aggregate only for groups with a row in the subset.

    Gives what joining a filtered aggregate back would give, without the second scan and join.
    """
    return F.when(F.count_if(pred) > 0, aggregate)


def subset_sum(pred: Column, c: Column | str) -> Column:
    return of_subset(pred, sum0(only(pred, c)))


def subset_count(pred: Column, cond: Column) -> Column:
    return of_subset(pred, F.count_if(pred & cond))


def nulls_last(c: Column | str, filler=0) -> list[Column]:
    """Two order columns that place missing values after all others."""
    c = col(c)
    return [c.isNull(), F.coalesce(c, F.lit(filler))]


def last_present(c: Column | str, order: Column) -> Column:
    """Last non-missing value of a column in the given order (``max_by`` skips a missing order)."""
    c = col(c)
    return F.max_by(c, F.when(c.isNotNull(), order))


def first_present(c: Column | str, order: Column) -> Column:
    c = col(c)
    return F.min_by(c, F.when(c.isNotNull(), order))

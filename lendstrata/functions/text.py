"""Column names and number texts."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9]+", "_", name).strip("_")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename to letters, digits and single underscores; two columns may not end up with one name."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after cleaning: {clashes}")
    return df.toDF(*names)


def add_prefix(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Prefix all columns but the kept ones; a name that already has the prefix is left as it is."""
    keep = set(keep)
    return df.toDF(*[c if c in keep or c.startswith(prefix) else prefix + c for c in df.columns])


def decimal_text(c: Column, digits: int) -> Column:
    """Shortest plain decimal text of a rounded number: 0.3, 12.0, 0.0001."""
    text = F.rtrim(F.round(c, digits).cast(f"decimal(38,{digits})").cast("string"), F.lit("0"))
    return F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text)

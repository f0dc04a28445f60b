"""NULL handling: counts per column in one pass, fills, drops, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """One row: NULL count per column, computed in a single aggregate."""
    return df.select([F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


def first_non_null(*cols, default=None) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)

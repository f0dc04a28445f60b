"""Row filters and column masks keyed by entitlement tables, a dynamic
view per group, and cascaded deletion of personal data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions.columns import mask


def row_filter(df: DataFrame, entitlements: DataFrame, group: str, on: str) -> DataFrame:
    """Rows whose ``on`` value the group is entitled to (semi join)."""
    allowed = entitlements.filter(F.col("group") == group).select(F.col("value").alias("_allowed"))
    return df.join(allowed, F.col(on) == F.col("_allowed"), "left_semi")


def masked(df: DataFrame, columns: Sequence[str], visible: int = 4) -> DataFrame:
    return df.withColumns({c: mask(c, visible) for c in columns})


def dynamic_view(df: DataFrame, entitlements: DataFrame, groups: DataFrame, on: str,
                 masked_columns: Sequence[str]) -> DataFrame:
    """Rows each group may see, one output row per (group, row); groups
    flagged ``unmasked`` see clear text. ``entitlements`` has (group,
    value); ``groups`` has (group, unmasked)."""
    ent = entitlements.join(groups, "group")
    v = df.join(ent, F.col(on) == F.col("value")).drop("value")
    return v.withColumns({c: F.when(F.col("unmasked"), F.col(c)).otherwise(mask(c)) for c in masked_columns}).drop(
        "unmasked")


def erase(tables: dict[str, DataFrame], erase_keys: DataFrame, chain: Sequence[tuple[str, str, str, str]]) -> dict[str, DataFrame]:
    """Remove erased keys and everything that hangs off them.

    ``chain``: ``(table, key, parent_table, parent_key)`` from the root
    down; the root entry has ``parent_table`` None and is matched against
    ``erase_keys`` (one column ``key``). Each step is an anti join against
    the removed parent keys, so children of removed rows go too.
    """
    out = dict(tables)
    removed: dict[str, DataFrame] = {}
    for table, key, parent, parent_key in chain:
        df = tables[table]
        gone = (erase_keys if parent is None else removed[parent]).select(F.col(
            "key" if parent is None else parent_key).alias("_gone"))
        hit = df.join(gone, F.col(key) == F.col("_gone"), "left_semi")
        out[table] = df.join(gone, F.col(key) == F.col("_gone"), "left_anti")
        removed[table] = hit
    return out

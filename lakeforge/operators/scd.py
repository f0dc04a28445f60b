"""Change data: apply a change feed as SCD type 1 or type 2, SCD2 upserts
on a dimension, and the row-level change feed between two snapshots.

All steps are joins, aggregates and windows keyed by the business key; the
per-key window only sees that key's changes (not the dimension), and the
latest-row pick is an aggregate with a map-side step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.operators.relational import latest_per_key
from lakeforge.operators.windows import skew_safe_window


def apply_scd1(changes: DataFrame, keys: Sequence[str], sequence: str, op: str = "op",
               delete_value: str = "delete") -> DataFrame:
    """Latest change per key by sequence number (order of arrival does not
    matter); keys whose latest change is a delete disappear."""
    latest = latest_per_key(changes, keys, [sequence], columns=changes.columns)
    return latest.filter(F.col(op) != delete_value).drop(op)


def apply_scd2(changes: DataFrame, keys: Sequence[str], sequence: str, op: str = "op",
               delete_value: str = "delete", segment_width: int | None = None) -> DataFrame:
    """One row per version: ``valid_from`` = its sequence, ``valid_to`` = the
    next change's sequence (NULL while current); deletes close the last
    version and add none.

    A key of one column with very many changes is cut into segments by
    sampled sequences (``operators.windows``), or into ranges of
    ``segment_width`` of a numeric sequence; keys of several columns use the
    plain window."""
    if len(keys) == 1:
        seg = None if segment_width is None else F.floor(F.col(sequence) / F.lit(segment_width))
        versions = skew_safe_window(changes, keys, [sequence], seg, {"valid_to": ("lead", sequence)})
    else:
        w = Window.partitionBy(*keys).orderBy(sequence)
        versions = changes.withColumn("valid_to", F.lead(sequence).over(w))
    return (versions.filter(F.col(op) != delete_value)
            .withColumn("valid_from", F.col(sequence))
            .withColumn("is_current", F.col("valid_to").isNull())
            .drop(op, sequence))


def scd2_upsert(dim: DataFrame, updates: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                effective: str) -> DataFrame:
    """Type-2 merge of ``updates`` (one row per key, with an ``effective``
    value) into ``dim`` (``valid_from``, ``valid_to``, ``is_current``).

    Current rows whose tracked columns changed are closed at ``effective``
    and a new current version is added; new keys get a first version;
    history rows pass through. One join of the updates with the current
    rows, then a union.
    """
    cur = dim.filter("is_current")
    hist = dim.filter("NOT is_current")
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in tracked], F.col(effective).alias("_eff"))
    j = cur.join(u, list(keys), "full")
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_u_{c}"))
    in_dim, in_upd = F.col("valid_from").isNotNull(), F.col("_eff").isNotNull()
    j = j.withColumn("_state", F.when(in_dim & in_upd & changed, "changed").when(in_dim, "same").otherwise("new"))
    dim_cols = dim.columns
    kept = j.filter("_state = 'same'").select(*dim_cols)
    closed = (j.filter("_state = 'changed'").withColumn("valid_to", F.col("_eff"))
              .withColumn("is_current", F.lit(False)).select(*dim_cols))
    fresh = j.filter("_state IN ('changed', 'new')")
    for c in tracked:
        fresh = fresh.withColumn(c, F.col(f"_u_{c}"))
    fresh = (fresh.withColumn("valid_from", F.col("_eff")).withColumn("valid_to", F.lit(None).cast(dim.schema["valid_to"].dataType))
             .withColumn("is_current", F.lit(True)).select(*dim_cols))
    return hist.unionByName(kept).unionByName(closed).unionByName(fresh)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level changes between two snapshots: insert, delete,
    update_preimage and update_postimage rows (unchanged rows omitted)."""
    cols = [c for c in before.columns if c not in keys]
    b = before.select(*keys, F.struct(*cols).alias("_b"))
    a = after.select(*keys, F.struct(*cols).alias("_a"))
    j = b.join(a, list(keys), "full")
    kind = (F.when(F.col("_b").isNull(), F.array(F.lit("insert")))
            .when(F.col("_a").isNull(), F.array(F.lit("delete")))
            .when(~F.col("_a").eqNullSafe(F.col("_b")), F.array(F.lit("update_preimage"), F.lit("update_postimage"))))
    j = j.filter(kind.isNotNull()).select(*keys, "_a", "_b", F.explode(kind).alias("_change_type"))
    image = F.when(F.col("_change_type").isin("insert", "update_postimage"), F.col("_a")).otherwise(F.col("_b"))
    return j.select(*keys, *[image[c].alias(c) for c in cols], "_change_type")

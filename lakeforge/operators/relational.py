"""Relational building blocks: joins with bounded broadcasts, top-N and
latest-record per key, de-duplication, foreign-key subsets, rollups.

Scale notes
- Aggregations are written as one ``agg`` so Spark runs partial (map-side)
  then final aggregation: a hot key is combined before the shuffle.
- ``broadcast`` is hinted only for dimensions whose size is fixed by the
  data model (``BOUNDED_DIMENSIONS``); everything else is left to the
  planner, whose adaptive execution broadcasts a side only after measuring
  it at runtime and otherwise keeps the sort-merge join.
- Top-N per group uses a rank window plus filter, which Catalyst turns into
  a partial ``WindowGroupLimit`` before the shuffle, so at most N rows (plus
  ties) per group and input partition cross the network.
- Latest-record per key is an aggregate of a struct (partial + final),
  not a window, so a key holding a third of all rows never lands whole in
  one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.sources.tables import BOUNDED_DIMENSIONS

RANKERS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def dimension(df: DataFrame, name: str) -> DataFrame:
    """Hint a broadcast only for a dimension with a model-fixed row bound."""
    return F.broadcast(df) if name in BOUNDED_DIMENSIONS else df


def top_n_per_group(df: DataFrame, partition_by, order_by, n: int,
                    ties: str = "dense_rank", rank_col: str = "rank") -> DataFrame:
    """Keep the top ``n`` rows per group.

    ``ties``: 'row_number' (exactly n, give a unique tie-break in order_by),
    'rank' or 'dense_rank' (may return more than n rows on ties).
    """
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*_cols(order_by))
    return df.withColumn(rank_col, RANKERS[ties]().over(w)).filter(F.col(rank_col) <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    Give ``order`` ending in a unique column for a deterministic result.
    Implemented as ``max(struct(order..., payload...))`` per key: an
    aggregate with a partial step, so skewed keys are combined map-side.
    """
    columns = list(columns or [c for c in df.columns if c not in keys])
    payload = [c for c in columns if c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns if c not in keys])


def latest_per_key_window(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """Window form of latest-per-key (``row_number`` = 1), as in SQL QUALIFY."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_desc])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Deterministic de-duplication: keep the greatest ``order`` row per key."""
    return latest_per_key(df, keys, order, columns=df.columns)


def fk_subset(root: DataFrame, key: str, modulo: int) -> DataFrame:
    """Keep root rows with ``key % modulo = 0`` (the sampling rule)."""
    return root.filter(F.col(key) % modulo == 0)


def _keys_of(parent: DataFrame, parent_key: str) -> DataFrame:
    # Distinct keys: the de-duplication runs map-side before the shuffle, so
    # a key repeated a billion times on the right crosses the network once
    # per map task, not once per row.
    return parent.select(F.col(parent_key).alias("_fk")).distinct()


def semi(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is among the parent's keys (EXISTS; no row growth)."""
    return child.join(_keys_of(parent, parent_key), F.col(child_key) == F.col("_fk"), "left_semi")


def anti(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is not among the parent's keys (NOT EXISTS)."""
    return child.join(_keys_of(parent, parent_key), F.col(child_key) == F.col("_fk"), "left_anti")


def row_count_report(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; a single job of unioned counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table"), "row_count")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rollup_counts(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Hierarchical subtotals with ``grouping_id`` so subtotal NULLs are
    told apart from NULL data."""
    return df.rollup(*keys).agg(*aggs, F.grouping_id().alias("grouping_id"))


def cube_counts(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return df.cube(*keys).agg(*aggs, F.grouping_id().alias("grouping_id"))

"""Cut points that split a hot key's ordered rows into even segments.

A segment by date or id range follows the values, so a key's segments can be
far more than its rows need. Here they follow the rows: of each hot key about
``SAMPLE`` rows a segment are picked by a hash of key and order (a retried
task picks the same ones), put in order, and every ``SAMPLE``-th is a cut. A
key of n rows gets about n / ``rows_per_segment`` cuts, so all keys together
have no more than that share of the table's rows: the list is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled rows for each segment: sizes vary by about a tenth.
SAMPLE = 100
#: Rows that one task should sort at once.
ROWS_PER_SEGMENT = 1_000_000
#: Cuts in a group; a row is placed by its group first, then within it.
GROUP = 256


def order_cuts(df: DataFrame, key: str, order: list[str], hot: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """``(_hot, _cuts)``: for each key of ``hot`` (with its number of rows as
    ``_rows``) the ordered cut values in groups of ``GROUP``."""
    wanted = hot.select(F.col(key).alias("_hot"), F.ceil(F.col("_rows") / F.lit(rows_per_segment)).alias("_segs"), "_rows")
    place = F.pmod(F.xxhash64(key, *order), F.lit(1 << 40)) / F.lit(float(1 << 40))
    near = df.select(key, *order).join(F.broadcast(wanted), F.col(key).eqNullSafe(F.col("_hot")))
    picked = near.where((F.col("_segs") > 1) & (place < F.lit(float(SAMPLE)) * F.col("_segs") / F.col("_rows")))
    at = F.row_number().over(Window.partitionBy("_hot").orderBy(*order))
    cuts = picked.select("_hot", F.struct(*order).alias("_cut"), at.alias("_at")).where(F.col("_at") % SAMPLE == 0)
    grouped = cuts.groupBy("_hot", F.floor((F.col("_at") / SAMPLE - 1) / GROUP).alias("_group")).agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
    found = grouped.groupBy("_hot").agg(F.sort_array(F.collect_list("_cuts")).alias("_cuts"))
    return wanted.select("_hot").join(found.withColumnRenamed("_hot", "_cut_key"), F.col("_hot").eqNullSafe(F.col("_cut_key")), "left").drop("_cut_key")


def segment_of(order: list[str], cuts: str = "_cuts") -> Column:
    """How many of the key's cuts are not above the row: its segment."""
    row = F.struct(*order)
    group = F.size(F.filter(cuts, lambda g: g[0] <= row)) - 1
    inside = F.size(F.filter(F.get(F.col(cuts), group), lambda c: c <= row))
    return F.when(F.col(cuts).isNull() | (group < 0), F.lit(0)).otherwise(group * GROUP + inside)

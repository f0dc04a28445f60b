"""Connected components of a link table, by alternating star contraction.

Links are kept as (larger node, smaller node). The large step hangs every
node that a node is smaller than below that node's smallest neighbour, the
small step hangs all smaller neighbours of a node below the smallest of them.
The table never gets longer, and after a number of rounds logarithmic in the
nodes every node hangs directly below the smallest of its component.

Each half step is one aggregate and one join. The aggregate is written
before it is joined, so both join inputs are plain shuffles and adaptive
execution can split the rows of a node that very many others hang below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import drop, keep


def _relinked(links: DataFrame, side: str) -> DataFrame:
    """``side`` 'lo': (hi, smallest neighbour of lo); 'hi': (lo, smallest neighbour of hi)."""
    spark = links.sparkSession
    least, path = keep(links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("least")), "least")
    if side == "lo":
        moved = (links.join(least, F.col("lo") == F.col("node"), "left")
                 .select("hi", F.coalesce("least", "lo").alias("lo")))
    else:
        moved = (links.join(least, F.col("hi") == F.col("node"))
                 .select(F.when(F.col("lo") == F.col("least"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("least").alias("lo")))
    # the small step leaves equal links once; in between they do no harm
    out, new = keep(moved.distinct() if side == "hi" else moved, "links")
    drop(spark, path)
    return out, new


def _print_of(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.hash("hi", "lo").cast("bigint"))).first()


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` of every node of ``pairs``, root the smallest node of
    its component. Pairs may repeat, come in either order or link a node to
    itself; rows with a null are ignored."""
    spark = pairs.sparkSession
    links, path = keep(pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    seen = _print_of(links)
    while seen[0]:
        half, half_path = _relinked(links, "lo")
        links2, path2 = _relinked(half, "hi")
        drop(spark, half_path)
        drop(spark, path)
        links, path, now = links2, path2, _print_of(links2)
        if tuple(now) == tuple(seen):
            break
        seen = now
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())

"""Arrays, structs and maps.

``nest`` is the inverse of explode with a bound: rows of one group are
packed into arrays of about ``max_items`` structs, so no single array (or
task) has to hold a hot group whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(c: str | Column, sep: str = " ") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.split(col, sep)


def word_counts(df: DataFrame, text_col: str, sep: str = " ") -> DataFrame:
    """Exploded words counted; the count aggregate combines map-side."""
    return df.select(F.explode(words(text_col, sep)).alias("word")).groupBy("word").count()


#: Numbers that one exploded array holds.
_BLOCK = 4096


def _numbers(df: DataFrame, count: Column, name: str) -> DataFrame:
    """One row for each number from 0 to ``count`` - 1, in two steps so that
    no row carries an array that grows with the count."""
    blocks = df.withColumn("_n", count).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / _BLOCK).cast("bigint"))))
    first = F.col("_b") * _BLOCK
    return blocks.withColumn(name, F.explode(F.sequence(first, F.least(F.col("_n"), first + _BLOCK) - 1))).drop("_n", "_b")


def nest(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str,
         max_items: int = 100_000) -> DataFrame:
    """Each group's rows as ``array<struct<cols>>`` in numbered chunks of
    about ``max_items``: always one row per (keys..., chunk), chunk 0 alone
    for a group of up to ``max_items`` rows. NULL keys form a group.

    Equal rows are counted first. A row that occurs very often is split into
    pieces of at most ``max_items`` / 16, which are spread over the group's
    chunks by a hash of the row and the piece's number (a retried task finds
    the same chunk); its copies are written out only inside a chunk. Group
    sizes come from a partial aggregate and are joined back NULL-safely."""
    piece = max(1, max_items // 16)
    group = {f"_g{i}": F.col(k) for i, k in enumerate(keys)}
    counted = df.groupBy(*[c.alias(n) for n, c in group.items()], F.struct(*cols).alias("_item")).agg(F.count(F.lit(1)).alias("_times"))
    sizes = df.groupBy(*[c.alias("s" + n) for n, c in group.items()]).agg(F.ceil(F.count(F.lit(1)) / F.lit(max_items)).cast("bigint").alias("_chunks"))
    same = [F.col(n).eqNullSafe(F.col("s" + n)) for n in group]
    pieces = _numbers(counted.join(sizes, same), F.ceil(F.col("_times") / F.lit(piece)).cast("bigint"), "_nth")
    copies = F.least(F.lit(piece).cast("bigint"), F.col("_times") - F.col("_nth") * piece).cast("int")
    chunk = F.pmod(F.xxhash64("_item", "_nth"), F.col("_chunks")).alias("chunk")
    packed = pieces.groupBy(*group, chunk).agg(F.collect_list(F.struct("_item", copies.alias("_copies"))).alias("_pieces"))
    items = F.flatten(F.transform("_pieces", lambda p: F.array_repeat(p["_item"], p["_copies"])))
    return packed.select(*[F.col(n).alias(k) for n, k in zip(group, keys)], "chunk", items.alias(name))


def unnest(nested: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Explode the arrays back to one row per struct (``inline``)."""
    return nested.select(*keys, F.inline(name))


def map_entries(df: DataFrame, id_col: str, json_col: str, value_type: str = "int") -> DataFrame:
    """Parse a JSON object column as a map and explode it to key/value rows."""
    m = F.from_json(F.col(json_col), f"map<string,{value_type}>")
    return df.select(id_col, F.explode(m).alias("key", "value"))

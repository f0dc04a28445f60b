"""Exact de-duplication with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z. Every text
gets a SHA-256 digest; the rest works on digests only:

1. Each task keeps a Misra-Gries summary of its digests. The summaries'
   counts add up to a lower bound that is too small by at most
   rows / (counters + 1), so every digest on more than rows / ``share`` rows
   is among at most ``2 * share`` candidates, however large the table is.
2. The candidates are counted exactly (partial aggregation, one row per
   candidate and task crosses the network). Those that really are frequent
   are the winners; they are broadcast, at most ``share`` rows.
3. Rows of a winner's digest are settled map-side. All other digests go
   through ordinary shuffles: an aggregate finds those on several rows, whose
   winner and number are joined back. No group of rows has to meet in a task:
   the aggregate combines map-side, and the join's partitions may be split.

Defined results: a null text counts as the empty text. The row with the
largest id stays; a null id counts as the smallest. Of rows that repeat both
id and text exactly one stays. An empty table gives an empty result. Other
columns, whatever their names, do not matter and are passed through.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import fresh, quoted, save, utf8

#: A digest on more than one in so many rows is settled map-side.
SHARE = 1024


def _digest_batches(batches):
    for b in batches:
        texts = b.column(b.num_columns - 1)
        out = [hashlib.sha256(t.lower()).digest() for t in texts.to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.binary())], [*b.schema.names[:-1], "digest"])


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, digest)`` of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("digest", T.BinaryType())])
    return docs.select(quoted(id_col).alias("id"), utf8(f"`{text_col}`").alias("digest")).mapInArrow(_digest_batches, schema)


def _misra_gries(counters: int):
    def run(batches):
        kept: Counter = Counter()
        for b in batches:
            kept.update(b.column(0).to_pylist())
            if len(kept) > counters:
                least = int(-np.partition(-np.fromiter(kept.values(), np.int64, len(kept)), counters)[counters])
                kept = Counter({k: v - least for k, v in kept.items() if v > least})
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())], ["digest", "seen"])
    return run


def candidates(table: DataFrame, share: int = SHARE) -> tuple[DataFrame, int]:
    """Digests that may be on more than 1 / ``share`` of the rows (at most
    2 * ``share`` of them), and the number of rows."""
    rows = table.count()
    sketch = table.select("digest").mapInArrow(_misra_gries(2 * share), "digest binary, seen bigint")
    return sketch.groupBy("digest").agg(F.sum("seen").alias("seen")).where(F.col("seen") * 2 * share >= rows).select("digest"), rows


def heavy_hitters(table: DataFrame, share: int = SHARE) -> DataFrame:
    """The digests on more than one row and more than 1 / ``share`` of them,
    with the row that stays and the rows' number: fewer than ``share`` rows."""
    maybe, rows = candidates(table, share)
    return (table.join(F.broadcast(maybe), "digest")
            .groupBy("digest").agg(F.max(F.struct("id", "row_no")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
            .where((F.col("group_size") > 1) & (F.col("group_size") * share > rows)))


@dataclass
class Decisions:
    """``rows``: id, row_no, digest, keep (struct id, row_no), group_size of
    every row. ``heavy``: the winners' part of it, one row per digest."""
    rows: DataFrame
    heavy: DataFrame


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> Decisions:
    table = save(digests(docs, id_col, text_col).withColumn("row_no", F.monotonically_increasing_id()), "digests")
    heavy = save(heavy_hitters(table, share), "heavy")
    marked = table.join(F.broadcast(heavy), "digest", "left")
    light = marked.where(F.col("keep").isNull()).select("id", "row_no", "digest")
    groups = light.groupBy("digest").agg(F.max(F.struct("id", "row_no")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    repeated = save(groups.where(F.col("group_size") > 1), "repeated")
    light = light.join(repeated, "digest", "left").withColumns(
        {"keep": F.coalesce("keep", F.struct("id", "row_no")), "group_size": F.coalesce("group_size", F.lit(1).cast("bigint"))})
    return Decisions(marked.where(F.col("keep").isNotNull()).unionByName(light), heavy)


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256."""
    return decide(docs, id_col, text_col, share).rows.select(
        F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("keep.row_no")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def row_key(digest, row_id):
    """Digest and id in one value that is never null."""
    return F.concat(digest, F.when(row_id.isNull(), F.lit(b"-")).otherwise(F.concat(F.lit(b"="), row_id.cast("string").cast("binary"))))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """The rows that stay, with the columns of ``docs``.

    Copies of heavy digests are dropped before the one shuffle of the texts,
    which is on (digest, id), so no group of copies meets in one task."""
    found = decide(docs, id_col, text_col, share)
    keys = found.rows.where(F.col("row_no") == F.col("keep.row_no")).select(row_key(F.col("digest"), F.col("id")).alias("key"))
    digest, keep, key = fresh(docs, "digest", "keep", "key")
    schema = T.StructType([*docs.schema.fields, T.StructField(digest, T.BinaryType())])

    def with_digest(batches):
        for b in _digest_batches(batches):
            yield b.rename_columns([*b.schema.names[:-1], digest])

    rows = docs.withColumn(digest, utf8(f"`{text_col}`")).mapInArrow(with_digest, schema)
    winners = found.heavy.select(F.col("digest").alias(digest), F.col("keep.id").alias(keep), F.lit(True).alias("won"))
    won = fresh(docs, "won")[0]
    rows = (rows.join(F.broadcast(winners.withColumnRenamed("won", won)), digest, "left")
            .where(F.col(won).isNull() | quoted(id_col).eqNullSafe(F.col(keep)))
            .withColumn(key, row_key(F.col(digest), quoted(id_col))))
    return rows.join(keys.withColumnRenamed("key", key), key, "left_semi").dropDuplicates([key]).select(*[quoted(c) for c in docs.columns])

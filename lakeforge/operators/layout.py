"""Partition layout: rows per partition, skew summary, file report,
compaction and clustered writes. Everything is a Spark aggregate; nothing
is collected to the driver."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.session import sizes_in
from lakeforge.sources.files import detached


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, without RDDs."""
    return df.groupBy(F.spark_partition_id().alias("partition")).count()


def skew_summary(df: DataFrame) -> DataFrame:
    """One row: partitions (non-empty), min, max and mean rows per partition,
    and the max/mean ratio."""
    s = partition_sizes(df)
    return s.agg(F.count(F.lit(1)).alias("partitions"), F.min("count").alias("min_rows"),
                 F.max("count").alias("max_rows"), F.avg("count").alias("mean_rows")).withColumn(
        "skew_ratio", F.col("max_rows") / F.col("mean_rows"))


def keys_per_partition(df: DataFrame, key: str) -> DataFrame:
    """Distinct partitions each key value landed in (1 after hash repartition)."""
    tagged = df.select(key, F.spark_partition_id().alias("_pid"))
    return tagged.groupBy(key).agg(F.count_distinct("_pid").alias("partitions"))


def range_bounds(df: DataFrame, col: str) -> DataFrame:
    """Min and max of ``col`` per partition (disjoint after range repartition)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(F.lit(1)).alias("rows"))


def file_report(df: DataFrame) -> DataFrame:
    """Rows and bytes per input file (hidden ``_metadata`` columns)."""
    return df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size").agg(
        F.count(F.lit(1)).alias("rows"))


TARGET_FILE_BYTES = 512 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Total size of the files behind ``df``, by one listing of each folder; no
    data is read."""
    spark, files = df.sparkSession, {unquote(f) for f in df.inputFiles()}
    folders = {f.rpartition("/")[0] for f in files}
    return sum(size for folder in folders for name, size in sizes_in(spark, folder).items() if f"{folder}/{name}" in files)


def compact(df: DataFrame, path: str, target_files: int | None = None,
            target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite ``df``, a frame read from files, into fewer, even files.
    Without ``target_files`` the count follows the input size: about one file
    per ``target_file_bytes``. Returns the file count used.

    A file is made of whole splits of the scan, so its task reads no more than
    the input's bytes for it, and nothing is shuffled. Only files smaller than
    two splits, or made of input that cannot be split, are dealt round-robin."""
    n = target_files or max(1, -(-input_bytes(df) // target_file_bytes))
    whole = n == 1 or df.rdd.getNumPartitions() >= 2 * n
    (df.coalesce(n) if whole else df.repartition(n)).write.mode("overwrite").parquet(path)
    return n


def write_clustered(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str],
                    num_partitions: int | None = None) -> None:
    """Partitioned folders, rows range-clustered on ``cluster_by`` within
    them, so min/max statistics let scans skip row groups. The range
    exchange has ``num_partitions`` tasks (default: the session's shuffle
    partitions, coalesced by adaptive execution), each writing a contiguous
    key range, so file count grows with the data, not with a constant."""
    cols = [*partition_by, *cluster_by]
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` by the hash of ``key``, sorted in
    each, and read it back. Frames bucketed alike by their join keys join and
    group on them without a shuffle, as often as they are read.

    The frame keeps the bucket layout; the catalog entry that carried it is
    dropped again, the files stay. A key's rows are all in one bucket: for a
    key that holds a large share of them use ``skew.skew_join`` instead."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return detached(spark, name)

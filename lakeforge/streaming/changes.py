"""A change feed applied batch by batch, whatever the order and the repeats.

``ChangeLog`` is a ``foreachBatch`` function. The changes are kept compacted
in hash buckets of the key: for type 1 each key's last change by sequence, a
delete included (a tombstone, so that an older change arriving later cannot
bring the row back); for type 2 one row of each (key, sequence). A batch reads
the buckets it touches, adds its rows, compacts again and replaces just those
buckets. Compacting keeps the same rows in any order and however often a
change arrives, so shuffled, repeated and replayed batches end alike.

Replacing is not atomic, so the new buckets are staged first. A batch that
failed while it published is replayed by Spark with the same id; if its staged
buckets are complete they are published again as they are, without reading
the target, which may be damaged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.operators.relational import latest_per_key
from lakeforge.operators.scd import apply_scd1, apply_scd2
from lakeforge.operators.upsert import bucket
from lakeforge.session import exists, listing, remove

BUCKET = "_bucket"


class ChangeLog:
    def __init__(self, base: str, keys: Sequence[str], sequence: str, kind: str = "scd1", op: str = "op", delete_value: str = "delete", buckets: int = 64):
        if kind not in ("scd1", "scd2"):
            raise ValueError(f"no change log for {kind!r}")
        self.base, self.keys, self.sequence, self.kind = base.rstrip("/"), list(keys), sequence, kind
        self.op, self.delete_value, self.buckets = op, delete_value, buckets

    @property
    def table(self) -> str:
        return f"{self.base}/log"

    def _staged(self, batch_id: int) -> str:
        return f"{self.base}/staged/batch_id={batch_id}"

    def _compact(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        by = self.keys if self.kind == "scd1" else [*self.keys, self.sequence]
        return latest_per_key(rows, by, [self.sequence], columns=columns)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = self._staged(batch_id)
        if not exists(spark, f"{staged}/_SUCCESS"):
            new = batch.withColumn(BUCKET, bucket(self.keys, self.buckets))
            rows = new
            if exists(spark, self.table):
                touched = [r[0] for r in new.select(BUCKET).distinct().collect()]      # at most ``buckets`` numbers
                rows = spark.read.schema(new.schema).parquet(self.table).where(F.col(BUCKET).isin(touched)).unionByName(new)
            self._compact(rows, rows.columns).write.mode("overwrite").parquet(staged)
        self._publish(spark, staged)
        for old in listing(spark, f"{self.base}/staged"):                              # the batches before are committed
            if int(old.split("=")[1]) < batch_id:
                remove(spark, f"{self.base}/staged/{old}")

    def _publish(self, spark: SparkSession, staged: str) -> None:
        (spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.table))

    def current(self, spark: SparkSession) -> DataFrame:
        """The table that the changes so far give."""
        log = spark.read.parquet(self.table).drop(BUCKET)
        if self.kind == "scd1":
            return apply_scd1(log, self.keys, self.sequence, self.op, self.delete_value)
        return apply_scd2(log, self.keys, self.sequence, self.op, self.delete_value)

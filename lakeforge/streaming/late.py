"""Late rows kept apart instead of lost.

A stateful query drops rows behind its watermark without a trace. ``LateSplit``
is a ``foreachBatch`` function that keeps its own watermark: the greatest event
time of all earlier batches less ``delay``. Rows behind it go to ``late``, all
others to ``on_time``, so the two together are the input. The watermark of a
batch is written with the batch, from the one before and the batch's own rows;
a replayed batch reads the same earlier watermark, overwrites its own folders
and changes nothing else. Rows without a time are late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.session import listing


class LateSplit:
    def __init__(self, base: str, time: str, delay: str):
        self.base, self.time, self.delay = base.rstrip("/"), time, delay

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.base}/{kind}/batch_id={batch_id}"

    def _highest_before(self, spark: SparkSession, batch_id: int):
        """The greatest event time of the batches before this one, None at the start."""
        done = [int(n.split("=")[1]) for n in listing(spark, f"{self.base}/highest") if n.startswith("batch_id=")]
        earlier = [n for n in done if n < batch_id]
        return spark.read.schema("highest timestamp").parquet(self._path("highest", max(earlier))).first()[0] if earlier else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        highest = self._highest_before(spark, batch_id)
        bound = F.lit(highest) - F.expr(f"INTERVAL {self.delay}")
        behind = F.lit(False) if highest is None else F.col(self.time) < bound
        late = F.coalesce(behind, F.lit(True)) if highest is not None else F.col(self.time).isNull()
        batch.persist()
        try:
            batch.where(~late).write.mode("overwrite").parquet(self._path("on_time", batch_id))
            batch.where(late).withColumn("watermark", F.lit(None).cast("timestamp") if highest is None else bound).write.mode("overwrite").parquet(self._path("late", batch_id))
            now = batch.agg(F.max(F.col(self.time).cast("timestamp")).alias("own"))
            known = F.lit(highest).cast("timestamp")
            # written last: a batch without it is not done
            now.select(F.greatest("own", known).alias("highest")).write.mode("overwrite").parquet(self._path("highest", batch_id))
        finally:
            batch.unpersist()

    def on_time(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.base}/on_time")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.base}/late")

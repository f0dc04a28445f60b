"""Incremental processing with Structured Streaming.

``run_available_now`` processes everything that arrived since the
checkpoint and stops (``trigger(availableNow=True)``); the checkpoint
(offsets, commits, metadata, sources) makes a rerun pick up only new input.
One checkpoint folder per query; sharing one between queries is refused.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.session import exists, listing

#: Who writes with a checkpoint, kept in the checkpoint folder itself.
OWNER = "_owner"


@dataclass
class RunResult:
    batches: int
    rows: int
    progress: list


def claim_checkpoint(spark: SparkSession, checkpoint: str, query_name: str) -> None:
    """Refuse to give one checkpoint folder to two different queries, also
    of other processes: the first one leaves its name in the folder."""
    owner = f"{checkpoint}/{OWNER}"
    if not exists(spark, owner):
        spark.createDataFrame([(query_name,)], "value string").coalesce(1).write.mode("ignore").text(owner)
    found = spark.read.text(owner).first()[0]
    if found != query_name:
        raise ValueError(f"checkpoint {checkpoint} already belongs to query {found}")


def _last_commit(spark: SparkSession, checkpoint: str) -> int:
    return max((int(n) for n in listing(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                      output_mode: str = "append", query_name: str = "incremental",
                      table: str | None = None) -> RunResult:
    """Run ``stream`` to the sink until all available input is processed.

    Spark keeps only the last progress reports of a query, so they are
    gathered while it runs, by batch number. The batches committed since the
    start must all be there; a missing one is an error, not a low count."""
    spark = stream.sparkSession
    claim_checkpoint(spark, checkpoint, query_name)
    before = _last_commit(spark, checkpoint)
    w = (stream.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    q = w.toTable(table) if table else w.start(sink)
    reports: dict[int, dict] = {}

    def gather() -> None:
        for p in q.recentProgress:
            report = json.loads(p.json) if hasattr(p, "json") else dict(p)
            reports[report["batchId"]] = report

    while not q.awaitTermination(0.2):
        gather()
    gather()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    missing = set(range(before + 1, _last_commit(spark, checkpoint) + 1)) - set(reports)
    if missing:
        raise RuntimeError(f"no progress report of batches {sorted(missing)[:10]}")
    progress = [reports[k] for k in sorted(reports)]
    return RunResult(batches=len(progress), rows=sum(p["numInputRows"] for p in progress), progress=progress)


def append_batch(source: DataFrame, key: str, lo: int, hi: int, path: str) -> None:
    """Append rows with ``lo <= key < hi`` and an arrival time as one commit."""
    (source.filter((F.col(key) >= lo) & (F.col(key) < hi))
     .withColumn("arrived_at", F.current_timestamp())
     .write.mode("append").parquet(path))


def checkpoint_layout(spark: SparkSession, checkpoint: str) -> list[str]:
    """Entries of a checkpoint folder: offsets, commits, metadata, sources."""
    return listing(spark, checkpoint)


def file_stream(spark: SparkSession, path: str, fmt: str, schema, max_files: int | None = None,
                with_source_file: bool = False) -> DataFrame:
    """A file-source stream over a landing folder with a known schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.load(path)
    if with_source_file:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def idempotent_batch_writer(base: str, fmt: str = "parquet"):
    """``foreachBatch`` function writing batch ``n`` to ``base/batch_id=n``
    with overwrite: a batch replayed after a failure (same id, same input,
    from the checkpoint) replaces its own output instead of duplicating it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{base}/batch_id={batch_id}")
    return write

"""Event streams: watermark windows, streaming de-duplication, output modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.operators import windows as WIN
from lakeforge.plans.registry import query
from lakeforge.session import scratch_root
from lakeforge.sources.tables import raw
from lakeforge.streaming import event_time as ET
from lakeforge.streaming import incremental as INC

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]


def _landing_events(spark, sf_dir, with_copies: bool = False) -> str:
    """Events as parquet files in time order; optionally with every fourth
    event repeated (the repeats sit in the same files, one batch)."""
    ev = raw(spark, sf_dir, "events").select(*EVENT_COLS)
    if with_copies:
        ev = ev.unionByName(ev.filter("event_id % 4 = 0"))
    path = scratch_root(spark, "events_landing")
    ev.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.mode("overwrite").parquet(path)
    return path


def _event_stream(spark, path):
    schema = spark.read.parquet(path).schema
    return ET.event_time(spark.readStream.schema(schema).parquet(path))


@query("ex_27_tumbling_window_watermark", oracle="""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type,
       count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2, 3
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def ex_27(spark, sf_dir):
    stream = _event_stream(spark, _landing_events(spark, sf_dir))
    agg = ET.windowed_counts(stream, "ts", "1 hour", "1 day", keys=["event_type"], value="value")
    sink, ckpt = scratch_root(spark, "windows_sink"), scratch_root(spark, "windows_ckpt")
    INC.run_available_now(agg, sink, ckpt, query_name="ex_27")
    return spark.read.parquet(sink)


@query("ex_27_sliding_window", oracle="""
SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, count(*) AS events FROM (
  SELECT date_trunc('day', ts) AS window_start FROM events
  UNION ALL SELECT date_trunc('day', ts) - INTERVAL 1 DAY FROM events) GROUP BY window_start""")
def ex_27_sliding(spark, sf_dir):
    ev = ET.event_time(raw(spark, sf_dir, "events"))
    return ET.windowed_counts(ev, "ts", "1 hour", "2 days", "1 day")


SESSION_SQL = """
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM (
  SELECT user_id, ts, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM (
    SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
      OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END
      AS new_session FROM events))
GROUP BY user_id, session_no"""


@query("ex_27_session_window", oracle=SESSION_SQL)
def ex_27_session(spark, sf_dir):
    """Gaps-and-islands sessions over the skew-safe window (no user has to
    fit in one task)."""
    ev = raw(spark, sf_dir, "events")
    return WIN.sessionize(ev, "user_id", "ts", "event_id", 30 * 60)


@query("ex_27_session_window_segmented", oracle=SESSION_SQL)
def ex_27_session_seg(spark, sf_dir):
    ev = raw(spark, sf_dir, "events")
    return WIN.sessionize(ev, "user_id", "ts", "event_id", 30 * 60, _event_segment(), force_segmented=True)


@query("ex_27_session_window_builtin", oracle=SESSION_SQL)
def ex_27_session_builtin(spark, sf_dir):
    """Spark's own ``session_window`` (per user in one task)."""
    ev = ET.event_time(raw(spark, sf_dir, "events"))
    return ET.sessions(ev, "ts", "30 minutes", ["user_id"])


def _event_segment():
    """(day, block of 2^20 event ids): monotone in (ts, event_id), bounded."""
    return F.struct(F.to_date("ts").alias("d"), F.shiftright("event_id", 20).alias("b"))


@query("sm_08_dedup_within_watermark", oracle="""
SELECT event_id, ts, user_id, event_type, value FROM events""")
def sm_08(spark, sf_dir):
    stream = _event_stream(spark, _landing_events(spark, sf_dir, with_copies=True))
    deduped = ET.dedup_within_watermark(stream, ["event_id"], "ts", "1 hour")
    sink, ckpt = scratch_root(spark, "dedup_sink"), scratch_root(spark, "dedup_ckpt")
    INC.run_available_now(deduped, sink, ckpt, query_name="sm_08")
    return spark.read.parquet(sink).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("ex_28_complete_mode_counts", oracle="SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def ex_28(spark, sf_dir):
    """Complete mode rewrites the whole (small, keyed) result each batch;
    collected through ``foreachBatch`` into a parquet snapshot."""
    path = _landing_events(spark, sf_dir)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    counts = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    out = scratch_root(spark, "complete_out")

    def write(batch, batch_id):
        # Idempotent per batch: the latest complete result replaces the last.
        batch.write.mode("overwrite").parquet(out)

    q = (counts.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", scratch_root(spark, "complete_ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


@query("ex_28_update_mode_counts", oracle="SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def ex_28b(spark, sf_dir):
    """Update mode gives each batch's changed groups only; the newest batch
    that names a group holds its count."""
    path = _landing_events(spark, sf_dir)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    counts = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    out = scratch_root(spark, "update_out")
    q = (counts.writeStream.outputMode("update").foreachBatch(INC.idempotent_batch_writer(out))
         .option("checkpointLocation", scratch_root(spark, "update_ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.max_by("events", "batch_id").alias("events"))


@query("sm_06_checkpoint_reset", oracle="""
SELECT count(*) AS first_run, CAST(0 AS BIGINT) AS rerun, count(*) AS after_reset, TRUE AS owner_kept FROM events""")
def sm_06(spark, sf_dir):
    """A rerun on the same checkpoint reads nothing; a new checkpoint reads
    all again; a checkpoint is refused to another query."""
    path = _landing_events(spark, sf_dir)
    schema = spark.read.parquet(path).schema
    first, second = scratch_root(spark, "reset_ckpt"), scratch_root(spark, "reset_ckpt")
    # a file sink keeps its own batch log, so each checkpoint has a sink of its own
    run = lambda ckpt: INC.run_available_now(spark.readStream.schema(schema).parquet(path), f"{ckpt}-sink", ckpt, query_name="sm_06").rows
    rows = [run(first), run(first), run(second)]
    try:
        INC.claim_checkpoint(spark, first, "another")
        kept = False
    except ValueError:
        kept = True
    names = ("first_run", "rerun", "after_reset")
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in zip(names, rows)], F.lit(kept).alias("owner_kept"))

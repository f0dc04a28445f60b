"""Streams with state: joins of two streams, sessions by timers, late rows
kept apart, a change feed applied batch by batch. Each query lands its input
in parts and runs the stream after every part, so each resumes from its
checkpoint."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.plans.outline import CHG_SQL, changes
from lakeforge.plans.registry import query
from lakeforge.plans.streams import SESSION_SQL
from lakeforge.session import scratch_root
from lakeforge.sources.tables import raw, with_typed
from lakeforge.streaming import event_time as ET
from lakeforge.streaming.changes import ChangeLog
from lakeforge.streaming.incremental import claim_checkpoint, run_available_now
from lakeforge.streaming.joins import join_within
from lakeforge.streaming.late import LateSplit
from lakeforge.streaming.stateful import rocksdb, sessions_by_timer

PARTS = 4


def in_parts(df: DataFrame, time: str) -> DataFrame:
    """The rows with ``part``, equal stretches of time from 0 on."""
    ends = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi")).select(F.unix_micros(F.col("lo").cast("timestamp")).alias("lo"), F.unix_micros(F.col("hi").cast("timestamp")).alias("hi")).first()
    at = F.unix_micros(F.col(time).cast("timestamp"))
    return df.withColumn("part", F.expr("CAST(0 AS INT)") if ends["lo"] is None else
                         F.call_function("div", (at - F.lit(ends["lo"])) * PARTS, F.lit(ends["hi"] - ends["lo"] + 1)).cast("int"))


PART_SQL = f"CAST((epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) * {PARTS} // (SELECT epoch_us(max(ts)) - epoch_us(min(ts)) + 1 FROM events) AS INTEGER)"


class Landing:
    """A folder that gets its rows part by part, and a stream over it."""

    def __init__(self, rows: DataFrame, name: str):
        self.rows, self.path = rows, scratch_root(rows.sparkSession, name)

    def add(self, part: int) -> None:
        self.rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(self.path)

    def stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.schema(self.rows.drop("part").schema).parquet(self.path)


def _views_and_purchases(spark, sf_dir):
    ev = in_parts(raw(spark, sf_dir, "events"), "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    views = ev.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts"), "part")
    bought = ev.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"), F.col("ts").alias("bought_ts"), "part")
    return Landing(views, "views_landing"), Landing(bought, "purchases_landing")


def stream_join(spark, sf_dir, how: str):
    """The joined rows in the sink, and the progress of every run."""
    views, bought = _views_and_purchases(spark, sf_dir)
    sink, ckpt = scratch_root(spark, "stream_join_sink"), scratch_root(spark, "stream_join_ckpt")
    progress = []
    for part in range(PARTS):
        views.add(part)
        bought.add(part)
        pairs = join_within(views.stream(spark), bought.stream(spark), "user_id", "buyer", "view_ts", "bought_ts", within="1 hour", delay="1 hour", how=how)
        progress += run_available_now(pairs.select("view_id", "user_id", "view_ts", "purchase_id"), sink, ckpt, query_name=f"stream_join_{how}").progress
    return spark.read.parquet(sink), progress


#: Views whose hour is closed for certain: before the last day.
STREAM_JOIN_SQL = """
SELECT v.event_id AS view_id, v.user_id, p.event_id AS purchase_id
FROM (SELECT * FROM events WHERE event_type = 'view' AND ts < (SELECT date_trunc('day', max(ts)) FROM events)) v
{how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON p.user_id = v.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR"""


def _stream_join(how):
    def build(spark, sf_dir):
        last_day = F.date_trunc("day", F.lit(raw(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).first()[0]))
        return stream_join(spark, sf_dir, how)[0].where(F.col("view_ts") < last_day).drop("view_ts")
    return build


query("sm_10_stream_join_inner", oracle=STREAM_JOIN_SQL.format(how="INNER"))(_stream_join("inner"))
query("sm_10_stream_join_left", oracle=STREAM_JOIN_SQL.format(how="LEFT"))(_stream_join("left"))


@query("sm_11_sessions_by_timer", oracle=f"""
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY session_start) AS session_no, session_start, session_end, events
FROM ({SESSION_SQL}) WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def sm_11(spark, sf_dir):
    """Sessions that the watermark has closed, from list and value state and timers."""
    landing = Landing(in_parts(raw(spark, sf_dir, "events").select("user_id", "ts"), "ts"), "session_events")
    sink, ckpt = scratch_root(spark, "timer_sink"), scratch_root(spark, "timer_ckpt")
    with rocksdb(spark):
        for part in range(PARTS):
            landing.add(part)
            found = sessions_by_timer(ET.event_time(landing.stream(spark)), "user_id", "ts", timedelta(minutes=30), "1 hour")
            run_available_now(found, sink, ckpt, query_name="sm_11")
    got = spark.read.parquet(sink)
    return got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


LATE_SQL = f"""
WITH e AS (SELECT event_id, ts, CASE WHEN event_id % 50 = 0 THEN {PARTS - 1} ELSE {PART_SQL} END AS part FROM events),
h AS (SELECT p.part, (SELECT max(ts) FROM e WHERE e.part < p.part) AS highest FROM (SELECT DISTINCT part FROM e) p)
SELECT event_id, CAST(part AS INTEGER) AS batch_id, coalesce(ts < highest - INTERVAL 1 HOUR, FALSE) AS is_late FROM e JOIN h USING (part)"""


@query("sm_12_late_rows_kept", oracle=LATE_SQL)
def sm_12(spark, sf_dir):
    """Every 50th event comes with the last part: none is lost, the late ones are told apart."""
    ev = in_parts(raw(spark, sf_dir, "events").select("event_id", "ts"), "ts")
    landing = Landing(ev.withColumn("part", F.when(F.col("event_id") % 50 == 0, PARTS - 1).otherwise(F.col("part"))), "late_events")
    split = LateSplit(scratch_root(spark, "late_split"), "ts", "1 hour")
    ckpt = scratch_root(spark, "late_ckpt")
    claim_checkpoint(spark, ckpt, "sm_12")
    for part in range(PARTS):
        landing.add(part)
        _each_batch(ET.event_time(landing.stream(spark)), split, ckpt)
    told = lambda df, late: df.select("event_id", F.col("batch_id").cast("int").alias("batch_id"), F.lit(late).alias("is_late"))
    return told(split.on_time(spark), False).unionByName(told(split.late(spark), True))


def _each_batch(stream: DataFrame, write, checkpoint: str) -> None:
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _streamed_changes(spark, sf_dir, kind: str) -> DataFrame:
    """The feed in shuffled parts, a fifth of the changes in every part."""
    feed = changes(spark, sf_dir).withColumn("h", F.xxhash64("c_custkey", "seq"))
    parts = feed.withColumn("part", F.explode(F.when(F.pmod("h", F.lit(5)) == 0, F.sequence(F.lit(0), F.lit(PARTS - 1)))
                                              .otherwise(F.array(F.pmod(F.shiftright("h", 8), F.lit(PARTS)).cast("int"))))).drop("h")
    landing, ckpt = Landing(parts, f"{kind}_feed"), scratch_root(spark, f"{kind}_ckpt")
    log = ChangeLog(scratch_root(spark, kind), ["c_custkey"], "seq", kind, buckets=16)
    claim_checkpoint(spark, ckpt, kind)
    for part in range(PARTS):
        landing.add(part)
        _each_batch(landing.stream(spark), log, ckpt)
    return log.current(spark)


@query("ex_13_cdc_scd1_stream", oracle=with_typed("""
SELECT c_custkey, c_name, c_acctbal, seq FROM chg
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1 AND op <> 'delete'""", "customer", extra=CHG_SQL))
def ex_13_scd1(spark, sf_dir):
    return _streamed_changes(spark, sf_dir, "scd1")


@query("ex_13_cdc_scd2_stream", oracle=with_typed("""
SELECT c_custkey, c_name, c_acctbal, valid_to, seq AS valid_from, valid_to IS NULL AS is_current FROM (
  SELECT *, lead(seq) OVER (PARTITION BY c_custkey ORDER BY seq) AS valid_to FROM chg) WHERE op <> 'delete'""", "customer", extra=CHG_SQL))
def ex_13_scd2(spark, sf_dir):
    return _streamed_changes(spark, sf_dir, "scd2")

"""Event-time processing: watermarks, tumbling / sliding / session
windows, and de-duplication with bounded state.

Watermarks need a TIMESTAMP column (TIMESTAMP_NTZ is refused), so event
times are cast under the session zone (UTC). With the append output mode a
window is emitted once the watermark passes its end, so the newest window
stays open at the end of a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp"))


def windowed_counts(df: DataFrame, ts: str, delay: str, duration: str, slide: str | None = None,
                    keys: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Counts (and an exact decimal sum of ``value``) per event-time window."""
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    aggs: list[Column] = [F.count(F.lit(1)).alias("events")]
    if value:
        aggs.append(F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias("total_value"))
    return (df.withWatermark(ts, delay).groupBy(w.alias("window"), *keys).agg(*aggs)
            .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window.end").cast("timestamp_ntz").alias("window_end"), *keys, *aggs_names(aggs)))


def aggs_names(aggs) -> list[str]:
    return ["events"] + (["total_value"] if len(aggs) > 1 else [])


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str]) -> DataFrame:
    """Session windows per key: a session ends ``gap`` after its last event."""
    s = F.session_window(ts, gap)
    return (df.groupBy(s.alias("s"), *keys).agg(F.count(F.lit(1)).alias("events"))
            .select(*keys, F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"), "events"))


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key seen within ``delay``; state is evicted as the
    watermark moves, so it stays bounded on an endless stream."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))

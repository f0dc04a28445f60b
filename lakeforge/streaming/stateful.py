"""Custom keyed state: sessions closed by event-time timers.

Spark's own session window gives the counts of a session; this operator shows
the general form, ``transformWithState`` on the RocksDB store. Each key keeps
its open sessions as a list and how many it has closed as a value. A row joins
the sessions it lies within ``gap`` of, which may merge two when rows come out
of order. A key has one timer, at the end of its first open session; when the
watermark passes it, all sessions that have ended by then are given out,
numbered, and removed, and the timer moves to the next end. So the state of a
key is its open sessions, one number and one timer, and a batch calls a key at
most twice, however many sessions it opens and closes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SESSION = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("events", T.LongType())])


@contextmanager
def rocksdb(spark: SparkSession):
    """State stores of queries started inside keep their data outside the
    heap; ``transformWithState`` needs this store. A query's checkpoint
    remembers its store."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def merged(sessions: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(first, last, events) in order; those less than ``gap`` apart as one."""
    out: list[tuple[int, int, int]] = []
    for first, last, events in sorted(sessions):
        if out and first < out[-1][1] + gap:
            out[-1] = (out[-1][0], max(last, out[-1][1]), out[-1][2] + events)
        else:
            out.append((first, last, events))
    return out


class Sessions(StatefulProcessor):
    """Times are microseconds in state, milliseconds in timers."""

    def __init__(self, key: str, gap: timedelta):
        self.key = key
        self.gap = int(gap.total_seconds() * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", SESSION)
        self.closed = handle.getValueState("closed", "n bigint")

    def _due(self, last: int) -> int:
        """The first millisecond at which the session has ended."""
        return -(-(last + self.gap) // 1000)

    def _first_due(self, sessions: list[tuple[int, int, int]]) -> int | None:
        """When the key's timer has to be; sessions lie apart in order, so it is the first one's end."""
        return self._due(sessions[0][1]) if sessions else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = list(self.open.get())
        now = merged(before + [(r["_at"], r["_at"], 1) for r in rows], self.gap)
        was, due = self._first_due(before), self._first_due(now)
        if was != due:
            if was is not None:
                self.handle.deleteTimer(was)
            self.handle.registerTimer(due)
        self.open.put(now)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        sessions = list(self.open.get())
        ended = [s for s in sessions if self._due(s[1]) <= timerValues.getCurrentWatermarkInMs()]
        if not ended:        # a timer that a checkpoint of one timer a session has left
            return
        left = sessions[len(ended):]
        if left:
            self.open.put(left)
            self.handle.registerTimer(self._first_due(left))
        else:
            self.open.clear()
        n = (self.closed.get() or (0,))[0]
        self.closed.update((n + len(ended),))
        for k, (first, last, events) in enumerate(ended):
            yield Row(**{self.key: key[0], "session_no": n + k + 1, "_first": first, "_end": last + self.gap, "events": events})

    def close(self) -> None:
        pass


def sessions_by_timer(stream: DataFrame, key: str, time: str, gap: timedelta, delay: str) -> DataFrame:
    """``(key, session_no, session_start, session_end, events)`` of every
    session that the watermark has closed; append mode. Rows later than the
    watermark are dropped before they reach the state. ``session_no`` counts
    a key's sessions in the order in which they are closed."""
    rows = stream.withWatermark(time, delay).select(F.col(key), F.col(time), F.unix_micros(time).alias("_at"))
    out = T.StructType([stream.schema[key], *[T.StructField(c, T.LongType()) for c in ("session_no", "_first", "_end", "events")]])
    found = rows.groupBy(key).transformWithState(Sessions(key, gap), out, "Append", "EventTime")
    return found.select(key, "session_no", F.timestamp_micros("_first").alias("session_start"), F.timestamp_micros("_end").alias("session_end"), "events")

"""Streams with state: what is closed equals the batch result, state stays
bounded, runs resume, replays change nothing."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from lakeforge.plans.stateful import stream_join
from lakeforge.session import listing, remove, scratch_root
from lakeforge.streaming import stateful as ST
from lakeforge.streaming.changes import BUCKET, ChangeLog
from lakeforge.streaming.incremental import run_available_now
from lakeforge.streaming.joins import join_within
from lakeforge.streaming.late import LateSplit

SF01 = "/root/testdata/sf0.01"
#: Times count from here; at the epoch itself rows are behind the first watermark.
DAY = 86_400


def test_stream_join_state_is_bounded(spark):
    """Over four runs the state never holds more than the rows of about a
    part, and at the end only those of the last hours."""
    got, progress = stream_join(spark, SF01, "left")
    state = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in progress]
    total = sum(p["numInputRows"] for p in progress)
    assert total > 3000 and len(progress) >= 4
    assert max(state) < 0.3 * total and state[-1] < 0.02 * total
    assert got.count() == got.select("view_id", "purchase_id").distinct().count()


def test_join_kinds(spark):
    s = spark.readStream.format("rate").load().selectExpr("value AS k", "timestamp AS t")
    r = spark.readStream.format("rate").load().selectExpr("value AS rk", "timestamp AS rt")
    with pytest.raises(ValueError):
        join_within(s, r, "k", "rk", "t", "rt", "1 hour", "1 hour", how="full")


def test_sessions_merge_in_any_order():
    rng = random.Random(2)
    for _ in range(200):
        times = [rng.randrange(300) for _ in range(rng.randrange(1, 30))]
        whole = ST.merged([(t, t, 1) for t in times], 10)
        step = []
        for t in times:
            step = ST.merged(step + [(t, t, 1)], 10)
        assert step == whole and sum(n for *_, n in whole) == len(times)
        assert all(b[0] - a[1] >= 10 for a, b in zip(whole, whole[1:]))


def _sessions(spark, parts):
    """Sessions given out after all parts have been run, one by one."""
    path, sink, ckpt = (scratch_root(spark, n) for n in ("timer_in", "timer_out", "timer_state"))
    with ST.rocksdb(spark):
        for part in parts:
            spark.createDataFrame(part, "u INT, s LONG").select("u", F.timestamp_seconds(F.col("s") + DAY).alias("ts")).write.mode("append").parquet(path)
            stream = spark.readStream.schema("u INT, ts TIMESTAMP").parquet(path)
            run_available_now(ST.sessions_by_timer(stream, "u", "ts", timedelta(seconds=60), "100 seconds"), sink, ckpt, query_name="timers")
    got = spark.read.parquet(sink).select("u", "session_no", (F.unix_seconds("session_start") - DAY).alias("a"), (F.unix_seconds("session_end") - DAY).alias("z"), "events")
    return sorted(map(tuple, got.collect()))


def test_sessions_by_timer_over_runs_and_out_of_order(spark):
    """A session spans two runs; a row between two open sessions merges them;
    an open session is not given out."""
    first = [(1, 0), (1, 30), (2, 10), (1, 170), (1, 80)]
    second = [(1, 125), (2, 500), (1, 520)]
    third = [(1, 900), (2, 905)]
    # all of user 1's rows from 0 to 170 are less than a minute apart
    assert _sessions(spark, [first, second, third]) == [(1, 1, 0, 230, 5), (1, 2, 520, 580, 1), (2, 1, 10, 70, 1), (2, 2, 500, 560, 1)]


class OneKey:
    """State and timers of one key in memory; ``batch`` does what a batch does."""

    def __init__(self, gap):
        self.work, self.timers, self.calls, self.out = ST.Sessions("u", timedelta(seconds=gap)), set(), 0, []
        self.work.init(self)

    def getListState(self, *_):
        return type("Listed", (), {"rows": [], "get": lambda s: iter(s.rows), "put": lambda s, v: setattr(s, "rows", list(v)), "clear": lambda s: s.put([])})()

    def getValueState(self, *_):
        return type("Valued", (), {"v": None, "get": lambda s: s.v, "exists": lambda s: s.v is not None, "update": lambda s, v: setattr(s, "v", v)})()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def batch(self, seconds, watermark):
        values = type("Values", (), {"getCurrentWatermarkInMs": lambda s: watermark * 1000})()
        list(self.work.handleInputRows((1,), [{"_at": s * 1_000_000} for s in seconds], values))
        most = len(self.timers)
        for at in sorted(t for t in self.timers if t <= watermark * 1000):
            self.calls += 1
            self.out += self.work.handleExpiredTimer((1,), values, type("Info", (), {"getExpiryTimeInMs": lambda s: at})())
            self.timers.remove(at)
        return most


def test_a_key_has_one_timer_however_many_sessions():
    key = OneKey(gap=60)
    assert key.batch([100 * k for k in range(500)], watermark=100 * 400 + 60) == 1
    assert key.calls == 1 and len(key.timers) == 1
    assert [(r["session_no"], r["_first"], r["events"]) for r in key.out] == [(k + 1, 100_000_000 * k, 1) for k in range(401)]
    key.batch([100 * 500], watermark=10**6)
    assert key.calls == 2 and len(key.out) == 501 and not key.timers and not key.work.open.rows


def test_one_timer_gives_each_session_once_it_has_ended():
    rng = random.Random(5)
    for _ in range(100):
        key, watermark, seen = OneKey(gap=10), 0, []
        for _ in range(8):
            rows = [watermark + rng.randrange(120) for _ in range(rng.randrange(1, 12))]
            seen += rows
            watermark += rng.randrange(60)
            assert key.batch(rows, watermark) == 1
            ended = [s for s in ST.merged([(t, t, 1) for t in seen], 10) if s[1] + 10 <= watermark]
            assert [(r["session_no"], r["_first"], r["_end"], r["events"]) for r in key.out] == [
                (k + 1, a * 1_000_000, (z + 10) * 1_000_000, n) for k, (a, z, n) in enumerate(ended)]


def test_timers_left_by_a_checkpoint_of_one_a_session_change_nothing():
    key = OneKey(gap=60)
    key.batch([0, 100, 200, 900], watermark=0)
    key.timers |= {160_000, 260_000, 960_000}
    key.batch([950], watermark=500)
    assert [(r["session_no"], r["_first"]) for r in key.out] == [(1, 0), (2, 100_000_000), (3, 200_000_000)]
    key.batch([5000], watermark=1010)
    assert [(r["session_no"], r["events"]) for r in key.out][3:] == [(4, 2)]


def test_store_setting_is_put_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with ST.rocksdb(spark):
        assert spark.conf.get(name) == ST.ROCKSDB
    assert spark.conf.get(name, None) == before


def _late(spark, base, batches, replay=()):
    split = LateSplit(base, "ts", "10 seconds")
    frames = [spark.createDataFrame(b, "id INT, s LONG").select("id", F.timestamp_seconds("s").alias("ts")) for b in batches]
    for n, frame in enumerate(frames):
        split(frame, n)
        for again in replay:
            if again <= n:
                split(frames[again], again)
    rows = lambda df: sorted((r["id"], r["batch_id"]) for r in df.select("id", "batch_id").collect())
    return rows(split.on_time(spark)), rows(split.late(spark))


BATCHES = [[(1, 100), (2, 5), (3, None)], [(4, 90), (5, 89), (6, 300)], [(7, 291), (8, 290), (9, 289), (10, None)], [(11, 1)]]


def test_late_rows_are_told_by_the_batches_before(spark):
    on_time, late = _late(spark, scratch_root(spark, "late"), BATCHES)
    assert late == [(3, 0), (5, 1), (9, 2), (10, 2), (11, 3)]
    assert sorted(i for i, _ in on_time + late) == list(range(1, 12))


def test_replayed_batches_split_alike(spark):
    plain = _late(spark, scratch_root(spark, "late"), BATCHES)
    assert _late(spark, scratch_root(spark, "late"), BATCHES, replay=(0, 1, 2)) == plain


CHANGES = [(k, s, "delete" if (k + s) % 5 == 0 else "upsert", f"{k}-{s}") for k in range(12) for s in range(1, 6)]
FEED = "k INT, seq INT, op STRING, v STRING"


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_shuffled_and_repeated_changes_end_alike(spark, kind):
    def run(seed):
        rng = random.Random(seed)
        rows = CHANGES + rng.sample(CHANGES, 20)
        rng.shuffle(rows)
        log = ChangeLog(scratch_root(spark, kind), ["k"], "seq", kind, buckets=4)
        cuts = sorted(rng.sample(range(1, len(rows)), 3))
        for n, (i, j) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            log(spark.createDataFrame(rows[i:j], FEED), n)
            log(spark.createDataFrame(rows[i:j], FEED), n)                   # replayed as it was
        return sorted(map(tuple, log.current(spark).select("k", "v", "valid_to" if kind == "scd2" else "seq").collect()), key=str)

    if kind == "scd1":
        expected = sorted(((k, v, s) for k, s, op, v in CHANGES if s == 5 and op != "delete"), key=str)
    else:
        expected = sorted(((k, v, s + 1 if s < 5 else None) for k, s, op, v in CHANGES if op != "delete"), key=str)
    assert run(1) == run(2) == expected


def test_tombstones_keep_older_changes_out(spark):
    log = ChangeLog(scratch_root(spark, "tomb"), ["k"], "seq")
    log(spark.createDataFrame([(1, 5, "delete", None)], FEED), 0)
    log(spark.createDataFrame([(1, 4, "upsert", "old"), (2, 1, "upsert", "x")], FEED), 1)
    assert [(r.k, r.v) for r in log.current(spark).collect()] == [(2, "x")]


def test_a_batch_that_failed_while_publishing_is_published_from_its_stage(spark):
    log = ChangeLog(scratch_root(spark, "broken"), ["k"], "seq", buckets=2)
    log(spark.createDataFrame([(k, 1, "upsert", "a") for k in range(8)], FEED), 0)
    batch = spark.createDataFrame([(1, 2, "upsert", "b")], FEED)
    publish, log._publish = log._publish, lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        log(batch, 1)
    touched = spark.read.parquet(log._staged(1)).select(BUCKET).distinct().collect()
    for r in touched:                                                        # the overwrite had begun: its buckets are gone
        remove(spark, f"{log.table}/{BUCKET}={r[0]}")
    log._publish = publish
    log(batch, 1)
    assert sorted((r.k, r.v) for r in log.current(spark).collect()) == [(k, "b" if k == 1 else "a") for k in range(8)]
    log(batch, 2)
    assert listing(spark, f"{log.base}/staged") == ["batch_id=2"]

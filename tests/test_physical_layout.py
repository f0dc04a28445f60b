"""Overlap report, Z-order, bucketed joins, join-driven pruning and the
partitioned table function, against plain Python versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeforge.functions.funnel import funnel
from lakeforge.operators import clustering as C
from lakeforge.operators.layout import bucketed
from lakeforge.plans import load_all
from lakeforge.plans.inspect import explain_text
from lakeforge.session import scratch_root


def plain_overlap(ranges):
    """(files, empty, max depth, pairs) of a list of (lo, hi) or None."""
    some = [r for r in ranges if r is not None]
    pairs = sum(a[0] <= b[1] and b[0] <= a[1] for i, a in enumerate(some) for b in some[:i])
    depth = max((sum(r[0] <= at <= r[1] for r in some) for at, _ in some), default=0)
    return len(some), len(ranges) - len(some), depth, pairs


def units_frame(spark, files):
    """Two rows a file, of its low and its high value, for several types."""
    rows = []
    for name, bounds in files.items():
        for v in bounds or (None, None):
            day = None if v is None else dt.date(2000, 1, 1) + dt.timedelta(days=v)
            rows.append((name, v, None if v is None else v / 8 - 3, day, None if v is None else f"é{v:04d}"))
    return spark.createDataFrame(rows, "file string, n bigint, x double, d date, s string")


@pytest.mark.parametrize("cut", [False, True])
def test_overlap_report_matches_plain(spark, monkeypatch, cut):
    if cut:                      # the sweep over segments gives the same
        monkeypatch.setattr(C, "skew_safe_window", _cut_window)
    rnd = random.Random(7)
    files = {f"f{i}": tuple(sorted((rnd.randrange(40), rnd.randrange(40)))) for i in range(25)}
    files |= {"point": (5, 5), "point too": (5, 5), "nulls": None}
    columns = ["n", "x", "d", "s"]
    found = C.overlap_report(C.file_ranges(units_frame(spark, files), columns, unit=F.col("file"))).collect()
    want = plain_overlap(list(files.values()))
    assert {r.column_name for r in found} == set(columns)
    for r in found:
        assert (r.files, r.empty_files, r.max_depth, r.overlap_pairs) == want
        assert r.mean_overlaps == 2 * want[3] / want[0] and r.rows == 2 * len(files)


def _cut_window(df, keys, order, segment, specs):
    from lakeforge.operators.windows import segmented_window
    number = F.coalesce(F.col("at.exact"), F.col("at.real"), F.lit(0)).cast("double")
    return segmented_window(df, keys, order, F.floor(number / 7), specs)


def test_overlap_report_of_empty_and_null_columns(spark):
    empty = spark.createDataFrame([], "file string, n bigint")
    assert C.overlap_report(C.file_ranges(empty, ["n"], unit=F.col("file"))).count() == 0
    nulls = spark.createDataFrame([("a", None), ("b", None)], "file string, n bigint")
    row = C.overlap_report(C.file_ranges(nulls, ["n"], unit=F.col("file"))).first()
    assert (row.files, row.empty_files, row.max_depth, row.overlap_pairs, row.mean_overlaps) == (0, 2, 0, 0, None)
    with pytest.raises(ValueError, match="no order"):
        C.file_ranges(spark.range(1).select(F.array("id").alias("a")), ["a"], unit=F.lit(1))


def test_zorder_interleaves_ranks(spark):
    df = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"))
    got = C.with_zorder(df, ["a", "b"], bits=2).collect()
    for r in got:
        x, y = r.a // 16, r.b // 16           # even values: four ranges of 16, up to one value at a cut
        want = {sum((((p >> k) & 1) << (2 * k)) | (((q >> k) & 1) << (2 * k + 1)) for k in range(2))
                for p in {x, (r.a + 1) // 16} for q in {y, (r.b + 1) // 16}}
        assert r._z in want, r


def test_zorder_write_keeps_rows_and_spreads_a_hot_value(spark):
    rows = [(i, 1 if i % 3 else i, None if i % 5 == 0 else f"w{i % 97}") for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, `a b` bigint, s string")
    path = scratch_root(spark, "z")
    C.write_zordered(df, path, ["a b", "s"], 8)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    per_file = back.groupBy("_metadata.file_path").count().collect()
    assert len(per_file) == 8 and max(r["count"] for r in per_file) < 2 * 6000 / 8
    assert C.with_zorder(df.limit(0), ["a b"]).count() == 0


def test_bucketed_frames_join_without_exchange(spark, sf):
    df = load_all()["ex_19_bucketed_join"].run(spark, sf)
    plan = explain_text(df)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
    twice = bucketed(spark.range(10), scratch_root(spark, "b"), "id", 4)
    assert sorted(r.id for r in twice.collect()) == list(range(10))


def test_filtered_dimension_prunes_folders_at_run_time(spark, sf):
    df = load_all()["ex_20_dynamic_partition_pruning"].run(spark, sf)
    assert "dynamicpruning" in explain_text(df).lower()
    assert df.count() == 5


def plain_funnel(events, steps):
    out = {}
    for user in {e[0] for e in events}:
        times = []
        for _, kind, at in sorted((e for e in events if e[0] == user and e[2] is not None), key=lambda e: e[2]):
            if len(times) < len(steps) and kind == steps[len(times)] and (not times or at > times[-1]):
                times.append(at)
        out[user] = (len(times), *times, *[None] * (len(steps) - len(times)))
    return out


def test_funnel_matches_plain(spark):
    rnd = random.Random(3)
    kinds = ["view", "click", "buy", "other", None]
    events = [(rnd.choice([None, *range(12)]), rnd.choice(kinds), rnd.choice([None, *range(15)])) for _ in range(400)]
    events += [(99, "other", 1), (100, "view", 4), (100, "click", 4), (100, "click", 5)]
    steps = ["view", "click", "buy"]
    df = spark.createDataFrame(events, "u bigint, kind string, at bigint").withColumn("more", F.lit("x"))
    got = {r[0]: tuple(r[1:]) for r in funnel(df, "u", "kind", "at", steps).collect()}
    assert got == plain_funnel(events, steps)
    assert funnel(df.limit(0), "u", "kind", "at", steps).count() == 0


def test_funnel_reads_a_partition_in_order_and_refuses_bad_calls(spark):
    df = spark.createDataFrame([(1, "a", 1)], "u bigint, kind string, at bigint")
    plan = explain_text(funnel(df, "u", "kind", "at", ["a"]))
    assert "PythonUDTF" in plan and "Sort" in plan
    with pytest.raises(ValueError, match="comma"):
        funnel(df, "u", "kind", "at", ["a,b"])
    with pytest.raises(Exception, match="different names"):
        funnel(df, "u", "kind", "at", ["a", "a"]).collect()

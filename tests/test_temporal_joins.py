"""As-of and interval joins against plain Python, on hot keys, and their plans."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import cuts as CUT
from lakeforge.operators import temporal as TJ
from lakeforge.operators import windows as WIN
from lakeforge.operators.skew import hot_keys
from lakeforge.plans.inspect import explain_text

LEFT, RIGHT = "k STRING, t BIGINT, n INT", "rk STRING, rt BIGINT, tie INT, v STRING"


def latest(left, right, allow_equal=True):
    by = {}
    for k, t, tie, v in right:
        if k is not None and t is not None:
            by.setdefault(k, []).append((t, tie, v))
    for rows in by.values():
        rows.sort()
    out = []
    for k, t, n in left:
        rows = by.get(k, []) if t is not None else []
        i = bisect.bisect_right([r[0] for r in rows], t) if allow_equal and rows else bisect.bisect_left([r[0] for r in rows], t) if rows else 0
        out.append((k, t, n, rows[i - 1][2] if i else None))
    return sorted(out, key=str)


def made(seed, n):
    """A key holding a third of the rows, ties, NULL keys, times and values."""
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "hot", None, *"abcde"])
    left = [(key(), rng.choice([None, *[rng.randrange(500)] * 9]), i) for i in range(n)]
    right = [(key(), rng.choice([None, *[rng.randrange(500)] * 9]), i, rng.choice([None, f"v{i}"])) for i in range(n)]
    return left, right


@pytest.mark.parametrize("allow_equal", [True, False])
@pytest.mark.parametrize("how", [{}, {"hot_fraction": 0.05, "sample_fraction": 1.0, "rows_per_segment": 60}, {"segment": "floor(_time / 7)"}])
def test_asof_equals_plain(spark, allow_equal, how):
    left, right = made(1, 900)
    how = {k: F.expr(v) if k == "segment" else v for k, v in how.items()}
    got = TJ.asof_join(spark.createDataFrame(left, LEFT).repartition(4), spark.createDataFrame(right, RIGHT).repartition(3), "k", "rk", "t", "rt", ["v"], "tie",
                       allow_equal=allow_equal, **how)
    assert got.columns == ["k", "t", "n", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == latest(left, right, allow_equal)


def test_asof_empty_sides_and_clashes(spark):
    left, right = spark.createDataFrame([("a", 5, 1)], LEFT), spark.createDataFrame([("a", 5, 1, "x")], RIGHT)
    join = lambda a, b: [tuple(r) for r in TJ.asof_join(a, b, "k", "rk", "t", "rt", ["v"], "tie").collect()]
    assert join(left, right) == [("a", 5, 1, "x")]
    assert join(left, right.limit(0)) == [("a", 5, 1, None)] and join(left.limit(0), right) == []
    with pytest.raises(ValueError, match="both sides"):
        TJ.asof_join(left, right.withColumnRenamed("v", "n"), "k", "rk", "t", "rt", ["n"], "tie")


def test_asof_is_one_shuffle_without_a_join(spark):
    left, right = made(2, 50)
    plan = explain_text(TJ.asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "rk", "t", "rt", ["v"], "tie"))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 1


def hot_history(spark):
    """One key with a third of the rows; its ids run against its dates."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 997).alias("k"), F.expr("date '2024-01-01' + cast((id * 7919) % 90 as int)").alias("d"),
        (-F.col("id")).alias("id"), F.when(F.col("id") % 13 == 0, None).otherwise(F.col("id") % 101).alias("v"))


def test_sampled_cuts_follow_the_rows(spark):
    df = hot_history(spark)
    hot = hot_keys(df, "k", 0.1, sample_fraction=1.0)
    cuts = CUT.order_cuts(df, "k", ["d", "id"], hot, rows_per_segment=500)
    assert [r["_hot"] for r in cuts.collect()] == [-1]
    sizes = (df.where("k = -1").join(F.broadcast(cuts), F.col("k") == F.col("_hot")).select(CUT.segment_of(["d", "id"]).alias("s"), "d", "id")
             .groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "id")).alias("lo"), F.max(F.struct("d", "id")).alias("hi")).orderBy("s").collect())
    assert 15 <= len(sizes) <= 26 and sum(r["n"] for r in sizes) == 10_000       # 10,000 rows by 500, not one for each date
    assert all(r["n"] < 1000 for r in sizes)
    assert all(a["hi"] < b["lo"] for a, b in zip(sizes, sizes[1:]))
    again = CUT.order_cuts(df.repartition(7), "k", ["d", "id"], hot, rows_per_segment=500)
    assert [r["_cuts"] for r in again.collect()] == [r["_cuts"] for r in cuts.collect()]


def test_segment_of_many_groups(spark):
    """More cuts than one group holds."""
    df = spark.range(60_000).select(F.lit(1).alias("k"), "id")
    cuts = CUT.order_cuts(df, "k", ["id"], spark.createDataFrame([(1, 60_000)], "k INT, _rows BIGINT"), rows_per_segment=100)
    flat = sorted(c["id"] for g in cuts.first()["_cuts"] for c in g)
    assert len(flat) > 2 * CUT.GROUP
    got = df.crossJoin(F.broadcast(cuts)).select("id", CUT.segment_of(["id"]).alias("s")).collect()
    assert all(r["s"] == bisect.bisect_right(flat, r["id"]) for r in got)


def test_windows_with_sampled_cuts_equal_plain_ones(spark):
    df = hot_history(spark)
    specs = {"prev": ("lag", "v"), "next": ("lead", "v"), "run": ("running_sum", "v"), "mov": ("moving_sum", "v", 3), "movn": ("moving_count", "v", 3),
             "first": ("first", "v"), "known": ("last_known", "v"), "n": ("row_number", None)}
    plain = WIN.plain_window(df, ["k"], ["d", "id"], specs)
    cut = WIN.skew_safe_window(df, ["k"], ["d", "id"], None, specs, hot_fraction=0.1, sample_fraction=1.0, rows_per_segment=500)
    assert cut.columns == plain.columns
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0


def test_sessions_with_sampled_cuts(spark):
    ev = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("u"),
                                  F.timestamp_seconds((F.col("id") * 7919) % 400_000).alias("ts"), "id")
    whole = WIN.sessionize(ev, "u", "ts", "id", 600, F.to_date("ts"), force_segmented=True)
    cut = WIN.sessionize(ev, "u", "ts", "id", 600, hot_fraction=0.05)
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def pairs(points, spans):
    return sorted((p, s) for p, t, k in points for s, lo, hi, g in spans if None not in (t, lo, hi) and lo <= t <= hi and (k is None or k == g))


@pytest.mark.parametrize("keyed", [True, False])
def test_intervals_equal_plain(spark, keyed):
    rng = random.Random(5)
    points = [(i, rng.choice([None, *[rng.randrange(-5000, 5000)] * 9]), rng.choice("abc") if keyed else None) for i in range(400)]
    spans = [(i, lo := rng.randrange(-5000, 5000), rng.choice([None, lo - 1, lo, lo, lo + 1, lo + rng.randrange(64), lo + rng.randrange(9000)]), rng.choice("abc")) for i in range(200)]
    p = spark.createDataFrame(points, "p INT, t BIGINT, k STRING").select("p", "t", *["k"] * keyed)
    s = spark.createDataFrame(spans, "s INT, lo BIGINT, hi BIGINT, k STRING").select("s", "lo", "hi", *["k"] * keyed)
    got = TJ.interval_join(p, s, "t", "lo", "hi", on=["k"] if keyed else [])
    assert sorted((r["p"], r["s"]) for r in got.collect()) == pairs(points, spans)


def test_interval_candidates_stay_near_the_matches(spark):
    """No nested loop, two bins at most for an interval of any length, and few pairs that do not match."""
    p = spark.range(4000).select(F.col("id").alias("p"), (F.col("id") * 977 % 1_000_000).alias("t"))
    s = spark.range(600).select(F.col("id").alias("s"), (F.col("id") * 1663).alias("lo"), (F.col("id") * 1663 + F.pow(2, F.col("id") % 14).cast("bigint")).alias("hi"))
    got = TJ.interval_join(p, s, "t", "lo", "hi")
    plan = explain_text(got)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    matches = got.count()
    spans = s.withColumns({"_lo": F.col("lo"), "_hi": F.col("hi")}).withColumn("_level", F.length(F.bin(F.col("_hi") - F.col("_lo"))))
    bins = spans.withColumn("_bin", F.explode(F.sequence(TJ._bin(F.col("_lo"), F.col("_level")), TJ._bin(F.col("_hi"), F.col("_level")))))
    assert bins.groupBy("s").count().agg(F.max("count")).first()[0] <= 2
    levels = spans.select("_level").distinct()
    candidates = p.crossJoin(F.broadcast(levels)).withColumn("_bin", TJ._bin(F.col("t"), F.col("_level"))).join(bins, ["_level", "_bin"]).count()
    assert matches <= candidates <= 5 * matches


def test_interval_types_must_agree(spark):
    p = spark.sql("SELECT 1 AS p, TIMESTAMP '2024-01-01 00:00:00' AS t")
    with pytest.raises(TypeError):
        TJ.interval_join(p, spark.sql("SELECT 1 AS s, DATE '2024-01-01' AS lo, DATE '2024-01-02' AS hi"), "t", "lo", "hi")
    with pytest.raises(TypeError):
        TJ.interval_join(p.selectExpr("p", "1.5D AS t"), spark.sql("SELECT 1 AS s, 1D AS lo, 2D AS hi"), "t", "lo", "hi")

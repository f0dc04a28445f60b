import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeforge.llm import hard_negatives
from lakeforge.llm.queries import op12_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, score double, rank int, norm double, cell int, anchor string, vector int"


def brute(rows, scale=256):
    """``rows``: (id, components, label), labels final; anchors are ids divisible by 50."""
    ok = []
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(scale * float(np.float32(x))) for x in v]
        if math.sqrt(sum(x * x for x in v)) <= 2**31:
            ok.append((i, v, y))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in sorted({i for i, *_ in ok if i % 50 == 0}):
        _, v, y = max((r for r in ok if r[0] == a), key=lambda r: (r[2], r[1]))
        others = sorted(((-dot(v, w), i, z) for i, w, z in ok if i != a), key=lambda r: r[:2])
        for p, pid, _ in [r for r in others if r[2] == y][:5]:
            p = -p
            near = [(-s, i) for s, i, z in others if z != y and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(a, pid, k + 1, i, p, s) for k, (s, i) in enumerate(near)]
    return sorted(out)


def flipped(rows):
    return [(i, v, (y + 1) % 10 if i is not None and y is not None and i % 7 == 0 else y) for i, v, y in rows]


def mined(spark, rows, tmp_path):
    wide = [(i, v, y, "x", 0.5, 1, None, 3, None, 9) for i, v, y in rows]
    spark.createDataFrame(wide, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(map(tuple, op12_hard_negatives(spark, str(tmp_path)).collect()))


def test_query_equals_brute_force_on_odd_rows(spark, tmp_path):
    rng = random.Random(4)
    vec = lambda n=6: [rng.gauss(0, 0.4) for _ in range(n)]
    same = vec()
    rows = [(i, vec(), rng.randrange(4)) for i in range(400)]
    rows += [(400 + i, same, i % 3) for i in range(60)]                       # ties
    rows += [(500, vec(), None), (550, None, 1), (None, vec(), 1), (None, None, None), (601, [0.1, None, 0.2], 1), (602, [float("nan")] * 6, 1),
             (650, [float("inf")] * 6, 2), (651, [3e38] * 6, 2), (700, [], 1), (701, [0.0] * 6, 1), (750, vec(3), 2), (751, vec(9), 2), (800, [1e5] * 6, 3), (801, [9e4] * 6, 1)]
    rows += [rows[7], rows[7], rows[50], (50, vec(), 2)]                      # repeated rows and anchors
    got = mined(spark, rows, tmp_path)
    assert got == brute(flipped(rows)) and len(got) > 50


def test_large_and_negative_scores_stay_exact(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(0, 4e6) for _ in range(3)], rng.randrange(3)) for i in range(150)]
    rows += [(200 + i, [-0.5, float(i)], 4) for i in range(2)]
    assert mined(spark, rows, tmp_path) == brute(flipped(rows))


def test_empty_and_one_label(spark, tmp_path):
    assert mined(spark, [], tmp_path / "none") == []
    assert mined(spark, [(i, [1.0, i / 9], 3) for i in range(1, 60) if i % 7], tmp_path / "one") == []


@pytest.mark.parametrize("references, block, sample", [(0, 4096, 64), (3, 2, 64), (40, 3, 4000)])
def test_any_directions_and_blocks_give_the_same(spark, references, block, sample):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(j == i % 5, 0.3) for j in range(5)], rng.randrange(3)) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, references=references, block=block, sample=sample)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_bounds_hold_and_leave_rows_out():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 8))
    vectors = np.floor(256 * (centres[rng.integers(0, 6, 900)] + rng.normal(scale=0.05, size=(900, 8)))).astype(np.int64)
    norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    refs = hard_negatives._directions(vectors.astype(float), norms, 6)
    rows = hard_negatives.Rows(np.arange(900), np.zeros(900, int), vectors, norms, hard_negatives._angles(vectors.astype(float), norms, refs))
    a, tile = rows.take(slice(0, 40)), rows.take(slice(40, 900))
    scores = hard_negatives._scores(a, tile)
    lo, hi = hard_negatives._row_bounds(a, tile)
    assert (lo <= scores).all() and (scores <= hi).all()
    low, high = hard_negatives._tile_bounds(a, tile)
    assert (low[:, None] <= scores).all() and (scores <= high[:, None]).all()
    best = np.sort(scores, axis=1)[:, -5]
    assert (hi >= best[:, None]).mean() < 0.5                                # most rows need no score


def test_rows_out_of_bounds_get_no_score(monkeypatch):
    """What the bounds leave out is never scored, and the rest is."""
    scored = []
    plain = hard_negatives._scores
    monkeypatch.setattr(hard_negatives, "_scores", lambda a, x: scored.append((a.ids.tolist(), x.ids.tolist())) or plain(a, x))
    vectors = np.array([[256, 0], [250, 10], [0, 256], [-256, 0]])
    norms = np.sqrt((vectors**2).sum(axis=1))
    rows = hard_negatives.Rows(np.arange(4), np.zeros(4, int), vectors, norms, hard_negatives._angles(vectors, norms, np.eye(2)))
    got = hard_negatives._search(rows, rows, np.array([0]), np.full(4, 60_000.0), np.full(4, np.inf))
    assert scored == [([0], [0, 1])] and got[1].tolist() == [0, 1]
    assert hard_negatives._search(rows, rows, np.array([3]), np.full(4, 1e9), np.full(4, np.inf)) is None

"""Targets and flows against plain computations; what the mix takes."""

import random
from itertools import product

import pytest
from lakeforge.llm import mixing as M
from pyspark.sql import functions as F


def slow_targets(sizes, weights, total, cap):
    """Share, cap those above, share the rest again."""
    capped = set()
    while True:
        left = total - sum(cap * sizes[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        goal = [cap * sizes[i] if i in capped else weights[i] * left / w for i in range(len(sizes))]
        more = {i for i in range(len(sizes)) if i not in capped and goal[i] > cap * sizes[i] + 1e-9}
        if not more:
            return goal
        capped |= more
        if len(capped) == len(sizes):
            return [cap * s for s in sizes]


def test_targets():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 5, 100, 3000]) for _ in range(rng.randint(1, 8))]
        weights = [float(i % 3 + 1) for i in range(len(sizes))]
        got = M.targets(sizes, weights, sum(sizes), 3)
        assert got == pytest.approx(slow_targets(sizes, weights, sum(sizes), 3))


def test_flow_fills_quotas_at_least_cost():
    """Against all integer flows of a small problem."""
    rng = random.Random(2)
    for _ in range(60):
        patterns = [(m, rng.randint(0, 3)) for m in rng.sample([(0,), (1,), (0, 1)], rng.randint(1, 3))]
        quotas = [rng.randint(0, 7), rng.randint(0, 7)]
        flow = M.route(patterns, quotas, 3)
        edges = [(p, s) for p, (m, _) in enumerate(patterns) for s in m]

        def cost(amounts):
            use = [sum(a for (p, _), a in zip(edges, amounts) if p == k) for k in range(len(patterns))]
            got = [sum(a for (_, s), a in zip(edges, amounts) if s == k) for k in range(2)]
            if any(u > 3 * w for u, (_, w) in zip(use, patterns)) or any(g > q for g, q in zip(got, quotas)):
                return None
            spent = sum(r * min(max(u - r * w, 0), w) for u, (_, w) in zip(use, patterns) for r in range(3))
            return -sum(got), spent

        best = min(c for c in (cost(a) for a in product(range(8), repeat=len(edges))) if c)
        assert cost([flow[p][s] for p, s in edges]) == best


def sized(rng, n, sources):
    return [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(sources)) for i in range(n)]


def test_single_source(spark):
    rng = random.Random(3)
    rows = sized(rng, 900, ["a"] * 9 + ["b", "c", "é", None])
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = M.mix_single(df, "source", lambda i, _: i % 3 + 1).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(900))
    names = ["a", "b", "c", "é", None]
    words = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in names}
    goal = dict(zip(names, slow_targets([words[s] for s in names], [1, 2, 3, 1, 2], sum(words.values()), 3)))
    taken = dict.fromkeys(names, 0)
    for r in got:
        _, text, s = rows[r["doc_id"]]
        assert r["size"] == len(text.split()) and r["source_size"] == words[s] and r["target"] == pytest.approx(goal[s])
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 31 for s in names)
    again = M.mix_single(df.repartition(3), "source", lambda i, _: i % 3 + 1).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_overlapping_sources(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice([["a"], ["b"], ["a", "b"], ["b", "c"], [], ["c", None, "c"]])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, sources array<string>")
    got, sources = M.mix(df, F.col("sources"), lambda i, _: 1.0)
    assert [s[0] for s in sources] == ["a", "b", "c", None]
    assert all(flow == pytest.approx(goal, abs=1) for _, _, goal, flow in sources)
    out = {r["id"]: r for r in got.collect()}
    assert len(out) == 600 and all(r["repeats"] <= 3 for r in out.values())
    assert all(out[i]["repeats"] == 0 for i, _, s in rows if not s)
    assert sum(r["size"] * r["repeats"] for r in out.values()) == pytest.approx(sum(s[3] for s in sources), abs=100)


def test_resample(spark, odd, empty):
    rng = random.Random(5)
    rows = sized(rng, 300, ["a"] * 5 + ["b", "c"])
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weights = lambda i, _: i % 3 + 1
    want = {r["doc_id"]: r["taken"] // r["size"] for r in M.mix_single(df, "source", weights).collect() if r["taken"]}
    out = M.resample(df, F.array("source"), weights)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == want
    odd_out = M.resample(odd, F.array("source"), weights)
    assert odd_out.columns == odd.columns
    total = M.mix(odd, F.array("source"), weights)[0].agg(F.sum("repeats")).first()[0]
    assert odd_out.count() == total
    assert M.resample(empty, F.array("source"), weights).count() == 0
    assert M.mix_single(empty, "source", weights).count() == 0

"""Fingerprints, links and components against all pairs."""

import random

import pytest
import xxhash
from lakeforge.llm import simhash as S
from lakeforge.llm.components import components
from pyspark.sql import functions as F


def plain_fingerprint(text, shingle):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    out = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return out - (1 << 64) if out >> 63 else out


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x
    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def all_pairs(fps, bits):
    return [(i, j) for i in range(len(fps)) for j in range(i) if bin((fps[i] ^ fps[j]) & (1 << 64) - 1).count("1") <= bits]


def test_fingerprint(odd):
    for shingle in (1, 3):
        for r in S.fingerprints(odd, shingle=shingle).join(F.broadcast(odd.select(F.col("doc_id").alias("id"), "text")), "id").where("id NOT IN (2)").collect():
            assert r["fp"] == plain_fingerprint(r["text"], shingle)


@pytest.mark.parametrize("bits,segments,bucket", [(0, 1, 64), (1, 2, 64), (2, 2, 64), (2, 2, 0), (2, 2, 3), (2, 3, 64), (3, 2, 64), (3, 2, 0)])
def test_links_connect_all_pairs(spark, bits, segments, bucket):
    rng = random.Random(10 * bits + segments)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        family = [x]
        for _ in range(rng.choice([1, 3, 20])):
            y = rng.choice(family)
            for _ in range(rng.randint(1, 3)):
                y ^= 1 << rng.choice([rng.randrange(64), rng.randrange(32)])
            family.append(y)
        fps |= set(family)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    got = S.links(spark.createDataFrame([(x,) for x in fps], "fp bigint"), bits, segments, bucket).collect()
    at = {x: i for i, x in enumerate(fps)}
    pairs = [(at[r["a"]], at[r["b"]]) for r in got]
    allowed = set(all_pairs(fps, bits))
    assert all((max(p), min(p)) in allowed for p in pairs)
    assert roots(len(fps), pairs) == roots(len(fps), allowed)


def test_components_of_random_and_long_graphs(spark):
    rng = random.Random(2)
    for pairs in ([(i, i + 1) for i in range(150)], [(rng.randrange(200), rng.randrange(200)) for _ in range(140)], [(0, i) for i in range(1, 300)], []):
        want = roots(400, pairs)
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs + [(None, 3)], "a bigint, b bigint"), "a", "b").collect()}
        linked = {x for a, b in pairs if a != b for x in (a, b)}
        assert set(got) == linked and all(got[x] == want[x] for x in linked)


@pytest.mark.parametrize("bucket", [64, 0])
def test_classes_and_dedup_of_odd_rows(odd, bucket):
    rows = [(r["id"], r["fp"]) for r in S.fingerprints(odd).collect()]
    comp = roots(len(rows), all_pairs([fp for _, fp in rows], 2))
    name = {c: min((i for (i, _), d in zip(rows, comp) if d == c and i is not None), default=None) for c in comp}
    want = sorted(str((i, fp, name[c])) for (i, fp), c in zip(rows, comp))
    assert sorted(str(tuple(r)) for r in S.classes(odd, bucket=bucket).collect()) == want
    kept = S.dedup(odd, bucket=bucket)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i in name.values())


def test_empty_table(empty):
    assert S.classes(empty).count() == 0 and S.dedup(empty).count() == 0

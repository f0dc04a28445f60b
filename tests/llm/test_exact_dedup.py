"""Exact dedup against a dictionary of normalised texts."""

import hashlib
import random
from collections import defaultdict

import pytest
from lakeforge.llm import exact_dedup as E

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        first = True
        for i in ids:
            stays = i == keep and first
            first = first and not stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def check(df, share=E.SHARE):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in E.mark(df, share=share).collect()), key=str)
    assert got == expected(rows)
    kept = E.dedup(df, share=share)
    assert kept.columns == df.columns
    assert sorted(str((r["doc_id"], hashlib.sha256((r["text"] or "").translate(LOWER).encode()).hexdigest())) for r in kept.collect()) == sorted(
        str((i, h)) for i, _, _, stays, h in got if stays)


@pytest.mark.parametrize("share", [2, 8, E.SHARE])
def test_random_copies(spark, share):
    rng = random.Random(share)
    texts = [f"Text {i} É" for i in range(40)]
    rows = [(i, "Hot COPY" if rng.random() < 0.35 else rng.choice(texts).swapcase() if rng.random() < 0.2 else rng.choice(texts)) for i in range(400)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), share)


def test_odd_rows(odd, empty):
    check(odd)
    check(odd, share=4)
    assert E.mark(empty).count() == 0 and E.dedup(empty).count() == 0


def test_row_that_stays(odd):
    kept = {(r["doc_id"], r["text"]) for r in E.dedup(odd).collect()}
    assert len([1 for i, t in kept if i == 2]) == 1                    # repeated rows: one of them
    assert not any(i == 1 for i, _ in kept)                            # the larger id stays
    assert sorted(i for i, t in kept if not (t or "")) == [5]          # null and empty are equal


def test_heavy_hitters_are_found_in_many_partitions(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    d = E.decide(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(23), share=16)
    assert [r["group_size"] for r in d.heavy.collect()] == [1000]
    assert d.rows.where("keep.id = 2997").count() == 1000


def test_summary_bound():
    """A summary never overstates, and understates by at most rows / (counters + 1)."""
    import pyarrow as pa
    rng = random.Random(1)
    values = [bytes([min(rng.randrange(60), rng.randrange(60))]) for _ in range(5000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i:i + 100], pa.binary())], ["digest"]) for i in range(0, 5000, 100)]
    got = {k: v for b in E._misra_gries(9)(iter(batches)) for k, v in zip(*(c.to_pylist() for c in b.columns))}
    assert len(got) <= 9
    for v in set(values):
        assert values.count(v) - 500 <= got.get(v, 0) <= values.count(v)

"""Removed bytes against a scan of all windows; transforms against sorted suffixes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from lakeforge.llm import suffix_dedup as S


def plain(rows, length):
    big = 1 << 62
    docs = [(big if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for d, t in docs:
        for p in range(len(t) - length + 1):
            first[t[p:p + length]] = min(first.get(t[p:p + length], big), d)
    out = []
    for d, t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p:p + length]] < d:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, b"\0" + bytes(gone)))
        out.append((None if d == big else d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed, n):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "abcdefgh ", "abcdefghijklmnopqrstuvwxyzé "])
    make = lambda a, z: "".join(rng.choice(alphabet) for _ in range(rng.randint(a, z)))
    pool = [make(5, 150) for _ in range(6)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(pool) if rng.random() < 0.5 else make(0, 90) for _ in range(rng.randint(0, 6)))
        rows.append((rng.choice([i, i, None, 3]), rng.choice(rows)[1] if rows and rng.random() < 0.2 else text))
    return rows


@pytest.mark.parametrize("seed,length,block,hot", [(1, 50, 2000, 4096), (2, 20, 500, 2), (3, 50, 10**6, 0), (4, 10, 300, 5)])
def test_against_plain(spark, seed, length, block, hot):
    rows = passages(seed, 60)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = S.remove_repeats(df, length=length, block_bytes=block, shard_bytes=400, hot=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, length)


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for hot in (4096, 1):
        got = S.remove_repeats(odd, block_bytes=60_000, hot=hot, with_text=True).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == plain(rows, 50)
        assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    assert S.remove_repeats(empty).count() == 0


def rotations(strings):
    out = []
    for n, s in enumerate(strings):
        s = s + b"\0"
        out += [(s[i:] + s[:i], n, i) for i in range(len(s))]
    return out


def shard(strings):
    data = np.concatenate([np.concatenate((np.frombuffer(s, np.uint8) + 1, [0])) for s in strings]).astype(np.uint8)
    return S.shard_transform(data, np.array([len(s) + 1 for s in strings]), 50)


def test_shard_transform():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(20)]
    start, before, left = shard(strings)
    want = sorted(rotations(strings), key=lambda r: r[0] * 60)
    text = b"".join(s + b"\0" for s in strings)
    own = [(s + b"\0")[i:] + (s + b"\0")[:i] for s in strings for i in range(len(s) + 1)]
    assert [own[p] * 60 for p in start] == [r[0] * 60 for r in want]
    assert sorted(left) == list(range(len(text)))
    assert all(own[start[left[r]]][0] == (int(before[r]) - 1 if before[r] else 0) for r in range(len(text)))


@pytest.mark.parametrize("rounds", [1, 5, 50])
def test_merge_finds_repeated_intervals_and_common_prefixes(rounds):
    rng = random.Random(rounds)
    groups = [[bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 70))) for _ in range(rng.randint(1, 5))] for _ in range(4)]
    groups[1].append(groups[0][0] + b"a")
    interleave, edge, common = S.merge([shard(g) for g in groups], rounds)
    rows = []
    for g in groups:
        own = [(s + b"\0")[i:] + (s + b"\0")[:i] for s in g for i in range(len(s) + 1)]
        rows += [(own[p] * 60)[:rounds] for p in shard(g)[0]]
    count = Counter(rows)
    assert sorted(interleave) == [r for r in range(len(rows)) if count[rows[r]] > 1]
    ordered = [rows[r] for r in interleave]
    assert ordered == sorted(ordered)
    assert [bool(e) for e in edge] == [i == 0 or ordered[i] != ordered[i - 1] for i in range(len(ordered))]
    ranked = sorted(range(len(rows)), key=lambda r: rows[r])
    same = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), rounds)
    near = [same(rows[a], rows[b]) for a, b in zip(ranked, ranked[1:])]
    for k, r in enumerate(ranked):
        assert common[r] == max(near[k - 1] if k else 0, near[k] if k < len(near) else 0)

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lakeforge.llm import periodic
from lakeforge.llm.queries import op11_periodic_runs


def brute(w, least=6):
    """Every run, by looking at each period and stretch."""
    out = []
    for q in range(1, len(w)):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, n = i - q, j - i + q
            if n >= max(least, 4 * q) and not any(all(w[k] == w[k - p] for k in range(s + p, s + n)) for p in range(1, q)):
                out.append((s, n, q))
            i = j
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def tailed(doc_id, text):
    """Words of a document as the query sees them."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digest_row(doc_id, text):
    w = tailed(doc_id, text)
    runs = brute(w)
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(w, runs)))


def repeated(rng, letters, size):
    w = []
    while len(w) < size:
        block = [rng.choice(letters) for _ in range(rng.randrange(1, 12))]
        w += block * rng.randrange(1, 9) + block[:rng.randrange(len(block) + 1)]
        w += [rng.choice(letters) for _ in range(rng.randrange(8))]
    return w


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghijklmnop"])
def test_runs_equal_brute_force(letters):
    rng = random.Random(len(letters))
    hashes = dict(zip(letters, np.random.default_rng(3).integers(1, 2**62, len(letters)).astype(np.uint64)))
    for _ in range(150):
        rows = [repeated(rng, letters, rng.randrange(90)) for _ in range(rng.randrange(1, 5))]
        words = np.array([hashes[x] for w in rows for x in w], np.uint64)
        got = periodic.runs_of(words, np.cumsum([0] + [len(w) for w in rows]), 6)
        assert [got.get(r, []) for r in range(len(rows))] == [brute(w) for w in rows]


def test_a_text_of_one_word_takes_one_diagonal():
    words = np.full(200_000, 7, np.uint64)
    first = np.array([0, len(words)])
    assert periodic.runs_of(words, first, 6) == {0: [(0, 200_000, 1)]}
    row, room = np.zeros(len(words), np.int64), np.arange(len(words), 0, -1)
    last, lag, _ = periodic._occurrences(words, row, room)
    assert len(last) < len(words) and set(lag.tolist()) == {1}


def test_runs_inside_and_across_each_other():
    inner = "x x x x x x y z".split()
    w = inner * 4 + "q r q r q r q r q".split()
    hashes = {x: np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64) for i, x in enumerate("xyzqr")}
    got = periodic.runs_of(np.array([hashes[x] for x in w]), np.array([0, len(w)]), 6)
    assert got[0] == brute(w) and (0, 32, 8) in got[0] and (0, 6, 1) in got[0] and len(got[0]) == 6


def test_find_on_odd_rows(spark, odd):
    got = periodic.find(odd).collect()
    given = [(r.doc_id, r.text) for r in odd.collect()]
    assert len(got) == len(given)
    by_id = {}
    for i, t in given:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = brute(w) if len(w) < 2000 else []
        by_id.setdefault(i, []).append((len(w), [(r[0], r[1], r[2]) for r in runs], collapsed(w, runs).encode()))
    for r in got:
        assert (r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed)) in by_id[r.id]


def test_empty_table_and_arguments(spark, empty):
    assert periodic.find(empty).count() == 0
    with pytest.raises(ValueError):
        periodic.find(empty, min_length=5)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(repeated(rng, "abcdef", rng.randrange(60)))) for i in range(120)]
    rows += [(i, rng.choice([" ", "\n", "\t \x0b"]).join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(150)))) for i in range(120, 260)]
    rows += [(300 + i, t) for i, t in enumerate([None, "", " \n", "é", "ä ö ä ö ä ö ä ö", "a b " * 9])] + [(None, "k " * 8), (7, "same " * 7), (7, "same " * 7)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[6])
    assert sorted(got, key=key) == sorted((digest_row(i, t) for i, t in rows), key=key)
    assert sum(r[1] > 0 for r in got) > 40


def test_query_equals_brute_force_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    small = {r.doc_id: r.text for r in docs if len(r.text or "") < 4000}
    got = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, sf).collect()}
    assert len(got) == len(docs) and len(small) > 100
    for i, t in small.items():
        assert got[i] == digest_row(i, t)

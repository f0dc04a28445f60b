"""Base spans against plain scans; the battery on made-up tokens."""

import math
import random
import re

import numpy as np
import pytest
from lakeforge.llm import secrets as S

ASSIGN = r"""(?a:(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)))"""


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def random_token(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def test_base_spans(spark):
    rng = random.Random(4)
    parts = ["password: hunter22 ", "PassWD='abc'", "api_key=\"ABCDEF123\"", "apikey = x", "Secret:a.b-c_d/e", "AKIA" + "Z9" * 8, "AKIAabc", "AKIA" + "Q" * 15,
             "deadbeef" * 3, "deadbee" * 3, "ſecret: abcdefgh", "toKen=é", "\n", " ñ ", "token=token=abcdef", "0123456789abcdef01234567G"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(300)] + [(300, None), (301, "f" * 200_000)]
    texts = dict(rows)
    got = S.scan(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = base(texts[r["id"]])
        assert [tuple(s) for s in r["base"]] == want
        assert set(want) <= {tuple(s) for s in r["found"]}
        assert [tuple(s) for s in r["found"]] == sorted(tuple(s) for s in r["found"])


def test_random_tokens_pass_and_words_do_not(spark):
    rng = random.Random(8)
    keys = [random_token(rng, B64, 40) + "a9Z" for _ in range(40)]
    plain = ["src/main/java/org/example/service2/impl", "AbstractSingletonProxyFactoryBean2Impl", "2024-01-01-2024-01-02-2024-01-03-2024", "aaaaaaaaaa1111111111aaaaaaaaaa1111111111",
             "theverylongwordwithoutanyspaces", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"] * 7
    rows = [(i, f"see {t} there") for i, t in enumerate(keys + plain)]
    got = {r["id"]: [s["k"] for s in r["found"]] for r in S.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    found = [3 in got[i] for i in range(len(rows))]
    assert sum(found[:len(keys)]) >= 0.9 * len(keys)
    assert sum(found[len(keys):]) == 0


def test_tokens_inside_paths_and_of_one_case(spark):
    """Tokens in runs that no alphabet holds, behind words, beside base spans, and of letters alone."""
    rng = random.Random(21)
    word = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    frames = [("https://host.com/reset-password/", word, 40, "/x"), ("org/repo_name/", word, 40, ""), ("see src/main/java/example/resources/", word, 40, "/end"),
              ("https://host.com/a/", word + "-_", 43, "/b+c"), ("get deadbeefdeadbeefdeadbeef/", word, 40, ""), ("key ", B64[:26], 20, " end")]
    rows, want = [], {}
    for i in range(240):
        before, alphabet, n, after = frames[i % len(frames)]
        key = "k" + random_token(rng, alphabet, n - 2) + "Z" if "-" in alphabet else random_token(rng, alphabet, n)
        rows.append((i, before + key + after))
        want[i] = (len(before), len(before) + n)
    got = {r["id"]: [tuple(s) for s in r["found"]] for r in S.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    covered = [any(k == 3 and a <= want[i][0] and z >= want[i][1] for a, k, z in got[i]) for i in range(240)]
    for f in range(len(frames) - 1):
        assert sum(covered[f::len(frames)]) >= 32, frames[f]
    # their lack of digits counts against letters alone
    assert sum(covered[5::len(frames)]) >= 10
    for spans in got.values():
        assert all(a[2] <= b[0] for a, b in zip(spans, spans[1:]))


def test_p_values_are_about_uniform_under_the_hypothesis():
    rng = random.Random(1)
    for name, alphabet in (S.ENCODINGS[0], S.ENCODINGS[5], S.ENCODINGS[6]):
        for n in (24, 40, 200):
            p = [S.randomness(random_token(rng, alphabet, n), alphabet) for _ in range(400)]
            assert sum(x < 0.05 for x in p) < 48, (name, n)


def test_step_up():
    """Against the textbook procedure on the rounded p-values."""
    rng = random.Random(3)
    steps = [int(rng.expovariate(0.04)) for _ in range(300)]
    counts = [(1, s, steps.count(s)) for s in set(steps)]
    limit = S.findings(counts, 0.1).get(1)
    p = sorted(10 ** (-s / S.STEPS) for s in steps)
    k = max((i + 1 for i, x in enumerate(p) if x <= 0.1 * (i + 1) / len(p)), default=0)
    assert sum(s >= limit for s in steps) == k if limit is not None else k == 0


def pairs_of(texts):
    """Neighbours inside runs of under 20 letters and digits, by regular expression."""
    out = {}
    for t in texts:
        for run in re.findall("[A-Za-z0-9]+", t or ""):
            for a, b in zip(run, run[1:]) if len(run) < 20 else ():
                out[a, b] = out.get((a, b), 0) + 1
    return out


def test_model_counts_equal_plain(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abzAZ09 .-é\n") * rng.choice([1, 1, 1, 8]) for _ in range(rng.randrange(80))) for _ in range(200)] + [None, "", "x", "y" * 19, "y" * 20, "ab"]
    counts = np.zeros((len(S.SYMBOLS),) * 2)
    for (a, b), n in pairs_of(texts).items():
        counts[S.SYMBOLS.index(a), S.SYMBOLS.index(b)] = n
    got = S.learn(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    assert np.allclose(got, S.spelling(counts))
    assert np.allclose(np.exp(got).sum(axis=1), 1) and np.allclose(np.exp(S._prior()).shape, got.shape)


def test_p_values_of_word_like_tokens_are_valid():
    """Of tokens spelled by the model itself, at most a share p has a p-value of p."""
    rng = np.random.default_rng(3)
    model = S.spelling(np.zeros((len(S.SYMBOLS),) * 2))
    cum = np.exp(model).cumsum(axis=1)
    alphabet = S.ENCODINGS[6][1]
    p = []
    for _ in range(3000):
        s = [0]
        while len(s) < 24:
            s.append(min(int(np.searchsorted(cum[s[-1]], rng.random())), len(S.SYMBOLS) - 1))
        p.append(math.exp(S.word_likeness("".join(S.SYMBOLS[i] for i in s).translate(str.maketrans("-_", "+/")), alphabet, model)))
    for bound in (0.2, 0.05, 0.01):
        assert np.mean(np.array(p) <= bound) <= bound


def identifiers():
    """Source text with names of all kinds."""
    import argparse
    import email.message
    import http.client
    import logging.handlers
    import unittest.mock
    from pathlib import Path
    from pyspark.sql import dataframe, functions, types
    modules = (argparse, email.message, http.client, logging.handlers, unittest.mock, dataframe, functions.builtin, types)
    return [part for m in modules for part in Path(m.__file__).read_text().split("\n\n")]


def prose(rng, n):
    parts = ["an", "the", "or", "ti", "sh", "ea", "lo", "mun", "ka", "reading", "Ver", "ing"]
    return [" ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(20, 120))) for _ in range(n)]


LENGTHS = (20, 24, 32, 48)


@pytest.mark.parametrize("kind", ["identifiers", "prose"])
def test_reported_spans_are_keys(spark, kind):
    """Keys planted in text: nearly all are found at each length, and of the
    spans reported no more than the rate are names or words."""
    rng = random.Random(17)
    texts, want = identifiers() if kind == "identifiers" else prose(rng, 900), {}
    rows = list(enumerate(texts))
    for i in rng.sample(range(len(rows)), 200):
        n = LENGTHS[len(want) % len(LENGTHS)]
        key = random_token(rng, B64[:62], n)
        rows[i] = (i, f"{rows[i][1]} {key} end")
        want[i] = (len(texts[i]) + 1, len(texts[i]) + 1 + n)
    got = {r["id"]: [tuple(s) for s in r["found"]] for r in S.scan(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}
    found = {n: [any(k == 3 and a <= x and z >= y for a, k, z in got[i]) for i, (x, y) in want.items() if y - x == n] for n in LENGTHS}
    assert all(np.mean(f) >= 0.9 for f in found.values()), {n: np.mean(f) for n, f in found.items()}
    spans = [(i, a, z) for i, x in got.items() for a, k, z in x if k == 3]
    false = [(i, a, z) for i, a, z in spans if i not in want or z <= want[i][0] or a >= want[i][1]]
    assert len(false) <= 0.05 * len(spans), [dict(rows)[i][a:z] for i, a, z in false]


def test_odd_rows(odd, empty):
    got, given = S.scan(odd).collect(), odd.select("doc_id", "text").collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r["id"], [tuple(s) for s in r["base"]]) for r in got), key=key) == sorted(((r.doc_id, base(r.text)) for r in given), key=key)
    assert all(r["found"] == r["base"] for r in got)                 # words, repeats and empty texts hold no key
    assert S.scan(empty).count() == 0

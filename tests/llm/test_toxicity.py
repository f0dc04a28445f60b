"""Features against plain n-grams; held-out accuracy on planted words."""

import random

import numpy as np
from lakeforge.llm import toxicity as X
from pyspark.sql import functions as F

BAD = ["grubbler", "snortface", "wretchling", "plonker"]


def make(spark, n, seed):
    rng = random.Random(seed)
    syllables = ["an", "the", "or", "ti", "sh", "ea", "lo", "mun", "ré", "ka"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(30, 200))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        docs.append((i, " ".join(words).capitalize()))
        if rng.random() < 0.9:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = make(spark, 1500, 3)
    fold = F.col("doc_id") % 5
    model = X.fit(docs, labels, use=fold != 0)
    got = {r["id"]: r["score"] for r in X.score(docs, model).collect()}
    held = [(got[r["doc_id"]], r["toxic"]) for r in labels.where(fold == 0).collect()]
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    assert sum(s >= 0.5 for s in toxic) >= 0.9 * len(toxic)
    assert sum(s < 0.5 for s in clean) >= 0.98 * len(clean)
    assert all(0 <= s <= 1 for s in got.values())


def test_labels_outside_the_fold_do_not_matter(spark):
    docs, labels = make(spark, 300, 4)
    fold = F.col("doc_id") % 5
    flipped = labels.withColumn("toxic", F.when(fold == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (X.fit(docs, x, use=fold != 0) for x in (labels, flipped))
    assert np.array_equal(a.features, b.features) and np.array_equal(a.effect, b.effect) and a.intercept == b.intercept


def test_features_of_rows():
    texts = ["Abcdé", "", "ab", "éñü abcde ABCDE", "xyz"]
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
    row, feature, times = X.held(np.frombuffer(b"".join(raw), np.uint8), off, None)
    for i, t in enumerate(texts):
        t = "".join(c.lower() if c.isascii() else c for c in t)
        grams = {t[p:p + n] for n in X.GRAMS for p in range(len(t) - n + 1)}
        alone = X.held(np.frombuffer(raw[i], np.uint8), np.array([0, len(raw[i])]), None)[1] if raw[i] else np.zeros(0)
        assert (row == i).sum() == len(grams) == len(alone)
        assert set(feature[row == i]) == set(alone)
        assert times[row == i].sum() == sum(max(0, len(t) - n + 1) for n in X.GRAMS)


def test_few_labels(spark, odd, empty):
    labels = lambda *rows: spark.createDataFrame(list(rows), "doc_id bigint, toxic int")
    scores = lambda docs, known: [r["score"] for r in X.score(docs, X.fit(odd, known)).collect()]
    assert scores(odd, labels()) == [0.0] * odd.count()
    assert scores(odd, labels((1, 0), (3, None), (None, 1), (6, 7))) == [0.0] * odd.count()
    assert all(s == 1 for s in scores(odd, labels((1, 1))))
    some = scores(odd, labels((1, 1), (1, 0), (3, 0), (6, 0), (9, 1), (10, 0)))
    assert len(some) == odd.count() and all(0 <= s <= 1 for s in some)
    assert scores(empty, labels((1, 1), (6, 0))) == []
    assert X.fit(empty, labels((1, 1), (6, 0))).features.size == 0


def plain_scores(rows, known, features, alpha=1.0, penalty=1.0):
    """The module's docstring by loops and dense algebra: scores by id."""
    def grams(text):
        t = "".join(c.lower() if c.isascii() else c for c in text or "")
        out = {}
        for n in X.GRAMS:
            for p in range(len(t) - n + 1):
                h = 0
                for k, c in enumerate(t[p:p + n]):
                    code = (ord(c) + 1) * int(X._SPREAD) % 2**64
                    h = code if k == 0 else (h * int(X._BASE) + code) % 2**64
                f = (h * int(X._SPREAD) % 2**64) >> (64 - X.BITS)
                out[f] = out.get(f, 0) + 1
        return out

    held = {i: grams(t) for i, t in rows}
    y = np.array([known[i] for i in sorted(known)], float)
    toxic, other = y.sum(), len(y) - y.sum()
    seen = {}
    for i in sorted(known):
        for f in held[i]:
            seen.setdefault(f, [0, 0])[known[i]] += 1
    chi = lambda f: (seen[f][1] * other - seen[f][0] * toxic) ** 2 / (sum(seen[f]) * (toxic + other - sum(seen[f]) + 1))
    kept = sorted((f for f in seen if sum(seen[f]) >= 3), key=lambda f: (-chi(f), f))[:features]
    ratio = np.array([np.log((seen[f][1] + alpha) / (toxic + 2 * alpha)) - np.log((seen[f][0] + alpha) / (other + 2 * alpha)) for f in kept])
    values = lambda i: np.array([r * np.log2(1 + held[i].get(f, 0)) for f, r in zip(kept, ratio)])
    design = np.hstack([np.stack([values(i) for i in sorted(known)]), np.ones((len(y), 1))])
    w = np.zeros(design.shape[1])
    ridge = np.diag([penalty] * len(kept) + [0.0])
    for _ in range(200):                         # damped Newton to the optimum
        p = 1 / (1 + np.exp(-design @ w))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(len(w)), design.T @ (y - p) - ridge @ w)
        w += step / max(1, np.abs(step).max())
    return {i: float(1 / (1 + np.exp(-(values(i) @ w[:-1] + w[-1])))) for i, _ in rows}


def test_scores_equal_a_plain_version(spark):
    """Selection, ratios, regression and scores, end to end."""
    docs, labels = make(spark, 160, 12)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(900, None), (901, ""), (902, "ÄB plonker")]
    known = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id % 5}
    all_docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    model = X.fit(all_docs, labels, use=F.col("doc_id") % 5 != 0, features=60)
    got = {r["id"]: r["score"] for r in X.score(all_docs, model).collect()}
    expected = plain_scores(rows, known, 60)
    assert set(got) == set(expected)
    assert max(abs(got[i] - expected[i]) for i in got) < 5e-3
    assert [i for i in got if got[i] >= 0.5] and all((got[i] >= 0.5) == (expected[i] >= 0.5) for i in got)


def test_entries_are_bounded(spark):
    """With room for few entries the regression learns from whole texts, fewer of them."""
    docs, labels = make(spark, 300, 5)
    whole, some = X.fit(docs, labels), X.fit(docs, labels, max_entries=20_000)
    assert np.array_equal(whole.features, some.features) and not np.allclose(whole.effect, some.effect)
    again = X.fit(docs.repartition(7), labels, max_entries=20_000)
    assert np.array_equal(some.effect, again.effect)

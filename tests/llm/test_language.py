import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeforge.llm import language
from lakeforge.llm.queries import op13_language

SOUNDS = {"aa": "ba be bi lo la lu".split(), "bb": "krx zok vrr tzk okk xor".split(), "cc": "éli ñor çou üne ßer ölä".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    langs = ["aa"] * 6 + ["bb"] * 3 + ["cc"]
    rows = [(i, text(rng, lang := rng.choice(langs), rng.randrange(3, 80)), lang, "s") for i in range(900)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4).cache()


@pytest.fixture(scope="module")
def model(corpus):
    return language.fit(corpus, use=F.col("doc_id") % 3 != 0, max_train=400)


def subwords(s):
    """Codes of the subwords of a text, as the module's docstring says."""
    fold = lambda c: ord(c.lower()) if len(c.lower()) == 1 else ord(c)
    out, word = [], []
    for c in [*s, " "]:
        if c.isalpha():
            word.append(fold(c))
        elif word:
            framed = [0, *word, 0]
            out += [tuple(framed[i:i + n]) for n in language.GRAMS for i in range(len(framed) - n + 1)]
            word = []
    return out


def bucket(gram):
    h = 0
    for c in gram:
        h = (h * 0x9E3779B97F4A7C15 + (c + 1) * 0xD6E8FEB86659FD93) % 2**64
    return (h * 0xD6E8FEB86659FD93 % 2**64) >> (64 - language.BITS)


ODD_TEXTS = ["", "a", "Éa ß", "12 3!", "x" * 50, "İstanbul ŞI", "日本語 と ab", "a-b c", " lead", "trail ", "\n"]


def test_subwords_equal_brute_force():
    raw = [t.encode() for t in ODD_TEXTS]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    got = [Counter() for _ in raw]
    for row, place in language._subwords(data, off):
        assert (np.diff(row) >= 0).all()
        for r, p in zip(row.tolist(), place.tolist()):
            got[r][p] += 1
    assert got == [Counter(map(bucket, subwords(t))) for t in ODD_TEXTS]


def test_scores_equal_brute_force(spark, model, odd):
    rows = odd.select("doc_id", "text").collect()
    got = {}
    for r in language.predict(odd, model).collect():
        got.setdefault(r.id, []).append((r.lang, r.score, r.known, r.accepted))
    for r in rows:
        grams = [bucket(g) for g in subwords(r.text or "")]
        if not grams:
            expected = ("und", 0.0, 0.0, False)
        else:
            z = [(sum(float(model.table[g, k]) for g in grams) / len(grams) + float(model.bias[k])) / model.temperature for k in range(len(model.langs))]
            e = [math.exp(x - max(z)) for x in z]
            known = sum(bool(model.known[g]) for g in grams) / len(grams)
            best = max(e) / sum(e)
            expected = (model.langs[int(np.argmax(e))], best, known, best >= model.min_score and known >= model.min_known)
        assert any(g[0] == expected[0] and g[3] == expected[3] and g[1] == pytest.approx(expected[1]) and g[2] == pytest.approx(expected[2]) for g in got[r.doc_id])
    assert sum(map(len, got.values())) == len(rows)


def test_gradient_steps_equal_a_plain_version():
    """One minibatch by loops over single entries."""
    rng = np.random.default_rng(5)
    n, dim = 6, 4
    places = [np.sort(rng.choice(1 << language.BITS, 5, replace=False)) for _ in range(n)]
    shares = [np.full(5, 0.2) for _ in range(n)]
    data = language.Texts.of([p.astype(np.uint16).tobytes() for p in places], [s.astype(np.float32).tobytes() for s in shares])
    y = np.array([0, 1, 2, 0, 1, 2])
    embed, layer, bias = language.train(data, y, np.arange(n), 3, dim=dim, epochs=1, batch=n, rate=0.5, seed=11)
    again = np.random.default_rng(11)
    e0 = again.normal(scale=0.5, size=(1 << language.BITS, dim)).astype(np.float32)
    w0 = again.normal(scale=0.5, size=(3, dim)).astype(np.float32)
    e1, w1, b1 = e0.astype(float), w0.astype(float), np.zeros(3)
    for p, s, k in zip(places, shares, y):
        x = sum(a * e0[i] for i, a in zip(p, s))
        z = w0 @ x
        g = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        g[k] -= 1
        w1 -= 0.5 / 4 * np.outer(g, x) / n
        b1 -= 0.5 / 4 * g / n
        for i, a in zip(p, s):
            e1[i] -= 0.5 * 2 ** (language.BITS / 2) * a * (g @ w0) / n
    assert np.allclose(embed, e1, atol=1e-4) and np.allclose(layer, w1, atol=1e-5) and np.allclose(bias, b1, atol=1e-5)


def test_held_out_accuracy_and_calibration(corpus, model):
    got = language.predict(corpus.where("doc_id % 3 = 0"), model).join(corpus.select(F.col("doc_id").alias("id"), F.col("lang").alias("true")), "id").collect()
    assert np.mean([r.lang == r.true for r in got]) > 0.98
    kept = [r for r in got if r.accepted]
    assert len(kept) > 0.9 * len(got) and np.mean([r.lang == r.true for r in kept]) >= 0.99
    assert abs(np.mean([r.score for r in got]) - np.mean([r.lang == r.true for r in got])) < 0.05


def test_text_of_no_learned_language_is_rejected(spark, model):
    rows = [(1, "日本語の文章です これは"), (2, "Привет как дела сегодня"), (3, "qwmpf hjsdg ygfdw qwpgh")]
    assert not any(r.accepted for r in language.predict(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect())


def test_temperature_and_least_score():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(4000, 3))
    p = language._softmax(z)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert language._likeliest(3 * z, y, np.ones(4000)) == pytest.approx(3, rel=0.15)
    score, right = np.array([0.9, 0.8, 0.8, 0.7, 0.6]), np.array([True, True, False, True, True])
    assert language._least_score(score, right, np.ones(5), 0.0) == 0.9
    assert language._least_score(score, right, np.ones(5), 0.2) == 0.6
    assert language._least_score(score, ~right, np.ones(5), 0.1) == 2.0


def test_quotas_share_rows_evenly():
    assert language._quotas({"a": 1000, "b": 2, "c": 50, "d": 9000}, 100) == {"a": 33, "b": 2, "c": 32, "d": 33}
    assert language._quotas({"a": 3}, 100) == {"a": 3} and sum(language._quotas({str(i): 9 for i in range(7)}, 20).values()) == 20


def test_rare_languages_are_learned_too(spark):
    rng = random.Random(7)
    rows = [(i, text(rng, "aa" if i % 200 else "bb", 30), "aa" if i % 200 else "bb") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(df, max_train=60)
    assert model.langs == ("aa", "bb")
    got = {(r.id % 200 == 0, r.lang) for r in language.predict(df, model).collect()}
    assert got == {(True, "bb"), (False, "aa")}


def test_nothing_or_one_language_to_learn(spark, empty):
    schema = "doc_id bigint, text string, lang string"
    rows = [(1, "abc", None), (None, "abc", "aa"), (2, None, "aa"), (3, "", "aa")]
    model = language.fit(spark.createDataFrame(rows, schema))
    assert model.langs in ((), ("aa",))
    if not model.langs:
        assert {(r.lang, r.score) for r in language.predict(spark.createDataFrame(rows, schema), model).collect()} == {("und", 0.0)}
    one = language.fit(spark.createDataFrame([(i, "abc de", "aa") for i in range(20)], schema))
    assert [(r.lang, r.score) for r in language.predict(spark.createDataFrame([(1, "xyz"), (1, "xyz")], "doc_id bigint, text string"), one).collect()] == [("aa", 1.0)] * 2
    assert language.predict(empty, one).count() == 0


def test_query_learns_from_its_fold_only(spark, corpus, tmp_path):
    fold = lambda i: zlib.crc32(str(i).encode()) % 3
    rows = [(r.doc_id, r.text, "zz" if fold(r.doc_id) == 1 else r.lang, r.source) for r in corpus.collect()]
    rows += [(None, "abc", "qq", None), (10_000, None, None, "s"), (10_001, "1 2 3", "aa", "s"), (10_002, "ba be bi", None, "s")]
    spark.createDataFrame(rows, corpus.schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op13_language(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got.values()} == {"aa", "bb", "cc", "und"}
    assert all(r.held_out == (i is not None and fold(i) == 1) for i, r in got.items())
    assert got[10_000].lang_pred == got[10_001].lang_pred == "und" and got[10_002].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    got = op13_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98

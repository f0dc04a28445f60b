"""Toxicity: a linear classifier on character n-grams, features scaled by
naive Bayes log-count ratios.

The n-grams (3 to 5 code points, A-Z lower-cased) are hashed to 2^20
features. From a bounded sample of labelled texts:

1. Spark counts for each feature how many toxic and other texts hold it, and
   keeps the ``features`` ones whose presence depends most on the label
   (largest chi-squared).
2. A feature's naive Bayes ratio is the log of the smoothed share of toxic
   texts with it over that of the others. Its value in a text that holds it
   n times is the ratio times log2(1 + n).
3. A logistic regression with an L2 penalty is fitted to these values by
   Newton's method.

The score of a text is the logistic function of the intercept and the sum of
weight x value over the kept n-grams of the whole text.

What reaches the driver is bounded by parameters: ``features`` counts, and at
most ``max_entries`` entries of 4 bytes, one for each kept feature of a text.
The sample is the at most ``max_train`` labelled texts with the smallest
hashed ids; the regression uses as many of them, in that order and whole, as
``max_entries`` holds (20,000 texts of 800 kept features each by default).

Defined results: a null or empty text holds no n-gram; its score is the
intercept's. A null or other label than 0 and 1, or a null id, is not used; a text with
both labels counts as toxic. With labels of one class only, all scores are
that class; without labels, 0. An empty table gives an empty result. Extra
columns do not matter. Rows are scored each by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import _CONTINUED, _LOWER, flat, quoted, save, steps, utf8

GRAMS = (3, 4, 5)
BITS = 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _codes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points, lower-cased, of all rows one after the other, and the rows' starts."""
    upto = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_CONTINUED[data], out=upto[1:])
    codes = np.frombuffer(_LOWER[data].tobytes().decode().encode("utf-32-le"), np.uint32)
    return codes, upto[off]


def held(data: np.ndarray, off: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (row, feature) pairs, by row, and how often each occurs; only
    features marked in ``wanted``."""
    codes, at = _codes(data, off)
    c = (codes.astype(np.uint64) + np.uint64(1)) * _SPREAD
    ends = at[1:]
    found = []
    h = c
    for n in range(2, GRAMS[-1] + 1):
        if len(c) < n:
            break
        h = h[:len(c) - n + 1] * _BASE + c[n - 1:]
        if n not in GRAMS:
            continue
        feature = ((h * _SPREAD) >> np.uint64(64 - BITS)).astype(np.int64)
        ok = np.ones(len(feature), bool) if wanted is None else wanted[feature]
        for k in range(1, n):                    # n-grams that would run into the next row
            cut = ends - k
            cut = cut[(cut >= 0) & (cut < len(ok))]
            ok[cut] = False
        where = np.flatnonzero(ok)
        row = np.searchsorted(ends, where, "right")
        found.append((row << BITS) | feature[where])
    pairs, times = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    return pairs >> BITS, pairs & ((1 << BITS) - 1), times


def _marked(features: np.ndarray) -> np.ndarray:
    wanted = np.zeros(1 << BITS, bool)
    wanted[features] = True
    return wanted


def _count(batches):
    """Texts of each label that hold each feature."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    for b in batches:
        labels = np.asarray(b.column(0).to_pylist(), np.int64)
        data, off = flat(b.column(1))
        for i, j in steps(off):
            row, feature, _ = held(data[off[i]:off[j]], off[i:j + 1] - off[i], None)
            for label in (0, 1):
                counts[label] += np.bincount(feature[labels[i:j][row] == label], minlength=1 << BITS)
    some = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], ["feature", "other", "toxic"])


def _design(features: np.ndarray):
    """Turn, label and entries of each text: the kept features that it holds,
    as 16-bit places, and log2(1 + times) of each, as 16-bit floats."""
    place = np.zeros(1 << BITS, np.uint16)
    place[features] = np.arange(len(features))

    def run(batches):
        wanted = _marked(features)
        for b in batches:
            data, off = flat(b.column(2))
            places, values = [], []
            for i, j in steps(off):
                row, feature, times = held(data[off[i]:off[j]], off[i:j + 1] - off[i], wanted)
                cut = np.searchsorted(row, np.arange(1, j - i))
                places += [x.tobytes() for x in np.split(place[feature], cut)]
                values += [x.tobytes() for x in np.split(np.log2(1 + times).astype(np.float16), cut)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(x) // 2 for x in places], pa.int32()), pa.array(places, pa.binary()), pa.array(values, pa.binary())],
                                             ["turn", "label", "entries", "places", "values"])
    return run


@dataclass(frozen=True)
class Model:
    """``effect`` of each feature (weight x ratio) and the intercept."""
    features: np.ndarray
    effect: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, off: np.ndarray, wanted: np.ndarray, effect: np.ndarray) -> np.ndarray:
        row, feature, times = held(data, off, wanted)
        return self.intercept + np.bincount(row, effect[feature] * np.log2(1 + times), len(off) - 1)


def _logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, n_cols: int, penalty: float, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-penalised logistic regression on a
    sparse design (entries rows, cols, values), by Newton's method with
    conjugate gradients."""
    n = len(y)
    w, b = np.zeros(n_cols), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    times = lambda v: np.bincount(rows, values * v[cols], n)
    back = lambda u: np.bincount(cols, values * u[rows], n_cols)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(times(w) + b, -35, 35)))
        s = np.maximum(p * (1 - p), 1e-6)
        g, gb = back(y - p) - penalty * w, float((y - p).sum())
        # solve (X'SX + penalty) d = g with the intercept as one more column
        x, xb = np.zeros(n_cols), 0.0
        r, rb = g.copy(), gb
        d, db, rr = r.copy(), rb, float(r @ r + rb * rb)
        for _ in range(40):
            if rr < 1e-10:
                break
            u = s * (times(d) + db)
            q, qb = back(u) + penalty * d, float(u.sum())
            step = rr / float(d @ q + db * qb)
            x, xb, r, rb = x + step * d, xb + step * db, r - step * q, rb - step * qb
            new = float(r @ r + rb * rb)
            d, db, rr = r + new / rr * d, rb + new / rr * db, new
        longest = max(1.0, float(np.abs(x).max(initial=0)), abs(xb))
        w, b = w + x / longest, b + xb / longest
        if float(np.abs(x).max(initial=0)) < 1e-4:
            break
    return w, b


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", use: Column | None = None,
        max_train: int = 20_000, features: int = 4096, penalty: float = 1.0, alpha: float = 1.0, max_entries: int = 1 << 24) -> Model:
    """``use``: which rows of ``labels`` may be learned from."""
    if not 0 < features <= 1 << 16:
        raise ValueError("features must fit 16 bits")
    known = labels.where(quoted(label_col).isin(0, 1) & quoted(id_col).isNotNull() & (F.lit(True) if use is None else use))
    known = known.groupBy(quoted(id_col).alias("id")).agg(F.max(quoted(label_col)).cast("int").alias("label"))
    # at most max_train rows
    chosen = known.orderBy(F.xxhash64(F.lit("train"), "id"), "id").limit(max_train)
    texts = docs.select(quoted(id_col).alias("id"), utf8(f"`{text_col}`").alias("text"))
    sample = save(texts.join(F.broadcast(chosen), "id").select(F.xxhash64(F.lit("train"), "id").alias("turn"), "label", "text"), "train")
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    other, toxic = n.get(0, 0), n.get(1, 0)
    if not other or not toxic:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.inf if toxic else -np.inf)
    counts = sample.select("label", "text").mapInArrow(_count, "feature bigint, other bigint, toxic bigint").groupBy("feature").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    seen = F.col("other") + F.col("toxic")
    apart = F.col("toxic") * float(other) - F.col("other") * float(toxic)
    chi2 = apart * apart / (seen * (float(other + toxic) - seen + 1.0))
    best = counts.where(seen >= 3).orderBy(chi2.desc(), "feature").limit(features).collect()
    if not best:
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(toxic / other)))
    chosen_features = np.array([r["feature"] for r in best], np.int64)
    ratio = (np.log((np.array([r["toxic"] for r in best]) + alpha) / (toxic + 2 * alpha))
             - np.log((np.array([r["other"] for r in best]) + alpha) / (other + 2 * alpha)))
    design = save(sample.mapInArrow(_design(chosen_features), "turn bigint, label int, entries int, places binary, values binary"), "design")
    # whole texts in the order of their turn, as many as the driver may hold entries
    sizes = sorted((r["turn"], r["entries"]) for r in design.select("turn", "entries").collect())
    within = int(np.searchsorted(np.cumsum([n for _, n in sizes]), max_entries, "right"))
    if within < len(sizes):
        design = design.where(F.col("turn") < sizes[within][0])
    table = design.select("label", "places", "values").orderBy("turn", "places").toArrow()
    size = np.array([len(x) // 2 for x in table.column("places").to_pylist()], np.int64)
    rows = np.repeat(np.arange(len(size), dtype=np.int32), size)
    cols = np.frombuffer(b"".join(table.column("places").to_pylist()), np.uint16).astype(np.int32)
    logs = np.frombuffer(b"".join(table.column("values").to_pylist()), np.float16).astype(np.float32)
    ratio32 = ratio.astype(np.float32)
    w, b = _logistic(rows, cols, ratio32[cols] * logs, table.column("label").to_numpy().astype(float), len(ratio), penalty)
    return Model(chosen_features, w * ratio, b)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches):
        wanted, effect = _marked(model.features), np.zeros(1 << BITS)
        effect[model.features] = model.effect
        for b in batches:
            data, off = flat(b.column(1))
            parts = [model.scores(data[off[i]:off[j]], off[i:j + 1] - off[i], wanted, effect) for i, j in steps(off)]
            z = np.concatenate(parts) if parts else np.zeros(0)
            with np.errstate(over="ignore"):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-z)))], schema.names)

    return docs.select(quoted(id_col).alias("id"), utf8(f"`{text_col}`").alias("text")).mapInArrow(run, schema)

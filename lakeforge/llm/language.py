"""Language of texts: averaged hashed subword embeddings and a linear softmax,
trained by stochastic gradient descent in numpy, with calibrated rejection.

Letters are lower-cased; whatever lies between two words is one boundary. The
subwords are the n-grams of 2 to 4 codes inside a word with its boundaries,
hashed to 2^14 buckets. A text's vector is the average of the embeddings of
all its subwords; a linear layer and a softmax over it give the languages.

Training, on a bounded sample:

1. Spark picks at most ``max_train`` labelled rows, as evenly by language as
   their numbers allow (a rare language is learned too), each language's by
   smallest hashed id. Tasks count the subwords of the whole texts; a text sends the driver its
   share of each bucket, at most 2^14 pairs of 6 bytes.
2. Four fifths of the sample train embeddings and layer, in minibatches with a
   falling learning rate and a fixed seed.
3. The last fifth calibrates. The temperature of the softmax is the one of the
   greatest likelihood, with rows weighted by their language's share of all
   learnable rows. A text is accepted when its score reaches the smallest
   bound above which at most ``max_error`` of the calibrating rows are wrong,
   and when the share of its subwords that training has seen is not below the
   ``strange`` quantile of theirs: text unlike any learned language is rejected
   however sure the softmax is.

Prediction reads each whole text in Arrow batches: with the embeddings times
the layer as one table, a logit is the mean of the subwords' table entries.

Defined results: a null text or one without a letter is ``und`` with score 0,
not accepted. Other texts get the likeliest learned language, accepted or not;
``und`` with score 0 if none was learned, and score 1 at most if there was only
one. Rows with a null language or id are not learned from. Rows are predicted
each by itself: repeated rows give equal results, an empty table an empty one.
Extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import _CONTINUED, flat, quoted, steps, utf8

GRAMS = (2, 3, 4)
BITS = 14
NONE = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code of every letter, 0 for all other code points."""
    def fold(c: str) -> int:
        small = c.lower()
        return ord(small if len(small) == 1 else c) if c.isalpha() else 0

    return np.fromiter((fold(chr(k)) for k in range(0x110000)), np.uint32, 0x110000)


def _subwords(data: np.ndarray, off: np.ndarray):
    """For each n, the rows and buckets of all subwords, by row."""
    codes = _letters()[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
    upto = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_CONTINUED[data], out=upto[1:])
    at = upto[off]
    row = np.repeat(np.arange(len(off) - 1), np.diff(at))
    codes, row = np.append(np.insert(codes, at[:-1], 0), 0), np.append(np.insert(row, at[:-1], np.arange(len(off) - 1)), len(off) - 2)
    stay = codes > 0
    stay[0] = True
    stay[1:] |= codes[:-1] > 0                   # the first boundary after a letter
    codes, row = codes[stay], row[stay]
    row = np.where(codes[:-1] > 0, row[:-1], row[1:])        # of the first letter in a subword from here
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * _SPREAD
    h, whole = mixed, np.ones(len(codes), bool)
    for n in range(2, GRAMS[-1] + 1):
        if len(codes) < n:
            return
        h = h[:len(codes) - n + 1] * _BASE + mixed[n - 1:]
        whole = whole[:len(h)] if n == 2 else whole[:len(h)] & (codes[n - 2:len(codes) - 1] > 0)
        if n in GRAMS:
            yield row[:len(h)][whole], ((h[whole] * _SPREAD) >> np.uint64(64 - BITS)).astype(np.int64)


def _shares(batches):
    """Label and, as bytes, buckets (16 bits) and shares (32 bits) of each text."""
    for b in batches:
        data, off = flat(b.column(1))
        places, shares = [], []
        for i, j in steps(off):
            found = list(_subwords(data[off[i]:off[j]], off[i:j + 1] - off[i]))
            pairs = np.concatenate([(row << BITS) | bucket for row, bucket in found]) if found else np.zeros(0, np.int64)
            pairs, times = np.unique(pairs, return_counts=True)
            cut = np.searchsorted(pairs >> BITS, np.arange(1, j - i))
            for place, n in zip(np.split(pairs & ((1 << BITS) - 1), cut), np.split(times, cut)):
                places.append(place.astype(np.uint16).tobytes())
                shares.append((n / max(1, n.sum())).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(places, pa.binary()), pa.array(shares, pa.binary())], ["lang", "check", "places", "shares"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Texts:
    """Sparse subword shares of texts, one text after the other."""
    places: np.ndarray
    shares: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(places: list[bytes], shares: list[bytes]) -> Texts:
        size = np.array([len(x) // 2 for x in places], np.int64)
        return Texts(np.frombuffer(b"".join(places), np.uint16).astype(np.int64), np.frombuffer(b"".join(shares), np.float32), np.concatenate(([0], np.cumsum(size))))

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row (from 0), bucket and share of the entries of some texts."""
        size = self.starts[which + 1] - self.starts[which]
        at = np.repeat(self.starts[which] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.repeat(np.arange(len(which)), size), self.places[at], self.shares[at]


def train(texts: Texts, y: np.ndarray, which: np.ndarray, n_langs: int, dim: int = 16, epochs: int = 8, batch: int = 32, rate: float = 4.0,
          seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, layer and bias by stochastic gradient descent on the cross entropy."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(scale=0.5, size=(1 << BITS, dim)).astype(np.float32)
    layer, bias = rng.normal(scale=0.5, size=(n_langs, dim)).astype(np.float32), np.zeros(n_langs, np.float32)
    parts = -(-len(which) // batch)
    for step in range(epochs * parts):
        if step % parts == 0:
            shuffled = np.array_split(rng.permutation(which), parts)
        part = shuffled[step % parts]
        now = np.float32(rate * (1 - step / (epochs * parts)))
        row, place, share = texts.take(part)
        given = np.zeros((len(part), 1 << BITS), np.float32)
        given[row, place] = share
        x = given @ embed
        g = _softmax(x @ layer.T + bias)
        g[np.arange(len(part)), y[part]] -= 1
        g /= len(part)
        # a share is small, about one over the subwords of a text: embeddings take larger steps
        embed -= now * np.float32(2.0 ** (BITS / 2)) * (given.T @ (g @ layer))
        layer -= now / 4 * (g.T @ x)
        bias -= now / 4 * g.sum(axis=0)
    return embed, layer, bias


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    table: np.ndarray                            # bucket x language
    bias: np.ndarray
    known: np.ndarray                            # which buckets training has seen
    temperature: float = 1.0
    min_score: float = 0.0
    min_known: float = 0.0

    def scores(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities, share of known subwords, and number of subwords of each text."""
        n_rows = len(off) - 1
        z, seen, size = np.zeros((n_rows, len(self.langs))), np.zeros(n_rows), np.zeros(n_rows)
        for row, bucket in _subwords(data, off):
            cut = np.searchsorted(row, np.arange(n_rows + 1))
            some = np.flatnonzero(cut[1:] > cut[:-1])
            if len(some):
                sums = lambda v: np.add.reduceat(v, cut[some], dtype=np.float64)
                size[some] += cut[some + 1] - cut[some]
                seen[some] += sums(self.known[bucket])
                for k in range(len(self.langs)):
                    z[some, k] += sums(self.table[:, k][bucket])
        each = np.maximum(size, 1)
        return _softmax((z / each[:, None] + self.bias) / self.temperature), seen / each, size


def _likeliest(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The temperature with the greatest weighted likelihood, by golden section
    on its logarithm. As if one row more were wrong: without any error the
    softmax would else become ever surer."""
    miss = 1 / (len(y) + 1)

    def loss(t: float) -> float:
        p = np.maximum(_softmax(z / np.exp(t)), 1e-300)
        right = np.log(p[np.arange(len(y)), y])
        return float(-(weight * ((1 - miss) * right + miss * np.log(p).mean(axis=1))).sum())

    low, high, gold = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - gold * (high - low), low + gold * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _least_score(score: np.ndarray, right: np.ndarray, weight: np.ndarray, max_error: float) -> float:
    """The smallest score from which on at most ``max_error`` of the weight is wrong; above 1 if there is none."""
    order = np.argsort(-score, kind="stable")
    wrong, all_ = np.cumsum((weight * ~right)[order]), np.cumsum(weight[order])
    last = np.append(score[order][1:] < score[order][:-1], True)     # rows of one score stay together
    good = np.flatnonzero(last & (wrong <= max_error * all_))
    return float(score[order][good[-1]]) if len(good) else 2.0


def _quotas(total: dict[str, int], rows: int) -> dict[str, int]:
    """How many rows of each language to take, as evenly as their numbers allow."""
    out, left = {}, rows
    for k, (lang, n) in enumerate(sorted(total.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(n, left // (len(total) - k))
        left -= out[lang]
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", use: Column | None = None,
        max_train: int = 3000, max_error: float = 0.01, strange: float = 0.002) -> Model:
    """``use``: which rows may be learned from."""
    given = docs.where(quoted(id_col).isNotNull() & quoted(lang_col).isNotNull() & (F.lit(True) if use is None else use))
    rows = given.select(quoted(id_col).alias("id"), quoted(lang_col).cast("string").alias("lang"), quoted(text_col).isNotNull().alias("some")).where("some").drop("some")
    # a language needs one row at least: at most max_train languages, the most frequent ones
    total = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(max_train).collect()}
    if not total:
        return Model((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0), np.zeros(1 << BITS, bool))
    wanted = _quotas(total, max_train)
    quota = docs.sparkSession.createDataFrame([(x, q, total[x]) for x, q in wanted.items()], "lang string, quota int, total bigint")
    # hashed ids are uniform: below the cut there are about half as many rows again as wanted, whatever the size
    hashed = F.pmod(F.xxhash64(F.lit("language"), "id"), F.lit(1 << 40))
    few = rows.join(F.broadcast(quota), "lang").withColumn("place", hashed).where(F.col("place") / float(1 << 40) * F.col("total") < 1.5 * F.col("quota") + 50)
    turn = few.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("place", "id"))).where(F.col("turn") <= F.col("quota"))
    # of rows with one id and language the greatest text is used
    chosen = turn.select("id", "lang", (F.col("turn") % 5 == 0).alias("check")).dropDuplicates(["id", "lang"])
    texts = given.select(quoted(id_col).alias("id"), quoted(lang_col).cast("string").alias("lang"), utf8(f"`{text_col}`").alias("text"))
    sample = texts.join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang", "check").agg(F.max("text").alias("text"))
    got = sample.select("lang", "text", "check").mapInArrow(_shares, "lang string, check boolean, places binary, shares binary").toArrow()
    got = got.filter(pa.compute.greater(pa.compute.binary_length(got.column("places")), 0)).sort_by([("lang", "ascending"), ("places", "ascending"), ("shares", "ascending")])
    langs = tuple(sorted(set(got.column("lang").to_pylist())))
    if not langs:
        return Model((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0), np.zeros(1 << BITS, bool))
    y = np.searchsorted(np.array(langs), np.array(got.column("lang").to_pylist()))
    data = Texts.of(got.column("places").to_pylist(), got.column("shares").to_pylist())
    check = np.array(got.column("check").to_pylist(), bool)
    learn = np.flatnonzero(~check)
    embed, layer, bias = train(data, y, learn, len(langs))
    table = (embed @ layer.T).astype(np.float32)
    known = np.zeros(1 << BITS, bool)
    known[data.take(learn)[1]] = True
    held = np.flatnonzero(check)
    if not len(held):
        return Model(langs, table, bias, known)
    weight = (np.array([total[x] for x in langs]) / np.maximum(np.bincount(y[held], minlength=len(langs)), 1))[y[held]]
    row, place, share = data.take(held)
    z = np.stack([np.bincount(row, share * table[place, k], len(held)) for k in range(len(langs))], axis=1) + bias
    heat = _likeliest(z, y[held], weight)
    p = _softmax(z / heat)
    least = _least_score(p.max(axis=1), p.argmax(axis=1) == y[held], weight, max_error)
    seen = np.bincount(row, share * known[place], len(held))
    return Model(langs, table, bias, known, heat, least, float(np.quantile(seen, strange)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang, score, known, accepted)`` of every row; ``known`` is the
    share of the text's subwords that training has seen."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("known", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    names = np.array([*model.langs, NONE], object)

    def run(batches):
        for b in batches:
            data, off = flat(b.column(1))
            out = []
            for i, j in steps(off):
                part, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
                if not model.langs:
                    out.append((np.full(j - i, 0), np.zeros(j - i), np.zeros(j - i), np.zeros(j - i, bool)))
                    continue
                p, seen, size = model.scores(part, at)
                score = np.where(size > 0, p.max(axis=1), 0.0)
                out.append((np.where(size > 0, p.argmax(axis=1), len(model.langs)), score, seen, (size > 0) & (score >= model.min_score) & (seen >= model.min_known)))
            if out:
                lang, score, seen, accepted = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names[lang], pa.string()), pa.array(score), pa.array(seen), pa.array(accepted)], schema.names)

    return docs.select(quoted(id_col).alias("id"), utf8(f"`{text_col}`").alias("text")).mapInArrow(run, schema)

"""Secrets: known patterns, and tokens that pass for random.

Base spans are the leftmost non-overlapping matches of each pattern:
assignments of a value of 6 or more characters to a name such as
``password``, access key ids of 20 or more characters, and lower-case hex
runs of 24 or more.

Every other run of 20 or more characters of base64 alphabets is a candidate,
and as runs can be paths around a token, so are its parts of 20 or more
between the symbols that the token's alphabet lacks (``_PARTS``). Each
candidate gets the encoding it looks like (hex, base32, base36, base62,
base64) and a battery of tests of the hypothesis that its symbols are drawn
uniformly from that alphabet:

* chi-squared of the symbols' counts, in classes of neighbouring symbols so
  that about five symbols are expected in each class whatever the length;
* the Wald-Wolfowitz runs test of symbols below and above the middle;
* the serial correlation of neighbouring symbols.

Fisher's method combines the three; for letters of one case, which are words
more often than keys, also the probability that a token has no digit. A token
for which this hypothesis is rejected (p below ``gate``) is no key.

What passes is not yet a finding: short names pass such tests too. So each
token is also tested against the hypothesis that it is a word, a name or a
path. How those are spelled is a model of which symbol follows which: counts
over all runs of under 20 letters and digits in the corpus, which are no
candidates, smoothed by a stated prior on classes of symbols. The ratio of the
token's probability under uniform symbols to that under the model exceeds 1/p
with probability p at most if the token is word-like (Markov's inequality), so
its inverse is a p-value, for any length and encoding. Over these
Benjamini-Hochberg's step-up runs within each encoding and doubling of length,
since short tokens show less than long ones: among the tokens *reported* in a
class, the expected share of word-like ones is at most ``rate``, whatever their
dependence. What is reported is kind ``random``, tokens that overlap as one
span; candidates that overlap a base span are not tested. P-values are rounded
up to 1/20 of a power of ten, so the step-up needs one count per encoding,
length class and step, a few thousand numbers for any corpus. Digits alone are
numbers, not candidates (from 24 on they are base spans of kind ``hex``).

Defined results: a null or empty text has no spans. Base spans depend on the
row alone; which tokens are reported depends also on the corpus, by its model
and the number of tests. Repeated rows get the same spans, and each counts as
a test. An empty table gives an empty result. Extra columns do not matter. Positions
count code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import flat, quoted, save, steps, utf8

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")              # the same spans as runs of any length, short ones dropped
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_SEPARATOR = re.compile(r"[+/_-]")
#: What a run with separators is split into: both base64 alphabets, the plain one also without slashes, and none of the four.
_PARTS = tuple(re.compile(rf"[A-Za-z0-9{more}]{{20,}}") for more in ("+/", "_-", "+", ""))

#: Alphabets in symbol order, the narrowest that holds a token is its encoding.
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Steps of a power of ten that p-values are rounded up to, and the smallest power.
STEPS, DECADES = 20, 30


#: The symbols of all alphabets, by class: lower case, capitals, digits, separators.
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/-_")
SYMBOLS = "".join(_CLASSES)
_PLACE = {c: i for i, c in enumerate(SYMBOLS)}
#: How often a symbol of one class is followed by each class in words, names and paths.
_FOLLOWS = ((0.90, 0.04, 0.03, 0.03), (0.45, 0.45, 0.07, 0.03), (0.12, 0.05, 0.78, 0.05), (0.60, 0.15, 0.20, 0.05))
#: Weight of the prior in counts, and its least share at any number of counts.
PRIOR_COUNTS, PRIOR_SHARE = 200.0, 0.1
#: Runs that the model is learned from are shorter than any candidate.
_LEARNED = 20


def _prior() -> np.ndarray:
    of = np.repeat(np.arange(4), [len(c) for c in _CLASSES])
    size = np.array([len(c) for c in _CLASSES])
    return np.array(_FOLLOWS)[of][:, of] / size[of]


def _pairs(batches):
    """How often each symbol follows each other one inside the runs of under ``_LEARNED`` letters and digits."""
    code = np.full(256, -1, np.int64)
    for c in "".join(_CLASSES[:3]):
        code[ord(c)] = _PLACE[c]
    n = len(SYMBOLS)
    counts = np.zeros(n * n, np.int64)
    for b in batches:
        data, off = flat(b.column(0))
        for i, j in steps(off):
            part, ends = data[off[i]:off[j]], off[i + 1:j + 1] - off[i]
            symbol = code[part]
            inside = symbol >= 0
            joined = inside[1:] & inside[:-1]
            cut = ends[(ends > 0) & (ends < len(part))] - 1
            joined[cut] = False
            # runs of joined neighbours, by where they begin and end
            edge = np.diff(np.concatenate(([False], joined, [False])).astype(np.int8))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            long = last - first + 1 >= _LEARNED
            for x, y in zip(first[long].tolist(), last[long].tolist()):
                joined[x:y] = False
            at = np.flatnonzero(joined)
            counts += np.bincount(symbol[at] * n + symbol[at + 1], minlength=n * n)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["pair", "n"])


def spelling(counts: np.ndarray) -> np.ndarray:
    """Logarithm of the probability that a symbol (row) is followed by another (column) in word-like text."""
    prior = _prior()
    total = counts.sum(axis=1, keepdims=True)
    learned = (counts + PRIOR_COUNTS * prior) / (total + PRIOR_COUNTS)
    return np.log((1 - PRIOR_SHARE) * learned + PRIOR_SHARE * prior)


def learn(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The spelling model of a table: one aggregate over all texts, at most 66 x 66 numbers."""
    found = docs.select(utf8(f"`{text_col}`").alias("text")).mapInArrow(_pairs, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(SYMBOLS) ** 2)
    for r in found:
        counts[r["pair"]] = r["n"]
    return spelling(counts.reshape(len(SYMBOLS), -1))


def word_likeness(token: str, alphabet: str, model: np.ndarray) -> float:
    """Logarithm of the p-value that ``token`` is spelled like a word: the
    model's probability of its symbols over that of uniform ones, 1 at most."""
    s = np.fromiter((_PLACE[c] for c in token), np.int64, len(token))
    return min(0.0, float(model[s[:-1], s[1:]].sum()) + (len(s) - 1) * math.log(len(alphabet)))


def infer(token: str) -> tuple[int, str] | None:
    """The encoding's number and alphabet; None for digits alone, which are
    numbers, and where no alphabet has all symbols."""
    if token.isdigit():
        return None
    seen = set(token)
    for n, (_, alphabet) in enumerate(ENCODINGS):
        if seen <= set(alphabet):
            return n, alphabet
    return None


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _upper_chi2(x: float, k: int) -> float:
    """Wilson-Hilferty approximation; exact for k = 2, 6 and 8."""
    if k == 2:
        return math.exp(-x / 2)
    if k in (6, 8):
        h = x / 2
        return math.exp(-h) * (1 + h + h * h / 2 + (h ** 3 / 6 if k == 8 else 0))
    return _upper_normal(((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)))


def randomness(token: str, alphabet: str) -> float:
    """Combined p-value of the three tests that ``token`` is uniform over
    ``alphabet``, and for letters of one case of the share of tokens without digits."""
    place = {c: i for i, c in enumerate(alphabet)}
    s = np.fromiter((place[c] for c in token), np.int64, len(token))
    n, a = len(s), len(alphabet)
    classes = min(a, max(2, n // 5))
    share = np.bincount(np.arange(a) * classes // a, minlength=classes) / a
    counts = np.bincount(s * classes // a, minlength=classes)
    p_chi = _upper_chi2(float((((counts - n * share) ** 2) / (n * share)).sum()), classes - 1)
    high = s >= a / 2
    up = int(high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if 0 < up < n:
        mean = 1 + 2 * up * (n - up) / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * _upper_normal(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    d = s - s.mean()
    spread = float((d * d).sum())
    p_serial = 2 * _upper_normal(abs(float((d[1:] * d[:-1]).sum()) / spread) * math.sqrt(n)) if spread > 0 else 2.0 ** (1 - n)
    found = [p_chi, p_runs, p_serial]
    if token.isalpha() and (token.islower() or token.isupper()):
        found.append((sum(c.isalpha() for c in alphabet) / a) ** n)
    tiny = 10.0 ** -(DECADES + 5)
    return _upper_chi2(-2 * sum(math.log(min(1.0, max(p, tiny))) for p in found), 2 * len(found))


def _base(text: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _candidates(text: str):
    """(start, end) of each run and of its parts, each once."""
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        yield start, end
        if _SEPARATOR.search(text, start, end):
            yield from {p.span() for part in _PARTS for p in part.finditer(text, start, end)} - {(start, end)}


def _tested(text: str, base: list[tuple[int, int, int]], model: np.ndarray, gate: float) -> list[tuple[int, int, int, int]]:
    """(start, end, stratum, step of the p-value of being word-like) of the
    candidates that no base span overlaps; step 0 for those that the battery rejects."""
    out, starts, reach = [], [s for s, _, _ in base], [0, *accumulate((e for _, _, e in base), max)]
    for start, end in _candidates(text):
        token = text[start:end]
        kind = infer(token) if reach[bisect_left(starts, end)] <= start else None
        if kind:
            p = word_likeness(token, kind[1], model) if randomness(token, kind[1]) >= gate else 0.0
            step = min(DECADES * STEPS, int(-p / math.log(10) * STEPS))
            out.append((start, end, kind[0] * 64 + (end - start).bit_length(), step))
    return sorted(out, key=lambda t: (t[0], -t[1]))


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("k", pa.int32()), ("end", pa.int64())]))
_TEST = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("stratum", pa.int32()), ("step", pa.int32())]))


def _scan(model: np.ndarray, gate: float):
    def run(batches):
        for b in batches:
            spans, tests = [], []
            for raw in b.column(1).to_pylist():
                text = raw.decode()
                base = _base(text)
                spans.append([{"start": s, "k": k, "end": e} for s, k, e in base])
                tests.append([{"start": s, "end": e, "stratum": g, "step": q} for s, e, g, q in _tested(text, base, model, gate)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _SPAN), pa.array(tests, _TEST)], ["id", "base", "tests"])
    return run


def findings(counts: list[tuple[int, int, int]], rate: float) -> dict[int, int]:
    """Benjamini-Hochberg in each stratum: the smallest step from which on
    tokens are reported. ``counts``: (stratum, step, tokens); a token of step
    q has a p-value of at most 10 ** -(q / STEPS)."""
    by: dict[int, dict[int, int]] = {}
    for stratum, step, n in counts:
        by.setdefault(stratum, {})[step] = n
    out = {}
    for stratum, found in by.items():
        tests, seen = sum(found.values()), 0
        for step in sorted(found, reverse=True):
            seen += found[step]
            if 10.0 ** -(step / STEPS) <= rate * seen / tests:
                out[stratum] = step
    return out


def _merged(kept: Column) -> Column:
    """Spans by start, those that overlap as one."""
    none = F.struct(F.filter(F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"))), lambda t: F.lit(False)).alias("out"),
                    F.lit(-1).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"))
    closed = lambda acc: F.when(acc["start"] < 0, acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))))

    def step(acc: Column, t: Column) -> Column:
        return (F.when(t["start"] < acc["end"], F.struct(acc["out"].alias("out"), acc["start"].alias("start"), F.greatest(acc["end"], t["end"]).alias("end")))
                .otherwise(F.struct(closed(acc).alias("out"), t["start"].alias("start"), t["end"].alias("end"))))

    return F.aggregate(kept, none, step, closed)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.05, gate: float = 0.01) -> DataFrame:
    """One row per input row: id, base (its spans) and found (all spans):
    structs (start, kind number, end) by start, then kind."""
    span = "array<struct<start:bigint,k:int,end:bigint>>"
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("base", T._parse_datatype_string(span)),
                           T.StructField("tests", T._parse_datatype_string("array<struct<start:bigint,end:bigint,stratum:int,step:int>>"))])
    model = learn(docs, text_col)
    rows = save(docs.select(quoted(id_col).alias("id"), utf8(f"`{text_col}`").alias("text")).mapInArrow(_scan(model, gate), schema), "secret_tests")
    # at most encodings x length classes x steps rows
    counts = rows.select(F.explode("tests").alias("t")).groupBy("t.stratum", "t.step").agg(F.count(F.lit(1)).alias("n")).collect()
    limits = findings([tuple(r) for r in counts], rate)
    pairs = [x for k, v in limits.items() for x in (F.lit(k), F.lit(v))]
    limit = F.create_map(*pairs) if pairs else F.create_map().cast("map<int,int>")
    kept = F.filter("tests", lambda t: t["step"] >= F.coalesce(F.try_element_at(limit, t["stratum"]), F.lit(DECADES * STEPS + 1)))
    random = F.transform(_merged(kept), lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("k"), t["end"].alias("end")))
    return rows.select("id", "base", F.array_sort(F.concat("base", random)).alias("found"))


def joined(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")

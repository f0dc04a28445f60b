"""Quality rules: how much of a text repeats itself.

Words are ``[^\\x20\\x09-\\x0D]+``. For several n-gram lengths a rolling hash
of the word hashes is computed in numpy over whole texts; the measure is the
share of the words' characters that lie inside n-grams occurring twice or
more in the text, the first occurrence included. For lines it is the share
of characters in lines that equal an earlier line.

A text fails the base rules with fewer than 20 words, or when more than 30 %
of its words lie in 8-word windows found twice or more. It fails the method
when the share of repeated characters passes ``Limits`` for any length.

Defined results: a null text has no words and fails, as does an empty one.
Every row is judged on its own, so repeated rows get the same verdict and an
empty table gives an empty result. Extra columns are ignored by ``measure``
and passed through by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import _CONTINUED, SPACE, flat, fresh, gram_hashes, prefix_sums, quoted, range_hashes, steps, utf8, word_bounds

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True




@dataclass(frozen=True)
class Limits:
    """Largest accepted share of characters in repeated n-grams, by length,
    and in repeated lines. Documents of running text stay far below: a
    passage that a text quotes once more is fine, a text made of repeats isn't."""
    grams: tuple[tuple[int, float], ...] = ((5, 0.40), (8, 0.35), (12, 0.30))
    lines: float = 0.30


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars_seen", "dup_line_chars")


def _per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _covered(words: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in an n-gram that the same row holds twice or more."""
    out = np.zeros(len(words), bool)
    h = gram_hashes(words, n)
    if not len(h):
        return out
    same_row = row[:len(h)] == row[n - 1:]
    h = (h ^ (row[:len(h)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))[same_row]
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return out
    at = np.flatnonzero(same_row)[np.isin(h, np.unique(twice))]
    depth = np.zeros(len(words) + 1, np.int64)
    depth[at] += 1
    np.subtract.at(depth, at + n, 1)
    return np.cumsum(depth[:-1]) > 0


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier one: their number and characters."""
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0, 0
    seen, n, chars = set(), 0, 0
    for line in lines:
        if line in seen:
            n, chars = n + 1, chars + len(line.decode("utf-8", "replace"))
        elif line.strip():
            seen.add(line)
    return n, chars


def _measure(data: np.ndarray, off: np.ndarray, grams: tuple[int, ...]) -> list[np.ndarray]:
    starts, ends = word_bounds(data, off)
    words = range_hashes(prefix_sums(data), starts, ends)
    first = np.searchsorted(starts, off)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(off) - 1), n_words)
    is_char = ~_CONTINUED[data]
    chars = _per_row(is_char & ~SPACE[data], off)
    upto = np.zeros(len(data) + 1, np.int64)
    np.cumsum(is_char, out=upto[1:])
    width = upto[ends] - upto[starts]
    eight = _covered(words, row, 8)
    raw = data.tobytes()
    lines = np.array([_lines(raw[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())], np.int64).reshape(-1, 2)
    out = [n_words, chars, _per_row(_SYMBOL[data], off), lines[:, 0], _per_row(eight, first), upto[off[1:]] - upto[off[:-1]], lines[:, 1]]
    for n in grams:
        hit = eight if n == 8 else _covered(words, row, n)
        out.append(np.bincount(row[hit], width[hit], len(off) - 1).astype(np.int64))
    return out


def _run(grams: tuple[int, ...]):
    def run(batches):
        for b in batches:
            data, off = flat(b.column(b.num_columns - 1))
            parts = [_measure(data[off[i]:off[j]], off[i:j + 1] - off[i], grams) for i, j in steps(off)]
            if parts:
                found = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *found], [*b.schema.names[:-1], *[f"c{k}" for k in range(len(found))]])
    return run


def _judged(docs: DataFrame, carried: list[str], text_col: str, limits: Limits) -> tuple[DataFrame, dict]:
    """``carried`` columns with the counts, and the verdicts as expressions."""
    grams = tuple(n for n, _ in limits.grams)
    # Spark names the result by the schema, in order: the counts get names free of clashes.
    plain = docs.select(*[quoted(c) for c in carried])
    names = fresh(plain, *COUNTS, *[f"dup{n}_chars" for n in grams])
    body = fresh(plain, "body")[0]
    schema = T.StructType([*plain.schema.fields, *[T.StructField(c, T.LongType()) for c in names]])
    given = docs.select(*[quoted(c) for c in carried], utf8(f"`{text_col}`").alias(body))
    run = _run(grams)

    def named(batches):
        for b in run(batches):
            yield b.rename_columns([f.name for f in schema.fields])

    got = given.mapInArrow(named, schema)
    col = {k: quoted(v) for k, v in zip([*COUNTS, *[f"dup{n}_chars" for n in grams]], names)}
    failed = (col["n_words"] < 20) | (100 * col["n_repeat_words"] > 30 * col["n_words"])
    passed = col["dup_line_chars"] <= F.lit(limits.lines) * col["n_chars_seen"]
    for n, most in limits.grams:
        passed = passed & (col[f"dup{n}_chars"] <= F.lit(most) * col["word_chars"])
    return got, col | {"base_failed": failed, "kept": ~failed & passed}


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The counts, base_failed and kept of every row, beside ``id_col``."""
    got, col = _judged(docs, [id_col], text_col, limits)
    return got.select(quoted(id_col), *[c.alias(k) for k, c in col.items()])


def keep_good(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns."""
    got, col = _judged(docs, docs.columns, text_col, limits)
    return got.where(col["kept"]).select(*[quoted(c) for c in docs.columns])

"""Periodic runs: stretches of words that repeat with a period four times or
more, found by an online dynamic program over sparse diagonals.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a maximal stretch
of consecutive words with smallest period q and a length of at least
max(``min_length``, 4 q).

On the diagonal of lag q, word i matches when it equals word i - q; a run of
period q is a stretch of at least 3 q matches there. Reading a text from left
to right, the earlier occurrences of each word say which diagonals grow by
one. A diagonal that the next word does not extend is closed, and emits its
run at once if it is long enough (``_online``).

The diagonals are sparse because an occurrence counts only if it can belong
to a long enough stretch (``_occurrences``): for lags from a to below 1.5 a,
the 3 a words that end at i must occur again ending at i - lag. Two lags of
such a band add up to less than the gram's length, so by the theorem of Fine
and Wilf the nearest earlier occurrence of a gram is the only one that can be
a smallest period there: each word has at most one diagonal in each of
log1.5(n / 4) bands, whatever the text (one word repeated n times included).
A sort of the 5-gram hashes comes first; texts without a near repeat, nearly
all, end there.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text. Rows are looked at each by itself, so repeated rows give equal
results and an empty table gives an empty result; a null id is kept. Extra
columns do not matter. Words and grams are compared by 64-bit hashes; each
run's words are compared before it is returned, so a collision (1 in 2^64 a
pair) could only hide a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm import common
from lakeforge.llm.common import flat, prefix_sums, quoted, range_hashes, steps, utf8, word_bounds

#: Words of the shortest gram: a run of period 1 and 6 words is 5 matches.
GRAM = 5
PERIODS = 4
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def _bands(longest: int) -> Iterator[tuple[int, int, int]]:
    """Smallest and largest lag of each band and the length of its grams."""
    a = 1
    while a <= longest:
        b = -(-3 * a // 2)
        yield a, min(b - 1, longest), max(GRAM, (PERIODS - 1) * a)
        a = b


def _nearest(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distance from each position to the nearest earlier one with the same hash; 0 if none."""
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    out = np.zeros(len(hashes), np.int64)
    out[order[same + 1]] = at[order[same + 1]] - at[order[same]]
    return out


def _occurrences(words: np.ndarray, row: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Last word, lag and length of every gram whose nearest earlier
    occurrence in the row lies within the gram's band; by last word.
    ``room``: words of the row from each word on."""
    none = (np.zeros(0, np.int64),) * 3
    n = len(words)
    if n <= GRAM:
        return none
    up, _ = common._grown(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=sums[1:])
    salt = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def hashes(at: np.ndarray, size: int) -> np.ndarray:
        return range_hashes(sums, at, at + size) ^ salt[at]

    near = np.zeros(n, np.int64)
    fits = np.flatnonzero(room >= GRAM)
    near[fits] = _nearest(hashes(fits, GRAM), fits)
    found = []
    for low, high, size in _bands(int(room.max()) // PERIODS):
        close = np.zeros(n + 1, np.int64)
        np.cumsum((near > 0) & (near <= high), out=close[1:])
        if not close[-1]:
            continue
        grams = size - GRAM + 1                  # 5-grams in a gram: all of them must occur again as near
        at = np.flatnonzero(room >= size)
        again = np.zeros(n + 1, np.int64)
        again[at + 1] = close[at + grams] - close[at] == grams
        np.cumsum(again, out=again)
        at = at[again[np.minimum(at + high + 1, n)] > again[at]]      # those and what lies up to a lag before
        if len(at):
            lag = _nearest(hashes(at, size), at)
            ok = (lag >= low) & (lag <= high)
            found.append((at[ok] + size - 1, lag[ok], np.full(int(ok.sum()), size)))
    if not found:
        return none
    last, lag, size = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(last, kind="stable")
    return last[order], lag[order], size[order]


def _online(last: list[int], lags: list[int], sizes: list[int], min_length: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, in the order in which
    their diagonals end. Words come from left to right, each with the lags at
    which it has occurred (at first, with the words of the gram before it)."""
    runs: list[tuple[int, int, int]] = []
    active: dict[int, list[int]] = {}            # lag -> matches so far, last word

    def close(before: int) -> None:
        for lag in [d for d, (_, word) in active.items() if word < before]:
            matches, word = active.pop(lag)
            if matches + lag >= max(min_length, PERIODS * lag):
                runs.append((word - matches - lag + 1, matches + lag, lag))

    seen = -1
    for word, lag, size in zip(last, lags, sizes):
        if word != seen:
            close(word - 1)
            seen = word
        diagonal = active.get(lag)
        if diagonal is None:
            active[lag] = [size, word]
        else:
            diagonal[0] += 1
            diagonal[1] = word
    close(seen + 1)
    return runs


def runs_of(words: np.ndarray, first: np.ndarray, min_length: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs by row, sorted by start and period. ``words``: word hashes of all
    rows one after the other; ``first``: each row's first word, one more than rows."""
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    room = np.repeat(first[1:], count) - np.arange(len(words))
    last, lag, size = _occurrences(words, row, room)
    out = {}
    of = row[last]
    cuts = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        r = int(of[i])
        begin = int(first[r])
        own = words[begin:int(first[r + 1])]
        runs = _online((last[i:j] - begin).tolist(), lag[i:j].tolist(), size[i:j].tolist(), min_length)
        runs = [(s, n, q) for s, n, q in runs if np.array_equal(own[s + q:s + n], own[s:s + n - q])]
        if runs:
            out[r] = sorted(runs, key=lambda x: (x[0], x[2]))
    return out


def _collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    words = text.split()                         # exactly the six ASCII space characters
    if runs:
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period:start + length] = True
        words = [w for w, drop in zip(words, gone.tolist()) if not drop]
    return b" ".join(words)


def _scan(min_length: int):
    def run(batches):
        for b in batches:
            data, off = flat(b.column(1))
            raw = memoryview(data)
            found, texts, n_words = [], [], []
            for i, j in steps(off):
                part, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
                starts, ends = word_bounds(part, at)
                first = np.searchsorted(starts, at)
                runs = runs_of(range_hashes(prefix_sums(part), starts, ends), first, min_length)
                n_words += np.diff(first).tolist()
                for r in range(j - i):
                    own = runs.get(r, [])
                    found.append([dict(zip(RUN.names, x)) for x in own])
                    texts.append(_collapsed(bytes(raw[off[i + r]:off[i + r + 1]]), own))
            kind = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in RUN.names]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(found, kind), pa.array(texts, pa.binary())],
                                             ["id", "n_words", "runs", "collapsed"])
    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` of every row: the runs by start and
    period, and the UTF-8 text of the words that stay when each run keeps its
    first period only, joined by one space."""
    if min_length <= GRAM:
        raise ValueError(f"min_length must be over {GRAM}")
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.BinaryType())])
    return docs.select(quoted(id_col).alias("id"), utf8(f"`{text_col}`").alias("text")).mapInArrow(_scan(min_length), schema)


def best(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of ties
    the one with the smallest start, then period. Null without runs."""
    def better(x: Column, y: Column) -> Column:
        mine, its = x["length"] * y["period"], y["length"] * x["period"]
        # runs come by start and period: the earlier one wins ties
        return F.when(x.isNull() | (its > mine), y).otherwise(x)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def lines(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in RUN.names]), F.lit("\n"))))

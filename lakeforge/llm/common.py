"""Helpers shared by the text operators: scratch tables on the shared
checkpoint folder, byte views of Arrow columns and vectorised hashes of
byte ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.session import scratch_root

#: Bytes of text a task looks at in one numpy step; a longer text is one step of its own.
STEP_BYTES = 1 << 20


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back, so
    that later jobs neither recompute it nor lose it with an executor."""
    return keep(df, name)[0]


def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_root(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that do not clash with ``df``'s (also not in other case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def utf8(col: str) -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(col).cast("string").cast("binary"), F.lit(b""))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one uint8 array, and each row's start
    in it (one more than rows). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def steps(off: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


# ---------------------------------------------------------------------------
# Hashes of byte ranges. S[i] is the sum of T[byte j] * B^j for j < i modulo
# 2^64, so a range's hash, (S[end] - S[start]) * B^-start, does not depend on
# where the range lies.
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64))))


_TABLE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_POW = {"up": _powers(_BASE, 1 << 10), "down": _powers(pow(_BASE, -1, 1 << 64), 1 << 10)}


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["up"]) <= n:
        m = max(n + 1, 2 * len(_POW["up"]))
        _POW["up"], _POW["down"] = _powers(_BASE, m), _powers(pow(_BASE, -1, 1 << 64), m)
    return _POW["up"], _POW["down"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = _grown(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:len(data)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _grown(len(sums))
    return _mixed((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (by its first word)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h = h * np.uint64(_BASE) + words[j:j + m]
    return _mixed(h)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


_CONTINUED = np.zeros(256, bool)                 # bytes inside a code point
_CONTINUED[0x80:0xC0] = True
_LOWER = np.arange(256, dtype=np.uint8)          # A-Z lower-cased
_LOWER[65:91] += 32


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``; a word never runs over a row's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1

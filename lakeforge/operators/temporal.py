"""Joins by time: the latest row at or before each row (as-of), and points
inside intervals.

``asof_join`` puts both sides under one another in time order and carries the
last right row along: one shuffle on the key, no pairs. Hot keys are cut into
segments with a summary each (``operators.windows``), so a key with a third of
the rows is not sorted in one task.

``interval_join`` is an equi-join on bins whose size is a power of two. An
interval of length n goes into the bins of the first size above n, of which
it touches at most two whatever n is; a point goes into one bin of every size
that some interval uses (at most 63). Every pair that shares a bin is checked,
so the result is exact; there is no nested loop. An interval's bins are at
most twice as long as the interval, so candidates are a small multiple of the
matches; a bin with very many rows is an ordinary skewed join partition, which
adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.operators.cuts import ROWS_PER_SEGMENT
from lakeforge.operators.windows import skew_safe_window, segmented_window


def asof_join(left: DataFrame, right: DataFrame, key: str, right_key: str, left_time: str, right_time: str, columns: Sequence[str],
              tiebreak: str, allow_equal: bool = True, within: str | None = None, hot_fraction: float | None = None,
              sample_fraction: float | None = None, rows_per_segment: int = ROWS_PER_SEGMENT, segment: Column | None = None) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the right row of its key that
    is the latest at or before it (before it, without ``allow_equal``); of
    right rows of one time the one with the greatest ``tiebreak``. NULLs where
    there is none, where the left row's key or time is NULL, and where the
    match is more than ``within`` (an interval such as ``'7 days'``) old.
    Right rows without key or time match nothing.

    ``segment`` (tests) cuts every key by an expression over ``_time``."""
    clash = sorted(set(columns) & set(left.columns))
    if clash:
        raise ValueError(f"both sides have columns {', '.join(clash)}")
    kind = left.schema[left_time].dataType
    as_time = lambda c: F.col(c).cast("timestamp") if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else F.col(c)
    tie = right.schema[tiebreak].dataType
    found = T.StructType([T.StructField("t", T.TimestampType() if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else kind),
                          T.StructField("v", T.StructType([right.schema[c] for c in columns]))])
    # at the same time, right rows come first if they may match
    mine, its = (1, 0) if allow_equal else (0, 1)
    a = left.select(F.col(key).alias("_key"), as_time(left_time).alias("_time"), F.lit(mine).alias("_side"), F.lit(None).cast(tie).alias("_tie"),
                    F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"), F.lit(None).cast(found).alias("_right"))
    b = (right.where(F.col(right_key).isNotNull() & F.col(right_time).isNotNull())
         .select(F.col(right_key).cast(left.schema[key].dataType).alias("_key"), as_time(right_time).alias("_time"), F.lit(its).alias("_side"), F.col(tiebreak).alias("_tie"),
                 F.lit(None).cast(a.schema["_left"].dataType).alias("_left"),
                 F.struct(as_time(right_time).cast(found["t"].dataType).alias("t"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("v")).cast(found).alias("_right")))
    known = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    rows, order, specs = a.where(known).unionByName(b), ["_time", "_side", "_tie"], {"_match": ("last_known", "_right")}
    if segment is not None:
        carried = segmented_window(rows, ["_key"], order, segment, specs)
    else:
        carried = skew_safe_window(rows, ["_key"], order, None, specs, hot_fraction=hot_fraction, sample_fraction=sample_fraction, rows_per_segment=rows_per_segment)
    out = carried.where(F.col("_left").isNotNull()).select("_time", "_left", "_match")
    out = out.unionByName(a.where(~known).select("_time", "_left", F.lit(None).cast(found).alias("_match")))
    fresh = F.lit(True) if within is None else F.col("_match.t") >= F.col("_time") - F.expr(f"INTERVAL {within}")
    return out.select("_left.*", *[F.when(fresh, F.col("_match.v")[c]).alias(c) for c in columns])


def _ticks(c: Column, kind: T.DataType) -> Column:
    """Whole numbers in time order: microseconds, days or the number itself."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    raise TypeError(f"cannot put {kind.simpleString()} into bins")


def _bin(tick: Column, level: Column) -> Column:
    return F.call_function("shiftright", tick, level)


def interval_join(points: DataFrame, intervals: DataFrame, time: str, start: str, end: str, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of a point and an interval with ``start <= time <= end`` and, if
    ``on`` names columns of both sides, equal values of those. NULLs and
    intervals that end before they start match nothing. Columns of both sides
    must have different names, but for ``on``."""
    kind = points.schema[time].dataType
    if any(type(intervals.schema[c].dataType) is not type(kind) for c in (start, end)):
        raise TypeError(f"{time}, {start} and {end} must have one type")
    lo, hi = _ticks(F.col(start), kind), _ticks(F.col(end), kind)
    spans = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumns({"_lo": lo, "_hi": hi}).where("_lo <= _hi")
    # the number of binary digits of the length: bins of 2^level are longer than the interval
    spans = spans.withColumn("_level", F.length(F.bin(F.col("_hi") - F.col("_lo"))))
    binned = spans.withColumn("_bin", F.explode(F.sequence(_bin(F.col("_lo"), F.col("_level")), _bin(F.col("_hi"), F.col("_level")))))
    used = spans.agg(F.sort_array(F.collect_set("_level")).alias("levels")).scalar()
    spread = (points.where(F.col(time).isNotNull()).withColumn("_at", _ticks(F.col(time), kind)).withColumn("_level", F.explode(used))
              .withColumn("_bin", _bin(F.col("_at"), F.col("_level"))))
    pairs = spread.join(binned, [*on, "_level", "_bin"]).where((F.col("_lo") <= F.col("_at")) & (F.col("_at") <= F.col("_hi")))
    return pairs.select(*on, *[F.col(f"`{c}`") for c in points.columns if c not in on], *[F.col(f"`{c}`") for c in intervals.columns if c not in on])

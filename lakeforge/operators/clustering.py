"""How far files overlap on a column, and clustering by several columns.

A scan skips a file whose min and max exclude the wanted value. What that is
worth shows in how many files hold any one value: the overlap report counts it
from each file's range, and a Z-order write lowers it for several columns at
once, where a plain sort helps its first column only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.operators.windows import skew_safe_window

#: Ranges of a column are known by this many bits, so by 2^8 - 1 cut points.
RANK_BITS = 8

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def sweep_key(name: str, dtype: T.DataType) -> Column:
    """A column as a struct of one type for all columns, whose order is the
    column's own: exact numbers, dates and times as DECIMAL, floats as DOUBLE,
    text as bytes."""
    c = F.col(f"`{name}`")
    exact, real, text = F.lit(None).cast("decimal(38,10)"), F.lit(None).cast("double"), F.lit(None).cast("binary")
    if isinstance(dtype, _WHOLE) or (isinstance(dtype, T.DecimalType) and dtype.scale <= 10 and dtype.precision - dtype.scale <= 28):
        exact = c.cast("decimal(38,10)")
    elif isinstance(dtype, T.DateType):
        exact = F.unix_date(c).cast("decimal(38,10)")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        exact = F.unix_micros(c.cast("timestamp")).cast("decimal(38,10)")
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        real = c.cast("double")
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        text = c.cast("binary")
    else:
        raise ValueError(f"{name}: no order to report on for {dtype.simpleString()}")
    return F.when(c.isNotNull(), F.struct(exact.alias("exact"), real.alias("real"), text.alias("text")))


def file_ranges(df: DataFrame, columns: Sequence[str], unit: Column | None = None) -> DataFrame:
    """One row per file and column: ``unit, column_name, rows, lo, hi``; both
    bounds are NULL where the file holds only NULLs. ``unit`` may name
    something else than the file, such as its folder. One scan and one
    aggregate for all columns."""
    if not columns:
        raise ValueError("no columns to report on")
    types = {f.name: f.dataType for f in df.schema.fields}
    unit = F.col("_metadata.file_path") if unit is None else unit
    keyed = df.select(unit.alias("unit"), *[sweep_key(c, types[c]).alias(f"_{i}") for i, c in enumerate(columns)])
    per_unit = keyed.groupBy("unit").agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(f"_{i}").alias(f"_{n}{i}") for i in range(len(columns)) for n, f in (("lo", F.min), ("hi", F.max))])
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi"))
                     for i, c in enumerate(columns)])
    return per_unit.select("unit", "rows", F.explode(each).alias("_c")).select("unit", "_c.column_name", "rows", "_c.lo", "_c.hi")


def overlap_report(ranges: DataFrame) -> DataFrame:
    """One row per column of ``file_ranges``: ``column_name, files, empty_files``
    (only NULLs), ``rows``, ``max_depth`` (most files that hold one value between their
    bounds), ``overlap_pairs`` (pairs of files that share a value) and
    ``mean_overlaps`` (other files that a file overlaps; NULL without files).

    A sweep over the interval ends: they are counted per value first, then
    summed in order by the skew-safe window, so many files on one value are one
    row and a table of very many small files is cut over tasks. A file that
    opens at a value overlaps those open before it and those that open with it,
    so pairs are counted without being formed."""
    ranges = ranges.checkpoint(eager=True)          # one row per file and column; the files are scanned once
    ends = ranges.where(F.col("lo").isNotNull()).select("column_name", F.explode(F.array(
        F.struct(F.col("lo").alias("at"), F.lit(1).alias("opens"), F.lit(0).alias("closes")),
        F.struct(F.col("hi").alias("at"), F.lit(0).alias("opens"), F.lit(1).alias("closes")))).alias("_e"))
    points = ends.groupBy("column_name", F.col("_e.at").alias("at")).agg(
        F.sum("_e.opens").alias("opens"), F.sum("_e.closes").alias("closes"))
    points = points.withColumn("change", F.col("opens") - F.col("closes"))
    swept = skew_safe_window(points, ["column_name"], ["at"], None, {"after": ("running_sum", "change")})
    before = F.col("after") - F.col("change")
    found = swept.groupBy("column_name").agg(
        F.max(before + F.col("opens")).alias("max_depth"),
        F.sum(F.col("opens") * before + F.expr("opens * (opens - 1) div 2")).alias("overlap_pairs"))
    files = ranges.groupBy("column_name").agg(F.count("lo").alias("files"), F.count_if(F.col("lo").isNull()).alias("empty_files"),
                                               F.sum("rows").alias("rows"))
    return files.join(found, "column_name", "left").select(
        "column_name", "files", "empty_files", "rows", F.coalesce("max_depth", F.lit(0)).alias("max_depth"),
        F.coalesce("overlap_pairs", F.lit(0)).alias("overlap_pairs"),
        F.when(F.col("files") > 0, 2 * F.coalesce("overlap_pairs", F.lit(0)) / F.col("files")).alias("mean_overlaps"))


def _rankable(name: str, dtype: T.DataType) -> Column:
    """The column as a number whose order is the column's own; of text the
    first six bytes."""
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    raise ValueError(f"{name}: cannot cluster by {dtype.simpleString()}")


def with_zorder(df: DataFrame, columns: Sequence[str], out: str = "_z", bits: int = RANK_BITS) -> DataFrame:
    """``df`` with ``out``: the bits of each column's rank interleaved. A rank
    is the number of the column's cut points not above the value, found by
    halving; the cut points are approximate quantiles of all rows, so ranks hold
    even shares of the rows whatever the values. NULL ranks lowest. The cut
    points are one row of ``2^bits - 1`` numbers a column, broadcast."""
    if not columns or len(columns) * bits > 62:
        raise ValueError("between 1 column and 62 bits in all")
    types = {f.name: f.dataType for f in df.schema.fields}
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    ranks = [_rankable(c, types[c]) for c in columns]
    cuts = df.select(*[r.alias(f"_v{i}") for i, r in enumerate(ranks)]).agg(
        *[F.percentile_approx(f"_v{i}", shares, 10_000).alias(f"_cuts{i}") for i in range(len(columns))])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def rank(i: int) -> Column:
        value, at = F.col(f"_rank{i}"), F.col(f"_cuts{i}")
        found = F.aggregate(steps, F.lit(0), lambda pos, step: F.when(F.get(at, pos + step - 1) <= value, pos + step).otherwise(pos))
        return F.coalesce(found, F.lit(0)).cast("bigint")

    n = len(columns)
    valued = df.withColumns({f"_rank{i}": r for i, r in enumerate(ranks)}).join(F.broadcast(cuts))
    ranked = valued.withColumns({f"_rank{i}": rank(i) for i in range(n)})
    z = F.lit(0).cast("bigint")
    for i in range(n):
        for b in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(f"_rank{i}"), b).bitwiseAND(F.lit(1).cast("bigint")), b * n + i))
    return ranked.withColumn(out, z).select(*df.columns, out)


def write_zordered(df: DataFrame, path: str, columns: Sequence[str], num_files: int | None = None) -> None:
    """Files that hold near ranges of several columns at once: rows are
    range-partitioned by Z-order, the columns and a hash of the row, so that
    also a value held by a third of the rows is spread over files, and sorted
    the same way within them. ``num_files`` as ``write_clustered``'s partitions."""
    names = [f"`{c}`" for c in columns]
    keyed = with_zorder(df, columns).withColumn("_tie", F.xxhash64(*[f"`{c}`" for c in df.columns]))
    order = ["_z", *names, "_tie"]
    ranged = keyed.repartitionByRange(num_files, *order) if num_files else keyed.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).drop("_z", "_tie").write.mode("overwrite").parquet(path)

"""Column profiles and drift between two frames.

Rows, NULLs, min, max, mean and median of every column come from one
aggregate; the median is Spark's bounded-memory percentile, right to within
one in ``ACCURACY`` of the rows. Exact distinct counts take one more scan: the
rows are turned to (column, value) pairs, equal pairs are merged map-side
and in the shuffle, and the pairs of each column counted. Several
``count_distinct`` in one aggregate would send every row once per column.

Percentiles and the distance of distributions come from KLL quantile sketches,
one of each column and part, all from one scan. Sketches of parts are merged
without their rows, so a table's profile follows from its days' profiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rank error of the medians: one in so many rows.
ACCURACY = 10_000


def _stats(df: DataFrame, columns: Sequence[str], approx_distinct: bool) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}"), F.min(x).alias(f"_lo{i}"),
                 F.max(x).alias(f"_hi{i}"), F.avg(x).alias(f"_m{i}"),
                 F.percentile_approx(x, 0.5, ACCURACY).alias(f"_p{i}")]
        if approx_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"_d{i}"))
    fields = lambda i, c: [F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls"),
                           F.col(f"_lo{i}").alias("min"), F.col(f"_hi{i}").alias("max"), F.col(f"_m{i}").alias("mean"),
                           F.col(f"_p{i}").alias("median")] + (
        [F.col(f"_d{i}").alias("distinct")] if approx_distinct else [])
    rows = F.explode(F.array(*[F.struct(*fields(i, c)) for i, c in enumerate(columns)])).alias("p")
    return df.agg(*aggs).select("_rows", rows).select("p.*", F.col("_rows").alias("rows"))


def _distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).select("p.*").distinct().groupBy("column").agg(F.count("value").alias("distinct"))


def profile(df: DataFrame, columns: Sequence[str], exact_distinct: bool = True) -> DataFrame:
    """One row per column: rows, nulls, distinct, min, max, mean, median (as DOUBLE)."""
    stats = _stats(df, columns, approx_distinct=not exact_distinct)
    if exact_distinct:
        stats = stats.join(F.broadcast(_distinct_counts(df, columns)), "column")   # one row per column
    return stats.select("column", "rows", "nulls", "distinct", "min", "max", "mean", "median")


def drift(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Statistics of two frames side by side with the change of mean and of
    the share of NULLs: one scan of each frame."""
    sides = [_stats(df, columns, approx_distinct=False).select("column", *[F.col(c).alias(f"{c}_{n}") for c in ("rows", "nulls", "mean")])
             for n, df in (("a", a), ("b", b))]
    null_share = lambda n: F.col(f"nulls_{n}") / F.nullif(F.col(f"rows_{n}"), F.lit(0))
    return sides[0].join(sides[1], "column").withColumns({"mean_change": F.col("mean_b") - F.col("mean_a"), "null_share_change": null_share("b") - null_share("a")})


#: Size of the sketches: ranks are right to within about 1.33 % of the values at 200, and better in inverse proportion.
SKETCH_K = 1000
#: Rank error of a sketch of that size, with room to spare.
SKETCH_ERROR = 0.005
PERCENTILES = tuple(i / 100 for i in range(1, 100))


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``(by..., column, values, sketch)``: one sketch of each column and part, NULLs left out."""
    found = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"_s{i}") for i, c in enumerate(columns)],
                                *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("values"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]))
    return found.select(*by, each.alias("p")).select(*by, "p.*")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Sketches of parts as those of the whole, or of coarser parts ``by``."""
    return sketches.groupBy(*by, "column").agg(F.sum("values").alias("values"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def percentiles(sketches: DataFrame, at: Sequence[float] = PERCENTILES) -> DataFrame:
    """``percentiles`` beside each sketch: the values at the shares ``at``; NULL where a column has none."""
    points = F.when(F.col("values") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in at])))
    return sketches.withColumn("percentiles", points)


def distribution_drift(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, distance)``: the greatest difference between the shares of
    values up to a point in two frames (Kolmogorov-Smirnov). Shares are read
    off the percentiles of both, so the distance is right to within 0.02 and
    the two rank errors. One scan of each frame; NULL where a side has no value."""
    sides = [percentiles(quantile_sketches(df, columns)).select("column", F.col("percentiles").alias(f"points_{n}")) for n, df in (("a", a), ("b", b))]
    both = sides[0].join(sides[1], "column").withColumn("at", F.array_distinct(F.concat("points_a", "points_b")))
    upto = lambda side, x: F.size(F.filter(side, lambda p: p <= x)) / F.lit(float(len(PERCENTILES)))
    gaps = F.transform("at", lambda x: F.abs(upto(F.col("points_a"), x) - upto(F.col("points_b"), x)))
    return both.select("column", F.when(F.col("at").isNotNull(), F.array_max(gaps)).alias("distance"))

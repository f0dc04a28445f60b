"""Segmented (skew-safe) ordered windows equal the plain window."""

from pyspark.sql import functions as F

from lakeforge.operators import windows as WIN

SPECS = {"run": ("running_sum", "v"), "prev": ("lag", "v"), "nxt": ("lead", "v"), "first": ("first", "v"),
         "mov": ("moving_sum", "v", 3), "movn": ("moving_count", "v", 3)}


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_segmented_equals_plain_on_hot_key(spark):
    # Key 0 holds a third of the rows; segments of 7 ids, some segments
    # hold a single row, values include NULLs.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("o"),
        F.when(F.col("id") % 17 == 0, F.lit(None)).otherwise(F.col("id") % 11).cast("bigint").alias("v"))
    plain = WIN.plain_window(df, ["k"], ["o"], SPECS)
    seg = WIN.segmented_window(df, ["k"], ["o"], (F.col("o") / 7).cast("bigint"), SPECS)
    _same(plain, seg)
    mixed = WIN.skew_safe_window(df, ["k"], ["o"], (F.col("o") / 7).cast("bigint"), SPECS, hot_fraction=0.05,
                                 sample_fraction=1.0)
    _same(plain, mixed)


def test_single_row_segments(spark):
    df = spark.range(0, 40).select(F.lit(1).alias("k"), F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    _same(WIN.plain_window(df, ["k"], ["o"], SPECS), WIN.segmented_window(df, ["k"], ["o"], F.col("o"), SPECS))


def test_share_of_total(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], "k INT, v DOUBLE")
    got = sorted((r.k, r.s) for r in WIN.share_of_total(df, ["k"], "v", "s").collect())
    assert got == [(1, 0.25), (1, 0.75), (2, 1.0)]


def test_segmented_ranks_equal_plain(spark):
    # One group holds most rows, many ties on the rounded value.
    df = spark.range(0, 2000).select(
        F.when(F.col("id") % 4 == 0, F.lit("b")).otherwise(F.lit("a")).alias("g"), F.col("id").alias("id"),
        (F.col("id") * 7919 % 97).alias("v"))
    specs = {"rn": ("row_number", None), "rk": ("rank", None, ["-v"]), "dr": ("dense_rank", None, ["-v"])}
    order = [F.col("v").desc(), F.col("id")]
    plain = WIN.plain_window(df, ["g"], order, specs)
    seg = WIN.segmented_window(df, ["g"], order, -F.col("v"), specs)
    _same(plain, seg)
    _same(plain, WIN.skew_safe_window(df, ["g"], order, -F.col("v"), specs, hot_fraction=0.3, sample_fraction=1.0))


def test_sampled_hot_key_detection_finds_the_hot_key(spark):
    from lakeforge.operators.skew import hot_keys
    df = spark.range(0, 300000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    got = [r.k for r in hot_keys(df, "k", max_rows_per_key=50000, sample_fraction=0.05).collect()]
    assert got == [0]

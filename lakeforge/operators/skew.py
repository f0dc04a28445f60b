"""Skew handling for joins and aggregates: find the hot keys with a partial
aggregate, join them salted, join the rest normally.

A key is hot when it holds more rows than one task should handle,
``max_rows_per_key`` (or, when ``hot_fraction`` is given, the smaller of
that and ``hot_fraction`` of all rows), but the threshold is never so small
that more than ``max_hot_keys`` keys could pass it.

Detection reads only the key column of a Bernoulli sample
(``sample_fraction``, fixed seed) and keeps keys whose sampled count
exceeds half the scaled threshold: a key above 2M rows shows about 20k
sampled rows at 1%, so a miss is vanishingly unlikely, and a miss would
only cost speed (that key takes the plain path), never correctness. The
list stays below about 2x ``max_hot_keys``. Since at most ``total / threshold`` keys can exceed the threshold, the
hot list has a proven size bound (``max_hot_keys``) and is broadcast. The
threshold is a scalar subquery inside the same plan (no separate job). Hot rows of the big side are spread over
sub-keys by a hash of the row (deterministic, so retries reproduce it), as
many as the key's rows ask for; only the hot keys' rows of the other side
are replicated. The result equals the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MAX_ROWS_PER_KEY = 2_000_000
MAX_HOT_KEYS = 1_000_000


SAMPLE_FRACTION = 0.01


def hot_keys(df: DataFrame, key: str, hot_fraction: float | None = None,
             max_rows_per_key: int = MAX_ROWS_PER_KEY, max_hot_keys: int = MAX_HOT_KEYS,
             sample_fraction: float = SAMPLE_FRACTION, seed: int = 7) -> DataFrame:
    """Keys with more rows than the threshold (see module doc)."""
    keys = df.select(key)
    exact = sample_fraction >= 1.0
    if not exact:
        keys = keys.sample(fraction=sample_fraction, seed=seed)
    total = keys.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar() / F.lit(min(sample_fraction, 1.0))
    limit = F.lit(float(max_rows_per_key))
    if hot_fraction is not None:
        limit = F.least(total * F.lit(hot_fraction), limit)
    threshold = F.greatest(limit, total / F.lit(float(max_hot_keys)), F.lit(1.0))
    scaled = threshold * F.lit(1.0 if exact else 0.5 * sample_fraction)
    scale = F.lit(1.0 / min(sample_fraction, 1.0))
    return (keys.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > scaled)
            .select(key, (F.col("_n") * scale).cast("bigint").alias("_rows")))


def skew_join(big: DataFrame, other: DataFrame, key: str, other_key: str | None = None,
              salts: int = 2, hot_fraction: float | None = None, how: str = "inner",
              sample_fraction: float = SAMPLE_FRACTION, rows_per_salt: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Equi-join ``big`` to ``other`` on ``key`` with hot keys salted.

    A hot key gets one salt for every ``rows_per_salt`` of its rows,
    ``salts`` at least; every other key has salt 0, so there is one join.
    Rows of ``big`` without a key match nothing and are spread. For ``right``
    and ``full`` the replicated side cannot tell by itself which of its rows
    match: those without a partner are added once, by an anti join against
    the keys of ``big``."""
    ok = other_key or key
    if how not in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot do {how!r}")
    hot = hot_keys(big, key, hot_fraction, sample_fraction=sample_fraction).select(
        F.col(key).alias("_hot"), F.greatest(F.lit(salts), F.ceil(F.col("_rows") / F.lit(rows_per_salt))).cast("bigint").alias("_salts")).where("_hot IS NOT NULL")
    hot = F.broadcast(hot)                     # bounded, see the module text
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.coalesce("_salts", F.when(F.col(key).isNull(), 1024).otherwise(1)))
    left = big.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt).drop("_hot", "_salts")
    right = (other.join(hot, F.col(ok) == F.col("_hot"), "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1))).drop("_hot", "_salts"))
    kind = {"right": "inner", "full": "left"}.get(how, how)
    if ok == key:                              # shared key name: one key column, as join(on=key)
        out = left.join(right, [key, "_salt"], kind).drop("_salt")
    else:
        out = left.join(right, (left[key] == right[ok]) & (left["_salt"] == right["_salt"]), kind).drop("_salt")
    if how in ("right", "full"):
        known = big.select(F.col(key).alias("_known")).where("_known IS NOT NULL").distinct()
        alone = other.join(known, F.col(ok) == F.col("_known"), "left_anti")
        out = out.unionByName(alone, allowMissingColumns=True)
    return out


def salted_sum(df: DataFrame, key: str, value: str, salts: int = 32) -> DataFrame:
    """Two-step aggregate: per (key, salt), then per key."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).alias("_salt")
    step = df.groupBy(key, salt).agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return step.groupBy(key).agg(F.sum("_s").alias("total"), F.sum("_n").alias("rows"))

"""Joins of two streams with state that stays bounded.

Both sides carry a watermark and the condition bounds how far apart two rows
may be, so a row leaves the state once the other side's watermark has passed
the latest time a partner could have. With ``how="left"`` a left row without
a partner comes out, with NULLs, at that moment and not before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_within(left: DataFrame, right: DataFrame, key: str, right_key: str, left_time: str, right_time: str, within: str, delay: str, how: str = "inner") -> DataFrame:
    """Pairs of one key in which the right row comes at the same time or up
    to ``within`` later. Times must be TIMESTAMP; rows more than ``delay``
    behind the latest of their side may be dropped."""
    if how not in ("inner", "left"):
        raise ValueError(f"join_within cannot do {how!r}")
    a, b = left.withWatermark(left_time, delay), right.withWatermark(right_time, delay)
    span = F.expr(f"INTERVAL {within}")
    soon = (F.col(right_key) == F.col(key)) & (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + span)
    return a.join(b, soon, "leftOuter" if how == "left" else "inner")

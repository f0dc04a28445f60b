"""Plan inspection for plan-shape tests: the formatted physical plan as
text, captured from ``DataFrame.explain``."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def has_node(df: DataFrame, node: str) -> bool:
    return node in explain_text(df)

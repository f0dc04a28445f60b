"""Named queries, one module per inventory section; each pairs a Spark
builder with its DuckDB oracle SQL in the registry."""

import importlib

from lakeforge.plans.registry import REGISTRY, Query, query

SECTIONS = ("projection", "scalars", "nested", "nulls", "joins", "temporal", "aggregates", "windows", "io", "upserts", "quality", "layout", "physical", "streams", "outline", "stateful", "extras")


def load_all() -> dict[str, Query]:
    for s in SECTIONS:
        importlib.import_module(f"lakeforge.plans.{s}")
    return REGISTRY


__all__ = ["REGISTRY", "Query", "query", "load_all"]

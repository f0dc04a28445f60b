"""lakeforge: reusable Spark DataFrame / SQL / Structured Streaming operators
for star-schema analytics (ingest, projection, joins, aggregation, windows,
nested data, NULL handling, upserts, data-quality rules, layout, streams).

Every operator is a function from DataFrames to a DataFrame (lazy plan), so
Catalyst sees the whole query and can push filters, prune columns, pick join
strategies and re-plan adaptively.
"""

from lakeforge.session import get_session, scratch_root

__all__ = ["get_session", "scratch_root"]

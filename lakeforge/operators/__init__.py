"""Relational, window, upsert, quality and layout operators over DataFrames."""

"""Structured Streaming: incremental runs, multi-hop flows, watermarks."""

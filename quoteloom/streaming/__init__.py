"""Continuous ingestion with Structured Streaming."""

from .landing import stream_csv, stream_json, stream_table

__all__ = ["stream_csv", "stream_json", "stream_table"]

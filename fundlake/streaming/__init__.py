"""Incremental ingest of Bronze landing files (Structured Streaming)."""

from fundlake.streaming.ingest import bronze_stream, ingest, rebuild_dates

__all__ = ["bronze_stream", "ingest", "rebuild_dates"]

"""Incremental ingestion of posting files with Structured Streaming."""

from payscope.streaming.ingest import clean_stream, ingest, read_ingested

__all__ = ["clean_stream", "ingest", "read_ingested"]

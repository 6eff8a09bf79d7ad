"""The same ingestion as a file stream."""

from martloom.streaming.ingest import ingest_stream

__all__ = ["ingest_stream"]

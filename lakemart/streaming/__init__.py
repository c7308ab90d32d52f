"""Structured Streaming entry points (incremental bronze ingest)."""

from .ingest import bronze_stream, ingest_available

__all__ = ["bronze_stream", "ingest_available"]

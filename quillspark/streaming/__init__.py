"""Structured Streaming jobs."""

from .incremental import ingest_batch, start_ingest

__all__ = ["ingest_batch", "start_ingest"]

"""Structured Streaming forms of the batch jobs."""

from vesseltrack.streaming.ingest import ingest_stream, stream_checkpoint

__all__ = ["ingest_stream", "stream_checkpoint"]

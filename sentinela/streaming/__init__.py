"""Structured Streaming jobs (incremental landing)."""

from sentinela.streaming.land import archive_stream, land_archives

__all__ = ["archive_stream", "land_archives"]

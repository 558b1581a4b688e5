"""Streaming append of landed files."""

from millrace.streaming.append import append_stream

__all__ = ["append_stream"]

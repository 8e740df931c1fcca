"""Structured Streaming entry points."""

from .stream import read_cef_stream, write_cef_stream

__all__ = ["read_cef_stream", "write_cef_stream"]

"""Scalar column functions (usable on any string column, batch or stream)."""

from .escape import escape_extension as cef_escape_extension
from .escape import escape_header as cef_escape_header
from .tokens import extensions_map as cef_extensions
from .tokens import header_struct as cef_header
from .values import to_timestamp as cef_timestamp

__all__ = [
    "cef_escape_extension", "cef_escape_header", "cef_extensions", "cef_header", "cef_timestamp",
]

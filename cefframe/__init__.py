"""cefframe: Common Event Format (CEF) logs on Spark, as Catalyst expressions.

Read, infer, parse, pivot and encode CEF with the DataFrame API; the same
functions work on files, on any string column and on streams.
"""

from .functions import (cef_escape_extension, cef_escape_header, cef_extensions, cef_header,
                        cef_timestamp)
from .functions.sql import register_cef_functions
from .operators.encode import to_cef_lines
from .operators.infer import infer_cef_schema
from .operators.parse import REASONS, flag_malformed, parse_cef, split_malformed, with_parse_error
from .options import CefOptions, CefOptionsError
from .schema import HEADER_FIELDS, KEY_TYPES
from .sources import read_cef, register_cef_view, write_cef
from .sources.quarantine import quarantine_cef, read_split, split_stream, with_origin, write_split
from .sources.summary import key_summary, promote_rest, summary_schema, update_key_summary
from .streaming import read_cef_stream, write_cef_stream

__all__ = [
    "CefOptions", "CefOptionsError", "HEADER_FIELDS", "KEY_TYPES", "REASONS",
    "cef_escape_extension", "cef_escape_header", "cef_extensions", "cef_header", "cef_timestamp",
    "flag_malformed", "infer_cef_schema", "key_summary", "parse_cef", "promote_rest", "quarantine_cef",
    "read_cef", "read_cef_stream", "read_split", "register_cef_functions", "register_cef_view",
    "split_malformed", "split_stream", "summary_schema", "to_cef_lines", "update_key_summary",
    "with_origin", "with_parse_error", "write_cef", "write_cef_stream", "write_split",
]

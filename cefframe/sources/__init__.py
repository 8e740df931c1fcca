"""File sources and sinks for CEF text."""

from .files import infer_files_schema, read_cef, register_cef_view, write_cef

__all__ = ["infer_files_schema", "read_cef", "register_cef_view", "write_cef"]

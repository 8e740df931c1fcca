"""Escaping of header and extension text for CEF output (writer side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _newlines(c: Column, repl: str) -> Column:
    r"""``\r\n``, ``\r`` and ``\n`` -> ``repl``: the same as the regex ``\r\n|\r|\n``,
    but as literal replaces (no regex engine per value)."""
    for nl in ("\r\n", "\r", "\n"):
        c = F.replace(c, F.lit(nl), F.lit(repl))
    return c


def escape_header(c: Column) -> Column:
    """``\\|`` -> ``|``, ``\\`` -> ``\\\\``, ``|`` -> ``\\|``, newline -> space."""
    v = F.replace(c, F.lit("\\|"), F.lit("|"))
    v = F.replace(v, F.lit("\\"), F.lit("\\\\"))
    v = F.replace(v, F.lit("|"), F.lit("\\|"))
    return _newlines(v, " ")


def escape_extension(c: Column) -> Column:
    """``\\=`` -> ``=``, ``\\`` -> ``\\\\``, ``=`` -> ``\\=``, newline -> ``\\n``."""
    v = F.replace(c, F.lit("\\="), F.lit("="))
    v = F.replace(v, F.lit("\\"), F.lit("\\\\"))
    v = F.replace(v, F.lit("="), F.lit("\\="))
    return _newlines(v, "\\n")

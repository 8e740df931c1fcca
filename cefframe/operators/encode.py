"""``to_cef_lines``: DataFrame -> one CEF text line per row (column ``value``).

Headers are validated on the driver before any job; nulls in headers and a
bad ``CEFVersion`` fail the task through ``raise_error``.  Everything else is
a single Project of built-in string functions.
"""

from __future__ import annotations

import logging
import re
from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.escape import escape_extension, escape_header
from ..options import CefOptions, resolve

log = logging.getLogger(__name__)

NULL_HEADER_MESSAGE = "Mandatory fields cannot contain null values"
VERSION_MESSAGE = "CEFVersion field must end with the CEF version information, e.g. 'CEF:0'"
_SIMPLE_NAME = r"^[\w._-]+$"


def _schema_error() -> ValueError:
    req = "\n".join(f"{h}: string" for h in S.HEADER_FIELDS)
    return ValueError(f"Schema must contain required CEF fields:\n{req}")


def split_fields(schema: T.StructType, exclude: Iterable[str] = ()) -> tuple[list[str], list[T.StructField]]:
    """(header column names in canonical order, extension fields in schema order)."""
    excluded = set(exclude)
    header_cols: list[str | None] = [None] * len(S.HEADER_FIELDS)
    matched = 0
    extensions: list[T.StructField] = []
    for f in schema.fields:
        if f.name in excluded:
            continue
        idx = next((i for i, h in enumerate(S.HEADER_FIELDS)
                    if h.lower() == f.name.lower() and isinstance(f.dataType, T.StringType)), None)
        if idx is None:
            extensions.append(f)
        else:
            matched += 1
            header_cols[idx] = f.name
    if matched != len(S.HEADER_FIELDS) or any(h is None for h in header_cols):
        raise _schema_error()
    return [h for h in header_cols if h is not None], extensions


def _value_text(c: Column, dt: T.DataType, opts: CefOptions) -> Column | None:
    if isinstance(dt, T.StringType):
        return escape_extension(c)
    if isinstance(dt, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        return c.cast("string")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        ts = c.cast("timestamp") if isinstance(dt, T.TimestampNTZType) else c
        if opts.date_format_is_epoch:
            fn = F.unix_micros if opts.epoch_unit == "micros" else F.unix_millis
            return fn(ts).cast("string")
        return F.date_format(ts, opts.date_format)
    return None


def to_cef_lines(df: DataFrame, options: CefOptions | Mapping[str, Any] | None = None,
                 keep: Iterable[str] = (), **kwargs: Any) -> DataFrame:
    """Encode every row as a CEF line in column ``value``; ``keep`` columns are
    carried along unencoded (e.g. for ``partitionBy`` on write)."""
    opts = resolve(options, **kwargs)
    keep = list(keep)
    header_cols, extensions = split_fields(df.schema, exclude=keep)
    nv = F.lit(opts.null_value)

    heads = []
    for i, name in enumerate(header_cols):
        c = F.coalesce(F.col(f"`{name}`"), F.raise_error(F.lit(NULL_HEADER_MESSAGE)))
        if i == 0:
            c = F.when(F.lower(c).endswith("cef:0"), c).otherwise(F.raise_error(F.lit(VERSION_MESSAGE)))
        heads.append(escape_header(c))

    exts = []
    for f in extensions:
        if not re.match(_SIMPLE_NAME, f.name):
            log.warning("Column '%s' is written but cannot be read back as a CEF key", f.name)
        text = _value_text(F.col(f"`{f.name}`"), f.dataType, opts)
        if text is None:
            log.warning("Column '%s' has unsupported type %s; written as the null token",
                        f.name, f.dataType.simpleString())
            text = nv
        exts.append(F.concat(F.lit(f.name + "="), F.coalesce(text, nv)))

    ext_text = F.concat_ws(" ", *exts) if exts else F.lit("")
    line = F.concat(F.concat_ws("|", *heads), F.lit("|"), ext_text)
    return df.select(line.alias("value"), *[F.col(f"`{k}`") for k in keep])

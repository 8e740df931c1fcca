"""Structured Streaming: parse CEF text arriving in a directory (or any
string column of a streaming DataFrame, e.g. Kafka ``value``) and write CEF
text from a stream.  Parsing is stateless, so no watermark or state store is
involved; ``mode=failfast`` fails the query, ``dropmalformed`` filters.
"""

from __future__ import annotations

import functools
from typing import Any, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.encode import to_cef_lines
from ..operators.parse import parse_cef
from ..options import resolve
from ..sources.files import _split_options, infer_files_schema


# Options of the streaming source that a batch read does not know.
_STREAM_ONLY = ("maxfilespertrigger", "maxbytespertrigger", "latestfirst", "maxfileage", "cleansource",
                "sourcearchivedir", "filenameonly", "maxcachedfiles", "discardcachedinputratio")


def read_cef_stream(spark: SparkSession, *paths: str | Iterable[str], schema: T.StructType | None = None,
                    options: Mapping[str, Any] | None = None, rest: str | None = None, **kwargs: Any) -> DataFrame:
    """Stream CEF files from one or more paths (one stream per path, united).  Without ``schema`` the
    schema is inferred once from the files already there (fixed for the query's life).

    ``rest`` names a map column for the pairs that have no column yet, so that keys which first turn
    up in a later micro-batch are not lost: see :mod:`cefframe.operators.summary` for the schema of
    the next start.
    """
    flat: list[str] = []
    for p in paths:
        flat.extend([p] if isinstance(p, str) else list(p))
    cef_opts, spark_opts = _split_options(options, kwargs)
    opts = resolve(cef_opts)
    if schema is None:
        batch_opts = {k: v for k, v in spark_opts.items() if k.lower() not in _STREAM_ONLY}
        schema = infer_files_schema(spark, flat, opts, batch_opts)
    reader = spark.readStream
    for k, v in spark_opts.items():
        reader = reader.option(k, v)
    streams = [parse_cef(reader.text(p), schema, "value", opts, rest=rest) for p in flat]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)


def write_cef_stream(df: DataFrame, path: str, checkpoint_location: str,
                     partition_by: Iterable[str] | None = None,
                     options: Mapping[str, Any] | None = None, **kwargs: Any) -> DataStreamWriter:
    """A ``DataStreamWriter`` writing CEF lines to ``path``; call ``.start()``."""
    parts = list(partition_by or [])
    cef_opts, spark_opts = _split_options(options, kwargs)
    writer = (to_cef_lines(df, resolve(cef_opts), keep=parts).writeStream.format("text")
              .option("path", path).option("checkpointLocation", checkpoint_location))
    for k, v in spark_opts.items():
        writer = writer.option(k, v)
    if parts:
        writer = writer.partitionBy(*parts)
    return writer

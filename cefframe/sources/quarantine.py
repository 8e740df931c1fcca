"""M6 quarantine in one pass: good and bad lines of a batch or a stream go to one Parquet table.

``flag_malformed`` parses each line once and says what is wrong with it; the write deals the rows out
by a flag, which is a partition directory, so each side is read back without the other's files::

    out/_cef_bad=false/   the columns of the schema and the other input columns
    out/_cef_bad=true/    the raw line, the reason, file and offset of the split it was read from

Bad rows keep the fields that could be parsed as well, for repair.  Writing needs no sort: each task
keeps one open file a side.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.parse import ERROR_COL, RAW_COL, flag_malformed
from ..options import CefOptions, resolve

BAD_COL, FILE_COL, OFFSET_COL = "_cef_bad", "_cef_file", "_cef_offset"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def with_origin(lines: DataFrame) -> DataFrame:
    """Lines of a file source with the file and the offset of the split that each line starts in or after."""
    return lines.select("*", F.col("_metadata.file_path").alias(FILE_COL),
                        F.col("_metadata.file_block_start").alias(OFFSET_COL))


def _rows(df: DataFrame, schema: T.StructType, column: str, options: Any, counts: Any, rest: str | None,
          kwargs: Mapping[str, Any]) -> DataFrame:
    flagged = flag_malformed(df, schema, column, options, counts=counts, rest=rest, **kwargs)
    bad = F.col(ERROR_COL).isNotNull()
    return flagged.withColumn(BAD_COL, bad).withColumn(RAW_COL, F.when(bad, F.col(RAW_COL)))


@contextmanager
def _two_writers(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(WRITERS)
    if int(before) < 2:
        spark.conf.set(WRITERS, "2")
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def write_split(df: DataFrame, schema: T.StructType, path: str, column: str = "value",
                options: CefOptions | Mapping[str, Any] | None = None, *, mode: str = "errorifexists",
                counts: Observation | None = None, rest: str | None = None, **kwargs: Any) -> tuple[DataFrame, DataFrame]:
    """Parse ``df`` once, store both sides under ``path`` and return (good rows, bad rows) read from there.

    The parse mode has no say here: all lines are kept.  ``mode`` is the save mode; with ``append`` the
    results hold the earlier rows too.
    """
    rows = _rows(df, schema, column, options, counts, rest, kwargs)
    with _two_writers(df.sparkSession):
        rows.write.mode(mode).partitionBy(BAD_COL).parquet(path)
    return _sides(df.sparkSession, path, rows.schema)


def split_stream(df: DataFrame, schema: T.StructType, path: str, checkpoint_location: str, column: str = "value",
                 options: CefOptions | Mapping[str, Any] | None = None, *, counts: str | None = None,
                 rest: str | None = None, **kwargs: Any) -> DataStreamWriter:
    """The same for a stream; call ``.start()``.  The file sink commits each micro-batch once, both sides."""
    rows = _rows(df, schema, column, options, counts, rest, kwargs)
    return (rows.writeStream.format("parquet").partitionBy(BAD_COL).option("path", path)
            .option("checkpointLocation", checkpoint_location))


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) of a table that :func:`write_split` or :func:`split_stream` wrote."""
    return _sides(spark, path, spark.read.parquet(path).schema)


def _sides(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    fields = [f for f in schema.fields if f.name != BAD_COL]
    table = spark.read.schema(T.StructType([*fields, T.StructField(BAD_COL, T.BooleanType())])).parquet(path)
    good = table.filter(~F.col(BAD_COL)).drop(BAD_COL, RAW_COL, ERROR_COL, FILE_COL, OFFSET_COL)
    origin = [c for c in (FILE_COL, OFFSET_COL) if c in table.columns]
    others = [c for c in good.columns]
    bad = table.filter(F.col(BAD_COL)).select(RAW_COL, ERROR_COL, *origin,
                                              *["`" + c.replace("`", "``") + "`" for c in others])
    return good, bad


def quarantine_cef(spark: SparkSession, *paths: str, out: str, schema: T.StructType | None = None,
                   options: Mapping[str, Any] | None = None, mode: str = "errorifexists",
                   counts: Observation | None = None, rest: str | None = None, **kwargs: Any) -> tuple[DataFrame, DataFrame]:
    """Read CEF files once and store good and bad lines under ``out``; bad ones with their file and offset."""
    from .files import _split_options, _text_reader, infer_files_schema
    cef_opts, spark_opts = _split_options(options, kwargs)
    opts = resolve(cef_opts)
    if schema is None:
        schema = infer_files_schema(spark, list(paths), opts, spark_opts)
    lines = with_origin(_text_reader(spark, spark_opts).text(list(paths)))
    return write_split(lines, schema, out, "value", opts, mode=mode, counts=counts, rest=rest)

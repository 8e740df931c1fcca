"""File source and sink: ``read_cef``, ``write_cef``, ``register_cef_view``.

Reading is Spark's text source (splittable plain text, gzip / bzip2 by
extension, globs, partition discovery, ``pathGlobFilter``,
``recursiveFileLookup``) followed by :func:`parse_cef`.  Writing is
:func:`to_cef_lines` followed by Spark's text sink.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.encode import to_cef_lines
from ..operators.infer import build_schema, first_seen_names, log_inferred
from ..operators.parse import parse_cef
from ..options import CefOptions, _BY_NORM, _norm, near_miss, resolve

# A limit of up to so many lines is taken by the driver, which stops the scan early.
TAKE = 100_000
# Files are read together up to so many bytes, or as many as have been read before.
TOGETHER = 64 << 20
# A larger file in a codec that cannot be split is dealt out to more tasks right after the scan.
LARGE_UNSPLIT = 64 << 20
UNSPLIT = (".gz", ".zst", ".lz4", ".snappy", ".deflate")
NO_FILES_MESSAGE = "Unable to infer schema for CEF. It must be specified manually."


def _split_options(options: Mapping[str, Any] | None, kwargs: Mapping[str, Any]):
    """Separate CEF options from options for Spark's text source / sink, which get all others.

    Spark matches its option names ignoring case; a name that is a misspelling of a CEF option is
    left to CefOptions, which reports it.
    """
    cef: dict[str, Any] = {}
    spark_opts: dict[str, str] = {}
    for key, value in {**(options or {}), **kwargs}.items():
        if _norm(key) in _BY_NORM or near_miss(key) is not None:
            cef[key] = value
        else:
            spark_opts[key] = str(value).lower() if isinstance(value, bool) else str(value)
    return cef, spark_opts


def _text_reader(spark: SparkSession, spark_opts: Mapping[str, str]):
    reader = spark.read
    for k, v in spark_opts.items():
        reader = reader.option(k, v)
    return reader


def infer_files_schema(spark: SparkSession, paths: list[str], opts: CefOptions,
                       spark_opts: Mapping[str, str] | None = None) -> T.StructType:
    """Names in the order of (file path, offset, place in line).

    All lines of all files count, in one scan.  With ``maxRecords`` = N only the first N lines
    do, and the scan stops there: files are taken in path order, 1, 2, 4, ... at a time (fewer where
    they are large), and a file on its own gives its first lines from its first splits.  So the
    bytes read follow N, not the files' size, and the jobs follow the logarithm of their number.
    """
    started = time.monotonic()
    # A private option keeps these reads from matching a cached read of the same
    # paths (inputFiles() of a cached plan is empty).
    listing = _text_reader(spark, {**(spark_opts or {}), "cefframe.inference": "true"}).text(paths)
    inputs = [c for c in listing.columns if c != "value"]
    n = opts.effective_max_records
    if n is None:
        lines = listing.select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                               F.monotonically_increasing_id().alias("j"))
        found = first_seen_names(lines, opts, "value", F.col("j"), ("f", "b"))
        if not found and not listing.inputFiles():
            raise ValueError(NO_FILES_MESSAGE)
    else:
        files = file_sizes(spark, paths, spark_opts)
        if not files:
            raise ValueError(NO_FILES_MESSAGE)
        found = _names_of_first_lines(spark, listing, files, opts, n)
    case_sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    schema = build_schema(found, opts, case_sensitive, inputs)
    log_inferred(schema, n, started)
    return schema


def file_sizes(spark: SparkSession, paths: list[str], spark_opts: Mapping[str, str] | None = None) -> list[tuple[str, int]]:
    """(file, bytes) of all files of a read in path order; no contents are read."""
    reader = spark.read.format("binaryFile")
    for k, v in (spark_opts or {}).items():
        reader = reader.option(k, v)
    rows = reader.load(paths).select("_metadata.file_path", "_metadata.file_size").collect()
    return sorted((r["file_path"], r["file_size"]) for r in rows)


def _doubling(files: list[tuple[str, int]]) -> Iterator[list[str]]:
    """Consecutive files, 1, 2, 4, ... of them, as long as their bytes stay within bounds."""
    at = seen = 0
    most = 1
    while at < len(files):
        taken, size = 1, files[at][1]
        while (taken < most and at + taken < len(files)
               and size + files[at + taken][1] <= max(TOGETHER, seen)):
            size += files[at + taken][1]
            taken += 1
        yield [name for name, _ in files[at:at + taken]]
        at, seen, most = at + taken, seen + size, 2 * most


def _within(first: str, last: str) -> Column:
    """Files from ``first`` to ``last``, by their metadata, so that no character of a name is taken for a
    pattern and only these files are scanned.  A URI without a host may have one slash or three."""
    path = F.col("_metadata.file_path")
    one, three = (lambda u: re.sub(r"^(\w+):/+", r"\1:/", u)), (lambda u: re.sub(r"^(\w+):/(?!/)", r"\1:///", u))
    return path.between(one(first), one(last)) | path.between(three(first), three(last))


def _names_of_first_lines(spark: SparkSession, listing: DataFrame, files: list[tuple[str, int]], opts: CefOptions,
                          n: int) -> list:
    """Names in the first ``n`` lines; up to TAKE of them at a time pass the driver."""
    found: list = []
    lines: list[str] = []
    for rank, names in enumerate(_doubling(files)):
        part = listing.filter(_within(names[0], names[-1])).select(
            "value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
            F.monotonically_increasing_id().alias("j"))
        if n <= TAKE:
            # One file alone is left after its first lines; of several, all lines are ranked.
            first = part if len(names) == 1 else part.orderBy("f", "b", "j")
            taken = [r["value"] for r in first.limit(n).select("value").collect()]
            lines += taken
            n -= len(taken)
        else:
            frame = part.orderBy("f", "b", "j").limit(n)
            found += [((rank, place), name, src) for place, name, src in first_seen_names(frame, opts, "value", F.col("j"), ("f", "b"))]
            n -= frame.count()
        if n <= 0:
            break
    if lines:
        frame = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, i long")
        found += [((len(files), place), name, src)
                  for place, name, src in first_seen_names(frame, opts, "value", F.col("i"), few=True)]
    return found


def read_cef(spark: SparkSession, *paths: str | Iterable[str], schema: T.StructType | str | None = None,
             options: Mapping[str, Any] | None = None, counts: Observation | None = None, rest: str | None = None,
             **kwargs: Any) -> DataFrame:
    """S1-S5: read CEF files (one or more paths or globs) into a typed DataFrame.

    A large file in a codec that cannot be split (gzip) is read by one task, but parsed by many: its
    lines are rebalanced right after the scan.  ``counts`` and ``rest``: see :func:`parse_cef`.
    """
    flat: list[str] = []
    for p in paths:
        flat.extend([p] if isinstance(p, str) else list(p))
    cef_opts, spark_opts = _split_options(options, kwargs)
    opts = resolve(cef_opts)
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)  # noqa: SLF001 - public DDL parser
    if schema is None:
        schema = infer_files_schema(spark, flat, opts, spark_opts)
    text = _text_reader(spark, spark_opts).text(flat)
    if any(f.endswith(UNSPLIT) for f in text.inputFiles()):
        large = [f for f, size in file_sizes(spark, flat, spark_opts) if f.endswith(UNSPLIT) and size > LARGE_UNSPLIT]
        text = text.hint("rebalance") if large else text
    return parse_cef(text, schema, "value", opts, counts=counts, rest=rest)


def register_cef_view(spark: SparkSession, name: str, *paths: str, **kwargs: Any) -> DataFrame:
    """S6: make CEF files queryable from SQL as a temporary view."""
    df = read_cef(spark, *paths, **kwargs)
    df.createOrReplaceTempView(name)
    return df


def write_cef(df: DataFrame, path: str, mode: str = "errorifexists",
              partition_by: Iterable[str] | str | None = None,
              options: Mapping[str, Any] | None = None, **kwargs: Any) -> None:
    """S7-S9: write ``df`` as CEF text (``compression``, ``lineSep`` supported).

    Partitioned output is rebalanced by its partition columns first: adaptive execution joins the
    lines of a small value in one file and splits those of a large one by bytes, so the number of
    files follows the data and not the number of tasks.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    cef_opts, spark_opts = _split_options(options, kwargs)
    lines = to_cef_lines(df, resolve(cef_opts), keep=parts)
    if parts:
        lines = lines.hint("rebalance", *[F.col("`" + c.replace("`", "``") + "`") for c in parts])
    writer = lines.write.mode(mode)
    for k, v in spark_opts.items():
        writer = writer.option(k, v)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.text(path)

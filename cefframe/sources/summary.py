"""I1 over time: a mergeable summary of the keys that files hold, and schemas that grow with it.

Inference over all lines is one aggregate; a summary keeps its state per file, so a new day's files
are read and the old ones are not.  A store is a folder with two Parquet tables, appended to only::

    keys    batch, file, name, first (block, line, place, source key), n (pairs)
    files   batch, file, size, modified (null: the file is gone), options

A file's latest row in ``files`` says which batch of ``keys`` counts for it, and it is written after
that batch, so an update that failed half-way leaves nothing that counts.  Changed files are read
again, files that are gone no longer count: the merged summary is that of a full scan.

Streams: a running query has a fixed schema.  ``parse_cef(..., rest="_rest")`` keeps the pairs that
have no column yet; at the next start ``update_key_summary`` gives a schema with the new keys, and
``promote_rest`` reads what was written before with that schema.
"""

from __future__ import annotations

import time
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions import values as V
from ..operators.infer import MOST_NAMES, _names, build_schema, first_places, log_inferred
from ..options import CefOptions, resolve
from .files import NO_FILES_MESSAGE, _split_options, _text_reader

FILES = "batch long, file string, size long, modified timestamp, options string"
KEYS = "batch long, file string, name string, first struct<b:long,i:long,p:int,src:string>, n long"


def _fingerprint(opts: CefOptions) -> str:
    """The options that decide which names a line gives."""
    return repr((opts.pivot_fields, opts.null_value, opts.repair_trailing, opts.defensive_mode, opts.unescape))


def _table(spark: SparkSession, store: str, name: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(f"{store}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _latest(files: DataFrame) -> DataFrame:
    """One row per file that is there: its latest batch."""
    last = files.groupBy("file").agg(F.max(F.struct("batch", "size", "modified", "options")).alias("l"))
    return last.filter("l.modified IS NOT NULL").select("file", "l.*")


def _listing(spark: SparkSession, paths: list[str], spark_opts: Mapping[str, str]) -> DataFrame:
    reader = spark.read.format("binaryFile")
    for k, v in spark_opts.items():
        reader = reader.option(k, v)
    return reader.load(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                                     F.col("_metadata.file_modification_time").alias("modified"))


def update_key_summary(spark: SparkSession, store: str, *paths: str, options: Mapping[str, Any] | None = None,
                       **kwargs: Any) -> T.StructType:
    """Read the files under ``paths`` that are new or changed since the last update; the schema of all of them.

    The driver handles one row per new file and one per name.  One writer at a time may update a store.
    """
    started = time.monotonic()
    cef_opts, spark_opts = _split_options(options, kwargs)
    opts = resolve(cef_opts)
    if opts.effective_max_records is not None:
        raise ValueError("A summary covers all lines: maxRecords cannot limit it.")
    files = _table(spark, store, "files", FILES)
    latest = _latest(files)
    others = latest.filter(F.col("options") != _fingerprint(opts)).limit(1).count()
    if others:
        raise ValueError("The summary was made with other options (pivotFields, nullValue, repairs, unescape).")
    old = latest.select("file", F.col("size").alias("old_size"), F.col("modified").alias("old_modified"))
    # One row per file: in the listing, in the store, or both.
    joined = _listing(spark, list(paths), spark_opts).join(old, "file", "full")
    changed = joined.filter(~(F.col("size").eqNullSafe(F.col("old_size")) & F.col("modified").eqNullSafe(F.col("old_modified"))))
    rows = changed.select("file", "size", "modified").collect()
    batch = (files.agg(F.max("batch")).first()[0] or 0) + 1
    listing = _text_reader(spark, {**spark_opts, "cefframe.inference": "true"}).text(list(paths))
    inputs = [c for c in listing.columns if c != "value"]
    fresh = [r["file"] for r in rows if r["modified"] is not None]
    if fresh:
        path = F.col("_metadata.file_path")
        # By their metadata, so that only these files are scanned.
        lines = listing.filter(path.isin(fresh)).select("value", F.struct(
            path.alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("o"))
        names = _names(lines, "value", F.col("o"), opts).filter("name IS NOT NULL")
        # No sort of all pairs: see first_places.
        (first_places(names, [F.col("o.f").alias("file"), F.col("o.b").alias("b")], F.col("o.i")).groupBy("file", "name")
         .agg(F.min(F.struct("b", "i", "p", "src")).alias("first"), F.sum("n").alias("n"))
         .select(F.lit(batch).cast("long").alias("batch"), "file", "name", "first", "n")
         .write.mode("append").parquet(f"{store}/keys"))
    if rows:
        done = spark.createDataFrame([(batch, r["file"], r["size"], r["modified"], _fingerprint(opts)) for r in rows], FILES)
        done.write.mode("append").parquet(f"{store}/files")
    schema = summary_schema(spark, store, opts, inputs)
    log_inferred(schema, None, started)
    return schema


def key_summary(spark: SparkSession, store: str) -> DataFrame:
    """The merged summary: name, first (file, block, line, place, source key), n (pairs), files (that hold it)."""
    latest = _latest(_table(spark, store, "files", FILES)).select("file", "batch")
    keys = _table(spark, store, "keys", KEYS).join(latest, ["file", "batch"])
    first = F.min(F.struct("file", "first.b", "first.i", "first.p", "first.src"))
    return keys.groupBy("name").agg(first.alias("first"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("files"))


def summary_schema(spark: SparkSession, store: str, options: CefOptions | Mapping[str, Any] | None = None,
                   inputs: list[str] | tuple[str, ...] = ()) -> T.StructType:
    """The schema of all files of a store, as inference over them would give it."""
    if not _latest(_table(spark, store, "files", FILES)).limit(1).count():
        raise ValueError(NO_FILES_MESSAGE)
    rows = key_summary(spark, store).limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"More than {MOST_NAMES} distinct extension keys: the keys look like free text. Supply a schema.")
    case_sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    found = [(tuple(r["first"])[:4], r["name"], r["first"]["src"]) for r in rows]
    return build_schema(found, resolve(options), case_sensitive, inputs)


def promote_rest(df: DataFrame, schema: T.StructType, rest: str = "_rest") -> DataFrame:
    """Rows that were parsed with an older schema, in the columns of ``schema``.

    A column that the table lacks, or has no value in, is filled from the map ``rest``, typed as
    ``schema`` says; names that have a column leave the map, which is null once it is empty.
    """
    have = {c.lower(): c for c in df.columns}
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    # The texts first, in a Project of their own: typed conversion reads its input several times.
    texts = {f.name: f"__cef_rest{i}" for i, f in enumerate(schema.fields)}
    step = df.select("*", *[F.try_element_at(quoted(rest), F.lit(n)).alias(t) for n, t in texts.items()])

    def value(f: T.StructField) -> Column:
        kept = V.convert(F.col(texts[f.name]), f.dataType)
        if f.name.lower() in have:
            kept = F.coalesce(quoted(have[f.name.lower()]).cast(f.dataType), kept)
        return kept.cast(f.dataType).alias(f.name)

    names = [f.name for f in schema.fields]
    left = F.map_filter(quoted(rest), lambda k, _: ~k.isin(names))
    lower = {n.lower() for n in names}
    others = [quoted(c) for c in df.columns if c.lower() not in lower and c != rest]
    return step.select(*[value(f) for f in schema.fields], F.when(F.size(left) > 0, left).alias(rest), *others)

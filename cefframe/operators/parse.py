"""``parse_cef``: CEF text column -> typed DataFrame, as pure Catalyst expressions.

Plan shape (one narrow stage, no shuffle, no Python worker)::

    Project [value, pieces, <input columns>]                   split of the header
    Filter  [mode: error IS NULL | raise_error(error)]         (dropmalformed / failfast)
    Project [headers, error, regexp_extract_all(ext, pair, 0)] one regex pass per row
    Project [keys]            Project [raw value per column]   Project [typed columns]
    Expand  [typed columns behind it: computed once]
    Project [columns of the schema]

Columns the query does not use are pruned by Catalyst: a header-only query never runs the extension
regex.  A filter on a header or an input column (directory partitions included) passes below the
parse; a filter on an extension column reads the computed column.
"""

from __future__ import annotations

from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import tokens as TK
from ..functions import values as V
from ..functions.once import computed_once
from ..options import CefOptions, resolve
from . import pivot as PV

FAILFAST_PREFIX = ("Malformed records are detected in record parsing. Parse Mode: FAILFAST. "
                   "To process malformed records as null result, try setting the option 'mode' "
                   "as 'PERMISSIVE'. Reason: ")

_P = "__cef_"  # prefix of internal columns


def _header_index(name: str) -> int | None:
    for i, h in enumerate(S.HEADER_FIELDS):
        if h.lower() == name.lower():
            return i
    return None


def _needs_label_map(fields: list[T.StructField]) -> bool:
    suf = S.CONFLICT_SUFFIX
    return any(f.name.endswith(suf) and S.is_header(f.name[: -len(suf)]) for f in fields)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def name_rule(df: DataFrame):
    """How this session compares column names: as they are, or ignoring case."""
    return (lambda n: n) if df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true" else str.lower


def parse_cef(df: DataFrame, schema: T.StructType, column: str = "value",
              options: CefOptions | Mapping[str, Any] | None = None, *, counts: Observation | str | None = None,
              rest: str | None = None, **kwargs: Any) -> DataFrame:
    """Parse CEF lines in ``column`` into the columns of ``schema``.

    Other input columns (e.g. directory partition values) are kept after the parsed columns.  An
    input column that has the name of a schema column takes that column's place, as the partition
    values of Spark's file tables do.  ``options`` / keywords: ``mode``, ``nullValue``,
    ``pivotFields``, ``defensiveMode``, ``corruptRecordColumnName``, ...

    ``counts``: an ``Observation`` (for streams a name) that the next action fills with the number of
    ``lines``, of ``malformed`` ones, and of each reason (:data:`REASONS`), in every mode and
    without a second pass.  It counts all lines that are read, so filters on input columns no longer
    reach the scan.  In mode ``failfast`` the first malformed line ends the job.

    ``rest``: a further column of this name, a map of the pairs that have no column in ``schema``
    (by the name their column would have), null where there are none.
    """
    return _parse(df, schema, column, resolve(options, **kwargs), counts, rest)


def _parse(df: DataFrame, schema: T.StructType, column: str, opts: CefOptions, counts: Observation | str | None = None,
           rest: str | None = None, raw: str | None = None, reason: str | None = None) -> DataFrame:
    """:func:`parse_cef`; with columns ``raw`` and ``reason`` (null for a well-formed line) if named."""
    corrupt = opts.corrupt_record_column_name if opts.mode == "permissive" else None
    rule = name_rule(df)
    inputs = {rule(c): c for c in df.columns if c != column}
    parsed = [f for f in schema.fields if rule(f.name) not in inputs]
    headers = [(f, _header_index(f.name)) for f in parsed if not (corrupt and f.name == corrupt)]
    ext_fields = [f for f, idx in headers if idx is None]

    value = _quoted(column)
    line = TK.repair_line(value, opts.null_value, trailing=opts.repair_trailing, defensive=opts.defensive_mode,
                          escaped=opts.unescape)
    passed = {c: f"{_P}in{i}" for i, c in enumerate(inputs.values())}
    passed_cols = [F.col(p) for p in passed.values()]
    step = df.select(value.alias(_P + "value"), TK.split_header(line, escaped=opts.unescape).alias(_P + "pieces"),
                     *[_quoted(c).alias(p) for c, p in passed.items()])
    pieces = F.col(_P + "pieces")
    err = F.col(_P + "err")
    step = step.select(_P + "value", _P + "pieces", TK.header_error(pieces).alias(_P + "err"), *passed_cols)
    if not opts.pivot_fields:
        step = _observed(step, err, counts)
        step = _apply_mode(step, TK.whole_header(pieces), TK.header_error_text(pieces), opts.mode)

    header_cols = []
    for f, idx in headers:
        if idx is not None:
            h = TK.header_field(pieces, idx)
            header_cols.append((TK.unescape_header(h) if opts.unescape else h).alias(f"{_P}h{idx}"))
    heads = [F.col(f"{_P}h{idx}") for _, idx in headers if idx is not None]
    keep = [F.col(_P + "value"), err, *heads, *passed_cols]
    ext = TK.extension_text(pieces, collapse=not opts.unescape)
    step = step.select(_P + "value", err, *header_cols, *passed_cols, TK.extension_matches(ext).alias(_P + "m"))

    m = F.col(_P + "m")
    once: dict[str, str] = {}
    if opts.pivot_fields:
        step, clash = PV.pivoted_columns(step, m, ext_fields, keep, opts, _P, rest is not None)
        step = step.withColumn(_P + "perr", F.coalesce(err, F.when(clash, F.lit(PV.TYPE_CLASH_MESSAGE))))
        once[_P + "perr"] = _P + "error"
    else:
        step = _plain_columns(step, m, ext_fields, keep, opts, rest is not None)
    if rest:
        once[_P + "rest"] = _P + "others"
    once |= {f"{_P}t{i}": f"{_P}c{i}" for i in range(len(ext_fields))}
    step = computed_once(step.select(*keep, *once), once)
    error = F.col(_P + "error") if opts.pivot_fields else err
    if opts.pivot_fields:
        step = _observed(step, error, counts)
        step = _apply_mode(step, error.isNull(), error, opts.mode)

    place = {f.name: F.col(f"{_P}c{i}") for i, f in enumerate(ext_fields)}
    outputs: list[Column] = []
    for f in schema.fields:
        if rule(f.name) in inputs:
            outputs.append(F.col(passed[inputs[rule(f.name)]]).alias(f.name))
        elif corrupt and f.name == corrupt:
            # A null line is malformed as well; an empty text says so.
            outputs.append(F.when(error.isNotNull(), F.coalesce(F.col(_P + "value"), F.lit("")))
                           .cast(f.dataType).alias(f.name))
        elif (idx := _header_index(f.name)) is not None:
            outputs.append(F.col(f"{_P}h{idx}").cast(f.dataType).alias(f.name))
        else:
            outputs.append(place[f.name].cast(f.dataType).alias(f.name))
    named = {rule(f.name) for f in schema.fields}
    added = {rest: F.col(_P + "others"), raw: F.col(_P + "value"), reason: error}
    if clash := [n for n in added if n and (rule(n) in named or rule(n) in inputs)]:
        raise ValueError(f"The table already has a column '{clash[0]}'")
    outputs += [c.alias(n) for n, c in added.items() if n]
    return step.select(*outputs, *[F.col(passed[c]).alias(c) for k, c in inputs.items() if k not in named])


def _plain_columns(step: DataFrame, m: Column, ext_fields: list[T.StructField], keep: list[Column],
                   opts: CefOptions, rest: bool = False) -> DataFrame:
    """Typed extension columns ``t0``, ``t1``, ... (and the others); each stage is a Project over column references."""
    keys = TK.match_keys(m)
    if _needs_label_map(ext_fields):
        keys = F.transform(keys, PV.label_column_name)
    # Only the keys are mapped over; a value is cut out of its match just for the columns that are
    # selected (no per-element lambda for values).
    step = step.select(*keep, F.reverse(keys).alias(_P + "k"), F.reverse(m).alias(_P + "v"))
    raw = []
    for i, f in enumerate(ext_fields):
        suffixed = f.name.endswith(S.CONFLICT_SUFFIX) and S.is_header(f.name[: -len(S.CONFLICT_SUFFIX)])
        match = TK.lookup(F.col(_P + "k"), F.col(_P + "v"), f.name)
        raw.append(TK.match_text(match, None if suffixed else len(f.name)).alias(f"{_P}r{i}"))
    others = []
    if rest:
        names = F.col(_P + "k") if _needs_label_map(ext_fields) else F.transform(_P + "k", PV.label_column_name)
        step = step.withColumn(_P + "n", names)
        raw.append(PV.other_pairs(F.col(_P + "n"), F.col(_P + "v"), ext_fields, opts).alias(_P + "rest"))
        others.append(F.col(_P + "rest"))
    step = step.select(*keep, *raw)
    cleaned = []
    for i in range(len(ext_fields)):
        r = TK.clean_value(F.col(f"{_P}r{i}"), opts.null_value)
        cleaned.append((TK.unescape_extension(r) if opts.unescape else r).alias(f"{_P}r{i}"))
    step = step.select(*keep, *cleaned, *others)
    return step.select(*keep, *[V.convert(F.col(f"{_P}r{i}"), f.dataType).alias(f"{_P}t{i}")
                                for i, f in enumerate(ext_fields)], *others)


#: Why a line is malformed: the values of ``_cef_error``, and the names under which lines are counted.
REASONS = (*TK.MISSING_MESSAGES, TK.PIPE_COUNT_MESSAGE, PV.TYPE_CLASH_MESSAGE)


def _observed(df: DataFrame, error: Column, counts: Observation | str | None) -> DataFrame:
    """Metrics of all lines that pass here, whatever the mode does with them afterwards."""
    if counts is None:
        return df
    return df.observe(counts, F.count(F.lit(1)).alias("lines"), F.count(error).alias("malformed"),
                      *[F.count_if(error == r).alias(r) for r in REASONS])


def _apply_mode(df: DataFrame, whole: Column, reason: Column, mode: str) -> DataFrame:
    """A Filter for the mode; it may be pushed down, so it refers to cheap columns as rarely as it can."""
    if mode == "dropmalformed":
        return df.filter(whole)
    if mode == "failfast":
        # A Filter (not a Project) so that count() and column pruning keep it.
        return df.filter(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(FAILFAST_PREFIX), reason))))
    return df


def with_parse_error(df: DataFrame, column: str = "value",
                     options: CefOptions | Mapping[str, Any] | None = None,
                     **kwargs: Any) -> DataFrame:
    """Add ``_cef_error`` (reason a line is malformed, null if well formed)."""
    opts = resolve(options, **kwargs)
    line = TK.repair_line(F.col(column), opts.null_value, trailing=opts.repair_trailing,
                          defensive=opts.defensive_mode, escaped=opts.unescape)
    staged = df.withColumn("_cef_pieces", TK.split_header(line, escaped=opts.unescape))
    return staged.withColumn("_cef_error", TK.header_error(F.col("_cef_pieces"))).drop("_cef_pieces")


def split_malformed(df: DataFrame, schema: T.StructType, column: str = "value",
                    options: CefOptions | Mapping[str, Any] | None = None,
                    **kwargs: Any) -> tuple[DataFrame, DataFrame]:
    """M6 quarantine: (good parsed rows, bad raw rows with ``_cef_error``), both lazy.

    Each output parses the input when it is used.  To get both out of a single pass, write them with
    :func:`cefframe.write_split`.
    """
    opts = resolve(options, **kwargs)
    good = parse_cef(df, schema, column, resolve(opts, mode="dropmalformed"))
    if not opts.pivot_fields:
        return good, with_parse_error(df, column, opts).filter(F.col("_cef_error").isNotNull())
    flagged = flag_malformed(df, schema, column, opts)
    bad = flagged.filter(F.col(ERROR_COL).isNotNull()).select(F.col(RAW_COL).alias(column), ERROR_COL)
    return good, bad


RAW_COL, ERROR_COL = "_cef_raw", "_cef_error"


def flag_malformed(df: DataFrame, schema: T.StructType, column: str = "value",
                   options: CefOptions | Mapping[str, Any] | None = None, *, counts: Observation | str | None = None,
                   rest: str | None = None, **kwargs: Any) -> DataFrame:
    """All lines, parsed once: the columns of ``schema``, ``_cef_raw`` (the line) and ``_cef_error``
    (why it is malformed, null if it is not), then the other input columns."""
    opts = resolve(resolve(options, **kwargs), mode="permissive")
    return _parse(df, schema, column, opts, counts, rest, RAW_COL, ERROR_COL)

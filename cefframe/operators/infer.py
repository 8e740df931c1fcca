"""Schema inference: the seven headers, then every extension key (or pivot
label) in first-seen order, typed by the key dictionary.

Pairs are exploded on the executors and aggregated twice.  First each name, key and place in the line
keeps its smallest order: a number, which Spark aggregates in a hash table, so a task's memory follows
the names and not its lines (a minimum of structs or texts would sort all pairs of a task).  Then each
name keeps its smallest position, ``min(struct(order, place, key))``.  Only the distinct names come
back to the driver, one row per column of the schema that is being built; more than ``MOST_NAMES``
of them are refused, since no table can have that many columns.  By default every line counts;
``maxRecords`` limits inference to the first lines.
"""

from __future__ import annotations

import logging
import time
from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import tokens as TK
from ..options import CefOptions, resolve
from . import pivot as PV

log = logging.getLogger(__name__)

CORRUPT_CONFLICT_MESSAGE = ("The specified corrupt column name conflicts with a field name "
                            "in the data set.")
ORDER_COL = "__cef_ord"
MOST_NAMES = 100_000


def _names(lines: DataFrame, column: str, order: Column, opts: CefOptions) -> DataFrame:
    """One row per pair that gives a column: ``o`` (order), ``name``, ``src`` (key), ``p`` (place).

    Built in stages over column references so the regex runs once per line.
    """
    line = TK.repair_line(F.col(column), opts.null_value, trailing=opts.repair_trailing,
                          defensive=opts.defensive_mode, escaped=opts.unescape)
    m = lines.select(order.alias("o"), TK.extension_matches(
        TK.extension_text(TK.split_header(line, escaped=opts.unescape), collapse=not opts.unescape)).alias("m"))
    if opts.pivot_fields:
        arrays = PV.label_arrays(m, F.col("m"), [F.col("o")], opts.null_value, "_", positions=True)
        return PV.entries(arrays, [F.col("o")], "_")
    # Without pivoting a line only contributes its keys (no value needed).
    keys = m.select("o", F.posexplode(TK.match_keys(F.col("m"))).alias("p", "src"))
    return keys.select("o", PV.label_column_name(F.col("src")).alias("name"), "src", "p")


def first_places(names: DataFrame, block: Iterable[Column], order: Column) -> DataFrame:
    """Pairs of :func:`_names` by name, key (``src``), place (``p``) and the columns ``block``: the smallest
    ``order`` as ``i``, and their number ``n``.  A null order is the smallest."""
    return names.groupBy("name", "src", "p", *block, order.isNull()).agg(
        F.min(order).alias("i"), F.count(F.lit(1)).alias("n"))


def first_seen_names(lines: DataFrame, opts: CefOptions, column: str = "value",
                     order: Column | None = None, block: Iterable[str] = (), few: bool = False) -> list[tuple[Any, str, str]]:
    """Distinct names with (first position, name, source key), aggregated on executors.

    ``order`` is a sortable per-line column (earlier lines sort first); pairs are only aggregated
    without sorting them if it is a number, a date or a timestamp.  ``block``: columns that sort
    before it and that many lines share (a file, its split).  ``few``: the caller bounds the number of
    lines, so their pairs may be sorted, which saves a shuffle.  Without an order names are in
    alphabetical order, and of several source keys of one name the first in order counts.
    """
    ahead = list(block)
    position = F.struct(*ahead, (order if order is not None else F.lit(0)).alias("i"))
    names = _names(lines, column, position, opts)
    if order is None:
        names = names.withColumn("p", F.lit(0))
    places = (names.select("name", "src", "p", "o.*") if few
              else first_places(names, [F.col("o")[c].alias(c) for c in ahead], F.col("o.i")))
    agg = places.groupBy("name").agg(F.min(F.struct(F.struct(*ahead, "i").alias("o"), "p", "src")).alias("first"))
    rows = agg.limit(MOST_NAMES + 1).collect()  # one row per distinct name
    if len(rows) > MOST_NAMES:
        raise ValueError(f"More than {MOST_NAMES} distinct extension keys: the keys look like free text. "
                         "Supply a schema, or set maxRecords.")
    if order is None:
        return [(r["name"], r["name"], r["first"]["src"]) for r in rows if r["name"] is not None]
    return [((r["first"]["o"], r["first"]["p"]), r["name"], r["first"]["src"]) for r in rows]


def build_schema(found: Iterable[tuple[Any, str, str]], opts: CefOptions,
                 case_sensitive: bool = False, inputs: Iterable[str] = ()) -> T.StructType:
    """The schema of the names found; ``inputs`` (partition columns) have their names to themselves."""
    rule = (lambda n: n) if case_sensitive else str.lower
    taken = {rule(c) for c in inputs}
    fields = S.header_schema()
    seen = {f.name for f in fields}
    for _, name, src in sorted(found, key=lambda t: t[0]):
        if name is None or name in seen or rule(name) in taken:
            continue
        seen.add(name)
        fields.append(T.StructField(name, S.key_type(src), True))
    if not case_sensitive:
        by_lower: dict[str, str] = {}
        for f in fields:
            other = by_lower.setdefault(f.name.lower(), f.name)
            if other != f.name:
                raise ValueError(
                    f"CEF keys '{other}' and '{f.name}' differ only in case; Spark column names "
                    "are case-insensitive. Set spark.sql.caseSensitive=true or supply a schema.")
    if opts.mode == "permissive" and opts.corrupt_record_column_name:
        cc = opts.corrupt_record_column_name
        if any(f.name.lower() == cc.lower() for f in fields):
            raise ValueError(CORRUPT_CONFLICT_MESSAGE)
        fields.append(T.StructField(cc, T.StringType(), True))
    return T.StructType(fields)


def infer_cef_schema(df: DataFrame, column: str = "value",
                     options: CefOptions | Mapping[str, Any] | None = None,
                     order: Column | None = None, **kwargs: Any) -> T.StructType:
    """Infer a CEF schema from a string column.

    All rows count, unless ``maxRecords`` is given: then the ``maxRecords`` rows with the smallest
    ``order`` do, and ``order`` is required.  ``order`` also decides the order of the columns;
    without it they are in alphabetical order.
    """
    opts = resolve(options, **kwargs)
    started = time.monotonic()
    n = opts.effective_max_records
    if n is not None and order is None:
        raise ValueError("maxRecords needs an order: without one, the first rows are not defined.")
    lines = df.select(_quoted(column).alias(column), *([order.alias(ORDER_COL)] if order is not None else []))
    if n is not None:
        lines = lines.orderBy(ORDER_COL).limit(n)
    found = first_seen_names(lines, opts, column, F.col(ORDER_COL) if order is not None else None)
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    result = build_schema(found, opts, case_sensitive)
    log_inferred(result, n, started)
    return result


def log_inferred(schema: T.StructType, n: int | None, started: float) -> None:
    log.info("Inferred CEF schema of %d columns from %s in %.1f s", len(schema.fields),
             "all lines" if n is None else f"up to {n} lines", time.monotonic() - started)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")

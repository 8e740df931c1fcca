"""F1-F4 for SQL text: temporary SQL functions whose bodies are the same built-in expressions.

``register_cef_functions(spark)`` runs ``CREATE OR REPLACE TEMPORARY FUNCTION ... RETURN <expression>``.
Spark inlines a body into the query that calls it, so the work stays in the JVM and in the optimizer's
view, as with the column functions.  Each argument is computed once per call.

    cef_timestamp(text)               TIMESTAMP or null
    cef_header(line)                  STRUCT of the seven header fields
    cef_extensions(line)              MAP<STRING, STRING>, the last of equal keys wins, '-' is null
    cef_escape_header(text)           STRING
    cef_escape_extension(text)        STRING
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schema import HEADER_FIELDS
from . import tokens as TK
from . import values as V


def _text(value: str) -> str:
    """A SQL literal that is taken as it stands."""
    quote = "'" if "'" not in value else '"'
    return f"r{quote}{value}{quote}"


def _chars(value: str) -> str:
    """A SQL expression for text with control characters."""
    return "concat(" + ", ".join(f"char({ord(c)})" for c in value) + ")"


_PIECES = (f"CASE WHEN contains(line, {_text(chr(92) + '|')}) THEN split(line, {_text(TK.HEADER_SPLIT)}, 8) "
           f"ELSE split(line, {_text(chr(92) + '|')}, 8) END")
_TRIMMED = f"btrim(substr({{m}}, instr({{m}}, '=') + 1), {_chars(''.join(chr(c) for c in range(0x21)))})"

_HEADER = "named_struct(" + ", ".join(f"'{h}', get(p, {i})" for i, h in enumerate(HEADER_FIELDS)) + ")"


def _let(name: str, value: str, body: str) -> str:
    """``value`` is computed once as ``name`` in ``body``, and only where the body is needed.

    Arguments of a helper function are columns below the call: they are computed for every row, whatever
    branch of a CASE the call is in, and a filter gets another copy for each reference to one."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


_MATCHES = (f"regexp_extract_all(replace(get({_PIECES.replace('line', 'l')}, 7), r'\\\\', r'\\'), "
            f"{_text(TK.PAIR_PATTERN)}, 0)")
_KEYS_VALUES = ("named_struct('k', transform(m, x -> substring_index(x, '=', 1)), "
                f"'v', transform(m, x -> nullif({_TRIMMED.format(m='x')}, '-')))")
_EXTENSIONS = """CASE WHEN size(array_distinct(e.k)) = size(e.k) THEN map_from_arrays(e.k, e.v)
  ELSE map_from_entries(filter(zip_with(e.k, e.v, (k, v) -> named_struct('k', k, 'v', v)),
    (x, i) -> array_position(reverse(e.k), x.k) = size(e.k) - i)) END"""

_ISO_LAYOUT = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSSSSS]"
_ISO = _let(
    "p", f"split(regexp_replace(t, {_text(V.ISO_TS_PATTERN)}, concat('$1', char(1), '$2', char(1), '$3')), char(1), 3)",
    _let("d", "concat(substr(get(p, 0), 1, 10), 'T', substr(get(p, 0), 12))", f"""
  CASE WHEN get(p, 1) <> '' THEN try_to_timestamp(concat(d, upper(get(p, 1))), {_text(_ISO_LAYOUT + 'XXXXX')})
  WHEN get(p, 2) <> '' THEN try_to_timestamp(concat(d, ' ', get(p, 2)), {_text(_ISO_LAYOUT + ' VV')})
  ELSE try_to_timestamp(concat(d, 'Z'), {_text(_ISO_LAYOUT + 'XXXXX')}) END"""))

_MONTHS = "array(" + ", ".join(f"'{m}'" for m in V.MONTHS) + ")"
_MONTH_END = """CASE WHEN month = 2 THEN CASE WHEN (year % 4 = 0 AND year % 100 <> 0) OR year % 400 = 0 THEN 29 ELSE 28 END
  WHEN month IN (4, 6, 9, 11) THEN 30 ELSE 31 END"""
_LAYOUT = f"""CASE WHEN zone IN ('', 'UTC', 'GMT', 'UT', 'Z') OR zone RLIKE {_text(r'^[+-]\d{2}:\d{2}$')}
  THEN try_cast(concat(year, '-', lpad(CAST(month AS STRING), 2, '0'), '-', day, 'T', hms, '.', millis,
    CASE WHEN zone IN ('', 'UTC', 'GMT', 'UT', 'Z') THEN 'Z' ELSE zone END) AS TIMESTAMP)
  ELSE try_to_timestamp(concat_ws(' ', year, mon, day, concat(hms, '.', millis), zone), 'yyyy MMM dd HH:mm:ss.SSS zzz') END"""


#: name, parameters, type, body; a function may call those above it.
FUNCTIONS = (
    ("cef_escape_header", "t STRING", "STRING",
     r"replace(replace(replace(replace(replace(replace(t, r'\|', '|'), r'\', r'\\'), '|', r'\|'),"
     " concat(char(13), char(10)), ' '), char(13), ' '), char(10), ' ')"),
    ("cef_escape_extension", "t STRING", "STRING",
     r"replace(replace(replace(replace(replace(replace(t, r'\=', '='), r'\', r'\\'), '=', r'\='),"
     r" concat(char(13), char(10)), r'\n'), char(13), r'\n'), char(10), r'\n')"),
    ("cef_pieces", "line STRING", "ARRAY<STRING>", _PIECES),
    ("cef_header_of", "p ARRAY<STRING>", "STRUCT<" + ", ".join(f"{h}: STRING" for h in HEADER_FIELDS) + ">", _HEADER),
    ("cef_header", "line STRING", "STRUCT<" + ", ".join(f"{h}: STRING" for h in HEADER_FIELDS) + ">",
     "cef_header_of(cef_pieces(line))"),
    ("cef_extensions", "line STRING", "MAP<STRING, STRING>",
     _let("l", "line", _let("m", _MATCHES, _let("e", _KEYS_VALUES, _EXTENSIONS)))),
    ("cef_layout_time", "year STRING, mon STRING, month INT, day STRING, hms STRING, millis STRING, zone STRING", "TIMESTAMP",
     _LAYOUT),
    ("cef_month_end", "year INT, month INT", "INT", _MONTH_END),
    ("cef_layout_day", "year STRING, month INT, day STRING", "STRING",
     "CASE WHEN day BETWEEN '29' AND '31' THEN lpad(CAST(least(try_cast(day AS INT),"
     " cef_month_end(try_cast(year AS INT), month)) AS STRING), 2, '0') ELSE day END"),
    ("cef_layout_parts", "t STRING, year STRING, month INT, off INT, ms INT", "TIMESTAMP",
     "cef_layout_time(year, substr(t, 1, 3), month, cef_layout_day(year, month, substr(t, 5, 2)), substr(t, off + 8, 8),"
     " CASE WHEN ms > 0 THEN substr(t, off + 17, 3) ELSE '000' END,"
     " CASE WHEN substr(t, off + 16 + ms, 1) = ' ' THEN substr(t, off + 17 + ms) ELSE '' END)"),
    ("cef_layout_offset", "t STRING, off INT", "TIMESTAMP",
     f"cef_layout_parts(t, CASE WHEN off > 0 THEN substr(t, 8, 4) ELSE '{V.DEFAULT_YEAR}' END,"
     f" CAST(array_position({_MONTHS}, substr(t, 1, 3)) AS INT), off, CASE WHEN substr(t, off + 16, 1) = '.' THEN 4 ELSE 0 END)"),
    ("cef_layout", "t STRING", "TIMESTAMP", "cef_layout_offset(t, CASE WHEN substr(t, 10, 1) <> ':' THEN 5 ELSE 0 END)"),
    ("cef_millis", "ms BIGINT", "TIMESTAMP",
     f"CASE WHEN ms BETWEEN {-V._MAX_EPOCH_MILLIS} AND {V._MAX_EPOCH_MILLIS} THEN timestamp_millis(ms) END"),
    ("cef_timestamp", "t STRING", "TIMESTAMP",
     f"CASE WHEN t RLIKE {_text(r'^[+-]?0*\d{1,19}$')} THEN cef_millis(try_cast(t AS BIGINT))"
     f" WHEN t RLIKE {_text(V.ISO_TS_PATTERN)} THEN {_ISO} WHEN t RLIKE {_text(V.CEF_TS_PATTERN)} THEN cef_layout(t) END"),
)


def register_cef_functions(spark: SparkSession) -> None:
    """Create (or replace) the session's temporary functions; the ``cef_`` names not listed above are helpers."""
    for name, parameters, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")

"""Line-level column expressions: repair, header split, extension pairs.

All builders take and return ``Column``; they compile to Catalyst built-ins
(split, regexp_extract_all, transform, ...) so they run inside whole-stage
codegen on the executors and work the same on batch and streaming input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import HEADER_FIELDS

# --- fixed values (patterns of the CEF format) ---
HEADER_SPLIT = r"(?<!\\)\|"                               # pipe not preceded by a backslash
PAIR_PATTERN = r"(?m)([\w._-]+)=(.+?)(?=$|\s[\w._-]+=)"   # key=value up to the next " key="
DEFENSIVE_PATTERN = r"([\w\d])=($|\s)"                    # key= with an empty value
MISSING_MESSAGES = (
    "Missing device vendor in record",
    "Missing device product in record",
    "Missing device version in record",
    "Missing signature id in record",
    "Missing name in record",
    "Missing severity in record",
)
PIPE_COUNT_MESSAGE = "Record does not contain the correct number of pipe separated values"
# --- end of fixed values ---

# Java String.trim removes every char <= U+0020 from both ends.
_JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))
# Written by this library: a pipe after an even number of backslashes.
EXACT_SPLIT = r"(?<=(?<!\\)(?:\\\\){0,64})\|"


def _java_replacement_literal(text: str) -> str:
    """Quote ``$`` and ``\\`` for a Java regex replacement string."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def repair_line(value: Column, null_value: str, *, trailing: bool = True,
                defensive: bool = False, escaped: bool = False) -> Column:
    """Trailing ``=`` gets the null token; defensive mode fills every empty ``key=``.

    ``escaped``: the line comes from our writer, so an escaped ``=`` at its end belongs to a value.
    """
    line = value
    if trailing:
        empty = value.endswith("=")
        if escaped:
            empty = empty & value.rlike(r"(?<!\\)(?:\\\\)*=$")
        line = F.when(empty, F.concat(value, F.lit(null_value))).otherwise(value)
    if defensive:
        filled = F.regexp_replace(
            line, DEFENSIVE_PATTERN, "$1=" + _java_replacement_literal(null_value) + "$2")
        line = F.when(value.contains("= "), filled).otherwise(line)
    return line


def split_header(line: Column, escaped: bool = False) -> Column:
    """At most eight pieces: seven header fields and the extension text.

    Lines without an escaped pipe take Java's literal one-character split
    (no regex engine); the look-behind pattern is used only when needed.
    """
    pattern = EXACT_SPLIT if escaped else HEADER_SPLIT
    return F.when(line.contains("\\|"), F.split(line, pattern, 8)).otherwise(
        F.split(line, r"\|", 8))


def header_error(pieces: Column) -> Column:
    """Reason a line is malformed (null when it has all eight pieces)."""
    n = F.size(pieces)
    expr = F.when(n == 8, F.lit(None).cast("string"))
    for i, msg in enumerate(MISSING_MESSAGES, start=1):
        expr = expr.when(n == i, F.lit(msg))
    return expr.otherwise(F.lit(PIPE_COUNT_MESSAGE))


def whole_header(pieces: Column) -> Column:
    """Whether :func:`header_error` is null, as a test of its own (one reference to the pieces)."""
    return F.coalesce(F.size(pieces), F.lit(0)) == 8


def header_error_text(pieces: Column) -> Column:
    """The reason for a line that is known to be malformed (one reference to the pieces)."""
    messages = F.array(*[F.lit(m) for m in MISSING_MESSAGES])
    return F.coalesce(F.get(messages, F.size(pieces) - 1), F.lit(PIPE_COUNT_MESSAGE))


def header_field(pieces: Column, index: int) -> Column:
    return F.get(pieces, index)


def extension_text(pieces: Column, collapse: bool = True) -> Column:
    """Piece 7 with ``\\\\`` collapsed to ``\\`` (``\\=`` and ``\\n`` stay)."""
    if not collapse:
        return F.get(pieces, 7)
    return F.replace(F.get(pieces, 7), F.lit("\\\\"), F.lit("\\"))


def extension_matches(ext: Column) -> Column:
    """``key=value`` matches in text order, found in a single regex pass."""
    return F.regexp_extract_all(ext, F.lit(PAIR_PATTERN), F.lit(0))


def match_keys(matches: Column) -> Column:
    # Keys cannot hold '=', so the first '=' ends the key.
    return F.transform(matches, lambda m: F.substring_index(m, "=", 1))


def match_values(matches: Column, null_value: str | None = None) -> Column:
    """Trimmed values; equal to ``null_value`` -> null (one pass over the array)."""
    def value(m: Column) -> Column:
        v = java_trim(F.substr(m, F.instr(m, "=") + 1))
        return v if null_value is None else null_token(v, null_value)
    return F.transform(matches, value)


def java_trim(v: Column) -> Column:
    """Strip chars <= U+0020 at both ends (Java ``String.trim``)."""
    return F.btrim(v, F.lit(_JAVA_TRIM_CHARS))


def match_text(match: Column, key_length: int | None = None) -> Column:
    """Untrimmed value part of one ``key=value`` match.

    ``key_length`` (when the key is known) replaces the search for '='.
    """
    start = F.lit(key_length + 2) if key_length is not None else F.instr(match, "=") + 1
    return F.substr(match, start)


def clean_value(text: Column, null_value: str | None = None) -> Column:
    """Java-trim, then the null token -> null.  ``text`` should be a column reference."""
    v = java_trim(text)
    return v if null_value is None else F.nullif(v, F.lit(null_value))


def null_token(value: Column, null_value: str) -> Column:
    return F.when(value == F.lit(null_value), F.lit(None).cast("string")).otherwise(value)


def lookup(rev_keys: Column, rev_values: Column, key: str | Column) -> Column:
    """Value of the last occurrence of ``key`` (arrays are stored reversed)."""
    k = key if isinstance(key, Column) else F.lit(key)
    pos = F.array_position(rev_keys, k).cast("int")
    return F.get(rev_values, pos - 1)


def _decoded(value: Column, codes: dict[str, str]) -> Column:
    """One pass from the left: between doubled backslashes, each single one starts a code."""
    def part(p: Column) -> Column:
        for code, plain in codes.items():
            p = F.replace(p, F.lit(code), F.lit(plain))
        return p
    decoded = F.array_join(F.transform(F.split(value, r"\\\\"), part), "\\")
    return F.when(value.contains("\\"), decoded).otherwise(value)


def unescape_extension(value: Column) -> Column:
    """Opt-in inverse of the writer's extension escaping, on text that was not collapsed."""
    return _decoded(value, {"\\=": "=", "\\n": "\n"})


def unescape_header(value: Column) -> Column:
    return _decoded(value, {"\\|": "|"})


def header_struct(line: Column) -> Column:
    """the seven header fields of a line as a struct."""
    pieces = split_header(line)
    return F.struct(*[header_field(pieces, i).alias(h) for i, h in enumerate(HEADER_FIELDS)])


def extensions_map(line: Column, null_value: str = "-") -> Column:
    """extension pairs as ``map<string,string>``; the last duplicate wins.

    The matches and the key / value arrays are bound once (``let``) so the
    regex does not re-run inside the de-duplication lambda; lines without a
    repeated key skip de-duplication.
    """
    from .values import let

    matches = extension_matches(extension_text(split_header(line)))

    def build(kv: Column) -> Column:
        keys, vals = kv["k"], kv["v"]
        entries = F.arrays_zip(keys.alias("k"), vals.alias("v"))
        last = F.filter(entries, lambda e, i: F.array_position(
            F.reverse(keys), e["k"]).cast("int") == F.size(keys) - i)
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, vals)) \
            .otherwise(F.map_from_entries(last))

    return let(matches, lambda m: let(
        F.struct(match_keys(m).alias("k"), match_values(m, null_value).alias("v")), build))

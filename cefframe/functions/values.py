"""Lenient typed conversion of extension values (int, long, float, double,
timestamp).  Bad values become null; they never make a record malformed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (timestamp layouts accepted on read) ---
# CEF layouts: MMM dd[ yyyy] HH:mm:ss[.SSS][ zzz]
CEF_TS_PATTERN = r"^([A-Z][a-z]{2} \d{2})( \d{4})? (\d{2}:\d{2}:\d{2})(\.\d{3})?( \S.*)?$"
# ISO-8601 date-time with optional offset and optional [zone]
ISO_TS_PATTERN = (r"^(\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)"
                  r"([Zz]|[+-]\d{2}:\d{2}(?::\d{2})?)?(?:\[([^\]]+)\])?$")
DEFAULT_YEAR = "1970"
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# Special float spellings Spark's cast accepts but Java's parser does not.
_SPARK_ONLY_SPECIALS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan")
_JAVA_SPECIALS = ("NaN", "Infinity", "+Infinity", "-Infinity")
# --- end of fixed values ---

_MAX_EPOCH_MILLIS = 9223372036854775  # Long.MAX_VALUE // 1000: micros must fit a long
_SEP = "\u0001"


def to_int(v: Column) -> Column:
    return v.try_cast("int")


def to_long(v: Column) -> Column:
    return v.try_cast("bigint")


def _reject_spark_only_specials(v: Column, cast: Column) -> Column:
    bad = F.lower(v).isin(list(_SPARK_ONLY_SPECIALS)) & ~v.isin(list(_JAVA_SPECIALS))
    return F.when(bad, F.lit(None)).otherwise(cast)


def to_float(v: Column) -> Column:
    return _reject_spark_only_specials(v, v.try_cast("float"))


def to_double(v: Column) -> Column:
    return _reject_spark_only_specials(v, v.try_cast("double"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform)."""
    return F.get(F.transform(F.array(value), body), 0)


def _iso_timestamp(v: Column) -> Column:
    def build(p: Column) -> Column:
        local = F.get(p, 0)
        local = F.concat(F.substr(local, F.lit(1), F.lit(10)), F.lit("T"), F.substr(local, F.lit(12)))
        offset = F.upper(F.get(p, 1))
        zone = F.get(p, 2)
        fmt = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSSSSS]"
        with_offset = F.try_to_timestamp(F.concat(local, offset), F.lit(fmt + "XXXXX"))
        with_zone = F.try_to_timestamp(F.concat(local, F.lit(" "), zone), F.lit(fmt + " VV"))
        as_utc = F.try_to_timestamp(F.concat(local, F.lit("Z")), F.lit(fmt + "XXXXX"))
        return (F.when(offset != "", with_offset)
                .when(zone != "", with_zone)
                .otherwise(as_utc))
    parts = F.split(F.regexp_replace(v, ISO_TS_PATTERN, _SEP.join(["$1", "$2", "$3"])), _SEP, 3)
    return let(parts, build)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _cef_layout_timestamp(v: Column) -> Column:
    """``MMM dd[ yyyy] HH:mm:ss[.SSS][ zone]`` (shape already checked by regex).

    Fields sit at fixed offsets, so no further regex is needed.  The common
    case (no zone, UTC/GMT/Z, or a numeric offset) is rewritten as ISO text
    and read by Spark's native string->timestamp cast; other zone names go
    through the ``zzz`` formatter.  Days 29-31 past the end of the month are
    moved back to its last day (``Feb 30`` -> ``Feb 29``), as java.time's
    SMART resolver does.  The expression is kept flat so the generated code
    stays small enough for the JIT.
    """
    has_year = F.substr(v, F.lit(10), F.lit(1)) != ":"
    off = F.when(has_year, F.lit(5)).otherwise(F.lit(0))
    has_ms = F.substr(v, off + 16, F.lit(1)) == "."
    zone_at = off + 16 + F.when(has_ms, F.lit(4)).otherwise(F.lit(0))
    year_t = F.when(has_year, F.substr(v, F.lit(8), F.lit(4))).otherwise(F.lit(DEFAULT_YEAR))
    mon = F.substr(v, F.lit(1), F.lit(3))
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), mon)
    day_t = F.substr(v, F.lit(5), F.lit(2))
    year = _int(year_t)
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    month_end = (F.when(month == 2, F.when(leap, F.lit(29)).otherwise(F.lit(28)))
                 .when(month.isin(4, 6, 9, 11), F.lit(30)).otherwise(F.lit(31)))
    day = F.when(day_t.between("29", "31"),
                 F.lpad(F.least(_int(day_t), month_end).cast("string"), 2, "0")).otherwise(day_t)
    hms = F.substr(v, off + 8, F.lit(8))
    millis = F.when(has_ms, F.substr(v, off + 17, F.lit(3))).otherwise(F.lit("000"))
    zone = F.when(F.substr(v, zone_at, F.lit(1)) == " ", F.substr(v, zone_at + 1)).otherwise(F.lit(""))
    suffix = (F.when(zone.isin("", "UTC", "GMT", "UT", "Z"), F.lit("Z"))
              .when(zone.rlike(r"^[+-]\d{2}:\d{2}$"), zone))
    fast = F.concat(year_t, F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), day,
                    F.lit("T"), hms, F.lit("."), millis, suffix).try_cast("timestamp")
    text = F.concat_ws(" ", year_t, mon, day, F.concat(hms, F.lit("."), millis), zone)
    slow = F.try_to_timestamp(text, F.lit("yyyy MMM dd HH:mm:ss.SSS zzz"))
    return F.when(suffix.isNotNull(), fast).otherwise(slow)


def to_timestamp(v: Column) -> Column:
    """F1 ``cef_timestamp``: epoch millis, ISO-8601, or one of the 8 CEF layouts."""
    # Any number of leading zeros, then as many digits as a long may have.
    digits = v.rlike(r"^[+-]?0*\d{1,19}$")
    millis = v.try_cast("bigint")
    in_range = millis.between(-_MAX_EPOCH_MILLIS, _MAX_EPOCH_MILLIS)
    return (F.when(digits, F.when(in_range, F.timestamp_millis(millis)))
            .when(v.rlike(ISO_TS_PATTERN), _iso_timestamp(v))
            .when(v.rlike(CEF_TS_PATTERN), _cef_layout_timestamp(v))
            .otherwise(F.lit(None).cast("timestamp")))


def convert(v: Column, dt: T.DataType) -> Column:
    """Lenient conversion of a trimmed, null-mapped string to ``dt``."""
    if isinstance(dt, T.StringType):
        return v
    if isinstance(dt, T.IntegerType):
        return to_int(v)
    if isinstance(dt, T.LongType):
        return to_long(v)
    if isinstance(dt, T.FloatType):
        return to_float(v)
    if isinstance(dt, T.DoubleType):
        return to_double(v)
    if isinstance(dt, T.TimestampType):
        return to_timestamp(v)
    if isinstance(dt, T.TimestampNTZType):
        return to_timestamp(v).cast("timestamp_ntz")
    # Other user-declared types: Spark's own lenient cast.
    return v.try_cast(dt)

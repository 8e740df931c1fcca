"""CEF data model: the seven header columns, the typed extension dictionary
and the column-naming rules shared by parsing, inference and encoding.

Everything here is used at plan-build time on the driver; nothing in this
module touches data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the CEF V25 layout used by the reference) ---
# Header columns, in this order, always strings.
HEADER_FIELDS = (
    "CEFVersion",
    "DeviceVendor",
    "DeviceProduct",
    "DeviceVersion",
    "SignatureID",
    "Name",
    "Severity",
)

# Extension keys with a non-string type.  Keys are case-sensitive.
FLOAT_KEYS = ("cfp1", "cfp2", "cfp3", "cfp4")
LONG_KEYS = ("cn1", "cn2", "cn3", "cnt", "eventId")
INTEGER_KEYS = (
    "destinationTranslatedPort", "deviceDirection", "dpid", "dpt", "dvcpid", "in",
    "oldFileSize", "out", "sourceTranslatedPort", "spid", "spt", "type",
)
DOUBLE_KEYS = ("dlat", "dlong", "slat", "slong")
TIMESTAMP_KEYS = (
    "deviceCustomDate1", "deviceCustomDate2", "end", "fileCreateTime",
    "fileModificationTime", "flexDate1", "fsize", "oldFileCreateTime",
    "oldFileModificationTime", "rt", "start", "art",
)
# --- end of fixed values ---

STRING = T.StringType()
KEY_TYPES: dict[str, T.DataType] = {}
for _keys, _type in (
    (FLOAT_KEYS, T.FloatType()),
    (LONG_KEYS, T.LongType()),
    (INTEGER_KEYS, T.IntegerType()),
    (DOUBLE_KEYS, T.DoubleType()),
    (TIMESTAMP_KEYS, T.TimestampType()),
):
    for _k in _keys:
        KEY_TYPES[_k] = _type

# Types the format can carry; anything else is written as the null token.
SUPPORTED_TYPES = (
    T.StringType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.TimestampType,
)

_HEADER_LOWER = frozenset(h.lower() for h in HEADER_FIELDS)
CONFLICT_SUFFIX = "_1"


def key_type(key: str) -> T.DataType:
    """Dictionary type of an extension key; unknown keys are strings."""
    return KEY_TYPES.get(key, STRING)


def column_name(key: str) -> str:
    """Column a key (or pivot label) lands in: header clashes get ``_1``."""
    return key + CONFLICT_SUFFIX if key.lower() in _HEADER_LOWER else key


def is_header(name: str) -> bool:
    return name.lower() in _HEADER_LOWER


def header_schema() -> list[T.StructField]:
    return [T.StructField(h, STRING, True) for h in HEADER_FIELDS]


def keys_of_type(dt: T.DataType) -> list[str]:
    """Dictionary keys whose type equals ``dt`` (empty for strings)."""
    return [k for k, t in KEY_TYPES.items() if t == dt]


def typed_keys() -> list[str]:
    return list(KEY_TYPES)

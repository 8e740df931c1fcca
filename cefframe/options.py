"""Reader / writer options (maxRecords, pivotFields, mode, ...).

Option names are matched ignoring case and underscores, so ``maxRecords``,
``maxrecords`` and ``max_records`` are the same option.  A name that is not
known but looks like a known one is reported with a hint.
"""

from __future__ import annotations

import difflib
from dataclasses import dataclass
from typing import Any, Mapping

# --- fixed values (option defaults and accepted date formats) ---
DEFAULT_NULL_VALUE = "-"
DEFAULT_DATE_FORMAT = "MMM dd yyyy HH:mm:ss.SSS zzz"
VALID_DATE_FORMATS = (
    "millis",
    "MMM dd yyyy HH:mm:ss",
    "MMM dd yyyy HH:mm:ss.SSS zzz",
    "MMM dd yyyy HH:mm:ss.SSS",
    "MMM dd yyyy HH:mm:ss zzz",
    "MMM dd HH:mm:ss",
    "MMM dd HH:mm:ss.SSS zzz",
    "MMM dd HH:mm:ss.SSS",
    "MMM dd HH:mm:ss zzz",
)
MODES = ("permissive", "dropmalformed", "failfast")
# --- end of fixed values ---

# Options checked for misspellings, by canonical name.
_CHECKED = ("maxRecords", "pivotFields", "corruptRecordColumnName", "defensiveMode",
            "nullValue", "dateFormat")
# All options we understand (canonical spelling).
_KNOWN = _CHECKED + ("mode", "epochUnit", "repairTrailing", "unescape")


class CefOptionsError(ValueError):
    """Raised for invalid or misspelt options."""


def _norm(name: str) -> str:
    return name.replace("_", "").lower()


_BY_NORM = {_norm(k): k for k in _KNOWN}


# Options of Spark's own sources and sinks whose names come close to one of ours.
_SPARKS_OWN = ("maxcolumns", "maxfilespertrigger", "maxbytespertrigger", "maxfileage", "maxcharspercolumn",
               "maxrecordsperfile", "maxcachedfiles", "fileformat", "timestampformat", "timestampntzformat", "nanvalue",
               "emptyvalue", "columnnameofcorruptrecord", "datetimerebasemode", "ignorenullfields")

# Letters that sound alike get one letter; vowels count only at the start.
_ALIKE = (("ph", "f"), ("ck", "k"), ("ch", "k"), ("cs", "ks"), ("x", "ks"), ("ce", "se"), ("ci", "si"), ("cy", "sy"))
_SOUNDS = str.maketrans("bvcqgzd", "pfkkkst", "aeiouyhw")


def sound(name: str) -> str:
    """A phonetic key: the consonants of a name as groups of like sounds, no letter twice in a row."""
    text = "".join(c for c in name.lower() if c.isascii() and c.isalpha())
    for letters, alike in _ALIKE:
        text = text.replace(letters, alike)
    start = "a" if text[:1] in tuple("aeiou") else ""
    out = ""
    for c in text.translate(_SOUNDS):
        out += c if out[-1:] != c else ""
    return start + out


def near_miss(key: str) -> str | None:
    """The option a name is a misspelling of, if it is one: written much alike, or sounding alike."""
    name = _norm(key)
    if name in _BY_NORM or name in _SPARKS_OWN:
        return None
    close = difflib.get_close_matches(name, [_norm(k) for k in _CHECKED], n=1, cutoff=0.66)
    if close:
        return _BY_NORM[close[0]]
    heard = sound(name)
    return next((k for k in _CHECKED if len(heard) >= 4 and heard[:4] == sound(k)[:4]
                 and abs(len(heard) - len(sound(k))) <= 2), None)


def _to_bool(name: str, value: Any) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text in ("true", "false"):
        return text == "true"
    raise CefOptionsError(f"Option '{name}' expects true or false, got '{value}'")


def _to_int(name: str, value: Any) -> int:
    try:
        return int(str(value).strip())
    except ValueError as e:
        raise CefOptionsError(f"Option '{name}' expects an integer, got '{value}'") from e


@dataclass(frozen=True)
class CefOptions:
    max_records: int | None = None    # None: inference reads every line
    pivot_fields: bool = False
    mode: str = "permissive"
    corrupt_record_column_name: str | None = None
    defensive_mode: bool = False
    null_value: str = DEFAULT_NULL_VALUE
    date_format: str = DEFAULT_DATE_FORMAT
    # Our additions (see README "Deliberate differences").
    epoch_unit: str = "millis"        # unit written by dateFormat=millis
    repair_trailing: bool = True      # append the null token to lines ending in '='
    unescape: bool = False            # undo \= \| \n escapes on read

    @property
    def date_format_is_epoch(self) -> bool:
        return self.date_format.lower() == "millis"

    @property
    def effective_max_records(self) -> int | None:
        """The number of lines to infer from, None for all of them."""
        return self.max_records if self.max_records is not None and self.max_records >= 1 else None

    @classmethod
    def from_dict(cls, options: Mapping[str, Any] | None = None, **kwargs: Any) -> "CefOptions":
        merged: dict[str, Any] = dict(options or {})
        merged.update(kwargs)
        canon: dict[str, Any] = {}
        hints: list[str] = []
        for key, value in merged.items():
            known = _BY_NORM.get(_norm(key))
            if known is not None:
                canon[known] = value
                continue
            if (close := near_miss(key)) is not None:
                hints.append(f"Unable to find option '{key}', did you mean '{close}'")
            # Unrelated keys (path, compression, lineSep, ...) are Spark's.
        if hints:
            raise CefOptionsError("Unable to parse all options\n" + "\n".join(hints))

        fields: dict[str, Any] = {}
        if canon.get("maxRecords") is not None:
            fields["max_records"] = _to_int("maxRecords", canon["maxRecords"])
        if "pivotFields" in canon:
            fields["pivot_fields"] = _to_bool("pivotFields", canon["pivotFields"])
        if "defensiveMode" in canon:
            fields["defensive_mode"] = _to_bool("defensiveMode", canon["defensiveMode"])
        if "repairTrailing" in canon:
            fields["repair_trailing"] = _to_bool("repairTrailing", canon["repairTrailing"])
        if "unescape" in canon:
            fields["unescape"] = _to_bool("unescape", canon["unescape"])
        if canon.get("corruptRecordColumnName") is not None:
            fields["corrupt_record_column_name"] = str(canon["corruptRecordColumnName"])
        if canon.get("nullValue") is not None:
            fields["null_value"] = str(canon["nullValue"])
        if "dateFormat" in canon:
            fmt = str(canon["dateFormat"])
            if fmt.lower() != "millis" and fmt not in VALID_DATE_FORMATS:
                raise CefOptionsError(
                    f"Unable to parse date format '{fmt}', valid options are: "
                    + ", ".join(VALID_DATE_FORMATS))
            fields["date_format"] = fmt
        if "mode" in canon:
            mode = str(canon["mode"]).lower()
            if mode not in MODES:
                close = difflib.get_close_matches(mode, MODES, n=1, cutoff=0.6)
                hint = f", did you mean '{close[0]}'" if close else ""
                raise CefOptionsError(
                    f"Unknown mode '{canon['mode']}'{hint}; valid modes are: " + ", ".join(MODES))
            fields["mode"] = mode
        if "epochUnit" in canon:
            unit = str(canon["epochUnit"]).lower()
            if unit not in ("millis", "micros"):
                raise CefOptionsError(f"epochUnit must be 'millis' or 'micros', got '{unit}'")
            fields["epoch_unit"] = unit
        return cls(**fields)


def resolve(options: CefOptions | Mapping[str, Any] | None = None, **kwargs: Any) -> CefOptions:
    """Accept a ready ``CefOptions``, a dict of option strings, or keywords."""
    if isinstance(options, CefOptions):
        if kwargs:
            base = {
                "maxRecords": options.max_records, "pivotFields": options.pivot_fields,
                "mode": options.mode, "corruptRecordColumnName": options.corrupt_record_column_name,
                "defensiveMode": options.defensive_mode, "nullValue": options.null_value,
                "dateFormat": options.date_format, "epochUnit": options.epoch_unit,
                "repairTrailing": options.repair_trailing, "unescape": options.unescape,
            }
            return CefOptions.from_dict(base, **kwargs)
        return options
    return CefOptions.from_dict(options, **kwargs)

import pytest

from cefframe.options import near_miss, sound, CefOptions, CefOptionsError
from cefframe.sources.files import _split_options


def test_defaults():
    o = CefOptions.from_dict({})
    assert (o.effective_max_records, o.pivot_fields, o.mode, o.corrupt_record_column_name,
            o.defensive_mode, o.null_value, o.date_format) == (
        None, False, "permissive", None, False, "-", "MMM dd yyyy HH:mm:ss.SSS zzz")


def test_valid_map_and_case_insensitive_names():
    for keys in (("maxRecords", "pivotFields", "corruptRecordColumnName", "defensiveMode",
                  "nullValue", "dateFormat"),
                 ("MAXRECORDS", "pivotfields", "corrupt_record_column_name", "defensive_mode",
                  "NullValue", "DATEFORMAT")):
        o = CefOptions.from_dict(dict(zip(keys, ("10", "true", "test_col", "true", "NA", "millis"))))
        assert (o.max_records, o.pivot_fields, o.corrupt_record_column_name, o.defensive_mode,
                o.null_value, o.date_format) == (10, True, "test_col", True, "NA", "millis")


MISSPELT = {"maxRecrods": "maxRecords", "pivtFields": "pivotFields", "corruptRecordColName": "corruptRecordColumnName",
            "defensiveMod": "defensiveMode", "nullVal": "nullValue", "date_fromat": "dateFormat"}


def test_misspelt_options_get_hints():
    with pytest.raises(CefOptionsError) as e:
        CefOptions.from_dict(dict.fromkeys(MISSPELT, "1"))
    for bad, good in MISSPELT.items():
        assert f"Unable to find option '{bad}', did you mean '{good}'" in str(e.value)


HEARD = {"macksRekawrdz": "maxRecords", "pyvuttFheelds": "pivotFields", "koruptrekkord": "corruptRecordColumnName",
         "dhifensivvMoad": "defensiveMode", "nowlVallew": "nullValue", "deightForemat": "dateFormat", "macsRexord": "maxRecords",
         "datfrmt": "dateFormat", "nulVal": "nullValue", "devensiveMoad": "defensiveMode"}


def test_options_that_sound_alike_get_hints():
    assert sound("maxRecords") == sound("macksRekawrdz") == "mksrkrts" and sound("ABBA") == "ap" and sound("") == ""
    got = {bad: near_miss(bad) for bad in HEARD}
    assert {b: g for b, g in got.items() if g != HEARD[b]} == {"koruptrekkord": None}


SPARKS = """wholetext lineSep compression encoding pathGlobFilter recursiveFileLookup modifiedBefore modifiedAfter ignoreCorruptFiles
    ignoreMissingFiles basePath maxRecordsPerFile partitionOverwriteMode mergeSchema path checkpointLocation timeZone sep delimiter
    quote escape comment header inferSchema preferDate enforceSchema ignoreLeadingWhiteSpace ignoreTrailingWhiteSpace nanValue
    positiveInf negativeInf timestampFormat timestampNTZFormat enableDateTimeParsingFallback maxColumns maxCharsPerColumn
    columnNameOfCorruptRecord multiLine charToEscapeQuoteEscaping samplingRatio emptyValue locale unescapedQuoteHandling
    primitivesAsString prefersDecimal allowComments allowUnquotedFieldNames allowSingleQuotes allowNumericLeadingZeros
    allowBackslashEscapingAnyCharacter allowUnquotedControlChars allowNonNumericNumbers dropFieldIfAllNull ignoreNullFields
    datetimeRebaseMode int96RebaseMode maxFilesPerTrigger maxBytesPerTrigger latestFirst maxFileAge cleanSource sourceArchiveDir
    fileNameOnly maxCachedFiles discardCachedInputRatio fileFormat""".split()


def test_no_option_of_spark_gets_a_hint():
    assert {k: near_miss(k) for k in SPARKS if near_miss(k)} == {}


def test_options_of_sparks_sources_are_not_misspellings():
    own = {"fileFormat": "x", "maxColumns": 5, "Compression": "gzip", "LINESEP": "|", "recursivefilelookup": True,
           "pathglobfilter": "*.log", "maxBytesPerTrigger": "1g", "wholetext": True}
    assert CefOptions.from_dict(own) == CefOptions()
    cef, spark_opts = _split_options(own, {"NULLVALUE": "NA"})
    assert cef == {"NULLVALUE": "NA"} and set(spark_opts) == set(own) and spark_opts["recursivefilelookup"] == "true"


def test_unrelated_options_pass():
    CefOptions.from_dict({"path": "/x", "compression": "gzip", "lineSep": "\n", "mode": "failfast"})


def test_invalid_date_format():
    with pytest.raises(CefOptionsError, match="Unable to parse date format 'dd/MM/yyyy', valid options are"):
        CefOptions.from_dict({"dateFormat": "dd/MM/yyyy"})
    assert CefOptions.from_dict({"dateFormat": "MILLIS"}).date_format_is_epoch


def test_mode_values():
    assert CefOptions.from_dict({"mode": "DropMalformed"}).mode == "dropmalformed"
    with pytest.raises(CefOptionsError, match="did you mean 'failfast'"):
        CefOptions.from_dict({"mode": "failfst"})


@pytest.mark.parametrize("value,lines", [("0", None), (-5, None), (None, None), ("25", 25)])
def test_max_records_below_one_means_all_lines(value, lines):
    assert CefOptions.from_dict({"maxRecords": value}).effective_max_records == lines


def test_mode_ignores_case_and_blanks_are_refused():
    assert CefOptions.from_dict({"MODE": "FAILFAST"}).mode == "failfast"
    with pytest.raises(CefOptionsError, match="valid modes are"):
        CefOptions.from_dict({"mode": "strict"})

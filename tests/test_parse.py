import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cefframe import cef_extensions, cef_header, cef_timestamp, parse_cef
from cefframe.plans.inspect import count_calls, optimized_plan
from cefframe.schema import header_schema
from lines import lines_df


def schema(*ext):
    return T.StructType(header_schema() + [T.StructField(n, t) for n, t in ext])


S = T.StringType()
UTC = dt.timezone.utc


def utc(*a):
    return dt.datetime(*a)  # session is UTC; collected timestamps are naive UTC


def test_headers_and_syslog_prefix(spark):
    df = lines_df(spark, ["Mar  9 04:05:06 gw7 CEF:0|Northwind|Gatekeeper|7.2|AUTH-11|Door opened|6|src=192.0.2.8 act=let in"])
    r = parse_cef(df, schema(("src", S), ("act", S))).collect()[0]
    assert r.CEFVersion == "Mar  9 04:05:06 gw7 CEF:0"
    assert (r.DeviceVendor, r.DeviceProduct, r.DeviceVersion, r.SignatureID, r.Name, r.Severity) == (
        "Northwind", "Gatekeeper", "7.2", "AUTH-11", "Door opened", "6")
    assert (r.src, r.act) == ("192.0.2.8", "let in")


def test_escaped_pipe_in_header_and_bare_pipes_in_value(spark):
    df = lines_df(spark, [r"CEF:0|V|P|1|sig|Left \| Right|5|cs1=up|down and|back cs1Label=x"])
    r = parse_cef(df, schema(("cs1", S), ("cs1Label", S))).collect()[0]
    assert r.Name == r"Left \| Right"
    assert r.cs1 == "up|down and|back"


def test_escaped_equals_stays_and_value_is_trimmed(spark):
    df = lines_df(spark, [r"CEF:0|V|P|1|s|n|1|request=/a?x\=1 msg=  leading space   cs1=\t tabbed"])
    r = parse_cef(df, schema(("request", S), ("msg", S), ("cs1", S))).collect()[0]
    assert r.request == r"/a?x\=1"
    assert r.msg == "leading space"
    assert r.cs1 == r"\t tabbed"  # literal backslash-t, not a tab


def test_backslash_collapse_only_in_extensions(spark):
    df = lines_df(spark, [r"CEF:0|V|P\\x|1|s|n|1|fname=C:\\Users\\me path=a\nb"])
    r = parse_cef(df, schema(("fname", S), ("path", S))).collect()[0]
    assert r.DeviceProduct == r"P\\x"
    assert r.fname == r"C:\Users\me"
    assert r.path == r"a\nb"


def test_typed_dictionary(spark):
    line = ("CEF:0|V|P|1|s|n|1|eventId=9223372036854775807 cn1=12 cfp1=1.0 rt=1655789415000 "
            "slong=-0.125 slat=51.5 spt=70000 dpt=1.5 in=99999999999 cnt=x")
    sch = schema(("eventId", T.LongType()), ("cn1", T.LongType()), ("cfp1", T.FloatType()),
                 ("rt", T.TimestampType()), ("slong", T.DoubleType()), ("slat", T.DoubleType()),
                 ("spt", T.IntegerType()), ("dpt", T.IntegerType()), ("in", T.IntegerType()),
                 ("cnt", T.LongType()))
    r = parse_cef(lines_df(spark, [line]), sch).collect()[0]
    assert r.eventId == 9223372036854775807 and r.cn1 == 12 and r.cfp1 == 1.0
    assert r.rt == utc(2022, 6, 21, 5, 30, 15)
    assert (r.slong, r.slat, r.spt) == (-0.125, 51.5, 70000)
    assert r.dpt is None and r["in"] is None and r.cnt is None


def test_float_specials_follow_java(spark):
    df = lines_df(spark, [f"CEF:0|V|P|1|s|n|1|cfp1={v}" for v in ("NaN", "nan", "Infinity", "inf", "0x1p3", "1.0f")])
    got = [r.cfp1 for r in parse_cef(df, schema(("cfp1", T.FloatType()))).collect()]
    assert got[0] != got[0] and got[1] is None and got[2] == float("inf") and got[3] is None
    assert got[4:] == [8.0, 1.0]


def test_null_token_default_and_custom(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|-|n|1|a=- b=NA c=x"])
    r = parse_cef(df, schema(("a", S), ("b", S), ("c", S))).collect()[0]
    assert (r.SignatureID, r.a, r.b, r.c) == ("-", None, "NA", "x")  # headers are not null-mapped
    r = parse_cef(df, schema(("a", S), ("b", S)), nullValue="NA").collect()[0]
    assert (r.a, r.b) == ("-", None)


def test_duplicate_key_last_wins(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|ccode=US src=1 ccode=GB"])
    assert parse_cef(df, schema(("ccode", S))).collect()[0].ccode == "GB"


def test_header_name_conflict_gets_suffix(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|5|eventId=1 severity=1 Name=x"])
    r = parse_cef(df, schema(("eventId", T.LongType()), ("severity_1", S), ("Name_1", S))).collect()[0]
    assert (r.Severity, r.severity_1, r.Name_1) == ("5", "1", "x")


def test_trailing_equals_and_missing_keys(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|a=1 test=", "CEF:0|V|P|1|s|n|1|"])
    rows = parse_cef(df, schema(("a", S), ("test", S), ("zz", S))).collect()
    assert (rows[0].a, rows[0].test, rows[0].zz) == ("1", None, None)
    assert (rows[1].a, rows[1].test) == (None, None)


def test_defensive_mode(spark):
    line = "CEF:0|V|P|1|s|n|1|field1= filehash=cXV4IQ== field1Label=  cn1=5 test="
    sch = schema(("field1", S), ("filehash", S), ("field1Label", S), ("cn1", T.LongType()), ("test", S))
    plain = parse_cef(lines_df(spark, [line]), sch).collect()[0]
    assert plain.field1 == "filehash=cXV4IQ==" and plain.filehash is None
    r = parse_cef(lines_df(spark, [line]), sch, defensiveMode=True).collect()[0]
    assert (r.field1, r.filehash, r.field1Label, r.cn1, r.test) == (None, "cXV4IQ==", None, 5, None)


def test_trailing_base64_is_damaged_like_the_reference(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|hash=cXV4IQ=="])
    assert parse_cef(df, schema(("hash", S))).collect()[0].hash == "cXV4IQ==-"
    assert parse_cef(df, schema(("hash", S)), repairTrailing=False).collect()[0].hash == "cXV4IQ=="


@pytest.mark.parametrize("text,expected", [
    ("1655789415000", utc(2022, 6, 21, 5, 30, 15)),
    ("Jun 21 2022 05:30:15", utc(2022, 6, 21, 5, 30, 15)),
    ("Jun 21 2022 05:30:15.123 UTC", utc(2022, 6, 21, 5, 30, 15, 123000)),
    ("Jun 21 2022 05:30:15.123", utc(2022, 6, 21, 5, 30, 15, 123000)),
    ("Jun 21 2022 05:30:15 GMT", utc(2022, 6, 21, 5, 30, 15)),
    ("Jun 21 05:30:15", utc(1970, 6, 21, 5, 30, 15)),
    ("Jun 21 05:30:15.500 Z", utc(1970, 6, 21, 5, 30, 15, 500000)),
    ("Jun 21 05:30:15.500", utc(1970, 6, 21, 5, 30, 15, 500000)),
    ("Jun 21 05:30:15 +02:00", utc(1970, 6, 21, 3, 30, 15)),
    ("Dec 31 1999 23:59:59 Z", utc(1999, 12, 31, 23, 59, 59)),
    ("Jun 21 2022 05:30:15 Europe/Paris", utc(2022, 6, 21, 3, 30, 15)),
    ("Feb 30 2024 05:30:15", utc(2024, 2, 29, 5, 30, 15)),
    ("2022-06-21T05:30:15", utc(2022, 6, 21, 5, 30, 15)),
    ("2022-06-21T05:30:15.5+01:00", utc(2022, 6, 21, 4, 30, 15, 500000)),
    ("2022-06-21T05:30:15Z[UTC]", utc(2022, 6, 21, 5, 30, 15)),
    ("2022 21 Jun 05:30", None), ("jun 21 2022 05:30:15", None), ("Feb 32 2024 05:30:15", None),
    ("Jun 21 2022 05:30:60", None), ("2022-06-21", None), ("99999999999999999999", None),
])
def test_timestamp_formats(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(cef_timestamp(F.col("v")).alias("t")).collect()[0].t == expected


def test_blank_line_is_missing_vendor(spark):
    df = lines_df(spark, [""])
    r = parse_cef(df, schema(("_c", S)), corruptRecordColumnName="_c").collect()[0]
    assert (r.CEFVersion, r.DeviceVendor, r._c) == ("", None, "")


def test_header_and_extension_functions(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|a=1 b=x y a=2 c=-"])
    r = df.select(cef_header(F.col("value")).alias("h"), cef_extensions(F.col("value")).alias("m")).collect()[0]
    assert r.h.SignatureID == "s" and r.h.Severity == "1"
    assert r.m == {"a": "2", "b": "x y", "c": None}


def test_passthrough_columns_kept(spark):
    df = spark.createDataFrame([("CEF:0|V|P|1|s|n|1|a=1", "2020")], "value string, year string")
    out = parse_cef(df, schema(("a", S)))
    assert out.columns[-1] == "year" and out.collect()[0].year == "2020"


def test_plan_runs_pair_regex_once_and_prunes_it(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|a=1 b=2 rt=1"])
    sch = schema(("a", S), ("b", T.LongType()), ("rt", T.TimestampType()))
    full = optimized_plan(parse_cef(df, sch))
    assert count_calls(full, "regexp_extract_all") == 1
    headers_only = optimized_plan(parse_cef(df, sch).select("SignatureID"))
    assert count_calls(headers_only, "regexp_extract_all") == 0

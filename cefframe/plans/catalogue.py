"""Query catalogue: every operator of the library exercised on the test tables.

Each entry is ``name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL | None)``.
CEF lines are built from the tables with plain ``concat`` (independent of the
encoder wherever the parser is under test); the oracle SQL states the
expected result straight from the source columns, so DuckDB never has to
parse CEF.  Instants are returned as epoch-millis ``bigint``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import cef_extensions, cef_header
from ..operators.encode import to_cef_lines
from ..operators.infer import infer_cef_schema
from ..operators.parse import parse_cef, split_malformed
from ..sources.files import read_cef, register_cef_view, write_cef
from ..streaming.stream import read_cef_stream, write_cef_stream

Builder = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, sql: str | None):
    def wrap(fn: Builder) -> Builder:
        CATALOGUE[name] = (fn, sql)
        return fn
    return wrap


# ---------------------------------------------------------------- helpers

def _utc(spark: SparkSession) -> None:
    # Oracle values are UTC; CEF text without a zone is UTC as well.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _utc(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint directory, deleted when the driver ends.

    The directory is read from the session (scheme included); only a local session without one gets a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cefframe-")
    path = f"{base.rstrip('/')}/cefframe-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)  # noqa: SLF001
    return path


def _millis(ts: Column) -> Column:
    """Epoch millis of a ``timestamp_ntz`` (zone independent, truncating)."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _header_text(product: str = "Sensor") -> Column:
    return F.concat(F.lit(f"CEF:0|Acme|{product}|1.0|"), F.col("event_type"), F.lit("|User "),
                    F.col("event_type"), F.lit("|"), _s(F.col("event_id") % 10), F.lit("|"))


def _base_ext() -> Column:
    return F.concat(F.lit("eventId="), _s("event_id"), F.lit(" rt="), _s(_millis(F.col("ts"))),
                    F.lit(" suser="), _s("user_id"), F.lit(" slat="), _s("value"),
                    F.lit(" msg="), F.col("props"))


def _lines(events: DataFrame, *ext_parts: Column, base: bool = True) -> DataFrame:
    parts = [_base_ext()] if base else []
    for p in ext_parts:
        parts.extend([F.lit(" "), p] if parts else [p])
    return events.select("event_id", F.concat(_header_text(), *parts).alias("value"))


def _schema(*ext: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(S.header_schema() + [T.StructField(n, t, True) for n, t in ext])


BASE_EXT = (("eventId", T.LongType()), ("rt", T.TimestampType()), ("suser", T.StringType()),
            ("slat", T.DoubleType()), ("msg", T.StringType()))
BASE_SCHEMA = _schema(*BASE_EXT)


def _ms(c: str) -> Column:
    return F.unix_millis(F.col(c)).alias(c + "_ms")


def _schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "pos int, name string, type string")


_HEAD_SQL = ("'CEF:0' AS CEFVersion, 'Acme' AS DeviceVendor, 'Sensor' AS DeviceProduct, "
             "'1.0' AS DeviceVersion, event_type AS SignatureID, 'User ' || event_type AS Name, "
             "CAST(event_id % 10 AS VARCHAR) AS Severity")
_MS_SQL = "(epoch_us(ts) // 1000)"


# ---------------------------------------------------------------- flagship

@query("severity_rollup", f"""
SELECT event_type AS SignatureID, count(*) AS n_events, max(event_id) AS max_event_id,
       min({_MS_SQL}) AS first_rt_ms, count(DISTINCT CAST(user_id AS VARCHAR)) AS n_users
FROM events GROUP BY event_type""")
def severity_rollup(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse_cef(_lines(_table(spark, d, "events")), BASE_SCHEMA)
    return parsed.groupBy("SignatureID").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("eventId").alias("max_event_id"),
        F.min(F.unix_millis("rt")).alias("first_rt_ms"),
        F.countDistinct("suser").alias("n_users"))


# ---------------------------------------------------------------- parsing

@query("parse_headers", f"""
SELECT CASE WHEN event_id % 3 = 0 THEN 'Jan 01 00:00:00 host CEF:0' ELSE 'CEF:0' END AS CEFVersion,
       'Acme' AS DeviceVendor, 'Sensor' AS DeviceProduct, '1.0' AS DeviceVersion,
       event_type AS SignatureID, 'User ' || event_type AS Name,
       CAST(event_id % 10 AS VARCHAR) AS Severity, event_id AS eventId
FROM events""")
def parse_headers(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select(F.concat(
        F.when(F.col("event_id") % 3 == 0, F.lit("Jan 01 00:00:00 host ")).otherwise(F.lit("")),
        _header_text(), _base_ext()).alias("value"))
    return parse_cef(lines, BASE_SCHEMA).select(*S.HEADER_FIELDS, "eventId")


@query("parse_escaped_pipe", r"""
SELECT 'Sensor\|Pro' AS DeviceProduct, 'Invalid \| ' || event_type AS Name,
       'This|is|' || event_type || '|data' AS cs1, event_id AS eventId
FROM events""")
def parse_escaped_pipe(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select(F.concat(
        F.lit(r"CEF:0|Acme|Sensor\|Pro|1.0|"), F.col("event_type"), F.lit(r"|Invalid \| "),
        F.col("event_type"), F.lit("|5|eventId="), _s("event_id"), F.lit(" cs1=This|is|"),
        F.col("event_type"), F.lit("|data")).alias("value"))
    sch = _schema(("eventId", T.LongType()), ("cs1", T.StringType()))
    return parse_cef(lines, sch).select("DeviceProduct", "Name", "cs1", "eventId")


@query("parse_typed", """
SELECT event_id AS eventId, CAST(user_id AS INTEGER) AS spt, event_id * 1000003 AS cn1,
       round(value, 2) AS cfp1_r, value AS slat, -value AS dlong,
       CASE WHEN event_id % 5 IN (0, 1, 2) THEN NULL ELSE CAST(user_id AS INTEGER) END AS dpt,
       CASE WHEN event_id % 4 = 0 THEN 12345678901234 ELSE -event_id END AS cnt
FROM events""")
def parse_typed(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    m5 = F.col("event_id") % 5
    dpt = (F.when(m5 == 0, F.concat(F.lit("x"), _s("event_id")))
           .when(m5 == 1, F.lit("99999999999")).when(m5 == 2, F.lit("1.5"))
           .otherwise(_s("user_id")))
    cnt = F.when(F.col("event_id") % 4 == 0, F.lit("12345678901234")).otherwise(
        _s(-F.col("event_id")))
    lines = ev.select(F.concat(
        _header_text(), F.lit("eventId="), _s("event_id"), F.lit(" spt="), _s("user_id"),
        F.lit(" cn1="), _s(F.col("event_id") * 1000003), F.lit(" cfp1="), _s("value"),
        F.lit(" slat="), _s("value"), F.lit(" dlong="), _s(-F.col("value")),
        F.lit(" dpt="), dpt, F.lit(" cnt="), cnt).alias("value"))
    sch = _schema(("eventId", T.LongType()), ("spt", T.IntegerType()), ("cn1", T.LongType()),
                  ("cfp1", T.FloatType()), ("slat", T.DoubleType()), ("dlong", T.DoubleType()),
                  ("dpt", T.IntegerType()), ("cnt", T.LongType()))
    p = parse_cef(lines, sch)
    return p.select("eventId", "spt", "cn1", F.round(F.col("cfp1").cast("double"), 2).alias("cfp1_r"),
                    "slat", "dlong", "dpt", "cnt")


@query("parse_null_token", """
SELECT event_id AS eventId,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS suser,
       'padded ' || event_type AS cs2,
       CASE WHEN event_id % 4 = 1 THEN NULL ELSE 'NA' END AS cs3
FROM events""")
def parse_null_token(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    suser = F.when(F.col("event_id") % 4 == 0, F.lit("-")).otherwise(_s("user_id"))
    cs3 = F.when(F.col("event_id") % 4 == 1, F.lit("-")).otherwise(F.lit("NA"))
    lines = ev.select(F.concat(_header_text(), F.lit("eventId="), _s("event_id"),
                               F.lit(" suser="), suser, F.lit(" cs2=   padded "), F.col("event_type"),
                               F.lit("\t  cs3="), cs3).alias("value"))
    sch = _schema(("eventId", T.LongType()), ("suser", T.StringType()), ("cs2", T.StringType()),
                  ("cs3", T.StringType()))
    return parse_cef(lines, sch).select("eventId", "suser", "cs2", "cs3")


@query("parse_backslash", r"""
SELECT event_id AS eventId, 'C:\Users\' || event_type || '\file.txt' AS fname,
       'a\=b' || CAST(user_id AS VARCHAR) AS cs1
FROM events""")
def parse_backslash(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select(F.concat(_header_text(), F.lit("eventId="), _s("event_id"),
                               F.lit(r" fname=C:\\Users\\"), F.col("event_type"),
                               F.lit(r"\\file.txt cs1=a\=b"), _s("user_id")).alias("value"))
    sch = _schema(("eventId", T.LongType()), ("fname", T.StringType()), ("cs1", T.StringType()))
    return parse_cef(lines, sch).select("eventId", "fname", "cs1")


@query("parse_duplicate_key", """
SELECT event_id AS eventId, event_type AS ccode, CAST(user_id AS VARCHAR) AS suser FROM events""")
def parse_duplicate_key(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select(F.concat(_header_text(), F.lit("ccode=ZZ suser=nobody eventId="),
                               _s("event_id"), F.lit(" ccode="), F.col("event_type"),
                               F.lit(" suser="), _s("user_id")).alias("value"))
    sch = _schema(("eventId", T.LongType()), ("ccode", T.StringType()), ("suser", T.StringType()))
    return parse_cef(lines, sch).select("eventId", "ccode", "suser")


@query("parse_conflict_name", """
SELECT event_id AS eventId, CAST(event_id % 10 AS VARCHAR) AS Severity,
       event_type AS severity_1, 'n' || CAST(event_id AS VARCHAR) AS name_1
FROM events""")
def parse_conflict_name(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select("event_id", F.concat(
        _header_text(), F.lit("eventId="), _s("event_id"), F.lit(" severity="),
        F.col("event_type"), F.lit(" name=n"), _s("event_id")).alias("value"))
    sch = infer_cef_schema(lines, order=F.col("event_id"))
    return parse_cef(lines.select("value"), sch).select("eventId", "Severity", "severity_1", "name_1")


_TS_FORMATS = (
    # (spark date_format pattern on timestamp_ntz, literal suffix)
    None,                                      # 0: epoch millis
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", ""),      # 1: ISO, no zone -> UTC
    ("MMM dd yyyy HH:mm:ss", ""),              # 2
    ("MMM dd yyyy HH:mm:ss.SSS", " UTC"),      # 3
    ("MMM dd yyyy HH:mm:ss.SSS", ""),          # 4
    ("MMM dd yyyy HH:mm:ss", " GMT"),          # 5
    ("MMM dd HH:mm:ss", ""),                   # 6
    ("MMM dd HH:mm:ss.SSS", " UTC"),           # 7
    ("MMM dd HH:mm:ss.SSS", ""),               # 8
    ("MMM dd HH:mm:ss", " Z"),                 # 9
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "+02:00"),   # 10: ISO with offset
    ("yyyy dd MMM HH:mm", ""),                 # 11: not a CEF layout -> null
)
_Y1970 = ("epoch_us(make_timestamp(1970, month(ts), day(ts), hour(ts), minute(ts), "
          "second(ts))) // 1000")


@query("parse_timestamps", f"""
SELECT event_id AS eventId,
  CASE event_id % 12
    WHEN 0 THEN {_MS_SQL}
    WHEN 1 THEN {_MS_SQL}
    WHEN 2 THEN epoch_us(date_trunc('second', ts)) // 1000
    WHEN 3 THEN {_MS_SQL}
    WHEN 4 THEN {_MS_SQL}
    WHEN 5 THEN epoch_us(date_trunc('second', ts)) // 1000
    WHEN 6 THEN {_Y1970}
    WHEN 7 THEN {_Y1970} + millisecond(ts) % 1000
    WHEN 8 THEN {_Y1970} + millisecond(ts) % 1000
    WHEN 9 THEN {_Y1970}
    WHEN 10 THEN {_MS_SQL} - 7200000
    ELSE NULL END AS rt_ms
FROM events""")
def parse_timestamps(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    k = F.col("event_id") % 12
    text = F.when(k == 0, _s(_millis(F.col("ts"))))
    for i, spec in enumerate(_TS_FORMATS):
        if spec is None:
            continue
        fmt, suffix = spec
        text = text.when(k == i, F.concat(F.date_format("ts", fmt), F.lit(suffix)))
    lines = ev.select(F.concat(_header_text(), F.lit("eventId="), _s("event_id"), F.lit(" rt="),
                               text, F.lit(" suser=x")).alias("value"))
    sch = _schema(("eventId", T.LongType()), ("rt", T.TimestampType()))
    return parse_cef(lines, sch).select("eventId", _ms("rt").alias("rt_ms"))


@query("parse_extension_map", """
SELECT event_id AS eventId, CAST(user_id AS VARCHAR) AS suser, 5 AS n_keys, props AS msg FROM events""")
def parse_extension_map(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(_table(spark, d, "events"))
    m = cef_extensions(F.col("value"))
    return lines.select(m["eventId"].cast("bigint").alias("eventId"), m["suser"].alias("suser"),
                        F.size(m).alias("n_keys"), m["msg"].alias("msg"))


@query("parse_missing_keys", """
SELECT event_id AS eventId,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS suser,
       CASE WHEN event_id % 3 = 1 THEN NULL ELSE value END AS slat
FROM events""")
def parse_missing_keys(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    m3 = F.col("event_id") % 3
    suser = F.when(m3 == 0, F.lit("")).otherwise(F.concat(F.lit(" suser="), _s("user_id")))
    slat = F.when(m3 == 1, F.lit("")).otherwise(F.concat(F.lit(" slat="), _s("value")))
    lines = ev.select(F.concat(_header_text(), F.lit("eventId="), _s("event_id"), suser, slat)
                      .alias("value"))
    sch = _schema(("eventId", T.LongType()), ("suser", T.StringType()), ("slat", T.DoubleType()))
    return parse_cef(lines, sch).select("eventId", "suser", "slat")


@query("trailing_equals", """
SELECT event_id AS eventId,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'v' || CAST(event_id AS VARCHAR) END AS test
FROM events""")
def trailing_equals(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    tail = F.when(F.col("event_id") % 2 == 0, F.lit("")).otherwise(
        F.concat(F.lit("v"), _s("event_id")))
    lines = ev.select(F.concat(_header_text(), F.lit("eventId="), _s("event_id"), F.lit(" test="),
                               tail).alias("value"))
    sch = _schema(("eventId", T.LongType()), ("test", T.StringType()))
    return parse_cef(lines, sch).select("eventId", "test")


@query("defensive_repair", """
SELECT event_id AS eventId, NULL::VARCHAR AS field1, 'aGFzaA==' AS filehash,
       'x' || CAST(event_id AS VARCHAR) AS field2, NULL::VARCHAR AS last
FROM events""")
def defensive_repair(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select(F.concat(_header_text(), F.lit("eventId="), _s("event_id"),
                               F.lit(" field1= filehash=aGFzaA== field2=x"), _s("event_id"),
                               F.lit(" last=")).alias("value"))
    sch = _schema(("eventId", T.LongType()), ("field1", T.StringType()),
                  ("filehash", T.StringType()), ("field2", T.StringType()), ("last", T.StringType()))
    return parse_cef(lines, sch, defensiveMode=True).select(
        "eventId", "field1", "filehash", "field2", "last")


# ---------------------------------------------------------------- pivot

@query("pivot_labels", """
SELECT event_id AS eventId, CAST(value AS VARCHAR) AS Reading, event_type AS Kind,
       event_id AS "Sequence"
FROM events""")
def pivot_labels(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select("event_id", F.concat(
        _header_text(), F.lit("eventId="), _s("event_id"), F.lit(" cs1="), _s("value"),
        F.lit(" cs1Label=Reading cs2="), F.col("event_type"), F.lit(" cs2Label=Kind cn1="),
        _s("event_id"), F.lit(" cn1Label=Sequence")).alias("value"))
    sch = infer_cef_schema(lines, order=F.col("event_id"), pivotFields=True)
    return parse_cef(lines.select("value"), sch, pivotFields=True).select(
        "eventId", "Reading", "Kind", "Sequence")


@query("pivot_partial", """
SELECT event_id AS eventId,
       CASE WHEN event_id % 5 NOT IN (0, 1) THEN CAST(value AS VARCHAR) END AS Reading,
       CASE WHEN event_id % 5 = 0 THEN CAST(value AS VARCHAR) END AS cs1,
       CASE WHEN event_id % 5 = 1 THEN 'Reading' END AS cs1Label
FROM events""")
def pivot_partial(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    m5 = F.col("event_id") % 5
    key = F.when(m5 == 1, F.lit("")).otherwise(F.concat(F.lit(" cs1="), _s("value")))
    label = F.when(m5 == 0, F.lit("")).otherwise(F.lit(" cs1Label=Reading"))
    lines = ev.select("event_id", F.concat(_header_text(), F.lit("eventId="), _s("event_id"),
                                           key, label).alias("value"))
    sch = infer_cef_schema(lines, order=F.col("event_id"), pivotFields=True)
    return parse_cef(lines.select("value"), sch, pivotFields=True).select(
        "eventId", "Reading", "cs1", "cs1Label")


@query("pivot_conflict", """
SELECT event_id AS eventId, CAST(event_id % 10 AS VARCHAR) AS Severity, event_type AS Severity_1
FROM events""")
def pivot_conflict(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select("event_id", F.concat(_header_text(), F.lit("eventId="), _s("event_id"),
                                           F.lit(" cs3Label=Severity cs3="), F.col("event_type"))
                      .alias("value"))
    sch = infer_cef_schema(lines, order=F.col("event_id"), pivotFields=True)
    return parse_cef(lines.select("value"), sch, pivotFields=True).select(
        "eventId", "Severity", "Severity_1")


@query("pivot_type_clash", """
SELECT event_id AS eventId,
       CASE WHEN event_id % 2 = 0 THEN event_id END AS Amount,
       event_id % 2 = 1 AS is_corrupt
FROM events""")
def pivot_type_clash(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    pair = F.when(F.col("event_id") % 2 == 0,
                  F.concat(F.lit(" cn1="), _s("event_id"), F.lit(" cn1Label=Amount"))).otherwise(
        F.concat(F.lit(" cs4=t"), _s("event_id"), F.lit(" cs4Label=Amount")))
    lines = ev.select("event_id", F.concat(_header_text(), F.lit("eventId="), _s("event_id"), pair)
                      .alias("value"))
    opts = dict(pivotFields=True, corruptRecordColumnName="_corrupt_record")
    sch = infer_cef_schema(lines, order=F.col("event_id"), **opts)
    return parse_cef(lines.select("value"), sch, **opts).select(
        "eventId", "Amount", F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


# ---------------------------------------------------------------- malformed lines

def _truncated(ev: DataFrame) -> DataFrame:
    """id % 9 = k < 7 keeps k+1 header pieces; 7 and 8 are whole lines."""
    k = F.col("event_id") % 9
    heads = F.array(F.lit("CEF:0"), F.lit("Acme"), F.lit("Sensor"), F.lit("1.0"), F.col("event_type"),
                    F.concat(F.lit("User "), F.col("event_type")), _s(F.col("event_id") % 10))
    full = F.concat(_header_text(), _base_ext())
    short = F.concat_ws("|", F.slice(heads, 1, (k + 1).cast("int")))
    return ev.select("event_id", F.when(k >= 7, full).otherwise(short).alias("value"))


_TRUNC_HEAD_SQL = """
  'CEF:0' AS CEFVersion,
  CASE WHEN event_id % 9 >= 1 THEN 'Acme' END AS DeviceVendor,
  CASE WHEN event_id % 9 >= 2 THEN 'Sensor' END AS DeviceProduct,
  CASE WHEN event_id % 9 >= 3 THEN '1.0' END AS DeviceVersion,
  CASE WHEN event_id % 9 >= 4 THEN event_type END AS SignatureID,
  CASE WHEN event_id % 9 >= 5 THEN 'User ' || event_type END AS Name,
  CASE WHEN event_id % 9 >= 6 THEN CAST(event_id % 10 AS VARCHAR) END AS Severity,
  CASE WHEN event_id % 9 >= 7 THEN event_id END AS eventId"""

_REASON_SQL = """CASE event_id % 9
    WHEN 0 THEN 'Missing device vendor in record'
    WHEN 1 THEN 'Missing device product in record'
    WHEN 2 THEN 'Missing device version in record'
    WHEN 3 THEN 'Missing signature id in record'
    WHEN 4 THEN 'Missing name in record'
    WHEN 5 THEN 'Missing severity in record'
    WHEN 6 THEN 'Record does not contain the correct number of pipe separated values'
  END"""


@query("mode_permissive", f"SELECT {_TRUNC_HEAD_SQL} FROM events")
def mode_permissive(spark: SparkSession, d: str) -> DataFrame:
    lines = _truncated(_table(spark, d, "events")).select("value")
    return parse_cef(lines, BASE_SCHEMA).select(*S.HEADER_FIELDS, "eventId")


@query("mode_corrupt_column", f"""
SELECT {_TRUNC_HEAD_SQL},
  CASE WHEN event_id % 9 < 7 THEN array_to_string(list_slice(
    ['CEF:0', 'Acme', 'Sensor', '1.0', event_type, 'User ' || event_type,
     CAST(event_id % 10 AS VARCHAR)], 1, CAST(event_id % 9 + 1 AS INTEGER)), '|') END AS _corrupt_record
FROM events""")
def mode_corrupt_column(spark: SparkSession, d: str) -> DataFrame:
    lines = _truncated(_table(spark, d, "events")).select("value")
    sch = T.StructType(BASE_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    return parse_cef(lines, sch, corruptRecordColumnName="_corrupt_record").select(
        *S.HEADER_FIELDS, "eventId", "_corrupt_record")


@query("mode_drop", """
SELECT event_id AS eventId, event_type AS SignatureID, CAST(user_id AS VARCHAR) AS suser
FROM events WHERE event_id % 9 >= 7""")
def mode_drop(spark: SparkSession, d: str) -> DataFrame:
    lines = _truncated(_table(spark, d, "events")).select("value")
    return parse_cef(lines, BASE_SCHEMA, mode="dropmalformed").select("eventId", "SignatureID", "suser")


@query("quarantine_counts", f"""
SELECT {_REASON_SQL} AS reason, count(*) AS n
FROM events WHERE event_id % 9 < 7 GROUP BY 1""")
def quarantine_counts(spark: SparkSession, d: str) -> DataFrame:
    lines = _truncated(_table(spark, d, "events")).select("value")
    _, bad = split_malformed(lines, BASE_SCHEMA)
    return bad.groupBy(F.col("_cef_error").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("quarantine_good", """
SELECT event_id AS eventId, event_type AS SignatureID FROM events WHERE event_id % 9 >= 7""")
def quarantine_good(spark: SparkSession, d: str) -> DataFrame:
    lines = _truncated(_table(spark, d, "events")).select("value")
    good, _ = split_malformed(lines, BASE_SCHEMA)
    return good.select("eventId", "SignatureID")


@query("mode_failfast_clean", f"""
SELECT event_id AS eventId, event_type AS SignatureID, {_MS_SQL} AS rt_ms FROM events""")
def mode_failfast_clean(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse_cef(_lines(_table(spark, d, "events")).select("value"), BASE_SCHEMA, mode="failfast")
    return parsed.select("eventId", "SignatureID", _ms("rt").alias("rt_ms"))


# ---------------------------------------------------------------- inference

_EXTRA_KEY = {"click": ("request", "string"), "view": ("dpt", "int"), "error": ("reason", "string"),
              "purchase": ("cfp2", "float"), "signup": ("start", "timestamp")}


def _infer_lines(ev: DataFrame) -> DataFrame:
    et = F.col("event_type")
    extra = (F.when(et == "click", F.concat(F.lit("request=/p/"), _s("event_id")))
             .when(et == "view", F.concat(F.lit("dpt="), _s("user_id")))
             .when(et == "error", F.concat(F.lit("reason=e"), _s("event_id")))
             .when(et == "purchase", F.concat(F.lit("cfp2="), _s("value")))
             .when(et == "signup", F.concat(F.lit("start="), _s(_millis(F.col("ts")))))
             .otherwise(F.lit("other=1")))
    return _lines(ev, extra)


def _infer_sql(where: str = "") -> str:
    base = ", ".join(f"({i}, '{n}', 'string')" for i, n in enumerate(S.HEADER_FIELDS))
    base += ", (7, 'eventId', 'bigint'), (8, 'rt', 'timestamp'), (9, 'suser', 'string'), " \
            "(10, 'slat', 'double'), (11, 'msg', 'string')"
    name = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in _EXTRA_KEY.items()) \
        + " ELSE 'other' END"
    typ = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in _EXTRA_KEY.items()) \
        + " ELSE 'string' END"
    return f"""
SELECT pos, name, type FROM (VALUES {base}) AS t(pos, name, type)
UNION ALL
SELECT CAST(11 + row_number() OVER (ORDER BY first_id) AS INTEGER) AS pos, name, type
FROM (SELECT {name} AS name, {typ} AS type, min(event_id) AS first_id
      FROM events {where} GROUP BY 1, 2)"""


@query("infer_schema", _infer_sql())
def infer_schema(spark: SparkSession, d: str) -> DataFrame:
    lines = _infer_lines(_table(spark, d, "events"))
    sch = infer_cef_schema(lines, order=F.col("event_id"))
    return _schema_rows(spark, sch)


@query("infer_max_records", _infer_sql(
    "WHERE event_id IN (SELECT event_id FROM events ORDER BY event_id LIMIT 3)"))
def infer_max_records(spark: SparkSession, d: str) -> DataFrame:
    lines = _infer_lines(_table(spark, d, "events"))
    sch = infer_cef_schema(lines, order=F.col("event_id"), maxRecords=3)
    return _schema_rows(spark, sch)


@query("infer_pivot", """
SELECT pos, name, type FROM (VALUES (0, 'CEFVersion', 'string'), (1, 'DeviceVendor', 'string'),
  (2, 'DeviceProduct', 'string'), (3, 'DeviceVersion', 'string'), (4, 'SignatureID', 'string'),
  (5, 'Name', 'string'), (6, 'Severity', 'string'), (7, 'eventId', 'bigint'),
  (8, 'rt', 'timestamp'), (9, 'Reading', 'string')) AS t(pos, name, type)
UNION ALL
SELECT CAST(9 + row_number() OVER (ORDER BY first_id) AS INTEGER) AS pos, name, type
FROM (SELECT CASE event_type WHEN 'error' THEN 'Severity_1' WHEN 'click' THEN 'cs3'
                             ELSE 'Views' END AS name,
             CASE event_type WHEN 'error' THEN 'string' WHEN 'click' THEN 'string'
                             ELSE 'bigint' END AS type,
             min(event_id) AS first_id
      FROM events WHERE event_type IN ('error', 'click', 'view') GROUP BY 1, 2)""")
def infer_pivot(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    et = F.col("event_type")
    extra = (F.when(et == "error", F.concat(F.lit(" cs2=e"), _s("event_id"), F.lit(" cs2Label=Severity")))
             .when(et == "click", F.concat(F.lit(" cs3=u"), _s("event_id")))
             .when(et == "view", F.concat(F.lit(" cn2="), _s("event_id"), F.lit(" cn2Label=Views")))
             .otherwise(F.lit("")))
    lines = ev.select("event_id", F.concat(
        _header_text(), F.lit("eventId="), _s("event_id"), F.lit(" rt="), _s(_millis(F.col("ts"))),
        F.lit(" cs1="), _s("value"), F.lit(" cs1Label=Reading"), extra).alias("value"))
    sch = infer_cef_schema(lines, order=F.col("event_id"), pivotFields=True)
    return _schema_rows(spark, sch)


# ---------------------------------------------------------------- encoding

def _encode_frame(ev: DataFrame, product: str = "Sensor|Pro") -> DataFrame:
    return ev.select(
        F.lit("CEF:0").alias("CEFVersion"), F.lit("Acme").alias("DeviceVendor"),
        F.lit(product).alias("DeviceProduct"), F.lit("1.0").alias("DeviceVersion"),
        F.col("event_type").alias("SignatureID"),
        F.concat(F.lit("User "), F.col("event_type")).alias("Name"),
        _s(F.col("event_id") % 10).alias("Severity"),
        F.col("event_id").alias("eventId"), F.col("ts").cast("timestamp").alias("rt"),
        _s("user_id").alias("suser"), F.col("value").alias("slat"),
        F.concat(F.lit("k="), F.col("props")).alias("msg"))


_ENC_HEAD_SQL = ("'CEF:0|Acme|Sensor\\|Pro|1.0|' || event_type || '|User ' || event_type || '|' || "
                 "CAST(event_id % 10 AS VARCHAR) || '|'")


@query("encode_lines", f"""
SELECT {_ENC_HEAD_SQL} || 'eventId=' || CAST(event_id AS VARCHAR)
  || ' rt=' || strftime(ts, '%b %d %Y %H:%M:%S.%g') || ' UTC'
  || ' suser=' || CAST(user_id AS VARCHAR) || ' slat=' || CAST(value AS VARCHAR)
  || ' msg=k\\=' || props AS value
FROM events""")
def encode_lines(spark: SparkSession, d: str) -> DataFrame:
    return to_cef_lines(_encode_frame(_table(spark, d, "events")))


@query("encode_nulls", f"""
SELECT {_ENC_HEAD_SQL} || 'eventId=' || CAST(event_id AS VARCHAR)
  || ' suser=' || CASE WHEN event_id % 3 = 0 THEN 'NA' ELSE CAST(user_id AS VARCHAR) END
  || ' slat=' || CASE WHEN event_id % 3 = 1 THEN 'NA' ELSE CAST(value AS VARCHAR) END AS value
FROM events""")
def encode_nulls(spark: SparkSession, d: str) -> DataFrame:
    df = _encode_frame(_table(spark, d, "events"))
    df = df.select(*S.HEADER_FIELDS, "eventId",
                   F.when(F.col("eventId") % 3 != 0, F.col("suser")).alias("suser"),
                   F.when(F.col("eventId") % 3 != 1, F.col("slat")).alias("slat"))
    return to_cef_lines(df, nullValue="NA")


@query("encode_unsupported", f"""
SELECT {_ENC_HEAD_SQL} || 'eventId=' || CAST(event_id AS VARCHAR)
  || ' flag=- day=- tags=-' AS value
FROM events""")
def encode_unsupported(spark: SparkSession, d: str) -> DataFrame:
    df = _encode_frame(_table(spark, d, "events"))
    df = df.select(*S.HEADER_FIELDS, "eventId", (F.col("eventId") % 2 == 0).alias("flag"),
                   F.col("rt").cast("date").alias("day"), F.array(F.col("suser")).alias("tags"))
    return to_cef_lines(df)


@query("encode_millis", f"""
SELECT {_ENC_HEAD_SQL} || 'eventId=' || CAST(event_id AS VARCHAR)
  || ' rt=' || CAST({_MS_SQL} AS VARCHAR) AS value
FROM events""")
def encode_millis(spark: SparkSession, d: str) -> DataFrame:
    df = _encode_frame(_table(spark, d, "events")).select(*S.HEADER_FIELDS, "eventId", "rt")
    return to_cef_lines(df, dateFormat="millis")


@query("encode_date_formats", f"""
SELECT {_ENC_HEAD_SQL} || 'eventId=' || CAST(event_id AS VARCHAR)
  || ' a=' || strftime(ts, '%b %d %Y %H:%M:%S') AS value
FROM events
UNION ALL
SELECT {_ENC_HEAD_SQL} || 'eventId=' || CAST(event_id AS VARCHAR)
  || ' b=' || strftime(ts, '%b %d %H:%M:%S.%g') AS value
FROM events""")
def encode_date_formats(spark: SparkSession, d: str) -> DataFrame:
    df = _encode_frame(_table(spark, d, "events"))
    a = to_cef_lines(df.select(*S.HEADER_FIELDS, "eventId", F.col("rt").alias("a")),
                     dateFormat="MMM dd yyyy HH:mm:ss")
    b = to_cef_lines(df.select("eventId", F.col("rt").alias("b"), *S.HEADER_FIELDS),
                     dateFormat="MMM dd HH:mm:ss.SSS")
    return a.unionAll(b)  # two encodings of every row, no join


@query("encode_text_escapes", r"""
SELECT 'CEF:0|Acme|Chat|1.0|' || role || '|' || role || ' \| turn\|' || CAST(turn AS VARCHAR)
  || '|' || CAST(conv_id % 10 AS VARCHAR) || '|cn1=' || CAST(conv_id AS VARCHAR) || ' msg='
  || regexp_replace(replace(replace(replace(text || ' k=v|p\q\=r', '\=', '='), '\', '\\'), '=', '\='),
                    '\r\n|\r|\n', '\\n', 'g') AS value
FROM conversations""")
def encode_text_escapes(spark: SparkSession, d: str) -> DataFrame:
    cv = _table(spark, d, "conversations")
    df = cv.select(
        F.lit("CEF:0").alias("CEFVersion"), F.lit("Acme").alias("DeviceVendor"),
        F.lit("Chat").alias("DeviceProduct"), F.lit("1.0").alias("DeviceVersion"),
        F.col("role").alias("SignatureID"),
        F.concat(F.col("role"), F.lit(r" \| turn|"), _s("turn")).alias("Name"),
        _s(F.col("conv_id") % 10).alias("Severity"), F.col("conv_id").alias("cn1"),
        F.concat(F.col("text"), F.lit(r" k=v|p\q\=r")).alias("msg"))
    return to_cef_lines(df)


@query("roundtrip_events", f"""
SELECT event_id AS eventId, {_MS_SQL} AS rt_ms, CAST(user_id AS VARCHAR) AS suser, value AS slat,
       'k=' || props AS msg, event_type AS SignatureID, 'Sensor|Pro' AS DeviceProduct
FROM events""")
def roundtrip_events(spark: SparkSession, d: str) -> DataFrame:
    lines = to_cef_lines(_encode_frame(_table(spark, d, "events")))
    parsed = parse_cef(lines, BASE_SCHEMA, unescape=True)
    return parsed.select("eventId", _ms("rt").alias("rt_ms"), "suser", "slat", "msg",
                         "SignatureID", "DeviceProduct")


# ---------------------------------------------------------------- files, SQL, streams

def _write_events(spark: SparkSession, d: str, path: str, **kw) -> None:
    write_cef(_encode_frame(_table(spark, d, "events"), product="Sensor"), path, mode="overwrite", **kw)


_FILE_SQL = f"""
SELECT event_id AS eventId, event_type AS SignatureID, {_MS_SQL} AS rt_ms,
       CAST(user_id AS VARCHAR) AS suser, value AS slat FROM events"""


@query("file_roundtrip_gzip", _FILE_SQL)
def file_roundtrip_gzip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    _write_events(spark, d, path, compression="gzip")
    df = read_cef(spark, path)  # schema inferred from all lines
    return df.select("eventId", "SignatureID", _ms("rt").alias("rt_ms"), "suser", "slat")


@query("multi_path_read", _FILE_SQL)
def multi_path_read(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    ev = _encode_frame(_table(spark, d, "events"), product="Sensor")
    write_cef(ev.filter(F.col("eventId") % 2 == 0), base + "/even", compression="bzip2")
    write_cef(ev.filter(F.col("eventId") % 2 == 1), base + "/odd")
    df = read_cef(spark, base + "/even", base + "/odd")
    return df.select("eventId", "SignatureID", _ms("rt").alias("rt_ms"), "suser", "slat")


@query("glob_read", _FILE_SQL)
def glob_read(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    ev = _encode_frame(_table(spark, d, "events"), product="Sensor")
    write_cef(ev.filter(F.col("eventId") % 2 == 0), base + "/part a")
    write_cef(ev.filter(F.col("eventId") % 2 == 1), base + "/part b")
    df = read_cef(spark, base + "/part */*.txt")
    return df.select("eventId", "SignatureID", _ms("rt").alias("rt_ms"), "suser", "slat")


@query("partitioned_read", """
SELECT event_id AS eventId, event_type AS SignatureID, CAST(user_id AS VARCHAR) AS suser,
       event_type AS etype FROM events WHERE event_type IN ('error', 'purchase')""")
def partitioned_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    df = _encode_frame(_table(spark, d, "events"), product="Sensor").withColumn(
        "etype", F.col("SignatureID"))
    write_cef(df, path, mode="overwrite", partition_by="etype")
    parsed = read_cef(spark, path)
    return parsed.filter(F.col("etype").isin("error", "purchase")).select(
        "eventId", "SignatureID", "suser", "etype")


@query("sql_view", """
SELECT event_type AS SignatureID, count(*) AS n, max(event_id) AS max_id
FROM events GROUP BY event_type""")
def sql_view(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    _write_events(spark, d, path)
    view = "cef_events_" + uuid.uuid4().hex[:8]
    register_cef_view(spark, view, path)
    return spark.sql(f"SELECT SignatureID, count(*) AS n, max(eventId) AS max_id "
                     f"FROM {view} GROUP BY SignatureID")


@query("stream_parse", _FILE_SQL)
def stream_parse(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    _write_events(spark, d, base + "/in")
    sch = _schema(("eventId", T.LongType()), ("rt", T.TimestampType()), ("suser", T.StringType()),
                  ("slat", T.DoubleType()))
    stream = read_cef_stream(spark, base + "/in", schema=sch, maxFilesPerTrigger=2)
    q = (stream.writeStream.format("parquet").option("path", base + "/out")
         .option("checkpointLocation", base + "/chk").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.schema(T.StructType(sch.fields)).parquet(base + "/out")
    return out.select("eventId", "SignatureID", _ms("rt").alias("rt_ms"), "suser", "slat")


# ---------------------------------------------------------------- filters on parsed columns

@query("filter_extension", """
SELECT event_id AS eventId, CAST(user_id AS VARCHAR) AS suser, value AS slat FROM events
WHERE event_id > 500 AND event_type = 'click' AND value > 10""")
def filter_extension(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse_cef(_lines(_table(spark, d, "events")).select("value"), BASE_SCHEMA)
    return parsed.filter("eventId > 500 and SignatureID = 'click' and slat > 10").select("eventId", "suser", "slat")


@query("filter_timestamp", f"""
SELECT event_id AS eventId, {_MS_SQL} AS rt_ms FROM events
WHERE {_MS_SQL} > (SELECT (min({_MS_SQL}) + max({_MS_SQL})) // 2 FROM events)""")
def filter_timestamp(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    ms = _millis(F.col("ts"))
    half = ev.agg(F.floor((F.min(ms) + F.max(ms)) / 2).alias("at")).first()["at"]
    parsed = parse_cef(_lines(ev).select("value"), BASE_SCHEMA)
    return parsed.filter(F.col("rt") > F.timestamp_millis(F.lit(half))).select("eventId", _ms("rt").alias("rt_ms"))


@query("filter_pivot", """
SELECT event_id AS eventId, event_type AS Kind FROM events
WHERE event_type = 'view' AND event_id > 100 AND value <= 50""")
def filter_pivot(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(_table(spark, d, "events"), F.concat(F.lit("cs1="), F.col("event_type"), F.lit(" cs1Label=Kind")))
    sch = infer_cef_schema(lines, order=F.col("event_id"), pivotFields=True)
    out = parse_cef(lines.select("value"), sch, pivotFields=True)
    return out.filter("Kind = 'view' and eventId > 100 and slat <= 50 and rt > timestamp'1970-01-02'").select("eventId", "Kind")


@query("sql_view_where", """
SELECT event_id AS eventId, CAST(user_id AS VARCHAR) AS suser FROM events
WHERE event_type <> 'error' AND event_id % 3 = 0 AND user_id > 10""")
def sql_view_where(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    _write_events(spark, d, path)
    view = "cef_where_" + uuid.uuid4().hex[:8]
    register_cef_view(spark, view, path)
    return spark.sql(f"SELECT eventId, suser FROM {view} WHERE SignatureID <> 'error' AND eventId % 3 = 0 "
                     "AND CAST(suser AS BIGINT) > 10")


@query("partitioned_read_drop", """
SELECT event_id AS eventId, event_type AS etype FROM events WHERE event_type = 'click' AND event_id % 9 >= 7""")
def partitioned_read_drop(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    ev = _table(spark, d, "events")
    lines = _truncated(ev).join(ev.select("event_id", F.col("event_type").alias("etype")), "event_id").drop("event_id")
    lines.write.partitionBy("etype").text(path)
    return read_cef(spark, path, mode="dropmalformed").filter("etype = 'click'").select("eventId", "etype")


@query("partition_clash", """
SELECT event_id AS eventId, 'P' || CAST(event_id % 4 AS VARCHAR) AS src FROM events WHERE event_id % 4 = 1""")
def partition_clash(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    ev = _table(spark, d, "events")
    lines = ev.select(F.concat(_header_text(), F.lit("eventId="), _s("event_id"), F.lit(" src=line")).alias("value"),
                      F.concat(F.lit("P"), _s(F.col("event_id") % 4)).alias("src"))
    lines.write.partitionBy("src").text(path)
    return read_cef(spark, path).filter("src = 'P1'").select("eventId", "src")


# ---------------------------------------------------------------- operators without a query so far

@query("header_function", """
SELECT event_id, 'CEF:0' AS CEFVersion, 'Acme' AS DeviceVendor, 'Sensor' AS DeviceProduct, '1.0' AS DeviceVersion,
  event_type AS SignatureID, 'User ' || event_type AS Name, CAST(event_id % 10 AS VARCHAR) AS Severity FROM events""")
def header_function(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(_table(spark, d, "events"))
    return lines.select("event_id", cef_header(F.col("value")).alias("h")).select("event_id", "h.*")


@query("blank_lines", """
SELECT CASE WHEN event_id % 4 = 0 THEN '' ELSE 'CEF:0' END AS CEFVersion,
  CASE WHEN event_id % 4 > 0 THEN 'Acme' END AS DeviceVendor, CASE WHEN event_id % 4 > 0 THEN event_id END AS eventId,
  CASE WHEN event_id % 4 = 0 THEN '' END AS broken FROM events""")
def blank_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(_table(spark, d, "events")).select(
        F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.col("value")).alias("value"))
    sch = T.StructType(BASE_SCHEMA.fields + [T.StructField("broken", T.StringType())])
    return parse_cef(lines, sch, corruptRecordColumnName="broken").select("CEFVersion", "DeviceVendor", "eventId", "broken")


@query("infer_late_key", """
SELECT pos, name, type FROM (VALUES (7, 'eventId', 'bigint'), (8, 'late', 'string')) AS t(pos, name, type)
WHERE name = 'eventId' OR EXISTS (SELECT 1 FROM events)""")
def infer_late_key(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    last = ev.agg(F.max("event_id")).first()[0]
    lines = ev.select("event_id", F.concat(_header_text(), F.lit("eventId="), _s("event_id"),
                                           F.when(F.col("event_id") == last, F.lit(" late=x")).otherwise(F.lit(""))).alias("value"))
    return _schema_rows(spark, infer_cef_schema(lines, order=F.col("event_id"))).filter("pos >= 7")


@query("infer_defensive", """
SELECT pos, name, type FROM (VALUES (7, 'eventId', 'bigint'), (8, 'door', 'string'), (9, 'cn1', 'bigint'),
  (10, 'zone', 'string')) AS t(pos, name, type) WHERE EXISTS (SELECT 1 FROM events)""")
def infer_defensive(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    lines = ev.select("event_id", F.concat(_header_text(), F.lit("eventId="), _s("event_id"), F.lit(" door= cn1="),
                                           _s("user_id"), F.lit(" zone=")).alias("value"))
    return _schema_rows(spark, infer_cef_schema(lines, order=F.col("event_id"), defensiveMode=True)).filter("pos >= 7")


_ALL_FORMATS = (("MMM dd yyyy HH:mm:ss", "%b %d %Y %H:%M:%S"), ("MMM dd yyyy HH:mm:ss.SSS zzz", "%b %d %Y %H:%M:%S.%g UTC"),
                ("MMM dd yyyy HH:mm:ss.SSS", "%b %d %Y %H:%M:%S.%g"), ("MMM dd yyyy HH:mm:ss zzz", "%b %d %Y %H:%M:%S UTC"),
                ("MMM dd HH:mm:ss", "%b %d %H:%M:%S"), ("MMM dd HH:mm:ss.SSS zzz", "%b %d %H:%M:%S.%g UTC"),
                ("MMM dd HH:mm:ss.SSS", "%b %d %H:%M:%S.%g"), ("MMM dd HH:mm:ss zzz", "%b %d %H:%M:%S UTC"))


@query("encode_all_date_formats", "\nUNION ALL ".join(
    f"SELECT 'CEF:0|a|b|1|{i}|n|1|rt=' || strftime(ts, '{duck}') AS value FROM events WHERE event_id % 8 = {i}"
    for i, (_, duck) in enumerate(_ALL_FORMATS)))
def encode_all_date_formats(spark: SparkSession, d: str) -> DataFrame:
    ev = _table(spark, d, "events")
    out = None
    for i, (fmt, _) in enumerate(_ALL_FORMATS):
        heads = [F.lit(x).alias(h) for h, x in zip(S.HEADER_FIELDS, ("CEF:0", "a", "b", "1", str(i), "n", "1"))]
        one = to_cef_lines(ev.filter(F.col("event_id") % 8 == i).select(*heads, F.col("ts").cast("timestamp").alias("rt")), dateFormat=fmt)
        out = one if out is None else out.unionAll(one)
    return out


_TAIL = r" C:\new a\b = c|d"


@query("roundtrip_text", r"""
SELECT conv_id AS cn1, turn AS cn2, '[' || regexp_replace(replace(text, '\=', '='), '\r\n|\r', chr(10), 'g') || ' C:\new a\b = c|d' || chr(10) || ']' AS msg,
  role || ' \x | y' AS Name FROM conversations
UNION ALL SELECT page_id, -1, '[' || url || ' C:\new a\b = c|d' || chr(10) || ']', 'page \x | y' FROM pages""")
def roundtrip_text(spark: SparkSession, d: str) -> DataFrame:
    """Encoding and decoding with unescape give the text back: backslashes, newlines, = and pipes."""
    conv = _table(spark, d, "conversations").select("conv_id", "turn", "role", F.replace("text", F.lit(r"\="), F.lit("=")).alias("text"))
    page = _table(spark, d, "pages").select("page_id", F.lit(-1).cast("long"), F.lit("page"), "url")
    rows = conv.unionAll(page)
    frame = rows.select(
        F.lit("CEF:0").alias("CEFVersion"), F.lit("A|B").alias("DeviceVendor"), F.lit("C\\").alias("DeviceProduct"),
        F.lit("1").alias("DeviceVersion"), F.lit("s").alias("SignatureID"), F.concat("role", F.lit(r" \x | y")).alias("Name"),
        F.lit("1").alias("Severity"), F.col("conv_id").alias("cn1"), F.col("turn").alias("cn2"),
        F.concat(F.lit("["), F.col("text"), F.lit(_TAIL), F.lit("\n]")).alias("msg"))
    sch = _schema(("cn1", T.LongType()), ("cn2", T.LongType()), ("msg", T.StringType()))
    return parse_cef(to_cef_lines(frame), sch, unescape=True).select("cn1", "cn2", "msg", "Name")


@query("append_and_line_separator", """
SELECT event_id AS eventId, event_type AS SignatureID FROM events""")
def append_and_line_separator(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    ev = _encode_frame(_table(spark, d, "events"), product="Sensor")
    write_cef(ev.filter("eventId % 2 = 0"), path, lineSep="\r\n")
    write_cef(ev.filter("eventId % 2 = 1"), path, mode="append", lineSep="\r\n")
    write_cef(ev, path, mode="ignore", lineSep="\r\n")
    return read_cef(spark, path, lineSep="\r\n").select("eventId", "SignatureID")


@query("stream_write", _FILE_SQL)
def stream_write(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    ev = _encode_frame(_table(spark, d, "events"), product="Sensor")
    write_cef(ev.filter("eventId % 2 = 0"), base + "/a")
    write_cef(ev.filter("eventId % 2 = 1"), base + "/b")
    stream = read_cef_stream(spark, base + "/a", base + "/b", schema=BASE_SCHEMA)
    write_cef_stream(stream, base + "/out", base + "/chk").trigger(availableNow=True).start().awaitTermination()
    return read_cef(spark, base + "/out", schema=BASE_SCHEMA).select(
        "eventId", "SignatureID", _ms("rt").alias("rt_ms"), "suser", "slat")

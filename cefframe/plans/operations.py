"""Queries over the operations around a parse: one-pass quarantine, counts of bad lines, key
summaries, growing streams, SQL functions, many small files, rebalanced output, error messages.

They extend the catalogue; see :mod:`cefframe.plans.catalogue` for its rules.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.sql import register_cef_functions
from ..operators.encode import to_cef_lines
from ..operators.infer import infer_cef_schema
from ..operators.parse import parse_cef
from ..sources.files import read_cef, write_cef
from ..sources.quarantine import quarantine_cef, read_split, split_stream, write_split
from ..sources.summary import key_summary, promote_rest, update_key_summary
from ..streaming.stream import read_cef_stream
from .catalogue import (_MS_SQL, _REASON_SQL, BASE_EXT, BASE_SCHEMA, _base_ext, _encode_frame, _header_text, _infer_lines,
                        _infer_sql, _lines, _millis, _ms, _s, _schema, _schema_rows, _table, _truncated, query, scratch_dir)

# ---------------------------------------------------------------- quarantine in one pass


@query("quarantine_pass_good", f"""
SELECT event_id AS eventId, event_type AS SignatureID, {_MS_SQL} AS rt_ms, CAST(user_id AS VARCHAR) AS suser
FROM events WHERE event_id % 9 >= 7""")
def quarantine_pass_good(spark: SparkSession, d: str) -> DataFrame:
    lines = _truncated(_table(spark, d, "events")).select("value")
    good, _ = write_split(lines, BASE_SCHEMA, scratch_dir(spark))
    return good.select("eventId", "SignatureID", _ms("rt").alias("rt_ms"), "suser")


@query("quarantine_pass_bad", f"""
SELECT event_id, {_REASON_SQL} AS reason, array_to_string(list_slice(['CEF:0', 'Acme', 'Sensor', '1.0', event_type,
  'User ' || event_type, CAST(event_id % 10 AS VARCHAR)], 1, CAST(event_id % 9 + 1 AS INTEGER)), '|') AS line
FROM events WHERE event_id % 9 < 7""")
def quarantine_pass_bad(spark: SparkSession, d: str) -> DataFrame:
    _, bad = write_split(_truncated(_table(spark, d, "events")), BASE_SCHEMA, scratch_dir(spark))
    return bad.select("event_id", F.col("_cef_error").alias("reason"), F.col("_cef_raw").alias("line"))


def _amounts(ev: DataFrame) -> DataFrame:
    """Even events name a number column by a label, of the odd ones every third a text column."""
    pair = (F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" cn1="), _s("user_id"), F.lit(" cn1Label=Amount")))
            .when(F.col("event_id") % 3 == 0, F.concat(F.lit(" cs4=t"), _s("event_id"), F.lit(" cs4Label=Amount")))
            .otherwise(F.lit("")))
    return ev.select(F.concat(_header_text(), F.lit("eventId="), _s("event_id"), pair).alias("value"))


_AMOUNT = (("eventId", T.LongType()), ("Amount", T.LongType()))


@query("quarantine_pass_pivot", """
SELECT 'good' AS side, event_id AS eventId, CASE WHEN event_id % 2 = 0 THEN user_id END AS Amount, NULL AS reason
FROM events WHERE event_id % 2 = 0 OR event_id % 3 <> 0
UNION ALL
SELECT 'bad', event_id, NULL, 'An error occurred parsing the record.' FROM events WHERE event_id % 2 = 1 AND event_id % 3 = 0""")
def quarantine_pass_pivot(spark: SparkSession, d: str) -> DataFrame:
    good, bad = write_split(_amounts(_table(spark, d, "events")), _schema(*_AMOUNT), scratch_dir(spark), pivotFields=True)
    return good.select(F.lit("good").alias("side"), "eventId", "Amount", F.lit(None).cast("string").alias("reason")).unionAll(
        bad.select(F.lit("bad"), "eventId", "Amount", "_cef_error"))


@query("quarantine_files", """
SELECT CAST(event_id % 3 AS INTEGER) AS part, count(*) FILTER (event_id % 9 >= 7) AS good,
  count(*) FILTER (event_id % 9 < 7) AS bad, count(*) FILTER (event_id % 9 < 7) AS bad_with_own_file
FROM events GROUP BY 1""")
def quarantine_files(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    ev = _table(spark, d, "events")
    (_truncated(ev).select((F.col("event_id") % 3).cast("int").alias("part"), "value")
     .write.partitionBy("part").text(base + "/in"))
    good, bad = quarantine_cef(spark, base + "/in", out=base + "/out", schema=BASE_SCHEMA)
    own = F.col("_cef_file").contains(F.concat(F.lit("part="), F.col("part").cast("string"), F.lit("/")))
    sides = good.select("part", F.lit(1).alias("g"), F.lit(0).alias("b"), F.lit(0).alias("o")).unionAll(
        bad.select("part", F.lit(0), F.lit(1), own.cast("int")))
    return sides.groupBy("part").agg(F.sum("g").alias("good"), F.sum("b").alias("bad"), F.sum("o").alias("bad_with_own_file"))


@query("quarantine_stream", f"""
SELECT CASE WHEN event_id % 9 < 7 THEN {_REASON_SQL} ELSE 'good' END AS reason, count(*) AS n FROM events GROUP BY 1""")
def quarantine_stream(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    _truncated(_table(spark, d, "events")).select("value").repartition(3).write.text(base + "/in")
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).text(base + "/in")
    split_stream(stream, BASE_SCHEMA, base + "/out", base + "/chk").trigger(availableNow=True).start().awaitTermination()
    good, bad = read_split(spark, base + "/out")
    return (good.select(F.lit("good").alias("reason")).unionAll(bad.select("_cef_error"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


@query("counts_of_one_pass", f"""
SELECT 'lines' AS what, count(*) AS n FROM events
UNION ALL SELECT 'malformed', count(*) FROM events WHERE event_id % 9 < 7
UNION ALL SELECT {_REASON_SQL}, count(*) FROM events WHERE event_id % 9 < 7 GROUP BY 1
UNION ALL SELECT 'rows written', count(*) FROM events WHERE event_id % 9 >= 7""")
def counts_of_one_pass(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    seen = Observation()
    lines = _truncated(_table(spark, d, "events")).select("value")
    parse_cef(lines, BASE_SCHEMA, mode="dropmalformed", counts=seen).select("eventId").write.parquet(path)
    counted = spark.createDataFrame([(k, v) for k, v in seen.get.items() if v], "what string, n long")
    return counted.unionAll(spark.read.schema("eventId long").parquet(path).select(F.lit("rows written"), F.count(F.lit(1))))


# ---------------------------------------------------------------- many files, files over time

def _in_order(lines: DataFrame, files: int, path: str) -> None:
    """Lines in order of event_id, in files whose names have the same order."""
    lines.repartitionByRange(files, "event_id").sortWithinPartitions("event_id").select("value").write.mode("append").text(path)


@query("infer_first_of_many_files", _infer_sql(
    "WHERE event_id IN (SELECT event_id FROM events ORDER BY event_id LIMIT 37)"))
def infer_first_of_many_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    _in_order(_infer_lines(_table(spark, d, "events")), 200, path)
    return _schema_rows(spark, read_cef(spark, path, maxRecords=37).schema)


@query("infer_over_time", _infer_sql())
def infer_over_time(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    ev = _table(spark, d, "events")
    middle = ev.agg(F.expr("percentile(event_id, 0.5)").cast("long")).first()[0] or 0
    # The later half is seen first; its files come second in path order.
    _in_order(_infer_lines(ev.filter(F.col("event_id") > middle)), 3, base + "/in/day=2")
    update_key_summary(spark, base + "/keys", base + "/in")
    _in_order(_infer_lines(ev.filter(F.col("event_id") <= middle)), 3, base + "/in/day=1")
    return _schema_rows(spark, update_key_summary(spark, base + "/keys", base + "/in"))


@query("keys_over_time", """
SELECT name, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest(['eventId', 'rt', 'suser', 'slat', 'msg', CASE event_type WHEN 'click' THEN 'request' WHEN 'view' THEN 'dpt'
    WHEN 'error' THEN 'reason' WHEN 'purchase' THEN 'cfp2' WHEN 'signup' THEN 'start' ELSE 'other' END]) AS name FROM events)
GROUP BY name""")
def keys_over_time(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    lines = _infer_lines(_table(spark, d, "events"))
    for part in range(3):
        _in_order(lines.filter(F.col("event_id") % 3 == part), 2, base + "/in")
        update_key_summary(spark, base + "/keys", base + "/in")
    return key_summary(spark, base + "/keys").select("name", "n")


@query("stream_new_keys", """
SELECT event_id AS eventId, CAST(user_id AS VARCHAR) AS suser, CASE WHEN event_id % 2 = 1 THEN user_id END AS cnt,
  CASE WHEN event_id % 2 = 1 THEN 'z' || CAST(event_id AS VARCHAR) END AS zone FROM events""")
def stream_new_keys(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark)
    ev = _table(spark, d, "events")
    _lines(ev.filter("event_id % 2 = 0")).select("value").write.mode("append").text(base + "/in")
    first = update_key_summary(spark, base + "/keys", base + "/in")
    later = _lines(ev.filter("event_id % 2 = 1"), F.concat(F.lit("cnt="), _s("user_id"), F.lit(" zone=z"), _s("event_id")))
    later.select("value").write.mode("append").text(base + "/in")
    stream = read_cef_stream(spark, base + "/in", schema=first, rest="_rest", maxFilesPerTrigger=1)
    (stream.writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/chk")
     .trigger(availableNow=True).start().awaitTermination())
    second = update_key_summary(spark, base + "/keys", base + "/in")
    written = spark.read.schema(T.StructType([*first.fields, T.StructField("_rest", T.MapType(T.StringType(), T.StringType()))]))
    return promote_rest(written.parquet(base + "/out"), second).select("eventId", "suser", "cnt", "zone")


@query("rest_of_pairs", """
SELECT event_id AS eventId, CAST(user_id AS VARCHAR) AS suser, props AS msg, CAST(value AS VARCHAR) AS slat FROM events""")
def rest_of_pairs(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse_cef(_lines(_table(spark, d, "events")).select("value"), _schema(*BASE_EXT[:2]), rest="others")
    return parsed.select("eventId", *[F.get(F.map_values(F.map_filter("others", lambda k, _: k == F.lit(c))), 0).alias(c)
                                      for c in ("suser", "msg", "slat")])


@query("rebalanced_partitions", """
SELECT event_type AS etype, count(*) AS n, CAST(1 AS BIGINT) AS files FROM events GROUP BY event_type""")
def rebalanced_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Small partition values written by many tasks: one file each (they are far below the advisory size)."""
    path = scratch_dir(spark)
    frame = _encode_frame(_table(spark, d, "events"), product="Sensor").withColumn("etype", F.col("SignatureID")).repartition(16)
    write_cef(frame, path, partition_by="etype")
    text = spark.read.text(path).select("etype", F.col("_metadata.file_path").alias("f"))
    return text.groupBy("etype").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("f").alias("files"))


# ---------------------------------------------------------------- functions in SQL text

@query("sql_functions", f"""
SELECT event_id, event_type AS SignatureID, {_MS_SQL} AS rt_ms, CAST(user_id AS VARCHAR) AS suser, props AS msg,
  'a\\=' || event_type AS ext, event_type || '\\|' AS head, {_MS_SQL} AS layout_ms
FROM events WHERE user_id > 10""")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    register_cef_functions(spark)
    view = "cef_lines_" + uuid.uuid4().hex[:8]
    ev = _table(spark, d, "events")
    ev.select("event_id", "event_type", F.date_format("ts", "MMM dd yyyy HH:mm:ss.SSS").alias("layout"),
              F.concat(_header_text(), _base_ext()).alias("line")).createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT event_id, cef_header(line).SignatureID AS SignatureID,
          unix_millis(cef_timestamp(cef_extensions(line)['rt'])) AS rt_ms, cef_extensions(line)['suser'] AS suser,
          cef_extensions(line)['msg'] AS msg, cef_escape_extension(concat('a=', event_type)) AS ext,
          cef_escape_header(concat(event_type, '|')) AS head, unix_millis(cef_timestamp(layout)) AS layout_ms
        FROM {view} WHERE CAST(cef_extensions(line)['suser'] AS BIGINT) > 10""")


@query("option_names", _infer_sql("WHERE event_id IN (SELECT event_id FROM events ORDER BY event_id LIMIT 3)"))
def option_names(spark: SparkSession, d: str) -> DataFrame:
    lines = _infer_lines(_table(spark, d, "events"))
    return _schema_rows(spark, infer_cef_schema(lines, order=F.col("event_id"), options={"MAX_records": "3", "PIVOTFIELDS": "False"}))


# ---------------------------------------------------------------- messages

@query("failfast_messages", f"SELECT DISTINCT event_id % 9 AS pieces, {_REASON_SQL} AS reason FROM events WHERE event_id % 9 < 7")
def failfast_messages(spark: SparkSession, d: str) -> DataFrame:
    lines = _truncated(_table(spark, d, "events"))
    found = []
    for k in range(9):
        try:
            parse_cef(lines.filter(F.col("event_id") % 9 == k).select("value"), BASE_SCHEMA, mode="failfast").count()
        except Exception as error:  # the job's own error, whatever its class
            found.append((k, re.search(r"Reason: (.*?)(?: SQLSTATE|$)", str(error), re.M).group(1)))
    return spark.createDataFrame(found, "pieces long, reason string")


_MESSAGES = {
    "I5 corrupt column is a key": "The specified corrupt column name conflicts with a field name in the data set.",
    "I6 no files": "Unable to infer schema for CEF. It must be specified manually.",
    "I8 keys differ in case": "CEF keys 'suser' and 'SUSER' differ only in case",
    "M5 unknown mode": "Unknown mode 'drop'",
    "O7 date format": "Unable to parse date format 'yyyy'",
    "O9 misspelling": "Unable to find option 'maxRecord', did you mean 'maxRecords'",
    "O9 sounds alike": "Unable to find option 'defencivMode', did you mean 'defensiveMode'",
    "W1 header of another type": "Schema must contain required CEF fields",
    "W1 missing header": "Schema must contain required CEF fields",
    "W2 null header": "Mandatory fields cannot contain null values",
    "W3 version": "CEFVersion field must end with the CEF version information, e.g. 'CEF:0'",
}


@query("error_messages", "SELECT what, message FROM (VALUES " + ", ".join(
    "('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in _MESSAGES.items())
    + ") AS t(what, message) WHERE EXISTS (SELECT 1 FROM events)")
def error_messages(spark: SparkSession, d: str) -> DataFrame:
    """Each case fails on the whole table; the row holds the case and its message if that is the one expected."""
    ev = _table(spark, d, "events")
    lines, frame = _infer_lines(ev), _encode_frame(ev)
    twice = ev.select("event_id", F.concat(_header_text(), _base_ext(), F.lit(" SUSER="), _s(_millis(F.col("ts")))).alias("value"))
    cases = {
        "I5 corrupt column is a key": lambda: infer_cef_schema(lines, corruptRecordColumnName="suser"),
        "I6 no files": lambda: _read_nothing(spark, lines),
        "I8 keys differ in case": lambda: infer_cef_schema(twice, order=F.col("event_id")),
        "M5 unknown mode": lambda: parse_cef(lines, BASE_SCHEMA, mode="drop"),
        "O7 date format": lambda: to_cef_lines(frame, dateFormat="yyyy"),
        "O9 misspelling": lambda: infer_cef_schema(lines, maxRecord=3),
        "O9 sounds alike": lambda: parse_cef(lines, BASE_SCHEMA, defencivMode=True),
        "W1 header of another type": lambda: to_cef_lines(frame.withColumn("Severity", F.lit(1))),
        "W1 missing header": lambda: to_cef_lines(frame.drop("DeviceVendor")),
        "W2 null header": lambda: to_cef_lines(frame.withColumn("Name", F.when(F.col("eventId") < 0, F.col("Name")))).collect(),
        "W3 version": lambda: to_cef_lines(frame.withColumn("CEFVersion", F.col("SignatureID"))).collect(),
    }
    found = []
    for what, case in cases.items():
        try:
            case()
        except Exception as error:  # driver or task, whatever its class
            if _MESSAGES[what] in str(error):
                found.append((what, _MESSAGES[what]))
    return spark.createDataFrame(found if ev.limit(1).count() else [], "what string, message string")


def _read_nothing(spark: SparkSession, lines: DataFrame) -> None:
    path = scratch_dir(spark)
    lines.filter("event_id < 0").select("value").limit(0).write.text(path)
    read_cef(spark, path, pathGlobFilter="*.none")

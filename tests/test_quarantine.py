import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cefframe import (REASONS, flag_malformed, parse_cef, promote_rest, quarantine_cef, read_cef, read_split, split_malformed,
                      split_stream, with_parse_error, write_split)
from cefframe.plans.inspect import count_calls, optimized_plan, physical_plan
from cefframe.schema import header_schema
from cefframe.sources.quarantine import WRITERS
from lines import lines_df

S = T.StringType()


def schema(*ext):
    return T.StructType(header_schema() + [T.StructField(n, t) for n, t in ext])


GOOD = [f"CEF:0|V|P|1|s|n|{i % 10}|eventId={i} cs1=a{i} cs1Label=Site cn1={i} cn1Label=Amount" for i in range(40)]
BAD = ["CEF:0", "CEF:0|v", "CEF:0|v|p", "CEF:0|v|p|1", "CEF:0|v|p|1|s", "CEF:0|v|p|1|s|n", "CEF:0|v|p|1|s|n|5", ""]
CLASH = ["CEF:0|V|P|1|s|n|1|eventId=99 cs2=text cs2Label=Amount"]
FIELDS = schema(("eventId", T.LongType()), ("Site", S), ("Amount", T.LongType()))
PLAIN = schema(("eventId", T.LongType()), ("cs1", S))


@pytest.mark.parametrize("pivot", [False, True])
def test_both_sides_from_one_pass(spark, tmp_dir, pivot):
    df = lines_df(spark, GOOD + BAD + CLASH + [None]).withColumn("day", F.lit(3))
    fields = FIELDS if pivot else PLAIN
    before = spark.conf.get(WRITERS)
    good, bad = write_split(df, fields, f"{tmp_dir}/out", pivotFields=pivot)
    assert spark.conf.get(WRITERS) == before
    assert good.columns == [*fields.names, "day"] and bad.columns[:2] == ["_cef_raw", "_cef_error"]
    want = parse_cef(df, fields, mode="dropmalformed", pivotFields=pivot)
    assert sorted(map(str, good.collect())) == sorted(map(str, want.collect()))
    old_good, old_bad = split_malformed(df, fields, pivotFields=pivot)
    assert good.count() == old_good.count() == 40 + (not pivot)
    assert sorted(map(str, bad.select(F.col("_cef_raw").alias("value"), "_cef_error").collect())) == \
        sorted(map(str, old_bad.select("value", "_cef_error").collect()))
    assert [sorted(map(str, x.collect())) for x in read_split(spark, f"{tmp_dir}/out")] == \
        [sorted(map(str, x.collect())) for x in (good, bad)]


@pytest.mark.parametrize("pivot", [False, True])
def test_one_scan_one_regex_and_no_sort(spark, tmp_dir, pivot):
    lines_df(spark, GOOD + BAD).write.text(f"{tmp_dir}/in")
    flagged = flag_malformed(spark.read.text(f"{tmp_dir}/in"), FIELDS if pivot else PLAIN, pivotFields=pivot)
    plan = optimized_plan(flagged)
    assert count_calls(plan, "regexp_extract_all") == 1 and physical_plan(flagged).count("FileScan") == 1
    good, bad = write_split(spark.read.text(f"{tmp_dir}/in"), FIELDS if pivot else PLAIN, f"{tmp_dir}/out", pivotFields=pivot)
    # Each side reads its own directory only.
    for side, flag in ((good, "false"), (bad, "true")):
        assert all(f"_cef_bad={flag}" in f for f in side.inputFiles()) or "PartitionFilters: [isnotnull(_cef_bad" in physical_plan(side)
    assert sorted(d for d in os.listdir(f"{tmp_dir}/out") if d.startswith("_cef")) == ["_cef_bad=false", "_cef_bad=true"]


def test_bad_lines_know_their_file(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for name, lines in (("a b.cef", GOOD[:3] + BAD[:2]), ("c.cef", BAD[2:4])):
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    seen = Observation()
    good, bad = quarantine_cef(spark, f"{tmp_dir}/in", out=f"{tmp_dir}/out", counts=seen)
    assert good.count() == 3 and "eventId" in good.columns
    rows = sorted((r._cef_raw, os.path.basename(r._cef_file), r._cef_offset) for r in bad.collect())
    assert rows == [("CEF:0", "a%20b.cef", 0), ("CEF:0|v", "a%20b.cef", 0), ("CEF:0|v|p", "c.cef", 0), ("CEF:0|v|p|1", "c.cef", 0)]
    assert (seen.get["lines"], seen.get["malformed"]) == (7, 4)
    quarantine_cef(spark, f"{tmp_dir}/in", out=f"{tmp_dir}/out", mode="append")
    assert read_split(spark, f"{tmp_dir}/out")[0].count() == 6


def test_stream_deals_lines_out_once(spark, tmp_dir):
    lines_df(spark, GOOD + BAD).repartition(4).write.text(f"{tmp_dir}/in")
    for _ in range(2):  # the second start finds nothing new
        stream = spark.readStream.option("maxFilesPerTrigger", 1).schema("value string").text(f"{tmp_dir}/in")
        split_stream(stream, PLAIN, f"{tmp_dir}/out", f"{tmp_dir}/chk").trigger(availableNow=True).start().awaitTermination()
    good, bad = read_split(spark, f"{tmp_dir}/out")
    assert sorted(r.eventId for r in good.collect()) == list(range(40))
    assert sorted(r._cef_raw for r in bad.collect()) == sorted(BAD)


def test_counts_of_a_stream_are_in_its_progress(spark, tmp_dir):
    lines_df(spark, GOOD + BAD).repartition(4).write.text(f"{tmp_dir}/in")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).schema("value string").text(f"{tmp_dir}/in")
    query = split_stream(stream, PLAIN, f"{tmp_dir}/out", f"{tmp_dir}/chk", counts="seen").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = [p.observedMetrics["seen"].asDict() for p in query.recentProgress if "seen" in p.observedMetrics]
    assert len(rows) > 1 and sum(r["lines"] for r in rows) == 48 and sum(r["malformed"] for r in rows) == 8
    assert sum(r["Missing name in record"] for r in rows) == 1


@pytest.mark.parametrize("pivot", [False, True])
@pytest.mark.parametrize("mode", ["permissive", "dropmalformed"])
def test_counts_come_with_the_parse(spark, mode, pivot):
    df = lines_df(spark, GOOD + BAD * 3 + CLASH)
    seen = Observation()
    parse_cef(df, FIELDS if pivot else PLAIN, mode=mode, pivotFields=pivot, counts=seen).write.format("noop").mode("overwrite").save()
    reasons = with_parse_error(df).groupBy("_cef_error").count().collect()
    want = {r["_cef_error"]: r["count"] for r in reasons if r["_cef_error"]}
    if pivot:
        want["An error occurred parsing the record."] = 1
    got = dict(seen.get)
    assert got.pop("lines") == 65 and got.pop("malformed") == sum(want.values())
    assert set(got) == set(REASONS) and {k: v for k, v in got.items() if v} == want


def test_counts_of_one_write_agree_with_quarantine(spark, tmp_dir):
    lines_df(spark, GOOD + BAD).write.text(f"{tmp_dir}/in")
    seen = Observation()
    read_cef(spark, f"{tmp_dir}/in", schema=PLAIN, mode="dropmalformed", counts=seen).write.parquet(f"{tmp_dir}/out")
    assert (seen.get["lines"], seen.get["malformed"]) == (48, 8)


def test_rest_keeps_pairs_without_a_column(spark):
    lines = ["CEF:0|V|P|1|s|n|1|eventId=1 door=7 severity=9 door=8 nothing=- cs1=x", "CEF:0|V|P|1|s|n|1|eventId=2 cs1=y", "CEF:0|V"]
    rows = parse_cef(lines_df(spark, lines), PLAIN, rest="_rest").collect()
    assert [r._rest for r in rows] == [{"door": "8", "severity_1": "9", "nothing": None}, None, None]
    with pytest.raises(ValueError, match="already has a column"):
        parse_cef(lines_df(spark, lines), PLAIN, rest="EVENTID")
    lines = ["CEF:0|V|P|1|s|n|1|eventId=1 cs1=a cs1Label=Site cn1=5 cn1Label=Size severity=1 cs3Label=alone cs4=z cs4Label=-"]
    r = parse_cef(lines_df(spark, lines), schema(("eventId", T.LongType()), ("Site", S)), pivotFields=True, rest="_rest").collect()[0]
    assert (r.Site, r._rest) == ("a", {"Size": "5", "severity_1": "1", "cs3Label": "alone", "cs4": "z", "cs4Label": None})
    unescaped = parse_cef(lines_df(spark, ["CEF:0|V|P|1|s|n|1|a=x\\=y b=1"]), schema(("b", S)), unescape=True, rest="m").collect()[0]
    assert unescaped.m == {"a": "x=y"}


def test_rest_is_promoted_to_columns(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|eventId=1 cnt=7 note=n rt=1655789415000", "CEF:0|V|P|1|s|n|1|eventId=2"])
    old = parse_cef(df, schema(("eventId", T.LongType())), rest="_rest")
    newer = schema(("eventId", T.LongType()), ("cnt", T.LongType()), ("rt", T.TimestampType()))
    rows = sorted(promote_rest(old, newer).collect(), key=lambda r: r.eventId)
    assert [(r.cnt, r._rest) for r in rows] == [(7, {"note": "n"}), (None, None)]
    assert rows[0].rt is not None and promote_rest(old, newer).schema["cnt"].dataType == T.LongType()
    again = promote_rest(promote_rest(old, newer), schema(("eventId", T.LongType()), ("note", S)))
    assert [r.note for r in sorted(again.collect(), key=lambda r: r.eventId)] == ["n", None]
    assert "cnt" in again.columns

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cefframe import infer_cef_schema, parse_cef, split_malformed
from cefframe.plans.inspect import count_calls, optimized_plan, physical_plan
from cefframe.schema import header_schema
from lines import lines_df

S = T.StringType()


def schema(*ext):
    return T.StructType(header_schema() + [T.StructField(n, t) for n, t in ext])


def infer(df, **kw):
    return infer_cef_schema(df.withColumn("_o", F.monotonically_increasing_id()), order=F.col("_o"), **kw)


PIVOT_LINES = [f"CEF:0|V|P|1|s|n|1|eventId={i} door={900 + i} doorLabel=Lock State" for i in range(10)]


def test_pivot_off_keeps_pairs(spark):
    df = lines_df(spark, PIVOT_LINES)
    names = [f.name for f in infer(df).fields[7:]]
    assert names == ["eventId", "door", "doorLabel"]


def test_pivot_on(spark):
    df = lines_df(spark, PIVOT_LINES)
    sch = infer(df, pivotFields=True)
    assert [f.name for f in sch.fields[7:]] == ["eventId", "Lock State"]
    out = parse_cef(df, sch, pivotFields=True)
    assert out.filter(F.col("Lock State") == "901").count() == 1


def test_pivot_partial(spark):
    lines = PIVOT_LINES[:6] + ["CEF:0|V|P|1|s|n|1|eventId=6 doorLabel=Lock State",
                               "CEF:0|V|P|1|s|n|1|eventId=7 door=907"]
    df = lines_df(spark, lines)
    sch = infer(df, pivotFields=True)
    assert [f.name for f in sch.fields[7:]] == ["eventId", "Lock State", "doorLabel", "door"]
    rows = {r.eventId: r for r in parse_cef(df, sch, pivotFields=True).collect()}
    assert rows[6].doorLabel == "Lock State" and rows[6]["Lock State"] is None
    assert rows[7].door == "907" and rows[0]["Lock State"] == "900"


def test_pivot_type_follows_source_key(spark):
    lines = ["CEF:0|V|P|1|s|n|1|deviceCustomDate1=1655789415000 deviceCustomDate1Label=Valid From "
             "cfp1=1.5 cfp1Label=Battery",
             "CEF:0|V|P|1|s|n|1|deviceCustomDate1=Jun 21 2022 05:30:15 deviceCustomDate1Label=Valid From",
             "CEF:0|V|P|1|s|n|1|deviceCustomDate1=bad deviceCustomDate1Label=Valid From"]
    df = lines_df(spark, lines)
    sch = infer(df, pivotFields=True)
    types = {f.name: f.dataType for f in sch.fields}
    assert types["Valid From"] == T.TimestampType() and types["Battery"] == T.FloatType()
    got = [r["Valid From"] for r in parse_cef(df, sch, pivotFields=True).collect()]
    assert got[0] == got[1] and got[2] is None


def test_pivot_label_conflicting_with_header(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|7|eventId=1 cfp1=0.75 cfp1Label=severity"])
    sch = infer(df, pivotFields=True)
    assert "severity_1" in sch.fieldNames()
    r = parse_cef(df, sch, pivotFields=True).collect()[0]
    assert (r.Severity, r.severity_1) == ("7", pytest.approx(0.75))


def test_pivot_type_clash_is_malformed(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|eventId=1 cn1=5 cn1Label=Amount",
                          "CEF:0|V|P|1|s|n|1|eventId=2 cs4=text cs4Label=Amount",
                          "CEF:0|V|P|1|s|n|1|eventId=3 cs4=- cs4Label=Amount"])
    sch = infer(df, pivotFields=True, corruptRecordColumnName="_bad")
    rows = parse_cef(df, sch, pivotFields=True, corruptRecordColumnName="_bad").orderBy("eventId").collect()
    assert [r.Amount for r in rows] == [5, None, None]
    assert [r._bad is not None for r in rows] == [False, True, False]  # a null value never clashes
    kept = parse_cef(df, sch, pivotFields=True, mode="dropmalformed")
    assert sorted(r.eventId for r in kept.collect()) == [1, 3]


CORRUPT = ["CEF:0|V|P|1|100|n|5|badge=1 site=a",
           "CEF:0|V|P|1|101|n|5|badge=2 site=b",
           "CEF:0|V|P|1|102|"]


@pytest.mark.parametrize("line,msg", [
    ("CEF:0", "Missing device vendor in record"), ("CEF:0|v", "Missing device product in record"),
    ("CEF:0|v|p", "Missing device version in record"), ("CEF:0|v|p|1", "Missing signature id in record"),
    ("CEF:0|v|p|1|s", "Missing name in record"), ("CEF:0|v|p|1|s|n", "Missing severity in record"),
    ("CEF:0|v|p|1|s|n|5", "Record does not contain the correct number of pipe separated values"),
])
def test_malformed_ladder(spark, line, msg):
    _, bad = split_malformed(lines_df(spark, [line]), schema())
    assert bad.collect()[0]._cef_error == msg


def test_permissive_partial_row(spark):
    sch = schema(("badge", S), ("site", S))
    rows = parse_cef(lines_df(spark, CORRUPT), sch).collect()
    assert len(rows) == 3
    assert rows[2].SignatureID == "102" and rows[2].Name == "" and rows[2].Severity is None
    assert rows[2].badge is None


def test_broken_column(spark):
    df = lines_df(spark, CORRUPT)
    sch = infer(df, corruptRecordColumnName="_broken")
    assert sch.fieldNames()[-1] == "_broken"
    out = parse_cef(df, sch, corruptRecordColumnName="_broken")
    assert [r._broken for r in out.filter("_broken is not null").collect()] == [CORRUPT[2]]


def test_corrupt_column_name_conflict(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|Bad=1"])
    with pytest.raises(ValueError, match="conflicts with a field name"):
        infer(df, corruptRecordColumnName="bad")


def test_dropmalformed_also_under_count(spark):
    sch = schema(("badge", S))
    assert parse_cef(lines_df(spark, CORRUPT), sch, mode="dropmalformed").count() == 2


def test_failfast(spark):
    sch = schema(("badge", S))
    with pytest.raises(Exception, match="Missing"):
        parse_cef(lines_df(spark, CORRUPT), sch, mode="failfast").select("SignatureID").count()
    assert parse_cef(lines_df(spark, CORRUPT[:2]), sch, mode="failfast").count() == 2


def test_quarantine_split(spark):
    good, bad = split_malformed(lines_df(spark, CORRUPT), schema(("badge", S)))
    assert good.count() == 2 and bad.count() == 1


@pytest.mark.parametrize("pivot", [False, True])
@pytest.mark.parametrize("mode", ["permissive", "dropmalformed", "failfast"])
def test_filters_on_parsed_columns_do_not_copy_the_parse(spark, mode, pivot):
    df = lines_df(spark, PIVOT_LINES)
    sch = schema(("eventId", T.LongType()), ("rt", T.TimestampType()), ("Lock State", S))
    out = parse_cef(df, sch, mode=mode, pivotFields=pivot)
    for cond in ("eventId > 5", "rt > timestamp'2020-01-01'", "`Lock State` = '905' and eventId > 1 and rt is null"):
        plan = optimized_plan(out.filter(cond))
        assert count_calls(plan, "regexp_extract_all") == 1
        assert count_calls(plan, "split") <= 8  # fast path and look-behind pattern, once for the mode's Filter
    assert "regexp_extract_all" not in optimized_plan(out.select("Name")) or pivot and mode != "permissive"
    if mode != "failfast":
        assert out.filter("`Lock State` = '905'").count() == int(pivot)


@pytest.mark.parametrize("pivot", [False, True])
@pytest.mark.parametrize("mode", ["permissive", "dropmalformed", "failfast"])
def test_partitions_are_pruned_in_every_mode(spark, tmp_dir, mode, pivot):
    path = f"{tmp_dir}/p"
    spark.createDataFrame([(x, f"d{i % 3}") for i, x in enumerate(PIVOT_LINES)], "value string, day string") \
        .write.partitionBy("day").text(path)
    out = parse_cef(spark.read.text(path), schema(("eventId", T.LongType()), ("Lock State", S)), mode=mode, pivotFields=pivot)
    picked = out.filter("day = 'd1' and eventId > 1 and SignatureID = 's'")
    plan = physical_plan(picked)
    assert "PartitionFilters: [isnotnull(day" in plan and "(day" in plan.split("PartitionFilters:")[1]
    assert sorted(r.eventId for r in picked.collect()) == [4, 7]

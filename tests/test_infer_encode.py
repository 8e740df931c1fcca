import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cefframe import infer_cef_schema, to_cef_lines
from cefframe.schema import HEADER_FIELDS, header_schema
from lines import lines_df


def infer(df, **kw):
    return infer_cef_schema(df.withColumn("_o", F.monotonically_increasing_id()), order=F.col("_o"), **kw)


def test_first_seen_order_and_types(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|rt=1 src=a cn1=2",
                          "CEF:0|V|P|1|s|n|1|src=b dpt=80 zone=x",
                          "CEF:0|V|P|1|s|n|1|badge=1"])
    sch = infer(df)
    assert sch.fieldNames() == list(HEADER_FIELDS) + ["rt", "src", "cn1", "dpt", "zone", "badge"]
    t = {f.name: f.dataType for f in sch.fields}
    assert t["rt"] == T.TimestampType() and t["cn1"] == T.LongType() and t["dpt"] == T.IntegerType()
    assert infer(df, maxRecords=1).fieldNames()[7:] == ["rt", "src", "cn1"]


def test_case_variant_keys_rejected(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|src=a SRC=b"])
    with pytest.raises(ValueError, match="differ only in case"):
        infer(df)


def test_header_text_does_not_create_columns(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|a=b|1|src=x"])
    assert infer(df).fieldNames()[7:] == ["src"]


HEAD = {h: v for h, v in zip(HEADER_FIELDS, ["CEF:0", "Northwind", "Gatekeeper", "7.2", "AUTH-11", "Door opened", "4"])}
TS = dt.datetime(2023, 3, 9, 4, 5, 6, 78000)


def frame(spark, **ext):
    fields = header_schema() + [T.StructField(k, t) for k, (t, _) in ext.items()]
    row = list(HEAD.values()) + [v for _, v in ext.values()]
    return spark.createDataFrame([row], T.StructType(fields))


@pytest.mark.parametrize("fmt,expected", [
    (None, "Mar 09 2023 04:05:06.078 UTC"), ("MMM dd yyyy HH:mm:ss", "Mar 09 2023 04:05:06"),
    ("MMM dd yyyy HH:mm:ss.SSS", "Mar 09 2023 04:05:06.078"), ("MMM dd yyyy HH:mm:ss zzz", "Mar 09 2023 04:05:06 UTC"),
    ("MMM dd HH:mm:ss", "Mar 09 04:05:06"), ("MMM dd HH:mm:ss.SSS", "Mar 09 04:05:06.078"),
    ("MMM dd HH:mm:ss zzz", "Mar 09 04:05:06 UTC"), ("MMM dd HH:mm:ss.SSS zzz", "Mar 09 04:05:06.078 UTC"),
    ("millis", "1678334706078"),
])
def test_date_formats(spark, fmt, expected):
    df = frame(spark, cs1=(T.TimestampType(), TS))
    opts = {} if fmt is None else {"dateFormat": fmt}
    assert to_cef_lines(df, **opts).collect()[0].value == f"CEF:0|Northwind|Gatekeeper|7.2|AUTH-11|Door opened|4|cs1={expected}"


def test_epoch_micros_reproduces_reference_output(spark):
    df = frame(spark, rt=(T.TimestampType(), dt.datetime(2021, 11, 30, 23, 59, 1)))
    assert to_cef_lines(df, dateFormat="millis", epochUnit="micros").collect()[0].value.endswith("rt=1638316741000000")


def test_number_formatting(spark):
    df = frame(spark, rt=(T.TimestampType(), TS), cs1=(T.IntegerType(), -42), cs2=(T.LongType(), 9007199254740993),
               cs3=(T.FloatType(), 0.5), cs4=(T.DoubleType(), 2.0625))
    assert to_cef_lines(df).collect()[0].value == (
        "CEF:0|Northwind|Gatekeeper|7.2|AUTH-11|Door opened|4|rt=Mar 09 2023 04:05:06.078 UTC cs1=-42 cs2=9007199254740993 cs3=0.5 cs4=2.0625")


def test_escaping(spark):
    df = frame(spark, cs1=(T.StringType(), "a=b \\= c\\d|e\r\nf\rg\nh"))
    df = df.withColumn("Name", F.lit("x\\|y|z\\w\nq=1"))
    v = to_cef_lines(df).collect()[0].value
    assert v == r"CEF:0|Northwind|Gatekeeper|7.2|AUTH-11|x\|y\|z\\w q=1|4|cs1=a\=b \= c\\d|e\nf\ng\nh"


def test_nulls_unsupported_order_and_empty(spark):
    df = frame(spark, cs1=(T.StringType(), None), flag=(T.BooleanType(), True))
    assert to_cef_lines(df, nullValue="NA").collect()[0].value.endswith("|4|cs1=NA flag=NA")
    reordered = frame(spark).select(*reversed([F.col(h).alias(h.lower()) for h in HEADER_FIELDS]))
    assert to_cef_lines(reordered).collect()[0].value == "CEF:0|Northwind|Gatekeeper|7.2|AUTH-11|Door opened|4|"


def test_schema_validation(spark):
    with pytest.raises(ValueError, match="Schema must contain required CEF fields"):
        to_cef_lines(frame(spark).drop("CEFVersion"))
    with pytest.raises(ValueError, match="Schema must contain required CEF fields"):
        to_cef_lines(frame(spark).withColumn("Severity", F.lit(1)))


def test_null_header_and_bad_version_fail(spark):
    with pytest.raises(Exception, match="Mandatory fields cannot contain null values"):
        to_cef_lines(frame(spark).withColumn("Name", F.lit(None).cast("string"))).collect()
    with pytest.raises(Exception, match="CEFVersion field must end with"):
        to_cef_lines(frame(spark).withColumn("CEFVersion", F.lit("CEF:1"))).collect()
    ok = to_cef_lines(frame(spark).withColumn("CEFVersion", F.lit("Jan 1 host cef:0"))).collect()
    assert ok[0].value.startswith("Jan 1 host cef:0|")


def test_all_lines_count_by_default(spark):
    lines = [f"CEF:0|V|P|1|s|n|1|cn1={i}" for i in range(12_000)] + ["CEF:0|V|P|1|s|n|1|late=1"]
    df = spark.createDataFrame(list(enumerate(lines)), "o long, value string").repartition(5)
    plan_free = infer_cef_schema(df, order=F.col("o"))
    assert plan_free.fieldNames()[7:] == ["cn1", "late"]
    assert infer_cef_schema(df, order=F.col("o"), maxRecords=12_000).fieldNames()[7:] == ["cn1"]


def test_inference_without_order_is_alphabetical_and_max_records_needs_one(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|zone=1 badge=2", "CEF:0|V|P|1|s|n|1|act=1"])
    assert infer_cef_schema(df).fieldNames()[7:] == ["act", "badge", "zone"]
    with pytest.raises(ValueError, match="maxRecords needs an order"):
        infer_cef_schema(df, maxRecords=1)


def test_inference_repairs_lines_first(spark):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|door= badge=7 zone="])
    assert infer(df).fieldNames()[7:] == ["door", "zone"]  # without repairs the pair runs on to the next key
    assert infer(df, defensiveMode=True).fieldNames()[7:] == ["door", "badge", "zone"]


def test_pivot_inference_takes_seconds_on_many_wide_lines(spark):
    import time
    ext = " ".join(f"cs{i}=v{i} cs{i}Label=Name {i}" for i in range(1, 11))
    df = spark.range(3000).select(F.col("id").alias("o"), F.concat(F.lit("CEF:0|V|P|1|s|n|1|cn1="), F.col("id").cast("string"), F.lit(" " + ext)).alias("value"))
    started = time.monotonic()
    assert infer_cef_schema(df, order=F.col("o"), pivotFields=True).fieldNames()[7:] == ["cn1", *[f"Name {i}" for i in range(1, 11)]]
    assert time.monotonic() - started < 60


def test_inference_logs_its_time(spark, caplog):
    with caplog.at_level("INFO", logger="cefframe"):
        infer(lines_df(spark, ["CEF:0|V|P|1|s|n|1|a=1"]))
    assert "Inferred CEF schema of 8 columns from all lines" in caplog.text


@pytest.mark.parametrize("text", ["C:\\new", "a=b", "=", "x\\", "\\\\=\\n", "one\ntwo", "back\\slash | pipe = x\nnext", "k=v w=z"])
def test_unescape_is_the_inverse_of_the_writer(spark, text):
    if "\\=" in text:
        text = text.replace("\\=", "\\ =")  # the writer drops the backslash of a ready-made escape
    from cefframe import parse_cef
    df = frame(spark, msg=(T.StringType(), text), last=(T.StringType(), text))
    df = df.withColumn("Name", F.lit(text.replace("\n", " "))).withColumn("DeviceProduct", F.lit("p\\q"))
    sch = T.StructType(header_schema() + [T.StructField("msg", T.StringType()), T.StructField("last", T.StringType())])
    r = parse_cef(to_cef_lines(df), sch, unescape=True).collect()[0]
    assert (r.msg, r.last, r.Name, r.DeviceProduct) == (text, text, text.replace("\n", " "), "p\\q")


def scans_of(monkeypatch, spark, action):
    """What ``action`` returns, and the plans of the rows it collects, each up to its first shuffle."""
    from cefframe.plans.inspect import physical_plan
    kind, plans = type(spark.range(1)), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: (plans.append(physical_plan(df)), collect(df))[1])
    out = action()
    monkeypatch.undo()
    return out, [p.split("== Initial Plan ==")[-1].rpartition("Exchange")[2] for p in plans if "Generate" in p]


@pytest.mark.parametrize("pivot", [False, True])
def test_inference_does_not_sort_the_pairs(spark, monkeypatch, pivot):
    df = lines_df(spark, ["CEF:0|V|P|1|s|n|1|rt=1 cs1=a cs1Label=Zone", "CEF:0|V|P|1|s|n|1|src=b"])
    sch, (scan,) = scans_of(monkeypatch, spark, lambda: infer(df, pivotFields=pivot))
    assert sch.fieldNames()[7:] == (["rt", "Zone", "src"] if pivot else ["rt", "cs1", "cs1Label", "src"])
    assert "HashAggregate" in scan and "Sort" not in scan


def test_smallest_place_and_key_of_lines_with_one_order(spark):
    rows = [(2, "rt=1 act=2"), (1, "zone=1 door=2 zone=3"), (1, "badge=1 zone=2 door=3"), (1, "door=5")]
    df = spark.createDataFrame([(o, "CEF:0|V|P|1|s|n|1|" + x) for o, x in rows], "o long, value string").repartition(4)
    # Of equal orders the smallest place counts, of equal places the name.
    assert infer_cef_schema(df, order=F.col("o")).fieldNames()[7:] == ["badge", "door", "zone", "rt", "act"]
    assert infer_cef_schema(df, order=F.col("o").cast("string")).fieldNames()[7:] == ["badge", "door", "zone", "rt", "act"]
    empty = df.withColumn("o", F.nullif("o", F.lit(1)))
    assert infer_cef_schema(empty.filter("o IS NULL"), order=F.col("o")).fieldNames()[7:] == ["badge", "door", "zone"]

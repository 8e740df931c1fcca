import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cefframe import read_cef, read_cef_stream, register_cef_view, write_cef, write_cef_stream
from cefframe.plans.inspect import physical_plan
from cefframe.schema import header_schema

LINES = [f"CEF:0|Northwind|Gatekeeper|7.2|{i}|Door|5|badge={i} cn1={i * 10} start={1655789415000 + i}" +
         (" zone=x" if i == 1 else "") + (" note=r" if i == 2 else "") for i in range(3)]


def write_lines(path, lines, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        import gzip
        with gzip.open(path, "wt") as f:
            f.write("\n".join(lines) + "\n")
    else:
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")


def test_read_plain_gzip_bzip2_multi_and_glob(spark, tmp_dir):
    write_lines(f"{tmp_dir}/gate.cef", LINES)
    write_lines(f"{tmp_dir}/gate.cef.gz", LINES, gz=True)
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(
        f"{tmp_dir}/bz", compression="bzip2")
    bz = glob.glob(f"{tmp_dir}/bz/*.bz2")[0]
    os.rename(bz, f"{tmp_dir}/gate.cef.bz2")
    plain = read_cef(spark, f"{tmp_dir}/gate.cef")
    assert plain.count() == 3
    assert plain.filter("zone is not null").count() == 1 and plain.filter("note is not null").count() == 1
    assert dict((f.name, f.dataType) for f in plain.schema.fields)["start"] == T.TimestampType()
    assert read_cef(spark, f"{tmp_dir}/gate.cef.gz").count() == 3
    assert read_cef(spark, f"{tmp_dir}/gate.cef.bz2").count() == 3
    assert read_cef(spark, f"{tmp_dir}/gate.cef.gz", f"{tmp_dir}/gate.cef").count() == 6
    assert read_cef(spark, f"{tmp_dir}/gate*").count() == 9
    one = read_cef(spark, f"{tmp_dir}/gate.cef", maxRecords=2)
    assert "zone" in one.columns and "note" not in one.columns


def test_path_with_spaces_and_cached_input(spark, tmp_dir):
    p = f"{tmp_dir}/two words here.cef"
    write_lines(p, LINES)
    spark.read.text(p).cache().count()
    assert read_cef(spark, p).count() == 3


def test_inference_reads_first_lines_in_file_order(spark, tmp_dir):
    lines_a = [f"CEF:0|V|P|1|s|n|1|k{i}=v" for i in range(300)]
    lines_b = [f"CEF:0|V|P|1|s|n|1|z{i}=v" for i in range(300)]
    write_lines(f"{tmp_dir}/d/a.cef", lines_a)
    write_lines(f"{tmp_dir}/d/b.cef", lines_b)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        df = read_cef(spark, f"{tmp_dir}/d", maxRecords=350)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    names = df.columns[7:]
    assert names == [f"k{i}" for i in range(300)] + [f"z{i}" for i in range(50)]


def test_sql_view(spark, tmp_dir):
    write_lines(f"{tmp_dir}/v.cef", LINES)
    register_cef_view(spark, "cef_test_view", f"{tmp_dir}/v.cef")
    assert spark.sql("SELECT count(*) AS n, sum(cn1) AS s FROM cef_test_view").collect()[0] == (3, 30)


def test_writer_output_file(spark, tmp_dir):
    fields = header_schema() + [T.StructField(n, T.StringType()) for n in ("cs1", "cs1Label", "cs2", "cs2Label")] \
        + [T.StructField("rt", T.TimestampType())]
    rows = [["CEF:0", "Northwind", "Gate|keeper", "7.2", "B-2", "Badge read", "6",
             f"door {i}=open", "State", None if i % 4 == 1 else "left | right",
             "Side", dt.datetime(2021, 11, 30, 23, 59, 1)] for i in range(9)]
    df = spark.createDataFrame(rows, T.StructType(fields)).coalesce(1)
    write_cef(df, f"{tmp_dir}/out", mode="overwrite", dateFormat="millis", epochUnit="micros")
    content = open(glob.glob(f"{tmp_dir}/out/*.txt")[0]).read().splitlines()
    assert len(content) == 9
    assert content[1] == (r"CEF:0|Northwind|Gate\|keeper|7.2|B-2|Badge read|6|cs1=door 1\=open "
                          "cs1Label=State cs2=- cs2Label=Side rt=1638316741000000")
    assert r"|6|cs1=door 4\=open cs1Label=State cs2=left | right cs2Label=Side" in content[4]


def test_partitioned_write_and_read(spark, tmp_dir):
    df = spark.createDataFrame([("CEF:0", "V", "P", "1", f"s{i}", "n", "1", i, f"d{i % 2}") for i in range(6)],
                               "CEFVersion string, DeviceVendor string, DeviceProduct string, DeviceVersion string, "
                               "SignatureID string, Name string, Severity string, cn1 bigint, day string")
    write_cef(df, f"{tmp_dir}/part", partition_by="day", compression="gzip")
    back = read_cef(spark, f"{tmp_dir}/part")
    assert "day" in back.columns and "day=" not in back.collect()[0].CEFVersion
    pruned = back.filter(F.col("day") == "d1")
    assert sorted(r.cn1 for r in pruned.collect()) == [1, 3, 5]
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_stream_parse(spark, tmp_dir):
    write_lines(f"{tmp_dir}/in/a.cef", LINES)
    write_lines(f"{tmp_dir}/in/b.cef", ["CEF:0|V|P", "CEF:0|V|P|1|9|n|1|badge=9"])
    stream = read_cef_stream(spark, f"{tmp_dir}/in", mode="dropmalformed")
    q = (stream.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
         .option("checkpointLocation", f"{tmp_dir}/chk").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert sorted(r.badge for r in out.collect()) == ["0", "1", "2", "9"]


def test_max_records_stops_reading_early(spark, tmp_dir):
    write_lines(f"{tmp_dir}/big/a.cef", [f"CEF:0|V|P|1|s|n|1|k{i // 5000}=v pad={'x' * 80}" for i in range(60_000)])
    df = read_cef(spark, f"{tmp_dir}/big", maxRecords=3)
    assert df.columns[7:] == ["k0", "pad"]


def test_file_names_with_glob_characters_and_logged_inference(spark, tmp_dir, caplog):
    for i, name in enumerate(("a[1].cef", "b{x}.cef", "c d.cef", "e%20f.cef")):
        write_lines(f"{tmp_dir}/odd/{name}", [f"CEF:0|V|P|1|s|n|1|k{i}=1"])
    with caplog.at_level("INFO", logger="cefframe"):
        assert read_cef(spark, f"{tmp_dir}/odd").columns[7:] == ["k0", "k1", "k2", "k3"]
    assert "Inferred CEF schema of 11 columns" in caplog.text
    assert read_cef(spark, f"{tmp_dir}/odd", maxRecords=2).columns[7:] == ["k0", "k1"]


def test_no_files(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/none")
    for kw in ({}, {"maxRecords": 5}):
        with pytest.raises(ValueError, match="It must be specified manually"):
            read_cef(spark, f"{tmp_dir}/none", **kw)


@pytest.mark.parametrize("name", ["src", "Src"])
def test_partition_column_named_like_a_key_wins(spark, tmp_dir, name):
    write_lines(f"{tmp_dir}/{name}/{name}=P1/x.cef", ["CEF:0|V|P|1|s|n|1|src=line act=go"])
    write_lines(f"{tmp_dir}/{name}/{name}=P2/x.cef", ["CEF:0|V|P|1|s|n|1|src=line act=go"])
    df = read_cef(spark, f"{tmp_dir}/{name}")
    assert [c.lower() for c in df.columns].count("src") == 1
    one = df.filter(F.col("src") == "P1")
    assert [(r["src"], r.act) for r in one.select("src", "act").collect()] == [("P1", "go")]
    assert f"({name}#" in physical_plan(one).split("PartitionFilters:")[1].split("PushedFilters")[0]
    given = T.StructType(header_schema() + [T.StructField("src", T.StringType()), T.StructField("act", T.StringType())])
    assert [r.src for r in read_cef(spark, f"{tmp_dir}/{name}", schema=given).orderBy("src").collect()] == ["P1", "P2"]


def test_options_reach_spark_whatever_their_case(spark, tmp_dir):
    df = spark.createDataFrame([("CEF:0", "V", "P", "1", "s", "n", "1", "x")],
                               "CEFVersion string, DeviceVendor string, DeviceProduct string, DeviceVersion string, "
                               "SignatureID string, Name string, Severity string, act string")
    write_cef(df.union(df), f"{tmp_dir}/z", Compression="gzip", LINESEP="\r\n", mode="append")
    write_cef(df, f"{tmp_dir}/z", mode="ignore")
    assert glob.glob(f"{tmp_dir}/z/*.gz") and not glob.glob(f"{tmp_dir}/z/*.txt")
    assert [r.act for r in read_cef(spark, f"{tmp_dir}/z", LINESEP="\r\n", pathglobfilter="*.gz").collect()] == ["x", "x"]


def test_null_line_is_marked_in_the_corrupt_column(spark):
    from cefframe import parse_cef
    df = spark.createDataFrame([(None,), ("CEF:0|V|P|1|s|n|1|act=x",)], "value string")
    sch = T.StructType(header_schema() + [T.StructField("act", T.StringType()), T.StructField("_c", T.StringType())])
    out = parse_cef(df, sch, corruptRecordColumnName="_c")
    assert [(r.act, r._c) for r in out.collect()] == [(None, ""), ("x", None)] and out.filter("_c is not null").count() == 1


def test_stream_of_several_paths_and_stream_write(spark, tmp_dir):
    write_lines(f"{tmp_dir}/one/a.cef", LINES)
    write_lines(f"{tmp_dir}/two/b.cef", LINES[:1])
    stream = read_cef_stream(spark, f"{tmp_dir}/one", f"{tmp_dir}/two", maxBytesPerTrigger=1000000)
    write_cef_stream(stream, f"{tmp_dir}/sout", f"{tmp_dir}/schk").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.badge for r in read_cef(spark, f"{tmp_dir}/sout").collect()) == ["0", "0", "1", "2"]


def test_large_gzip_files_are_parsed_by_many_tasks(spark, tmp_dir, monkeypatch):
    import cefframe.sources.files as files
    write_lines(f"{tmp_dir}/g/a.cef.gz", LINES * 50, gz=True)
    write_lines(f"{tmp_dir}/p/a.cef", LINES * 50)
    rebalanced = lambda df: "REBALANCE_PARTITIONS" in physical_plan(df)
    assert not rebalanced(read_cef(spark, f"{tmp_dir}/g"))
    monkeypatch.setattr(files, "LARGE_UNSPLIT", 100)
    assert rebalanced(read_cef(spark, f"{tmp_dir}/g")) and not rebalanced(read_cef(spark, f"{tmp_dir}/p"))
    plan = physical_plan(read_cef(spark, f"{tmp_dir}/g"))
    # The regex runs above the exchange, on the rebalanced lines.
    assert plan.index("regexp_extract_all") < plan.index("REBALANCE_PARTITIONS") and plan.count("FileScan") == 1
    a, b = (sorted(map(str, read_cef(spark, f"{tmp_dir}/{x}").collect())) for x in "gp")
    assert a == b and len(a) == 150


def test_files_of_partitioned_output_follow_the_bytes(spark, tmp_dir):
    keys = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    heads = [F.lit(x).alias(h) for h, x in zip(("CEFVersion", "DeviceVendor", "DeviceProduct", "DeviceVersion", "SignatureID", "Name",
                                                "Severity"), ("CEF:0", "v", "p", "1", "s", "n", "5"))]
    df = spark.range(30_000).repartition(16).select(*heads, F.col("id").alias("eventId"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("msg"),
                                                    keys.alias("day"))
    sizes, parts = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(sizes, "400k")
    spark.conf.set("spark.sql.shuffle.partitions", "199")  # hash partitions of their own for the eight values
    try:
        write_cef(df, f"{tmp_dir}/out", partition_by="day")
    finally:
        spark.conf.unset(sizes)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    files = {d: glob.glob(f"{tmp_dir}/out/{d}/*.txt") for d in os.listdir(f"{tmp_dir}/out") if d.startswith("day=")}
    assert len(files) == 8
    for names in files.values():
        assert len(names) <= 1 + sum(map(os.path.getsize, names)) // 200_000, names
    assert len(files["day=hot"]) > 1  # a hot value is written by several tasks
    assert read_cef(spark, f"{tmp_dir}/out").groupBy("day").count().filter("day = 'hot'").first()["count"] == 10_000


def test_inference_over_files_does_not_sort_the_pairs(spark, tmp_dir, monkeypatch):
    from test_infer_encode import scans_of
    first, second = (spark.createDataFrame([(f"CEF:0|V|P|1|s|n|1|{x}",) for x in xs], "value string").coalesce(1)
                     for xs in (["zone=1 act=2", "act=3 door=4"], ["door=1 late=2"]))
    second.write.option("compression", "bzip2").text(tmp_dir + "/b")
    first.write.text(tmp_dir + "/a")
    df, (scan,) = scans_of(monkeypatch, spark, lambda: read_cef(spark, tmp_dir + "/b", tmp_dir + "/a"))
    assert df.columns[7:] == ["zone", "act", "door", "late"]  # in path order
    assert "HashAggregate" in scan and "Sort" not in scan


def test_views_and_other_line_separators_are_inferred_without_sorting_the_pairs(spark, tmp_dir, monkeypatch):
    from test_infer_encode import scans_of
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    for mode in ("errorifexists", "append"):
        lines.write.mode(mode).option("lineSep", "\r\n").text(tmp_dir + "/a")
    df, (scan,) = scans_of(monkeypatch, spark, lambda: read_cef(spark, tmp_dir + "/a", lineSep="\r\n"))
    assert df.count() == 6 and "HashAggregate" in scan and "Sort" not in scan
    lines.write.text(tmp_dir + "/b")
    _, (scan,) = scans_of(monkeypatch, spark, lambda: register_cef_view(spark, "cef_unsorted", tmp_dir + "/b"))
    assert "HashAggregate" in scan and "Sort" not in scan
    assert spark.sql("SELECT badge FROM cef_unsorted WHERE badge > 0").count() == 2

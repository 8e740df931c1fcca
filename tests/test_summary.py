import os

import pytest
from pyspark.sql import types as T

from cefframe import key_summary, promote_rest, read_cef, read_cef_stream, summary_schema, update_key_summary
from cefframe.options import CefOptions
from cefframe.sources.files import infer_files_schema
from lines import lines_df


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def line(ext):
    return f"CEF:0|V|P|1|s|n|1|{ext}"


def full(spark, folder, **kw):
    return infer_files_schema(spark, [folder], CefOptions(**kw))


def jobs_in(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        result = fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return result, len(sc.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("pivot", [False, True])
def test_updates_give_the_schema_of_a_full_scan(spark, tmp_dir, pivot):
    src, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    put(src, "b.cef", [line("eventId=1 cs1=x cs1Label=Site"), "broken", line("zeta=1")])
    assert update_key_summary(spark, store, src, pivotFields=pivot) == full(spark, src, pivot_fields=pivot)
    put(src, "c 1.cef", [line("cnt=4 Severity=2")])
    put(src, "a.cef", [line("alpha=1 eventId=2")])  # earlier in path order than what is known
    assert update_key_summary(spark, store, src, pivotFields=pivot) == full(spark, src, pivot_fields=pivot)
    assert summary_schema(spark, store, CefOptions()) == full(spark, src, pivot_fields=pivot)
    counts = {r.name: (r.n, r.files) for r in key_summary(spark, store).collect()}
    assert counts["eventId"] == (2, 2) and counts["alpha"] == (1, 1)


def test_only_new_and_changed_files_are_read(spark, tmp_dir):
    src, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    for i in range(5):
        put(src, f"f{i}.cef", [line(f"k{i}=1")])
    update_key_summary(spark, store, src)
    batches = lambda: {(r.file[-6:], r.batch) for r in spark.read.parquet(f"{store}/keys").collect()}
    assert {b for _, b in batches()} == {1}
    _, jobs = jobs_in(spark, "nothing-new", lambda: update_key_summary(spark, store, src))
    assert {b for _, b in batches()} == {1} and jobs < 20
    put(src, "f9.cef", [line("k9=1")])
    put(src, "f1.cef", [line("changed=1 k1=2")])
    os.remove(f"{src}/f3.cef")
    got = update_key_summary(spark, store, src)
    assert got == full(spark, src) and "k3" not in got.names and "changed" in got.names
    assert {f for f, b in batches() if b == 2} == {"f9.cef", "f1.cef"}
    put(src, "f3.cef", [line("back=1")])
    assert update_key_summary(spark, store, src) == full(spark, src)


def test_a_half_finished_update_does_not_count(spark, tmp_dir):
    src, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    put(src, "a.cef", [line("a=1")])
    update_key_summary(spark, store, src)
    keys = spark.read.parquet(f"{store}/keys")
    orphan = keys.selectExpr("batch + 1 AS batch", "concat(file, 'x') AS file", "'ghost' AS name", "first", "n")
    orphan.write.mode("append").parquet(f"{store}/keys")
    assert "ghost" not in summary_schema(spark, store).names
    put(src, "b.cef", [line("b=1")])
    assert update_key_summary(spark, store, src) == full(spark, src)


def test_partitions_other_options_and_empty_stores(spark, tmp_dir):
    src, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    put(f"{src}/day=1", "a.cef", [line("day=7 a=1")])
    got = update_key_summary(spark, store, src)
    assert got == full(spark, src) and "day" not in got.names
    with pytest.raises(ValueError, match="other options"):
        update_key_summary(spark, store, src, pivotFields=True)
    with pytest.raises(ValueError, match="maxRecords"):
        update_key_summary(spark, store, src, maxRecords=5)
    os.makedirs(f"{tmp_dir}/none")
    with pytest.raises(ValueError, match="Unable to infer schema"):
        update_key_summary(spark, f"{tmp_dir}/s2", f"{tmp_dir}/none")


def test_a_stream_whose_keys_grow_loses_nothing(spark, tmp_dir):
    src, store, out = f"{tmp_dir}/in", f"{tmp_dir}/store", f"{tmp_dir}/out"

    def start(schema):
        stream = read_cef_stream(spark, src, schema=schema, rest="_rest", maxFilesPerTrigger=1)
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_dir}/chk")
         .trigger(availableNow=True).start().awaitTermination())

    put(src, "a.cef", [line("eventId=1")])
    first = update_key_summary(spark, store, src)
    put(src, "b.cef", [line("eventId=2 cnt=5 door=x")])  # arrives while the first schema is in use
    start(first)
    second = update_key_summary(spark, store, src)
    assert second.names[-2:] == ["cnt", "door"]
    put(src, "c.cef", [line("eventId=3 cnt=6 late=1")])
    start(second)
    third = update_key_summary(spark, store, src)
    written = spark.read.schema(T.StructType(second.fields + [T.StructField("_rest", T.MapType(T.StringType(), T.StringType()))])).parquet(out)
    whole = promote_rest(written, third)
    want = read_cef(spark, src, schema=third)
    assert sorted(map(str, whole.drop("_rest").collect())) == sorted(map(str, want.collect()))
    assert whole.filter("_rest IS NOT NULL").count() == 0


def test_first_lines_of_many_small_files_take_few_jobs(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    for i in range(5000):
        put(src, f"f{i:04}.cef", [line(f"k{i % 50}=1 m{i // 100}=2")])
    schema, jobs = jobs_in(spark, "first-lines", lambda: full(spark, src, max_records=4000))
    want = [n for i in range(4000) for n in (f"k{i}" if i < 50 else None, f"m{i // 100}" if i % 100 == 0 else None) if n]
    assert [f.name for f in schema.fields[7:]] == want
    assert jobs <= 15, jobs


def test_first_lines_beyond_what_the_driver_takes(spark, tmp_dir, monkeypatch):
    import cefframe.sources.files as files
    src = f"{tmp_dir}/in"
    for i in range(9):
        put(src, f"f{i}.cef", [line(f"k{i}x{j}=1") for j in range(4)])
    want = [full(spark, src, max_records=n) for n in (1, 5, 18, 36, 50)]
    monkeypatch.setattr(files, "TAKE", 3)
    assert [full(spark, src, max_records=n) for n in (1, 5, 18, 36, 50)] == want
    assert [len(s.fields) - 7 for s in want] == [1, 5, 18, 36, 36]
    monkeypatch.setattr(files, "TOGETHER", 1)
    assert full(spark, src, max_records=18) == want[2]


def test_summary_of_text_written_by_spark(spark, tmp_dir):
    lines_df(spark, [line(f"k{i}=v") for i in range(40)]).repartition(6).write.text(f"{tmp_dir}/in", compression="gzip")
    assert update_key_summary(spark, f"{tmp_dir}/store", f"{tmp_dir}/in") == full(spark, f"{tmp_dir}/in")

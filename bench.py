"""Benchmark: CEF read / parse / encode throughput on lineitem encoded as CEF.

Setup (untimed): lineitem (about 600,000 rows at sf0.1) is encoded as CEF
text once.  Timed (median of BENCH_RUNS warm runs each):

  infer           schema inference over all lines of the files
  infer_pivot     the same with pivotFields=true
  infer_first     inference from the first 10,000 lines (the scan stops there)
  parse_full      parse every line into 21 typed columns (noop sink)
  header_scan     groupBy(SignatureID).count() (extension regex pruned)
  parse_pivot     parse with pivotFields=true (noop sink)
  filter_rt       parse_full behind a filter on a parsed timestamp (noop sink)
  rollup          TPC-H Q1-style aggregate over parsed CEF
  encode          lineitem parquet -> CEF lines (noop sink)
  gzip_roundtrip  write gzip CEF, read it back, count
  quarantine      parse every line once, store good and bad rows as Parquet

Prints one JSON line.  Env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cefframe import quarantine_cef, read_cef, to_cef_lines, write_cef  # noqa: E402
from cefframe.sources.files import infer_files_schema  # noqa: E402
from cefframe.options import CefOptions  # noqa: E402
from cefframe.plans.catalogue import scratch_dir  # noqa: E402
from cefframe.session import local_session  # noqa: E402


def lineitem_frame(spark, sf_dir):
    li = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet"))
    return li.select(
        F.lit("CEF:0").alias("CEFVersion"), F.lit("TPC").alias("DeviceVendor"),
        F.lit("TPC-H lineitem").alias("DeviceProduct"), F.lit("1").alias("DeviceVersion"),
        F.concat("l_returnflag", "l_linestatus").alias("SignatureID"),
        F.lit("Line item").alias("Name"), F.col("l_linenumber").cast("string").alias("Severity"),
        F.col("l_orderkey").alias("eventId"), F.col("l_partkey").alias("cn1"),
        F.col("l_suppkey").alias("cn2"), F.col("l_linenumber").alias("dpt"),
        F.col("l_quantity").cast("float").alias("cfp1"), F.col("l_extendedprice").alias("slat"),
        F.col("l_discount").alias("slong"), F.col("l_tax").alias("dlat"),
        F.col("l_shipdate").cast("timestamp").alias("rt"),
        F.col("l_returnflag").alias("cs1"), F.lit("ReturnFlag").alias("cs1Label"),
        F.col("l_linestatus").alias("cs2"), F.lit("LineStatus").alias("cs2Label"),
        F.concat(F.lit("order="), F.col("l_orderkey").cast("string"), F.lit(" part "),
                 F.col("l_partkey").cast("string")).alias("msg"))


def timed(fn, runs):
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="cefframe-bench")
    # A local benchmark: its files are this machine's; elsewhere they go to the shared folder.
    work = scratch_dir(spark)
    text_dir = f"{work}/lineitem_cef"
    write_cef(lineitem_frame(spark, sf_dir), text_dir, mode="overwrite")
    n_lines = spark.read.text(text_dir).count()

    schema = infer_files_schema(spark, [text_dir], CefOptions())
    pivot_schema = infer_files_schema(spark, [text_dir], CefOptions(pivot_fields=True))

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def q_infer():
        infer_files_schema(spark, [text_dir], CefOptions())

    def q_infer_pivot():
        infer_files_schema(spark, [text_dir], CefOptions(pivot_fields=True))

    def q_infer_first():
        infer_files_schema(spark, [text_dir], CefOptions(max_records=10_000))

    def q_filter_rt():
        noop(read_cef(spark, text_dir, schema=schema).filter("rt > timestamp'1993-01-01'"))

    def q_parse_full():
        noop(read_cef(spark, text_dir, schema=schema))

    def q_header_scan():
        read_cef(spark, text_dir, schema=schema).groupBy("SignatureID").count().collect()

    def q_parse_pivot():
        noop(read_cef(spark, text_dir, schema=pivot_schema, pivotFields=True))

    def q_rollup():
        df = read_cef(spark, text_dir, schema=schema)
        (df.groupBy("cs1", "cs2")
           .agg(F.sum("cfp1").alias("sum_qty"), F.sum("slat").alias("sum_base_price"),
                F.sum(F.col("slat") * (1 - F.col("slong"))).alias("sum_disc_price"),
                F.sum(F.col("slat") * (1 - F.col("slong")) * (1 + F.col("dlat"))).alias("sum_charge"),
                F.avg("cfp1").alias("avg_qty"), F.count(F.lit(1)).alias("count_order"),
                F.max("rt").alias("last_ship"))
           .orderBy("cs1", "cs2").collect())

    def q_encode():
        noop(to_cef_lines(lineitem_frame(spark, sf_dir)))

    counter = {"i": 0}

    def q_gzip_roundtrip():
        counter["i"] += 1
        out = f"{work}/gz_{counter['i']}"
        write_cef(read_cef(spark, text_dir, schema=schema), out, compression="gzip")
        read_cef(spark, out, schema=schema).count()

    def q_quarantine():
        counter["i"] += 1
        quarantine_cef(spark, text_dir, out=f"{work}/split_{counter['i']}", schema=schema)

    plan = [("infer", q_infer), ("infer_pivot", q_infer_pivot), ("infer_first", q_infer_first), ("filter_rt", q_filter_rt), ("parse_full", q_parse_full), ("header_scan", q_header_scan),
            ("parse_pivot", q_parse_pivot), ("rollup", q_rollup), ("encode", q_encode),
            ("gzip_roundtrip", q_gzip_roundtrip), ("quarantine", q_quarantine)]
    results = {}
    for name, fn in plan:
        fn()  # warm-up
        results[name] = round(timed(fn, runs), 3)
    total = round(sum(results.values()), 3)
    print(json.dumps({"metric": "cef_bench_total", "value": total, "unit": "sec",
                      "queries": results, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "lines": n_lines, "columns": len(schema.fields), "cpus": cpus,
                      "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()

import pytest
from pyspark.sql import functions as F

from cefframe.llm.mixing import MOST, allocate, mix, mixed_rows, targets
from conftest_llm import CLASHING, COLUMNS, docs_frame


def fill(sizes):
    """Brute force: raise a common level by resharing until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        left, w = total - sum(capped.values()), sum(weight[s] for s in rest)
        target = {s: left * weight[s] / w for s in rest} if rest else {}
        over = [s for s in rest if target[s] > MOST * sizes[s]]
        if not over:
            return {**capped, **target}
        capped |= {s: MOST * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 20, "c": 30}, {"a": 1000, "b": 1, "c": 1, "d": 5}, {"a": 7}, {"a": 0, "b": 5}, {None: 50, "z": 1, "é": 9, "a": 3},
    {f"s{i}": (i * 37) % 11 + 1 for i in range(20)}])
def test_targets_match_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(fill(sizes)) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_come_near_their_targets(spark):
    rows = [(i, "w " * (i * 7919 % 90), "en", f"s{i % 5}" if i % 3 else "hot", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, COLUMNS)
    out = mix(df)
    sums = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 90 for r in sums)
    assert out.filter("taken > 3 * size or taken < 0 or copies not between 0 and 3").count() == 0
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, mix(df.repartition(7)).collect()))


def test_bins_do_not_change_the_sample(spark):
    df = spark.range(500).select("id", F.lit("s").alias("source"), (F.col("id") % 13).alias("size"), (F.rand(5)).alias("u"))
    df = df.unionByName(spark.range(500, 600).select("id", F.lit("t").alias("source"), F.lit(3).cast("long").alias("size"), F.rand(6).alias("u")))
    df = spark.createDataFrame(df.toPandas())
    few, many = (sorted((r.id, r.copies) for r in allocate(df, bins=b).collect()) for b in (1, 4096))
    assert few == many


def test_rows_of_the_mix(spark):
    df = docs_frame(spark, ["a b c", "", None, "d " * 50_000, "e", "e", (4, "e"), (None, "f g")], CLASHING)
    out = mixed_rows(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    words = out.agg(F.sum(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda x: x != "")))).first()[0]
    assert words == mix(df).agg(F.sum("taken")).first()[0]


def words_of(df):
    return df.agg(F.sum(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda x: x != "")))).first()[0]


@pytest.mark.parametrize("key", [5, None])
def test_rows_tied_on_id_share_the_planned_copies(spark, key):
    rows = [(key, f"w{i} x y z", "en", "a", i) for i in range(150)] + [(1000 + i, "p q r", "en", f"s{i % 4}", i) for i in range(40)]
    rows += [(key, "one two", "en", "s1", 0)] * 30 + [(7, "same same", "en", None, 1)] * 21
    df = spark.createDataFrame(rows, COLUMNS).repartition(6)
    plan = mix(df).collect()
    out = mixed_rows(df)
    assert words_of(out) == sum(r.taken for r in plan)
    # Per tie, the copies differ by at most one, and their sum is what was planned.
    got = {}
    for r in out.groupBy("doc_id", "source", "text", "n_chars").count().collect():
        got.setdefault((r.doc_id, r.source, len(r.text.split())), []).append(r["count"])
    want = {}
    for r in plan:
        want[r.doc_id, r.source, r.size] = want.get((r.doc_id, r.source, r.size), 0) + r.copies
    assert {k: sum(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert all(max(got[k]) - min(got[k]) <= 1 for k in got if k[0] == key and k[1] == "a")


def test_empty(spark):
    df = docs_frame(spark, ["x"]).limit(0)
    assert mix(df).collect() == [] and mixed_rows(df).collect() == []
    blank = docs_frame(spark, ["", None, " \n"])
    assert [r.taken for r in mix(blank).collect()] == [0, 0, 0]

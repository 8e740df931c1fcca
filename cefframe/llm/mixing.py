"""Mixing sources to target weights by Pareto order sampling.

Each source's share of all words is a target; a target stops at ``most`` times the source's size
and the excess goes to the others by weight until none is above (solved in closed form: sources
sorted by cap over weight, the capped ones are a prefix).  A source whose target is L times its
size takes floor(L) certain whole copies of every document.  The rest, a fraction f, is drawn by
Pareto order sampling: inclusion probabilities differ from source to source, a document with the
inclusion probability p = f and the uniform number u has the rank (u / (1 - u)) / (p / (1 - p)),
and the smallest ranks are taken until the words left to the target are filled (the sample's size
is fixed in words).  u comes from a digest of the id, so reruns agree.

The running total over a source is found in two steps, so that no task sees a whole source: words
per (source, rank bin) first, then rows only within the one bin where a source's total is reached.

Defined cases: null text has size 0; the null source is a source of its own, ordered last; an empty
table gives an empty result; rows tied on id are told apart by size (full ties are interchangeable,
and share out their copies); documents of size 0 take nothing; other columns, whatever their names,
are ignored; texts of any length count whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, new_run, quoted, stored, table

MOST, BINS, SEED = 3, 16384, "mix"


def word_count(text_col):
    return F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD)).cast("long")


def uniform(id_col, seed: str = SEED):
    """A number in (0, 1) from the first 52 bits of a digest of the id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """source, source_size, target from (source, source_size); weights 1, 2, 3, ... in source order.

    One row per source: the table of sources is small, whatever the corpus holds.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.select("source", "source_size", (F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1).alias("weight"))
    ranked = Window.orderBy((F.lit(most) * F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, whole = ranked.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    w = w.select("*", (F.lit(most) * F.col("source_size") / F.col("weight")).alias("ratio"),
                 F.row_number().over(ranked).alias("place"),
                 ((F.sum("source_size").over(whole) - F.coalesce(F.lit(most) * F.sum("source_size").over(before), F.lit(0)))
                  / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))).alias("level"))
    w = w.withColumn("first", F.min(F.when(F.col("level") <= F.col("ratio"), F.col("place"))).over(whole))
    w = w.withColumn("common", F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(whole))
    return w.select("source", "source_size",
                    F.when(F.col("place") < F.col("first"), (F.lit(most) * F.col("source_size")).cast("double"))
                    .otherwise(F.col("common") * F.col("weight")).alias("target"))


def allocate(rows: DataFrame, most: int = MOST, bins: int = BINS) -> DataFrame:
    """rows: (id, source, size, u) -> (id, source, size, source_size, target, copies)."""
    run = new_run(rows.sparkSession, "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = (targets(sizes, most)
            .withColumn("load", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
            .withColumn("whole", F.floor("load").cast("long"))
            .withColumn("p", F.col("load") - F.col("whole"))
            .withColumn("words_left", F.col("target") - F.col("whole") * F.col("source_size")))
    # Stored, so that Spark knows its size: it broadcasts the table of sources only if it is small.
    goal = stored(goal.drop("load"), f"{run}/targets")
    ranked = (rows.join(goal, rows["source"].eqNullSafe(goal["source"])).drop(goal["source"])
              .withColumn("rank", F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))))
              .withColumn("bin", F.floor(F.lit(bins) * F.col("u")).cast("int")))
    binned = ranked.filter("p > 0").groupBy("source", "bin", "words_left").agg(F.sum("size").alias("bin_words"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    binned = binned.withColumn("before", F.coalesce(F.sum("bin_words").over(upto), F.lit(0)))
    # The bin in which the words left are reached: one per source.
    edge = stored(binned.filter("before < words_left AND words_left <= before + bin_words")
                  .select(F.col("source").alias("edge_source"), F.col("bin").alias("edge_bin"), "before"),
                  f"{run}/edges")
    placed = ranked.join(edge, ranked["source"].eqNullSafe(edge["edge_source"]), "left").drop("edge_source")
    in_edge = F.col("edge_bin").isNotNull() & (F.col("bin") == F.col("edge_bin")) & (F.col("p") > 0)
    at = Window.partitionBy("source").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    keep = ["id", "source", "size", "source_size", "target", "whole"]
    # A row is taken if its middle lies before the target: the nearer of stopping before or after it.
    edge_rows = (placed.filter(in_edge)
                 .withColumn("sum", F.col("before") + F.coalesce(F.sum("size").over(at), F.lit(0)))
                 .select(*keep, (F.col("sum") + F.col("size") / 2 <= F.col("words_left")).alias("drawn")))
    others = placed.filter(~in_edge).select(*keep, F.coalesce((F.col("bin") < F.col("edge_bin")) & (F.col("p") > 0),
                                                              F.lit(False)).alias("drawn"))
    return edge_rows.unionByName(others).select(
        *keep[:-1], (F.col("whole") + F.col("drawn").cast("long")).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken."""
    rows = docs.select(F.col(id_col).alias("id"), "source", word_count(F.col("text")).alias("size"),
                       uniform(F.col(id_col), seed).alias("u"))
    rows = stored(rows, f"{new_run(docs.sparkSession, 'mix')}/sizes")
    return (allocate(rows, most).withColumn("taken", F.col("copies") * F.col("size"))
            .withColumnRenamed("id", id_col))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``docs``, all its columns, as often as the mix takes it.

    Rows tied on id, source and size are told apart by nothing the mix looks at: they share out the
    copies that were planned for them, some one more than others where they do not divide evenly.
    """
    key, source, size, share, more, part, at, turn, copy = fresh(
        docs, "_id", "_source", "_size", "_share", "_more", "_part", "_at", "_turn", "_copy")
    run = new_run(docs.sparkSession, "mixed")
    chosen = stored(mix(docs, id_col, most, seed)
                    .groupBy(F.col(id_col).alias(key), F.col("source").alias(source), F.col("size").alias(size))
                    .agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("n")).filter("c > 0")
                    .select(key, source, size, F.expr("c div n").cast("int").alias(share), F.expr("c % n").alias(more)),
                    f"{run}/copies")
    on = (docs[id_col].eqNullSafe(chosen[key]) & docs["source"].eqNullSafe(chosen[source])
          & (word_count(docs["text"]) == chosen[size]))
    columns = list(map(quoted, docs.columns))
    found = docs.join(chosen.filter(F.col(share) > 0), on).select(*columns, F.col(share).alias(copy))
    if chosen.filter(F.col(more) > 0).limit(1).count():
        # The first rows of such a tie get one more: rows are numbered by part, then place in the part.
        tied = stored(docs.join(chosen.filter(F.col(more) > 0), on)
                      .select(*columns, key, source, size, more, F.spark_partition_id().alias(part),
                              F.monotonically_increasing_id().alias(at)), f"{run}/tied")
        group = [F.struct(F.xxhash64(key), key, source, size).alias("g"), F.col(part).alias("p")]
        held = tied.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"))
        upto = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        starts = held.select("g", "p", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("before"))
        own = F.row_number().over(Window.partitionBy(key, source, size, part).orderBy(at))
        placed = tied.withColumn(turn, own)
        first = (placed.join(starts, (F.struct(F.xxhash64(key), key, source, size).eqNullSafe(starts["g"])) & (F.col(part) == starts["p"]))
                 .filter(F.col("before") + F.col(turn) <= F.col(more)).select(*columns, F.lit(1).alias(copy)))
        found = found.unionAll(first)
    return found.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "copies"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS ratio,
    row_number() OVER o AS place,
    CAST(sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM s WINDOW o AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST)),
f AS (SELECT *, min(CASE WHEN level <= ratio THEN place END) OVER () AS first_place FROM r),
c AS (SELECT *, max(CASE WHEN place = first_place THEN level END) OVER () AS common FROM f),
g AS (
  SELECT source, source_size,
    CASE WHEN place < first_place THEN CAST(3 * source_size AS DOUBLE) ELSE common * weight END AS target FROM c),
h AS (
  SELECT *, CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS BIGINT) AS whole,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS load FROM g),
k AS (
  SELECT d.doc_id, d.size, h.source_size, h.target, h.whole, target - whole * source_size AS words_left, load - whole AS p,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY (u / (1 - u)) / (CASE WHEN load > whole THEN (load - whole) / (1 - (load - whole)) ELSE 1 END),
                      d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS upto
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source)
SELECT doc_id, size, source_size, target,
  whole + CASE WHEN p > 0 AND upto + size / 2.0::DOUBLE <= words_left THEN 1 ELSE 0 END AS copies,
  size * (whole + CASE WHEN p > 0 AND upto + size / 2.0::DOUBLE <= words_left THEN 1 ELSE 0 END) AS taken
FROM k
"""

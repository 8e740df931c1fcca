"""Exact top-k inner-product search over a pivot-distance index.

Vectors become whole numbers, floor(256 * x).  With one coordinate added, sqrt(M - |x|^2) for a row
and 0 for a query, the largest inner product is the smallest distance: |q - x|^2 = |q|^2 + M - 2 q.x.

Index: every row is keyed by its nearest pivot and its distance to it; the rows of a pivot are cut
by distance into annuli (cells).  The pivots are fitted (a few rounds of k-means) on at most FIT
rows chosen by a digest of their id; every row is indexed.

Search: a query's cells are sorted by the least distance that the triangle inequality allows,
max(0, d(q, p) - outer, inner - d(q, p)).  The first cells are scored (until they hold PROBE rows);
that gives a k-th best score.  Of all others only cells whose bound still reaches it are scored.
Results are exact whatever the pivots are; these only decide how much is skipped.

A cell is dealt out in parts of about PART rows, its queries in parts of about CHUNK, so a cell that
holds a third of all rows (one vector, repeated) is spread over tasks.  The driver holds one row for
each cell, PIVOTS * RINGS at most.

Defined cases: a vector that is null, or has a null or non-finite component, takes no part; all
others do, whatever their size, and scores are exact.  A result score of 2^63 - 1 or more in size, or
a component whose whole number does not fit a long (LIMIT / 256 or more in size), raises an error, as
in SQL; shorter vectors count as padded with zeros; rows that share the query's id are its own rows; of several
vectors with a query's id the first in order is the query; null ids are candidates, last among ties,
and no queries; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow, new_run, ship_code, stored, table

SCALE, LIMIT = 256, 1 << 63
#: Stands for scores that no long holds; of such parts is an exact product put together.
BEYOND, PART_BITS, PART_DIMS = (1 << 63) - 1, 21, 2048
FIT, PIVOTS, RINGS, ROUNDS = 4096, 32, 4, 6
PROBE, PART, CHUNK = 2000, 4096, 2048


def whole_numbers(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): usable vectors as arrays of longs."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("x"))
    given = given.filter(F.col("x").isNotNull() & F.forall("x", ok))
    large = F.exists("x", lambda x: F.abs(x) * F.lit(float(SCALE)) >= F.lit(float(LIMIT)))
    error = F.raise_error(F.concat(F.lit("top-k: a component times 256 does not fit a long; vector "), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    return given.select("id", F.when(large, error.cast("array<bigint>"))
                        .otherwise(F.transform("x", lambda x: F.floor(F.lit(float(SCALE)) * x))).alias("v"))


def fit_pivots(sample: np.ndarray, most: float) -> np.ndarray:
    """Pivots in the space with the added coordinate."""
    x = with_norm(sample, most)
    rng = np.random.default_rng(11)
    pivots = x[rng.permutation(len(x))[:PIVOTS]]
    for _ in range(ROUNDS):
        near = distances(x, pivots).argmin(axis=1)
        pivots = np.array([x[near == p].mean(axis=0) if (near == p).any() else pivots[p] for p in range(len(pivots))])
    return pivots


def with_norm(v: np.ndarray, most: float) -> np.ndarray:
    v = v.astype(np.float64)
    return np.column_stack([v, np.sqrt(np.maximum(most - (v * v).sum(axis=1), 0))])


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def padded(rows, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where they are exact, else in longs, else in parts of PART_BITS bits.

    Products that reach BEYOND in size become BEYOND with their sign.
    """
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < BEYOND:
        return a @ b.T
    mask = (1 << PART_BITS) - 1
    split = lambda x: [(x & mask), (x >> PART_BITS) & mask, x >> 2 * PART_BITS]
    sums = [np.zeros((len(a), len(b)), np.int64) for _ in range(5)]
    for at in range(0, a.shape[1], PART_DIMS):  # so few that doubles are exact
        left, right = split(a[:, at:at + PART_DIMS]), split(b[:, at:at + PART_DIMS])
        right = [y.astype(np.float64).T for y in right]
        for i, x in enumerate(left):
            x = x.astype(np.float64)
            for j, y in enumerate(right):
                sums[i + j] += (x @ y).astype(np.int64)
    low = np.zeros_like(sums[0])
    for i in range(4):
        sums[i + 1] += sums[i] >> PART_BITS
        sums[i] &= mask
        if i < 3:
            low |= sums[i] << i * PART_BITS
    # The product is (sums[4] * 2^21 + sums[3]) * 2^63 + low.
    zero, minus = (sums[4] == 0) & (sums[3] == 0), (sums[4] == -1) & (sums[3] == mask)
    out = np.where(sums[4] >= 0, BEYOND, -BEYOND)
    out[zero] = low[zero]
    out[minus] = np.maximum(low[minus] + np.iinfo(np.int64).min, -BEYOND)
    return out


def best_rows(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """The k best of these rows for each of these queries; ``ids`` may hold None."""
    known = np.array([i is not None and not pd.isna(i) for i in ids])
    keys = np.array([int(i) if n else np.iinfo(np.int64).max for i, n in zip(ids, known)], np.int64)
    scores = products(queries, vectors)
    out = []
    for q, row in zip(query_ids, scores):
        at = np.nonzero(~(known & (keys == q)))[0]
        if len(at) > k:
            floor = np.partition(row[at], len(at) - k)[len(at) - k]
            at = at[row[at] >= floor]
        at = at[np.lexsort((keys[at], ~known[at], -row[at]))][:k]
        out += [(int(q), int(keys[i]) if known[i] else None, int(row[i])) for i in at]
    frame = pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
    return frame.astype({"query_id": "int64", "vec_id": "Int64", "score": "int64"})


class Cells:
    """What the search knows of the index: pivots, and count, inner and outer distance of each cell."""

    def __init__(self, pivots: np.ndarray, rows: list):
        self.pivots = pivots
        self.pivot = np.array([r["pivot"] for r in rows], np.int64)
        self.ring = np.array([r["ring"] for r in rows], np.int64)
        self.count = np.array([r["n"] for r in rows], np.int64)
        self.inner = np.array([r["inner"] for r in rows])
        self.outer = np.array([r["outer"] for r in rows])

    def plan(self, queries: np.ndarray):
        """For each query: cells in the order of their bounds, bounds, and how many to probe."""
        q = np.column_stack([queries.astype(np.float64), np.zeros(len(queries))])
        d = distances(q, self.pivots)[:, self.pivot]
        bound = np.maximum(0, np.maximum(d - self.outer, self.inner - d))
        # Ties (many bounds are 0): the pivot that is nearer first.
        order = np.lexsort((d, bound), axis=1)
        held = np.cumsum(self.count[order], axis=1)
        probe = np.minimum((held < PROBE).sum(axis=1) + 1, order.shape[1])
        return order, bound, probe


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows of ``vectors``."""
    spark = vectors.sparkSession
    ship_code(spark)
    run = new_run(spark, "topk")
    rows = stored(whole_numbers(vectors, id_col, vec_col), f"{run}/rows")
    norm = F.aggregate("v", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.max(F.size("v")).alias("dims"), F.max(norm).alias("most")).first()
    asked = whole_numbers(queries, id_col, vec_col).filter("id IS NOT NULL").groupBy("id").agg(F.min("v").alias("v"))
    if not facts["dims"]:  # no rows, or only empty vectors: keep one coordinate so that the rest holds
        facts = {"dims": 1, "most": 0.0}
    width = asked.agg(F.max(F.size("v"))).first()[0] or 1
    dims, most = max(facts["dims"], width), facts["most"]
    sample = rows.orderBy(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))).limit(FIT).toPandas()
    pivots = fit_pivots(padded(sample["v"], dims), most) if len(sample) else np.zeros((1, dims + 1))

    def key(batches):
        for batch in batches:
            v = padded(batch.column(1).to_pylist(), dims)
            d = distances(with_norm(v, most), pivots)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in v], pa.binary()), pa.array(near.astype(np.int32)),
                 pa.array(d[np.arange(len(v)), near])], ["id", "v", "pivot", "distance"])

    keyed = stored(map_arrow(rows, key, "id long, v binary, pivot int, distance double")
                   .withColumn("row", F.monotonically_increasing_id()), f"{run}/keyed")
    spans = keyed.groupBy("pivot").agg(F.min("distance").alias("least"), F.max("distance").alias("largest"))
    spans = {r["pivot"]: (r["least"], r["largest"]) for r in spans.collect()}  # one row for each pivot
    span = F.create_map(*[F.lit(x) for p, (a, b) in spans.items() for x in (p, (b - a) / RINGS or 1.0)]) if spans else None
    low = F.create_map(*[F.lit(x) for p, (a, _) in spans.items() for x in (p, a)]) if spans else None
    ring = (F.least(F.floor((F.col("distance") - low[F.col("pivot")]) / span[F.col("pivot")]), F.lit(RINGS - 1)).cast("int")
            if spans else F.lit(0))
    index = keyed.withColumn("ring", ring)
    cells = Cells(pivots, index.groupBy("pivot", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("distance").alias("inner"), F.max("distance").alias("outer")).collect())
    shape = "query_id long, rank int, vec_id long, score long"
    if not len(cells.count):
        return spark.createDataFrame([], shape)

    def planner(phase: int):
        def plan(batches):
            for batch in batches:
                q = padded(batch.column(1).to_pylist(), dims)
                order, bound, probe = cells.plan(q)
                size = (q.astype(np.float64) ** 2).sum(axis=1)
                take, cell = [], []
                for i in range(len(q)):
                    mine = order[i, :probe[i]] if phase == 1 else order[i, probe[i]:]
                    floor = batch.column(2)[i].as_py() if phase == 2 else None
                    if floor is not None:
                        reach = (size[i] + most - bound[i, mine] ** 2) / 2
                        # A little slack, for rounding in the bounds: a distance is off by up to about
                        # 1e-6 of the largest norm, where it is small.
                        mine = mine[reach + 1 + 1e-5 * (size[i] + most) >= floor]
                    take += [i] * len(mine)
                    cell += mine.tolist()
                packed = [r.tobytes() for r in q]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take, pa.int64())),
                                                  pa.array([packed[i] for i in take], pa.binary()), pa.array(cell, pa.int32())],
                                                 ["query", "q", "cell"])
        return plan

    places = spark.createDataFrame([(i, int(cells.pivot[i]), int(cells.ring[i]), math.ceil(int(cells.count[i]) / PART))
                                    for i in range(len(cells.count))], "cell int, pivot int, ring int, parts int")
    located = index.join(places, ["pivot", "ring"])

    def scored(asked_rows: DataFrame, phase: int, name: str) -> DataFrame:
        wanted = stored(map_arrow(asked_rows, planner(phase), "query long, q binary, cell int"), f"{run}/{name}-wanted")
        load = wanted.groupBy("cell").agg(F.count(F.lit(1)).alias("asked")).withColumn("chunks", F.ceil(F.col("asked") / CHUNK).cast("int"))
        load = stored(load.select("cell", "chunks").join(places.select("cell", "parts"), "cell"), f"{run}/{name}-load")
        # By id and row number: rows that share an id, or have none, are dealt out as well.
        deal = F.xxhash64("id", "row")
        left = (located.join(load.select("cell", "chunks"), "cell")
                .withColumn("part", F.pmod(deal, F.col("parts")).cast("int"))
                .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
        right = (wanted.join(load, "cell").withColumn("chunk", F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int"))
                 .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
        on = ["cell", "part", "chunk"]

        def score(rows_: pd.DataFrame, queries_: pd.DataFrame) -> pd.DataFrame:
            if not len(rows_) or not len(queries_):
                return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="Int64"),
                                     "score": pd.Series(dtype="int64")})
            v = np.frombuffer(b"".join(rows_["v"]), np.int64).reshape(len(rows_), dims)
            q = np.frombuffer(b"".join(queries_["q"]), np.int64).reshape(len(queries_), dims)
            return best_rows(queries_["query"].to_numpy(), q, rows_["id"].astype(object).to_numpy(), v, k)

        both = (left.select(*on, "id", "v").groupBy(*on)
                .cogroup(right.select(*on, "query", "q").groupBy(*on))
                .applyInPandas(score, "query_id long, vec_id long, score long"))
        return stored(both, f"{run}/{name}")

    asked = stored(asked, f"{run}/asked")
    first = scored(asked.select("id", "v"), 1, "first")
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    floor = first.withColumn("rank", F.row_number().over(rank)).filter(f"rank = {k}").select(F.col("query_id").alias("id"), "score")
    second = scored(asked.join(floor, "id", "left").select("id", "v", "score"), 2, "second")
    error = F.raise_error(F.concat(F.lit("top-k: a score does not fit a long; query "), F.col("query_id").cast("string")))
    fits = F.when(F.col("rank") > k, False).when(F.abs("score") >= BEYOND, error.cast("boolean")).otherwise(True)
    return (first.unionByName(second).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).filter(fits)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

"""Merkle manifest of a dataset: built levels stored as parent-linked node rows, climbed by a recursive query.

Rows are leaves.  Per group (source) the leaves in order of id form a tree: every FAN consecutive
nodes of a level become one node of the next, until one remains, the group's subroot; the subroots
in order of the groups form the top tree in the same way.  H is SHA-256 over joined texts, digests
as lowercase hex.

1. *Places.*  Leaves are range-partitioned by (group, id) and numbered inside each partition; the
   few (partition, group) counts, added up, make these numbers places in the group.  A group that
   holds a third of all rows is spread over many partitions.
2. *Levels.*  SPAN = FAN ** STEP neighbours meet in one task, which builds STEP levels.  A node row
   holds its digest, its parent's place and, at the foot of each stretch of STEP levels, the rung to
   the next foot: the siblings on the left and right at each level between, and the digest there.
   Each stretch is stored; the next starts from its SPAN times fewer rows.
3. *Climb.*  ``WITH RECURSIVE``: every leaf's own (perhaps altered) digest is folded with the
   siblings on its way, rung by rung, up to the root, and the siblings are appended to its proof.
   The SPAN leaves below one node differ on their first rung only.  From there on they ascend in one
   row: an array of their digests, each folded by itself, and the part of the proof that they share.
   The upper rungs are stored once for each such row, so no join key has more than one row a side at
   any height, however many leaves a group has.  The climb takes (levels / STEP) steps.

Only the number of groups, the largest group's size and the root reach the driver.

Defined cases: any null in a leaf's columns hashes as ``-``; null ids come first in their group,
rows tied on the id are ordered by their leaf; the null group comes first; a lone leaf is its
subroot, a lone subroot the root, and an empty proof's digest is that of the empty text; rows with a
null id are never altered by the query; an empty table gives no rows and no root; further columns,
whatever their names, take no part; texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_run, ship_code, stored, table

FAN, STEP = 3, 4
SPAN = FAN ** STEP
#: The powers of FAN that fit a long.
POWERS = [FAN ** k for k in range(40) if FAN ** k < 1 << 63]
TOP = -1
CHUNK = 10_000


class Manifest(NamedTuple):
    nodes: DataFrame      #: tree, level, idx, hash, parent; tree -1 is the top tree
    groups: DataFrame     #: tree, the group's value, n (its leaves)
    leaves: DataFrame     #: the feet of level 0 with id, altered digest and rung
    ladder: DataFrame     #: rungs by (tree, level, slot) from level STEP and from the subroots on
    height: int           #: levels of the top tree
    root: str | None      #: hex digest


def leaf_text(columns: Sequence[Column]) -> Column:
    """Each value as its UTF-8 byte count, a colon and the value, or ``-`` if null; joined."""
    values = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
                      for v in values])


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def depth_of(n: str) -> Column:
    """Levels above n leaves: how many powers of FAN are smaller than n."""
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in POWERS]), lambda p: p < F.col(n)))


def power(k: Column) -> Column:
    return F.get(F.array(*[F.lit(p).cast("long") for p in POWERS]), k)


def spread(rows: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """Each row once for every number from ``first`` to ``last``; long ranges are cut up and dealt out to tasks."""
    cut = (rows.withColumn("_first", first).withColumn("_last", last)
           .withColumn("_chunk", F.explode(F.sequence(F.expr(f"_first div {CHUNK}"), F.expr(f"_last div {CHUNK}"))))
           .repartition("tree", "level", "_chunk"))
    return cut.withColumn(name, F.explode(F.sequence(
        F.greatest("_first", F.col("_chunk") * CHUNK), F.least(F.col("_last"), F.col("_chunk") * CHUNK + (CHUNK - 1)))))


def numbered(rows: DataFrame, group: list[str], order: list[str], folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows with ``part`` and ``at``; and of each (part, group) ``start``: place = start + at.

    ``group`` may be empty.  The second table also has ``n``, its number of rows.
    """
    keys = [*group, *order]
    at = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("mark", F.monotonically_increasing_id())
    marked = stored(at.select(*rows.columns, F.expr("shiftright(mark, 33)").alias("part"),
                              F.expr("mark & 8589934591").alias("at")), f"{folder}/sorted")
    runs = marked.groupBy("part", *group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    return marked, stored(runs.select("part", *group, "n", start.alias("start")), f"{folder}/runs")


def _parents(below: list[str]) -> list[str]:
    return [hashlib.sha256("".join(below[i:i + FAN]).encode()).hexdigest() for i in range(0, len(below), FAN)]


def _packed(digests: list[str]) -> bytes:
    return bytes.fromhex("".join(digests))


def node_schema(id_type: str) -> str:
    return ("tree long, n long, depth int, level int, idx long, hash binary, parent long, reach int, "
            f"lefts array<binary>, rights array<binary>, top binary, id {id_type}, altered binary")


def build_stretch(base: int):
    """For one task: up to SPAN neighbours of level ``base``, the levels above them, and their rungs."""
    def build(block: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        n, first = block["n"][0].as_py(), block["idx"][0].as_py()
        depth = sum(p < n for p in POWERS)
        levels = [[h.hex() for h in block["hash"].to_pylist()]]
        for _ in range(min(STEP, depth - base)):
            levels.append(_parents(levels[-1]))
        up = len(levels) - 1
        lefts, rights = [], []
        for i in range(len(levels[0])):
            left, right = [], []
            for level in levels[:-1]:
                run = i - i % FAN
                left.append(_packed(level[run:i]))
                right.append(_packed(level[i + 1:run + FAN]))
                i //= FAN
            lefts.append(left)
            rights.append(right)
        rows: dict[str, list] = {c: [] for c in ("level", "idx", "hash", "parent")}
        for k, level in enumerate(levels):
            start = first // FAN ** k
            rows["level"] += [base + k] * len(level)
            rows["idx"] += range(start, start + len(level))
            rows["hash"] += map(bytes.fromhex, level)
            rows["parent"] += [(start + i) // FAN if base + k < depth else None for i in range(len(level))]
        size, feet = len(rows["level"]), len(levels[0])
        more = size - feet
        rung = feet if up else 0
        whole = {"tree": pa.array([block["tree"][0].as_py()] * size, pa.int64()), "n": pa.array([n] * size, pa.int64()),
                 "depth": pa.array([depth] * size, pa.int32()), "level": pa.array(rows["level"], pa.int32()),
                 "idx": pa.array(rows["idx"], pa.int64()), "hash": pa.array(rows["hash"], pa.binary()),
                 "parent": pa.array(rows["parent"], pa.int64()),
                 "reach": pa.array([base + up] * rung + [None] * (size - rung), pa.int32()),
                 "lefts": pa.array([x if rung else None for x in lefts] + [None] * more, pa.list_(pa.binary())),
                 "rights": pa.array([x if rung else None for x in rights] + [None] * more, pa.list_(pa.binary())),
                 "top": pa.array([bytes.fromhex(levels[-1][0])] * rung + [None] * (size - rung), pa.binary())}
        for c in ("id", "altered"):
            own = block[c].combine_chunks()
            whole[c] = pa.concat_arrays([own.chunk(0) if isinstance(own, pa.ChunkedArray) else own,
                                         pa.nulls(more, own.type)])
        return pa.table(whole)

    return build


def build_levels(feet: DataFrame, deepest: int, id_type: str, folder: str) -> DataFrame:
    """All node rows above ``feet`` (tree, n, idx, hash, id, altered), stretch by stretch."""
    ship_code(feet.sparkSession)
    stretches, base = [], 0
    while True:
        block = F.expr(f"idx div {SPAN}").alias("block")
        built = stored(feet.groupBy("tree", block).applyInArrow(build_stretch(base), node_schema(id_type)),
                       f"{folder}/level{base}")
        # A stretch's last level is the next one's first, unless it is the tree's root.
        unfinished = (F.col("level") == base + STEP) & (F.col("depth") > F.col("level"))
        stretches.append(built.filter(~unfinished))
        base += STEP
        if base >= deepest:
            return reduce(DataFrame.unionAll, stretches)
        feet = built.filter(unfinished).select("tree", "n", "idx", "hash", "id", "altered")


def build_manifest(docs: DataFrame, columns: Sequence[Column], group_col: str = "source", id_col: str = "doc_id",
                   altered: Sequence[Column] | None = None) -> Manifest:
    """The trees over ``docs``; a leaf is the digest of ``columns``, ``altered`` what a climb starts from."""
    folder = new_run(docs.sparkSession, "merkle")
    id_type = docs.schema[id_col].dataType.simpleString()
    leaf = leaf_text(columns)
    other = leaf_text(altered) if altered is not None else leaf
    hashed = docs.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), digest(leaf).alias("hash"),
                         F.when(other != leaf, digest(other)).alias("altered"))
    # Stored first: range bounds are sampled, and texts should be hashed once.
    rows, runs = numbered(stored(hashed, f"{folder}/leaves"), ["grp"], ["id", "hash"], folder)
    marked, starts = numbered(runs.groupBy("grp").agg(F.sum("n").alias("leaves")), [], ["grp"], f"{folder}/groups")
    groups = stored(marked.join(starts, "part").select((F.col("start") + F.col("at")).alias("tree"), "grp",
                                                       F.col("leaves").alias("n")), f"{folder}/trees")
    trees, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    # The runs learn their tree (a group has at most one run a partition), then each row its run.
    named = runs.drop("n").join(groups, runs["grp"].eqNullSafe(groups["grp"])).select(
        "part", runs["grp"].alias("its_grp"), "start", "tree", "n")
    feet = (rows.join(named, (rows["part"] == named["part"]) & rows["grp"].eqNullSafe(named["its_grp"]))
            .select("tree", "n", (F.col("start") + F.col("at")).alias("idx"), "hash", "id",
                    F.coalesce("altered", "hash").alias("altered")))
    own = build_levels(feet, sum(p < (largest or 0) for p in POWERS), id_type, folder)
    subroots = own.filter(F.col("level") == F.col("depth")).select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"), F.col("tree").alias("idx"), "hash",
        F.lit(None).cast(id_type).alias("id"), F.lit(None).cast("binary").alias("altered"))
    height = sum(p < trees for p in POWERS)
    top = build_levels(subroots, height, id_type, f"{folder}/top")
    root = top.filter((F.col("level") == height) & (F.col("idx") == 0)).select(F.lower(F.hex("hash"))).first()

    rung = ["reach", "lefts", "rights", "top"]
    # An upper rung is stored for each SPAN leaves below it.
    width, slots = power(F.col("level") - STEP), F.ceil(F.col("n") / SPAN)
    upper = spread(own.filter((F.col("level") >= STEP) & F.col("reach").isNotNull()).select("tree", "level", "idx", "n", *rung),
                   F.col("idx") * width, F.least((F.col("idx") + 1) * width, slots) - 1, "slot")
    width = power(F.col("level"))
    over = spread(top.filter(F.col("reach").isNotNull()).select("tree", "level", "idx", *rung),
                  F.col("idx") * width, F.least((F.col("idx") + 1) * width, F.lit(trees)) - 1, "over").drop("tree")
    own_depth = groups.select("tree", "n", depth_of("n").alias("own"))
    beyond = spread(over.withColumnRenamed("over", "tree").join(own_depth, "tree").select(
        "tree", "n", (F.col("level") + F.col("own")).alias("level"), (F.col("reach") + F.col("own")).alias("reach"),
        "lefts", "rights", "top"), F.lit(0).cast("long"), slots - 1, "slot")
    steps = ["tree", "level", "slot", *rung]
    upper, beyond = upper.select(steps), beyond.select(steps)
    ladder = stored(upper.unionByName(beyond), f"{folder}/ladder")
    nodes = own.select("tree", "level", "idx", "hash", "parent").unionByName(
        top.select("tree", "level", "idx", "hash", "parent"))
    leaves = own.filter(F.col("level") == 0)
    return Manifest(nodes, groups, leaves, ladder, height, root[0] if root else None)


FOLD = ("unhex(aggregate(arrays_zip({r}.lefts, {r}.rights), lower(hex({start})), "
        "(h, s) -> sha2(concat(lower(hex(s.lefts)), h, lower(hex(s.rights))), 256)))")
APPEND = "aggregate(arrays_zip({r}.lefts, {r}.rights), {proof}, (p, s) -> concat(p, s.lefts, s.rights))"
OWN_PROOF = "coalesce(" + APPEND.format(r="f", proof="X''") + ", X'')"

CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT f.tree, f.idx div {SPAN} AS slot, max(f.depth) AS depth, max(coalesce(f.reach, 0)) AS level,
    transform(array_sort(collect_list(named_struct('i', f.idx, 'd',
      coalesce({FOLD.format(r="f", start="f.altered")}, f.altered)))), x -> x.d) AS folded,
    X'' AS proof, max(CASE WHEN coalesce(f.reach, 0) = f.depth THEN coalesce(f.top, f.hash) END) AS subroot
  FROM {{leaves}} f GROUP BY f.tree, f.idx div {SPAN}
  UNION ALL
  SELECT c.tree, c.slot, c.depth, r.reach, transform(c.folded, d -> {FOLD.format(r="r", start="d")}),
    {APPEND.format(r="r", proof="c.proof")}, coalesce(c.subroot, CASE WHEN r.reach = c.depth THEN r.top END)
  FROM climb c JOIN {{ladder}} r ON r.tree = c.tree AND r.level = c.level AND r.slot = c.slot
)
SELECT tree, slot, folded, proof, subroot FROM climb WHERE level = depth + {{height}}
"""

ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


@contextmanager
def recursion_over_all_rows(spark: SparkSession):
    """Spark stops recursive queries after a number of rows; this one's are bounded by the leaves."""
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(ROW_LIMIT, before)


def climb(manifest: Manifest) -> DataFrame:
    """One row per leaf: tree, idx, id, hash, subroot, folded (the root it leads to), proof (digests, joined)."""
    spark = manifest.leaves.sparkSession
    with recursion_over_all_rows(spark):
        query = CLIMB.replace("{height}", str(manifest.height))  # the tables are filled in by spark.sql
        found = spark.sql(query, leaves=manifest.leaves, ladder=manifest.ladder)
        up = stored(found, f"{new_run(spark, 'merkle-climb')}/rows")
    own = manifest.leaves.alias("f").select("f.tree", "f.idx", "f.id", "f.hash", F.expr(OWN_PROOF).alias("near"),
                                            F.expr(f"f.idx div {SPAN}").alias("slot"))
    place = (F.col("idx") - F.col("slot") * SPAN).cast("int")
    return own.join(up, ["tree", "slot"]).select("tree", "idx", "id", "hash", "subroot", F.get("folded", place).alias("folded"),
                                                 F.concat("near", "proof").alias("proof"))


def hex_of(name: str) -> Column:
    return F.lower(F.hex(name))


def verified_leaves(manifest: Manifest, id_col: str = "doc_id") -> DataFrame:
    """The climb's digests in hex, and whether each leaf's (altered) digest leads to the root."""
    root = F.lit(manifest.root).cast("string")
    return climb(manifest).select(
        F.col("id").alias(id_col), hex_of("hash").alias("leaf"), hex_of("subroot").alias("subroot"), root.alias("root"),
        F.sha2(hex_of("proof"), 256).alias("proof_sha256"), hex_of("folded").alias("folded_root"),
        (hex_of("folded") == root).alias("verified"))


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return verified_leaves(build_manifest(
        table(spark, sf_dir, "documents"), [F.col(c) for c in COLUMNS],
        altered=[*[F.col(c) for c in COLUMNS[:-1]], text]))


def _sql_leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_SQL_CHOSEN = """list_reduce(list_prepend(4294967295,
      list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) & 1 = 1"""

ORACLE = f"""
WITH RECURSIVE
d AS (SELECT doc_id, source, {_sql_leaf('text')} AS leaf,
        {_sql_leaf(f"(CASE WHEN {_SQL_CHOSEN} THEN replace(text, chr(10), '') ELSE text END)")} AS altered
      FROM documents),
leaves AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
own(tree, level, idx, hash, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (max(n) + 2) // 3
  FROM own WHERE n > 1 GROUP BY tree, level, idx // 3),
top(tree, level, idx, hash, n) AS (
  SELECT CAST(0 AS BIGINT), 0, tree - 1, hash, count(*) OVER () FROM own WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (max(n) + 2) // 3
  FROM top WHERE n > 1 GROUP BY tree, level, idx // 3),
nodes AS (SELECT * FROM own UNION ALL SELECT * FROM top),
runs AS (
  SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.idx),
low(tree, pos, level, idx, h, p) AS (
  SELECT tree, pos, 0, pos, altered, '' FROM leaves
  UNION ALL
  SELECT w.tree, w.pos, w.level + 1, w.idx // 3, sha256(r.l || w.h || r.r), w.p || r.l || r.r
  FROM low w JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.idx = w.idx),
high(tree, pos, level, idx, h, p) AS (
  SELECT w.tree, w.pos, 0, w.tree - 1, w.h, w.p FROM low w JOIN own o ON o.n = 1 AND o.tree = w.tree AND o.level = w.level
  UNION ALL
  SELECT w.tree, w.pos, w.level + 1, w.idx // 3, sha256(r.l || w.h || r.r), w.p || r.l || r.r
  FROM high w JOIN runs r ON r.tree = 0 AND r.level = w.level AND r.idx = w.idx)
SELECT v.doc_id, v.leaf, o.hash AS subroot, t.hash AS root, sha256(w.p) AS proof_sha256, w.h AS folded_root,
  w.h = t.hash AS verified
FROM leaves v JOIN own o ON o.tree = v.tree AND o.n = 1 JOIN top t ON t.n = 1
JOIN high w ON w.tree = v.tree AND w.pos = v.pos AND w.level = t.level
"""

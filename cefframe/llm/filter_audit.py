"""Filter interaction audit: what each filter removes, in every order in which the filters may run.

Spark reduces the documents to counts by part and failure mask (one bit a filter), at most 2^m rows
a part.  For each part a decision diagram over those masks is built: level k tests the k-th filter
of an order, every node has a passing and a failing child, equal nodes of a level are one node, the
terminals are count vectors and every node carries the counts below it.  A step of the order is read
off the path on which all filters pass: the failing child's counts are what that filter removes, the
passing child's what it keeps.  The orders follow each other by swaps of two adjacent levels (plain
changes), and a swap rebuilds these two levels alone.

What a filter fails in all is what it removes when it comes first; what it alone fails is what it
removes when it comes last.

A copy is a document whose text some smaller id has as well, wherever in the table.  Texts are
compared by SHA-256; rows then meet by (digest, id), so a text that a third of all rows share is
spread like any other.

Defined cases: null text counts as empty; a null part is the empty string's part; a null id is
neither smaller nor greater than another, so its row is no copy, makes none, and has no labels; rows
that share an id are counted each, and none of them is a copy of another; labels of one id count as
set if any row sets them; missing labels count as unset; an empty table gives no rows; further
columns, whatever their names, are ignored; a text of any length is judged whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, new_run, ship_code, stored, table, text_or_empty

Counts = tuple[int, ...]


def plain_changes(m: int) -> list[int]:
    """Places k: swapping k and k + 1 in turn leads through all orders of m things."""
    if m < 2:
        return []
    down, up = list(range(m - 2, -1, -1)), list(range(m - 1))
    out: list[int] = []
    for i, inner in enumerate([*plain_changes(m - 1), None]):
        out += up if i % 2 else down
        if inner is not None:
            out.append(inner if i % 2 else inner + 1)
    return out


class Diagram:
    """An ordered diagram over failure masks; ``order[k]`` is the bit that level k tests."""

    def __init__(self, m: int, counts: Mapping[int, Counts]):
        self.order = list(range(m))
        self.zero = tuple(0 for _ in next(iter(counts.values())))
        #: levels[k]: (passing, failing) children by their numbers in level k + 1; the last are terminals.
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(m)]
        self.weights: list[list[Counts]] = [[] for _ in range(m + 1)]
        terminals: dict[Counts, int] = {}
        known: list[dict[tuple[int, int], int]] = [{} for _ in range(m)]

        def node(k: int, below: dict[int, Counts]) -> int:
            if k == m:
                value = below.get(0, self.zero)
                if value not in terminals:
                    terminals[value] = len(terminals)
                    self.weights[m].append(value)
                return terminals[value]
            # Masks lose their lowest bit from level to level.
            children = tuple(node(k + 1, {mask >> 1: c for mask, c in below.items() if mask & 1 == side})
                             for side in (0, 1))
            return self._one(k, children, known[k])

        node(0, dict(counts))

    def _one(self, k: int, children: tuple[int, int], known: dict[tuple[int, int], int]) -> int:
        """The number of the node with these children in level k; equal nodes are one."""
        if children not in known:
            known[children] = len(self.levels[k])
            self.levels[k].append(children)
            a, b = (self.weights[k + 1][c] for c in children)
            self.weights[k].append(tuple(x + y for x, y in zip(a, b)))
        return known[children]

    def swap(self, k: int) -> None:
        """Exchange levels k and k + 1; nodes of level k keep their numbers, counts and parents."""
        old = self.levels[k + 1]
        self.levels[k + 1], self.weights[k + 1] = [], []
        known: dict[tuple[int, int], int] = {}
        crossed = []
        for passing, failing in self.levels[k]:
            (both, second), (first, neither) = old[passing], old[failing]
            crossed.append((self._one(k + 1, (both, first), known), self._one(k + 1, (second, neither), known)))
        self.levels[k] = crossed
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """Along the path where all pass: the filter, what it keeps, what it removes."""
        at = 0
        for k, bit in enumerate(self.order):
            at, failing = self.levels[k][at]
            yield bit, self.weights[k + 1][at], self.weights[k + 1][failing]


def audit_rows(part: str, counts: Mapping[int, Counts], letters: str) -> list[tuple]:
    """All orders of one part; a count vector is (documents, good ones, toxic ones)."""
    m = len(letters)
    diagram = Diagram(m, counts)
    orders = [(list(diagram.order), list(diagram.steps()))]
    for k in plain_changes(m):
        diagram.swap(k)
        orders.append((list(diagram.order), list(diagram.steps())))
    failing, alone, shapley = [0] * m, [0] * m, [0] * m
    for _, steps in orders:
        for k, (bit, _, removed) in enumerate(steps):
            shapley[bit] += removed[0]
            if k == 0:
                failing[bit] = removed[0]
            if k == m - 1:
                alone[bit] = removed[0]
    return [(part, "".join(letters[b] for b in order), k + 1, kept[0], gone[0], failing[bit] - gone[0], alone[bit],
             gone[1], gone[2], shapley[bit])
            for order, steps in orders for k, (bit, kept, gone) in enumerate(steps)]


AUDIT = {"part": "string", "filter_order": "string", "step": "int", "kept": "long", "removed": "long",
         "redundant": "long", "unique_fails": "long", "good_lost": "long", "toxic_lost": "long", "shapley": "long"}


def audit_orders(masks: DataFrame, letters: str) -> DataFrame:
    """The audit of ``part, mask, n, good, toxic`` rows; bit i of a mask is the filter ``letters[i]``."""
    ship_code(masks.sparkSession)

    def one_part(rows: pd.DataFrame) -> pd.DataFrame:
        counts = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in rows.itertuples()}
        return pd.DataFrame(audit_rows(rows["part"].iloc[0], counts, letters), columns=list(AUDIT))

    sums = masks.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])
    return sums.groupBy("part").applyInPandas(one_part, ", ".join(f"{c} {t}" for c, t in AUDIT.items()))


def mask_counts(docs: DataFrame, labels: DataFrame, failures: Mapping[str, Column], copies: str | None = None,
                part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Rows ``part, mask, n, good, toxic``, and the letters of the mask's bits.

    ``failures``: letter -> failure condition on the columns ``text`` (null made empty) and ``words``;
    ``copies``: the letter of the copy filter, if it takes part.
    """
    letters = "".join(failures) + (copies or "")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                        text_or_empty(text_col).alias("text"))
    words = texts.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    bits = [F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(failures.values())]
    judged = words.select("id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"),
                          reduce(Column.bitwiseOR, bits).alias("mask"))
    rows = stored(judged, f"{new_run(docs.sparkSession, 'audit')}/judged")
    # Rows repeated as a whole are counted first; so each (digest, id) is rare from here on.
    each = rows.filter("id IS NOT NULL").groupBy("sha", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    if copies:
        smallest = (rows.filter("id IS NOT NULL").groupBy(F.col("sha").alias("its_sha"))
                    .agg(F.min("id").alias("its_id")))
        each = each.join(smallest, (F.col("sha") == F.col("its_sha")) & (F.col("id") == F.col("its_id")), "left")
        copy = F.when(F.col("its_id").isNull(), F.lit(1 << len(failures))).otherwise(F.lit(0))
        each = each.withColumn("mask", F.col("mask").bitwiseOR(copy))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    marked = each.join(marks, "id", "left").select(
        "part", "mask", "n", *[(F.col("n") * F.coalesce(f"is_{c}", F.lit(0))).alias(c) for c in ("good", "toxic")])
    unnamed = rows.filter("id IS NULL").select("part", "mask", F.lit(1).cast("long").alias("n"),
                                               F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return marked.unionByName(unnamed), letters


def standard_failures() -> dict[str, Column]:
    """A: short; B: repetitive words; C: many capitals; D: special characters."""
    words, distinct, text = F.size("words"), F.size(F.array_distinct("words")), F.col("text")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {"A": words < 200, "B": distinct * 100 < words * 50, "C": capitals * 100 > F.length(text) * 2,
            "D": text.rlike("[#$%&*|]")}


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks, letters = mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                 standard_failures(), copies="E")
    return audit_orders(masks, letters)


ORACLE = r"""
WITH RECURSIVE
t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             min(doc_id) OVER (PARTITION BY text) AS smallest FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
        || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
        || (CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text)
            THEN 'C' ELSE '' END)
        || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
        || (CASE WHEN w.doc_id > smallest THEN 'E' ELSE '' END) AS fails
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
orders(o) AS (SELECT '' UNION ALL
  SELECT o || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x) WHERE NOT contains(o, x)),
steps AS (SELECT o, k, substr(o, k, 1) AS f, substr(o, 1, k - 1) AS before
          FROM orders, (VALUES (1), (2), (3), (4), (5)) v(k) WHERE length(o) = 5),
s AS (
  SELECT part, o, k, f,
    sum(CASE WHEN translate(fails, before || f, '') = fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, steps GROUP BY part, o, k, f)
SELECT part, o AS filter_order, CAST(k AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM s
"""

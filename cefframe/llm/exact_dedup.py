"""Exact de-duplication by skew-safe combining.

Texts are equal when identical after each run of ASCII white space becomes one space.  Three
combining stages, each of which compares the full normalised text (the digest is only the part of
the key that travels further):

1. local: the partial aggregate collapses the copies that one map task sees;
2. salted: rows meet by (digest, salt, text), so a group of copies that holds a third of all rows
   is spread over ``salts`` tasks, each of which names a salt winner;
3. global: at most ``salts`` winners per text meet by (digest, text) and name the row that stays.

The way back follows the same steps: each text's result goes to the salts that hold it (a bit mask
of salts, 64 to a word), and each row looks its answer up by (digest, salt), never by the digest
alone.  A 64-bit hash of the text and its length travel with the digest, so that texts told apart
by content stay apart on the way back as well.

Defined cases: null text counts as empty; an empty table gives an empty result; a null id sorts
after every other id, and a row with a null id stays only if its whole group has none; of fully
tied rows (same id, same text) exactly one stays; further columns are ignored here and kept whole
by :func:`drop_copies`, whatever their names; texts of any length are compared whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, digest_hex, fresh, new_run, quoted, stored, table

#: At least as many salts, in multiples of 64; more where the session has more shuffle partitions.
SALTS, MOST_SALTS = 64, 1024


def normalised(text_col):
    return F.regexp_replace(F.coalesce(text_col, F.lit("")), SPACE, " ")


def bits(mask: str, first: int):
    """The numbers ``first`` + i of the bits i that are set in a long column."""
    return F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(mask, i) == 1), lambda i: i + first)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 salts: int | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = -(-(salts or min(MOST_SALTS, max(SALTS, parts))) // 64)
    rows = (docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
            .withColumn("sha", digest_hex(F.col("text")))
            .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(words * 64)).cast("int")))
    # Stages 1 and 2: the partial and the final half of one aggregate over the full text.
    salted = rows.groupBy("sha", "salt", "text").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    # Stage 3: salt winners meet, again by their full text.
    masks = [F.bit_or(F.when(F.floor(F.col("salt") / 64) == w, F.expr("shiftleft(1L, salt % 64)"))
                      .otherwise(F.lit(0).cast("long"))).alias(f"mask{w}") for w in range(words)]
    winners = salted.groupBy("sha", "text").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"), *masks)
    held = F.concat(*[bits(f"mask{w}", 64 * w) for w in range(words)])
    content = [F.xxhash64("text").alias("check"), F.octet_length("text").alias("bytes")]
    answers = stored(winners.select("sha", *content, "keep_id", "group_size", F.explode(held).alias("salt")),
                     f"{new_run(spark, 'exact')}/answers")
    found = rows.select("id", "sha", "salt", *content).join(answers, ["sha", "salt", "check", "bytes"], "left")
    # Rows tied on id and text are neighbours in their salt's partition: no further shuffle.
    turn = F.row_number().over(Window.partitionBy("sha", "salt", "check", "bytes", "id").orderBy(F.lit(0)))
    return found.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (turn == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.  Ties on id and text leave one row."""
    sha, turn = fresh(docs, "_text_sha", "_turn")
    groups = exact_groups(docs, id_col, text_col)
    # A row goes if its id is not its group's, or if it repeats a row that stays.
    gone = (groups.filter(~F.col(id_col).eqNullSafe(F.col("keep_id")))
            .select(F.col(id_col).alias("gone_id"), F.col("text_sha256").alias("gone_sha")).distinct())
    keyed = docs.withColumn(sha, digest_hex(normalised(F.col(text_col))))
    rest = keyed.join(gone, keyed[id_col].eqNullSafe(gone["gone_id"]) & (keyed[sha] == gone["gone_sha"]), "left_anti")
    one = F.row_number().over(Window.partitionBy(id_col, sha).orderBy(F.lit(0)))
    return rest.withColumn(turn, one).filter(F.col(turn) == 1).select(*map(quoted, docs.columns))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

"""A corpus pipeline of training-data operators: STAGES, run() and its SQL.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet in the shared folder and read again as the next stage's docs.  Every
stage works on all rows that its predecessor kept.  All but the last return the columns of
``documents``; the last returns the encoding of each row of the mix.

Defined cases, as the stages' operators have them: null and empty texts are no near copies, copies of
each other for exact dedup (one stays), and take no words in the mix; null ids sort last in exact
dedup and are no near copies; rows repeated as a whole leave one; rows that share an id are judged by
their texts in exact dedup and are one document in near dedup; the null source is a source of its
own; an empty table gives no rows; extra columns, whatever their names, pass through all stages but
the last; texts of any length count whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cefframe.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from cefframe.llm.common import new_run, stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches their language's threshold go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return near_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.mixed_rows(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each row of the mix."""
    return bpe.encode_decode(docs, bpe.default_tokenizer())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources", mixing_stage),
    ("BPE encoding and decoding", encode_stage),
]

#: SQL cannot train the classifier or encode text: run() is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``."""
    folder = new_run(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"{folder}/{k}")
    return docs

"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before
it kept; what it returns is written as Parquet and read again for the next.
All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.llm import decontaminate, jaccard_join, mixing, pii, quality
from metricloom.llm.common import read_table, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the rules go."""
    return quality.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts (words by five, 0.8 or more) one row stays.

    It is the one with the smallest id. Rows without words are alike to nothing
    and stay.
    """
    return jaccard_join.deduplicated(docs, percent=80, words=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with 5 % or more of their words in benchmark phrases go."""
    judged = decontaminate.judged(docs, read_table(spark, sf_dir, "benchmark"), docs.columns)
    return judged.where(~F.col("contaminated")).select("row.*")


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to surrogates; ``n_chars`` follows."""
    done = pii.pseudonymised(docs)
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return done.select(
        *[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of texts, so that sources have their target weights, shuffled."""
    return mixing.mixed(docs).select("row.*", "copy", "place")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii_surrogates", surrogates),
    ("mixture", mixture),
]

#: Near duplicates and surrogates have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

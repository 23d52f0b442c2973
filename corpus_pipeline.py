"""The corpus pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; ``run`` writes each stage's result as
Parquet in the shared folder and reads it back for the next, so a lost executor repeats one stage at most.

1. quality: rows that the attention classifier scores below 0.7 go. 2. toxicity: rows that the factorization machine scores 0.5
or more go. 3. near_duplicates: one row of each SimHash component stays. 4. decontamination: rows that cover a
benchmark item go. 5. encode: the rest as piece ids (doc_id, ids, n_tokens).

The classifiers learn from the labelled rows of their own input that are not held out. Rows with null columns pass
through the stages as each operator defines; extra columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import merge_dropout, quality_mil, simhash_dedup, string_tiling, toxicity_fm
from ledgerlake.llm.store import small_batches, table, written
from ledgerlake.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    small_batches(spark)
    return quality_mil.keep_good(docs, quality_mil.train_quality(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    small_batches(spark)
    return toxicity_fm.drop_toxic(docs, toxicity_fm.train_toxicity(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    small_batches(spark)
    return simhash_dedup.keep_one_of_each_group(docs, shingle_words=4, max_distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    small_batches(spark)
    return string_tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    small_batches(spark)
    return merge_dropout.encode(docs)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("encode", encode)]

# The trained stages, SimHash, tiling and merge-dropout have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs

"""The registered queries of this package: thin callers of the operators over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import (block_neighbours, html_extract, lattice_lm, license_scan, merge_dropout, orc_tokens, pii_scan, prefix_trie,
               quality_mil, simhash_dedup, string_tiling, toxicity_fm, whitening)
from .oracle import ORACLE_SQL
from .store import small_batches, table


def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_mil.score_quality(docs, quality_mil.train_quality(docs, table(spark, sf_dir, "labels")))


def op2_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicate_report(table(spark, sf_dir, "documents"), shingle_words=4, max_distance=4)


def op3_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.lattice_scores(table(spark, sf_dir, "documents"))


def op5_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.token_digest(table(spark, sf_dir, "documents"))


def op7_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.encode_digest(table(spark, sf_dir, "documents"))


def op8_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_fm.score_toxicity(docs, toxicity_fm.train_toxicity(docs, table(spark, sf_dir, "labels")))


def op9_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_neighbours.nearest_of_every(table(spark, sf_dir, "embeddings"), step=20)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as a file tree: source/language/id."""
    docs = table(spark, sf_dir, "documents")
    files = docs.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text")
    return license_scan.scan(files, license_scan.template_table(spark))


def op11_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_scan.pii_report(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), components=4)


QUERIES = [op1_quality_mil, op2_simhash_ball, op3_html_template, op4_lattice_lm, op5_string_tiling, op6_orc_tokens, op7_merge_dropout,
           op8_toxicity_fm, op9_block_neighbours, op10_license_scan, op11_pii_scan, op12_prefix_trie, op13_whitening]


def _with_package(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _with_package(q) for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)

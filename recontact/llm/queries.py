"""The registered queries of the training-data operators, over whole tables, and SQL for some."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recontact.llm import (
    angular_negatives,
    bpe,
    chat,
    cover_tree,
    fixity,
    lattice,
    line_dedup,
    mixing,
    ngram_join,
    quality,
    reputation,
    simplex_clusters,
    substring,
)
from recontact.llm.common import reachable

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE, BYTE_PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair encoding and decoding of every document."""
    return bpe.digests(table(spark, sf_dir, "documents"), WORD_BPE)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes and numbers of links of every document."""
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents replicated to the target weights, in shuffled order."""
    return mixing.mixed_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", F.col("_copy").alias("copy"), F.col("_at").alias("at"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_text"),
    )


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every embedding."""
    return cover_tree.linked(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document."""
    return quality.judged(table(spark, sf_dir, "documents"))


def op6_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of an archive, and what the audit says of a damaged replica."""
    return fixity.audited_pages(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line runs that came before: of three lines, of ten words, or whole."""
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where runs of one or two lines need fifty words, or are whole documents."""
    return line_dedup.digests(table(spark, sf_dir, "documents"), line_dedup.PASSAGE_WORDS)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and read back from its token ids."""
    turns = chat.with_sample(table(spark, sf_dir, "conversations"))
    return chat.digests(turns, BYTE_BPE, BYTE_PATTERN)


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of words that occur elsewhere."""
    return substring.digests(table(spark, sf_dir, "documents"))


def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    return lattice.scored(table(spark, sf_dir, "documents"), PIECES)


def op11_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's address by rules and host reputation."""
    return reputation.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op12_simplex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after five rounds."""
    return simplex_clusters.clustered(table(spark, sf_dir, "embeddings"))


def op13_angular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding among all of them."""
    return angular_negatives.mined(angular_negatives.relabelled(table(spark, sf_dir, "embeddings")))


_RUNS = [
    op1_bpe,
    op2_ngram_join,
    op3_mixing,
    op4_cover_tree,
    op5_quality,
    op6_fixity,
    op7_line_dedup,
    op7_passage_dedup,
    op8_chat,
    op9_substring,
    op10_lattice,
    op11_reputation,
    op12_simplex,
    op13_angular,
]


def _registered(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return run(spark, os.fspath(sf_dir))

    return query


QUERIES = {run.__name__: _registered(run) for run in _RUNS}
ORACLE = {
    "op3_mixing": mixing.mixing_sql(),
    "op6_fixity": fixity.audit_sql(),
    "op7_line_dedup": line_dedup.digests_sql(),
    "op7_passage_dedup": line_dedup.digests_sql(line_dedup.PASSAGE_WORDS),
    "op11_reputation": reputation.judged_sql(),
    "op12_simplex": simplex_clusters.clustered_sql(),
    "op13_angular": angular_negatives.mined_sql(),
}

"""From raw documents to token ids: rules, line dedup, near-duplicate join, mixing, encoding."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recontact.llm import bpe, line_dedup, mixing, ngram_join, quality
from recontact.llm.common import reachable
from recontact.llm.queries import WORD_BPE
from recontact.sources.storage import written_once


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their posterior keep."""
    reachable(spark)
    return quality.keep_good(docs)


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line runs that came before: of three lines, of fifty words, or whole documents.
    Those that consist of them by four fifths of their words go. Shorter single lines stay, as cutting
    them would hide near copies from the next stage."""
    reachable(spark)
    return line_dedup.without_repeats(docs, min_words=line_dedup.PASSAGE_WORDS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    reachable(spark)
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks, in shuffled order."""
    reachable(spark)
    return mixing.mixed_sources(docs).select(*docs.columns)


def in_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``part`` and ``row``, their place in the files of a written stage; null for rows that
    come from elsewhere. Readers pack files by size, so these alone keep the order and tell copies apart."""
    place = ("_metadata.file_name", "_metadata.row_index")
    try:
        return docs.select("*", F.col(place[0]).alias("part"), F.col(place[1]).alias("row"))
    except AnalysisException:
        return docs.select("*", F.lit(None).cast("string").alias("part"), F.lit(None).cast("long").alias("row"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, the text they decode to, and its place ``part``, ``row`` in the mix."""
    reachable(spark)
    ids = bpe.encoded(in_order(docs.select("doc_id", "source", "text")), WORD_BPE).drop("text")
    return bpe.decoded(ids, WORD_BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_runs),
    ("ngram_join", near_duplicates),
    ("mixing", mix),
    ("bpe", encode),
]
ORACLE_SQL = None  # encoding is not expressible; tests hold each stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if i + 1 < len(STAGES):
            rows = written_once(rows, name)
    return rows

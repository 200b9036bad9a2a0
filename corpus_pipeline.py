"""From raw documents to a training mix: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareflow.llm import decontam, lines, mixing, quality, setjoin
from fareflow.llm.common import stored, table
from fareflow.session import prepare


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur, or nearly occur, earlier; those left without text go."""
    return lines.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return setjoin.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words each document gives to the mix."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [("quality", good_quality), ("lines", line_dedup), ("near duplicates", near_dedup),
          ("decontamination", decontaminate), ("mix", mix_sources)]

# SQL can state neither the classifier's factorisation nor the dual's iteration.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder and reread."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs

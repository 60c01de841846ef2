"""A corpus pipeline: identify languages, drop poor texts, drop near duplicates, pack what stays into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerq.llm import language_id, order_minhash, packing, quality_model
from ledgerq.llm.common import cut, prepare, table


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages, whichever of those that resemble each other.

    Null texts and texts without a letter go, and texts whose best language codes them no shorter than its letters
    alone: those in no learned language, and those that mix several.
    """
    prepare(spark)
    return language_id.keep_identified(docs, language_id.learn(docs), least=0.0, by_context=True)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier scores 0.5 or more, learned from those of them that are labelled and not held out."""
    return quality_model.keep_good(docs, quality_model.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    prepare(spark)
    return order_minhash.distinct_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence.

    The Python workers still hold what the stages before keep, so packing keeps less than by itself.
    """
    prepare(spark)
    return packing.pack(docs, room=40 << 20)


STAGES = [("language_id", languages), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", packed)]
#: Trained models and alignments have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-corpus pipeline over ``documents``: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dimloom.llm import bpe, decontaminate, disclosure, jaccard, toxicity
from dimloom.llm.common import cut, table

#: Rows that Spark hands to Python at once: 10,000 whole texts, its default, take some 30 MB and more on either side of each task.
BATCH_ROWS = 1_000


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage under ``BATCH_ROWS``, which stays set in the session, because a stage's rows are computed after it returns."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model, learned from all labelled ones among ``docs``, scores as toxic go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))


@in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash links confirmed by five-word shingles (Jaccard similarity of 0.8 or more),
    and the pairs of that similarity that fingerprints cannot tell."""
    return jaccard.keep_one(docs, size=5, least=0.8)


@in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return decontaminate.drop_documents(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away are replaced in ``text``; every document stays."""
    return disclosure.sanitise(docs)


@in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed, and as digests) of every document, and a digest of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True, forget=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("pii", sanitise),
    ("bpe", encode),
]

#: The first stage learns a model; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over ``documents``.  Every stage reads its input more than once, so it is computed once and kept."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

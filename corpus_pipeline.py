"""Training-data pipeline over ``documents``: junk and toxic documents go, one document
of each near-duplicate group stays, benchmark passages are cut out, and what is left
is packed into sequences of tokens.

Every stage gets all that its predecessor kept, as a Parquet table in the shared
folder, so a lost executor costs the tasks it held and no more.

Defined results: a null text is the empty one in every stage: it is kept by the classifier
(its weight is zero), forms one near-duplicate group with all texts without a word,
has nothing to cut out and is packed as its end id.  A row with a null id goes through
like any other; within a group ids come before nulls and the smallest id stays, and of rows
that share id and text one.  Very long texts are read whole.  An empty table gives empty
stages.  All stages but the last return the columns of their input, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duescore.llm.common import staged, table
from duescore.llm.decontaminate import decontaminated
from duescore.llm.packing import packed
from duescore.llm.quality import resampled
from duescore.llm.simhash import simhash_dedup


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample keeps, classifier fitted on ``labels``."""
    return resampled(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, at most 3 bits)."""
    return simhash_dedup(docs, shingle=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without spans of benchmark windows; those mostly made of them go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of at most 2,048 tokens."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Fingerprints, token ids and sampling have no SQL; tests/llm checks each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents to a training mix, in five stages.

Each stage takes what its predecessor kept, all but the last return the columns of
``documents``.  ``run`` writes each stage's rows to the shared scratch folder and reads
them back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import read, stage
from strata.llm.decontam import remove_contaminated
from strata.llm.jaccard import keep_one_each
from strata.llm.mixing import mix_result
from strata.llm.secrets import redact
from strata.llm.toxicity import remove_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the restored-text classifier rejects go."""
    return remove_toxic(docs, read(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret is replaced by its kind; n_chars follows the text."""
    return redact(docs, length="n_chars")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each kept document the mix takes."""
    return mix_result(docs)


STAGES = [
    ("toxicity", toxicity),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
]

#: Training, restoring and mixing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

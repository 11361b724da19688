"""A corpus cleaning pipeline over ``documents``: five stages, each one operator of logwarden.llm.

Every stage works on all that its predecessor kept, and what it drops is gone:

1. toxicity: documents with a toxicity score of 0.5 or more go;
2. exact_dedup: of equal texts (white space aside) one document stays;
3. near_dedup: of documents linked by a Jaccard similarity of 0.8 or more over five-word shingles,
   the one with the least doc_id stays;
4. decontamination: documents that hold a benchmark passage go;
5. sentencepiece: the rest is encoded, with a check that it decodes to the very text.

Missing and empty texts pass the first stage and are copies of each other in the second; an empty
table stays empty; columns that documents has beyond its usual ones are kept up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logwarden.llm import decontaminate, exact_dedup, near_dedup, sentencepiece_codec, toxicity
from logwarden.llm.common import table
from logwarden.operators.durable import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: No SQL can fit the toxicity model or encode; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage before it kept. All but the last return the
columns of documents; each result is written as Parquet in the shared folder and reread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wherry.llm import mixing, packing, quality_classifier, quality_rules, simhash_groups
from wherry.llm.common import documents, table
from wherry.llm.queries import PACKING_VOCABULARY
from wherry.session import materialize


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy keeps."""
    return quality_rules.filter_documents(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is high enough.

    The model is fitted on labelled rows of the whole documents table: those that the rules rejected are its lowest grade.
    """
    model = quality_classifier.train(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return quality_classifier.filter_documents(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash links, confirmed by four fifths of the five-word shingles."""
    return simhash_groups.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix: what it takes twice stands twice, what it leaves out is gone."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.pack_documents(docs, PACKING_VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the classifier, 64-bit hashing and tokenization; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

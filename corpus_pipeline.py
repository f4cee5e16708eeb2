"""A training corpus from raw documents: classify, rule, deduplicate, mix and pack.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and hands the reread table on. All but the last stage return the
columns of ``documents``. Stages handle nulls, empty and repeated rows as their operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trialmill.llm.compression import keep_by_rules
from trialmill.llm.gam import keep_good
from trialmill.llm.jaccard_join import one_of_each
from trialmill.llm.mixing import mixed_documents
from trialmill.llm.packing import packed
from trialmill.llm.store import saved


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model predicts to be good; it learns from ``labels``."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and the compression bands."""
    return keep_by_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8 or more."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights: documents are cut or repeated as the mix takes their words."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048; one row per piece, with its token ids."""
    return packed(docs, with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: The stages learn a model, compress, hash and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read back as the next stage's documents. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from appraise.llm.common import cut, documents
from appraise.llm.exact_dedup import drop_copies
from appraise.llm.mixing import mixed_documents
from appraise.llm.packing import pack
from appraise.llm.quality import keep_good
from appraise.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: a document is listed as often as it is taken."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixing", mixing), ("packing", packing)]
ORACLE_SQL = None       # fingerprints, flow and tokens are outside SQL; tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

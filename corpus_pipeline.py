"""A corpus from raw documents to packed sequences: each stage is one operator, written and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tariffmart.llm.common import given, written
from tariffmart.llm.language import language_model, with_known_language
from tariffmart.llm.mixing import mix
from tariffmart.llm.packing import pack
from tariffmart.llm.similar import one_of_each
from tariffmart.llm.toxicity import fit_toxicity, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more go."""
    return without_toxic(docs, fit_toxicity(docs, given(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language the network cannot tell, go."""
    return with_known_language(docs, language_model(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links at Jaccard 0.8 over five words join, the one of smallest id stays."""
    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and the documents of light sources up to twice, towards an entropy of 0.98 of the sources."""
    return mix(docs, budget_share=None, target_entropy=0.98, most_repeats=2.0).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

#: The classifier, the network and the tokenizer cannot be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

"""The corpus pipeline: from documents to packed sequences, in five stages.

Each stage works on all that the one before it kept. Its result is written as
Parquet in the shared folder and read again, so a lost executor costs no more than one stage.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftstats.llm import mixing, ngram_join, packing, pii, quality_classifier
from draftstats.llm.common import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels.filter(~quality_classifier.held_out(F.col("doc_id"))))
    return quality_classifier.keep_good(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: five words, similarity of 0.8."""
    return ngram_join.one_of_each(docs, ngram_join.Similarity(n=5, percent=80))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    pieces = packing.pieces(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return packing.pack(pieces)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good),
    ("n-gram Jaccard join", distinct),
    ("personal data", without_personal_data),
    ("source mixing", mixed),
    ("best-fit packing", packed),
]

#: Fitting a model, connected components and packing by search have no SQL; the tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

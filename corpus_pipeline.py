"""From raw documents to token digests: five stages, each one operator of ``wardline.llm``.

A stage takes (session, documents, folder of the tables) and gives a DataFrame;
it is written as Parquet and read again as the next stage's documents.  All but
the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import bpe, exact_dedup, mixing, quality, simhash
from wardline.llm.common import fresh, materialise, read


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (score of at least 0.5); held-out labels are never learnt."""
    score = fresh(docs, "__score")
    scored = quality.classify(docs, read(spark, sf_dir, "labels"), name=score)
    return scored.where(F.col(score) >= 0.5).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, at most 4 differing bits), the one with the smallest doc_id."""
    return simhash.drop_near_copies(docs, n=4, distance=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, each once per pass (at most twice): 150% of all words, sources weighing 5, 2, 1 in turn."""
    return mixing.mixed_rows(docs, weights=(5, 2, 1), share=1.5, passes=2)


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of the ids and of the bytes decoded from them."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", token_digests),
]

ORACLE_SQL = None  # the classifier can't be stated in SQL; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline over ``documents``: each stage calls one operator, is written as Parquet and read by the next.

Edge cases, in all stages: null texts count as empty; missing languages and sources are values like any other; rows
without doc_id are kept by the classifier's score, count after all others among exact copies, and never are near copies;
repeated rows are exact copies; an empty table stays empty; columns of any names pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftwork.llm.exact_dedup import drop_exact_copies
from siftwork.llm.mixing import mixture
from siftwork.llm.ngram_join import drop_near_copies
from siftwork.llm.packing import pack
from siftwork.llm.quality import drop_rejected
from siftwork.llm.queries import TOKENIZER, mixture_of
from siftwork.session import staged

#: Near copies: sets of five-word shingles with a Jaccard similarity of at least 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go; it learns from those that are there."""
    return drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links reach, the document with the smallest doc_id stays."""
    return drop_near_copies(docs, NEAR_WORDS, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixture(docs, **mixture_of())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return pack(docs, **TOKENIZER)


STAGES = [("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mix_sources", mix_sources), ("packing", packing)]

#: The stages train models and pack sequences, which SQL cannot express; the tests hold each stage after the first against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs

"""A training-data pipeline over documents: quality, exact and near duplicates, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.bpe import encode_decode
from corpusloom.llm.exact_dedup import drop_duplicates
from corpusloom.llm.mixing import mix
from corpusloom.llm.ngram_join import drop_near_duplicates
from corpusloom.llm.quality import keep_good
from corpusloom.llm.shared import cut, documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a Jaccard similarity of 0.8 or more."""
    return drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources come near their target weights."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mixed), ("tokens", tokens)]
#: The classifier's weights come from training, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"stage-{name}")
    return docs

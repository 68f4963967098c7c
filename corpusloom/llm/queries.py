"""The queries of this subpackage: each operator over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import exact_dedup, mixing, pii, secrets, url_filter
from corpusloom.llm.bpe import encode_decode
from corpusloom.llm.language_id import fit, predict_languages
from corpusloom.llm.media import media_features
from corpusloom.llm.ngram_join import link_documents
from corpusloom.llm.pii import find_personal, personal_digests
from corpusloom.llm.quality import score_quality
from corpusloom.llm.secrets import scan_secrets, secret_digests
from corpusloom.llm.shared import documents

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = media_features(documents(spark, sf_dir))
    feature = F.concat_ws(":", "n_frames", F.size("segments"), F.sha2("tensors", 256), F.sha2(F.to_json("segments"), 256))
    return media.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature")
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(documents(spark, sf_dir), TOKENIZER)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(documents(spark, sf_dir), words=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(scan_secrets(documents(spark, sf_dir)))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_digests(find_personal(documents(spark, sf_dir)))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict_languages(docs, fit(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    named = (op1_media, op2_bpe, op3_mixing, op4_ngram_join, op5_secrets, op6_pii, op7_exact_dedup, op8_quality, op9_url_filter, op10_language_id)
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": mixing.SQL, "op5_secrets": secrets.SQL, "op6_pii": pii.SQL, "op7_exact_dedup": exact_dedup.SQL, "op9_url_filter": url_filter.SQL}

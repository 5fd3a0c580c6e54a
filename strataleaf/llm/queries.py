"""The queries of this subpackage over the given tables, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, language, licenses, mixing, ngrams, pivots, secrets, sharding, tokenbin, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenbin.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.classify(docs, language.fit(docs))


def op5_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_ngram_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.components(_table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_url_filter, op3_token_file, op4_language_id, op5_vector_links, op6_ngram_components, op7_license_scan, op8_source_mix, op9_byte_shards, op10_decontaminate)}
SQL: dict[str, str] = {"op2_url_filter": urlfilter.SQL, "op7_license_scan": licenses.sql()}

"""The operators' queries, with production parameters, over the whole of their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from domloom.llm import decontaminate, licenses, merkle, minhash, packing, periodic, permutation, repeats, sharding, simhash, tokens, toxicity, urls
from domloom.llm.common import table
from domloom.llm.oracles import ORACLES  # noqa: F401


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_counted(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.rate(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_shards(table(spark, sf_dir, "documents"), 40)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(table(spark, sf_dir, "documents"), 85)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(table(spark, sf_dir, "documents"))


def op13_permutation_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_repeated_passages, op2_url_filter, op3_token_counts, op4_license_scan, op5_best_fit_packing, op6_toxicity, op7_byte_shards, op8_simhash, op9_benchmark_leaks, op10_minhash_components, op11_periodic_runs, op12_merkle_manifest, op13_permutation_neighbours)}

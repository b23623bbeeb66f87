"""Registered queries of the training-data operators, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import (ball_hashing, decontaminate, jaccard, kmeans, langid, license_scan, mixing, quality, ranked_search, simhash,
                            suffix_dedup, toxicity, url_filter)
from palimpsest.llm.common import table


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.with_license_lines(license_scan.scan_licenses(table(spark, sf_dir, "documents"))).drop("text")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"), length=400)


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.cluster_vectors(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dim=64)


def op13_simhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_hashing.near_copies(table(spark, sf_dir, "documents"), radius=4, k=4)


QUERIES = {f.__name__: f for f in (op1_source_mix, op2_url_filter, op3_license_scan, op4_decontaminate, op5_fingerprints, op6_quality, op7_suffix_dedup, op8_jaccard, op9_langid, op10_toxicity,
                                  op11_ranked_search, op12_centroid_clusters, op13_simhash_near_copies)}
ORACLE_SQL = {"op1_source_mix": mixing.ORACLE_SQL, "op2_url_filter": url_filter.ORACLE_SQL,
              "op3_license_scan": license_scan.ORACLE_SQL, "op11_ranked_search": ranked_search.ORACLE_SQL,
              "op12_centroid_clusters": kmeans.ORACLE_SQL}

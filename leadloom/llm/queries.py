"""One query per operator of this package, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm import (
    centroids,
    decontaminate,
    html,
    language,
    lm,
    periodic,
    quality,
    toxicity,
    urls,
)
from leadloom.llm.fingerprint import edited_neighbours
from leadloom.llm.mixing import contributions
from leadloom.llm.shared import table
from leadloom.llm.sharding import shards
from leadloom.llm.simhash import near_duplicates


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop(
        "similarities"
    )


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributions(table(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_decontamination": op2_decontamination,
    "op3_html": op3_html,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_toxicity": op6_toxicity,
    "op7_language_model": op7_language_model,
    "op8_mixing": op8_mixing,
    "op9_urls": op9_urls,
    "op10_simhash": op10_simhash,
    "op11_centroids": op11_centroids,
    "op12_sharding": op12_sharding,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op9_urls": urls.oracle(),
    "op11_centroids": centroids.oracle(),
}

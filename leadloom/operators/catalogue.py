"""The question catalogue: which questions an API has and which rules their answers obey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import flag, key


def question_catalogue(
    question_group_h: DataFrame,
    question_group_d: DataFrame,
    question_list: DataFrame,
    question_label: DataFrame,
    active_only: bool = False,
) -> DataFrame:
    """One row per question of every API; `active_only` drops inactive groups and questions."""
    if active_only:
        question_group_h = question_group_h.filter("is_active = 1")
        question_list = question_list.filter("is_active = 1")
    return (
        question_group_d.join(question_group_h, "group_h_id")
        .join(
            question_list.withColumn("identifier_key", key("question_identifier")).drop(
                "question_identifier"
            ),
            key("question_identifier") == F.col("identifier_key"),
        )
        .join(question_label, "label_id")
        .select(
            "questiongroup_name",
            "question_api",
            "question_code",
            "sequence",
            "answer_type",
            "lov",
            "is_mandatory",
            "response_date",
            "response_numeric",
            "max_length",
        )
    )


def rule_catalogue(catalogue: DataFrame, api: str | None = None) -> DataFrame:
    """Rules per API and question code, for one API or for all."""
    if api is not None:
        catalogue = catalogue.filter(key("questiongroup_name") == api.rstrip().lower())
    return catalogue.select(
        "questiongroup_name",
        "question_code",
        "question_api",
        flag(F.col("is_mandatory") == 1).alias("is_mandatory"),
        _filled("response_date").alias("is_date"),
        _filled("response_numeric").alias("is_numeric"),
        "max_length",
        flag(key("answer_type") == "expression").alias("is_expression"),
        F.when(key("answer_type") == "expression", F.col("lov")).alias("lov"),
    )


def answer_rules(catalogue: DataFrame) -> DataFrame:
    """Per API one map from member name to its questions with their rules.

    Its size is that of the metadata: one entry per catalogue row. A rule belongs to the
    question code, so two questions with one code share their rules.
    """
    named = catalogue.dropna(subset=["questiongroup_name", "question_api", "question_code"])
    rules = rule_catalogue(named).withColumns(
        {
            "api_key": key("questiongroup_name"),
            "name_key": key("question_api"),
            "code_key": key("question_code"),
        }
    )
    by_code = rules.groupBy("api_key", "code_key").agg(
        F.max("is_mandatory").alias("is_mandatory"),
        F.max("is_date").alias("is_date"),
        F.max("is_numeric").alias("is_numeric"),
        F.min("max_length").alias("max_length"),
    )
    question = F.struct(
        "question_code", "question_api", "is_mandatory", "is_date", "is_numeric", "max_length"
    )
    return (
        rules.select("api_key", "name_key", "code_key", "question_code", "question_api")
        .join(by_code, ["api_key", "code_key"])
        .groupBy("api_key", "name_key")
        .agg(F.array_sort(F.collect_list(question)).alias("asked"))
        .groupBy("api_key")
        .agg(F.map_from_entries(F.collect_list(F.struct("name_key", "asked"))).alias("questions"))
    )


def _filled(column: str):
    return F.length(F.rtrim(F.coalesce(F.col(column), F.lit("")))) > 0

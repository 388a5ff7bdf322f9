"""From raw documents to a training mix: five stages over `documents`, each by one operator.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the
last return the columns of `documents`; the last returns what each document gives to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import decontaminate, language, mixing, quality
from leadloom.llm.shared import table
from leadloom.llm.simhash import near_duplicates
from leadloom.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text stays if one language has at least this share of the decoded likelihood.
LEAST_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and texts in no clear language, go; a missing `lang` is filled."""
    docs = docs.select(*COLUMNS)
    found = language.predict(docs, language.fit(docs))
    kept = found.where(
        (F.col("_lang") != language.UNKNOWN) & (F.col("_score") >= LEAST_LANGUAGE_SCORE)
    )
    return kept.withColumn("lang", F.coalesce("lang", "_lang")).select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier takes for bad ones go. It learns from all labels here."""
    docs = docs.select(*COLUMNS)
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(*quality.training_rows(docs, labels, 1, -1, quality.SAMPLE))
    return quality.predict(docs, model).where("_quality >= 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once."""
    rows = docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id())
    rows = materialise(rows, "dedup-rows")
    groups = near_duplicates(rows, id_col="_row").select(
        F.col("doc_id").alias("_row"), "component_id"
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row")))
    named = groups.join(rows.select("_row", "doc_id"), "_row")
    kept = named.groupBy("component_id").agg(first.alias("first")).select(F.col("first._row"))
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document stand in the mix."""
    return mixing.contributions(docs)


STAGES = [
    ("language", identify_language),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Fingerprints, classifiers and the hash order of the mix have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs

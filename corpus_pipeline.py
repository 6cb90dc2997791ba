"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, mixing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet and read
again. ``run`` deletes the tables that a stage has made on its way once its result is written.

Edge cases, stage by stage (and see the operators' docstrings)
    quality_rules       null, empty and short texts go (fewer than 50 words); null lang or source is a group of its own
    near_duplicates     null doc_id: kept, takes no part; of rows that repeat a doc_id the one with the smallest text stays
    decontamination     null or empty benchmark: all stay; null text: stays
    personal_data       null text stays null, its n_chars too
    source_mix          null source is a source; texts without a word go, as nothing of them can be taken
    Repeated rows without a doc_id stay apart. Very long texts are read whole in every stage. Ties are decided as in the operators, alike
    in every run. An empty table gives an empty result. All but the last stage return the five columns of ``documents``; further
    columns of the input are left out at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontam, mixing, neardup, pii, quality
from corpusmill.llm.common import materialise, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep."""
    return quality.keep(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return neardup.keep(docs.select(*COLUMNS), width=5, threshold=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't contaminate."""
    return decontam.keep(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data and secrets replaced; n_chars is the new text's length."""
    return pii.sanitise(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target, taken (words, repeats counted) and copies (times to be read)."""
    return mixing.lay_out(docs.select(*COLUMNS))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("source_mix", source_mix)]

#: SQL can't express the outlier estimate, the signatures or the disclosure scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark):
        for k, (_, stage) in enumerate(STAGES):
            with scratch(spark):
                # the last stage's table outlives both blocks
                docs = materialise(stage(spark, docs, sf_dir), outlives=1 + (k == len(STAGES) - 1))
    return docs

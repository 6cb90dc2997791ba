"""Resumable processing over a manifest: an append log of (id, processed), whose last record per id holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MANIFEST


def state(log: DataFrame, order: str) -> DataFrame:
    """id and its last processed flag (missing: false)."""
    return log.groupBy("id").agg(F.max_by(F.coalesce("processed", F.lit(False)), order).alias("processed"))


def pending(items: DataFrame, log: DataFrame, order: str) -> DataFrame:
    """Items that the manifest doesn't have as processed."""
    return items.join(state(log, order).filter("processed").select("id"), "id", "left_anti")


def counts(log: DataFrame, order: str) -> DataFrame:
    return state(log, order).agg(F.count(F.lit(1)).alias("total"), F.count_if("processed").alias("processed"))


def outcomes(items: DataFrame) -> DataFrame:
    """Run counters over a column outcome: processed, skipped, failed."""
    return items.agg(*[F.count_if(F.col("outcome") == k).alias(k) for k in ("processed", "skipped", "failed")])


def append(finished: DataFrame, path: str, dataset: str, split: str = "train", shard: str = "") -> None:
    """Add a line for each processed item of a run (source_id, outcome) to the log: a folder of JSON lines."""
    lines = finished.filter("outcome = 'processed'").select(F.col("source_id").alias("id"), F.lit(dataset).alias("dataset"), F.lit(split).alias("split"), F.lit(True).alias("processed"), F.lit(shard).alias("output_shard"))
    lines.write.mode("append").json(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The log with ``ord``: later files come after earlier ones, lines of a file in order. Lines without an id raise."""
    rows = spark.read.schema(MANIFEST).json(path, mode="FAILFAST").select("*", F.struct(F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")).alias("ord"))
    return rows.withColumn("id", F.coalesce("id", F.raise_error(F.lit("a line of the manifest has no id"))))

"""Whole runs over folders of JSON lines: merge tiers into one corpus, split files for validation."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus, sampling, validate
from ..operators.tables import delete, materialise, scratch
from ..sources import readers, sinks

ENDING = ".jsonl"


def _tail(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def jsonl_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """tier_ord, tier, stem and path of the JSON-lines files (or folders of part files) of each folder; names are few and listed on the driver."""
    rows = [(k, _tail(d), n.removesuffix(ENDING), f"{d.rstrip('/')}/{n}") for k, d in enumerate(folders) for n in readers.names_in(spark, d) if n.endswith(ENDING)]
    return spark.createDataFrame(rows, "tier_ord int, tier string, stem string, path string")


def samples_of(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The samples of such files with tier_ord, tier, stem and file_ord (files of a tier by name), file and line_no."""
    named = files.collect()
    if not named:
        return spark.createDataFrame([], readers.SAMPLE).selectExpr("0 AS tier_ord", "'' AS tier", "'' AS stem", "0 AS file_ord", "'' AS file", "0L AS line_no", "*")
    plain = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^(file:)?/+", "/")
    order = {p: k for k, p in enumerate(sorted((r["tier_ord"], r["stem"]) for r in named))}
    known = spark.createDataFrame([(r["tier_ord"], r["tier"], r["stem"], order[r["tier_ord"], r["stem"]], r["path"]) for r in named], "tier_ord int, tier string, stem string, file_ord int, path string").withColumn("at", plain(F.col("path"))).drop("path")
    rows = readers.jsonl(spark, [r["path"] for r in named])
    at = F.regexp_replace(plain(F.col("file")), rf"(\{ENDING})/[^/]*$", "$1")
    return rows.withColumn("at", at).join(F.broadcast(known), "at").drop("at").select("tier_ord", "tier", "stem", "file_ord", "file", "line_no", *readers.SAMPLE.fieldNames())


def merge(spark: SparkSession, tiers: list[str]) -> tuple[DataFrame, DataFrame]:
    """Valid samples of all tiers in order (files that a split has replaced are left out), and the errors (id, tier, errors) of the others."""
    files = jsonl_files(spark, tiers)
    used = files.join(corpus.source_files(files.select("tier_ord", "stem").withColumnRenamed("tier_ord", "tier")).withColumnRenamed("tier", "tier_ord"), ["tier_ord", "stem"], "left_semi")
    judged = materialise(validate.with_errors(samples_of(spark, used)))
    bad = judged.filter(F.size("errors") > 0).select(F.coalesce("id", F.lit("?")).alias("id"), "tier", "errors")
    return judged.filter(F.size("errors") == 0).drop("errors"), bad


def merge_and_package(spark: SparkSession, tiers: list[str], out: str, tar_shards: bool = False) -> dict:
    """Write dataset.jsonl (first sample of each id, in order), stats.json, and with ``tar_shards`` each tier's images; returns the statistics."""
    with scratch(spark):
        valid, bad = merge(spark, tiers)
        first = materialise(corpus.keep_first(valid, ["id"], [*corpus.ORDER[:2], "file", "line_no"]))
        sinks.write_jsonl(first.orderBy(*corpus.ORDER[:2], "file", "line_no"), f"{out}/dataset.jsonl")
        stats = sinks.report(first, f"{out}/stats.json", bad.count(), corpus.duplicate_ids(valid).count())
        for tier in tiers if tar_shards else ():
            if readers.exists(spark, f"{tier}/images"):
                sinks.write_folder_shards(spark, f"{tier}/images", out, f"{_tail(tier)}_images")
    return stats


def split_all(spark: SparkSession, folder: str, fraction: float = 0.03, seed: int = 42) -> DataFrame:
    """Write <stem>_train.jsonl and <stem>_val_internal.jsonl for each file that isn't split yet; file, total, train and val of each.

    All files are read once, split and written by one job, a partition for each output, which then get their names; quotas are by
    dataset and task within a file.
    """
    files = corpus.unsplit_files(jsonl_files(spark, [folder]))
    rows = samples_of(spark, files).withColumn("key", F.concat_ws(":", "id", "file", F.col("line_no").cast("string")))
    marked = materialise(sampling.validation_split(rows, ["stem", "dataset", "task"], "key", fraction, seed))
    staging = f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    try:
        # the split stays a field of the lines, so the outputs are dealt by a copy of it
        marked.select("stem", F.col("split").alias("part"), sinks.json_line().alias("value")).write.partitionBy("stem", "part").text(staging)
        for at_stem in readers.names_in(spark, staging):
            for at_part in readers.names_in(spark, f"{staging}/{at_stem}") if at_stem.startswith("stem=") else ():
                stem, part = (unquote(x.partition("=")[2]) for x in (at_stem, at_part))
                sinks.rename(spark, f"{staging}/{at_stem}/{at_part}", f"{folder}/{stem}_{part}{ENDING}")
    finally:
        delete(spark, staging)
    counts = marked.groupBy("stem").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val_internal").alias("val"))
    return files.select("stem").join(counts, "stem", "left").select(F.concat("stem", F.lit(ENDING)).alias("file"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "train", "val")])

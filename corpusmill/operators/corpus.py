"""Corpus assembly: union of tiers, supersession of split files, keep-first, statistics, shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ORDER = ["tier_ord", "file_ord", "line_no"]
GROUPS = ("dataset", "task", "pair_type", "modality", "split")


def union_tiers(tiers: list[DataFrame]) -> DataFrame:
    """UNION ALL in argument order, with the tier's place as tier_ord."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("tier_ord", F.lit(k)) for k, t in enumerate(tiers)])


def source_files(files: DataFrame) -> DataFrame:
    """Drop a bare stem where its ``_train`` file is there; files: tier, stem."""
    bases = files.filter(F.endswith("stem", F.lit("_train"))).select("tier", F.expr("substring(stem, 1, length(stem) - 6)").alias("stem"))
    return files.join(bases, ["tier", "stem"], "left_anti")


def unsplit_files(files: DataFrame) -> DataFrame:
    """Files that no earlier split has made."""
    return files.filter(~F.col("stem").contains("_train") & ~F.col("stem").contains("_val"))


def duplicate_ids(samples: DataFrame) -> DataFrame:
    """Ids with their count if over one; a missing id is the empty one."""
    return samples.groupBy(F.coalesce("id", F.lit("")).alias("id")).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def keep_first(samples: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order.

    By min_by, which combines on the map side: a key that holds a third of all rows is no hot task.
    """
    keys = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}") for i, k in enumerate(key)]
    row = F.struct(*[F.col(c) for c in samples.columns])
    best = samples.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("r"))
    return best.select("r.*")


def grouped_counts(samples: DataFrame, fields: tuple[str, ...] = GROUPS) -> DataFrame:
    """field, value, count for every field, in one pass; a missing value is ``?``. The total is the field ``total``."""
    filled = samples.select(*[F.coalesce(f, F.lit("?")).alias(f) for f in fields])
    pairs = F.array(F.struct(F.lit("total").alias("field"), F.lit("").alias("value")), *[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    return filled.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.value").agg(F.count(F.lit(1)).alias("count"))


def percent_text(part: Column, total: Column) -> Column:
    """``h/n (p%)`` with one decimal, half to even on the exact tenth; 0 without rows."""
    tenths = F.bround(part * 1000 / F.greatest(total, F.lit(1)), 0).cast("long")
    return F.concat(part.cast("string"), F.lit("/"), total.cast("string"), F.lit(" ("), F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%)"))


def coverage(samples: DataFrame) -> DataFrame:
    """total, single and paired (by the number of images), with_bbox (not null) and the coverage text."""
    n = F.when(F.col("image_path").isNotNull(), F.size("image_path")).otherwise(0)
    sums = samples.agg(F.count(F.lit(1)).alias("total"), F.count_if(n == 1).alias("single"), F.count_if(n == 2).alias("paired"), F.count_if(F.col("bbox").isNotNull()).alias("with_bbox"))
    return sums.withColumn("bbox_coverage", percent_text(F.col("with_bbox"), F.col("total")))


def shard_assign(files: DataFrame, order: list[str], capacity: int = 2000, slices: int = 64) -> DataFrame:
    """shard (from 0) and place in it, in the given order, without sorting all files in one task.

    The order is range-partitioned; counts per partition give each its offset.
    """
    ranged = files.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33))
    from .tables import materialise

    ranged = materialise(ranged)
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    at = F.col("_o") + F.col("_i")
    return ranged.join(F.broadcast(offsets), "_p").select(*files.columns, F.floor(at / capacity).cast("long").alias("shard"), (at % capacity).cast("long").alias("place"))


def all_or_nothing(rows: DataFrame, group: str) -> DataFrame:
    """Only the groups of which no row is invalid (column errors): one shuffle by group, rows stay as they are."""
    fine = F.bool_and(F.size("errors") == 0).over(Window.partitionBy(group))
    return rows.withColumn("_fine", fine).filter("_fine").drop("_fine")

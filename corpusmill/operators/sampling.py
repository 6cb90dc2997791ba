"""Sampling with exact quotas.

Members are chosen by the order of a hash of (id, seed), so runs and partitionings agree. Instead of ranking whole
strata (a stratum may hold a third of all rows) the order is cut in two steps: rows are counted per stratum and hash
slice, running counts say in which slice a stratum's quota ends, slices before it are taken whole, and only that one
slice per stratum is ranked. Tie-break: id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLICE_DIGITS = 3


def order_hash(key: Column, seed: int = 42) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def take_quota(df: DataFrame, strata: list[str], key: str, quota: Column, seed: int = 42, flag: str | None = None) -> DataFrame:
    """The first ``quota`` rows of each stratum by hash order; or all rows with a boolean column ``flag``.

    quota is a column over ``_n``, the rows of the stratum. Strata are compared null-safely.
    """
    names = [f"_k{i}" for i in range(len(strata))]
    hashed = df.withColumn("_h", order_hash(F.col(key), seed)).withColumn("_s", F.substring("_h", 1, SLICE_DIGITS))
    counts = hashed.groupBy(*[F.col(c).alias(n) for c, n in zip(strata, names, strict=True)], "_s").agg(F.count(F.lit(1)).alias("_c"))
    all_of, upto = Window.partitionBy(*names), Window.partitionBy(*names).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    edges = counts.withColumn("_n", F.sum("_c").over(all_of)).withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0))).withColumn("_quota", quota.cast("long"))
    if flag is None:  # slices beyond the quota needn't be read on
        edges = edges.filter(F.col("_before") < F.col("_quota"))
    edges = edges.withColumn("_cut", (F.col("_before") < F.col("_quota")) & (F.col("_before") + F.col("_c") > F.col("_quota"))).withColumnRenamed("_s", "_es")
    match = F.col("_s") == F.col("_es")
    for c, n in zip(strata, names, strict=True):
        match = match & F.col(c).eqNullSafe(F.col(n))
    joined = hashed.join(edges, match, "inner")
    rank = F.row_number().over(Window.partitionBy(*names, "_s").orderBy("_h", key))
    inside = joined.filter("_cut").withColumn("_in", F.col("_before") + rank <= F.col("_quota"))
    outside = joined.filter("NOT _cut").withColumn("_in", F.col("_before") < F.col("_quota"))
    both = inside.unionByName(outside)
    if flag is None:
        return both.filter("_in").select(*df.columns)
    return both.withColumn(flag, F.col("_in")).select(*df.columns, flag)


def stratified_sample(df: DataFrame, strata: list[str], key: str, fraction: float, seed: int = 42) -> DataFrame:
    """max(1, round(n * fraction)) rows of each stratum, half to even; all rows if fraction is 1 or more."""
    if fraction >= 1:
        return df
    return take_quota(df, strata, key, F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(fraction), 0)), seed)


def uniform_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """max(1, floor(n * fraction)) rows."""
    return take_quota(df, [], key, F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(fraction))), seed)


def validation_split(df: DataFrame, strata: list[str], key: str, fraction: float = 0.03, seed: int = 42) -> DataFrame:
    """All rows with split: max(1, floor(n * fraction)) of each stratum, never all of it, are val_internal; a lone row is train."""
    quota = F.when(F.col("_n") > 1, F.least(F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(fraction))), F.col("_n") - 1)).otherwise(0)
    return take_quota(df.drop("split"), strata, key, quota, seed, flag="_val").withColumn("split", F.when(F.col("_val"), "val_internal").otherwise("train")).drop("_val")


def split_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val_internal").alias("val"))


def head(df: DataFrame, order: list[str], n: int | None, zero_is_none: bool = True) -> DataFrame:
    """The first n rows in source order; None, and zero if asked, means all."""
    return df if n is None or (n == 0 and zero_is_none) else df.orderBy(*order).limit(n)


def native_proxy_mix(df: DataFrame, key: str, ratio: float, seed: int = 42, bucket: str = "gsd_bucket") -> DataFrame:
    """floor(N * ratio) native rows and N - that proxy rows, each as far as there are any; all rows if there are no proxies."""
    from ..functions.gsd import is_proxy

    marked = df.withColumn("_proxy", is_proxy(F.col(bucket)))
    total, proxies = marked.agg(F.count(F.lit(1)), F.count_if("_proxy")).first()
    if not proxies:
        return df
    native = int(total * ratio)
    return take_quota(marked, ["_proxy"], key, F.when(F.col("_k0"), F.lit(total - native)).otherwise(F.lit(native)), seed).drop("_proxy")


def replay(df: DataFrame, key: str, fraction: float, n_samples: int, seed: int = 42) -> DataFrame:
    """floor(n_samples * fraction) rows of an earlier corpus, as far as there are any."""
    return take_quota(df, [], key, F.lit(int(n_samples * fraction) if fraction > 0 else 0), seed)

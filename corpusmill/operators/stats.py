"""Quantile edges, buckets, band percentiles and mask statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quantiles, sampling


def quantile_edges(df: DataFrame, value: str, n: int, digits: int = 6) -> DataFrame:
    """One row with edges: the n - 1 interior quantile edges, by linear interpolation; empty for n <= 1 and for no values."""
    none = F.array().cast("array<double>")
    if n <= 1:
        return df.sparkSession.range(1).select(none.alias("edges"))
    found = quantiles.percentiles(df, [], value, [i / n for i in range(1, n)])
    return found.agg(F.first("p").alias("p")).select(F.coalesce(F.transform("p", lambda e: F.bround(e, digits)), none).alias("edges"))


def bucket_of(value: Column, edges: Column) -> Column:
    """Index of the first edge that is not below the value."""
    return F.size(F.filter(edges, lambda e: e < value))


def with_quantile_bucket(df: DataFrame, value: str, n: int, out: str = "bucket") -> DataFrame:
    """Adds the quantile bucket of a column; the n - 1 edges become literals."""
    edges = quantile_edges(df, value, n).first()["edges"]
    return df.withColumn(out, bucket_of(F.col(value), F.array(*[F.lit(e) for e in edges]).cast("array<double>")))


def quantile_sample(df: DataFrame, value: str, n: int, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Stratified sample over quantile buckets."""
    return sampling.stratified_sample(with_quantile_bucket(df, value, n), ["bucket"], key, fraction, seed)


def band_percentiles(df: DataFrame, band: str, value: str, low: float = 2.0, high: float = 98.0) -> DataFrame:
    """low and high per band, exact."""
    p = quantiles.percentiles(df, [band], value, [low / 100, high / 100])
    return p.select(band, F.bround(F.col("p")[0], 6).alias("low"), F.bround(F.col("p")[1], 6).alias("high"))


#: Size of a sketch (some 200 KB a band at most): ranks are off by less than 0.0007 of the values in 99 of 100 sketches.
SKETCH_K = 8192
#: A bound of the rank error for SKETCH_K, by a wide margin.
RANK_ERROR = 0.002


def save_state(df: DataFrame, band: str, value: str, path: str, append: bool = True, run: str | None = None) -> None:
    """Add the values seen by a run to a state that ``percentiles_of_state`` reads: one row a band, a mergeable sketch of bounded size.

    Nulls and NaN are left out. A run with a name replaces what it has added before, so that a run that is repeated doesn't count twice.
    """
    seen = F.col(value).cast("double")
    rows = df.filter(seen.isNotNull() & ~F.isnan(seen)).groupBy(F.col(band).alias("band")).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(seen, F.lit(SKETCH_K)).alias("sketch"))
    if run is None:
        rows.write.mode("append" if append else "overwrite").parquet(path)
    else:
        rows.write.mode("overwrite").parquet(f"{path}/run={run}")


def percentiles_of_state(spark, path: str, low: float = 2.0, high: float = 98.0) -> DataFrame:
    """band, n, low and high over all values that were added to a state, by their ranks within RANK_ERROR; raises if there are none."""
    state = spark.read.parquet(path)
    if not state.limit(1).count():
        raise ValueError("no values were accumulated")
    merged = state.groupBy("band").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))
    return merged.select("band", "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(share / 100)).alias(name) for name, share in (("low", low), ("high", high))])


def save_values(df: DataFrame, band: str, value: str, path: str, run: str) -> None:
    """Add the values seen by a run to an exact state: counts of each band's distinct values. Nulls and NaN are left out; a repeated run replaces itself."""
    seen = F.col(value).cast("double")
    rows = df.filter(seen.isNotNull() & ~F.isnan(seen)).groupBy(F.col(band).alias("band"), seen.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").parquet(f"{path}/run={run}")


def percentiles_of_values(spark, path: str, low: float = 2.0, high: float = 98.0) -> DataFrame:
    """band, low and high, exact, over all values that were added to a state; no task holds a band's values."""
    values = spark.read.parquet(path).select("band", "value", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return band_percentiles(values, "band", "value", low, high)


def band_clip(df: DataFrame, percentiles: DataFrame, band: str, value: str) -> DataFrame:
    """Values clamped to their band's percentiles; a band without any is left as it is."""
    joined = df.join(percentiles, band, "left")
    return joined.withColumn(value, F.when(F.col("low").isNull(), F.col(value)).otherwise(F.least(F.greatest(F.col(value), F.col("low")), F.col("high")))).drop("low", "high")


def clip_to_percentiles(values: Column, low: float = 2.0, high: float = 98.0) -> Column:
    """An image's values (an array) clamped to their own percentiles, by linear interpolation; nulls and NaN stay and don't count."""
    double = F.transform(values, lambda v: v.cast("double"))
    known = F.array_sort(F.filter(double, lambda v: v.isNotNull() & ~F.isnan(v)))

    def at(share: float) -> Column:
        place = (F.size(known) - 1) * F.lit(share / 100)
        lower, upper = F.get(known, F.floor(place).cast("int")), F.get(known, F.ceil(place).cast("int"))
        return lower + (upper - lower) * (place - F.floor(place))

    # the two bounds are worked out once for the whole array
    bounds = F.array(F.struct(at(low).alias("low"), at(high).alias("high")))
    return F.transform(bounds, lambda b: F.transform(double, lambda v: F.when(F.isnan(v), v).when(v.isNotNull(), F.least(F.greatest(v, b["low"]), b["high"]))))[0]


def change_fraction(values: Column, level: float = 127) -> Column:
    """Share of an array's elements above a level; 0 without elements."""
    # the size of a null array is -1 in sessions without ANSI
    share = F.try_divide(F.size(F.filter(values, lambda v: v > level)), F.size(values))
    return F.when(values.isNull(), F.lit(0.0)).otherwise(F.coalesce(share, F.lit(0.0)))


def envelope(pixels: DataFrame, keys: list[str], least: int = 10) -> DataFrame:
    """x1, y1, x2, y2 (inclusive) and count of the pixels (x, y) per key, if there are enough."""
    return pixels.groupBy(*keys).agg(F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2"), F.count(F.lit(1)).alias("pixels")).filter(F.col("pixels") >= least)


def first_class(rows: DataFrame, key: str, order: str, name: Column) -> DataFrame:
    """Per key the first valid class name by order, else ``unknown``."""
    return rows.groupBy(key).agg(F.coalesce(F.min_by(name, F.when(name.isNotNull(), F.col(order))), F.lit("unknown")).alias("class_name"))


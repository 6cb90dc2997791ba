"""Exact quantiles of any number of rows: ranks are found by histograms, not by counters of all values.

The values of a group are counted in equal ranges between its smallest and its largest one; each wanted rank falls into one of
them, whose own smallest and largest values are the next bounds. A range whose bounds are equal is the value; one with at most
``most`` rows is sorted. All groups and ranks go through one pass together, and a pass keeps at most ``bins`` counters for each
range that is still open: what a task holds depends on neither the number of rows nor that of distinct values.

Nulls are left out; infinite values and NaN (the largest of all) are counted apart, so they don't stretch a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import join_small, materialise

#: Ranges of a pass, and rows of a range that are sorted in one task.
BINS, MOST = 4096, 500_000
_RANGE = ["g", "lo", "hi"]


def _inside(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """g, lo, hi, v: the values within each distinct range of their group."""
    found = join_small(rows, ranges.select(*_RANGE).distinct(), ["g"])
    return found.filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))


def _narrower(rows: DataFrame, wide: DataFrame, bins: int) -> DataFrame:
    """The wanted ranks of ranges that are too wide, each with the part of its range that holds it."""
    width = F.col("hi") - F.col("lo")
    half = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    share = F.when(width < float("inf"), (F.col("v") - F.col("lo")) / width).otherwise(half)
    part = F.least(F.lit(bins - 1), F.floor(share * bins)).cast("int")
    parts = _inside(rows, wide).groupBy(*_RANGE, part.alias("part")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("first"), F.max("v").alias("last"))
    upto = Window.partitionBy(*_RANGE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("c").over(upto), F.lit(0)))
    held = wide.select("g", "rank", "at", "lo", "hi").join(parts, _RANGE).filter((F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("c")))
    return held.select("g", "rank", (F.col("at") - F.col("before")).alias("at"), F.col("first").alias("lo"), F.col("last").alias("hi"), F.col("c").alias("n"))


def at_ranks(rows: DataFrame, wanted: DataFrame, bins: int = BINS, most: int = MOST) -> DataFrame:
    """g, rank, value. rows: g, v (finite); wanted: g, rank, at (place among the rows of its range), lo, hi and n (its rows)."""
    settled, small, wide = [], [], wanted
    while True:
        settled.append(wide.filter("lo = hi").select("g", "rank", F.col("lo").alias("value")))
        small.append(wide.filter((F.col("lo") != F.col("hi")) & (F.col("n") <= most)))
        wide = wide.filter((F.col("lo") != F.col("hi")) & (F.col("n") > most))
        if not wide.limit(1).count():
            break
        wide = materialise(_narrower(rows, wide, bins))
    few = small[0]
    for x in small[1:]:
        few = few.unionByName(x)
    place = F.row_number().over(Window.partitionBy(*_RANGE).orderBy("v")) - 1
    sorted_ = _inside(rows, few).withColumn("at", place.cast("long"))
    out = sorted_.join(few.select("g", "rank", "at", "lo", "hi"), [*_RANGE, "at"]).select("g", "rank", F.col("v").alias("value"))
    for x in settled:
        out = out.unionByName(x)
    return out


def percentiles(df: DataFrame, keys: list[str], value: str, shares: list[float], bins: int = BINS, most: int = MOST) -> DataFrame:
    """The keys and p, an array of the quantiles at ``shares`` by linear interpolation; groups without values have no row."""
    g = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k0"))
    v = F.col("v")
    rows = df.select(g.alias("g"), F.col(value).cast("double").alias("v")).filter(v.isNotNull())
    finite = ~F.isnan(v) & (F.abs(v) != float("inf"))
    sums = rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("all"), F.count_if(v == float("-inf")).alias("low"), F.count_if(finite).alias("n"), F.count_if(F.isnan(v)).alias("nan"),
        F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi"),
    )
    sums = materialise(sums)
    place = F.transform(F.array(*[F.lit(float(s)) for s in shares]), lambda s: s * (F.col("all") - 1))
    ranks = F.array_distinct(F.flatten(F.transform(place, lambda p: F.array(F.floor(p).cast("long"), F.ceil(p).cast("long")))))
    each = sums.withColumn("rank", F.explode(ranks))
    at = F.col("rank") - F.col("low")
    odd = F.when(at < 0, F.lit(float("-inf"))).when(at >= F.col("n"), F.when(F.col("rank") >= F.col("all") - F.col("nan"), F.lit(float("nan"))).otherwise(F.lit(float("inf"))))
    each = each.withColumn("at", at).withColumn("odd", odd)
    found = at_ranks(rows.filter(finite), each.filter("odd IS NULL").select("g", "rank", "at", "lo", "hi", "n"), bins, most)
    found = found.unionByName(each.filter("odd IS NOT NULL").select("g", "rank", F.col("odd").alias("value")))
    # at most two values for each share
    of = found.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("of"))

    def between(p: Column) -> Column:
        low, high = F.element_at("of", F.floor(p).cast("long")), F.element_at("of", F.ceil(p).cast("long"))
        return F.when(low == high, low).otherwise(low + (high - low) * (p - F.floor(p)))

    done = sums.join(of, "g").select("g", F.transform(place, between).alias("p"))
    return done.select(*[F.col(f"g.k{i}").alias(k) for i, k in enumerate(keys)], "p")

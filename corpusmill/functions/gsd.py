"""Resolution buckets, proxies and curriculum tables as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import NATIVE_BUCKETS

OPTICAL_PROXY, SAR_PROXY = ("CARTOSAT-proxy", 2.0), ("RISAT-proxy", 5.0)
#: Stage to (native, proxy) share; other stages: 4 and later as 4, else as 1.
STAGE_RATIOS = {1: (1.0, 0.0), 2: (0.8, 0.2), 3: (0.5, 0.5), 4: (0.3, 0.7)}


def format_gsd(gsd: Column) -> Column:
    """``5m`` for whole metres, else two decimals (half to even)."""
    cents = F.bround(gsd * 100, 0).cast("long")
    parts = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"), F.lit("m"))
    return F.when(gsd == F.floor(gsd), F.concat(gsd.cast("long").cast("string"), F.lit("m"))).otherwise(parts)


def bucket(dataset: Column, gsd: Column | None = None) -> Column:
    """A known source's bucket; else the tag of a given resolution; else VHR-native."""
    known = F.coalesce(*[F.when(dataset == k, F.lit(v)) for k, v in NATIVE_BUCKETS.items()])
    tag = F.lit(None).cast("string") if gsd is None else F.concat(F.lit("[GSD:"), format_gsd(gsd), F.lit("]"))
    return F.coalesce(known, tag, F.lit("VHR-native"))


def proxy_bucket(modality: Column, gsd: Column | None = None) -> Column:
    sar = F.coalesce(modality, F.lit("optical")) == "sar"
    size = F.when(sar, F.lit(SAR_PROXY[1])).otherwise(F.lit(OPTICAL_PROXY[1]))
    size = size if gsd is None else F.coalesce(gsd, size)
    return F.concat(F.when(sar, F.lit(SAR_PROXY[0])).otherwise(F.lit(OPTICAL_PROXY[0])), F.lit("[GSD:"), format_gsd(size), F.lit("]"))


def with_proxies(samples: DataFrame, eligible: Column | None = None, gsd: Column | None = None, proxy_path: Column | None = None) -> DataFrame:
    """Every sample, and after it its proxy if it is eligible: another bucket and id, and other images if given."""
    others = [c for c in samples.columns if c not in ("id", "gsd_bucket", "image_path")]
    row = lambda i, b, p: F.struct(i.alias("id"), b.alias("gsd_bucket"), p.alias("image_path"), *[F.col(c) for c in others])
    native = row(F.col("id"), F.col("gsd_bucket"), F.col("image_path"))
    proxy = row(F.concat("id", F.lit("_proxy")), proxy_bucket(F.col("modality"), gsd), F.col("image_path") if proxy_path is None else F.coalesce(proxy_path, F.col("image_path")))
    both = F.array(native, proxy)
    rows = both if eligible is None else F.when(eligible, both).otherwise(F.array(native))
    return samples.select(F.explode(rows).alias("r")).select(*[f"r.{c}" for c in samples.columns])

def is_proxy(bucket_: Column) -> Column:
    return F.lower(F.coalesce(bucket_, F.lit(""))).contains("proxy")


def stage_ratio(stage: Column) -> Column:
    """(native, proxy) of a curriculum stage."""
    pair = lambda k: F.struct(F.lit(STAGE_RATIOS[k][0]).alias("native"), F.lit(STAGE_RATIOS[k][1]).alias("proxy"))
    return F.when(stage >= 4, pair(4)).when(stage == 3, pair(3)).when(stage == 2, pair(2)).otherwise(pair(1))


def step_ratio(step: Column, max_steps: Column, ratios: Column) -> Column:
    """The native share at a training step: one of the ratios, changing at 33 and 66 hundredths."""
    last = lambda k: F.get(ratios, F.least(F.lit(k), F.size(ratios) - 1))
    progress = step / max_steps
    return F.when(F.size(ratios) == 1, ratios[0]).when(progress < 0.33, ratios[0]).when(progress < 0.66, last(1)).otherwise(last(2))


def proxy_size(width: Column, height: Column, factor: int = 4, least: int = 32) -> Column:
    """Width and height of a proxy image."""
    return F.struct(F.greatest(F.lit(least), F.floor(width / factor).cast("int")).alias("w"), F.greatest(F.lit(least), F.floor(height / factor).cast("int")).alias("h"))

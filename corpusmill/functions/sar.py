"""Radar intensities as column expressions, for pixel tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: dB ranges of the two polarisations, and of their difference.
VV, VH, DIFF = (-25.0, 0.0), (-30.0, -5.0), (0.0, 25.0)


def to_db(value: Column, eps: float = 1e-10) -> Column:
    return 10 * F.log10(F.greatest(value, F.lit(eps)))


def clip(value: Column, low, high) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def clip_vv(db: Column) -> Column:
    return clip(db, *VV)


def clip_vh(db: Column) -> Column:
    return clip(db, *VH)


def to_byte(db: Column, low: float, high: float) -> Column:
    """0..255, towards zero."""
    return (clip((db - low) / (high - low), 0.0, 1.0) * 255).cast("int")


def dual_rgb(vv: Column, vh: Column) -> Column:
    """VV, VH, and the difference of the clipped two."""
    a, b = clip_vv(to_db(vv)), clip_vh(to_db(vh))
    return F.struct(to_byte(a, *VV).alias("r"), to_byte(b, *VH).alias("g"), to_byte(a - b, *DIFF).alias("b"))


def quad_rgb(hh: Column, vv: Column, vh: Column) -> Column:
    return F.struct(to_byte(to_db(hh), *VV).alias("r"), to_byte(to_db(vv), *VV).alias("g"), to_byte(to_db(vh), *VH).alias("b"))


def gray_rgb(intensity: Column) -> Column:
    g = to_byte(clip_vv(to_db(intensity)), *VV)
    return F.struct(g.alias("r"), g.alias("g"), g.alias("b"))


def downsampled_size(size: Column, target: Column, native: Column) -> Column:
    """Pixels of a side after down-sampling to a coarser resolution; unchanged if it is as coarse already."""
    return F.when(native >= target, size).otherwise(F.greatest(F.lit(1), F.bround(size * (native / target), 0).cast("int")))

"""Bounding boxes as column expressions: lists of [x1, y1, x2, y2] on a 0..1000 grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SAR_CATEGORIES


def scaled(value: Column, size: Column) -> Column:
    """A pixel coordinate on the 0..1000 grid, two decimals, half to even."""
    return F.bround(value / size * 1000, 2)


def pixel_to_normalized(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """One box in pixels as a list of one normalised box."""
    return F.array(F.array(scaled(x1, width), scaled(y1, height), scaled(x2, width), scaled(y2, height)))


def normalized_to_pixel(bbox: Column, width: Column, height: Column) -> Column:
    """The first box in whole pixels, half to even, as a struct x1, y1, x2, y2."""
    at = lambda k, size: F.bround(bbox[0][k] / 1000 * size, 0).cast("int")
    return F.struct(at(0, width).alias("x1"), at(1, height).alias("y1"), at(2, width).alias("x2"), at(3, height).alias("y2"))


def unit_to_grid(bbox: Column) -> Column:
    """Boxes in 0..1 on the 0..1000 grid, not rounded."""
    return F.transform(bbox, lambda box: F.transform(box, lambda v: v * 1000))


def grid_to_map(bbox: Column, affine: list[float]) -> Column:
    """The corners of the first box in map coordinates; affine is (a, b, c, d, e, f).

    The x fraction is taken as the row and the y fraction as the column, with pixel centres.
    """
    a, b, c, d, e, f = affine
    fx = lambda k: F.struct((F.lit(a) * (bbox[0][k + 1] / 1000 + 0.5) + F.lit(b) * (bbox[0][k] / 1000 + 0.5) + c).alias("x"), (F.lit(d) * (bbox[0][k + 1] / 1000 + 0.5) + F.lit(e) * (bbox[0][k] / 1000 + 0.5) + f).alias("y"))
    return F.array(fx(0), fx(2))


def ordered(bbox: Column) -> Column:
    """Whether the first box has its top left before its bottom right."""
    return (bbox[0][0] <= bbox[0][2]) & (bbox[0][1] <= bbox[0][3])


def coordinate_errors(bbox: Column) -> Column:
    """One message for each coordinate outside 0..1000; NaN passes."""
    bad = lambda v: ~F.isnan(v) & ((v < 0) | (v > 1000))
    number = lambda v: F.when(v == F.floor(v), F.format_string("%.1f", v)).otherwise(v.cast("string"))
    told = F.transform(bbox, lambda box, i: F.transform(box, lambda v, j: F.when(bad(v), F.concat(F.lit("bbox["), i.cast("string"), F.lit("]["), j.cast("string"), F.lit("]="), number(v), F.lit(" out of range [0, 1000]")))))
    return F.array_compact(F.flatten(told))


def polygons_to_boxes(rings: Column, width: Column, height: Column) -> Column:
    """Envelopes of outer rings with three points or more, in whole pixels (towards zero), normalised."""
    full = F.filter(rings, lambda ring: F.size(ring) >= 3)

    def box(ring):
        xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
        whole = lambda v: v.cast("long").cast("double")
        return F.array(scaled(whole(F.array_min(xs)), width), scaled(whole(F.array_min(ys)), height), scaled(whole(F.array_max(xs)), width), scaled(whole(F.array_max(ys)), height))

    return F.transform(full, box)


def yolo_row(line: Column, width: Column, height: Column) -> Column:
    """class_name and bbox of a label row ``class cx cy w h``; null if it is short or of an unknown class.

    Corners are whole pixels towards zero, clamped to the image. Negative classes are refused.
    """
    parts = F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+")
    kind = parts[0].try_cast("int")
    num = lambda k: F.get(parts, F.lit(k)).try_cast("double")
    corner = lambda c, s, sign, size: ((num(c) + sign * num(s) / 2) * size).cast("long").cast("double")
    x1, y1 = F.greatest(F.lit(0.0), corner(1, 3, -1, width)), F.greatest(F.lit(0.0), corner(2, 4, -1, height))
    x2, y2 = F.least(width.cast("double"), corner(1, 3, 1, width)), F.least(height.cast("double"), corner(2, 4, 1, height))
    box = F.array(scaled(x1, width), scaled(y1, height), scaled(x2, width), scaled(y2, height))
    name = F.get(F.array(*[F.lit(c) for c in SAR_CATEGORIES]), kind)
    return F.when((F.size(parts) >= 5) & name.isNotNull(), F.struct(name.alias("class_name"), box.alias("bbox")))


def referring_box(text: Column) -> Column:
    """Boxes of a text that begins with {<a><b><c><d>}, times ten; null if it doesn't, or is reversed or without area."""
    stripped = F.regexp_replace(text, r"^\s+", "")
    at = lambda k: F.regexp_extract(stripped, r"^\{<(\d+)><(\d+)><(\d+)><(\d+)>\}", k).try_cast("double") * 10
    x1, y1, x2, y2 = (at(k) for k in (1, 2, 3, 4))
    return F.when((x1 < x2) & (y1 < y2), F.array(F.array(x1, y1, x2, y2)))

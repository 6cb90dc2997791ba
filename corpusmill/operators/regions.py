"""Rasters as tables: runs of pixels, connected regions across tiles, area averages.

A mask becomes its runs, the stretches of set pixels of a row: far fewer rows than pixels, and cut at no size of image. Runs that touch
are links of a graph, and regions are its components, so an image may lie in any number of tiles and tasks. Images of a bounded number
of runs need no graph: theirs are folded in order.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.rasters import binary_mask
from . import graph
from .images import slices, unpack
from .tables import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns of an image that meet in a join of neighbouring runs.
STRIP = 256
#: Runs of an image that are taken together in a row at most.
MOST_RUNS = 100


def runs_of_pixels(pixels: DataFrame, key: str) -> DataFrame:
    """key, y, x1, x2 (inclusive): the runs of a table of set pixels (key, y, x); repeated pixels count once."""
    along = Window.partitionBy(key, "y").orderBy("x")
    # in a run of neighbouring pixels x goes up as the row number does
    numbered = pixels.select(key, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x")).distinct().withColumn("_r", F.col("x") - F.row_number().over(along))
    return numbered.groupBy(key, "y", "_r").agg(F.min("x").alias("x1"), F.max("x").alias("x2")).drop("_r")


def runs_of_tiles(tiles: DataFrame, key: str, mask: str = "image", top: str | None = None, left: str | None = None) -> DataFrame:
    """The runs of rasters, which are whole images, or tiles whose first row and column are in the columns ``top`` and ``left``."""
    kind = tiles.schema[key].dataType.simpleString()
    at = [c for c in (top, left) if c]

    def run(batches):
        for b in slices(batches):
            offs = [b.column(c).to_pylist() if c else [0] * b.num_rows for c in (top, left)]
            for k, (raster, oy, ox) in enumerate(zip(b.column(mask).to_pylist(), *offs, strict=True)):
                if raster is None:
                    continue
                on = np.pad(binary_mask(unpack(raster)), ((0, 0), (1, 1)))
                step = np.diff(on.astype(np.int8), axis=1)
                (y, x1), (_, stop) = np.nonzero(step == 1), np.nonzero(step == -1)
                keys = b.column(key).slice(k, 1).take(pa.array(np.zeros(len(y), np.int64)))
                yield pa.RecordBatch.from_arrays([keys, pa.array(y + oy, pa.int64()), pa.array(x1 + ox, pa.int64()), pa.array(stop - 1 + ox, pa.int64())], names=[key, "y", "x1", "x2"])

    return tiles.select(key, mask, *at).mapInArrow(run, f"{key} {kind}, y long, x1 long, x2 long")


def links(runs: DataFrame, key: str, strip: int = STRIP) -> DataFrame:
    """a and b, structs (key, y, x1): runs that touch at sides, in the next row or, across a border of tiles, in the same one.

    Runs meet by row and strip of columns, so that a row of any width is no one task's.
    """
    node = F.struct(F.col(key).alias("k"), "y", "x1")
    each = runs.select(node.alias("node"), F.col(key).alias("k"), "y", "x1", "x2")
    # a run is in the strips of its own columns and of the one beyond its end
    near = each.withColumn("strip", F.explode(F.sequence(F.floor(F.col("x1") / strip), F.floor((F.col("x2") + 1) / strip))))
    other = near.select(F.col("k").alias("k2"), F.col("strip").alias("strip2"), F.col("y").alias("y2"), F.col("x1").alias("l2"), F.col("x2").alias("r2"), F.col("node").alias("b"))
    same = F.col("k").eqNullSafe(F.col("k2")) & (F.col("strip") == F.col("strip2"))
    below = near.join(other.withColumn("y2", F.col("y2") - 1), same & (F.col("y") == F.col("y2"))).filter("x1 <= r2 AND l2 <= x2")
    beside = near.join(other, same & (F.col("y") == F.col("y2"))).filter("x2 + 1 = l2")
    return below.select(F.col("node").alias("a"), "b").union(beside.select(F.col("node").alias("a"), "b")).distinct()


def boxes(runs: DataFrame, key: str, least: int = 50, most_runs: int = MOST_RUNS) -> DataFrame:
    """key, x1, y1, x2, y2 (inclusive) and pixels of the connected regions with at least ``least`` pixels.

    Images of at most ``most_runs`` runs are folded within a row each; the runs of larger ones are components of a table of links.
    """
    runs = materialise(runs.select(F.col(key).alias("k"), "y", "x1", "x2"))
    small = runs.groupBy(F.col("k").alias("own")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= most_runs).select("own")
    is_small = F.col("k").eqNullSafe(F.col("own"))
    few = _of_small_images(runs.join(small, is_small, "left_semi"), least)
    large = materialise(runs.join(small, is_small, "left_anti"))
    if not large.limit(1).count():
        return few.withColumnRenamed("k", key)
    found = graph.components(links(large, "k"))
    placed = large.withColumn("node", F.struct("k", "y", "x1")).join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    size = F.sum(F.col("x2") - F.col("x1") + 1).alias("pixels")
    out = placed.groupBy("comp").agg(F.min("x1").alias("x1"), F.min("y").alias("y1"), F.max("x2").alias("x2"), F.max("y").alias("y2"), size)
    return few.unionByName(out.filter(F.col("pixels") >= least).select("comp.k", "x1", "y1", "x2", "y2", "pixels")).withColumnRenamed("k", key)


def _of_small_images(runs: DataFrame, least: int) -> DataFrame:
    """The regions of images of few runs (k, y, x1, x2): runs in their order are added to the boxes they touch, which become one."""
    box = "x1 bigint, y1 bigint, x2 bigint, y2 bigint, pixels bigint, last array<struct<y: bigint, x1: bigint, x2: bigint>>"
    none = F.array().cast("array<struct<" + ",".join(f"{c.split(' ', 1)[0]}:{c.split(' ', 1)[1]}" for c in box.replace(": ", ":").split(", ", 5)) + ">>")
    rows = F.array_sort(F.collect_list(F.struct("y", "x1", "x2")))

    def touches(g, r):
        """Whether a run meets one of a box's runs in its own row or the one before: those are all that later runs can meet."""
        beside = lambda p: ((p["y"] == r["y"] - 1) & (p["x1"] <= r["x2"]) & (r["x1"] <= p["x2"])) | ((p["y"] == r["y"]) & (p["x2"] + 1 == r["x1"]))
        return F.exists(g["last"], beside)

    def add(groups, r):
        one = F.struct(r["x1"].alias("x1"), r["y"].alias("y1"), r["x2"].alias("x2"), r["y"].alias("y2"), (r["x2"] - r["x1"] + 1).alias("pixels"), F.array(r).alias("last"))

        def join(a, g):
            recent = F.filter(F.concat(a["last"], g["last"]), lambda p: p["y"] >= r["y"] - 1)
            return F.struct(F.least(a["x1"], g["x1"]).alias("x1"), F.least(a["y1"], g["y1"]).alias("y1"), F.greatest(a["x2"], g["x2"]).alias("x2"), F.greatest(a["y2"], g["y2"]).alias("y2"), (a["pixels"] + g["pixels"]).alias("pixels"), recent.alias("last"))

        met = F.aggregate(F.filter(groups, lambda g: touches(g, r)), one, join)
        return F.concat(F.filter(groups, lambda g: ~touches(g, r)), F.array(met))

    found = runs.groupBy("k").agg(F.aggregate(rows, none, add).alias("g")).select("k", F.explode("g").alias("g")).select("k", "g.x1", "g.y1", "g.x2", "g.y2", "g.pixels")
    return found.filter(F.col("pixels") >= least)


def _cells(at: str, old: Column, new: Column) -> Column:
    """The cells of the smaller side that a pixel reaches, and the part of it in each."""
    scale = old / new
    low, high = F.floor(F.col(at) / scale), F.least(F.ceil((F.col(at) + 1) / scale), new) - 1
    part = lambda c: F.least(F.col(at) + 1, (c + 1) * scale) - F.greatest(F.col(at).cast("double"), c * scale)
    return F.filter(F.transform(F.sequence(low, F.greatest(low, high)), lambda c: F.struct(c.alias("cell"), part(c).alias("part"))), lambda x: x["part"] > 1e-9)


def area_averages(pixels: DataFrame, keys: list[str], height: Column, width: Column, small_height: Column, small_width: Column, value: str = "v") -> DataFrame:
    """keys, y, x and value: a table of pixels (y, x, value) at a smaller size, each cell the average of its area."""
    split = pixels.select(*keys, value, F.explode(_cells("y", height, small_height)).alias("cy"), "x", width.alias("_w"), small_width.alias("_s"))
    split = split.select(*keys, value, F.col("cy.cell").alias("y"), F.col("cy.part").alias("py"), F.explode(_cells("x", F.col("_w"), F.col("_s"))).alias("cx"))
    weight = F.col("py") * F.col("cx.part")
    return split.groupBy(*keys, "y", F.col("cx.cell").alias("x")).agg((F.sum(F.col(value) * weight) / F.sum(weight)).alias(value))

"""The ten source recipes: scan, select, join, build rows, validate, emit.

A recipe gives a frame (source_id, position, rows): rows is an array of samples, null where nothing could be made.
``finish`` turns it into outcomes; the sink, the manifest and the run counters all derive from that one frame.
"""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import boxes, rasters
from ..functions.text import padded
from ..operators import images, manifest, sampling, stats, validate
from ..operators.tables import materialise
from ..schema import LAND_COVER, SAR_CATEGORIES
from ..sources import readers, sinks, stores
from . import rows


@dataclasses.dataclass
class Options:
    """max_samples: first items after selection; fraction: share that is sampled; done: manifest log (id, processed, ord)."""

    max_samples: int | None = None
    fraction: float | None = None
    seed: int = 42
    output_dir: str = ""
    done: DataFrame | None = None
    #: Land-cover boxes from class masks. Rows that have them are then refused, as their task must not have any.
    masks: bool = False


def finish(made: DataFrame, validated: bool = True) -> DataFrame:
    """source_id, outcome and rows: an item of which any row is invalid fails as a whole."""
    exploded = made.select("source_id", F.explode_outer("rows").alias("r")).select("source_id", "r.*")
    judged = exploded.withColumn("errors", F.when(F.col("id").isNull(), F.array(F.lit("no row"))).otherwise(validate.errors() if validated else F.array().cast("array<string>")))
    sample = F.struct(*[c for c in judged.columns if c not in ("source_id", "errors")])
    groups = judged.groupBy("source_id").agg(F.bool_and(F.size("errors") == 0).alias("fine"), F.array_sort(F.collect_list(sample), lambda a, b: F.when(F.length(a["id"]) < F.length(b["id"]), -1).when(F.length(a["id"]) > F.length(b["id"]), 1).when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)).alias("rows"), F.flatten(F.collect_list("errors")).alias("errors"))
    return groups.select("source_id", F.when(F.col("fine"), "processed").otherwise("failed").alias("outcome"), F.when(F.col("fine"), F.col("rows")).alias("rows"), "errors")


def samples(finished: DataFrame) -> DataFrame:
    return finished.filter("outcome = 'processed'").select(F.explode("rows").alias("r")).select("r.*")


def counters(finished: DataFrame, skipped: int = 0) -> DataFrame:
    return manifest.outcomes(finished).withColumn("skipped", F.lit(skipped).cast("long"))


def _pending(items: DataFrame, o: Options) -> DataFrame:
    """Without items that the manifest has as processed; items have source_id."""
    return items if o.done is None else items.join(manifest.state(o.done, "ord").filter("processed").select(F.col("id").alias("source_id")), "source_id", "left_anti")


def _at(o: Options, name):
    return F.concat(F.lit(f"{o.output_dir}/images/"), name, F.lit(".png"))


def _write(encoded: DataFrame, o: Options) -> None:
    """PNG files of (name, png), where an output folder is given."""
    if o.output_dir:
        sinks.write_files(encoded.filter("png IS NOT NULL").select(F.concat("name", F.lit(".png")).alias("path"), "png"), "path", "png", f"{o.output_dir}/images")


def _content(spark: SparkSession, items: DataFrame, folder: str, glob: str, recursive: bool = False) -> DataFrame:
    """The items (path and others) with the content of their files; no other file of the folder is opened."""
    return stores.contents_of(spark, items, "path", folder, glob, recursive).drop("error")


def _stem(c: str = "path"):
    return F.regexp_replace(F.substring_index(c, "/", -1), r"\.[^.]*$", "")


def vrsbench(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    entries = sampling.head(readers.conversations(spark, root), ["position"], o.max_samples).withColumn("source_id", padded(F.col("position"), 7, "vrsbench_"))
    folder = readers.first_existing(spark, [f"{root}/{d}" for d in ("Images_train", "images", "Images")])
    files = readers.listing(spark, folder or f"{root}/images").select(F.col("name").alias("image"), "path")
    placed = _pending(entries, o).join(files, "image", "left")
    proxy = F.lit(None).cast("string")
    if o.output_dir:  # one proxy per image, however many entries share it
        if folder:
            among = placed.filter("path IS NOT NULL").select("path").distinct()
            small = images.decode_jvm(spark, folder, among=among, out="png", kind=T.BinaryType(), function=lambda x: rasters.write_png(rasters.proxy_image(x))).select(F.concat(_stem(), F.lit("_proxy")).alias("name"), "png")
            _write(small, o)
            proxy = F.when(F.col("path").isNotNull(), _at(o, F.concat(_stem(), F.lit("_proxy"))))
    return placed.select("source_id", "position", rows.conversation_rows(F.col("position"), F.col("conversations"), F.col("path"), proxy).alias("rows"))


def rsvqa_hr(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    items = sampling.head(readers.questions(spark, root), ["position"], o.max_samples)
    items = items.withColumn("source_id", F.concat(F.lit("rsvqa_hr_"), F.coalesce("question_id", "id", F.col("position").cast("string"))))
    placed = readers.first_image(_pending(items, o), readers.listing(spark, f"{root}/images"), "image_id", ("png", "jpg", "jpeg", "tif"))
    image = F.col("image")
    if o.output_dir and readers.exists(spark, f"{root}/images"):  # other formats become PNGs, each image once
        wanted = placed.filter(~F.endswith("image", F.lit(".png"))).select(F.col("image").alias("path")).distinct()
        others = materialise(images.decode_any(spark, f"{root}/images", wanted, out="png", kind=T.BinaryType(), function=rasters.write_png).filter("png IS NOT NULL").select("path", "png"))
        _write(others.select(_stem().alias("name"), "png"), o)
        placed = placed.join(others.select(F.col("path").alias("image"), F.lit(True).alias("made")), "image", "left")
        image = F.when(F.endswith(image, F.lit(".png")), image).when(F.col("made"), _at(o, _stem("image")))
    return placed.select("source_id", "position", rows.question_rows(F.col("source_id"), F.col("question"), F.col("answer"), image).alias("rows"))


def cdvqa(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    items = sampling.head(readers.change_questions_all(spark, root), ["position"], o.max_samples).withColumn("source_id", padded(F.col("position"), 7, "cdvqa_"))
    files = readers.listing(spark, f"{root}/images", recursive=True).select("path", F.regexp_extract("path", r"/images/(.*)$", 1).alias("rel"))
    placed = _pending(items, o).join(files.select(F.col("rel").alias("before"), F.col("path").alias("p1")), "before", "left").join(files.select(F.col("rel").alias("after"), F.col("path").alias("p2")), "after", "left")
    made = rows.change_question_rows(F.col("source_id"), F.col("question"), F.col("answer"), F.col("p1"), F.col("p2"))
    return placed.select("source_id", "position", F.when((F.coalesce("before", F.lit("")) != "") & (F.coalesce("after", F.lit("")) != ""), made).alias("rows"))


def levir_cd(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    fraction = 0.10 if o.fraction is None else o.fraction
    folder = f"{root}/train"
    pairs = readers.before_after(*(readers.listing(spark, f"{folder}/{d}", "*.png") for d in ("A", "B", "label")))
    if readers.exists(spark, f"{folder}/label"):
        masks = _content(spark, pairs.filter("mask IS NOT NULL").select(F.col("mask").alias("path")).distinct(), f"{folder}/label", "*.png")
        # one read of a mask gives both the key and the box; no picture goes back to the JVM

        def look(x):
            plane = (x[:, :, 0] if x.ndim == 3 else x) > 127
            ys, xs = np.nonzero(plane)
            h, w = plane.shape
            n = lambda v, size: round(float(v) / size * 1000, 2)
            box = [n(xs.min(), w), n(ys.min(), h), n(xs.max(), w), n(ys.max(), h)] if len(ys) >= 10 else None
            return {"share": float(plane.mean()), "box": box}

        kind = T.StructType([T.StructField("share", T.DoubleType()), T.StructField("box", T.ArrayType(T.DoubleType()))])
        seen = images.see(masks, "seen", kind, look).select(F.col("path").alias("mask"), "seen")
        pairs = pairs.join(seen, "mask", "left")
    else:
        pairs = pairs.withColumn("seen", F.lit(None).cast("struct<share:double,box:array<double>>"))
    pairs = materialise(pairs.withColumn("share", F.coalesce("seen.share", F.lit(0.0))).withColumn("source_id", F.concat(F.lit("levir_"), "base")))
    chosen = sampling.head(stats.quantile_sample(pairs, "share", 10, "base", fraction, o.seed), ["base"], o.max_samples)
    box = F.when(F.col("seen.box").isNotNull(), F.array(F.col("seen.box")))
    path = lambda end, src: _at(o, F.concat(F.col("source_id"), F.lit(end))) if o.output_dir else F.col(src)
    todo = _pending(chosen, o)
    if o.output_dir:
        for end, src, sub in (("_before", "before", "A"), ("_after", "after", "B")):
            names = todo.select(F.col(src).alias("path"), F.concat("source_id", F.lit(end)).alias("name"))
            _write(images.see(_content(spark, names, f"{folder}/{sub}", "*.png"), "png", T.BinaryType(), rasters.write_png), o)
    return todo.select("source_id", F.lit(0).alias("position"), rows.change_pair_rows(F.col("base"), path("_before", "before"), path("_after", "after"), box).alias("rows"))


def sn6_opt(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    """The selection of tiles is returned by ``sn6_selection`` before the limit is applied."""
    chosen = sampling.head(sn6_selection(spark, root, o), ["tile"], o.max_samples).withColumn("source_id", F.concat(F.lit("sn6_"), "tile"))
    files = _content(spark, _pending(chosen, o).select("path", "tile", "source_id", "rings"), f"{root}/train/images", "*.tif")
    drawn = bool(o.output_dir)
    kind = T.StructType([T.StructField("w", T.DoubleType()), T.StructField("h", T.DoubleType()), T.StructField("png", T.BinaryType())])
    # a tile is decoded once, for its size and its picture
    look = lambda x: {"w": float(x.shape[1]), "h": float(x.shape[0]), "png": rasters.write_png(rasters.tile_rgb(x)) if drawn else None}
    seen = images.see(files, "seen", kind, look).drop("content", "error")
    if drawn:
        seen = materialise(seen)
        _write(seen.select(F.col("source_id").alias("name"), "seen.png"), o)
    found = boxes.polygons_to_boxes(F.col("rings"), F.col("seen.w"), F.col("seen.h"))
    image = _at(o, F.col("source_id")) if drawn else F.col("path")
    return seen.select("source_id", F.lit(0).alias("position"), F.when(F.col("seen").isNotNull(), rows.building_rows(F.col("tile"), image, found)).alias("rows"))


def sn6_selection(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    """tile, path, rings: sampled over quartiles of the number of buildings."""
    tiles = readers.listing(spark, f"{root}/train/images", "*.tif").select("path", F.col("stem").alias("tile"))
    folder = f"{root}/train/labels"
    if readers.exists(spark, folder):
        texts = spark.read.text(f"{folder}/*.geojson", wholetext=True).select(_stem("_metadata.file_path").alias("tile"), readers.rings(F.col("value")).alias("rings"))
        tiles = tiles.join(texts, "tile", "left")
    else:
        tiles = tiles.withColumn("rings", F.lit(None).cast("array<array<array<double>>>"))
    tiles = materialise(tiles.withColumn("rings", F.coalesce("rings", F.array().cast("array<array<array<double>>>"))).withColumn("n", F.size("rings").cast("double")))
    return stats.quantile_sample(tiles, "n", 4, "tile", 0.05 if o.fraction is None else o.fraction, o.seed)


def oscd(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    """Bands other than the three of RGB are never opened."""
    if not readers.exists(spark, f"{root}/images"):
        raise FileNotFoundError(f"{root}/images")
    masks = readers.listing(spark, f"{root}/labels", "*-cm.tif", recursive=True)
    pairs = readers.location_pairs(readers.listing(spark, f"{root}/images", "*.tif", recursive=True), masks).withColumn("source_id", rows.text.location_id(F.col("location")))
    todo = _pending(pairs, o)
    date = lambda c: [F.col(c)[b] for b in ("B04", "B03", "B02")]
    complete = F.lit(True)
    for c in ("before", "after"):
        for b in date(c):
            complete = complete & b.isNotNull()
    if o.output_dir:
        for c in ("before", "after"):
            want = todo.filter(complete).select(F.concat("source_id", F.lit(f"_{c}")).alias("name"), F.posexplode(F.array(*date(c))).alias("k", "path"))
            planes = images.decode(_content(spark, want, f"{root}/images", "*.tif", recursive=True)).drop("error", "content").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("k", "image"))).alias("b"))
            three = planes.select("name", *[F.col("b")[k]["image"].alias(f"i{k}") for k in range(3)])
            _write(images.map_images(three, ["i0", "i1", "i2"], "png", T.BinaryType(), lambda r, g, b: rasters.write_png(rasters.reflectance_rgb(np.stack([r, g, b], axis=-1)))), o)
    path = lambda c: _at(o, F.concat(F.col("source_id"), F.lit(f"_{c}"))) if o.output_dir else date(c)[0]
    return todo.select("source_id", F.lit(0).alias("position"), F.when(complete, rows.location_rows(F.col("location"), path("before"), path("after"))).alias("rows"))


def sardet(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    fraction = 0.10 if o.fraction is None else o.fraction
    files = readers.listing(spark, f"{root}/images").filter(F.col("ext").isin("png", "jpg"))
    lines = readers.yolo_lines(spark, f"{root}/labels")
    kind = F.split(F.trim("line"), r"\s+")[0].try_cast("int")
    name = F.get(F.array(*[F.lit(c) for c in SAR_CATEGORIES]), kind)
    primary = stats.first_class(lines, "stem", "line_no", F.when(F.size(F.split(F.trim("line"), r"\s+")) >= 1, name))
    items = files.join(primary, "stem", "left").withColumn("class_name", F.coalesce("class_name", F.lit("unknown"))).withColumn("ext_ord", F.when(F.col("ext") == "png", 0).otherwise(1))
    chosen = sampling.head(sampling.stratified_sample(materialise(items), ["class_name"], "name", fraction, o.seed), ["ext_ord", "name"], o.max_samples).withColumn("source_id", F.concat(F.lit("sardet_"), "stem"))
    todo = _pending(chosen, o)
    loaded = materialise(images.decode_any(spark, f"{root}/images", todo.select("path", "stem", "source_id", "ext_ord")))
    # of a PNG and a JPEG of one id the first that can be read holds
    sizes = loaded.filter("image IS NOT NULL").select("path", "stem", "source_id", "ext_ord", F.col("image.w").cast("double").alias("w"), F.col("image.h").cast("double").alias("h"))
    first = materialise(sizes.groupBy("source_id").agg(F.min_by(F.struct("path", "stem", "w", "h"), F.struct("ext_ord", "path")).alias("f")).select("source_id", "f.*"))
    if o.output_dir:
        gray = lambda x: rasters.write_png(rasters.radar_rgb((x if x.ndim == 2 else x[:, :, :3].mean(axis=2)).astype(np.float32)))
        _write(images.map_images(loaded.join(first.select("path"), "path", "left_semi"), ["image"], "png", T.BinaryType(), gray).select(F.col("source_id").alias("name"), "png"), o)
    sized = lines.join(first, "stem")
    found = sized.withColumn("a", boxes.yolo_row(F.col("line"), F.col("w"), F.col("h"))).filter("a IS NOT NULL").groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "a"))), lambda x: x["a"]).alias("found"))
    placed = todo.select("source_id").distinct().join(first.join(found, "path", "left"), "source_id", "left")
    image = _at(o, F.col("source_id")) if o.output_dir else F.col("path")
    return placed.select("source_id", F.lit(0).alias("position"), rows.detection_rows(F.col("source_id"), image, F.col("found")).alias("rows"))


def optical_run(spark: SparkSession, folder: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Samples and selected tiles that the optical run has left in its folder; None for what isn't there."""
    lines, chosen = (readers.first_existing(spark, [f"{folder}/{n}" for n in names]) for names in (("sn6_opt.jsonl",), ("selected_tile_ids.json", "selected_tile_ids")))
    return readers.jsonl(spark, lines).select("id", "image_path", "file", "line_no") if lines else None, sinks.read_selection(spark, chosen) if chosen else None


def sn6_sar(spark: SparkSession, root: str, o: Options = Options(), optical: DataFrame | None = None, selection: DataFrame | None = None, optical_dir: str | None = None) -> DataFrame:
    """optical: samples of the optical run; selection: its tiles (tile); or both from its folder, ``optical_dir``.

    A selection without tiles is none: tiles aren't paired then. Without a picture of the optical run they are sampled uniformly.
    """
    if optical_dir is not None:
        optical, selection = optical_run(spark, optical_dir)
    folder = readers.first_existing(spark, [f"{root}/train/sar", f"{root}/sar", f"{root}/Sentinel-1"]) or f"{root}/train/sar"
    tiles = readers.listing(spark, folder, "*.tif").select("path", F.col("stem").alias("tile"))
    pngs = None
    if optical is not None:
        native = optical.filter(~F.endswith("id", F.lit("_proxy")) & (F.size("image_path") > 0))
        pngs = native.groupBy(F.expr("substring(id, 5)").alias("tile")).agg(F.max_by(F.get("image_path", F.lit(0)), F.struct("file", "line_no") if {"file", "line_no"} <= set(optical.columns) else F.col("id")).alias("optical"))
        pngs = pngs if pngs.limit(1).count() else None
    if selection is not None and selection.limit(1).count():
        tiles = tiles.join(selection.select("tile"), "tile", "left_semi")
    fraction = 0.05 if o.fraction is None else o.fraction
    if pngs is None and fraction < 1:
        tiles = sampling.uniform_sample(tiles, "tile", fraction, o.seed)
    chosen = sampling.head(tiles, ["tile"], o.max_samples).withColumn("source_id", F.concat(F.lit("sn6_sar_"), "tile"))
    todo = _pending(chosen, o)
    todo = todo.join(pngs, "tile", "left") if pngs is not None else todo.withColumn("optical", F.lit(None).cast("string"))
    if o.output_dir:
        todo = materialise(todo)

        def colour(x):
            x = x.astype(np.float32)
            return rasters.write_png(rasters.radar_rgb(x[:, :, 1], x[:, :, 2], x[:, :, 0]) if x.ndim == 3 and x.shape[2] >= 3 else rasters.radar_rgb(x if x.ndim == 2 else x[:, :, 0]))

        radar = materialise(images.see(_content(spark, todo.select("path", "source_id"), folder, "*.tif"), "png", T.BinaryType(), colour).select("source_id", "png"))
        _write(radar.withColumnRenamed("source_id", "name"), o)
        # a picture of both, side by side
        left = stores.read_selected(todo.filter("optical IS NOT NULL").select("tile", "source_id", F.col("optical").alias("path"))).drop("error")
        both = left.join(radar.withColumnRenamed("png", "right"), "source_id")
        joined = images.map_images(both, ["content", "right"], "png", T.BinaryType(), rasters.concat_png)
        _write(joined.select(F.concat(F.lit("sn6_fusion_"), "tile").alias("name"), "png"), o)
    image = _at(o, F.col("source_id")) if o.output_dir else F.col("path")
    return todo.select("source_id", F.lit(0).alias("position"), rows.radar_tile_rows(F.col("tile"), image, F.col("optical")).alias("rows"))


def sen2lulc(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    items = materialise(readers.land_cover_labels(spark, root).withColumn("key", F.coalesce(F.col("position").cast("string"), F.lit(""))).withColumn("stratum", F.coalesce("label", F.lit("unknown"))))
    chosen = sampling.head(sampling.stratified_sample(items, ["stratum"], "key", 0.05 if o.fraction is None else o.fraction, o.seed), ["position"], o.max_samples)
    named = chosen.withColumn("source_id", F.concat(F.lit("sen2lulc_"), F.coalesce("image_id", F.col("position").cast("string"))))
    files = lambda names: readers.listing(spark, readers.first_existing(spark, [f"{root}/{d}" for d in names]) or f"{root}/{names[0]}")
    placed = readers.first_image(_pending(named, o), files(("images", "Images", "img")), "image_id", ("png", "jpg", "tif"))
    box = None
    if o.masks:
        placed = readers.first_image(placed, files(("masks", "Masks", "label", "labels")), "image_id", ("png", "tif"), "mask")
        folder = readers.first_existing(spark, [f"{root}/{d}" for d in ("masks", "Masks", "label", "labels")])
        if folder:
            boxes_of = lambda x: rasters.class_boxes(x, len(LAND_COVER))
            masks = _content(spark, placed.filter("mask IS NOT NULL").select(F.col("mask").alias("path")).distinct(), folder, "*.{png,tif}")
            made = images.see(masks, "boxes", T.ArrayType(T.ArrayType(T.DoubleType())), boxes_of).select(F.col("path").alias("mask"), "boxes")
            placed = placed.join(made, "mask", "left")
            box = F.when(F.size("boxes") > 0, F.col("boxes"))
    return placed.select("source_id", "position", F.when(F.coalesce("image_id", F.lit("")) != "", rows.land_cover_rows(F.col("source_id"), F.col("image"), F.col("label"), box)).alias("rows"))


def bigen(spark: SparkSession, root: str, o: Options = Options()) -> DataFrame:
    """Patches in the order of metadata.parquet, with arrays s2_npy/<patch>.npy (needed) and s1_npy/<patch>.npy."""
    meta = readers.first_existing(spark, [f"{root}/metadata.parquet"])
    if not meta:
        return spark.createDataFrame([], "source_id string, position int, rows array<struct<id:string>>")
    limit = 60_000 if o.max_samples is None else o.max_samples
    items = readers.patches(spark, meta).filter(F.col("position") < limit).withColumn("source_id", padded(F.col("position"), 8, "bigen_"))
    todo = _pending(items, o)
    s2 = readers.listing(spark, f"{root}/s2_npy", "*.npy").select(F.col("stem").alias("patch"), F.col("path").alias("p2"))
    s1 = readers.listing(spark, f"{root}/s1_npy", "*.npy").select(F.col("stem").alias("patch"), F.col("path").alias("p1"))
    placed = todo.join(s2, "patch", "left").join(s1, "patch", "left")
    optical, radar = F.col("p2"), F.col("p1")
    if o.output_dir:
        placed = materialise(placed)

        def coloured(sub: str, path: str, out: str, function) -> DataFrame:
            names = placed.filter(F.col(path).isNotNull()).select(F.col(path).alias("path"), "source_id")
            return images.see(_content(spark, names, f"{root}/{sub}", "*.npy"), out, T.BinaryType(), function).select("source_id", out)

        made = coloured("s2_npy", "p2", "png", lambda x: rasters.write_png(rasters.multispectral_rgb(np.moveaxis(x, -1, 0))))
        sar = lambda x: rasters.write_png(rasters.radar_rgb(x[:, :, 0].astype(np.float32), x[:, :, 1].astype(np.float32)))
        made = made.join(coloured("s1_npy", "p1", "sar", sar), "source_id", "left")
        made = materialise(made)
        both = images.map_images(made.filter("png IS NOT NULL AND sar IS NOT NULL"), ["png", "sar"], "both", T.BinaryType(), rasters.concat_png)
        for frame, end, column in ((made, "_optical", "png"), (made, "_sar", "sar"), (both, "_concat", "both")):
            _write(frame.select(F.concat("source_id", F.lit(end)).alias("name"), F.col(column).alias("png")), o)
        seen = made.select("source_id", F.col("png").isNotNull().alias("has"), F.col("sar").isNotNull().alias("has_sar"))
        placed = placed.join(seen, "source_id", "left")
        optical, radar = F.when(F.col("has"), _at(o, F.concat("source_id", F.lit("_optical")))), F.when(F.col("has_sar"), _at(o, F.concat("source_id", F.lit("_sar"))))
    return placed.select("source_id", "position", F.when(optical.isNotNull(), rows.patch_rows(F.col("position"), F.col("labels"), optical, radar)).alias("rows"))


RECIPES = {f.__name__: f for f in (bigen, vrsbench, rsvqa_hr, cdvqa, levir_cd, sn6_opt, oscd, sardet, sn6_sar, sen2lulc)}

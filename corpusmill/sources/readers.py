"""Readers of the sources: JSON lines, JSON arrays, CSV, label texts, listings of folders."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import band_of, strip
from ..operators.tables import join_small, materialise
from ..schema import SAMPLE
from . import json_arrays, stores
from .stores import exists

CONVERSATION = T.StructType([T.StructField("id", T.StringType()), T.StructField("image", T.StringType()), T.StructField("conversations", T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())])))])
QUESTION = T.StructType([T.StructField(n, T.StringType()) for n in ("question_id", "id", "question", "answer", "image_id", "before", "after")])
LABELLED = T.StructType([T.StructField(n, T.StringType()) for n in ("image_id", "id", "label", "class")])


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def numbered(rows: DataFrame, out: str) -> DataFrame:
    """Adds the place (from 0) of each row among all, in the order of files' names and of rows in a file; rows: file, at (the offset of
    their split) and others. Only the rows of a split are counted; nothing is sorted or brought together."""
    marked = materialise(rows.withColumn("_i", F.monotonically_increasing_id()))
    splits = marked.groupBy("file", "at").agg(F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_first"))
    before = Window.orderBy("file", "at").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "at", "_first", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    others = [c for c in rows.columns if c not in ("file", "at")]
    return join_small(marked, starts, ["file", "at"]).select((F.col("_before") + F.col("_i") - F.col("_first")).alias(out), *others)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_no (from 1) and line of text files, which are split among tasks like any others."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("line"))
    # a split's lines stand together; splits of a file are ordered by their offset
    marked = materialise(lines.withColumn("_i", F.monotonically_increasing_id()))
    splits = marked.groupBy("file", "at").agg(F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_first"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "at", "_first", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    return marked.join(F.broadcast(starts), ["file", "at"]).select("file", (F.col("_before") + F.col("_i") - F.col("_first") + 1).alias("line_no"), "line")


def jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType = SAMPLE) -> DataFrame:
    """Rows of JSON lines with file and line_no; blank lines are skipped, a bad line raises."""
    rows = numbered_lines(spark, path).filter(strip(F.col("line")) != "")
    return rows.select("file", "line_no", F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r")).select("file", "line_no", "r.*")


def head_lines(spark: SparkSession, path: str, n: int = 100, schema: T.StructType = SAMPLE) -> DataFrame:
    """Rows of the first n physical lines; blank ones count. Of one file only its beginning is read."""
    text = spark.read.text(path)
    if len(text.inputFiles()) <= 1:
        lines = spark.createDataFrame([(k, r.value) for k, r in enumerate(text.head(n), 1)], "line_no long, line string")
    else:
        lines = numbered_lines(spark, path)
    rows = lines.filter((F.col("line_no") <= n) & (strip(F.col("line")) != ""))
    return rows.select("line_no", F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r")).select("line_no", "r.*")


def json_array(spark: SparkSession, path: str, schema: T.StructType, wrappers: tuple[str, ...] = ()) -> DataFrame:
    """Entries of one JSON file with their position; the file is read by as many tasks as it has splits."""
    return json_arrays.read(spark, path, schema, wrappers)


def _none(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField("position", T.IntegerType()), *schema.fields]))


def conversations(spark: SparkSession, root: str) -> DataFrame:
    """Conversation entries; the file must be there."""
    path = f"{root}/VRSBench_train.json"
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return json_array(spark, path, CONVERSATION)


def questions(spark: SparkSession, root: str) -> DataFrame:
    """Questions of train.json, else of questions.json, else none."""
    path = first_existing(spark, [f"{root}/train.json", f"{root}/questions.json"])
    return json_array(spark, path, QUESTION, ("questions", "data")) if path else _none(spark, QUESTION)


def change_questions(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Questions of the train or val split; other splits are refused; none without the file."""
    if split not in ("train", "val"):
        raise ValueError(f"split {split!r} must not be used")
    path = f"{root}/{split}.json"
    return json_array(spark, path, QUESTION, ("questions", "data")) if exists(spark, path) else _none(spark, QUESTION)


def change_questions_all(spark: SparkSession, root: str) -> DataFrame:
    """train, then val; positions go on across the two."""
    train, val = (change_questions(spark, root, s) for s in ("train", "val"))
    n = train.count()
    return train.unionByName(val.withColumn("position", F.col("position") + n))


def land_cover_labels(spark: SparkSession, root: str) -> DataFrame:
    """position, image_id and label, all strings: CSV before JSON; none without either."""
    path = f"{root}/metadata.csv"
    if exists(spark, path):
        rows = spark.read.csv(path, header=True, inferSchema=False)
        have = {c.lower(): c for c in rows.columns}
        named = [(F.col(f"`{have[c]}`") if c in have else F.lit(None).cast("string")).alias(c) for c in LABELLED.fieldNames()]
        rows = numbered(rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), *named), "position")
    else:
        path = first_existing(spark, [f"{root}/annotations.json"])
        rows = json_array(spark, path, LABELLED, ("annotations", "data")) if path else _none(spark, LABELLED)
    return rows.select("position", F.coalesce("image_id", "id").alias("image_id"), F.coalesce("label", "class").alias("label"))


def patches(spark: SparkSession, path: str) -> DataFrame:
    """position (from 0, in the order of the file), patch and labels of a table of patches."""
    items = spark.read.parquet(path)
    key = F.coalesce(*[F.col(c).cast("string") for c in ("patch_id", "id") if c in items.columns])
    rows = items.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.trim(key).alias("patch"), F.col("labels") if "labels" in items.columns else F.lit(None).cast("array<long>").alias("labels"))
    sizes = rows.groupBy("file").agg(F.max("row").alias("last"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("start"))
    return rows.join(F.broadcast(starts), "file").select((F.col("start") + F.col("row")).alias("position"), "patch", "labels")


def listing(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """path, name, stem, ext and size of the files of a folder that fit the glob, empty ones too, without their content; nothing if the
    folder isn't there. Names that start with '_' or '.' are left out, as Spark's own sources do."""
    if not exists(spark, path):
        files = spark.createDataFrame([], "path string, size long")
    else:
        files = stores.files_below(spark, path, recursive)
    name = F.substring_index("path", "/", -1)
    # fnmatch has no braces, which Spark's globs have
    parts = re.split(r"\{([^}]*)\}", glob)
    kinds = [parts[0] + x + (parts[2] if len(parts) > 2 else "") for x in (parts[1].split(",") if len(parts) > 1 else [""])]
    wanted = "|".join(f"(?:{fnmatch.translate(k).removesuffix('\\Z').removesuffix('\\z')})" for k in kinds)
    files = files.filter(~name.rlike("^[._]") & name.rlike(f"^(?:{wanted})$"))
    return files.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("ext"), "size")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, by the file system that Spark uses for it; none if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in store.listStatus(p)) if store.exists(p) else []


def first_image(items: DataFrame, files: DataFrame, key: str, extensions: tuple[str, ...], out: str = "image") -> DataFrame:
    """Adds the path of the item's file with the first extension that is there; null without one."""
    priority = F.array_position(F.array(*[F.lit(e) for e in extensions]), F.col("ext"))
    best = files.filter(F.col("ext").isin(*extensions)).groupBy("stem").agg(F.min_by("path", priority).alias(out))
    return items.join(best, items[key] == best["stem"], "left").drop("stem")


def before_after(a: DataFrame, b: DataFrame, labels: DataFrame) -> DataFrame:
    """base, before, after and mask (or null) of listings of two dates: x_1, x_2 and x."""
    base = F.regexp_replace("stem", r"_1$", "")
    left = a.select(base.alias("base"), F.col("path").alias("before"))
    right = b.filter(F.endswith("stem", F.lit("_2"))).select(F.regexp_replace("stem", r"_2$", "").alias("base"), F.col("path").alias("after"))
    return left.join(right, "base").join(labels.select(F.col("stem").alias("base"), F.col("path").alias("mask")), "base", "left")


def location_pairs(files: DataFrame, masks: DataFrame | None = None) -> DataFrame:
    """location, the band files of both dates, and mask (or null), from recursive listings of <location>/imgs_{1,2}/* and of
    <location>/cm/<location>-cm.tif; only locations with both dates."""
    parts = files.select("path", F.regexp_extract("path", r"/([^/]+)/imgs_([12])/[^/]+$", 1).alias("location"), F.regexp_extract("path", r"/imgs_([12])/[^/]+$", 1).alias("date"), band_of(F.col("name")).alias("band"))
    per = parts.filter("location != ''").groupBy("location").agg(*[F.map_from_entries(F.array_sort(F.collect_set(F.when((F.col("date") == d) & F.col("band").isNotNull(), F.struct("band", "path"))))).alias(n) for d, n in (("1", "before"), ("2", "after"))], F.count_distinct("date").alias("dates"))
    pairs = per.filter("dates = 2").drop("dates")
    if masks is None:
        return pairs.withColumn("mask", F.lit(None).cast("string")).orderBy("location")
    found = masks.select(F.regexp_extract("path", r"/([^/]+)/cm/([^/]+)-cm\.tif$", 1).alias("location"), F.regexp_extract("path", r"/([^/]+)/cm/([^/]+)-cm\.tif$", 2).alias("again"), F.col("path").alias("mask"))
    return pairs.join(found.filter("location != '' AND location = again").select("location", "mask"), "location", "left").orderBy("location")


def rings(text: Column) -> Column:
    """Outer rings of the polygons of a GeoJSON text; none for a missing or bad one."""
    point = T.ArrayType(T.DoubleType())
    ring_list = T.ArrayType(T.ArrayType(point))
    geo = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    features = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("geometry", geo)])))])

    def outer(f):
        g = f["geometry"]
        one = F.slice(F.from_json(g["coordinates"], ring_list), 1, 1)
        many = F.transform(F.from_json(g["coordinates"], T.ArrayType(ring_list)), lambda p: F.get(p, F.lit(0)))
        return F.when(g["type"] == "Polygon", one).when(g["type"] == "MultiPolygon", many).otherwise(F.array().cast(ring_list))

    return F.coalesce(F.flatten(F.transform(F.from_json(text, features)["features"], outer)), F.array().cast(ring_list))


def yolo_lines(spark: SparkSession, path: str) -> DataFrame:
    """stem, line_no and line of label texts."""
    return numbered_lines(spark, f"{path}/*.txt").select(F.regexp_replace(F.substring_index("file", "/", -1), r"\.txt$", "").alias("stem"), "line_no", "line")

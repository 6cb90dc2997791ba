"""Queries of the catalogue that write files and read them again: sources, sinks, rasters, whole runs, recipes.

Their files come from the given tables and lie in a folder of their own below the shared one.
"""

from __future__ import annotations

import io
import math
import struct
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rasters
from ..operators import images, manifest, stats
from ..operators.tables import fresh_folder
from ..schema import CORINE, LAND_COVER, SAR_CATEGORIES
from ..sources import readers, sinks, stores
from . import checks, packaging, recipes, rows, training
from .catalog import _BANDS, _PIXELS, S, J, _sampled, query, samples, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LISTED = "['png', 'jpg', 'tif']"


def _one_json(df: DataFrame, path: str, order: str, wrapper: str | None = None) -> None:
    """One JSON file of all rows in order, as a list or under a name."""
    cols = [c for c in df.columns if c != order]
    every = F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*cols).alias("r")))), lambda x: x["r"])
    df.agg(F.to_json(F.struct(every.alias(wrapper)) if wrapper else every).alias("value")).coalesce(1).write.text(path)


def _files(df: DataFrame, folder: str, path, content=None) -> None:
    """Small files at folder/path; their content is a column of bytes, or a text."""
    sinks.write_files(df.select(path.alias("path"), (F.lit("x").cast("binary") if content is None else content).alias("content")), "path", "content", folder)


#: Files that a task writes at most, about.
_FILES_PER_TASK = 10_000


def _dealt(df: DataFrame) -> DataFrame:
    """Rows of a few bytes, each of which becomes a file, dealt to tasks of a bounded number of them."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / _FILES_PER_TASK)))


def _tiff(a: np.ndarray) -> bytes:
    """A TIFF of one strip, little-endian, uncompressed."""
    a = a if a.ndim == 3 else a[:, :, None]
    data = a.astype(a.dtype.newbyteorder("<")).tobytes()
    tags = [(256, a.shape[1]), (257, a.shape[0]), (258, a.dtype.itemsize * 8), (259, 1), (262, 1), (273, 8), (277, a.shape[2]), (278, a.shape[0]), (279, len(data)), (339, {"u": 1, "i": 2, "f": 3}[a.dtype.kind])]
    return struct.pack("<2sHI", b"II", 42, 8 + len(data)) + data + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags) + b"\0\0\0\0"


def _npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a)
    return out.getvalue()


# ---- lines, arrays, tables

_FLAT = "id, dataset, task, pair_type, gsd_bucket, split, instruction, response, modality"


@query(f"WITH {S} SELECT {_FLAT}, CAST(len(image_path) AS BIGINT) AS n_images, bbox[1][1] AS x1, bbox[1][4] AS y2 FROM s")
def jsonl_round_trip(spark, d):
    """Samples written as JSON lines in two steps, the second appended, and read again."""
    home, s = fresh_folder(spark), samples(spark, d)
    sinks.write_jsonl(s.filter("k % 2 = 0"), f"{home}/s.jsonl")
    sinks.write_jsonl(s.filter("k % 2 = 1"), f"{home}/s.jsonl", append=True)
    back = readers.jsonl(spark, f"{home}/s.jsonl")
    return back.select(*_FLAT.split(", "), F.size("image_path").cast("long").alias("n_images"), F.get(F.col("bbox")[0], F.lit(0)).alias("x1"), F.get(F.col("bbox")[0], F.lit(3)).alias("y2"))


@query("SELECT rn AS line_no, concat('d_', doc_id) AS id, source AS dataset FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 100 AND doc_id % 7 <> 3")
def head_lines(spark, d):
    """The first hundred lines of a file, of which blank ones count but give no row."""
    home = fresh_folder(spark)
    line = F.when(F.col("doc_id") % 7 == 3, "  ").otherwise(F.to_json(F.struct(F.concat(F.lit("d_"), F.col("doc_id").cast("string")).alias("id"), F.col("source").alias("dataset"))))
    table(spark, d, "documents").orderBy("doc_id").select(line.alias("value")).coalesce(1).write.text(f"{home}/d.jsonl")
    return readers.head_lines(spark, f"{home}/d.jsonl").select("line_no", "id", "dataset")


@query("SELECT n_regionkey AS file, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS line_no, n_name AS line FROM nation")
def line_numbers(spark, d):
    """Lines numbered within their files."""
    home = fresh_folder(spark)
    n = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]), "\n").alias("t"))
    _files(n, home, F.concat(F.lit("f"), F.col("n_regionkey").cast("string"), F.lit(".txt")), F.col("t").cast("binary"))
    return readers.numbered_lines(spark, home).select(F.regexp_extract("file", r"f(\d+)\.txt$", 1).cast("int").alias("file"), "line_no", "line")


@query(
    """SELECT CAST(row_number() OVER (ORDER BY p_partkey % 2, p_partkey) - 1 AS INTEGER) AS position, p_name AS question, p_type AS answer, concat(p_partkey, '/1.png') AS before FROM part"""
)
def json_array_scan(spark, d):
    """Questions of a train and a val file, one wrapped and one plain; positions go on across both."""
    home, p = fresh_folder(spark), table(spark, d, "part")
    q = p.select("p_partkey", F.col("p_name").alias("question"), F.col("p_type").alias("answer"), F.concat(F.col("p_partkey").cast("string"), F.lit("/1.png")).alias("before"))
    _one_json(q.filter("p_partkey % 2 = 0"), f"{home}/train.json", "p_partkey", "questions")
    _one_json(q.filter("p_partkey % 2 = 1"), f"{home}/val.json", "p_partkey")
    return readers.change_questions_all(spark, home).select(F.col("position").cast("int").alias("position"), "question", "answer", "before")


@query("SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS position, CAST(p_partkey AS VARCHAR) AS id, concat(p_brand, '.png') AS image, CAST(2 AS INTEGER) AS turns, p_name AS human, p_type AS gpt FROM part")
def conversation_scan(spark, d):
    home, p = fresh_folder(spark), table(spark, d, "part")
    turn = lambda who, c: F.struct(F.lit(who).alias("from"), F.col(c).alias("value"))
    entries = p.select("p_partkey", F.col("p_partkey").cast("string").alias("id"), F.concat("p_brand", F.lit(".png")).alias("image"), F.array(turn("human", "p_name"), turn("gpt", "p_type")).alias("conversations"))
    _one_json(entries, f"{home}/VRSBench_train.json", "p_partkey")
    return readers.conversations(spark, home).select(F.col("position").cast("int").alias("position"), "id", "image", F.size("conversations").alias("turns"), F.col("conversations")[0]["value"].alias("human"), F.col("conversations")[1]["value"].alias("gpt"))


@query("SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS position, concat('i', p_partkey) AS image_id, CAST(p_size AS VARCHAR) AS label FROM part")
def csv_labels(spark, d):
    """A table of labels as CSV: all strings, numbered in the order of the file."""
    home = fresh_folder(spark)
    t = table(spark, d, "part").orderBy("p_partkey").select(F.concat(F.lit("i"), F.col("p_partkey").cast("string")).alias("image_id"), F.col("p_size").alias("label")).coalesce(1)
    t.write.csv(f"{home}/metadata.csv", header=True)
    return readers.land_cover_labels(spark, home).select(F.col("position").cast("long").alias("position"), "image_id", "label")


@query("SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS position, concat('p', p_partkey) AS patch, CAST(p_size AS BIGINT) AS label FROM part")
def patch_scan(spark, d):
    """Patches of a table in several files, numbered in the order of files and rows."""
    home = fresh_folder(spark)
    t = table(spark, d, "part").repartitionByRange(3, "p_partkey").sortWithinPartitions("p_partkey")
    t.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("patch_id"), F.array(F.col("p_size").cast("long")).alias("labels")).write.parquet(f"{home}/metadata.parquet")
    return readers.patches(spark, f"{home}/metadata.parquet").select("position", "patch", F.col("labels")[0].alias("label"))


# ---- listings

_STEM = "CAST(s_suppkey AS VARCHAR)"


@query(f"SELECT concat('s', {_STEM}, '.', {_LISTED}[CAST(s_suppkey % 3 AS INTEGER) + 1]) AS name, concat('s', {_STEM}) AS stem, {_LISTED}[CAST(s_suppkey % 3 AS INTEGER) + 1] AS ext, length(s_name) AS size FROM supplier")
def folder_listing(spark, d):
    home = fresh_folder(spark)
    ext = F.array(*[F.lit(e) for e in ("png", "jpg", "tif")])[(F.col("s_suppkey") % 3).cast("int")]
    _files(table(spark, d, "supplier"), f"{home}/images", F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit("."), ext), F.col("s_name").cast("binary"))
    return readers.listing(spark, f"{home}/images").select("name", "stem", "ext", "size")


@query(f"SELECT concat('t', {_STEM}) AS base, concat('A/t', {_STEM}, '_1.png') AS before, concat('B/t', {_STEM}, '_2.png') AS after, CASE WHEN s_suppkey % 2 = 0 THEN concat('label/t', {_STEM}, '.png') END AS mask FROM supplier WHERE s_suppkey % 3 <> 0")
def date_pairs(spark, d):
    """Images of two dates and their masks, by their names."""
    s = table(spark, d, "supplier")
    key = F.concat(F.lit("t"), F.col("s_suppkey").cast("string"))

    def listed(folder, end, df):
        stem = F.concat(key, F.lit(end))
        return df.select(stem.alias("stem"), F.concat(F.lit(f"{folder}/"), stem, F.lit(".png")).alias("path"))

    return readers.before_after(listed("A", "_1", s), listed("B", "_2", s.filter("s_suppkey % 3 <> 0")), listed("label", "", s.filter("s_suppkey % 2 = 0"))).select("base", "before", "after", "mask")


@query("SELECT concat('l', o_custkey) AS location, count(DISTINCT concat('B0', o_orderkey % 9)) FILTER (o_orderkey % 2 = 0) AS before, count(DISTINCT concat('B0', o_orderkey % 9)) FILTER (o_orderkey % 2 = 1) AS after, CASE WHEN o_custkey % 3 = 0 THEN concat('/r/labels/l', o_custkey, '/cm/l', o_custkey, '-cm.tif') END AS mask FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderkey % 2) = 2")
def location_bands(spark, d):
    """Bands of both dates of a location, and its mask."""
    o = table(spark, d, "orders").select(F.concat(F.lit("l"), F.col("o_custkey").cast("string")).alias("l"), F.concat(F.lit("x_B0"), (F.col("o_orderkey") % 9).cast("string"), F.lit(".tif")).alias("name"), (F.col("o_orderkey") % 2 + 1).cast("string").alias("date"), "o_custkey")
    files = o.select("name", F.concat(F.lit("/r/images/"), "l", F.lit("/imgs_"), "date", F.lit("/"), "name").alias("path"))
    masks = o.filter("o_custkey % 3 = 0").select("l").distinct().select(F.concat(F.lit("/r/labels/"), "l", F.lit("/cm/"), "l", F.lit("-cm.tif")).alias("path"))
    found = readers.location_pairs(files, masks)
    return found.select("location", F.size("before").cast("long").alias("before"), F.size("after").cast("long").alias("after"), "mask")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS tile FROM supplier WHERE s_acctbal > 0")
def selection_file(spark, d):
    """Chosen ids written, and read as a selection."""
    home = fresh_folder(spark)
    sinks.write_selection(table(spark, d, "supplier").filter("s_acctbal > 0"), "s_suppkey", f"{home}/selected")
    return spark.read.text(f"{home}/selected").withColumnRenamed("value", "tile")


def _structure_sql() -> str:
    """Counts of the same patterns in another engine."""
    parts = []
    for name, kinds in checks.CHECKS.items():
        for k, group in kinds:
            hit = f"regexp_matches(path, '{k.pattern}')"
            n = f"count(DISTINCT CASE WHEN {hit} THEN regexp_extract(path, '{k.distinct}', 1) END)" if k.distinct else f"count(*) FILTER ({hit})"
            parts.append(f"SELECT '{name}' AS source, '{k.name}' AS kind, {n} AS count, {k.least} AS needed, {k.expected} AS expected, '{group}' AS any_of FROM f")
    paths = "SELECT concat('/r/', ['images', 'train/images', 'train/A', 'train/B', 'train/sar', 'train/labels', 'labels', 's2_npy', 'images/loc' || page_id // 40 || '/imgs_' || (page_id % 2 + 1)][CAST(page_id % 9 AS INTEGER) + 1], '/', page_id, ['.png', '.tif', '.png', '.png', '.tif', '.geojson', '.txt', '.npy', '_B04.tif'][CAST(page_id % 9 AS INTEGER) + 1]) AS path FROM pages UNION ALL SELECT unnest(['/r/train.json', '/r/metadata.csv', '/r/VRSBench_train.json', '/r/Images_val.zip', '/r/metadata.parquet'])"
    return f"WITH f AS ({paths}) SELECT *, CASE WHEN count < needed THEN 'missing' WHEN count < expected THEN 'warn' ELSE 'ok' END AS status FROM ({' UNION ALL '.join(parts)})"


@query(_structure_sql())
def structure_of_sources(spark, d):
    """The counts and verdicts of every source's check on one mixed folder."""
    k = F.col("page_id")
    pick = lambda xs: F.get(F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs]), (k % 9).cast("int"))
    place = F.concat(F.lit("images/loc"), F.floor(k / 40).cast("string"), F.lit("/imgs_"), (k % 2 + 1).cast("string"))
    folder = pick(["images", "train/images", "train/A", "train/B", "train/sar", "train/labels", "labels", "s2_npy", place])
    files = table(spark, d, "pages").select(F.concat(F.lit("/r/"), folder, F.lit("/"), k.cast("string"), pick([".png", ".tif", ".png", ".png", ".tif", ".geojson", ".txt", ".npy", "_B04.tif"])).alias("path"))
    more = ["/r/train.json", "/r/metadata.csv", "/r/VRSBench_train.json", "/r/Images_val.zip", "/r/metadata.parquet"]
    files = files.union(spark.range(1).select(F.explode(F.array(*[F.lit(p) for p in more]))))
    every = [checks.judge(files, name).withColumn("source", F.lit(name)) for name in checks.CHECKS]
    out = every[0]
    for x in every[1:]:
        out = out.unionByName(x)
    return out.select("source", "kind", "count", "needed", "expected", "any_of", "status")


# ---- sinks and whole runs


@query(f"WITH {S} SELECT id, split FROM s")
def split_files(spark, d):
    """Samples written to a folder for each split, and read again."""
    home = fresh_folder(spark)
    sinks.write_split(samples(spark, d), f"{home}/s")
    return spark.read.text(f"{home}/s").select(F.get_json_object("value", "$.id").alias("id"), "split")


def _members(spark: SparkSession, folder: str) -> DataFrame:
    """tar and name of what the tars of a folder hold."""
    import tarfile

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").load(folder).select(F.substring_index("path", "/", -1).alias("tar"), "content")
    names = images.map_images(found, ["content"], "names", T.ArrayType(T.StringType()), lambda data: tarfile.open(fileobj=io.BytesIO(data)).getnames())
    return names.select("tar", F.posexplode("names").alias("place", "name"))


_TARS = "SELECT printf('{p}_shard_%04d.tar.gz', (rn - 1) // {n}) AS tar, CAST((rn - 1) % {n} AS INTEGER) AS place, name FROM (SELECT name, row_number() OVER (ORDER BY {o}) AS rn FROM ({t}))"


@query(_TARS.format(p="s", n=20, o="name", t="SELECT concat('s', s_suppkey, '.txt') AS name FROM supplier"))
def tar_shards(spark, d):
    home = fresh_folder(spark)
    sinks.write_shards(table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(".txt")).alias("path"), F.col("s_name").cast("binary").alias("content")), home, "s", 20)
    return _members(spark, home)


@query(_TARS.format(p="t", n=15, o="path", t="SELECT concat('s', s_suppkey, '.txt') AS name, concat(s_nationkey, '/s', s_suppkey, '.txt') AS path FROM supplier"))
def tar_folder(spark, d):
    """All files of a folder but its lists, empty ones too, in tars."""
    home, s = fresh_folder(spark), table(spark, d, "supplier")
    path = F.concat(F.col("s_nationkey").cast("string"), F.lit("/s"), F.col("s_suppkey").cast("string"), F.lit(".txt"))
    _files(s, f"{home}/src", path, F.when(F.col("s_suppkey") % 4 == 0, F.lit("")).otherwise(F.col("s_name")).cast("binary"))
    _files(s.limit(1), f"{home}/src", F.lit("list.jsonl"))
    sinks.write_folder_shards(spark, f"{home}/src", f"{home}/tars", "t", 15)
    return _members(spark, f"{home}/tars")


def _tiers(spark, d) -> list[str]:
    """Two folders of samples: files that a split has replaced, ids that occur in several files."""
    home, s = fresh_folder(spark), samples(spark, d)
    for part, name in (("k % 2 = 0", "one/a"), ("k % 4 = 1", "one/b"), ("k % 3 = 0", "one/b_train"), ("k % 5 = 0", "two/a"), ("k % 7 = 0", "two/c")):
        sinks.write_jsonl(s.filter(part), f"{home}/{name}.jsonl")
    return [f"{home}/one", f"{home}/two"]


_MERGED = f"""{J}, f AS (SELECT *, 0 AS tier_ord, 'a' AS stem FROM j WHERE k % 2 = 0 UNION ALL SELECT *, 0, 'b_train' FROM j WHERE k % 3 = 0 UNION ALL SELECT *, 1, 'a' FROM j WHERE k % 5 = 0 UNION ALL SELECT *, 1, 'c' FROM j WHERE k % 7 = 0),
  v AS (SELECT * FROM f WHERE len(errors) = 0), u AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tier_ord, stem, k) AS rn FROM v)"""


@query(f"WITH {_MERGED} SELECT id, tier_ord, stem, response FROM u WHERE rn = 1")
def merge_tiers(spark, d):
    """Valid samples of all tiers, the first of each id."""
    from ..operators import corpus

    valid, _ = packaging.merge(spark, _tiers(spark, d))
    return corpus.keep_first(valid, ["id"], [*corpus.ORDER[:2], "file", "line_no"]).select("id", "tier_ord", "stem", "response")


_COUNTED = " UNION ALL ".join(f"SELECT 'by_{f}', {f}, count(*) FROM u WHERE rn = 1 GROUP BY {f}" for f in ("dataset", "task", "pair_type", "modality", "split"))


@query(
    f"""WITH {_MERGED} SELECT 'total_samples' AS field, '' AS value, count(*) AS count FROM u WHERE rn = 1 UNION ALL {_COUNTED} UNION ALL SELECT 'errors', '', count(*) FROM f WHERE len(errors) > 0
  UNION ALL SELECT 'duplicate_ids', '', count(*) FROM (SELECT id FROM v GROUP BY id HAVING count(*) > 1) UNION ALL SELECT 'image_paths', 'single', count(*) FILTER (len(image_path) = 1) FROM u WHERE rn = 1 UNION ALL SELECT 'image_paths', 'paired', count(*) FILTER (len(image_path) = 2) FROM u WHERE rn = 1
  UNION ALL SELECT 'written', '', count(*) FROM u WHERE rn = 1"""
)
def merge_package(spark, d):
    """Tiers merged, validated, de-duplicated, written and counted: the numbers of stats.json, and of the lines written."""
    tiers = _tiers(spark, d)
    packaging.merge_and_package(spark, tiers, f"{tiers[0]}/../out")
    text = spark.read.text(f"{tiers[0]}/../out/stats.json", wholetext=True)
    fields = F.from_json("value", "map<string,string>")
    one = text.select(F.explode(fields).alias("field", "v")).filter("field <> 'bbox_coverage'")
    flat = one.filter(~F.startswith("v", F.lit("{"))).select("field", F.lit("").alias("value"), F.col("v").cast("long").alias("count"))
    nested = one.filter(F.startswith("v", F.lit("{"))).select("field", F.explode(F.from_json("v", "map<string,bigint>")).alias("value", "count"))
    written = readers.jsonl(spark, f"{tiers[0]}/../out/dataset.jsonl").agg(F.lit("written").alias("field"), F.lit("").alias("value"), F.count(F.lit(1)).alias("count"))
    return flat.union(nested).union(written)


@query(
    f"""WITH {S}, g AS (SELECT dataset, task, count(*) AS n FROM s GROUP BY dataset, task), v AS (SELECT dataset, CAST(sum(n) AS BIGINT) AS total, CAST(sum(CASE WHEN n > 1 THEN least(greatest(1, floor(n * 0.03)), n - 1) ELSE 0 END) AS BIGINT) AS val FROM g GROUP BY dataset)
  SELECT dataset || '.jsonl' AS file, total, total - val AS train, val, total - val AS written FROM v"""
)
def split_all(spark, d):
    """Every file of a folder split by dataset and task: the counts, and the lines of the training files."""
    home, s = fresh_folder(spark), samples(spark, d)
    names = sorted(r[0] for r in s.select("dataset").distinct().collect())
    for name in names:
        sinks.write_jsonl(s.filter(F.col("dataset") == name), f"{home}/{name}.jsonl")
    found = packaging.split_all(spark, home)
    written = spark.read.text([f"{home}/{n}_train.jsonl" for n in names]).groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)_train\.jsonl/", 1).alias("stem")).agg(F.count(F.lit(1)).alias("written"))
    return found.join(written, F.col("file") == F.concat("stem", F.lit(".jsonl"))).drop("stem")


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'P'")
def manifest_log(spark, d):
    """Two runs add what they processed to the log; the third has the rest to do."""
    home, o = fresh_folder(spark), table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"))
    for status in ("F", "O"):
        run = o.select(F.col("id").alias("source_id"), F.when(F.col("status") == status, "processed").otherwise("failed").alias("outcome"))
        manifest.append(run, f"{home}/manifest.jsonl", "orders")
    left = manifest.pending(o, manifest.load(spark, f"{home}/manifest.jsonl"), "ord")
    return left.select(F.col("id").cast("long").alias("id"), "status")


@query(f"SELECT event_type AS band, n, low, high, true AS low_holds, true AS high_holds FROM {_BANDS} JOIN (SELECT event_type, count(value) AS n FROM events WHERE value IS NOT NULL GROUP BY event_type) USING (event_type)")
def percentile_state(spark, d):
    """States of two runs, of which the second is repeated, merged: the exact percentiles of one of values, and whether the ranks of those of
    sketches are within the bound."""
    home, e = fresh_folder(spark), table(spark, d, "events")
    for half in (0, 1, 1):
        stats.save_state(e.filter(F.col("event_id") % 2 == half), "event_type", "value", f"{home}/state", run=f"half{half}")
        stats.save_values(e.filter(F.col("event_id") % 2 == half), "event_type", "value", f"{home}/values", f"half{half}")
    found = stats.percentiles_of_state(spark, f"{home}/state")
    ranks = e.select(F.col("event_type").alias("band"), "value").join(F.broadcast(found), "band").groupBy("band", "n").agg(*[F.count_if(F.col("value") <= F.col(c) if k else F.col("value") < F.col(c)).alias(f"{c}{k}") for c in ("low", "high") for k in (0, 1)])
    # the wanted rank lies between the shares of values below and up to the one given
    holds = lambda c, share: (F.col(f"{c}0") <= (share + stats.RANK_ERROR) * F.col("n") + 1) & (F.col(f"{c}1") >= (share - stats.RANK_ERROR) * F.col("n") - 1)
    judged = ranks.select("band", "n", holds("low", 0.02).alias("low_holds"), holds("high", 0.98).alias("high_holds"))
    return judged.join(F.broadcast(stats.percentiles_of_values(spark, f"{home}/values")), "band").select("band", "n", "low", "high", "low_holds", "high_holds")


@query("SELECT p_partkey AS line_no, concat('p', p_partkey) AS id FROM part WHERE p_size % 4 IN (0, 2) ORDER BY CASE WHEN p_size % 4 = 0 THEN 'b' ELSE 'a_train' END, p_partkey LIMIT 500")
def training_feed(spark, d):
    """Training rows: files that a split has replaced and validation files are left out, then the first rows."""
    stem = F.get(F.array(F.lit("b"), F.lit("a"), F.lit("a_train"), F.lit("a_val_internal")), (F.col("p_size") % 4).cast("int"))
    feed = table(spark, d, "part").select(stem.alias("stem"), F.col("p_partkey").alias("line_no"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"))
    return training.training_rows(feed, max_samples=500).select("line_no", "id")


# ---- rasters as pixels

_BYTES = "CAST(trunc(least(greatest(v * 128 + 128, 0), 255)) AS INTEGER)"
_WIDE = "CAST(trunc(abs(v) * 60000) AS INTEGER)"


def _values(spark, d, value) -> DataFrame:
    """vec_id and the first values of each vector, which make an 8 x 8 image."""
    return table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 64), lambda v: value(v.cast("double"))).alias("v"))


def _byte(v):
    return F.least(F.greatest(v * 128 + 128, F.lit(0.0)), F.lit(255.0))


def _wide(v):
    return F.abs(v) * 60000


#: Numbers of pixels and their type.
_KINDS = {"byte": (_byte, "|u1"), "wide": (_wide, "<u2"), "real": (lambda v: v, "<f8")}


def _raster(spark, d, value, dtype: str, out: str = "image", kind: T.DataType = images.RASTER, function=lambda a: a) -> DataFrame:
    """vec_id and an 8 x 8 image, or what a function makes of it."""
    return images.from_values(_values(spark, d, value), "v", 8, 8, dtype, out, kind, function).drop("v")


def _coded(spark, d, name: str, out: str, function) -> DataFrame:
    """vec_id, its text n, and the bytes that a function makes of its image."""
    return _named(_raster(spark, d, *_KINDS[name], out, T.BinaryType(), function))


def _rows(found: DataFrame, digits: int | None = None) -> DataFrame:
    return found.select("vec_id", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), (F.col("v").cast("int") if digits is None else F.bround("v", digits)).alias("v"))


def _shown(spark, d, name: str, function) -> DataFrame:
    """vec_id, y, x, v of what a function makes of the images, in one pass."""
    value, dtype = _KINDS[name]
    return images.pixels(_values(spark, d, value), ["v"], lambda v: function(images.of_values(v, 8, 8, dtype)))


@query(f"SELECT vec_id, y, x, {_BYTES} AS v FROM {_PIXELS}")
def raster_png_round_trip(spark, d):
    """Arrays as gray PNGs, read again: every pixel."""
    return _rows(_shown(spark, d, "byte", lambda a: images.read("a.png", rasters.write_png(a))[:, :, 1]))


@query(f"SELECT vec_id, y, x, {_WIDE} AS v FROM {_PIXELS}")
def raster_tiff_round_trip(spark, d):
    """16-bit arrays as TIFFs, read again."""
    return _rows(_shown(spark, d, "wide", lambda a: images.read("a.tif", _tiff(a))))


@query(f"SELECT vec_id, y, x, {_WIDE} AS v FROM {_PIXELS}")
def raster_npy_round_trip(spark, d):
    return _rows(_shown(spark, d, "wide", lambda a: images.read("a.npy", _npy(a))))


_NEAR = "abs(j + 0.5 - (i + 0.5) * 0.25)"
_CUBIC = f"CASE WHEN {_NEAR} < 1 THEN (1.5 * {_NEAR} - 2.5) * {_NEAR} * {_NEAR} + 1 WHEN {_NEAR} < 2 THEN ((-0.5 * {_NEAR} + 2.5) * {_NEAR} - 4) * {_NEAR} + 2 ELSE 0 END"


@query(
    f"""WITH k AS (SELECT i, j, CAST({_CUBIC} AS DOUBLE) AS w FROM (SELECT unnest(range(32)) AS i), (SELECT unnest(range(8)) AS j)), n AS (SELECT i, j, w / sum(w) OVER (PARTITION BY i) AS w FROM k),
  a AS (SELECT vec_id, i AS y, x, sum(w * v) AS v FROM {_PIXELS} JOIN n ON y = j GROUP BY vec_id, i, x), b AS (SELECT vec_id, y, i AS x, sum(w * v) AS v FROM a JOIN n ON x = j GROUP BY vec_id, y, i)
  SELECT vec_id, y, round_even(avg(v), 4) + 0 AS v FROM b GROUP BY vec_id, y"""
)
def raster_proxy(spark, d):
    """Proxies have 32 pixels a side at least: the rows' means."""
    found = _shown(spark, d, "real", rasters.proxy_image)
    return found.groupBy("vec_id", F.col("y").cast("long").alias("y")).agg((F.bround(F.avg("v"), 4) + 0).alias("v"))


@query(f"SELECT vec_id, y, x, {_BYTES} AS v FROM {_PIXELS} UNION ALL SELECT vec_id, y, x + 10, 255 - {_BYTES} FROM {_PIXELS} UNION ALL SELECT vec_id, y, x + 8, 128 FROM {_PIXELS} WHERE x < 2")
def raster_side_by_side(spark, d):
    """A raster beside its negative, through PNGs."""
    both = lambda a: rasters.concat_png(rasters.write_png(a), rasters.write_png(255 - a))
    return _rows(_shown(spark, d, "byte", lambda a: images.read("a.png", both(a))[:, :, 0]))


_TOP = "(SELECT vec_id, list_sort(list(p))[63] AS top FROM (SELECT vec_id, {p} AS p FROM {t}) GROUP BY vec_id)"
_STRETCH = "CAST(trunc(CAST(least({p}, {top}) AS FLOAT) / CAST({top} AS FLOAT) * CAST(255 AS FLOAT)) AS INTEGER)"


@query(f"SELECT vec_id, y, x, {_STRETCH.format(p=_WIDE, top='top')} AS v FROM {_PIXELS} JOIN {_TOP.format(p=_WIDE, t=_PIXELS)} USING (vec_id)")
def raster_stretch(spark, d):
    """Three bands against their common 98th percentile (of equal bands: the last value but one)."""
    return _rows(_shown(spark, d, "wide", lambda a: rasters.multispectral_rgb(np.stack([a * 0, a, a, a]))[:, :, 0]))


@query(f"SELECT vec_id, y, x, {_STRETCH.format(p=_WIDE, top='10000')} AS v FROM {_PIXELS}")
def raster_reflectance(spark, d):
    """16-bit reflectances against 10000."""
    return _rows(_shown(spark, d, "wide", lambda a: rasters.reflectance_rgb(np.stack([a] * 3, axis=-1))[:, :, 2]))


@query(f"SELECT vec_id, y, x, {_STRETCH.format(p=_WIDE, top='top')} AS v FROM {_PIXELS} JOIN {_TOP.format(p=_WIDE, t=_PIXELS)} USING (vec_id)")
def raster_tile(spark, d):
    """A gray 16-bit tile in colour."""
    return _rows(_shown(spark, d, "wide", lambda a: rasters.tile_rgb(a)[:, :, 1]))


@query(f"SELECT vec_id, (y - 1) // 2 AS y, (x - 1) // 2 AS x, CAST({_WIDE} > 3000 AS INTEGER) AS v FROM {_PIXELS} WHERE y % 2 = 1 AND x % 2 = 1")
def raster_mask(spark, d):
    """Binary masks at half the size, by the nearest pixel."""
    return _rows(_shown(spark, d, "wide", lambda a: rasters.binary_mask(np.where(a > 3000, a, 0), (4, 4))))


@query(f"SELECT vec_id, y // 2 AS y, x // 2 AS x, round_even(avg(v), 6) + 0 AS v FROM {_PIXELS} GROUP BY vec_id, y // 2, x // 2")
def raster_downsample(spark, d):
    """The same averages of whole pictures."""
    small = _rows(_shown(spark, d, "real", lambda a: rasters.downsample(a, 1.0, 0.5)), 6)
    return small.withColumn("v", F.col("v") + 0)


_CLASS = "CAST(trunc(abs(v) * 60000) AS INTEGER) % 7"


@query(f"SELECT vec_id, c AS class, round_even(min(x) / 8.0 * 1000, 2) AS x1, round_even(max(y) / 8.0 * 1000, 2) AS y2 FROM (SELECT vec_id, x, y, {_CLASS} AS c FROM {_PIXELS}) GROUP BY vec_id, c")
def raster_class_boxes(spark, d):
    """The boxes of each class of a mask; the classes that are there in order."""
    kind = T.ArrayType(T.StructType([T.StructField("class", T.IntegerType()), T.StructField("box", T.ArrayType(T.DoubleType()))]))
    both = lambda a: [{"class": c, "box": box} for c, box in zip(sorted({int(v) for v in a.ravel()}), rasters.class_boxes(a, 7), strict=True)]
    made = _raster(spark, d, *_KINDS["wide"], "found", kind, lambda a: both(a % 7)).select("vec_id", F.explode("found").alias("z"))
    return made.select("vec_id", F.col("z.class"), F.col("z.box")[0].alias("x1"), F.col("z.box")[3].alias("y2"))


# ---- recipes, from the scan of their folders to validated samples; items that fail are rows of the task ``failed``

_N = "n_nationkey"


def _result(done: DataFrame) -> DataFrame:
    box = F.when(F.size("bbox") > 0, F.array_join(F.transform(F.col("bbox")[0], lambda v: F.bround(v * 100, 0).cast("long").cast("string")), " ")).otherwise("")
    made = recipes.samples(done).select("id", "task", "gsd_bucket", "instruction", "response", F.size("image_path").cast("long").alias("n_images"), box.alias("box"))
    bad = done.filter("outcome = 'failed'").select(F.col("source_id").alias("id"), F.lit("failed").alias("task"), *[F.lit("").alias(c) for c in ("gsd_bucket", "instruction", "response")], F.lit(0).cast("long").alias("n_images"), F.lit("").alias("box"))
    return made.union(bad)


def _sql(made: str, failed: str, proxies: str = "") -> str:
    """made and failed: selects; proxies: the condition of samples that come with a proxy."""
    cols = "id, task, gsd_bucket, instruction, response, CAST(n_images AS BIGINT) AS n_images, box"
    second = f" UNION ALL SELECT id || '_proxy', task, 'CARTOSAT-proxy[GSD:2m]', instruction, response, CAST(n_images AS BIGINT), box FROM made WHERE {proxies}" if proxies else ""
    return f"WITH made AS ({made}) SELECT {cols} FROM made{second} UNION ALL SELECT id, 'failed', '', '', '', 0, '' FROM ({failed})"


def _run(spark: SparkSession, name: str, home: str, *more, **options) -> DataFrame:
    return _result(recipes.finish(recipes.RECIPES[name](spark, home, recipes.Options(**options), *more)))


def _nation(spark, d) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("int").alias("g"))


def _key(*parts) -> object:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _k():
    return F.col("k").cast("string")


def _png(df: DataFrame, value=None, side: int = 4) -> DataFrame:
    """Adds png, a square gray picture; value: its numbers."""
    pixels = F.array_repeat(F.lit(9.0), side * side) if value is None else value
    return images.from_values(df.withColumn("v", pixels), "v", side, side, "|u1", "png", T.BinaryType(), rasters.write_png).drop("v")


_POSITIONS = f"(SELECT *, row_number() OVER (ORDER BY {_N} % 2, {_N}) - 1 AS p FROM nation)"


@query(_sql(f"SELECT printf('cdvqa_%07d', p) AS id, 'change_vqa' AS task, 'VHR-native' AS gsd_bucket, n_name AS instruction, n_name || '!' AS response, 2 AS n_images, '' AS box FROM {_POSITIONS} WHERE {_N} % 5 <> 0 AND {_N} % 7 <> 3", f"SELECT printf('cdvqa_%07d', p) AS id FROM {_POSITIONS} WHERE {_N} % 5 = 0 OR {_N} % 7 = 3"))
def recipe_cdvqa(spark, d):
    home, n = fresh_folder(spark), _nation(spark, d)
    q = n.select("k", F.col("name").alias("question"), F.when(F.col("k") % 5 == 0, "").otherwise(F.concat("name", F.lit("!"))).alias("answer"), _key(_k(), "/1.png").alias("before"), _key(_k(), "/2.png").alias("after"))
    _one_json(q.filter("k % 2 = 0"), f"{home}/train.json", "k", "questions")
    _one_json(q.filter("k % 2 = 1"), f"{home}/val.json", "k", "data")
    _files(n.select("k", F.explode(F.array(F.lit(1), F.lit(2))).alias("date")).filter("date = 1 OR k % 7 <> 3"), f"{home}/images", _key(_k(), "/", F.col("date").cast("string"), ".png"))
    return _run(spark, "cdvqa", home)


@query(_sql(f"SELECT concat('rsvqa_hr_', {_N}) AS id, 'vqa' AS task, '[GSD:0.15m]' AS gsd_bucket, n_name AS instruction, 'yes' AS response, 1 AS n_images, '' AS box FROM nation WHERE {_N} % 5 <> 0 AND n_regionkey > 0", f"SELECT concat('rsvqa_hr_', {_N}) AS id FROM nation WHERE {_N} % 5 = 0 OR n_regionkey = 0", "true"))
def recipe_rsvqa(spark, d):
    home, n = fresh_folder(spark), _nation(spark, d)
    _one_json(n.select("k", _k().alias("question_id"), F.col("name").alias("question"), F.when(F.col("k") % 5 == 0, "").otherwise("yes").alias("answer"), _key("i", F.col("g").cast("string")).alias("image_id")), f"{home}/train.json", "k", "questions")
    _files(n.select("g").distinct().filter("g > 0"), f"{home}/images", _key("i", F.col("g").cast("string"), F.when(F.col("g") % 2 == 0, ".png").otherwise(".jpg")))
    return _run(spark, "rsvqa_hr", home)


_TAGGED = f"(SELECT *, row_number() OVER (ORDER BY {_N}) - 1 AS p, {_N} % 4 AS t FROM nation)"


@query(_sql(f"SELECT printf('vrsbench_%07d_', p) || ['caption', 'grounding', 'vqa'][CAST(t AS INTEGER) + 1] AS id, ['caption', 'grounding', 'vqa'][CAST(t AS INTEGER) + 1] AS task, 'VHR-native' AS gsd_bucket, n_name AS instruction, CASE WHEN t = 1 THEN '{{<1><2><30><40>}}' ELSE 'so' END AS response, 1 AS n_images, CASE WHEN t = 1 THEN '1000 2000 30000 40000' ELSE '' END AS box FROM {_TAGGED} WHERE t < 3 AND n_regionkey > 0", f"SELECT printf('vrsbench_%07d', p) AS id FROM {_TAGGED} WHERE t = 3 OR n_regionkey = 0", "true"))
def recipe_vrsbench(spark, d):
    home, n = fresh_folder(spark), _nation(spark, d)
    tag = F.get(F.array(F.lit("caption"), F.lit("refer"), F.lit("vqa"), F.lit("other")), (F.col("k") % 4))
    said = F.when(F.col("k") % 4 == 1, "{<1><2><30><40>}").otherwise("so")
    turn = lambda who, c: F.struct(F.lit(who).alias("from"), c.alias("value"))
    entries = n.select("k", _k().alias("id"), _key("i", F.col("g").cast("string"), ".png").alias("image"), F.array(turn("human", F.concat(F.lit("<image>\n["), tag, F.lit("] "), "name")), turn("gpt", said)).alias("conversations"))
    _one_json(entries, f"{home}/VRSBench_train.json", "k")
    _files(n.select("g").distinct().filter("g > 0"), f"{home}/Images_train", _key("i", F.col("g").cast("string"), ".png"))
    return _run(spark, "vrsbench", home)


_COVER = f"list_value({', '.join(repr(c) for c in LAND_COVER)})"


@query(_sql(f"SELECT concat('sen2lulc_n', {_N}) AS id, 'vqa' AS task, '[GSD:10m]' AS gsd_bucket, 'What is the primary land cover type in this image?' AS instruction, CASE WHEN {_N} % 9 < 7 THEN {_COVER}[CAST({_N} % 9 AS INTEGER) + 1] ELSE CAST({_N} % 9 AS VARCHAR) END AS response, 1 AS n_images, '' AS box FROM nation WHERE {_N} % 6 > 0", f"SELECT concat('sen2lulc_n', {_N}) AS id FROM nation WHERE {_N} % 6 = 0"))
def recipe_sen2lulc(spark, d):
    home, n = fresh_folder(spark), _nation(spark, d)
    n.orderBy("k").select(_key("n", _k()).alias("image_id"), (F.col("k") % 9).alias("label")).coalesce(1).write.csv(f"{home}/metadata.csv", header=True)
    _files(n.filter("k % 6 > 0"), f"{home}/images", _key("n", _k(), ".png"))
    return _run(spark, "sen2lulc", home, fraction=1.0)


_CORINE = f"list_value({', '.join(repr(c) for c in CORINE)})"
_PATCH = f"(SELECT *, row_number() OVER (ORDER BY {_N}) - 1 AS p, {_CORINE}[CAST({_N} % 19 AS INTEGER) + 1] AS c FROM nation)"
_GOOD = f"{_N} % 5 > 0 AND {_N} % 7 > 0"


@query(_sql(f"""SELECT printf('bigen_%08d', p) AS id, 'vqa' AS task, '[GSD:10m]' AS gsd_bucket, 'What land cover types are present in this image?' AS instruction, c AS response, 1 AS n_images, '' AS box FROM {_PATCH} WHERE {_GOOD}
  UNION ALL SELECT printf('bigen_%08d_sar', p), 'vqa', '[GSD:10m]', 'Describe the SAR backscatter characteristics of this scene.', concat('SAR backscatter over a scene classified optically as: ', c, '.'), 1, '' FROM {_PATCH} WHERE {_GOOD} AND {_N} % 2 = 0
  UNION ALL SELECT printf('bigen_%08d_fusion', p), 'fusion_vqa', '[GSD:10m]', 'Using both the optical and SAR images, describe this scene''s land cover and surface conditions.', concat('Optical imagery shows: ', c, '. SAR backscatter is consistent with these cover types.'), 2, '' FROM {_PATCH} WHERE {_GOOD} AND {_N} % 2 = 0""", f"SELECT printf('bigen_%08d', p) AS id FROM {_PATCH} WHERE NOT ({_GOOD})"))
def recipe_bigen(spark, d):
    """Patches: no arrays for every fifth, no labels for every seventh, radar for every other."""
    home, n = fresh_folder(spark), _nation(spark, d)
    labels = F.when(F.col("k") % 7 == 0, F.array().cast("array<bigint>")).otherwise(F.array((F.col("k") % 19).cast("long")))
    n.orderBy("k").select(_key("p", _k()).alias("patch_id"), labels.alias("labels")).coalesce(1).write.parquet(f"{home}/metadata.parquet")
    _files(n.filter("k % 5 > 0"), f"{home}/s2_npy", _key("p", _k(), ".npy"))
    _files(n.filter("k % 2 = 0"), f"{home}/s1_npy", _key("p", _k(), ".npy"))
    return _run(spark, "bigen", home)


@query(_sql("SELECT concat('levir_t', n_nationkey) AS id, CASE WHEN n_regionkey > 0 THEN 'change_grounding' ELSE 'change_vqa' END AS task, '[GSD:0.5m]' AS gsd_bucket, 'What building changes occurred between these two dates?' AS instruction, concat('Building changes detected in t', n_nationkey, '.') AS response, 2 AS n_images, CASE WHEN n_regionkey > 0 THEN concat('0 0 46875 ', CAST((n_regionkey * 8 - 1) * 3125 AS BIGINT)) ELSE '' END AS box FROM nation WHERE n_nationkey % 6 > 0", "SELECT '' AS id WHERE false", "true"))
def recipe_levir(spark, d):
    """Pairs of dates with a mask of which the upper left is changed; every sixth has no second date."""
    home, n = fresh_folder(spark), _nation(spark, d)
    plain = _png(n)
    _files(plain, f"{home}/train/A", _key("t", _k(), "_1.png"), F.col("png"))
    _files(plain.filter("k % 6 > 0"), f"{home}/train/B", _key("t", _k(), "_2.png"), F.col("png"))
    changed = F.transform(F.sequence(F.lit(0), F.lit(1023)), lambda i: F.when((F.floor(i / 32) < F.col("g") * 8) & (i % 32 < 16), 255.0).otherwise(0.0))
    _files(_png(n, changed, 32), f"{home}/train/label", _key("t", _k(), ".png"), F.col("png"))
    return _run(spark, "levir_cd", home, fraction=1.0)


@query(_sql("SELECT concat('sn6_t', n_nationkey) AS id, CASE WHEN n_regionkey > 0 THEN 'grounding' ELSE 'vqa' END AS task, '[GSD:0.5m]' AS gsd_bucket, CASE WHEN n_regionkey > 0 THEN 'Locate the buildings in this image.' ELSE 'How many buildings are in this image?' END AS instruction, CASE n_regionkey WHEN 0 THEN '0' WHEN 1 THEN '1 building detected.' ELSE concat(n_regionkey, ' buildings detected.') END AS response, 1 AS n_images, CASE WHEN n_regionkey > 0 THEN '0 0 50000 50000' ELSE '' END AS box FROM nation WHERE n_nationkey % 8 > 0", "SELECT concat('sn6_t', n_nationkey) AS id FROM nation WHERE n_nationkey % 8 = 0", "true"))
def recipe_sn6_opt(spark, d):
    """Tiles with as many buildings as their region's number; every eighth file is damaged."""
    home, n = fresh_folder(spark), _nation(spark, d)
    tiles = images.from_values(n.withColumn("v", F.array_repeat(F.lit(500.0), 64)), "v", 8, 8, "<u2", "tif", T.BinaryType(), _tiff).drop("v")
    _files(tiles, f"{home}/train/images", _key("t", _k(), ".tif"), F.when(F.col("k") % 8 > 0, F.col("tif")).otherwise(F.lit("no").cast("binary")))
    ring = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit('{"geometry":{"type":"Polygon","coordinates":[[['), i.cast("string"), F.lit(",0],["), (i + 4).cast("string"), F.lit(",0],["), (i + 4).cast("string"), F.lit(",4.5]]]}}")))
    _files(n.filter("g > 0"), f"{home}/train/labels", _key("t", _k(), ".geojson"), F.concat(F.lit('{"features":['), F.array_join(F.slice(ring, 1, F.col("g")), ","), F.lit("]}")).cast("binary"))
    return _run(spark, "sn6_opt", home, fraction=1.0)


@query(_sql("SELECT concat('sn6_sar_t', n_nationkey) AS id, 'vqa' AS task, '[GSD:0.5m]' AS gsd_bucket, 'Describe the SAR characteristics of this scene.' AS instruction, concat('SAR image of t', n_nationkey, ' showing surface scattering properties.') AS response, 1 AS n_images, '' AS box FROM nation WHERE n_nationkey % 3 > 0 UNION ALL SELECT concat('sn6_fusion_t', n_nationkey), 'fusion_vqa', '[GSD:0.5m]', 'Using both the optical and SAR images, describe this scene''s surface conditions.', concat('Optical and SAR imagery of t', n_nationkey, ' show consistent surface conditions across both sensors.'), 2, '' FROM nation WHERE n_nationkey % 3 > 0 AND n_regionkey > 1", "SELECT '' AS id WHERE false"))
def recipe_sn6_sar(spark, d):
    """Radar tiles of the optical selection, fused where there is an optical sample."""
    home, n = fresh_folder(spark), _nation(spark, d)
    _files(n, f"{home}/Sentinel-1", _key("t", _k(), ".tif"))
    optical = n.filter("g > 1").select(_key("sn6_t", _k()).alias("id"), F.array(_key("/o/", _k(), ".png")).alias("image_path"))
    return _run(spark, "sn6_sar", home, optical, n.filter("k % 3 > 0").select(_key("t", _k()).alias("tile")))


@query(_sql("SELECT replace(replace(lower(n_name), ' ', '_'), '-', '_') AS id, 'change_vqa' AS task, '[GSD:10m]' AS gsd_bucket, 'What changed between the two dates?' AS instruction, concat('Change detected in ', replace(lower(n_name), ' ', '-'), '.') AS response, 2 AS n_images, '' AS box FROM nation WHERE n_nationkey % 4 > 0 AND n_nationkey % 5 > 0", "SELECT replace(replace(lower(n_name), ' ', '_'), '-', '_') AS id FROM nation WHERE n_nationkey % 4 > 0 AND n_nationkey % 5 = 0"))
def recipe_oscd(spark, d):
    """Locations of two dates; every fourth lacks a date and is no pair, every fifth lacks a band and fails."""
    home, n = fresh_folder(spark), _nation(spark, d)
    each = n.select("*", F.explode(F.array(F.lit("1"), F.lit("2"))).alias("date")).select("*", F.explode(F.array(F.lit("B02"), F.lit("B03"), F.lit("B04"), F.lit("B08"))).alias("band"))
    each = each.filter("(date = '1' OR k % 4 > 0) AND (k % 5 > 0 OR band <> 'B03')")
    _files(each, f"{home}/images", _key(F.replace(F.lower("name"), F.lit(" "), F.lit("-")), "/imgs_", F.col("date"), "/x_", F.col("band"), ".tif"))
    return _run(spark, "oscd", home)


@query(_sql(f"SELECT concat('sardet_i', {_N}) AS id, 'grounding' AS task, '[GSD:5m]' AS gsd_bucket, 'Locate the objects in this SAR image.' AS instruction, list_value({', '.join(repr(c) for c in SAR_CATEGORIES)})[CAST(n_regionkey AS INTEGER) + 1] AS response, 1 AS n_images, '25000 25000 75000 75000' AS box FROM nation WHERE {_N} % 5 > 0 AND {_N} % 7 > 0", f"SELECT concat('sardet_i', {_N}) AS id FROM nation WHERE {_N} % 5 = 0 OR {_N} % 7 = 0"))
def recipe_sardet(spark, d):
    """Pictures with one object each; every fifth has no label file, every seventh picture is damaged."""
    home, n = fresh_folder(spark), _nation(spark, d)
    _files(_png(n), f"{home}/images", _key("i", _k(), ".png"), F.when(F.col("k") % 7 > 0, F.col("png")).otherwise(F.lit("no").cast("binary")))
    _files(n.filter("k % 5 > 0"), f"{home}/labels", _key("i", _k(), ".txt"), _key(F.col("g").cast("string"), " .5 .5 .5 .5\n9 .5 .5 .5 .5\n").cast("binary"))
    return _run(spark, "sardet", home, fraction=1.0)


# ---- recipes with an output folder: their pictures, pixel by pixel, from real files of every vector

_B = _BYTES
_V = "CAST(vec_id AS VARCHAR)"


def _drawn(spark: SparkSession, home: str, band: int | None = 0) -> DataFrame:
    """name, y, x, v: one channel of the pictures that a recipe has written."""
    files = stores.files_below(spark, f"{home}/out/images").select("path")
    kept = files.filter(F.endswith("path", F.lit(".png")))
    plane = lambda name, data: (a if (a := images.read(name, data)).ndim == 2 else a[:, :, band])
    named = stores.read_selected(kept).select(F.regexp_extract("path", r"/([^/]*)\.png$", 1).alias("name"), "path", "content")
    flat = images.pixels(named, ["path", "content"], plane)
    return flat.select("name", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), F.col("v").cast("int").alias("v"))


def _go(spark: SparkSession, name: str, home: str, **options) -> None:
    """Run a recipe with its output folder; its rows are needed, as some pictures are made on the way to them."""
    done = recipes.finish(recipes.RECIPES[name](spark, home, recipes.Options(output_dir=f"{home}/out", fraction=1.0, **options)))
    assert not done.filter("outcome = 'failed'").limit(1).count()


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("n", F.col("vec_id").cast("string"))


@query(f"SELECT 'levir_t' || {_V} || e AS name, y, x, CASE WHEN e = '_before' THEN {_B} ELSE 255 - {_B} END AS v FROM {_PIXELS}, (VALUES ('_before'), ('_after')) AS t(e)")
def pictures_levir(spark, d):
    """Both dates of a pair as PNGs."""
    home = fresh_folder(spark)
    for folder, end, f in (("A", "_1", lambda x: x), ("B", "_2", lambda x: 255 - x), ("label", "", lambda x: x * 0)):
        coded = _coded(spark, d, "byte", "png", lambda x, f=f: rasters.write_png(f(x)))
        _files(coded, f"{home}/train/{folder}", _key("t", F.col("n"), f"{end}.png"), F.col("png"))
    _go(spark, "levir_cd", home)
    return _drawn(spark, home)


@query(f"SELECT 'sn6_t' || {_V} AS name, y, x, {_STRETCH.format(p=_WIDE, top='top')} AS v FROM {_PIXELS} JOIN {_TOP.format(p=_WIDE, t=_PIXELS)} USING (vec_id)")
def pictures_sn6_opt(spark, d):
    """16-bit tiles in colour."""
    home = fresh_folder(spark)
    tiles = _coded(spark, d, "wide", "tif", _tiff)
    _files(tiles, f"{home}/train/images", _key("t", F.col("n"), ".tif"), F.col("tif"))
    _go(spark, "sn6_opt", home)
    return _drawn(spark, home, 2)


@query(f"SELECT 'v' || {_V} || e AS name, y, x, CASE WHEN e = '_before' THEN {_STRETCH.format(p=_WIDE, top='10000')} ELSE 0 END AS v FROM {_PIXELS}, (VALUES ('_before'), ('_after')) AS t(e)")
def pictures_oscd(spark, d):
    """Three bands of two dates; a fourth is damaged and not opened."""
    home = fresh_folder(spark)
    for date in (1, 2):
        coded = _coded(spark, d, "wide", "tif", lambda x, date=date: _tiff(x * (date == 1)))
        for band in ("B02", "B03", "B04", "B08"):
            _files(coded, f"{home}/images", _key("v", F.col("n"), f"/imgs_{date}/x_{band}.tif"), F.col("tif") if band != "B08" else F.lit(b"no"))
    _go(spark, "oscd", home)
    return _drawn(spark, home, 1)


@query(f"SELECT 'sardet_i' || {_V} AS name, y, x, CASE WHEN {_B} > 0 THEN 255 ELSE 0 END AS v FROM {_PIXELS}")
def pictures_sardet(spark, d):
    """Radar pictures: every byte but zero is beyond the top of the decibels."""
    home = fresh_folder(spark)
    _files(_coded(spark, d, "byte", "png", rasters.write_png), f"{home}/images", _key("i", F.col("n"), ".png"), F.col("png"))
    _files(_named(table(spark, d, "embeddings")), f"{home}/labels", _key("i", F.col("n"), ".txt"), F.lit("0 .5 .5 .5 .5\n").cast("binary"))
    _go(spark, "sardet", home)
    return _drawn(spark, home)


#: Bytes of decibels that are half a step off the next ones, so that single precision decides alike.
_STEPS_DB = "CAST(abs(v) * 1000 AS BIGINT) % 200 + 20"


@query(f"SELECT 'sn6_sar_t' || {_V} AS name, y, x, CAST({_STEPS_DB} AS INTEGER) AS v FROM {_PIXELS} UNION ALL SELECT 'sn6_fusion_t' || {_V}, y, x + 10, CAST({_STEPS_DB} AS INTEGER) FROM {_PIXELS} UNION ALL SELECT 'sn6_fusion_t' || {_V}, y, x, {_B} FROM {_PIXELS} UNION ALL SELECT 'sn6_fusion_t' || {_V}, y, x + 8, 128 FROM {_PIXELS} WHERE x < 2")
def pictures_sn6_sar(spark, d):
    """Radar tiles in decibels, and beside the picture of the optical run, which has left its lines and selection in a folder."""
    home = fresh_folder(spark)
    step = lambda v: F.pow(F.lit(10.0), (((F.bround(F.abs(v) * 1000, 0).cast("long") % 200 + 20) + 0.5) / 255 * 25 - 25) / 10)
    tiles = _named(_raster(spark, d, step, "<f4", "tif", T.BinaryType(), _tiff))
    _files(tiles, f"{home}/train/sar", _key("t", F.col("n"), ".tif"), F.col("tif"))
    _files(_coded(spark, d, "byte", "png", rasters.write_png), f"{home}/opt", _key("t", F.col("n"), ".png"), F.col("png"))
    at = F.concat(F.lit(f"{home}/opt/t"), F.col("n"), F.lit(".png"))
    lines = _named(table(spark, d, "embeddings")).select(F.to_json(F.struct(_key("sn6_t", F.col("n")).alias("id"), F.array(at).alias("image_path"))))
    lines.write.text(f"{home}/run/sn6_opt.jsonl")
    sinks.write_selection(_named(table(spark, d, "embeddings")).select(_key("t", F.col("n")).alias("tile")), "tile", f"{home}/run/selected_tile_ids")
    o = recipes.Options(output_dir=f"{home}/out")
    recipes.finish(recipes.sn6_sar(spark, home, o, optical_dir=f"{home}/run")).collect()
    return _drawn(spark, home)


@query(f"SELECT printf('bigen_%08d_optical', n) AS name, y, x, {_STRETCH.format(p=_WIDE, top='top')} AS v FROM {_PIXELS} JOIN {_TOP.format(p=_WIDE, t=_PIXELS)} USING (vec_id) JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM embeddings) USING (vec_id) UNION ALL SELECT printf('bigen_%08d_sar', n), y, x, CAST({_STEPS_DB} AS INTEGER) FROM {_PIXELS} JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM embeddings) USING (vec_id)")
def pictures_bigen(spark, d):
    """Arrays of many bands in colour, and two bands of radar."""
    home = fresh_folder(spark)
    order = table(spark, d, "embeddings").orderBy("vec_id").select(F.col("vec_id").cast("string").alias("patch_id"), F.array(F.lit(3).cast("long")).alias("labels"))
    order.write.parquet(f"{home}/metadata.parquet")
    optical = _coded(spark, d, "wide", "npy", lambda a: _npy(np.stack([a * 0, a, a, a])))
    _files(optical, f"{home}/s2_npy", _key(F.col("n"), ".npy"), F.col("npy"))
    step = lambda v: F.pow(F.lit(10.0), (((F.bround(F.abs(v) * 1000, 0).cast("long") % 200 + 20) + 0.5) / 255 * 25 - 25) / 10)
    radar = _named(_raster(spark, d, step, "<f4", "npy", T.BinaryType(), lambda a: _npy(np.stack([a, a / 3]))))
    _files(radar, f"{home}/s1_npy", _key(F.col("n"), ".npy"), F.col("npy"))
    # the recipe's own limit is 60,000 patches
    _go(spark, "bigen", home, max_samples=order.count())
    return _drawn(spark, home).filter(~F.endswith("name", F.lit("_concat")))


@query(f"SELECT 'v' || {_V} AS name, y, x, {_B} AS v FROM {_PIXELS}")
def pictures_rsvqa(spark, d):
    """Images of another format become PNGs."""
    home, e = fresh_folder(spark), _named(table(spark, d, "embeddings").select("vec_id"))
    _one_json(e.select("vec_id", F.col("n").alias("question_id"), F.lit("q").alias("question"), F.lit("a").alias("answer"), _key("v", F.col("n")).alias("image_id")), f"{home}/train.json", "vec_id", "questions")
    _files(_coded(spark, d, "byte", "tif", _tiff), f"{home}/images", _key("v", F.col("n"), ".tif"), F.col("tif"))
    _go(spark, "rsvqa_hr", home)
    return _drawn(spark, home)


@query("SELECT 'v' || CAST(vec_id AS VARCHAR) || '_proxy' AS name, y, x, CAST(vec_id % 251 AS INTEGER) AS v FROM embeddings, (SELECT unnest(range(32)) AS y), (SELECT unnest(range(32)) AS x)")
def pictures_vrsbench(spark, d):
    """Proxies, one for each image however many entries share it."""
    home, e = fresh_folder(spark), _named(table(spark, d, "embeddings").select("vec_id"))
    turn = lambda who, c: F.struct(F.lit(who).alias("from"), F.lit(c).alias("value"))
    entries = e.select(F.explode(F.array(F.col("vec_id") * 2, F.col("vec_id") * 2 + 1)).alias("o"), F.col("n").alias("id"), _key("v", F.col("n"), ".png").alias("image"), F.array(turn("human", "<image>\n[vqa] q"), turn("gpt", "a")).alias("conversations"))
    _one_json(entries, f"{home}/VRSBench_train.json", "o")
    _files(_png(e, F.array_repeat((F.col("vec_id") % 251).cast("double"), 64), 8), f"{home}/Images_train", _key("v", F.col("n"), ".png"), F.col("png"))
    _go(spark, "vrsbench", home)
    return _drawn(spark, home)


@query(f"SELECT vec_id, c AS class, round_even(min(x) / 8.0 * 1000, 2) AS x1, round_even(max(y) / 8.0 * 1000, 2) AS y2 FROM (SELECT vec_id, x, y, {_B} % 7 AS c FROM {_PIXELS}) GROUP BY vec_id, c")
def masks_sen2lulc(spark, d):
    """Boxes of the classes of land-cover masks, by option."""
    home, e = fresh_folder(spark), _named(table(spark, d, "embeddings").select("vec_id"))
    e.orderBy("vec_id").select(F.col("n").alias("image_id"), F.lit("1").alias("label")).coalesce(1).write.csv(f"{home}/metadata.csv", header=True)
    _files(e, f"{home}/images", _key(F.col("n"), ".png"))
    kinds = _coded(spark, d, "byte", "png", lambda a: rasters.write_png(a % 7))
    _files(kinds, f"{home}/masks", _key(F.col("n"), ".png"), F.col("png"))
    seen = _raster(spark, d, *_KINDS["byte"], "classes", T.ArrayType(T.IntegerType()), lambda a: sorted({int(v) for v in (a % 7).ravel()}))
    made = recipes.sen2lulc(spark, home, recipes.Options(fraction=1.0, masks=True)).select(F.regexp_extract("source_id", r"_(\d+)$", 1).cast("long").alias("vec_id"), F.col("rows")[0]["bbox"].alias("boxes"))
    both = made.join(seen, "vec_id").select("vec_id", F.explode(F.arrays_zip("classes", "boxes")).alias("z"))
    return both.select("vec_id", F.col("z.classes").alias("class"), F.col("z.boxes")[0].alias("x1"), F.col("z.boxes")[3].alias("y2"))


_TILES = "(SELECT 't' || CAST(c_custkey AS VARCHAR) AS tile, c_custkey AS k FROM customer)"


@query(
    f"""SELECT 'paired' AS run, 'sn6_sar_' || tile AS id FROM {_TILES} WHERE k % 3 = 0 UNION ALL SELECT 'paired', 'sn6_fusion_' || tile FROM {_TILES} WHERE k % 6 = 0
  UNION ALL SELECT 'no selection', 'sn6_sar_' || tile FROM {_TILES} UNION ALL SELECT 'no selection', 'sn6_fusion_' || tile FROM {_TILES} WHERE k % 6 = 0
  UNION ALL SELECT 'no pictures', 'sn6_sar_' || tile FROM ({_sampled(f"(SELECT * FROM {_TILES} WHERE k % 3 = 0)", "tile", "", "greatest(1, floor(n * 0.05))", "tile")})
  UNION ALL SELECT 'alone', 'sn6_sar_' || tile FROM ({_sampled(_TILES, "tile", "", "greatest(1, floor(n * 0.05))", "tile")})"""
)
def optical_selection(spark, d):
    """Radar tiles by what the optical run has left: lines and selection, lines and an empty selection, a selection alone, nothing."""
    home, c = fresh_folder(spark), table(spark, d, "customer").select(F.col("c_custkey").alias("k"), _key("t", F.col("c_custkey").cast("string")).alias("tile"))
    _files(_dealt(c), f"{home}/train/sar", F.concat("tile", F.lit(".tif")))
    proxy = F.array(F.struct(F.concat(F.lit("sn6_"), "tile").alias("id"), F.array(F.concat(F.lit("/o/"), "tile", F.lit(".png"))).alias("image_path")), F.struct(F.concat(F.lit("sn6_"), "tile", F.lit("_proxy")).alias("id"), F.array(F.lit("/o/p.png")).alias("image_path")))
    lines = c.filter("k % 6 = 0").select(F.explode(proxy).alias("r")).select(F.to_json("r"))
    chosen = c.filter("k % 3 = 0").agg(F.to_json(F.collect_list("tile")))
    out = None
    for run, has_lines, selection in (("paired", True, chosen), ("no selection", True, chosen.select(F.lit("[]"))), ("no pictures", False, chosen), ("alone", False, None)):
        at = f"{home}/{run.replace(' ', '_')}"
        if has_lines:
            lines.write.text(f"{at}/sn6_opt.jsonl")
        if selection is not None:
            selection.coalesce(1).write.text(f"{at}/selected_tile_ids.json")
        made = recipes.finish(recipes.sn6_sar(spark, home, optical_dir=at))
        each = recipes.samples(made).select(F.lit(run).alias("run"), "id")
        out = each if out is None else out.union(each)
    return out

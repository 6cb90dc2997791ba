"""The query catalogue: every operator on the given tables, and the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import boxes, gsd, sar, text
from ..operators import corpus, images, manifest, regions, sampling, stats, validate
from ..schema import BOXES, DATASETS, SAR_CATEGORIES, TASKS
from ..sources import readers
from ..streaming import resume
from . import checks, rows, training

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL if there is one."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sampled(source: str, key: str, strata: str, quota: str, cols: str) -> str:
    part = f"PARTITION BY {strata}" if strata else ""
    return f"SELECT {cols} FROM (SELECT *, row_number() OVER ({part} ORDER BY md5(concat_ws(':', CAST({key} AS VARCHAR), '42')), {key}) AS rn, count(*) OVER ({part}) AS n FROM {source}) WHERE rn <= {quota}"


# ---- synthetic samples: one text for both engines, but for the name of the array function


def samples_sql(array: str) -> str:
    names = lambda xs: " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(xs))
    return f"""SELECT p_partkey AS k, CASE WHEN p_partkey % 97 = 0 THEN concat('P-', p_partkey) ELSE concat('p_', p_partkey) END AS id,
  CASE p_partkey % 11 {names(DATASETS)} ELSE 'mystery' END AS dataset, CASE p_size % 8 {names(TASKS)} ELSE 'vqa' END AS task,
  CASE WHEN p_partkey % 31 = 0 THEN {array}('') WHEN p_size % 8 IN (0, 1, 2, 7) AND p_partkey % 13 <> 0 THEN {array}('a.png') ELSE {array}('a.png', 'b.png') END AS image_path,
  CASE WHEN p_size % 8 IN (3, 4) THEN 'bitemporal' WHEN p_size % 8 IN (5, 6) THEN 'cross-modal' ELSE 'single' END AS pair_type,
  CASE WHEN p_partkey % 29 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN 'CARTOSAT-proxy[GSD:2m]' ELSE 'VHR-native' END AS gsd_bucket,
  CASE WHEN p_partkey % 20 = 0 THEN 'val_internal' ELSE 'train' END AS split, p_name AS instruction, CASE WHEN p_partkey % 23 = 0 THEN '' ELSE p_type END AS response,
  CASE WHEN p_size % 8 IN (2, 4, 6) AND p_partkey % 7 <> 0 THEN {array}({array}(CAST(p_size AS DOUBLE), CAST(10 AS DOUBLE), CAST(500 AS DOUBLE), CAST(p_partkey % 17 * 70 AS DOUBLE))) WHEN p_partkey % 19 = 0 THEN {array}({array}(CAST(-5 AS DOUBLE), CAST(1 AS DOUBLE), CAST(2 AS DOUBLE), CAST(3 AS DOUBLE))) END AS bbox,
  CASE WHEN p_size % 8 IN (5, 6) AND p_partkey % 5 <> 0 THEN 'optical+sar' WHEN p_partkey % 4 = 1 THEN 'sar' ELSE 'optical' END AS modality FROM part"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(samples_sql("array").replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part")).withColumn("bbox", F.col("bbox").cast(BOXES))


S = f"s AS ({samples_sql('list_value')})"
_ENUM = " ".join(f"CASE WHEN {f} NOT IN ({', '.join(repr(v) for v in vs)}) THEN 'schema [{f}]: ''' || {f} || ''' is not an allowed value' END," for f, vs in validate.ENUMS.items())
_SCHEMA = f"""list_filter([{_ENUM} CASE WHEN NOT regexp_matches(id, '^[a-z0-9_]+$') THEN 'schema [id]: ''' || id || ''' does not match the pattern' END,
  CASE WHEN gsd_bucket = '' THEN 'schema [gsd_bucket]: '''' is too short' END, CASE WHEN instruction = '' THEN 'schema [instruction]: '''' is too short' END, CASE WHEN response = '' THEN 'schema [response]: '''' is too short' END,
  CASE WHEN len(image_path) = 0 THEN 'schema [image_path]: [] is too short' END, CASE WHEN len(image_path) > 2 THEN 'schema [image_path]: too long' END, CASE WHEN list_contains(image_path, '') THEN 'schema [image_path]: '''' is too short' END], lambda x: x IS NOT NULL)"""
_RANGE = "coalesce(list_filter(list_transform(flatten(bbox), lambda v, i: CASE WHEN v < 0 OR v > 1000 THEN concat('bbox[', (i - 1) // 4, '][', (i - 1) % 4, ']=', printf('%.1f', v), ' out of range [0, 1000]') END), lambda x: x IS NOT NULL), [])"
_CROSS = """list_filter([CASE WHEN pair_type = 'single' AND len(image_path) <> 1 THEN concat('pair_type=''single'' requires exactly 1 image, got ', len(image_path)) END,
  CASE WHEN pair_type IN ('bitemporal', 'cross-modal') AND len(image_path) <> 2 THEN concat('pair_type=''', pair_type, ''' requires exactly 2 images, got ', len(image_path)) END,
  CASE WHEN task IN ('grounding', 'change_grounding', 'fusion_grounding') AND (bbox IS NULL OR len(bbox) = 0) THEN concat('task=''', task, ''' requires a non-empty bbox list, got ', CASE WHEN bbox IS NULL THEN 'None' ELSE '[]' END) END,
  CASE WHEN task IN ('vqa', 'caption', 'change_vqa', 'fusion_vqa') AND bbox IS NOT NULL THEN concat('task=''', task, ''' requires null bbox, got non-null') END,
  CASE WHEN task = 'change_grounding' AND pair_type <> 'bitemporal' THEN concat('task=''change_grounding'' requires pair_type=''bitemporal'', got pair_type=''', pair_type, '''') END,
  CASE WHEN task = 'change_grounding' AND len(image_path) <> 2 THEN concat('task=''change_grounding'' requires 2 images, got ', len(image_path)) END,
  CASE WHEN task = 'fusion_grounding' AND pair_type <> 'cross-modal' THEN concat('task=''fusion_grounding'' requires pair_type=''cross-modal'', got pair_type=''', pair_type, '''') END,
  CASE WHEN task = 'fusion_grounding' AND len(image_path) <> 2 THEN concat('task=''fusion_grounding'' requires 2 images, got ', len(image_path)) END,
  CASE WHEN pair_type = 'cross-modal' AND modality <> 'optical+sar' THEN concat('pair_type=''cross-modal'' requires modality=''optical+sar'', got modality=''', modality, '''') END], lambda x: x IS NOT NULL)"""
J = f"{S}, j AS (SELECT *, CASE WHEN len({_SCHEMA}) > 0 THEN {_SCHEMA} WHEN len({_RANGE}) > 0 THEN {_RANGE} ELSE {_CROSS} END AS errors FROM s)"


# ---- sampling and quantiles


@query(_sampled("events", "event_id", "event_type", "greatest(1, round_even(n * 0.1, 0))", "event_id, event_type"))
def stratified_sample(spark, d):
    return sampling.stratified_sample(table(spark, d, "events").select("event_id", "event_type"), ["event_type"], "event_id", 0.1)


EDGES = "(SELECT list_transform(quantile_cont({v}, {q}), lambda x: round_even(x, 6)) FROM {t})"
DECILES = EDGES.format(v="o_totalprice", q="[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]", t="orders")


@query(f"SELECT unnest({DECILES}) AS edge")
def quantile_edges(spark, d):
    return stats.quantile_edges(table(spark, d, "orders"), "o_totalprice", 10).select(F.explode("edges").alias("edge"))


@query(f"SELECT len(list_filter({EDGES.format(v='l_extendedprice', q='[0.25, 0.5, 0.75]', t='lineitem')}, lambda e: e < l_extendedprice)) AS bucket, count(*) AS n FROM lineitem GROUP BY 1")
def quantile_bucket(spark, d):
    return stats.with_quantile_bucket(table(spark, d, "lineitem"), "l_extendedprice", 4).groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


DECILE_SQL = _sampled(f"(SELECT o_orderkey, len(list_filter({DECILES}, lambda e: e < o_totalprice)) AS bucket FROM orders)", "o_orderkey", "bucket", "greatest(1, round_even(n * 0.1, 0))", "o_orderkey, bucket")


@query(DECILE_SQL)
def decile_sample(spark, d):
    return stats.quantile_sample(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, "o_orderkey", 0.1).select("o_orderkey", F.col("bucket").cast("long").alias("bucket"))


DENSITY = "(SELECT l_orderkey AS k, CAST(count(*) AS DOUBLE) AS n_items FROM lineitem GROUP BY l_orderkey)"


@query(_sampled(f"(SELECT k, len(list_filter({EDGES.format(v='n_items', q='[0.25, 0.5, 0.75]', t=DENSITY)}, lambda e: e < n_items)) AS bucket FROM {DENSITY})", "k", "bucket", "greatest(1, round_even(n * 0.05, 0))", "k, bucket"))
def density_sample(spark, d):
    items = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).cast("double").alias("n_items"))
    return stats.quantile_sample(items, "n_items", 4, "k", 0.05).select("k", F.col("bucket").cast("long").alias("bucket"))


@query(_sampled("(SELECT user_id, coalesce(arg_min(event_type, event_id), 'unknown') AS class_name FROM events GROUP BY user_id)", "user_id", "class_name", "greatest(1, round_even(n * 0.1, 0))", "user_id, class_name"))
def primary_class_sample(spark, d):
    first = stats.first_class(table(spark, d, "events"), "user_id", "event_id", F.col("event_type"))
    return sampling.stratified_sample(first, ["class_name"], "user_id", 0.1)


@query(_sampled("supplier", "s_suppkey", "", "greatest(1, floor(n * 0.05))", "s_suppkey, s_name"))
def uniform_sample(spark, d):
    return sampling.uniform_sample(table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey", 0.05)


SPLIT_SQL = "SELECT doc_id, lang, source, CASE WHEN n > 1 AND rn <= least(greatest(1, floor(n * 0.03)), n - 1) THEN 'val_internal' ELSE 'train' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY md5(concat_ws(':', CAST(doc_id AS VARCHAR), '42')), doc_id) AS rn, count(*) OVER (PARTITION BY lang, source) AS n FROM documents)"


@query(SPLIT_SQL)
def val_split(spark, d):
    return sampling.validation_split(table(spark, d, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id")


@query(f"SELECT count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val_internal') AS val FROM ({SPLIT_SQL})")
def val_split_stats(spark, d):
    return sampling.split_stats(val_split(spark, d))


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 100")
def head_limit(spark, d):
    return sampling.head(table(spark, d, "documents").select("doc_id", "n_chars"), ["doc_id"], 100)


# ---- validation and corpus


@query(f"WITH {J} SELECT id, unnest(errors) AS error FROM j")
def validate_errors(spark, d):
    return validate.with_errors(samples(spark, d)).select("id", F.explode("errors").alias("error"))


@query(f"WITH {J} SELECT count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid, CAST(sum(len(errors)) AS BIGINT) AS messages FROM j")
def validate_counts(spark, d):
    return validate.with_errors(samples(spark, d)).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size("errors") == 0).alias("valid"), F.sum(F.size("errors").cast("long")).alias("messages"))


@query(f"WITH {J} SELECT coalesce(id, '?') AS id, 'part' AS tier, array_to_string(errors, '; ') AS errors FROM j WHERE len(errors) > 0")
def validate_and_filter(spark, d):
    _, bad = validate.split_valid(samples(spark, d), "part")
    return bad.withColumn("errors", F.array_join("errors", "; "))


@query(f"WITH {J}, m AS (SELECT k, id, errors[1] AS error FROM j WHERE len(errors) > 0) SELECT k, id, error, (SELECT count(*) FROM m) AS total FROM m ORDER BY k LIMIT 10")
def error_preview(spark, d):
    bad = validate.with_errors(samples(spark, d)).filter(F.size("errors") > 0).select("k", "id", F.col("errors")[0].alias("error"))
    return validate.preview(bad, ["k"])


@query(
    """SELECT event_id AS line_no, CASE WHEN event_id % 10 = 3 THEN 'JSON parse error' WHEN event_id % 10 = 4 THEN 'schema [id]: not of type ''string'''
  WHEN event_id % 10 = 5 THEN 'schema [<root>]: ''bbox'' is a required property' WHEN event_id % 10 = 6 THEN 'schema [<root>]: additional properties: extra' WHEN event_id % 10 = 7 THEN 'bbox[0][1]=1500.0 out of range [0, 1000]' ELSE '' END AS errors FROM events WHERE event_id % 10 <> 9"""
)
def validate_lines(spark, d):
    line = '{"id": "e_1", "dataset": "bigen", "task": "grounding", "image_path": ["a.png"], "pair_type": "single", "gsd_bucket": "x", "split": "train", "instruction": "q", "response": "r", "bbox": [[1, 2, 3, 4]], "modality": "optical"}'
    k = F.col("event_id") % 10
    made = F.when(k == 3, '{"id": ').when(k == 4, line.replace('"e_1"', "5")).when(k == 5, line.replace(', "bbox": [[1, 2, 3, 4]]', "")).when(k == 6, line.replace("}", ', "extra": 1}')).when(k == 7, line.replace("[1, 2,", "[1, 1500,")).when(k == 9, "  ").otherwise(line)
    return validate.lines(table(spark, d, "events").select(F.col("event_id").alias("line_no"), made.alias("line"))).select("line_no", F.array_join("errors", "; ").alias("errors"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def dedupe_first(spark, d):
    return corpus.keep_first(table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS count FROM events GROUP BY user_id HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return corpus.duplicate_ids(table(spark, d, "events").select(F.col("user_id").cast("string").alias("id")))


@query("SELECT o_orderkey AS id, 0 AS tier_ord FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT c_custkey, 1 FROM customer")
def merge_union(spark, d):
    a = table(spark, d, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"))
    return corpus.union_tiers([a, table(spark, d, "customer").select(F.col("c_custkey").alias("id"))])


_FILES = "SELECT n_regionkey AS tier, concat(lower(substring(n_name, 1, 1)), CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_train' ELSE '_val_internal' END) AS stem FROM nation"


@query(f"WITH f AS (SELECT DISTINCT tier, stem FROM ({_FILES})) SELECT tier, stem FROM f WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.tier = f.tier AND g.stem = f.stem || '_train')")
def split_supersession(spark, d):
    return corpus.source_files(spark.sql(_FILES.replace("FROM nation", "FROM {n}"), n=table(spark, d, "nation")).distinct())


@query(f"SELECT DISTINCT tier, stem FROM ({_FILES}) WHERE stem NOT LIKE '%\\_train%' ESCAPE '\\' AND stem NOT LIKE '%\\_val%' ESCAPE '\\'")
def unsplit_files(spark, d):
    return corpus.unsplit_files(spark.sql(_FILES.replace("FROM nation", "FROM {n}"), n=table(spark, d, "nation")).distinct())


@query(f"WITH {S} SELECT 'total' AS field, '' AS value, count(*) AS count FROM s UNION ALL " + " UNION ALL ".join(f"SELECT '{f}', coalesce({f}, '?'), count(*) FROM s GROUP BY {f}" for f in ("dataset", "task", "pair_type", "modality", "split")))
def corpus_stats(spark, d):
    return corpus.grouped_counts(samples(spark, d))


@query(f"WITH {S}, t AS (SELECT count(*) AS total, count(*) FILTER (len(image_path) = 1) AS single, count(*) FILTER (len(image_path) = 2) AS paired, count(*) FILTER (bbox IS NOT NULL) AS with_bbox FROM s) SELECT *, concat(with_bbox, '/', total, ' (', CAST(round_even(with_bbox * 1000.0 / total, 0) AS BIGINT) // 10, '.', CAST(round_even(with_bbox * 1000.0 / total, 0) AS BIGINT) % 10, '%)') AS bbox_coverage FROM t")
def bbox_coverage(spark, d):
    return corpus.coverage(samples(spark, d))


@query("SELECT page_id, url, (row_number() OVER (ORDER BY url, page_id) - 1) // 20 AS shard, (row_number() OVER (ORDER BY url, page_id) - 1) % 20 AS place FROM pages")
def shard_assign(spark, d):
    return corpus.shard_assign(table(spark, d, "pages").select("page_id", "url"), ["url", "page_id"], 20)


# ---- manifest and joins


@query("SELECT doc_id AS id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def manifest_resume(spark, d):
    log = table(spark, d, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("processed"), F.lit(0).alias("ord"))
    return manifest.pending(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang"), log, "ord")


@query("SELECT user_id AS id, arg_max(value > 50, event_id) AS processed FROM events GROUP BY user_id")
def manifest_state(spark, d):
    return manifest.state(table(spark, d, "events").select(F.col("user_id").alias("id"), (F.col("value") > 50).alias("processed"), "event_id"), "event_id")


@query("SELECT count(*) AS total, count(*) FILTER (p) AS processed FROM (SELECT arg_max(value > 50, event_id) AS p FROM events GROUP BY user_id)")
def manifest_counts(spark, d):
    return manifest.counts(table(spark, d, "events").select(F.col("user_id").alias("id"), (F.col("value") > 50).alias("processed"), "event_id"), "event_id")


@query("SELECT count(*) FILTER (o_orderstatus = 'F') AS processed, count(*) FILTER (o_orderstatus = 'O') AS skipped, count(*) FILTER (o_orderstatus = 'P') AS failed FROM orders")
def run_counters(spark, d):
    outcome = F.when(F.col("o_orderstatus") == "F", "processed").when(F.col("o_orderstatus") == "O", "skipped").otherwise("failed")
    return manifest.outcomes(table(spark, d, "orders").select(outcome.alias("outcome")))


CUSTOMERS = _sampled("customer", "c_custkey", "", "greatest(1, floor(n * 0.05))", "c_custkey")


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN ({CUSTOMERS})")
def paired_selection(spark, d):
    chosen = sampling.uniform_sample(table(spark, d, "customer").select("c_custkey"), "c_custkey", 0.05)
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return o.join(chosen, o.o_custkey == chosen.c_custkey, "left_semi")


@query(
    """WITH o AS (SELECT concat('t', o_orderkey) AS tile, CASE WHEN c_custkey IS NOT NULL THEN concat('opt/', c_custkey, '.png') END AS opt FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) ON o_custkey = c_custkey)
  SELECT concat('sn6_sar_', tile) AS id, 'vqa' AS task, 'sar' AS modality, CAST(1 AS BIGINT) AS n_images FROM o UNION ALL SELECT concat('sn6_fusion_', tile), 'fusion_vqa', 'optical+sar', 2 FROM o WHERE opt IS NOT NULL"""
)
def fusion_rows(spark, d):
    rich = table(spark, d, "customer").filter("c_acctbal > 5000").select("c_custkey")
    o = table(spark, d, "orders")
    placed = o.join(rich, o.o_custkey == rich.c_custkey, "left").select(F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("tile"), F.when(F.col("c_custkey").isNotNull(), F.concat(F.lit("opt/"), F.col("c_custkey").cast("string"), F.lit(".png"))).alias("opt"))
    made = placed.select(F.explode(rows.radar_tile_rows(F.col("tile"), F.lit("sar.png"), F.col("opt"))).alias("r"))
    return made.select("r.id", "r.task", "r.modality", F.size("r.image_path").cast("long").alias("n_images"))


@query("SELECT user_id, max(value) FILTER (event_type = 'view') AS view, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY user_id")
def band_pivot(spark, d):
    return table(spark, d, "events").groupBy("user_id").pivot("event_type", ["view", "click", "purchase"]).agg(F.max("value"))


@query("SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def taxonomy_lookup(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")


@query(
    """WITH f AS (SELECT concat('d', doc_id) AS stem, CASE doc_id % 4 WHEN 0 THEN 'tif' WHEN 1 THEN 'jpg' ELSE 'png' END AS ext FROM documents WHERE doc_id % 5 <> 0 UNION ALL SELECT concat('d', doc_id), 'jpeg' FROM labels),
  b AS (SELECT stem, arg_min(concat(stem, '.', ext), list_position(['png', 'jpg', 'jpeg', 'tif'], ext)) AS image FROM f GROUP BY stem)
  SELECT doc_id, image FROM documents LEFT JOIN b ON concat('d', doc_id) = stem"""
)
def first_image(spark, d):
    docs = table(spark, d, "documents")
    stem = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    ext = F.when(F.col("doc_id") % 4 == 0, "tif").when(F.col("doc_id") % 4 == 1, "jpg").otherwise("png")
    files = docs.filter("doc_id % 5 <> 0").select(stem.alias("stem"), ext.alias("ext")).union(table(spark, d, "labels").select(stem, F.lit("jpeg")))
    files = files.withColumn("path", F.concat_ws(".", "stem", "ext"))
    return readers.first_image(docs.select("doc_id", stem.alias("key")), files, "key", ("png", "jpg", "jpeg", "tif")).select("doc_id", "image")


# ---- rows


@query(
    f"""WITH {S} SELECT id, gsd_bucket FROM s UNION ALL SELECT id || '_proxy', CASE WHEN modality = 'sar' THEN 'RISAT-proxy[GSD:5m]' ELSE 'CARTOSAT-proxy[GSD:2m]' END FROM s WHERE dataset IN ('vrsbench', 'rsvqa_hr', 'levir_cd', 'sn6_opt')"""
)
def dual_resolution(spark, d):
    return gsd.with_proxies(samples(spark, d), F.col("dataset").isin("vrsbench", "rsvqa_hr", "levir_cd", "sn6_opt")).select("id", "gsd_bucket")


_KNOWN = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in gsd.NATIVE_BUCKETS.items())


@query(
    f"""WITH {S} SELECT k, CASE dataset {_KNOWN} ELSE CASE WHEN k % 2 = 0 THEN concat('[GSD:', CASE WHEN k % 8 = 0 THEN concat(k // 8, 'm') ELSE printf('%d.%02d', CAST(round_even(k / 8.0 * 100, 0) AS BIGINT) // 100, CAST(round_even(k / 8.0 * 100, 0) AS BIGINT) % 100) || 'm' END, ']') ELSE 'VHR-native' END END AS bucket FROM s"""
)
def gsd_bucket(spark, d):
    known = F.when(F.col("k") % 2 == 0, F.col("k") / 8.0)
    return samples(spark, d).select("k", gsd.bucket(F.col("dataset"), known).alias("bucket"))


@query(
    """WITH l AS (SELECT l_orderkey, min(l_quantity) AS least FROM lineitem GROUP BY l_orderkey), p AS (SELECT o_orderkey, least >= 3 AS fine, o_orderpriority <> '5-LOW' AS radar FROM orders JOIN l ON o_orderkey = l_orderkey)
  SELECT concat(printf('bigen_%08d', o_orderkey), s) AS id FROM p, (VALUES (''), ('_sar'), ('_fusion')) v(s) WHERE fine AND (radar OR s = '')"""
)
def multi_emit_all_or_nothing(spark, d):
    least = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_quantity").alias("least"))
    o = table(spark, d, "orders").join(least, F.col("o_orderkey") == F.col("l_orderkey"))
    radar = F.when(F.col("o_orderpriority") != "5-LOW", "s.png")
    made = o.select("o_orderkey", "least", F.explode(rows.patch_rows(F.col("o_orderkey"), F.array(F.lit(1)), F.lit("o.png"), radar)).alias("r"))
    judged = made.select("o_orderkey", "r.*", F.when(F.col("least") < 3, F.array(F.lit("thin"))).otherwise(F.array().cast("array<string>")).alias("errors"))
    return corpus.all_or_nothing(judged, "o_orderkey").select("id")


@query(
    """WITH c AS (SELECT a.conv_id, concat('<image>\n[', CASE a.conv_id % 4 WHEN 0 THEN 'caption' WHEN 1 THEN 'refer' WHEN 2 THEN 'vqa' ELSE 'other' END, '] ', a.text) AS h, b.text AS g FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = 1 WHERE a.turn = 0)
  SELECT conv_id, CASE WHEN g IS NOT NULL AND conv_id % 4 < 3 THEN ['caption', 'refer', 'vqa'][CAST(conv_id % 4 AS INT) + 1] ELSE 'unknown' END AS task,
  CASE WHEN g IS NOT NULL AND conv_id % 4 < 3 THEN regexp_replace(regexp_replace(h, '(?s)^.*?\\[(?:caption|refer|vqa)\\]', ''), '^\\s+|\\s+$', '', 'g') ELSE '' END AS instruction, CASE WHEN conv_id % 4 < 3 THEN g END AS response FROM c"""
)
def conversation_parse(spark, d):
    c = table(spark, d, "conversations").filter("turn < 2")
    tag = F.when(F.col("conv_id") % 4 == 0, "caption").when(F.col("conv_id") % 4 == 1, "refer").when(F.col("conv_id") % 4 == 2, "vqa").otherwise("other")
    value = F.when(F.col("turn") == 0, F.concat(F.lit("<image>\n["), tag, F.lit("] "), F.col("text"))).otherwise(F.col("text"))
    turns = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", value.alias("value")))).alias("t"))
    return turns.filter("t[0].turn = 0").select("conv_id", text.parse_conversation(F.col("t")).alias("p")).select("conv_id", "p.*")


@query(
    """WITH c AS (SELECT concat(text, CASE WHEN conv_id % 3 = 0 THEN ' [refer]' ELSE '' END, CASE WHEN conv_id % 4 = 0 THEN ' [caption]' WHEN conv_id % 4 = 1 THEN ' [vqa]' ELSE '' END) AS t FROM conversations)
  SELECT CASE WHEN contains(t, '[caption]') THEN 'caption' WHEN contains(t, '[refer]') THEN 'refer' WHEN contains(t, '[vqa]') THEN 'vqa' END AS task, count(*) AS count FROM c GROUP BY 1"""
)
def task_distribution(spark, d):
    """Texts by the first of the tags that they have; some have two."""
    k = F.col("conv_id")
    more = F.concat(F.when(k % 3 == 0, " [refer]").otherwise(""), F.when(k % 4 == 0, " [caption]").when(k % 4 == 1, " [vqa]").otherwise(""))
    said = table(spark, d, "conversations").select(F.concat("text", more).alias("t"))
    return said.groupBy(text.task_tag(F.col("t")).alias("task")).agg(F.count(F.lit(1)).alias("count"))


_COVER = "['Built-up', 'Vegetation', 'Water', 'Barren', 'Agriculture', 'Forest', 'Wetland']"


@query(
    f"""SELECT k, dataset, task, n, instruction, response FROM (SELECT p_partkey AS k, 'levir_cd' AS dataset, CASE WHEN p_size > 25 THEN 'change_grounding' ELSE 'change_vqa' END AS task, 2 AS n, 'What building changes occurred between these two dates?' AS instruction, concat('Building changes detected in x', p_partkey, '.') AS response FROM part
  UNION ALL SELECT p_partkey, 'oscd', 'change_vqa', 1, 'What changed between the two dates?', concat('Change detected in ', p_name, '.') FROM part UNION ALL SELECT p_partkey, 'cdvqa', 'change_vqa', 1, p_name, p_type FROM part WHERE p_size % 2 = 0
  UNION ALL SELECT p_partkey, 'rsvqa_hr', 'vqa', 2, p_name, p_type FROM part UNION ALL SELECT p_partkey, 'sen2lulc', 'vqa', 1, 'What is the primary land cover type in this image?', CASE WHEN p_size < 7 THEN {_COVER}[CAST(p_size AS INTEGER) + 1] ELSE CAST(p_size AS VARCHAR) END FROM part)"""
)
def row_shapes(spark, d):
    p = table(spark, d, "part")
    k, key = F.col("p_partkey"), F.concat(F.lit("x"), F.col("p_partkey").cast("string"))
    box = F.when(F.col("p_size") > 25, F.array(F.array(*[F.lit(float(v)) for v in (1, 2, 3, 4)])))
    made = [
        rows.change_pair_rows(key, F.lit("a"), F.lit("b"), box),
        rows.location_rows(F.col("p_name"), F.lit("a"), F.lit("b")),
        rows.change_question_rows(key, F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(""), F.col("p_type"), F.lit("a"), F.lit("b")),
        rows.question_rows(key, F.col("p_name"), F.col("p_type"), F.lit("a.png")),
        rows.land_cover_rows(key, F.lit("a.png"), F.col("p_size").cast("string")),
    ]
    each = p.select(k.alias("k"), F.explode(F.array_compact(F.array(*made))).alias("r"))
    return each.select("k", *[F.col("r")[0][c].alias(c) for c in ("dataset", "task", "instruction", "response")], F.size("r").alias("n"))


# ---- boxes


@query("SELECT l_orderkey, l_linenumber, round_even(l_quantity / 640.0 * 1000, 2) AS x1, round_even(l_linenumber / 480.0 * 1000, 2) AS y1 FROM lineitem")
def bbox_normalize(spark, d):
    box = boxes.pixel_to_normalized(F.col("l_quantity"), F.col("l_linenumber").cast("double"), F.lit(600.0), F.lit(400.0), F.lit(640.0), F.lit(480.0))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", box.alias("b")).select("l_orderkey", "l_linenumber", F.col("b")[0][0].alias("x1"), F.col("b")[0][1].alias("y1"))


@query("SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 1000 * 640, 0) AS INTEGER) AS x1, CAST(round_even(l_linenumber * 3.0 / 1000 * 480, 0) AS INTEGER) AS y1 FROM lineitem")
def bbox_to_pixel(spark, d):
    box = F.array(F.array(F.col("l_quantity"), F.col("l_linenumber") * 3.0, F.lit(900.0), F.lit(900.0)))
    p = boxes.normalized_to_pixel(box, F.lit(640.0), F.lit(480.0))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", p["x1"].alias("x1"), p["y1"].alias("y1"))


@query("SELECT l_orderkey, l_linenumber, l_quantity <= 25 AND l_linenumber <= 4 AS fine FROM lineitem")
def bbox_order(spark, d):
    box = F.array(F.array(F.col("l_quantity"), F.col("l_linenumber").cast("double"), F.lit(25.0), F.lit(4.0)))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", boxes.ordered(box).alias("fine"))


@query("SELECT l_orderkey, l_linenumber, l_discount * 1000 AS x, l_tax * 1000 AS y FROM lineitem")
def unit_bbox(spark, d):
    b = boxes.unit_to_grid(F.array(F.array("l_discount", "l_tax")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", b[0][0].alias("x"), b[0][1].alias("y"))


@query("SELECT l_orderkey, l_linenumber, 0.5 * (l_tax * 1000 / 1000 + 0.5) + 0.25 * (l_discount * 1000 / 1000 + 0.5) + 10.0 AS x, 0.125 * (l_tax * 1000 / 1000 + 0.5) + -0.5 * (l_discount * 1000 / 1000 + 0.5) + 20.0 AS y FROM lineitem")
def bbox_to_map(spark, d):
    box = F.array(F.array(F.col("l_discount") * 1000, F.col("l_tax") * 1000, F.lit(900.0), F.lit(900.0)))
    p = boxes.grid_to_map(box, [0.5, 0.25, 10.0, 0.125, -0.5, 20.0])[0]
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", p["x"].alias("x"), p["y"].alias("y"))


@query(
    f"""WITH l AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) % 8 AS c, l_discount * 10 AS cx, l_tax * 10 AS cy, 0.2 AS w, 0.1 AS h FROM lineitem WHERE l_linenumber <> 3),
  b AS (SELECT *, greatest(0.0, trunc((cx - CAST(w AS DOUBLE) / 2) * 640)) AS x1, greatest(0.0, trunc((cy - CAST(h AS DOUBLE) / 2) * 480)) AS y1, least(640.0, trunc((cx + CAST(w AS DOUBLE) / 2) * 640)) AS x2, least(480.0, trunc((cy + CAST(h AS DOUBLE) / 2) * 480)) AS y2 FROM l WHERE c < 6)
  SELECT l_orderkey, l_linenumber, [{', '.join(repr(c) for c in SAR_CATEGORIES)}][c + 1] AS class_name, round_even(x1 / 640 * 1000, 2) AS x1, round_even(y1 / 480 * 1000, 2) AS y1, round_even(x2 / 640 * 1000, 2) AS x2, round_even(y2 / 480 * 1000, 2) AS y2 FROM b"""
)
def yolo_boxes(spark, d):
    parts = [(F.col("l_quantity").cast("int") % 8).cast("string"), (F.col("l_discount") * 10).cast("string"), (F.col("l_tax") * 10).cast("string"), F.lit("0.2"), F.when(F.col("l_linenumber") == 3, None).otherwise("0.1")]
    row = boxes.yolo_row(F.concat_ws(" ", *parts), F.lit(640.0), F.lit(480.0))
    found = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", row.alias("r")).filter("r IS NOT NULL")
    return found.select("l_orderkey", "l_linenumber", "r.class_name", *[F.col("r.bbox")[k].alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))])


@query(
    """SELECT p_partkey AS k, CAST(1 AS BIGINT) AS n, round_even(least(p_size, 30) / 640.0 * 1000, 2) AS x1, round_even(p_size % 7 / 480.0 * 1000, 2) AS y1, round_even(greatest(p_size, 30) / 640.0 * 1000, 2) AS x2, round_even(20 / 480.0 * 1000, 2) AS y2 FROM part"""
)
def polygon_boxes(spark, d):
    ring = F.concat(F.lit("[["), F.col("p_size").cast("string"), F.lit(".75,"), (F.col("p_size") % 7).cast("string"), F.lit("],[30,20.5],["), F.col("p_size").cast("string"), F.lit(",20]]"))
    geo = F.concat(F.lit('{"features":[{"geometry":{"type":"Polygon","coordinates":['), ring, F.lit(']}},{"geometry":{"type":"MultiPolygon","coordinates":[[[[1,1],[2,2]]]]}},{"geometry":{"type":"Point","coordinates":[1,2]}}]}'))
    found = boxes.polygons_to_boxes(readers.rings(geo), F.lit(640.0), F.lit(480.0))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), found.alias("b")).select("k", F.size("b").cast("long").alias("n"), *[F.col("b")[0][i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


@query("SELECT l_orderkey, l_linenumber, CAST(l_linenumber * 10 AS DOUBLE) AS x1, CAST(CAST(l_quantity AS INTEGER) * 10 AS DOUBLE) AS y2 FROM lineitem WHERE l_linenumber < 5 AND CAST(l_quantity AS INTEGER) > 2")
def geo_referring(spark, d):
    t = F.concat(F.lit("  {<"), F.col("l_linenumber").cast("string"), F.lit("><2><5><"), F.col("l_quantity").cast("int").cast("string"), F.lit(">} tail"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", boxes.referring_box(t).alias("b")).filter("b IS NOT NULL").select("l_orderkey", "l_linenumber", F.col("b")[0][0].alias("x1"), F.col("b")[0][3].alias("y2"))


# ---- radar, percentiles, masks

_DB = "10 * log10(greatest({v}, 1e-10))"
_BYTE = "CAST(trunc(greatest(0.0, least(1.0, ({x} - ({lo})) / {w})) * 255) AS INTEGER)"
_VV, _VH = _DB.format(v="value / 1000"), _DB.format(v="value / 4000")


@query(f"SELECT event_id, round_even({_DB.format(v='value')}, 6) AS db FROM events")
def sar_db(spark, d):
    return table(spark, d, "events").select("event_id", F.bround(sar.to_db(F.col("value")), 6).alias("db"))


@query(
    f"""SELECT event_id, {_BYTE.format(x='a', lo=-25, w=25)} AS r, {_BYTE.format(x='b', lo=-30, w=25)} AS g, {_BYTE.format(x='(a - b)', lo=0, w=25)} AS b FROM (SELECT event_id, least(greatest({_VV}, -25), 0) AS a, least(greatest({_VH}, -30), -5) AS b FROM events)"""
)
def sar_dual(spark, d):
    return table(spark, d, "events").select("event_id", sar.dual_rgb(F.col("value") / 1000, F.col("value") / 4000).alias("p")).select("event_id", "p.*")


@query(f"SELECT event_id, {_BYTE.format(x=_DB.format(v='value / 500'), lo=-25, w=25)} AS r, {_BYTE.format(x=_VV, lo=-25, w=25)} AS g, {_BYTE.format(x=_VH, lo=-30, w=25)} AS b FROM events")
def sar_quad(spark, d):
    return table(spark, d, "events").select("event_id", sar.quad_rgb(F.col("value") / 500, F.col("value") / 1000, F.col("value") / 4000).alias("p")).select("event_id", "p.*")


@query(f"SELECT event_id, {_BYTE.format(x=_VV, lo=-25, w=25)} AS r, {_BYTE.format(x=_VV, lo=-25, w=25)} AS b FROM events")
def sar_gray(spark, d):
    return table(spark, d, "events").select("event_id", sar.gray_rgb(F.col("value") / 1000).alias("p")).select("event_id", "p.r", "p.b")


_PIXELS = "(SELECT vec_id, label, (i - 1) // 8 AS y, (i - 1) % 8 AS x, CAST(embedding[i] AS DOUBLE) AS v FROM (SELECT vec_id, label, embedding, unnest(range(1, 65)) AS i FROM embeddings))"


def _grid(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("label"), F.posexplode(F.slice("embedding", 1, 64)).alias("i", "v"))
    return e.select("vec_id", "label", F.floor(F.col("i") / 8).cast("long").alias("y"), (F.col("i") % 8).cast("long").alias("x"), F.col("v").cast("double").alias("v"))


_BANDS = "(SELECT event_type, round_even(quantile_cont(value, 0.02), 6) AS low, round_even(quantile_cont(value, 0.98), 6) AS high FROM events GROUP BY event_type)"


@query(f"SELECT * FROM {_BANDS}")
def band_percentiles(spark, d):
    return stats.band_percentiles(table(spark, d, "events"), "event_type", "value")


@query(f"SELECT event_id, least(greatest(value, low), high) AS value FROM events JOIN {_BANDS} USING (event_type)")
def band_clip(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    return stats.band_clip(e, stats.band_percentiles(e, "event_type", "value"), "event_type", "value").select("event_id", "value")


@query(f"SELECT vec_id, min(x) AS x1, min(y) AS y1, max(x) AS x2, max(y) AS y2, count(*) AS pixels FROM {_PIXELS} WHERE v > 0 GROUP BY vec_id HAVING count(*) >= 10")
def mask_envelope(spark, d):
    return stats.envelope(_grid(spark, d).filter("v > 0"), ["vec_id"])


@query(f"SELECT vec_id, label, y % 3 AS class, min(x) AS x1, max(x) AS x2 FROM {_PIXELS} WHERE v > 0 GROUP BY vec_id, label, y % 3")
def class_envelopes(spark, d):
    return stats.envelope(_grid(spark, d).filter("v > 0").withColumn("class", F.col("y") % 3), ["vec_id", "label", "class"], 1).select("vec_id", "label", "class", "x1", "x2")


@query("SELECT vec_id, len(list_filter(embedding, lambda v: v > 0.05)) / len(embedding) AS share FROM embeddings")
def change_fraction(spark, d):
    return table(spark, d, "embeddings").select("vec_id", stats.change_fraction(F.col("embedding"), 0.05).alias("share"))


@query(
    f"""WITH RECURSIVE p AS (SELECT vec_id, y * 8 + x AS i, y, x FROM {_PIXELS} WHERE v > 0),
  e AS (SELECT a.vec_id, a.i, b.i AS j FROM p a JOIN p b ON a.vec_id = b.vec_id AND abs(a.x - b.x) + abs(a.y - b.y) = 1),
  r AS (SELECT vec_id, i, i AS j FROM p UNION SELECT r.vec_id, r.i, e.j FROM r JOIN e ON r.vec_id = e.vec_id AND r.j = e.i),
  c AS (SELECT vec_id, i, min(j) AS comp FROM r GROUP BY vec_id, i)
  SELECT vec_id, min(i % 8) AS x1, min(i // 8) AS y1, max(i % 8) AS x2, max(i // 8) AS y2 FROM c GROUP BY vec_id, comp HAVING count(*) >= 5"""
)
def components(spark, d):
    """Regions of a table of pixels."""
    runs = regions.runs_of_pixels(_grid(spark, d).filter("v > 0"), "vec_id")
    return regions.boxes(runs, "vec_id", 5).drop("pixels")


@query(ORACLE_SQL["components"])
def components_of_tiles(spark, d):
    """The same regions of images that lie in four tiles each."""
    part = lambda y, x: F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.when(F.get("embedding", (F.lit(y) + F.floor(i / 4)).cast("int") * 8 + x + i % 4) > 0, 1.0).otherwise(0.0))
    four = F.array(*[F.struct(F.lit(y).alias("top"), F.lit(x).alias("left"), part(y, x).alias("v")) for y in (0, 4) for x in (0, 4)])
    tiles = table(spark, d, "embeddings").select("vec_id", F.explode(four).alias("t")).select("vec_id", "t.*")
    runs = regions.runs_of_tiles(images.from_values(tiles, "v", 4, 4), "vec_id", top="top", left="left")
    return regions.boxes(runs, "vec_id", 5).drop("pixels")


@query(f"SELECT vec_id, y // 2 AS y, x // 2 AS x, round_even(avg(v), 6) + 0 AS v FROM {_PIXELS} GROUP BY vec_id, y // 2, x // 2")
def box_downsample(spark, d):
    """Area averages at half the resolution."""
    side = sar.downsampled_size(F.lit(8), F.lit(1.0), F.lit(0.5))
    small = regions.area_averages(_grid(spark, d).select("vec_id", "y", "x", "v"), ["vec_id"], F.lit(8), F.lit(8), side, side)
    return small.withColumn("v", F.bround("v", 6) + 0)


@query(
    f"""WITH p AS (SELECT vec_id, y, x, v, least(y + 1, (cy + 1) * 8 / 3.0::DOUBLE) - greatest(y, cy * 8 / 3.0::DOUBLE) AS py, least(x + 1, (cx + 1) * 8 / 5.0::DOUBLE) - greatest(x, cx * 8 / 5.0::DOUBLE) AS px, cy, cx
    FROM {_PIXELS}, (SELECT unnest(range(3)) AS cy), (SELECT unnest(range(5)) AS cx))
  SELECT vec_id, cy AS y, cx AS x, round_even(sum(v * py * px) / sum(py * px), 6) + 0 AS v FROM p WHERE py > 1e-9 AND px > 1e-9 GROUP BY vec_id, cy, cx"""
)
def area_downsample(spark, d):
    """Area averages at a size that divides pixels among cells."""
    small = regions.area_averages(_grid(spark, d).select("vec_id", "y", "x", "v"), ["vec_id"], F.lit(8), F.lit(8), F.lit(3), F.lit(5))
    return small.withColumn("v", F.bround("v", 6) + 0)


@query(
    f"""WITH q AS (SELECT vec_id, quantile_cont(v, 0.02) AS low, quantile_cont(v, 0.98) AS high FROM {_PIXELS} GROUP BY vec_id)
  SELECT vec_id, CAST(y * 8 + x AS INTEGER) AS i, round_even(least(greatest(v, low), high), 9) AS v FROM {_PIXELS} JOIN q USING (vec_id)"""
)
def image_clip(spark, d):
    """Every image clamped to its own percentiles."""
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode(stats.clip_to_percentiles(F.slice("embedding", 1, 64))).alias("i", "v"))
    return e.withColumn("v", F.bround("v", 9))


@query("SELECT p_partkey AS k, array_to_string(list_transform(range(0, 19), lambda i: CASE WHEN i IN (p_size, p_partkey % 23) THEN 1 ELSE 0 END), '') AS hot FROM part")
def multihot(spark, d):
    cell = F.array(F.col("p_size").cast("string"), F.lit("junk"), (F.col("p_partkey") % 23).cast("string"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.array_join(F.transform(text.multihot(cell), lambda v: v.cast("string")), "").alias("hot"))


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN p_type WHEN p_size < 7 THEN ['Built-up', 'Vegetation', 'Water', 'Barren', 'Agriculture', 'Forest', 'Wetland'][p_size + 1] ELSE CAST(p_size AS VARCHAR) END AS name FROM part")
def label_resolve(spark, d):
    label = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(F.col("p_size").cast("string"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), text.land_cover(label).alias("name"))


@query("SELECT p_partkey AS k, substring(replace(lower(concat(p_brand, '-', p_name)), '-', '_'), 1, 64) AS location, printf('cdvqa_%07d', p_partkey) AS id, CASE WHEN p_size % 2 = 0 THEN 'B08A' END AS band FROM part")
def id_forms(spark, d):
    name = F.concat(F.lit("tile_"), F.when(F.col("p_size") % 2 == 0, "B08A").otherwise("C08"), F.lit(".tif"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), text.location_id(F.concat_ws("-", "p_brand", "p_name")).alias("location"), text.padded(F.col("p_partkey"), 7, "cdvqa_").alias("id"), text.band_of(name).alias("band"))


@query("SELECT p_partkey AS k, greatest(32, p_partkey // 4) AS w, greatest(32, p_size // 4) AS h, greatest(1, CAST(round_even(p_partkey * 0.1, 0) AS INTEGER)) AS sar_w FROM part")
def proxy_sizes(spark, d):
    p = gsd.proxy_size(F.col("p_partkey"), F.col("p_size"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), p["w"].cast("long").alias("w"), p["h"].alias("h"), sar.downsampled_size(F.col("p_partkey").cast("int"), F.lit(5.0), F.lit(0.5)).alias("sar_w"))


# ---- training


@query(
    """SELECT o_orderkey AS step, CASE o_orderkey % 6 WHEN 2 THEN 0.8 WHEN 3 THEN 0.5 WHEN 4 THEN 0.3 WHEN 5 THEN 0.3 ELSE 1.0 END::DOUBLE AS stage_native, (CASE WHEN o_orderkey / 15000 < 0.33 THEN 1.0 WHEN o_orderkey / 15000 < 0.66 THEN 0.8 ELSE 0.5 END)::DOUBLE AS step_native FROM orders"""
)
def curriculum(spark, d):
    ratio = gsd.stage_ratio(F.col("o_orderkey") % 6)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("step"), ratio["native"].alias("stage_native"), gsd.step_ratio(F.col("o_orderkey"), F.lit(15000), F.array(F.lit(1.0), F.lit(0.8), F.lit(0.5))).alias("step_native"))


@query(
    f"""WITH {S}, m AS (SELECT id, contains(lower(gsd_bucket), 'proxy') AS proxy FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY proxy ORDER BY md5(concat_ws(':', id, '42')), id) AS rn, (SELECT count(*) FROM m) AS n FROM m)
  SELECT id, proxy FROM r WHERE rn <= CASE WHEN proxy THEN n - floor(n * 0.5) ELSE floor(n * 0.5) END"""
)
def native_proxy_mix(spark, d):
    mixed = sampling.native_proxy_mix(samples(spark, d).select("id", "gsd_bucket"), "id", 0.5)
    return mixed.select("id", gsd.is_proxy(F.col("gsd_bucket")).alias("proxy"))


_STEPS, _BATCH = 500, 8


@query(
    f"""WITH {S}, m AS (SELECT id, k, contains(lower(gsd_bucket), 'proxy') AS proxy FROM s), r AS (SELECT k AS key, proxy, row_number() OVER (PARTITION BY proxy ORDER BY md5(concat_ws(':', k, '42')), k) - 1 AS rn, count(*) OVER (PARTITION BY proxy) AS size FROM m),
  t AS (SELECT slot, slot // {_BATCH} AS step, CASE WHEN (slot // {_BATCH}) / {_STEPS}.0 < 0.33 THEN 800000 WHEN (slot // {_BATCH}) / {_STEPS}.0 < 0.66 THEN 500000 ELSE 300000 END AS share FROM (SELECT unnest(range({_STEPS * _BATCH})) AS slot)),
  u AS (SELECT slot, step, (sum(share) OVER (ORDER BY slot) - share) // 1000000 AS before, sum(share) OVER (ORDER BY slot) // 1000000 AS after FROM t),
  w AS (SELECT slot, step, before = after AS proxy, CAST(CASE WHEN before = after THEN slot - before ELSE before END AS BIGINT) AS rank FROM u)
  SELECT step, slot, rank // size AS epoch, key, w.proxy FROM w JOIN r ON w.proxy = r.proxy AND w.rank % r.size = r.rn"""
)
def training_steps(spark, d):
    """Rows dealt to the steps of a curriculum whose native share goes from 0.8 to 0.3."""
    return training.deal_to_steps(samples(spark, d).select("k", "gsd_bucket"), "k", _STEPS, _BATCH, [0.8, 0.5, 0.3])


@query("SELECT doc_id AS id, 'new' AS part FROM documents UNION ALL " + _sampled("benchmark", "item_id", "", "floor((SELECT count(*) FROM documents) * 0.02)", "item_id, 'replay'"))
def replay_mix(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("new").alias("part"))
    old = sampling.replay(table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.lit("replay").alias("part")), "id", 0.02, docs.count())
    return docs.unionByName(old)


@query(
    """WITH r AS (SELECT l_returnflag, avg(l_quantity) AS speed, max(l_extendedprice) AS memory, sum(CAST(l_tax * 100 AS BIGINT)) AS loss FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1), w AS (SELECT
  CASE WHEN max(speed) FILTER (l_returnflag = 'A') > max(speed) FILTER (l_returnflag = 'R') THEN 'dora' ELSE 'qlora' END AS speed, CASE WHEN max(memory) FILTER (l_returnflag = 'A') < max(memory) FILTER (l_returnflag = 'R') THEN 'dora' ELSE 'qlora' END AS memory,
  CASE WHEN max(loss) FILTER (l_returnflag = 'A') < max(loss) FILTER (l_returnflag = 'R') THEN 'dora' ELSE 'qlora' END AS loss FROM r)
  SELECT 'measured' AS kind, speed, memory, loss, CASE WHEN (speed = 'dora')::INT + (memory = 'dora')::INT + (loss = 'dora')::INT >= 2 THEN 'use_dora' ELSE 'use_qlora' END AS recommendation FROM w UNION ALL SELECT 'unmeasured', speed, memory, 'unmeasured', 'inconclusive' FROM w"""
)
def ab_compare(spark, d):
    """Two adapters compared by what was measured of them, and without a measured loss."""
    lines = table(spark, d, "lineitem").filter("l_returnflag IN ('A', 'R')").groupBy("l_returnflag").agg(F.avg("l_quantity").alias("steps_per_sec"), F.max("l_extendedprice").alias("memory_mb"), F.sum((F.col("l_tax") * 100).cast("long")).cast("double").alias("final_loss"))
    runs = lines.select(F.when(F.col("l_returnflag") == "A", "dora").otherwise("qlora").alias("name"), "steps_per_sec", "memory_mb", "final_loss")
    both = [training.compare(runs.withColumn("loss_is_real", F.lit(real))).select(F.lit(kind).alias("kind"), "*") for kind, real in (("measured", True), ("unmeasured", False))]
    return both[0].union(both[1])


@query(
    """SELECT 'images' AS kind, count(*) AS count, 1 AS needed, 0 AS expected, '' AS any_of, CASE WHEN count(*) < 1 THEN 'missing' ELSE 'ok' END AS status FROM pages WHERE page_id % 3 <> 0
  UNION ALL SELECT 'labels', count(*), 0, 0, '', 'ok' FROM pages WHERE page_id % 3 = 0"""
)
def structure_checks(spark, d):
    path = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("r/labels/"), F.col("page_id").cast("string"), F.lit(".txt"))).otherwise(F.concat(F.lit("r/images/"), F.col("page_id").cast("string"), F.lit(".png")))
    return checks.judge(table(spark, d, "pages").select(path.alias("path")), "sardet")


# ---- streams


@query("SELECT event_id, user_id FROM events WHERE value > 10")
def stream_resume(spark, d):
    from ..operators.tables import fresh_folder

    events = table(spark, d, "events")
    home = fresh_folder(spark)
    resume.resume(spark, d, events.schema, lambda b: b.filter("value > 10").select("event_id", "user_id"), f"{home}/sink", f"{home}/log", glob="events.parquet")
    return spark.read.parquet(f"{home}/sink").select("event_id", "user_id")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def incremental_first(spark, d):
    """The first event of each user and type, from three increments, of which the last are the earliest and one is run twice."""
    from ..operators.tables import fresh_folder

    home, e = fresh_folder(spark), table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts")
    for part in (2, 1, 2, 0):
        resume.add_increment(e.filter(F.col("event_id") % 3 == part), ["user_id", "event_type"], ["ts", "event_id"], f"{home}/state", part)
    return resume.first_of_state(spark, f"{home}/state").drop("ts")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def stream_first(spark, d):
    """The same from a stream of files; a second run finds nothing new."""
    from ..operators.tables import fresh_folder

    home, schema = fresh_folder(spark), table(spark, d, "events").schema
    for _ in range(2):
        resume.keep_first_stream(spark, d, schema, ["user_id", "event_type"], ["ts", "event_id"], f"{home}/state", f"{home}/log", glob="events.parquet")
    return resume.first_of_state(spark, f"{home}/state").select("user_id", "event_type", "event_id", "value")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    return resume.windowed_counts(table(spark, d, "events"), "ts", "event_type").withColumn("start", F.col("start").cast("timestamp_ntz"))

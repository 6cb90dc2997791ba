"""Entries of large JSON arrays, read by many tasks: a file is cut at closing braces and put together by prefix sums.

Spark's text source splits a file at any byte and finds the next ``}``, so the pieces between braces come in parallel. What a piece
does to the state of the text before it (within a string or not, how deep in brackets) is a small function: it turns the string
state over by its number of quotes, and adds to the depth by the brackets outside of strings, for either state it may begin in.
These functions are composed by sums over splits, of which there are few, and over the pieces within a split. An entry is the
run of pieces from the last one that comes out of the entry before it to the brace that closes back to its depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.tables import join_small, materialise

_SPLIT = ["file", "at"]
#: An array of objects under a key, and one without entries.
_NAMED, _EMPTY = r'"([^"\\]*)"\s*:\s*\[\s*\{', r'"([^"\\]*)"\s*:\s*\[\s*\]'


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, at (offset of the split), i (order in it), value, quotes, and the change of depth and its least on the way, if the piece begins
    outside (0) or within (1) a string."""
    text = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    # an escape never crosses a brace: a piece begins behind one
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    brackets = lambda k: F.regexp_replace(F.array_join(F.filter(parts, lambda _, i: i % 2 == k), ""), r"[^\[\]{]", "")
    rows = text.select(*_SPLIT, F.monotonically_increasing_id().alias("i"), "value", (F.size(parts) - 1).cast("long").alias("quotes"), brackets(0).alias("b0"), brackets(1).alias("b1"))
    step = lambda c: F.when(c == "]", -1).otherwise(1)
    depth = lambda b: F.aggregate(F.filter(F.split(b, ""), lambda c: c != ""), F.struct(F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("m")), lambda a, c: F.struct((a["d"] + step(c)).alias("d"), F.least(a["m"], a["d"] + step(c)).alias("m")))
    return rows.select(*_SPLIT, "i", "value", "quotes", depth("b0").alias("s0"), depth("b1").alias("s1"))


def _from_start(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds for each column its sum over all rows of the file before this one, under a new name."""
    sums = rows.groupBy(*_SPLIT).agg(*[F.sum(c).alias(c) for c in columns])
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(sums.select(*_SPLIT, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in columns]))
    joined = join_small(rows, starts, _SPLIT)
    upto = Window.partitionBy(*_SPLIT).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return joined.select(*rows.columns, *[(F.col(f"_{c}") + F.coalesce(F.sum(c).over(upto), F.lit(0))).alias(n) for c, n in columns.items()])


def texts(spark: SparkSession, path: str, wrappers: tuple[str, ...] = ()) -> DataFrame:
    """file, position (from 0) and text of the objects of each file's array: the file is a list, or an object that has one under the
    first of the wrappers that is there. Entries that aren't objects have no row."""
    pieces = materialise(_pieces(spark, path))
    within = _from_start(pieces, {"quotes": "seen"})
    opens, ends = F.col("seen") % 2, (F.col("seen") + F.col("quotes")) % 2
    moved = within.withColumn("in", ends).withColumn("change", F.when(opens == 0, F.col("s0.d")).otherwise(F.col("s1.d")) - F.when(ends == 0, 1).otherwise(0)).withColumn("least", F.when(opens == 0, F.col("s0.m")).otherwise(F.col("s1.m")))
    heads = materialise(pieces.groupBy("file").agg(F.min_by("value", F.struct("at", "i")).alias("head")))
    base = heads.select("file", F.when(F.regexp_replace("head", r"^[\s\uFEFF]+", "").startswith("["), 1).otherwise(2).alias("base"))
    deep = join_small(_from_start(moved.drop("seen", "quotes", "s0", "s1"), {"change": "depth"}), base, ["file"])
    closes = (F.col("in") == 0) & (F.col("depth") + F.col("change") == F.col("base"))
    marked = deep.withColumn("closed", closes.cast("long")).withColumn("begun", (F.col("depth") + F.col("least") <= F.col("base")).cast("long")).drop("in", "change", "least")
    numbered = _from_start(marked, {"closed": "number", "begun": "run"}).withColumn("run", F.col("run") + F.col("begun"))
    runs = numbered.groupBy("file", "run", "base").agg(F.min("number").alias("number"), F.max("closed").alias("closed"), F.array_sort(F.collect_list(F.struct("at", "i", "value"))).alias("parts"))
    whole = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    head = F.col("parts")[0]["value"]
    more = F.col("number").isNotNull() & head.rlike(r"^\s*,\s*\{")
    # what stands before an entry that doesn't go on with the array before it: empty arrays, then the name of its own
    name = F.regexp_extract(head, _NAMED, 1)
    ahead = F.when(name != "", F.regexp_extract(head, rf"(?s)^(.*?){_NAMED}", 1)).otherwise(head)
    found = runs.select("file", "number", "base", F.col("closed") == 1, whole, more, F.when(~more, name), F.when(~more, F.regexp_extract_all(ahead, F.lit(_EMPTY), 1))).toDF("file", "number", "base", "closed", "text", "more", "name", "empty")
    found = materialise(found)
    plain = found.filter("base = 1 AND closed").select("file", F.col("number").alias("position"), F.regexp_replace("text", r"^[\s\uFEFF\[,]+", "").alias("text"))
    if not wrappers:
        return plain
    # the arrays of a file are few: where each begins and ends, and which one is wanted
    arrays = found.filter("base = 2 AND NOT more").select("file", "number", "closed", "name", "empty")
    following = Window.partitionBy("file").orderBy("number")
    order = lambda c: F.array_position(F.array(*[F.lit(w) for w in wrappers]), c)
    full = arrays.filter("closed").select("file", F.col("number").alias("first"), F.lead("number").over(following).alias("next"), order(F.col("name")).alias("rank"))
    none = arrays.select("file", F.explode("empty").alias("name")).select("file", F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("next"), order(F.col("name")).alias("rank"))
    chosen = full.unionByName(none).filter("rank > 0").groupBy("file").agg(F.min_by(F.struct("first", "next"), "rank").alias("c")).select("file", "c.*")
    held = join_small(found.filter("base = 2 AND closed"), materialise(chosen), ["file"]).filter("number >= first AND (next IS NULL OR number < next)")
    own = F.regexp_replace(F.when(F.col("more"), F.col("text")).otherwise(F.regexp_replace("text", rf"(?s)^.*?{_NAMED}", "{")), r"^\s*,\s*", "")
    return plain.unionByName(held.select("file", (F.col("number") - F.col("first")).alias("position"), own.alias("text")))


def read(spark: SparkSession, path: str, schema: T.StructType, wrappers: tuple[str, ...] = ()) -> DataFrame:
    """position and the fields of the entries; a file is read by as many tasks as it has splits."""
    return texts(spark, path, wrappers).select("position", F.from_json("text", schema).alias("e")).select("position", "e.*")

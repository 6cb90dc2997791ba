"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

An item's windows are its runs of ``width`` consecutive words (the whole item if it is shorter). A window is found in
a document only if all of its words are, so by the prefix-filter principle one token of it, the rarest in a global
order, is enough to find all candidates: the documents' words are joined with the windows' rarest words. The place of
the token in the window gives the only possible start in the document (positional bound); windows that would stick
out are dropped (length bound); what is left is compared word by word (exact containment).

Rarity is the count of a word over all documents. Two passes read the documents; the index of windows is broadcast if
it weighs at most ``BROADCAST_ROWS`` (a row, an item of a row, and each 100 characters weigh one), else candidates are found
by a shuffled join on words without the texts. Counts of the windows' words are broadcast under the same bound.

Edge cases
    Null and word-less documents have no words and are not contaminated. Items without words have no window. Items with a null
    item_id count for hits but not for n_items. Of equally rare words of a window (ties) the first in order holds; results don't
    depend on it. Repeated documents each get a row, repeated items count once. An empty benchmark hits nothing; an empty table
    gives an empty result. Very long texts are searched whole. Further columns are ignored (``keep`` passes them through),
    whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, join_dimension, lower_az, materialise

#: Windows (rows, items and hundreds of characters) that are broadcast at most: some 20 MB.
BROADCAST_ROWS = 200_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _windows(benchmark: DataFrame, width: int) -> DataFrame:
    """win, len, items: the distinct windows and the ids (as strings) of the items that have them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(width))
    starts = items.select("item", "w", length.alias("len"), F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("s"))
    return starts.select("item", F.slice("w", F.col("s"), F.col("len")).alias("win"), "len").groupBy("win", "len").agg(F.collect_set("item").alias("items"))


def _index(docs: DataFrame, windows: DataFrame, limit: int) -> DataFrame:
    """word, off, win, len, items: the windows under their rarest word by its count over all documents."""
    vocabulary = windows.select(F.explode("win").alias("word")).distinct()
    small = vocabulary.limit(limit + 1).count() <= limit
    tokens = docs.select(F.explode(words(F.col("text"))).alias("word"))
    if small:
        counted = tokens.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    else:  # counts before the join: the most common word is a row of each task, not all of its tokens
        counted = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(vocabulary, "word")
    counted = materialise(counted)
    tokens = windows.select("win", F.posexplode("win").alias("off", "word")).join(F.broadcast(counted) if small else counted, "word", "left")
    rarest = tokens.groupBy("win").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "off")).alias("r"))
    return rarest.join(windows, "win").select("r.word", "r.off", "win", "len", "items")


def find(docs: DataFrame, benchmark: DataFrame, width: int = 13, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, mark, n_words, n_hit, items. ``mark`` is xxhash64 of the text."""
    windows = materialise(_windows(benchmark, width))
    index = materialise(_index(docs, windows, broadcast_rows))
    n_index = index.agg(F.sum(1 + F.size("items") + F.length(F.concat_ws(" ", "win")) / 100)).first()[0] or 0
    # one token more than the document has words keeps a row for every document
    end = index.sparkSession.createDataFrame([("", 0, [], 0, [])], index.schema)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.xxhash64("text").alias("mark"), words(F.col("text")).alias("w"))
    start = F.col("pos") - F.col("off")
    fits = (start >= 0) & (start + F.col("len") <= F.size("w"))
    same = F.slice("w", F.when(fits, start + 1).otherwise(F.lit(1)), F.col("len")) == F.col("win")
    if n_index <= broadcast_rows:
        tokens = rows.select("rid", "doc_id", "mark", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "word"))
        hits = tokens.join(F.broadcast(index.union(end)), "word").filter((F.col("len") == 0) | (fits & same))
        hits = hits.select("rid", "doc_id", "mark", F.size("w").alias("n_words"), start.alias("start"), "len", "items")
    else:
        rows = materialise(rows)
        # a window of common words only has a common rarest word: its tokens are dealt to many tasks
        near = join_dimension(rows.select("rid", F.posexplode("w").alias("pos", "word")), index.select("word", "off", "len", F.xxhash64("win").alias("wid")), "word", few=False)
        near = near.join(rows.select("rid", "w"), "rid").filter(fits)
        near = near.select("rid", start.alias("start"), "w", "wid").join(index.select(F.xxhash64("win").alias("wid"), "win", "len", "items"), "wid")
        near = near.filter(F.slice("w", F.col("start") + 1, F.col("len")) == F.col("win")).select("rid", "start", "len", "items")
        hits = rows.select("rid", "doc_id", "mark", F.size("w").alias("n_words")).join(near, "rid", "left").withColumn("len", F.coalesce("len", F.lit(0)))
    span = F.when(F.col("len") > 0, F.struct("start", "len"))
    found = hits.groupBy("rid", "doc_id", "mark", "n_words").agg(F.collect_set(span).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))
    return found.select("doc_id", "mark", F.col("n_words").cast("long").alias("n_words"), F.size(hit).cast("long").alias("n_hit"), "items")


def judge(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return find(docs, benchmark, width).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def contaminated() -> Column:
    """At least one word, and at least a twentieth of the words, is in a window."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def keep(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    bad = bounded_broadcast(materialise(find(docs, benchmark, width).filter(contaminated()).select("doc_id", "mark").distinct()), BROADCAST_ROWS)
    # all columns travel inside a struct, where their names can't clash with ours
    packed = docs.select(F.col("doc_id").alias("own"), F.xxhash64("text").alias("own_mark"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return packed.join(bad, F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("own_mark") == F.col("mark")), "left_anti").select("row.*")

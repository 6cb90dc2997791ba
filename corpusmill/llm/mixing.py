"""Mixing sources to target weights by weighted fair queueing.

Every source sends its documents in a shuffled order, a second time after the first, and so on up to
``max_epochs``. A copy of a document gets a virtual finish time: the source's words up to and including it,
divided by the source's weight. All copies are put in the order of their finish times and the order is cut
where the total budget is reached. A source that has sent all its epochs leaves its share to the others.

No source is ever sorted in one task: running totals are taken over hash slices of each source, whose sums are
added up first. In the same way the global order is cut into ranges of virtual time, and the range that holds the cut
into ranges again, until it has at most ``MOST_ROWS`` rows, which are ordered row by row. Sources are a dimension: one
row for each is held in one task.

Edge cases
    Null text has no words (its ``taken`` is 0). Null source is a source, last in order. Repeated rows are separate documents with
    places of their own in ``mix``; ``lay_out`` decides rows alike that are equal in id, source and size. Rows with null doc_id are
    ordered by their text's digest. Ties of virtual time go by source, then epoch. Very long texts only count their words; no
    document is taken in part. An empty table gives an empty result. Further columns are ignored by ``mix`` and pass through
    ``lay_out``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_broadcast, materialise

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
#: Hash slices of each source (16 to this power), and ranges of virtual time, that are ordered apart.
SLICE_DIGITS = 3
RANGES = 4096
#: Copies of the last range, which are sorted in one task.
MOST_ROWS = 1_000_000
#: Sources whose ends are broadcast at most (some 300 bytes each).
MOST_SOURCES = 50_000


def n_words(text: Column) -> Column:
    """Words separated by ASCII white space; null has none."""
    # the text is coalesced, not the size: without ANSI the size of null is -1
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """src, source_size, weight, target for sources' sizes: shares of the budget by weight, each at most max_epochs of its source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights)).cast("long")
    everything = Window.partitionBy()
    # sources by the level at which they are full: all before the first that isn't full stay full
    fill = Window.orderBy(F.col("most") / F.col("weight"), "src")
    upto, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * max_epochs)
        .withColumn("left", F.sum("source_size").over(everything) * F.lit(float(budget)) - F.coalesce(F.sum("most").over(upto), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(rest))
        .withColumn("full", F.col("most") * F.col("weights") <= F.col("left") * F.col("weight"))
        # the first source that isn't full sets the level
        .withColumn("level", F.first(F.when(~F.col("full"), F.struct("left", "weights")), ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("target", F.when(F.col("full") | F.col("level").isNull(), F.col("most").cast("double")).otherwise(F.col("level.left") * F.col("weight") / F.col("level.weights")))
        .select("src", "source_size", "weight", "target")
    )


def _ordered(docs: DataFrame, seed: int, keep: list[str]) -> DataFrame:
    """doc_id, source, src, size, h and the columns ``keep`` of docs. The md5 of seed and id, h, is the shuffled order."""
    src = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    named = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    h = F.md5(F.concat_ws(":", named, F.lit(str(seed))))
    return docs.select("doc_id", "source", src.alias("src"), n_words(F.col("text")).alias("size"), h.alias("h"), *keep)


def finish_times(docs: DataFrame, seed: int, weights: tuple[int, ...], budget: float, max_epochs: int) -> DataFrame:
    """A row per document: doc_id, size, src, h, slice, no, source_size, weight, target and cum, the source's words up to it.

    The first digits of h name the slice. ``no`` is the place in the slice.
    """
    sized = materialise(_ordered(docs, seed, []).withColumn("slice", F.substring("h", 1, SLICE_DIGITS)))
    slices = sized.groupBy("src", "source", "slice").agg(F.sum("size").alias("sum"))
    dims = targets(slices.groupBy("src", "source").agg(F.sum("sum").alias("source_size")), weights, budget, max_epochs)
    before = Window.partitionBy("src").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("src", "slice", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("src", "slice").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sized.select("doc_id", "size", "src", "h", "slice", F.sum("size").over(inside).alias("run"), F.row_number().over(inside).alias("no"))
    return run.join(starts, ["src", "slice"]).join(dims, "src").withColumn("cum", F.col("run") + F.col("start")).drop("run", "start")


def _finish(epoch: Column) -> Column:
    """Virtual finish time of a document's copy in an epoch (from 1)."""
    return ((epoch - 1) * F.col("source_size") + F.col("cum")) / F.col("weight")


def _place(epoch: Column) -> Column:
    """Where that copy stands in the global order."""
    return F.struct(_finish(epoch).alias("finish"), F.col("src"), epoch.alias("epoch"), F.col("slice"), F.col("no"))


def cut(timed: DataFrame, budget: float, max_epochs: int):
    """The place of the first copy that no longer fits the budget, as a column; None where all fit."""
    sources = timed.select("src", "source_size", "weight").distinct()
    limit, span = sources.agg(F.sum("source_size") * F.lit(float(budget)), F.max(F.col("source_size") * max_epochs / F.col("weight"))).first()
    if not span:
        return None
    copies = timed.filter(F.col("size") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(max_epochs)))).select("size", _place(F.col("epoch")).alias("place"))
    lo, hi, sent = 0.0, float(span), 0
    while True:
        # finish times are cut into ranges; running sums of the few ranges say which one holds the cut
        at = F.least(F.lit(RANGES - 1), F.floor((F.col("place.finish") - lo) / (hi - lo) * RANGES)).cast("int")
        ranged = copies.withColumn("range", at)
        upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = ranged.groupBy("range").agg(F.sum("size").alias("sum"), F.count(F.lit(1)).alias("rows"), F.min("place.finish").alias("first"), F.max("place.finish").alias("last"))
        over = sums.withColumn("upto", F.sum("sum").over(upto) + sent).filter(F.col("upto") > limit)
        if (edge := over.orderBy("range").first()) is None:
            return None
        sent, copies = edge["upto"] - edge["sum"], ranged.filter(F.col("range") == edge["range"]).drop("range")
        if edge["rows"] <= MOST_ROWS or edge["first"] == edge["last"]:
            break
        lo, hi = edge["first"], edge["last"]
    order = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = copies.withColumn("upto", F.sum("size").over(order) + sent).filter(F.col("upto") > limit).orderBy("place").select("place.*").first()
    return F.struct(*[F.lit(v).cast(t).alias(n) for n, v, t in zip(("finish", "src", "epoch", "slice", "no"), first, ("double", "string", "int", "string", "int"), strict=True)])


def _copies(timed: DataFrame, budget: float, max_epochs: int) -> Column:
    """How many copies of a row of ``timed`` are before the cut."""
    end = cut(timed, budget, max_epochs)
    return sum((F.when(_place(F.lit(e)) < end, 1).otherwise(0) for e in range(1, max_epochs + 1)), F.lit(0)) if end is not None else F.lit(max_epochs)


def mix(docs: DataFrame, seed: int = 42, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, size, source_size, target, taken, first_finish.

    ``taken`` is size times the number of the document's copies before the cut. ``first_finish`` orders a first epoch.
    """
    timed = materialise(finish_times(docs, seed, weights, budget, max_epochs))
    return timed.select("doc_id", "size", "source_size", "target", (F.col("size") * _copies(timed, budget, max_epochs)).alias("taken"), _finish(F.lit(1)).alias("first_finish"))


def lay_out(docs: DataFrame, seed: int = 42, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of docs that the mix takes, with all their columns, and size, source_size, target, taken and copies (times to be read).

    Texts are never shuffled: within a source and epoch the mix takes a first stretch of the shuffled order, so a row is judged by
    itself against the last place taken, a small table of sources and epochs.
    """
    timed = materialise(finish_times(docs, seed, weights, budget, max_epochs))
    at = lambda size: F.struct(F.col("h").alias("h"), F.col("doc_id").alias("doc_id"), size.alias("size"))
    judged = timed.filter("size > 0").withColumn("copies", _copies(timed, budget, max_epochs))
    last = [F.max(F.when(F.col("copies") >= e, at(F.col("size")))).alias(f"last{e}") for e in range(1, max_epochs + 1)]
    ends = judged.groupBy("src").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), *last)
    # all columns travel inside a struct, where their names can't clash with ours
    packed = _ordered(docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), seed, ["row"])
    copies = sum((F.when(at(F.col("size")) <= F.col(f"last{e}"), 1).otherwise(0) for e in range(1, max_epochs + 1)), F.lit(0))
    found = packed.filter("size > 0").join(bounded_broadcast(ends, MOST_SOURCES), "src").withColumn("copies", copies).filter("copies > 0")
    more = [c for c in ("size", "source_size", "target") if c not in docs.columns]
    taken = [] if "taken" in docs.columns else [(F.col("size") * F.col("copies")).alias("taken")]
    return found.select("row.*", *more, *taken, *([] if "copies" in docs.columns else ["copies"]))

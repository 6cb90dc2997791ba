"""Chat formatting by multi-party perspective rotation, in DataFrame operations only.

For every participant of a dialogue one example is made in which that speaker is the assistant and all others are named users.
The loss mask is the list of spans (code points, end exclusive) of the speaker's own texts with their closing marks.

An example is the whole dialogue, however long: one row for each dialogue and speaker, since that row is the result. Places come
from running sums over the dialogue in which everyone is a named user; a speaker's k-th own turn is moved by k times the difference
of the two headings. So each turn is laid out once, not once for every speaker, in linear time and by windows that spill.

Texts and names are escaped (``&`` and ``<``, in names ``>`` and ``"`` too), so that nothing in them can pass for a mark.

Edge cases
    Null text is empty; null role is the name ``unknown``. Turns come in order of (turn, role, text), null turns first; ties of all
    three are equal turns, so their order doesn't matter. Repeated rows are repeated turns. Rows with a null conv_id are dialogues of
    one turn each. Roles in ``NARRATORS`` set the scene and get no example of their own; a dialogue of them alone gives no row. An
    empty table gives an empty result. Very long texts are laid out whole. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NARRATORS = ("system",)
OWN = "<assistant>\n"


def escaped(text: Column, name: bool = False) -> Column:
    """A text, or a name, without anything that could be read as a mark."""
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), *([(">", "&gt;"), ('"', "&quot;")] if name else [])):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def rotate(turns: DataFrame) -> DataFrame:
    """conv_id, speaker, n_turns, n_own, text, mask for turns (conv_id, turn, role, text)."""
    narrates = F.col("role").isin(*NARRATORS)
    name = escaped(F.col("role"), name=True)
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    clean = (
        turns.select("conv_id", alone.alias("alone"), "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("raw"))
        .withColumn("head", F.when(narrates, F.concat(F.lit("<"), name, F.lit(">\n"))).otherwise(F.concat(F.lit('<user name="'), name, F.lit('">\n'))))
        .withColumn("body", F.concat(escaped(F.col("raw")), F.lit("\n</turn>\n")))
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("raw")]
    dialogue = Window.partitionBy("conv_id", "alone").orderBy(*order)
    before = F.coalesce(F.sum(F.length("head") + F.length("body")).over(dialogue.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("conv_id", "alone", "role").orderBy(*order)) - 1
    start = F.col("before") + F.col("nth") * (len(OWN) - F.length("head")) + len(OWN)
    placed = (
        clean.withColumn("place", F.row_number().over(dialogue))
        .withColumn("before", before)
        .withColumn("nth", nth)
        .withColumn("span", F.concat_ws(":", start.cast("string"), (start + F.length("body")).cast("string")))
    )
    whole = placed.groupBy("conv_id", "alone").agg(F.array_sort(F.collect_list(F.struct("place", "role", "head", "body", "span"))).alias("turns"))
    speakers = F.array_distinct(F.transform(F.filter("turns", lambda t: ~t["role"].isin(*NARRATORS)), lambda t: t["role"]))
    rotated = whole.select("conv_id", "turns", F.explode(speakers).alias("speaker"))
    own = F.filter("turns", lambda t: t["role"] == F.col("speaker"))
    laid = F.transform("turns", lambda t: F.concat(F.when(t["role"] == F.col("speaker"), F.lit(OWN)).otherwise(t["head"]), t["body"]))
    return rotated.select(
        "conv_id",
        "speaker",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(own).cast("long").alias("n_own"),
        F.array_join(laid, "").alias("text"),
        F.array_join(F.transform(own, lambda t: t["span"]), ",").alias("mask"),
    )

"""Conversations, labels and ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CORINE, LAND_COVER

#: Whole numbers as a cast takes them: with white space and control characters around.
WHOLE = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"
TAG = r"\[(caption|refer|vqa)\]"


#: Tags of tasks, in the order in which they hold.
TAGS = ("caption", "refer", "vqa")


def task_tag(text: Column) -> Column:
    """The first of the tags that stands in a text, null without one: a text with two of them counts once."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(f"[{t}]")), F.lit(t)) for t in TAGS])


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_conversation(turns: Column) -> Column:
    """task, instruction and response of an array of turns (from, value); task unknown if there are fewer than two or no tag."""
    human, reply = F.get(turns, F.lit(0))["value"], F.get(turns, F.lit(1))["value"]
    task = F.regexp_extract(human, TAG, 1)
    found = (F.size(turns) >= 2) & (task != "")
    rest = strip(F.regexp_replace(human, r"(?s)^.*?\[(?:caption|refer|vqa)\]", ""))
    return F.struct(F.when(found, task).otherwise("unknown").alias("task"), F.when(found, rest).otherwise("").alias("instruction"), F.when(found, reply).alias("response"))


def multihot(cell: Column, n: int = 19) -> Column:
    """0/1 per class from an array of class numbers (as strings or numbers), or from an array that is multihot already."""
    # a text that is no number costs an exception each time it is cast, so such texts aren't, and the numbers are worked out once
    numbers = F.transform(cell.cast("array<string>"), lambda v: F.when(v.rlike(WHOLE), v.try_cast("int")))

    def hot(x: Column) -> Column:
        ready = (F.size(x) == n) & (F.size(F.array_except(x, F.array(F.lit(0), F.lit(1)))) == 0)
        return F.when(x.isNull(), F.array_repeat(F.lit(0), n)).when(ready, x).otherwise(F.array(*[F.when(F.array_contains(x, i), 1).otherwise(0) for i in range(n)]))

    return F.transform(F.array(numbers), hot)[0]


def active_classes(hot: Column, names=CORINE) -> Column:
    """Names of the classes that are on, in class order, joined with commas; null if none is."""
    named = F.zip_with(hot, F.array(*[F.lit(x) for x in names]), lambda v, x: F.when(v > 0, x))
    text = F.array_join(F.array_compact(named), ", ")
    return F.when(text != "", text)


def land_cover(label: Column, names=LAND_COVER) -> Column:
    """A class name from a label text: a whole number in range names a class; other texts stand for themselves."""
    digits = F.when(strip(label).rlike(r"^-*\d+$"), strip(label).try_cast("int"))
    named = F.when(digits >= 0, F.get(F.array(*[F.lit(x) for x in names]), digits))
    return F.coalesce(named, F.when(label != "", label), F.lit("Unknown land cover"))


def location_id(name: Column) -> Column:
    return F.substring(F.replace(F.lower(name), F.lit("-"), F.lit("_")), 1, 64)


def padded(number: Column, width: int, prefix: str = "", suffix: str = "") -> Column:
    """A number with leading zeros between a prefix and a suffix; longer numbers are kept whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")), F.lit(suffix))


def band_of(name: Column) -> Column:
    """Band of a file name such as ``x_B04.tif``; null without one."""
    band = F.regexp_extract(name, r"_(B\d{2}[A-Z]?)\.tif$", 1)
    return F.when(band != "", band)

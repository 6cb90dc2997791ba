"""Staged validation: schema, then coordinate range, then rules across fields; a later stage only where the earlier found nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import coordinate_errors
from ..schema import ANSWER_TASKS, DATASETS, FIELDS, GROUNDING_TASKS, MODALITIES, PAIR_TYPES, SAMPLE, SPLITS, TASKS

ENUMS = {"dataset": DATASETS, "task": TASKS, "pair_type": PAIR_TYPES, "split": SPLITS, "modality": MODALITIES}
TEXTS = ("gsd_bucket", "instruction", "response")
ID_PATTERN = r"^[a-z0-9_]+$"


def _collect(*errors: tuple[Column, Column | str]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.lit(msg) if isinstance(msg, str) else msg) for cond, msg in errors]))


def _quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(c, F.lit("None")), F.lit("'"))


def schema_errors() -> Column:
    """For typed rows: a null where a value must be is a type error."""
    found = [(F.col(f).isNull(), f"schema [{f}]: None is not of the required type") for f in FIELDS if f != "bbox"]
    found += [(~F.col(f).isin(*values), F.concat(F.lit(f"schema [{f}]: "), _quoted(F.col(f)), F.lit(" is not an allowed value"))) for f, values in ENUMS.items()]
    found += [(~F.col("id").rlike(ID_PATTERN), F.concat(F.lit("schema [id]: "), _quoted(F.col("id")), F.lit(" does not match the pattern")))]
    found += [(F.col(f) == "", f"schema [{f}]: '' is too short") for f in TEXTS]
    n = F.when(F.col("image_path").isNotNull(), F.size("image_path"))
    found += [(n == 0, "schema [image_path]: [] is too short"), (n > 2, "schema [image_path]: too long"), (F.exists("image_path", lambda p: F.coalesce(p, F.lit("")) == ""), "schema [image_path]: '' is too short")]
    found += [(F.exists("bbox", lambda b: b.isNull() | (F.size(b) != 4)), "schema [bbox]: a box is not 4 numbers")]
    return _collect(*found)


def cross_field_errors() -> Column:
    task, pair, box = F.col("task"), F.col("pair_type"), F.col("bbox")
    n = F.when(F.col("image_path").isNotNull(), F.size("image_path"))
    got = F.concat(F.lit(", got "), n.cast("string"))
    got_pair = F.concat(F.lit(", got pair_type='"), pair, F.lit("'"))
    found = [
        ((pair == "single") & (n != 1), F.concat(F.lit("pair_type='single' requires exactly 1 image"), got)),
        (pair.isin("bitemporal", "cross-modal") & (n != 2), F.concat(F.lit("pair_type='"), pair, F.lit("' requires exactly 2 images"), got)),
        (task.isin(*GROUNDING_TASKS) & (box.isNull() | (F.size(box) == 0)), F.concat(F.lit("task='"), task, F.lit("' requires a non-empty bbox list, got "), F.when(box.isNull(), "None").otherwise("[]"))),
        (task.isin(*ANSWER_TASKS) & box.isNotNull(), F.concat(F.lit("task='"), task, F.lit("' requires null bbox, got non-null"))),
    ]
    for name, kind in (("change_grounding", "bitemporal"), ("fusion_grounding", "cross-modal")):
        found += [
            ((task == name) & (pair != kind), F.concat(F.lit(f"task='{name}' requires pair_type='{kind}'"), got_pair)),
            ((task == name) & (n != 2), F.concat(F.lit(f"task='{name}' requires 2 images"), got)),
        ]
    found.append(((pair == "cross-modal") & (F.col("modality") != "optical+sar"), F.concat(F.lit("pair_type='cross-modal' requires modality='optical+sar', got modality='"), F.col("modality"), F.lit("'"))))
    return _collect(*found)


def errors() -> Column:
    """All messages of the first stage that finds any."""
    first, second = schema_errors(), F.coalesce(coordinate_errors(F.col("bbox")), F.array().cast("array<string>"))
    return F.when(F.size(first) > 0, first).when(F.size(second) > 0, second).otherwise(cross_field_errors())


def with_errors(samples: DataFrame) -> DataFrame:
    return samples.withColumn("errors", errors())


def split_valid(samples: DataFrame, tier: str) -> tuple[DataFrame, DataFrame]:
    """Valid samples, and (id, tier, errors) of the others; a missing id is ``?``."""
    judged = with_errors(samples)
    bad = judged.filter(F.size("errors") > 0).select(F.coalesce("id", F.lit("?")).alias("id"), F.lit(tier).alias("tier"), "errors")
    return judged.filter(F.size("errors") == 0).drop("errors"), bad


def preview(messages: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first n messages and the number of all (a top-k report)."""
    return messages.orderBy(*order).limit(n).withColumn("total", F.lit(messages.count()))


def lines(texts: DataFrame) -> DataFrame:
    """line_no, line and the errors of JSON lines; blank lines are left out.

    Types are judged on the raw JSON: a variant tells a number from a text and a missing key from a null.
    """
    rows = texts.filter(F.trim(F.regexp_replace("line", r"\s+", " ")) != "").withColumn("v", F.try_parse_json("line"))
    # the keys are a column of their own: within the conditions the line would be parsed for each of them
    rows = rows.withColumn("keys", F.json_object_keys("line"))
    typed = F.from_json("line", SAMPLE)
    kind = lambda f: F.schema_of_variant(F.variant_get("v", f"$.{f}", "variant"))
    keys = F.col("keys")
    wrong = [F.when(~F.array_contains(keys, f), F.lit(f"schema [<root>]: '{f}' is a required property")) for f in FIELDS]
    wrong += [F.when(F.array_contains(keys, f) & (kind(f) != "STRING"), F.lit(f"schema [{f}]: not of type 'string'")) for f in FIELDS if f not in ("image_path", "bbox")]
    wrong += [F.when(F.array_contains(keys, "image_path") & (~kind("image_path").isin("ARRAY<STRING>", "ARRAY<VOID>")), F.lit("schema [image_path]: not an array of strings"))]
    # an array of arrays of numbers, empty or null
    numbers = kind("bbox").rlike(r"^(VOID|ARRAY<VOID>|ARRAY<ARRAY<(VOID|BIGINT|DOUBLE|DECIMAL\(\d+,\s*\d+\))>>)$")
    wrong += [F.when(F.array_contains(keys, "bbox") & ~numbers, F.lit("schema [bbox]: not null and not an array of boxes"))]
    extra = F.array_except(keys, F.array(*[F.lit(f) for f in FIELDS]))
    wrong += [F.when(F.size(extra) > 0, F.concat(F.lit("schema [<root>]: additional properties: "), F.array_join(F.array_sort(extra), ", ")))]
    told = rows.withColumn("raw", F.array_compact(F.array(*wrong))).withColumn("s", typed)
    told = told.select("line_no", "line", "v", "raw", *[F.col(f"s.{f}").alias(f) for f in FIELDS])
    told = told.withColumn("errors", F.when(F.col("v").isNull(), F.array(F.lit("JSON parse error"))).when(F.size("raw") > 0, F.col("raw")).otherwise(errors()))
    return told.select("line_no", "line", "errors")


def line_messages(judged: DataFrame) -> DataFrame:
    """One row per message, with its ``line N:`` prefix."""
    return judged.select("line_no", F.explode("errors").alias("e")).select("line_no", F.concat(F.lit("line "), F.col("line_no").cast("string"), F.lit(": "), F.col("e")).alias("message"))

"""Structural checks of source folders: counts of files per kind, then rules over the counts."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import TAGS, task_tag
from ..sources import readers


class StructureError(ValueError):
    """A source folder lacks what its recipe needs."""


@dataclasses.dataclass(frozen=True)
class Kind:
    """A kind of files: a pattern over paths below the root; how many are needed (0: none), and how many are expected."""

    name: str
    pattern: str
    least: int = 0
    expected: int = 0
    distinct: str = ""


#: Needs in one group (same ``any_of`` name) hold if one of them holds.
CHECKS: dict[str, tuple[tuple[Kind, str], ...]] = {
    "oscd": ((Kind("locations", r"/images/([^/]+)/", 1, 24, r"/images/([^/]+)/"), ""), (Kind("imgs_1", r"/imgs_1/", 1, 0, r"/images/([^/]+)/"), ""), (Kind("imgs_2", r"/imgs_2/", 1, 0, r"/images/([^/]+)/"), ""), (Kind("label_dirs", r"/labels/", 0, 0, r"/labels/([^/]+)/"), "")),
    "vrsbench": ((Kind("annotations", r"/VRSBench_train\.json$", 1), ""), (Kind("zips", r"/Images_(train|val)\.zip$", 1), "")),
    "bigearthnet": ((Kind("metadata", r"/metadata\.parquet(/|$)", 1), "meta"), (Kind("h5", r"\.(h5|hdf5)$", 1), "meta"), (Kind("arrays", r"/s2_npy/[^/]*\.npy$"), "")),
    "rsvqa_hr": ((Kind("questions", r"/(train|val|test)\.json$", 1), ""), (Kind("images", r"/images/[^/]*\.(png|jpg)$", 1), "")),
    "cdvqa": ((Kind("questions", r"/(train|val)\.json$", 1), ""), (Kind("test", r"/test\.json$"), "")),
    "levir_cd": ((Kind("train_before", r"/train/A/[^/]*\.png$", 1), ""), (Kind("train_after", r"/train/B/[^/]*\.png$"), ""), (Kind("labels", r"/label/[^/]*\.png$"), "")),
    "spacenet6": ((Kind("images", r"/train/images/[^/]*\.tif$", 1), ""), (Kind("labels", r"/train/labels/[^/]*\.geojson$"), ""), (Kind("sar", r"/train/sar/[^/]*\.tif$"), "")),
    "sardet": ((Kind("images", r"/images/[^/]*\.(png|jpg)$", 1), ""), (Kind("labels", r"/labels/[^/]*\.txt$"), "")),
    "sen2lulc": ((Kind("metadata", r"/(metadata\.csv|annotations\.json)$", 1), ""), (Kind("images", r"/images/[^/]*\.png$", 1), "")),
}
ALIASES = {"bigen": "bigearthnet", "sn6_opt": "spacenet6", "sn6_sar": "spacenet6"}


def counts(files: DataFrame, kinds: tuple[tuple[Kind, str], ...]) -> DataFrame:
    """One row with the count of each kind; distinct folders where a kind asks for them."""
    sums = [F.count_if(F.col("path").rlike(k.pattern)).alias(k.name) if not k.distinct else F.count_distinct(F.when(F.col("path").rlike(k.pattern), F.regexp_extract("path", k.distinct, 1))).alias(k.name) for k, _ in kinds]
    return files.agg(*sums)


def judge(files: DataFrame, name: str) -> DataFrame:
    """kind, count, needed, expected, status (ok, warn or missing) of a listing."""
    kinds = CHECKS[ALIASES.get(name, name)]
    rows = F.array(*[F.struct(F.lit(k.name).alias("kind"), F.col(k.name).alias("count"), F.lit(k.least).alias("needed"), F.lit(k.expected).alias("expected"), F.lit(group).alias("any_of")) for k, group in kinds])
    status = F.when(F.col("count") < F.col("needed"), "missing").when(F.col("count") < F.col("expected"), "warn").otherwise("ok")
    return counts(files, kinds).select(F.explode(rows).alias("r")).select("r.*").withColumn("status", status)


def contents(spark: SparkSession, name: str, root: str) -> list[tuple[str, int, int]]:
    """(kind, count, needed) of what a source's own tables hold: rows, and rows of a kind."""
    there = lambda f: readers.exists(spark, f"{root}/{f}")
    out: list[tuple[str, int, int]] = []
    if name == "oscd" and there("images"):
        files = readers.listing(spark, f"{root}/images", recursive=True)
        out.append(("complete_pairs", readers.location_pairs(files).count(), 1))
    if name == "vrsbench" and there("VRSBench_train.json"):
        said = readers.conversations(spark, root).select(F.col("conversations")[0]["value"].alias("v"))
        n, *tasks = said.agg(F.count(F.lit(1)), *[F.count_if(task_tag(F.col("v")) == t) for t in TAGS]).first()
        out += [("entries", n, 1), *((f"entries_{t}", k, 0) for t, k in zip(TAGS, tasks, strict=True))]
    if name == "bigearthnet" and there("metadata.parquet"):
        table = spark.read.parquet(f"{root}/metadata.parquet")
        out.append(("patches", table.count(), 1))
        if "country" in table.columns:
            out.append(("countries", table.select("country").distinct().count(), 0))
        if there("s2_npy"):
            out.append(("arrays_of_patches", readers.listing(spark, f"{root}/s2_npy", "*.npy").count(), 1))
    for split in {"rsvqa_hr": ("train", "val", "test"), "cdvqa": ("train", "val")}.get(name, ()):
        if there(f"{split}.json"):
            out.append((f"{split}_questions", readers.json_array(spark, f"{root}/{split}.json", readers.QUESTION, ("questions",)).count(), 0))
    return out


def run(spark: SparkSession, name: str, root: str) -> list[dict]:
    """The rows of a folder's check; StructureError if a need isn't met, ValueError for an unknown name."""
    if ALIASES.get(name, name) not in CHECKS:
        raise ValueError(f"unknown source {name!r}")
    rows = [r.asDict() for r in judge(readers.listing(spark, root, recursive=True), name).collect()]
    groups: dict[str, list[dict]] = {}
    for r in rows:
        groups.setdefault(r["any_of"] or r["kind"], []).append(r)
    for g in groups.values():
        if all(r["status"] == "missing" for r in g):
            raise StructureError(f"{name}: no {' or '.join(r['kind'] for r in g)} under {root}")
    for kind, count, needed in contents(spark, ALIASES.get(name, name), root):
        if count < needed:
            raise StructureError(f"{name}: no {kind} under {root}")
        rows.append({"kind": kind, "count": count, "needed": needed, "expected": 0, "any_of": "", "status": "ok"})
    return rows


def run_all(spark: SparkSession, roots: dict[str, str]) -> dict[str, str]:
    """pass, a failure's text, or skipped (folder missing) per source."""
    out = {}
    for name, root in roots.items():
        if not readers.exists(spark, root):
            out[name] = "skipped"
            continue
        try:
            run(spark, name, root)
            out[name] = "pass"
        except StructureError as e:
            out[name] = str(e)
    return out

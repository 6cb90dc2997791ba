"""Training feed and comparison: union of split files, curriculum mix, replay."""

from __future__ import annotations

import dataclasses
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.gsd import is_proxy
from ..operators import corpus, sampling


@dataclasses.dataclass
class Model:
    base: str = ""
    load_in_4bit: bool = True


@dataclasses.dataclass
class Lora:
    r: int = 16
    alpha: int = 32
    dropout: float = 0.05
    use_dora: bool = True


@dataclasses.dataclass
class Training:
    learning_rate: float = 2e-4
    max_steps: int = 1000
    batch_size: int = 2
    seed: int = 42

    def __post_init__(self):
        self.learning_rate = float(self.learning_rate)  # a YAML number without a dot is a text


@dataclasses.dataclass
class Curriculum:
    ratios: list[float] = dataclasses.field(default_factory=lambda: [1.0])


SECTIONS = {"model": Model, "lora": Lora, "training": Training, "curriculum": Curriculum}


def load_config(path: str, sections: dict[str, Any] = SECTIONS) -> dict[str, Any]:
    """Sections of a YAML file as dataclasses; an unknown key raises TypeError."""
    import yaml

    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f) or {}
    return {name: kind(**(raw.get(name) or {})) for name, kind in sections.items()}


def training_rows(corpus_rows: DataFrame, max_samples: int | None = None, replay: DataFrame | None = None, fraction: float = 0.0, seed: int = 42) -> DataFrame:
    """Rows of all files but those of internal validation (column stem), the first max_samples, and replay rows after them."""
    files = corpus_rows.select(F.lit("").alias("tier"), "stem").distinct()
    used = corpus.source_files(files).filter(~F.col("stem").contains("_val_internal")).select("stem")
    rows = sampling.head(corpus_rows.join(F.broadcast(used), "stem", "left_semi"), ["stem", "line_no"], max_samples)
    if replay is None or fraction <= 0:
        return rows
    return rows.unionByName(sampling.replay(replay, "id", fraction, rows.count(), seed), allowMissingColumns=True)


def deal_to_steps(rows: DataFrame, key: str, max_steps: int, batch: int, ratios: list[float], seed: int = 42, bucket: str = "gsd_bucket") -> DataFrame:
    """step, slot (from 0 over all steps), epoch, key and proxy: which row is read where in a curriculum.

    Each step has ``batch`` slots, of which the share of native rows is that of its step. Shares are added up slot by slot in millionths,
    and a slot is native where the sum passes a whole number: in every stretch of slots of one ratio the native rows are within one of
    their share. Rows come in the order of a hash of (key, seed), native ones and proxies apart, and again from the first when they are
    used up. Places in that order are offsets of range partitions, so no task numbers all rows. Without native rows or without proxies all
    slots are of the others; without rows there are none.
    """
    marked = rows.select(F.col(key).alias("key"), is_proxy(F.col(bucket)).alias("proxy")).withColumn("h", sampling.order_hash(F.col("key"), seed))
    ranked = corpus.shard_assign(marked, ["proxy", "h", "key"], 1).select("key", "proxy", F.col("shard").alias("place"))
    counts = {r.proxy: r.n for r in marked.groupBy("proxy").agg(F.count(F.lit(1)).alias("n")).collect()}
    native, proxies = counts.get(False, 0), counts.get(True, 0)
    slots = rows.sparkSession.range(max_steps * batch if native + proxies else 0).select(F.col("id").alias("slot"), F.floor(F.col("id") / batch).cast("long").alias("step"))
    # the steps at which the ratio changes, and what is added up until then
    share = [1.0 if not proxies else 0.0 if not native else ratios[min(len(ratios) - 1, 0 if s / max_steps < 0.33 else 1 if s / max_steps < 0.66 else 2)] for s in range(max_steps)]
    starts = [s for s in range(max_steps) if s == 0 or share[s] != share[s - 1]]
    upto, total, last = F.lit(0).cast("long"), 0, None
    for s in starts:
        if last is not None:
            total += (s - last) * batch * round(share[last] * 1_000_000)
        upto = F.when(F.col("step") >= s, F.lit(total) + (F.col("slot") - s * batch) * round(share[s] * 1_000_000)).otherwise(upto)
        last = s
    step_share = F.lit(0).cast("long")
    for s in starts:
        step_share = F.when(F.col("step") >= s, F.lit(round(share[s] * 1_000_000)).cast("long")).otherwise(step_share)
    slots = slots.withColumn("before", F.floor(upto / 1_000_000)).withColumn("after", F.floor((upto + step_share) / 1_000_000)).withColumn("proxy", F.col("before") == F.col("after"))
    rank = F.when(F.col("proxy"), F.col("slot") - F.col("before")).otherwise(F.col("before"))
    size = F.when(F.col("proxy"), F.lit(max(proxies, 1))).otherwise(F.lit(max(native, 1))).cast("long")
    wanted = slots.select("step", "slot", "proxy", F.floor(rank / size).alias("epoch"), (rank % size + F.when(F.col("proxy"), F.lit(native)).otherwise(0)).alias("place"))
    return wanted.join(ranked, ["proxy", "place"]).select("step", "slot", "epoch", "key", "proxy")


def compare(results: DataFrame) -> DataFrame:
    """Winners of two adapters (rows a = dora and qlora, as columns of one row); ties go to qlora, losses count only if both are measured."""
    best = lambda c: F.when(c, "dora").otherwise("qlora")
    wide = results.groupBy().pivot("name", ["dora", "qlora"]).agg(F.first("steps_per_sec").alias("speed"), F.first("memory_mb").alias("memory"), F.first("final_loss").alias("loss"), F.first("loss_is_real").alias("real"))
    real = F.col("dora_real") & F.col("qlora_real")
    won = wide.select(best(F.col("dora_speed") > F.col("qlora_speed")).alias("speed"), best(F.col("dora_memory") < F.col("qlora_memory")).alias("memory"), F.when(real, best(F.col("dora_loss") < F.col("qlora_loss"))).otherwise("unmeasured").alias("loss"))
    wins = sum((F.when(F.col(c) == "dora", 1).otherwise(0) for c in ("speed", "memory", "loss")), F.lit(0))
    return won.withColumn("recommendation", F.when(F.col("loss") == "unmeasured", "inconclusive").when(wins >= 2, "use_dora").otherwise("use_qlora"))

"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades 0..G are ordered; P(grade > k) = sigmoid(w x - theta_k) with one weight vector w for all thresholds
theta_0 <= theta_1 <= .... Features are the distinct words of the whole text, hashed to ``CELLS`` cells; x is their
mean over those with a weight, so that many words of one grade don't add up to the next. The output is the
expected severity, the sum of P(grade > k), and whether P(grade > 0) reaches one half.

The model is fitted on the driver by Adam on at most about ``most_rows`` labelled documents, and of these on at most about
``most_chars`` characters of text, chosen by hashes of their ids: a documented bound on the sample, in rows and in bytes. Only cells whose documents' grades differ from the rest's get a weight: for some threshold, the
exact binomial tail of the number above it must be below ``chance`` divided by the number of cells that are tested. Tested are
cells of so many documents that they could pass at all (chosen by document counts alone), so few labels still teach clear words,
and chance words of single documents stay out at any base rate.

Edge cases
    Null text has no features and gets the base rate. Labels of documents that don't exist, or with a null grade, are ignored; of
    several labels of a document the highest holds. Without labels, severity is null and nothing is toxic. A tie, P(grade > 0) of
    exactly one half, is toxic. Repeated rows are scored each (and learned from each, if labelled). Very long texts are read whole.
    An empty table gives an empty result. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, map_arrow, ship, sliced

ship(__name__)

CELLS = 1 << 20
WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> list[int]:
    return list({xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) % CELLS for w in set(WORD.findall((text or "").lower()))})


def differing(df: np.ndarray, hits: np.ndarray, base: float, chance: float) -> np.ndarray:
    """Which cells' hits of df documents have a binomial tail (either side) below ``chance``, by Bonferroni over the tested cells."""
    sizes, where = np.unique(df, return_inverse=True)
    tested = np.cumsum(np.bincount(where)[::-1])[::-1]
    # the smallest document count, two at least, at which a cell of one kind only could pass beside all larger cells
    can = (sizes > 1) & (sizes * np.log(min(base, 1 - base)) <= np.log(chance / 2 / tested))
    out = np.zeros(len(df), bool)
    if not can.any():
        return out
    first = int(np.argmax(can))
    level = chance / 2 / tested[first]
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, sizes[-1] + 1)))])
    order = np.argsort(where, kind="stable")
    ends = np.cumsum(np.bincount(where))
    for s in range(first, len(sizes)):
        n, cells = int(sizes[s]), order[ends[s - 1] if s else 0 : ends[s]]
        j = np.arange(n + 1)
        p = np.exp(log_fact[n] - log_fact[: n + 1] - log_fact[n::-1] + j * np.log(base) + (n - j) * np.log(1 - base))
        out[cells] = np.minimum(np.cumsum(p), np.cumsum(p[::-1])[::-1])[hits[cells]] <= level
    return out


def fit(rows: list[np.ndarray], grades: np.ndarray, levels: int, steps: int = 800, l2: float = 1e-6, chance: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights over CELLS and thresholds (ascending) of a cumulative-link model."""
    idx = np.concatenate(rows) if rows else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    df = np.bincount(idx, minlength=CELLS)
    above = grades[:, None] > np.arange(levels)[None, :]
    base = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    telling = np.zeros(CELLS, bool)
    for k in range(levels):
        telling |= differing(df, np.bincount(idx, above[row, k], CELLS).astype(np.int64), base[k], chance)
    use = telling[idx]
    cells, idx = np.unique(idx[use], return_inverse=True)
    row = row[use]
    theta = -np.log(base / (1 - base))
    share = 1 / np.maximum(np.bincount(row, minlength=len(rows)), 1)
    # theta as its first value and the logs of the gaps, so that the order can't be lost
    par = np.concatenate([np.zeros(len(cells)), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    n, d = max(len(rows), 1), len(cells)
    for t in range(1, steps + 1):
        gaps = np.exp(par[d + 1 :])
        theta = par[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(row, par[idx], len(rows)) * share
        # grade probabilities are differences of neighbouring cumulative ones
        cum = np.column_stack([np.ones(n), 1 / (1 + np.exp(-(z[:, None] - theta))), np.zeros(n)])
        slope = cum * (1 - cum)
        at = np.arange(len(rows))
        p = np.maximum(cum[at, grades] - cum[at, grades + 1], 1e-9)
        gz = -(slope[at, grades] - slope[at, grades + 1]) / p / n
        gt = np.zeros(levels)
        np.add.at(gt, np.maximum(grades - 1, 0), np.where(grades > 0, slope[at, grades] / p / n, 0))
        np.add.at(gt, np.minimum(grades, levels - 1), np.where(grades < levels, -slope[at, grades + 1] / p / n, 0))
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([np.bincount(idx, (gz * share)[row], d) + l2 * par[:d], [gt.sum()], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights = np.zeros(CELLS, np.float32)
    weights[cells] = par[:d]
    return weights, par[d] + np.concatenate([[0.0], np.cumsum(np.exp(par[d + 1 :]))])


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = 16_000, most_chars: int = 100_000_000) -> tuple[np.ndarray, np.ndarray] | None:
    """The model for labels (doc_id, grade); None if there is nothing to learn from."""
    known = labels.select("doc_id", "grade").filter("doc_id IS NOT NULL AND grade IS NOT NULL")
    if not (total := known.count()):
        return None
    part = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1_000_000.0 * most_rows / total)).groupBy("doc_id").agg(F.max("grade").cast("long").alias("grade"))
    sample = docs.select("doc_id", "text").join(bounded_broadcast(part, 2 * most_rows), "doc_id")
    chars = sample.agg(F.sum(F.length("text"))).first()[0] or 0
    if chars > most_chars:
        sample = sample.filter(F.pmod(F.xxhash64("doc_id", F.lit("chars")), F.lit(1_000_000)) < F.lit(1_000_000.0 * most_chars / chars))
    sample = sample.select("text", "grade")

    def run(batches):
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays([pa.array([features(t) for t in b.column("text").to_pylist()], pa.list_(pa.int32())), b.column("grade")], names=["cells", "grade"])

    got = map_arrow(sample, run, "cells array<int>, grade long").toArrow()
    if not got.num_rows:
        return None
    rows = [x.values.to_numpy() for x in got.column("cells")]
    grades = got.column("grade").to_numpy()
    return fit([r.astype(np.int64) for r in rows], grades, max(int(grades.max()), 1))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, severity (expected grade), p_toxic, toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for b in sliced(batches):
            texts = b.column("text").to_pylist()
            if model is None:
                sev = p = [None] * len(texts)
                toxic = [False] * len(texts)
            else:
                z = np.array([float(w.sum()) / max(np.count_nonzero(w), 1) for w in (model[0][features(t)] for t in texts)])
                cum = 1 / (1 + np.exp(-(z[:, None] - model[1])))
                sev, p = cum.sum(axis=1), cum[:, 0]
                toxic = p >= 0.5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sev, pa.float64()), pa.array(p, pa.float64()), pa.array(toxic, pa.bool_())], names=["doc_id", "severity", "p_toxic", "toxic"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, severity double, p_toxic double, toxic boolean")

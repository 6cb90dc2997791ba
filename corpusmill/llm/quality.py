"""Quality rules: robust multivariate outliers.

Each text gets a vector of transformed statistics. For every (language, source) the minimum covariance
determinant estimates location and scatter of the bulk; a text whose Mahalanobis distance from its group is
too large is rejected. Two plain base rules come first (too few words, too much repetition).

How the estimate is distributed
    Vectors are fixed-point integers, so sums are exact and do not depend on the order of rows. Equal texts of a
    group count once (by a 64-bit digest): thousands of copies of one text can't pose as the bulk, and a hot group
    shrinks in the map-side aggregate. A concentration step bins all squared distances of a group on a fine logarithmic
    grid and sums counts and moments per bin; the bins up to the one that reaches h rows are the next subset.
    No rows of a group ever meet in one task: estimates are broadcast to the rows (behind a count of the groups; beyond it
    each group's rows are dealt to several tasks). Steps start from the classical moments and from medians with
    quartile scales; the smaller determinant wins, and one reweighting step follows.

Small groups
    Every (language, source) has an estimate of its own. It is shrunk towards its language's, and that towards that of all
    texts, as if the latter had been seen in ``PRIOR`` texts: location and scatter are averages weighted by n and PRIOR.
    There is no group size at which the rule changes; in groups of thousands the prior weighs nothing.

Edge cases
    Null or empty text: no words, hence base_failed. Null lang or source is a group of its own. A text alone in its group is
    judged by its language's scatter, mostly from its language's location. Equal texts (ties, repeated rows) count once for
    an estimate, and each row gets its own result. Very long texts are read whole, one at a time. An empty table gives an
    empty result. Further columns are ignored by ``judge`` and passed through by ``keep``, whatever their names.
"""

from __future__ import annotations

import math
import re
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import few_rows, join_dimension, map_arrow, materialise, release, ship, sliced

ship(__name__)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"
#: Fixed-point units per 1.0 of a feature.
UNIT = 1024
#: Smallest standard deviation of each feature that counts as a difference, in feature units.
FLOORS = (0.08, 0.15, 0.10, 0.08)
P = len(FLOORS)
#: Groups whose estimates are broadcast at most (some 300 bytes each, 15 MB); more are joined by a shuffle.
BROADCAST_GROUPS = 50_000
#: Texts that a group's prior, the estimate of the level above, is worth.
PRIOR = 20
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
X = [f"x{i}" for i in range(P)]
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_stats(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, the features in fixed point, and the text's digest."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            lines += 1
            if line in seen:
                dups += 1
            seen.add(line)
    grams = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(grams)) < len(grams):
        once: set = set()
        twice = {g for g in grams if g in once or once.add(g)}
        end = 0  # windows come in order: count each covered word once
        for k, g in enumerate(grams):
            if g in twice:
                repeated += k + 3 - max(k, end)
                end = k + 3
    m = max(n, 1)
    features = (math.log(max(chars, 1) / m), math.asinh(10 * symbols / m), dups / max(lines, 1), repeated / m)
    digest = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63
    return (n, chars, symbols, dups, repeated, *(round(f * UNIT) for f in features), digest)


def with_stats(df: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``df`` and the statistics of its column text."""
    names = [*STATS, *X, "digest"]
    out = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in names)])

    def run(batches):
        for b in sliced(batches):
            rows = [text_stats(t) for t in b.column("text").to_pylist()]
            cols = np.array(rows, dtype=np.int64).reshape(len(rows), len(names))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(cols[:, i]) for i in range(len(names)))], names=[*keep, *names])

    src = df.select(*dict.fromkeys([*keep, "text"]))
    return map_arrow(src, run, out)


def chi2_quantile(q: float, df: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty's approximation)."""
    z = NormalDist().inv_cdf(q)
    return df * (1 - 2 / (9 * df) + z * math.sqrt(2 / (9 * df))) ** 3


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _key(level: int) -> Column:
    """Group key: 0 language and source, 1 language, 2 all. Null differs from any string."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    return F.concat_ws("\x1f", F.lit(str(level)), *[part(c) for c in ("lang", "source")[: 2 - level]])


def _moments() -> list[Column]:
    """Exact sums over rows: count, x_i, x_i x_j."""
    return [F.count(F.lit(1)).alias("n"), F.array(*[F.sum(x) for x in X]).alias("s1"), F.array(*[F.sum(F.col(X[i]) * F.col(X[j])) for i, j in PAIRS]).alias("s2")]


DOUBLES = T.ArrayType(T.DoubleType())


def _invert(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """Inverse and log determinant of a scatter; a spread below the floor is not believed, the diagonal is lifted up to it."""
    floor = np.diag((np.array(FLOORS) * UNIT) ** 2)
    cov = cov + np.diag(np.maximum(np.diag(floor) - np.diag(cov), 0)) + floor * 1e-3
    return np.linalg.inv(cov), float(np.linalg.slogdet(cov)[1])


def _solve(moments: DataFrame, keys: list[str], consistency: float) -> DataFrame:
    """n, location, scatter, and with bounds from below the inverse scatter and log determinant, of each row of sums."""
    names = ["mu", "cov", "inv", "logdet"]
    out = T.StructType([*[moments.schema[k] for k in keys], T.StructField("n", T.LongType()), *[T.StructField(c, DOUBLES) for c in names[:3]], T.StructField("logdet", T.DoubleType())])

    def run(batches):
        for b in batches:
            rows = []
            for n, s1, s2 in zip(*(b.column(c).to_pylist() for c in ("n", "s1", "s2")), strict=True):
                mu = np.array(s1, float) / n
                cov = np.zeros((P, P))
                for (i, j), v in zip(PAIRS, s2, strict=True):
                    cov[i, j] = cov[j, i] = v / n - mu[i] * mu[j]
                cov = cov * consistency
                inv, logdet = _invert(cov)
                rows.append((mu.tolist(), cov.ravel().tolist(), inv.ravel().tolist(), logdet))
            cols = list(zip(*rows)) or [[]] * 4
            kinds = [pa.list_(pa.float64())] * 3 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in (*keys, "n")), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=[*keys, "n", *names])

    return map_arrow(moments.select(*keys, "n", "s1", "s2"), run, out)


def shrunk(chain: list[tuple[int, np.ndarray, np.ndarray]], prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray]:
    """Location and inverse scatter of the first of a chain of estimates (n, mu, cov), each shrunk towards the next."""
    _, mu, cov = chain[-1]
    for n, m, c in chain[-2::-1]:
        share = n / (n + prior)
        mu, cov = share * m + (1 - share) * mu, share * c + (1 - share) * cov
    return mu, _invert(cov)[0]


def _shrink(chains: DataFrame) -> DataFrame:
    """g, mu, inv for rows of g and levels: an array of (level, n, mu, cov)."""
    out = T.StructType([T.StructField("g", T.StringType()), T.StructField("mu", DOUBLES), T.StructField("inv", DOUBLES)])

    def run(batches):
        for b in batches:
            mus, invs = [], []
            for chain in b.column("levels").to_pylist():
                mu, inv = shrunk([(x["n"], np.array(x["mu"]), np.array(x["cov"]).reshape(P, P)) for x in chain])
                mus.append(mu.tolist())
                invs.append(inv.ravel().tolist())
            yield pa.RecordBatch.from_arrays([b.column("g"), pa.array(mus, pa.list_(pa.float64())), pa.array(invs, pa.list_(pa.float64()))], names=["g", "mu", "inv"])

    return map_arrow(chains, run, out)


def _d2() -> Column:
    """Squared Mahalanobis distance of x0.. from mu under inv."""
    diff = [F.col(X[i]) - F.get("mu", F.lit(i)) for i in range(P)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + diff[i] * diff[j] * F.get("inv", F.lit(i * P + j)) * (1.0 if i == j else 2.0)
    return total


def _concentrate(vectors: DataFrame, params: DataFrame, sizes: DataFrame, few: bool, h: float, consistency: float) -> DataFrame:
    """One C-step for all groups and starts: the h share of vectors nearest to the estimate gives the next one."""
    binned = (
        join_dimension(vectors, params.select("g", "start", "mu", "inv"), "g", few)
        .withColumn("bin", F.least(F.lit(2047), F.floor(F.log2(1 + _d2()) * 64)).cast("int"))
        .groupBy("g", "start", "bin")
        .agg(*_moments())
    )
    before = Window.partitionBy("g", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = binned.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = join_dimension(placed, sizes, "g", few).filter(F.col("before") < F.ceil(F.col("size") * h))
    sums = inside.groupBy("g", "start").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.get("s1", F.lit(i))) for i in range(P)]).alias("s1"),
        F.array(*[F.sum(F.get("s2", F.lit(k))) for k in range(len(PAIRS))]).alias("s2"),
    )
    return _solve(sums, ["g", "start"], consistency)


def estimate(stats: DataFrame, h: float = 0.6, steps: int = 3) -> DataFrame:
    """Columns g (language and source), mu, inv: the estimate that each (language, source) is judged by."""
    vectors = stats.filter(~base_failed()).groupBy("lang", "source", "digest", *X).agg(F.lit(1).alias("one")).drop("one", "digest")
    levels = F.array(*[F.struct(F.lit(k).alias("level"), _key(k).alias("g")) for k in range(3)])
    groups = vectors.select("lang", "source").distinct().select(_key(0).alias("own"), F.explode(levels).alias("l")).select("own", "l.*")
    vectors = materialise(vectors.select(F.explode(F.array(_key(0), _key(1), _key(2))).alias("g"), *X))
    totals = materialise(vectors.groupBy("g").agg(*_moments(), *[F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, x in enumerate(X)]))
    few = few_rows(totals, BROADCAST_GROUPS)
    sizes = totals.select("g", F.col("n").alias("size"))
    classical = _solve(totals.withColumn("start", F.lit(0)), ["g", "start"], 1.0).select("g", "start", "mu", "inv")
    scale = [F.greatest(F.lit(FLOORS[i] * UNIT), (F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0))) / 1.349) for i in range(P)]
    median = totals.select(
        "g",
        F.lit(1).alias("start"),
        F.array(*[F.get(f"q{i}", F.lit(1)) for i in range(P)]).alias("mu"),
        F.array(*[(1 / (scale[i] * scale[i])) if i == j else F.lit(0.0) for i in range(P) for j in range(P)]).alias("inv"),
    )
    params = classical.unionByName(median)
    # variance of a normal sample cut at the h quantile of its distances, and at the 0.975 one
    cut = lambda q: q / _chi2_cdf(chi2_quantile(q, P), P + 2)
    for _ in range(steps):
        params = materialise(_concentrate(vectors, params, sizes, few, h, cut(h)))
    best = params.groupBy("g").agg(F.min_by(F.struct("mu", "inv"), F.struct("logdet", "start")).alias("b")).select("g", "b.mu", "b.inv")
    near = join_dimension(vectors, best, "g", few).filter(_d2() <= chi2_quantile(0.975, P)).groupBy("g").agg(*_moments())
    final = _solve(near, ["g"], cut(0.975)).select("g", "n", "mu", "cov")
    release(stats.sparkSession)
    chains = join_dimension(groups, final, "g", few).groupBy(F.col("own").alias("g")).agg(F.array_sort(F.collect_list(F.struct("level", "n", "mu", "cov"))).alias("levels"))
    return materialise(_shrink(chains))


def _chi2_cdf(x: float, df: int) -> float:
    """Distribution function of chi-square for an even number of degrees of freedom."""
    term = total = 1.0
    for k in range(1, df // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def verdicts(stats: DataFrame, params: DataFrame, tail: float = 1e-6) -> DataFrame:
    """Adds base_failed, distance2 and kept to a frame with lang, source and statistics."""
    cutoff = chi2_quantile(1 - tail, P)
    return (
        join_dimension(stats.withColumn("g", _key(0)), params, "g", few_rows(params, BROADCAST_GROUPS), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("distance2", _d2())
        .withColumn("kept", ~F.col("base_failed") & (F.col("mu").isNull() | (F.col("distance2") <= cutoff)))
        .drop("g", "mu", "inv")
    )


def judge(docs: DataFrame, tail: float = 1e-6, h: float = 0.6) -> DataFrame:
    """One row per row of docs (doc_id, text, lang, source): statistics, base_failed, distance2, kept."""
    stats = materialise(with_stats(docs, ["doc_id", "lang", "source"]))
    return verdicts(stats, estimate(stats, h=h), tail).select("doc_id", *STATS, "base_failed", "kept", "distance2")


def keep(docs: DataFrame, tail: float = 1e-6, h: float = 0.6) -> DataFrame:
    """The rows of docs that pass, with all their columns. Texts are scanned twice and never shuffled."""
    stats = materialise(with_stats(docs.select("text", "lang", "source"), ["lang", "source"]))
    params = estimate(stats, h=h)
    # other columns travel inside a struct, where their names can't clash with ours
    own = ["text", "lang", "source"]
    others = F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in own])
    packed = docs.select(*own, others.alias("row"))
    judged = verdicts(with_stats(packed, [*own, "row"]), params, tail).filter("kept")
    return judged.select(*[c if c in own else F.col(f"row.`{c}`") for c in docs.columns])

"""Exact quantiles by histograms of ranges, and mergeable sketches, against sorting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import quantiles, stats

SHARES = [0.0, 0.02, 0.1, 0.25, 0.5, 0.9, 0.98, 1.0]


def brute(values):
    v = sorted(values, key=lambda x: (x != x, x))
    out = []
    for s in SHARES:
        p = s * (len(v) - 1)
        lo, hi = v[int(np.floor(p))], v[int(np.ceil(p))]
        out.append(lo if lo == hi or lo != lo else lo + (hi - lo) * (p - np.floor(p)))
    return out


def same(a, b):
    return len(a) == len(b) and all((x != x and y != y) or x == y or abs(x - y) <= 1e-9 * max(1, abs(y)) for x, y in zip(a, b))


GROUPS = {
    "uniform": lambda r: r.uniform(-5, 5, 3000).tolist(),
    "tail": lambda r: np.exp(r.normal(0, 12, 3000)).tolist(),
    "ties": lambda r: r.integers(0, 4, 3000).astype(float).tolist(),
    "mostly one": lambda r: [7.5] * 2900 + r.normal(0, 1, 100).tolist(),
    "near": lambda r: (1e15 + r.integers(0, 50, 3000)).tolist(),
    "wide": lambda r: [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324] * 300,
    "odd": lambda r: [float("nan")] * 30 + [float("inf")] * 40 + [float("-inf")] * 50 + r.normal(0, 1, 500).tolist(),
    "nan only": lambda r: [float("nan")] * 3,
    "one": lambda r: [3.25],
    "two": lambda r: [1.0, 2.0],
    None: lambda r: r.normal(0, 1, 200).tolist(),
}


@pytest.mark.parametrize("bounds", [{}, {"bins": 300, "most": 20}, {"bins": 2, "most": 1}])
def test_groups(spark, bounds):
    """The same quantiles at any bound of what a task may hold."""
    rng = np.random.default_rng(1)
    groups = {k: f(rng) for k, f in GROUPS.items()}
    if bounds.get("bins") == 2:
        groups = {k: groups[k] for k in ("ties", "two", "one", "nan only", None)}
    rows = [(k, x) for k, v in groups.items() for x in v] + [("uniform", None), ("nulls", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: r.p for r in quantiles.percentiles(df, ["k"], "v", SHARES, **bounds).collect()}
    assert set(got) == set(groups)
    assert all(same(got[k], brute(v)) for k, v in groups.items())


def test_many_distinct_values(spark):
    """A million distinct doubles with a small bound: no more rows than that are sorted anywhere, and ranks are exact."""
    n, most = 1_000_000, 500
    df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(1 << 50)) / 7919.0).alias("v"), (F.col("id") % 2).alias("k"))
    values = np.sort(df.toPandas()["v"].to_numpy())
    got = quantiles.percentiles(df, [], "v", SHARES, bins=256, most=most).first().p
    assert same(got, brute(values.tolist()))


def test_ranges_stay_within_the_bound(spark, monkeypatch):
    """What is sorted is bounded: the largest range that reaches the last step has at most ``most`` rows."""
    seen = []
    inside = quantiles._inside
    monkeypatch.setattr(quantiles, "_inside", lambda rows, ranges: seen.append(ranges) or inside(rows, ranges))
    df = spark.range(200_000).select((F.rand(5) * F.rand(6)).alias("v"))
    from corpusmill.operators.tables import materialise

    df = materialise(df)
    quantiles.percentiles(df, [], "v", [0.1, 0.5, 0.9], bins=64, most=300).collect()
    held = inside(df.select(F.struct(F.lit(0).alias("k0")).alias("g"), "v"), seen[-1]).groupBy("lo", "hi").count()
    assert len(seen) >= 3 and held.agg(F.max("count")).first()[0] <= 300


def test_edges(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert stats.quantile_edges(empty, "v", 4).first().edges == [] and stats.band_percentiles(empty, "k", "v").count() == 0
    assert stats.quantile_edges(spark.range(5).selectExpr("cast(id as double) v"), "v", 1).first().edges == []
    assert stats.quantile_edges(spark.range(5).selectExpr("cast(id as double) v"), "v", 4).first().edges == [1.0, 2.0, 3.0]


def test_sketches(spark, tmp_path):
    """Merged states of many runs: one row a band and run, ranks within the bound, repeated runs count once."""
    path = f"file://{tmp_path}/state"
    df = spark.range(300_000).select((F.col("id") % 3).cast("string").alias("k"), F.exp(F.randn(3) * 3).alias("v"), (F.col("id") % 7).alias("run"))
    from corpusmill.operators.tables import materialise

    df = materialise(df)
    for run in (*range(7), 0, 3):
        stats.save_state(df.filter(F.col("run") == run), "k", "v", path, run=str(run))
    state = spark.read.parquet(path)
    assert state.count() == 21 and state.agg(F.max(F.length("sketch"))).first()[0] < 400_000
    for r in stats.percentiles_of_state(spark, path, 1, 99).collect():
        v = np.sort([x.v for x in df.filter(F.col("k") == r.band).select("v").collect()])
        assert r.n == len(v)
        for value, share in ((r.low, 0.01), (r.high, 0.99)):
            assert abs(np.searchsorted(v, value) / len(v) - share) <= stats.RANK_ERROR
    with pytest.raises(ValueError, match="no values"):
        stats.save_state(df.filter("false"), "k", "v", f"{path}-none")
        stats.percentiles_of_state(spark, f"{path}-none")


def test_image_clip(spark):
    rng = np.random.default_rng(2)
    rows = [(rng.normal(0, 9, n).tolist(),) for n in (1, 2, 50, 64)]
    got = spark.createDataFrame(rows, "v array<double>").select("v", stats.clip_to_percentiles(F.col("v")).alias("c")).collect()
    for r in got:
        assert np.allclose(r.c, np.clip(r.v, *np.percentile(r.v, [2, 98])))
    odd = spark.createDataFrame([([1.0, None, 3.0, float("nan"), 2.0],), ([],), (None,)], "v array<double>").select(stats.clip_to_percentiles(F.col("v"), 0, 50).alias("c")).collect()
    assert odd[0].c[:3] == [1.0, None, 2.0] and odd[0].c[3] != odd[0].c[3] and odd[0].c[4] == 2.0 and odd[1].c == [] and odd[2].c is None


def test_state_of_values_is_exact(spark, tmp_path):
    """Of runs, one of them repeated, with equal values, a null and NaN."""
    rows = [("a", float(k % 50), k % 2) for k in range(1001)] + [("a", None, 0), ("a", float("nan"), 1), ("b", 3.0, 1)]
    df = spark.createDataFrame(rows, "k string, v double, run int")
    for run in (0, 1, 1):
        stats.save_values(df.filter(F.col("run") == run), "k", "v", f"{tmp_path}/values", str(run))
    found = {r.band: (r.low, r.high) for r in stats.percentiles_of_values(spark, f"{tmp_path}/values").collect()}
    known = [v for k, v, _ in rows if k == "a" and v is not None and v == v]
    assert found == {"a": tuple(round(float(np.percentile(known, q)), 6) for q in (2, 98)), "b": (3.0, 3.0)}

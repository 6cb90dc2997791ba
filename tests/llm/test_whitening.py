"""Embedding whitening against numpy and whole-number arithmetic."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, most=32):
    """x, deviations, eigenvalues and components of float vectors, from plain loops over whole numbers and numpy's eigh."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    off = [[n * c - s for c, s in zip(row, sums)] for row in x]
    deviation = [sum(c * c for c in row) for row in off]
    centred = np.array([[float(Fraction(c, n)) for c in row] for row in off])
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    return n, deviation, centred, e, v, Fraction(sum(deviation), n**3)


def check(rows, vectors, most=32):
    """rows of a query by vec_id and component against the vectors (dict by vec_id)."""
    n, deviation, centred, e, v, trace = brute(list(vectors.values()), most)
    rank = int((e > 1e-9 * e[0]).sum())
    assert len(rows) == len(vectors) * rank
    by = {(r.vec_id, r.component): r for r in rows}
    white = np.array([[by[i, k + 1].whitened for k in range(rank)] for i in vectors])
    want = centred @ v[:, :rank] / np.sqrt(e[:rank])
    signs = np.sign((white * want).sum(axis=0))
    assert np.allclose(white, want * signs, atol=1e-5)
    for j, i in enumerate(vectors):
        for k in range(rank):
            r = by[i, k + 1]
            assert r.n == n and r.deviation == deviation[j] and r.explained == pytest.approx(float(Fraction(float(e[k])) / trace), rel=1e-6)
    cov = np.cov(white.T, bias=True).reshape(rank, rank)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error <= 1e-4
    assert rows[0].identity_error == pytest.approx(np.abs(cov - np.eye(rank)).max(), abs=1e-9)


def test_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    check(queries.op13_embedding_whitening(spark, SF).collect(), {r.vec_id: r.embedding for r in table.collect()})


def odd_vectors(d=5):
    rng = np.random.default_rng(3)
    fine = {k: (rng.normal(0, 1, d) * [9, 3, 1, 0.5, 0.3]).astype(np.float32).tolist() for k in range(40)}
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [nan, 0.0, 0.0, 0.0, 0.0]), (103, [0.0, inf, 0.0, 0.0, 0.0]), (104, [0.0, -inf, 0.0, 0.0, 0.0]), (105, []), (106, [1.0, 2.0])]
    return fine, bad


def frame(spark, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    for c in ("x", "w", "v", "at", "value", "n", "component", "deviation"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_brute(spark):
    fine, bad = odd_vectors()
    check(whitening.whiten(frame(spark, [*fine.items(), *bad]).repartition(3)).collect(), fine)
    check(whitening.whiten(frame(spark, [*fine.items(), *bad]), most=2).collect(), fine, 2)


def test_repeated_and_null_ids(spark):
    fine, _ = odd_vectors()
    rows = [*fine.items(), (0, fine[0]), (None, fine[1]), (None, fine[1])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 43 * 5 and sum(r.vec_id is None for r in got) == 10 and got[0].n == 43
    pair = sorted((r.component, r.whitened) for r in got if r.vec_id == 0)
    assert all(pair[k][1] == pytest.approx(pair[k + 1][1]) for k in range(0, 10, 2))


def test_dependent_dimensions(spark):
    """Constant, doubled and tied dimensions: components that can't be told from rounding have no rows."""
    rng = np.random.default_rng(8)
    v = {k: [float(a), float(2 * a), 3.0, float(b)] for k, (a, b) in enumerate(rng.integers(-9, 9, (60, 2)))}
    check(whitening.whiten(frame(spark, v.items())).collect(), v)


def test_edges(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(frame(spark, rows))
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    one = {1: [1.0], 2: [3.0], 3: [-2.5]}
    check(whitening.whiten(frame(spark, one.items())).collect(), one)


def test_deviations_beyond_64_bits(spark):
    """Products of large entries are exact in whole numbers."""
    v = {k: [float((-1) ** k * 2.0**20 * (k + 1)), float(k * k), 1.0 / (k + 1)] for k in range(30)}
    _, deviation, *_ = brute(v.values())
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, v.items()), most=1).collect()}
    assert [int(got[k]) for k in v] == deviation
    w = {k: [x * 2.0**14 for x in v[k][:2]] for k in v}
    _, deviation, *_ = brute(w.values())
    assert max(deviation) > 2**64
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, w.items()), most=1).collect()}
    assert [int(got[k]) for k in w] == deviation

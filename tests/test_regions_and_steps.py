"""Regions by runs and links, area averages, rows dealt to steps, keep-first by increments: against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import rasters
from corpusmill.operators import graph, images, regions
from corpusmill.plans import training
from corpusmill.streaming import resume


def brute_boxes(mask, least):
    mask, out = mask.copy(), []
    for y, x in np.argwhere(mask):
        if not mask[y, x]:
            continue
        stack, seen = [(y, x)], []
        mask[y, x] = False
        while stack:
            a, b = stack.pop()
            seen.append((a, b))
            for p, q in ((a - 1, b), (a + 1, b), (a, b - 1), (a, b + 1)):
                if 0 <= p < mask.shape[0] and 0 <= q < mask.shape[1] and mask[p, q]:
                    mask[p, q] = False
                    stack.append((p, q))
        if len(seen) >= least:
            ys, xs = zip(*seen)
            out.append((min(xs), min(ys), max(xs), max(ys), len(seen)))
    return sorted((*map(int, x),) for x in out)


def masks():
    rng = np.random.default_rng(3)
    spiral = np.zeros((31, 31), bool)
    y = x = 0
    spiral[0, :] = spiral[:, 30] = spiral[30, :] = True
    for k in range(2, 15, 4):
        spiral[k, k - 2 : 31 - k] = spiral[k : 31 - k, 30 - k] = spiral[30 - k, k : 31 - k] = spiral[k + 2 : 31 - k, k] = True
    comb = np.zeros((20, 600), bool)
    comb[:, ::2] = True
    comb[19] = True
    return {1: rng.random((40, 53)) < 0.55, 2: rng.random((9, 700)) < 0.6, 3: spiral, 4: comb, 5: np.ones((30, 30), bool), 6: np.zeros((5, 5), bool), 7: np.eye(12, dtype=bool)}


def tiled(spark, side):
    rows = []
    for k, m in masks().items():
        for top in range(0, m.shape[0], side):
            for left in range(0, m.shape[1], side):
                part = m[top : top + side, left : left + side].astype(np.uint8)
                rows.append((k, top, left, images.pack(part)))
    return spark.createDataFrame(rows, f"id int, top int, left int, image {images.RASTER.simpleString()}").repartition(4)


@pytest.mark.parametrize(("side", "most_runs"), [(1000, 0), (16, 0), (7, 60)])
def test_regions_of_tiles(spark, side, most_runs):
    """An image cut into tiles has the same regions as the whole, whichever way it goes."""
    runs = regions.runs_of_tiles(tiled(spark, side), "id", top="top", left="left")
    got = regions.boxes(runs, "id", 4, most_runs).collect()
    assert sorted((r.id, r.x1, r.y1, r.x2, r.y2, r.pixels) for r in got) == sorted((k, *b) for k, m in masks().items() for b in brute_boxes(m, 4))


def test_regions_of_pixels(spark):
    rows = [(None if k == 1 else k, int(y), int(x)) for k, m in masks().items() if k in (1, 3, 7) for y, x in np.argwhere(m)]
    px = spark.createDataFrame(rows + rows[:50], "id int, y int, x int").repartition(4)
    got = regions.boxes(regions.runs_of_pixels(px, "id"), "id", 1).collect()
    assert sorted(repr((r.id, r.x1, r.y1, r.x2, r.y2, r.pixels)) for r in got) == sorted(repr((None if k == 1 else k, *b)) for k, m in masks().items() if k in (1, 3, 7) for b in brute_boxes(m, 1))
    assert regions.boxes(regions.runs_of_pixels(px.filter("false"), "id"), "id").count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(300)] + [(1000 + rng.randrange(400), 1000 + rng.randrange(400)) for _ in range(250)] + [(5, 5), (2000, 2001), (2001, 2000)]
    parent = {}

    def top(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        p, q = top(a), top(b)
        parent[max(p, q)] = min(p, q)
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {a: top(a) for a in linked}
    assert graph.components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize(("h", "w", "sh", "sw"), [(8, 8, 4, 4), (7, 10, 3, 4), (9, 5, 9, 2), (64, 30, 7, 30), (5, 5, 1, 1)])
def test_area_averages(spark, h, w, sh, sw):
    a = np.random.default_rng(h).normal(0, 5, (h, w))
    px = spark.createDataFrame([("k", y, x, float(a[y, x])) for y in range(h) for x in range(w)], "id string, y int, x int, v double")
    got = np.full((sh, sw), np.nan)
    for r in regions.area_averages(px, ["id"], F.lit(h), F.lit(w), F.lit(sh), F.lit(sw)).collect():
        got[r.y, r.x] = r.v
    assert np.allclose(got, rasters.resize(a, sh, sw, "box"))


def dealt(spark, native, proxies, steps, batch, ratios):
    rows = [(f"n{k}", "VHR-native") for k in range(native)] + [(f"p{k}", "RISAT-proxy[GSD:5m]") for k in range(proxies)] + ([("null", None)] if native else [])
    df = spark.createDataFrame(rows, "id string, gsd_bucket string").repartition(3)
    return sorted(training.deal_to_steps(df, "id", steps, batch, ratios).collect(), key=lambda r: r.slot)


@pytest.mark.parametrize(("steps", "batch", "ratios"), [(100, 8, [1.0, 0.8, 0.5]), (37, 3, [0.3]), (60, 1, [0.7, 0.123456]), (10, 50, [0.0, 1.0, 0.5])])
def test_steps(spark, steps, batch, ratios):
    """Every stretch of slots of one ratio is within one row of its share; rows come in turn, and again when they are used up."""
    got = dealt(spark, 120, 60, steps, batch, ratios)
    assert [r.slot for r in got] == list(range(steps * batch)) and all(r.step == r.slot // batch for r in got)
    share = lambda s: ratios[min(len(ratios) - 1, 0 if s / steps < 0.33 else 1 if s / steps < 0.66 else 2)]
    rng = random.Random(1)
    for _ in range(300):
        a = rng.randrange(len(got))
        b = a
        while b < len(got) and share(got[b].step) == share(got[a].step) and b - a < rng.randrange(1, 200):
            b += 1
        assert abs(sum(not r.proxy for r in got[a:b]) - (b - a) * share(got[a].step)) <= 1 + 1e-6
    for proxy, size in ((False, 121), (True, 60)):
        own = [r for r in got if r.proxy == proxy]
        assert [r.epoch for r in own] == [k // size for k in range(len(own))]
        assert all(own[k].key == own[k % size].key for k in range(len(own))) and len({r.key for r in own[:size]}) == min(size, len(own))


def test_steps_without_one_kind(spark):
    assert not any(r.proxy for r in dealt(spark, 5, 0, 10, 2, [0.5])) and all(r.proxy for r in dealt(spark, 0, 5, 10, 2, [0.5]))
    assert dealt(spark, 0, 0, 10, 2, [0.5]) == []


def first_of(rows):
    best = {}
    for r in rows:
        k = r[0] or ""
        if k not in best or (r[1] is not None, r[1] or 0) < (best[k][1] is not None, best[k][1] or 0):
            best[k] = r
    return sorted(map(repr, best.values()))


def test_increments(spark, tmp_path):
    """Any order of increments, repeated ones and replaced ones give the rows of one full merge."""
    rng = random.Random(7)
    rows = [(rng.choice([None, *"abcdefghij"]), o, f"v{o}") for o in rng.sample(range(1000), 200)]
    parts = {n: rows[k::4] for k, n in enumerate(("w", "x", "y", "z"))}
    frame = lambda x: spark.createDataFrame(x, "id string, ord int, v string")
    for order in (("w", "x", "y", "z"), ("z", "y", "x", "w", "z", "x")):
        state = f"{tmp_path}/{''.join(order)}"
        for n in order:
            resume.add_increment(frame(parts[n]), ["id"], ["ord"], state, n)
        assert sorted(repr(tuple(r)) for r in resume.first_of_state(spark, state).collect()) == first_of(rows)
    # the second increment holds only what is new or earlier
    resume.add_increment(frame([("a", 5, "five"), ("b", 5, "five")]), ["id"], ["ord"], f"{tmp_path}/s", 0)
    resume.add_increment(frame([("a", 9, "nine"), ("b", 1, "one"), ("c", 3, "three")]), ["id"], ["ord"], f"{tmp_path}/s", 1)
    assert spark.read.parquet(f"{tmp_path}/s/batch=1").count() == 2
    assert sorted(r.v for r in resume.first_of_state(spark, f"{tmp_path}/s").collect()) == ["five", "one", "three"]
    resume.add_increment(frame([]), ["id"], ["ord"], f"{tmp_path}/s", 2)
    assert resume.first_of_state(spark, f"{tmp_path}/s").count() == 3

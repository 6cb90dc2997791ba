"""What queries over many small images hold in Python at a time, and that all of their rows are there."""

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.operators import images
from corpusmill.plans import catalog, catalog_files, recipes

SF = "/root/testdata/sf0.001"


def passes(df):
    """Python workers that a task of the plan has at once."""
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


@pytest.mark.parametrize("name", ["raster_side_by_side", "raster_proxy", "raster_downsample", "raster_png_round_trip", "raster_tile"])
def test_raster_steps_are_one_pass(spark, name):
    assert passes(catalog.QUERIES[name](spark, SF)) == 1


@pytest.mark.parametrize("name", ["sn6_sar", "sardet", "rsvqa"])
def test_pictures_are_read_in_two_passes(spark, monkeypatch, name):
    """What is written, and what is read again."""
    seen = []
    monkeypatch.setattr(catalog_files, "_files", lambda df, *a: seen.append(passes(df)))
    monkeypatch.setattr(catalog_files, "_go", lambda *a, **b: None)
    monkeypatch.setattr(recipes, "sn6_sar", lambda spark, *a, **b: spark.createDataFrame([], "source_id string, rows array<struct<id:string>>"))
    monkeypatch.setattr(recipes, "finish", lambda made: made)
    drawn = catalog.QUERIES[f"pictures_{name}"](spark, SF)
    assert max(seen) == 1 and "MapInArrow" in drawn._jdf.queryExecution().logical().toString()
    assert drawn._jdf.queryExecution().logical().toString().count("MapInArrow") <= 3  # listing, reading, looking


def test_slices_have_few_rows(spark):
    """Small inputs may have large results: few rows are held, and all come out."""
    rows = pa.RecordBatch.from_pylist([{"id": k} for k in range(5000)])
    held = [b.num_rows for b in images.slices([rows])]
    assert sum(held) == 5000 and max(held) <= 1000
    big = images.map_images(spark.range(0, 400, 1, 1), ["id"], "out", images.RASTER, lambda k: np.full((128, 128), k, "<f8"))
    assert sorted(r.id for r in big.filter("out.h = 128 AND error IS NULL").select("id").collect()) == list(range(400))

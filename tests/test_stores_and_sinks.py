"""Listing by tasks, reading of chosen files only, shards that appear together or not at all."""

import io
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import tiff

from corpusmill.functions import rasters
from corpusmill.plans import packaging, recipes
from corpusmill.sources import readers, sinks, stores


def put(root, files):
    for name, data in files.items():
        at = root / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data)


def test_listing(spark, tmp_path):
    files = {"a.png": b"1", "b b[1].PNG": b"22", "empty.txt": b"", ".hidden": b"3", "_under/x.png": b"4", "d/e/f/g.tif": b"55555", "d/ü%20.png": b"6"}
    put(tmp_path, files)
    (tmp_path / "no files" / "here").mkdir(parents=True)
    below = {r.path: r.size for r in stores.files_below(spark, str(tmp_path)).collect()}
    assert below == {f"file:{tmp_path}/{n}": len(c) for n, c in files.items()}
    assert {r.path for r in stores.files_below(spark, f"file://{tmp_path}", recursive=False).collect()} == {f"file:{tmp_path}/{n}" for n in files if "/" not in n}
    assert stores.files_below(spark, f"{tmp_path}/none").count() == 0
    assert {r.name for r in readers.listing(spark, str(tmp_path)).collect()} == {"a.png", "b b[1].PNG", "empty.txt"}
    assert {(r.name, r.stem, r.ext) for r in readers.listing(spark, str(tmp_path), "*.{png,tif}", recursive=True).collect()} == {("a.png", "a", "png"), ("x.png", "x", "png"), ("g.tif", "g", "tif"), ("ü%20.png", "ü%20", "png")}
    assert readers.listing(spark, f"{tmp_path}/none").count() == 0
    # what only Spark can open is listed by it: the same names
    assert {r.path.rsplit("/", 1)[-1] for r in stores._by_driver(spark, f"file://{tmp_path}", True).collect()} == {n.rsplit("/", 1)[-1] for n in files}


def test_chosen_files_only(spark, tmp_path):
    """Of a folder of 400 files 5 in 100 are wanted: so many bytes are read, and the rest needn't even be readable."""
    put(tmp_path, {f"f{k}.bin": os.urandom(1000 + k) for k in range(400)})
    wanted = readers.listing(spark, str(tmp_path)).filter(F.regexp_extract("stem", r"f(\d+)", 1).cast("int") % 20 == 3).select("path", "stem")
    meter = spark.sparkContext.accumulator(0)
    got = stores.read_selected(wanted, meter=meter).collect()
    assert len(got) == 20 and meter.value == sum(1000 + k for k in range(3, 400, 20))
    assert all(bytes(r.content) == (tmp_path / f"{r.stem}.bin").read_bytes() and r.error is None for r in got)
    lost = spark.createDataFrame([(f"file:{tmp_path}/gone", 1), (None, 2), (f"file:{tmp_path}/f0.bin", 3)], "path string, k int")
    by = {r.k: r for r in stores.contents_of(spark, lost).collect()}
    assert by[1].content is None and "gone" in by[1].error and by[2].content is None and by[2].error is None and len(by[3].content) == 1000


def test_oscd_opens_three_bands(spark, tmp_path, monkeypatch):
    meter, read = spark.sparkContext.accumulator(0), stores.read_selected
    monkeypatch.setattr(stores, "read_selected", lambda files, path="path", out="content", meter_=meter: read(files, path, out, meter_))
    size = len(tiff(np.full((8, 8), 5000, np.uint16)))
    for place in ("a", "b"):
        for date in (1, 2):
            put(tmp_path, {f"images/{place}/imgs_{date}/x_B{b:02d}.tif": tiff(np.full((8, 8), 5000, np.uint16)) for b in range(1, 14)})
    recipes.finish(recipes.oscd(spark, str(tmp_path), recipes.Options(output_dir=f"{tmp_path}/out"))).collect()
    assert meter.value == 2 * 2 * 3 * size


def test_sample_of_tiles_reads_its_share(spark, tmp_path, monkeypatch):
    meter, read = spark.sparkContext.accumulator(0), stores.read_selected
    monkeypatch.setattr(stores, "read_selected", lambda files, path="path", out="content", meter_=meter: read(files, path, out, meter_))
    tile = tiff(np.full((32, 32, 3), 5, np.uint16))
    put(tmp_path, {f"train/images/t{k}.tif": tile for k in range(100)})
    done = recipes.finish(recipes.sn6_opt(spark, str(tmp_path), recipes.Options(fraction=0.05, output_dir=f"{tmp_path}/out"))).collect()
    assert len(done) == 5 and meter.value == 5 * len(tile)


def members(folder, prefix="p"):
    return {n: [(m.name, tarfile.open(folder / n).extractfile(m).read()) for m in tarfile.open(folder / n)] for n in sorted(os.listdir(folder)) if n.endswith(".gz")}


def test_shards_commit(spark, tmp_path):
    rows = [(f"d/{k:03d}.txt", os.urandom(k)) for k in range(45)]
    counts = sinks.write_shards(spark.createDataFrame(rows, "path string, content binary").repartition(5), str(tmp_path / "out"), "p", 20)
    assert [(r.shard, r.files, r.tar) for r in counts.orderBy("shard").collect()] == [(k, n, f"p_shard_{k:04d}.tar.gz") for k, n in enumerate((20, 20, 5))]
    found = members(tmp_path / "out")
    assert [x for v in found.values() for x in v] == [(n.rsplit("/", 1)[-1], c) for n, c in rows]
    assert sorted(os.listdir(tmp_path / "out")) == [".p_shards.jsonl.crc", *found, "p_shards.jsonl"] or sorted(os.listdir(tmp_path / "out")) == [*found, "p_shards.jsonl"]
    assert sinks.write_shards(spark.createDataFrame([], "path string, content binary"), str(tmp_path / "none"), "p").count() == 0


def test_failed_shards_leave_nothing(spark, tmp_path):
    """A task that fails after others have written: no tar, no part of one, no count."""
    put(tmp_path / "src", {f"{k:03d}.txt": b"x" * 100 for k in range(60)})
    (tmp_path / "out").mkdir()
    names = stores.files_below(spark, str(tmp_path / "src")).select("path")
    from corpusmill.operators import corpus
    from corpusmill.operators.tables import materialise

    numbered = materialise(corpus.shard_assign(names, ["path"], 10).withColumn("source", F.col("path")))
    (tmp_path / "src" / "055.txt").unlink()
    with pytest.raises(Exception, match="055.txt"):
        sinks._pack(numbered, str(tmp_path / "out"), "p", True)
    assert os.listdir(tmp_path / "out") == []
    with pytest.raises(Exception, match="boom"):
        fail = F.when(F.col("k") == 30, F.raise_error(F.lit("boom"))).otherwise(F.lit(b"1"))
        sinks.write_files(spark.range(40).select(F.col("id").alias("k")).repartition(4).select(F.concat(F.lit("f"), F.col("k").cast("string")).alias("path"), fail.cast("binary").alias("content")), "path", "content", str(tmp_path / "files"))
    assert not [n for n in (os.listdir(tmp_path / "files") if (tmp_path / "files").exists() else []) if "staging" in n or "part" in n]


def test_folder_shards(spark, tmp_path):
    files = {".hidden": b"h", "_s": b"u", "a/empty": b"", "a/b/c.txt": b"c", "list.jsonl": b"{}", "z z.txt": b"z"}
    put(tmp_path / "src", files)
    counts = sinks.write_folder_shards(spark, str(tmp_path / "src"), str(tmp_path / "out"), "p", 3)
    assert {r.shard: r.files for r in counts.collect()} == {0: 3, 1: 2}
    want = [(n.rsplit("/", 1)[-1], files[n]) for n in sorted(files) if n != "list.jsonl"]
    assert [x for v in members(tmp_path / "out").values() for x in v] == want


def test_write_files(spark, tmp_path):
    rows = [(f"a/{k}.bin", os.urandom(50)) for k in range(30)]
    sinks.write_files(spark.createDataFrame(rows, "path string, content binary").repartition(3), "path", "content", str(tmp_path))
    assert {n: (tmp_path / n).read_bytes() for n, _ in rows} == dict(rows) and os.listdir(tmp_path) == ["a"]


def test_selection_files(spark, tmp_path):
    sinks.write_selection(spark.createDataFrame([("t2",), ("t1",)], "tile string"), "tile", f"{tmp_path}/lines")
    (tmp_path / "list.json").write_text('[ "t1",\n "t2" ]')
    (tmp_path / "none.json").write_text("[]")
    for name, want in (("lines", ["t1", "t2"]), ("list.json", ["t1", "t2"]), ("none.json", []), ("missing", [])):
        assert sorted(r.tile for r in sinks.read_selection(spark, f"{tmp_path}/{name}").collect()) == want


def test_split_all_in_one_job(spark, tmp_path):
    """Names with odd characters, a file of one row, lines that keep their split."""
    from test_operators import row

    rows = spark.createDataFrame([row(id=f"r{k}", split="train") for k in range(40)], readers.SAMPLE)
    sinks.write_jsonl(rows, f"{tmp_path}/a b=c.jsonl")
    sinks.write_jsonl(rows.limit(1), f"{tmp_path}/one.jsonl")
    got = {r.file: (r.total, r.train, r.val) for r in packaging.split_all(spark, str(tmp_path)).collect()}
    assert got == {"a b=c.jsonl": (40, 39, 1), "one.jsonl": (1, 1, 0)}
    assert sorted(n for n in os.listdir(tmp_path) if not n.startswith(".")) == ["a b=c.jsonl", "a b=c_train.jsonl", "a b=c_val_internal.jsonl", "one.jsonl", "one_train.jsonl"]
    val = readers.jsonl(spark, f"{tmp_path}/a b=c_val_internal.jsonl").collect()
    assert len(val) == 1 and val[0].split == "val_internal"
    assert packaging.split_all(spark, str(tmp_path)).count() == 2


def test_shards_of_pictures(spark, tmp_path):
    """Files written by a recipe, packed from their folder."""
    put(tmp_path / "images", {f"{k}.png": rasters.write_png(np.full((4, 4), k, np.uint8)) for k in range(5)})
    sinks.write_folder_shards(spark, str(tmp_path / "images"), str(tmp_path / "out"), "p", 2)
    data = [c for v in members(tmp_path / "out").values() for _, c in v]
    assert [int(rasters.read_png(c)[0, 0].max()) for c in data] == [0, 1, 2, 3, 4] and io.BytesIO(data[0]).read(4) == b"\x89PNG"


def test_listed_and_written_files_are_dealt_out(spark, tmp_path):
    """One task lists a folder, but many have its files; tasks that write files have a bounded number of them."""
    from pyspark.sql import functions as F

    from corpusmill.plans import catalog_files
    from corpusmill.sources import stores

    for k in range(60):
        (tmp_path / f"f{k}.txt").write_text("x" * k)
    (tmp_path / "below").mkdir()
    found = stores.files_below(spark, f"file://{tmp_path}", recursive=False)
    assert sorted(r["size"] for r in found.collect()) == list(range(60))
    assert found.select(F.spark_partition_id()).distinct().count() > 1
    assert catalog_files._dealt(spark.range(0, 45_000, 1, 1)).rdd.getNumPartitions() == 5

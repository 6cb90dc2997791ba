"""Operators on small rows: quotas, validation, corpus assembly, boxes, rasters, radar."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import boxes, gsd, rasters, sar, text
from corpusmill.operators import corpus, images, manifest, sampling, stats, validate
from corpusmill.plans import checks, training
from corpusmill.schema import SAMPLE
from corpusmill.sources import readers, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def row(**k):
    base = {"id": "a_1", "dataset": "bigen", "task": "vqa", "image_path": ["a.png"], "pair_type": "single", "gsd_bucket": "[GSD:10m]", "split": "train", "instruction": "q", "response": "r", "bbox": None, "modality": "optical"}
    return {**base, **k}


def errors(spark, *rows):
    df = spark.createDataFrame([tuple(r[f] for f in SAMPLE.fieldNames()) for r in rows], SAMPLE)
    return [r["errors"] for r in validate.with_errors(df).select("errors").collect()]


@pytest.mark.parametrize("n,fraction", [(1, 0.1), (7, 0.5), (100, 0.03), (1000, 0.1)])
def test_quotas(spark, n, fraction):
    df = spark.range(n).select("id", F.lit(None).cast("string").alias("k"))
    assert sampling.stratified_sample(df, ["k"], "id", fraction).count() == max(1, round(n * fraction))
    assert sampling.uniform_sample(df, "id", fraction).count() == max(1, int(n * fraction))
    val = sampling.validation_split(df, ["k"], "id", fraction).filter("split = 'val_internal'").count()
    assert val == (min(max(1, int(n * fraction)), n - 1) if n > 1 else 0)


def test_sample_is_stable_and_partition_free(spark):
    df = spark.range(500).withColumn("k", F.col("id") % 3)
    a = {r.id for r in sampling.stratified_sample(df, ["k"], "id", 0.2).collect()}
    b = {r.id for r in sampling.stratified_sample(df.repartition(7), ["k"], "id", 0.2).collect()}
    assert a == b and a != {r.id for r in sampling.stratified_sample(df, ["k"], "id", 0.2, seed=1).collect()}


def test_split_loses_nothing(spark):
    df = spark.range(300).withColumn("k", F.col("id") % 4)
    out = sampling.validation_split(df, ["k"], "id", 0.1).collect()
    assert sorted(r.id for r in out) == list(range(300))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, k string, gsd_bucket string, v double")
    assert sampling.stratified_sample(empty, ["k"], "id", 0.5).count() == 0
    assert sampling.native_proxy_mix(empty, "id", 0.5).count() == 0
    assert stats.quantile_edges(empty, "v", 4).first().edges == []
    assert stats.band_percentiles(empty, "k", "v").count() == 0
    assert corpus.keep_first(empty, ["k"], ["id"]).count() == 0
    assert corpus.shard_assign(empty, ["id"], 2).count() == 0


def test_null_arrays_without_ansi(spark):
    """The size of a null array is -1 in such sessions: no result depends on it."""
    df = spark.createDataFrame([tuple(row(image_path=None, bbox=None)[f] for f in SAMPLE.fieldNames())], SAMPLE)
    found = []
    before = spark.conf.get("spark.sql.ansi.enabled")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            seen = corpus.coverage(df).first()
            share = df.select(stats.change_fraction(F.lit(None).cast("array<double>")).alias("v")).first().v
            found.append((validate.with_errors(df).first().errors, seen.single, seen.paired, share))
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)
    assert found[0] == found[1] and found[0][1:] == (0, 0, 0.0)


def test_validation(spark):
    assert errors(spark, row(), row(task="grounding", bbox=[[0.0, 0.0, 1000.0, 1000.0]])) == [[], []]
    got = errors(
        spark, row(modality=None), row(task="grounding", bbox=[[0.0, 0.0, 1500.0, 3.0]]), row(image_path=["a", "b"]), row(task="grounding", bbox=[]), row(bbox=[]),
        row(pair_type="cross-modal", image_path=["a", "b"]), row(id="A-1"), row(bbox=[[float("nan"), 0.0, 1.0, 1.0]], task="grounding"), row(dataset="x", instruction=""),
    )
    assert [len(e) for e in got] == [1, 1, 1, 1, 1, 1, 1, 0, 2]
    assert got[1] == ["bbox[0][2]=1500.0 out of range [0, 1000]"]
    assert got[0][0].startswith("schema [modality]") and "exactly 1 image" in got[2][0]


def test_validate_file(spark, tmp_path):
    good = json.dumps(row())
    bad = json.dumps(row(id=5))
    (tmp_path / "x.jsonl").write_text("\n".join([good, "", bad, "{", json.dumps({**row(), "more": 1})]))
    judged = validate.lines(readers.numbered_lines(spark, str(tmp_path / "x.jsonl")))
    assert {r.line_no: len(r.errors) for r in judged.collect()} == {1: 0, 3: 1, 4: 1, 5: 1}
    assert any(m.message == "line 4: JSON parse error" for m in validate.line_messages(judged).collect())


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([tuple(row(bbox=[[1.0, 2.0, 3.0, 4.0]], response="ü")[f] for f in SAMPLE.fieldNames())], SAMPLE)
    sinks.write_jsonl(df, str(tmp_path / "out"))
    back = readers.jsonl(spark, str(tmp_path / "out") + "/*.txt").select(*SAMPLE.fieldNames())
    assert back.collect() == df.collect()
    (tmp_path / "bad.jsonl").write_text("{nope\n")
    with pytest.raises(Exception):
        readers.jsonl(spark, str(tmp_path / "bad.jsonl")).collect()


def test_corpus(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), (None, 2, "z"), ("", 3, "w")], "id string, ord int, v string")
    assert {(r.id, r.v) for r in corpus.keep_first(df, ["id"], ["ord"]).collect()} == {("a", "y"), (None, "z")}
    assert {(r.id, r["count"]) for r in corpus.duplicate_ids(df).collect()} == {("a", 2), ("", 2)}
    files = spark.createDataFrame([(1, "data"), (1, "data_train"), (1, "data_val_internal"), (1, "other")], "tier int, stem string")
    assert {r.stem for r in corpus.source_files(files).collect()} == {"data_train", "data_val_internal", "other"}
    shards = corpus.shard_assign(spark.range(5), ["id"], 2).orderBy("id").collect()
    assert [(r.shard, r.place) for r in shards] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]


def test_shard_files(spark, tmp_path):
    import tarfile

    files = spark.createDataFrame([(f"d/{k}.png", bytes([k])) for k in range(5)], "path string, content binary")
    counts = sinks.write_shards(files, str(tmp_path), "img", 2)
    assert sorted(r.files for r in counts.collect()) == [1, 2, 2]
    with tarfile.open(tmp_path / "img_shard_0002.tar.gz") as t:
        assert t.getnames() == ["4.png"]


def test_folder_shards(spark, tmp_path):
    """Empty and hidden files are packed too."""
    import tarfile

    want = {"a.png": b"1", "empty.txt": b"", "_mark": b"2", ".dot": b"3", "x y+%.txt": b"4", "in.txt": b"5"}
    for name, data in want.items():
        target = tmp_path / "src" / ("_sub" if name == "in.txt" else "d") / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
    (tmp_path / "src/rows.jsonl").write_text("{}")
    counts = sinks.write_folder_shards(spark, str(tmp_path / "src"), str(tmp_path / "out"), "img", 4)
    assert sorted(r.files for r in counts.collect()) == [2, 4]
    got = {}
    for path in (tmp_path / "out").glob("*.tar.gz"):
        with tarfile.open(path) as t:
            got |= {m.name: t.extractfile(m).read() for m in t.getmembers()}
    assert got == want


def test_manifest(spark):
    log = spark.createDataFrame([("a", True, 1), ("a", False, 2), ("b", True, 1), ("c", None, 1)], "id string, processed boolean, ord int")
    items = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    assert {r.id for r in manifest.pending(items, log, "ord").collect()} == {"a", "c", "d"}


def test_boxes(spark):
    lit = lambda *v: F.array(F.array(*[F.lit(float(x)) for x in v]))
    assert tuple(one(spark, boxes.normalized_to_pixel(lit(0, 0, 1000, 1000), F.lit(640.0), F.lit(480.0)))) == (0, 0, 640, 480)
    assert one(spark, boxes.referring_box(F.lit("{<45><45><59><59>}"))) == [[450.0, 450.0, 590.0, 590.0]]
    for bad in ("{<59><45><45><59>}", "{<45><45><45><59>}", "x{<1><2><3><4>}", ""):
        assert one(spark, boxes.referring_box(F.lit(bad))) is None
    assert one(spark, boxes.ordered(lit(1, 1, 1, 1))) and not one(spark, boxes.ordered(lit(2, 1, 1, 1)))
    w, h = F.lit(100.0), F.lit(50.0)
    assert one(spark, boxes.yolo_row(F.lit(" 2 0.5 0.5 0.2 0.2 x"), w, h))["bbox"] == [400.0, 400.0, 600.0, 600.0]
    for bad in ("2 0.5 0.5", "6 .5 .5 .1 .1", "-1 .5 .5 .1 .1", ""):
        assert one(spark, boxes.yolo_row(F.lit(bad), w, h)) is None


def test_geojson(spark):
    feature = lambda kind, c: {"geometry": {"type": kind, "coordinates": c}}
    square = [[0, 0], [10, 0], [10, 10.9]]
    doc = json.dumps({"features": [feature("Polygon", [square]), feature("MultiPolygon", [[square], [[[1, 1], [2, 2]]]]), feature("Point", [1, 2])]})
    assert len(one(spark, readers.rings(F.lit(doc)))) == 3
    assert one(spark, boxes.polygons_to_boxes(readers.rings(F.lit(doc)), F.lit(100.0), F.lit(100.0))) == [[0.0, 0.0, 100.0, 100.0]] * 2
    assert one(spark, readers.rings(F.lit("nope"))) == [] and one(spark, readers.rings(F.lit(None).cast("string"))) == []


def test_radar(spark):
    for value, want in ((1.0, 0.0), (10.0, 10.0), (0.0, -100.0), (-3.0, -100.0)):
        assert math.isclose(one(spark, sar.to_db(F.lit(value))), want, abs_tol=1e-9)
    assert [one(spark, sar.clip_vv(F.lit(v))) for v in (-30.0, -12.5, 5.0)] == [-25.0, -12.5, 0.0]
    got = one(spark, sar.dual_rgb(F.lit(0.1), F.lit(0.01)))
    assert tuple(got) == tuple(rasters.radar_rgb(np.full((1, 1), 0.1), np.full((1, 1), 0.01))[0, 0].tolist())


def test_gsd(spark):
    assert one(spark, gsd.bucket(F.lit("oscd"), F.lit(3.0))) == "[GSD:10m]"
    assert one(spark, gsd.bucket(F.lit("vrsbench"), F.lit(0.3))) == "[GSD:0.30m]"
    assert one(spark, gsd.bucket(F.lit("cdvqa"))) == "VHR-native"
    assert one(spark, gsd.proxy_bucket(F.lit("sar"))) == "RISAT-proxy[GSD:5m]"
    assert [one(spark, gsd.stage_ratio(F.lit(k)))["native"] for k in range(6)] == [1.0, 1.0, 0.8, 0.5, 0.3, 0.3]
    assert [one(spark, gsd.step_ratio(F.lit(k), F.lit(100), F.array(F.lit(1.0), F.lit(0.0)))) for k in (0, 33, 66)] == [1.0, 0.0, 0.0]


def test_labels(spark):
    assert one(spark, text.land_cover(F.lit("2"))) == "Water" and one(spark, text.land_cover(F.lit(" 2 "))) == "Water"
    assert one(spark, text.land_cover(F.lit("-1"))) == "-1" and one(spark, text.land_cover(F.lit(None).cast("string"))) == "Unknown land cover"
    hot = [0] * 19
    hot[3] = 1
    assert one(spark, text.multihot(F.array(*[F.lit(v) for v in hot]))) == hot
    assert one(spark, text.multihot(F.array(F.lit("3"), F.lit("99"), F.lit("x")))) == hot
    assert one(spark, text.multihot(F.lit(None).cast("array<int>"))) == [0] * 19


def test_png_tiff_npy():
    rng = np.random.default_rng(0)
    rgb = rng.integers(0, 256, (9, 7, 3)).astype(np.uint8)
    assert (rasters.read_png(rasters.write_png(rgb)) == rgb).all()
    assert (rasters.read_png(rasters.write_png(rgb[:, :, 0]))[:, :, 2] == rgb[:, :, 0]).all()
    with pytest.raises(ValueError):
        rasters.write_png(np.zeros((2, 2, 4)))
    import io

    buf = io.BytesIO()
    np.save(buf, rgb)
    assert (rasters.read_npy(buf.getvalue()) == rgb).all()
    assert (rasters.read_tiff(tiff(rgb.astype(np.uint16) * 100)) == rgb.astype(np.uint16) * 100).all()


def tiff(a):
    """A one-strip little-endian TIFF."""
    import struct

    a = a if a.ndim == 3 else a[:, :, None]
    data = a.astype(a.dtype.newbyteorder("<")).tobytes()
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    tags = [(256, a.shape[1]), (257, a.shape[0]), (258, a.dtype.itemsize * 8), (259, 1), (262, 1), (273, 8), (277, a.shape[2]), (278, a.shape[0]), (279, len(data)), (339, kind)]
    return struct.pack("<2sHI", b"II", 42, 8 + len(data)) + data + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags) + b"\0\0\0\0"


def png_with(rows: np.ndarray, depth: int, kind: int, filters, palette: bytes = b"") -> bytes:
    """A PNG whose rows of bytes are filtered as said, by the definition of the filters."""
    import struct
    import zlib

    step = max(1, depth * {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind] // 8)
    width = rows.shape[1] * 8 // (depth * {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind])
    out, above = b"", [0] * rows.shape[1]
    for row, f in zip(rows.tolist(), filters, strict=True):
        line = []
        for x, v in enumerate(row):
            a, b, c = (row[x - step] if x >= step else 0), above[x], (above[x - step] if x >= step else 0)
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line.append((v - (0, a, b, (a + b) // 2, paeth)[f]) & 255)
        out += bytes([f, *line])
        above = row
    part = lambda name, body: struct.pack(">I", len(body)) + name + body + b"\0\0\0\0"
    return rasters.PNG_HEAD + part(b"IHDR", struct.pack(">IIBBBBB", width, len(rows), depth, kind, 0, 0, 0)) + (part(b"PLTE", palette) if palette else b"") + part(b"IDAT", zlib.compress(out)) + part(b"IEND", b"")


def test_png_kinds():
    rng = np.random.default_rng(3)
    filters = [0, 1, 2, 3, 4, 4, 3]
    rgb = rng.integers(0, 256, (7, 15), np.uint8)
    assert (rasters.read_png(png_with(rgb, 8, 2, filters)) == rgb.reshape(7, 5, 3)).all()
    wide = rng.integers(0, 256, (7, 10), np.uint8)
    assert (rasters.read_png(png_with(wide, 16, 0, filters)) == wide.view(">u2")).all()
    palette = bytes(range(48))
    assert (rasters.read_png(png_with(rng.integers(0, 16, (7, 6), np.uint8), 8, 3, filters, palette))[..., 1] % 3 == 1).all()
    assert rasters.read_png(png_with(np.full((7, 1), 0b10100000, np.uint8), 1, 0, [0] * 7))[0].tolist() == [255, 0, 255, 0, 0, 0, 0, 0]


def test_tiff_kinds():
    """Tiles with deflate, planes, the difference predictor, packbits and LZW."""
    import struct
    import zlib

    def made(tags, parts):
        at, places = 8, []
        for p in parts:
            places.append(at)
            at += len(p)
        tags = sorted(tags)
        extra, body = at + 2 + 12 * len(tags) + 4, b""
        entries = b""
        for t, v in tags:
            v = places if v == "places" else [len(p) for p in parts] if v == "lengths" else v if isinstance(v, list) else [v]
            data = struct.pack(f"<{len(v)}I", *v)
            entries += struct.pack("<HHI", t, 4, len(v)) + (data if len(v) == 1 else struct.pack("<I", extra + len(body)))
            body += data if len(v) > 1 else b""
        return struct.pack("<2sHI", b"II", 42, at) + b"".join(parts) + struct.pack("<H", len(tags)) + entries + b"\0\0\0\0" + body

    a = np.arange(20 * 24, dtype=np.uint16).reshape(20, 24) * 7
    padded = np.zeros((32, 32), np.uint16)
    padded[:20, :24] = a
    tiles = [zlib.compress(padded[y : y + 16, x : x + 16].tobytes()) for y in (0, 16) for x in (0, 16)]
    assert (rasters.read_tiff(made([(256, 24), (257, 20), (258, 16), (259, 8), (277, 1), (322, 16), (323, 16), (324, "places"), (325, "lengths")], tiles)) == a).all()
    planes = np.stack([a, a + 1], axis=-1)
    assert (rasters.read_tiff(made([(256, 24), (257, 20), (258, 16), (259, 1), (277, 2), (278, 20), (284, 2), (273, "places"), (279, "lengths")], [a.tobytes(), (a + 1).tobytes()])) == planes).all()
    diff = np.diff(a.astype(np.uint16), axis=1, prepend=np.uint16(0)).astype(np.uint16)
    strip = [(256, 24), (257, 20), (258, 16), (277, 1), (278, 20), (273, "places"), (279, "lengths")]
    assert (rasters.read_tiff(made([*strip, (259, 8), (317, 2)], [zlib.compress(diff.tobytes())])) == a).all()
    raw = a.tobytes()
    packed = b"".join(bytes([len(raw[k : k + 100]) - 1]) + raw[k : k + 100] for k in range(0, len(raw), 100))
    assert (rasters.read_tiff(made([*strip, (259, 32773)], [packed])) == a).all()
    assert (rasters.read_tiff(made([*strip, (259, 5)], [lzw(raw)])) == a).all()


def lzw(data: bytes) -> bytes:
    """TIFF's LZW by its definition."""
    bits, table, width = "", {bytes([k]): k for k in range(256)}, 9
    emit = lambda code: format(code, f"0{width}b")
    bits += emit(256)
    last, size = b"", 258
    for k in data:
        if last + bytes([k]) in table:
            last += bytes([k])
            continue
        bits += emit(table[last])
        table[last + bytes([k])] = size
        size += 1
        if size in (512, 1024, 2048):
            width += 1
        elif size == 4095:
            bits += emit(256)
            table, width, size = {bytes([j]): j for j in range(256)}, 9, 258
        last = bytes([k])
    bits += emit(table[last]) + emit(257)
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


def test_raster_maths():
    flat = np.full((64, 64, 3), 7, np.uint8)
    assert (rasters.proxy_image(flat) == 7).all() and rasters.proxy_image(flat).shape == (32, 32, 3)
    small = rasters.downsample(np.arange(16.0).reshape(4, 4), 1.0, 0.5)
    assert small.tolist() == [[2.5, 4.5], [10.5, 12.5]]
    assert rasters.downsample(small, 1.0, 2.0) is small
    assert rasters.side_by_side(flat, flat[:32]).shape == (64, 64 + 2 + 128, 3)
    assert rasters.binary_mask(np.eye(2), (4, 4)).sum() == 8
    assert rasters.reflectance_rgb(np.full((2, 2, 3), 10000, np.uint16)).max() == 255


def test_decode_failure_is_an_outcome(spark):
    files = spark.createDataFrame([("a.png", b"x"), ("b.png", rasters.write_png(np.zeros((2, 2))))], "path string, content binary")
    got = {r.path: (r.image is None, r.error is None) for r in images.decode(files).collect()}
    assert got == {"a.png": (True, False), "b.png": (False, True)}


def test_structure(spark, tmp_path):
    (tmp_path / "images").mkdir()
    with pytest.raises(checks.StructureError):
        checks.run(spark, "sardet", str(tmp_path))
    (tmp_path / "images/a.png").touch()
    assert {r["kind"]: r["count"] for r in checks.run(spark, "sardet", str(tmp_path))} == {"images": 1, "labels": 0}
    with pytest.raises(ValueError):
        checks.run(spark, "nope", str(tmp_path))
    assert checks.run_all(spark, {"sardet": str(tmp_path), "oscd": str(tmp_path / "x"), "levir_cd": str(tmp_path)})["oscd"] == "skipped"


def test_structure_contents(spark, tmp_path):
    """What the tables of a source hold counts too: empty lists and tables, locations without a pair."""
    (tmp_path / "VRSBench_train.json").write_text("[]")
    (tmp_path / "Images_val.zip").touch()
    with pytest.raises(checks.StructureError):
        checks.run(spark, "vrsbench", str(tmp_path))
    (tmp_path / "VRSBench_train.json").write_text(json.dumps([{"id": "1", "image": "a", "conversations": [{"from": "human", "value": "[vqa] ?"}]}]))
    assert {r["kind"]: r["count"] for r in checks.run(spark, "vrsbench", str(tmp_path))}["entries_vqa"] == 1
    (tmp_path / "Images_val.zip").unlink()
    with pytest.raises(checks.StructureError):
        checks.run(spark, "vrsbench", str(tmp_path))
    root = tmp_path / "o"
    for place in ("a/imgs_1", "b/imgs_2"):
        (root / "images" / place).mkdir(parents=True)
        (root / "images" / place / "x_B02.tif").touch()
    with pytest.raises(checks.StructureError):
        checks.run(spark, "oscd", str(root))
    (root / "images/a/imgs_2").mkdir()
    (root / "images/a/imgs_2/x_B02.tif").touch()
    assert {r["kind"]: r["count"] for r in checks.run(spark, "oscd", str(root))}["complete_pairs"] == 1
    table = spark.createDataFrame([("p", "x"), ("q", "y")], "patch_id string, country string")
    table.filter("false").write.parquet(str(tmp_path / "e/metadata.parquet"))
    table.write.parquet(str(tmp_path / "m/metadata.parquet"))
    with pytest.raises(checks.StructureError):
        checks.run(spark, "bigen", str(tmp_path / "e"))
    assert {r["kind"]: r["count"] for r in checks.run(spark, "bigen", str(tmp_path / "m"))}["countries"] == 2


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("training:\n  learning_rate: 2e-4\ncurriculum:\n  ratios: [1.0, 0.0]\n")
    c = training.load_config(str(tmp_path / "c.yaml"))
    assert c["training"].learning_rate == 2e-4 and c["curriculum"].ratios == [1.0, 0.0]
    (tmp_path / "c.yaml").write_text("training:\n  nope: 1\n")
    with pytest.raises(TypeError):
        training.load_config(str(tmp_path / "c.yaml"))


def test_training_feed(spark):
    rows = spark.createDataFrame([("a", 0, "1"), ("a_train", 0, "2"), ("a_val_internal", 0, "3"), ("b", 0, "4")], "stem string, line_no int, id string")
    assert {r.id for r in training.training_rows(rows).collect()} == {"2", "4"}
    assert training.training_rows(rows, 1, rows, 1.0).count() == 2


def test_compare(spark):
    schema = "name string, steps_per_sec double, memory_mb double, final_loss double, loss_is_real boolean"
    got = training.compare(spark.createDataFrame([("dora", 2.0, 1.0, 0.5, True), ("qlora", 2.0, 2.0, 0.6, True)], schema)).first()
    assert (got.speed, got.memory, got.loss, got.recommendation) == ("qlora", "dora", "dora", "use_dora")


def test_jvm_images(spark, tmp_path):
    rgb = np.zeros((3, 2, 3), np.uint8)
    rgb[..., 0], rgb[..., 2] = 200, 7
    (tmp_path / "a.png").write_bytes(rasters.write_png(rgb))
    got = images.decode_jvm(spark, str(tmp_path)).first()
    assert (images.unpack(got.image.asDict()) == rgb).all()


def test_stream_resumes(spark, tmp_path):
    from corpusmill.streaming import resume

    source, sink, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    spark.range(5).write.parquet(source)
    schema = spark.range(1).schema
    assert resume.resume(spark, source, schema, lambda b: b, sink, log) == 1
    spark.range(5, 8).write.mode("append").parquet(source)
    assert resume.resume(spark, source, schema, lambda b: b, sink, log) == 1
    assert resume.resume(spark, source, schema, lambda b: b, sink, log) == 0
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(8))

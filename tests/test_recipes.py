"""Recipes end to end on small folders."""

import json

import numpy as np
import pytest
from test_operators import tiff

from corpusmill.functions import rasters
from corpusmill.plans import recipes
from corpusmill.sources import readers


def run(spark, name, root, **k):
    o = recipes.Options(output_dir=str(root / "out"), **k)
    made = recipes.RECIPES[name](spark, str(root), o)
    done = recipes.finish(made)
    return recipes.counters(done).first().asDict(), [r.asDict() for r in recipes.samples(done).collect()], done


def png(path, image):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(rasters.write_png(image))


def test_vrsbench(spark, tmp_path):
    turn = lambda a, b: [{"from": "human", "value": a}, {"from": "gpt", "value": b}]
    entries = [
        {"id": "0", "image": "a.png", "conversations": turn("<image>\n[caption] Describe.", "Nice.")},
        {"id": "1", "image": "a.png", "conversations": turn("<image>\n[refer] Where?", "{<45><45><59><59>}")},
        {"id": "2", "image": "b.png", "conversations": turn("<image>\n[vqa] How many?", "2")},
        {"id": "3", "image": "a.png", "conversations": turn("<image>\n[refer] Where?", "{<59><45><45><59>}")},
    ]
    (tmp_path / "VRSBench_train.json").write_text(json.dumps(entries))
    png(tmp_path / "Images_train" / "a.png", np.zeros((256, 128, 3)))
    counts, rows, _ = run(spark, "vrsbench", tmp_path)
    assert counts == {"processed": 2, "failed": 2, "skipped": 0}  # without an image, and with a bad box
    assert {r["id"] for r in rows} == {"vrsbench_0000000_caption", "vrsbench_0000000_caption_proxy", "vrsbench_0000001_grounding", "vrsbench_0000001_grounding_proxy"}
    small = rasters.read_png((tmp_path / "out/images/a_proxy.png").read_bytes())
    assert small.shape == (64, 32, 3)
    with pytest.raises(FileNotFoundError):
        readers.conversations(spark, str(tmp_path / "nowhere"))


def test_rsvqa(spark, tmp_path):
    (tmp_path / "train.json").write_text(json.dumps({"questions": [{"question_id": 7, "question": "q", "answer": "yes", "image_id": "1"}, {"question_id": 8, "question": "q", "answer": "", "image_id": "1"}]}))
    png(tmp_path / "images/1.png", np.zeros((4, 4)))
    counts, rows, _ = run(spark, "rsvqa_hr", tmp_path)
    assert counts["processed"] == 1 and counts["failed"] == 1 and [r["id"] for r in rows] == ["rsvqa_hr_7", "rsvqa_hr_7_proxy"]
    assert {r["gsd_bucket"] for r in rows} == {"[GSD:0.15m]", "CARTOSAT-proxy[GSD:2m]"}


def test_cdvqa(spark, tmp_path):
    q = {"question": "q", "answer": "a", "before": "x/1.png", "after": "x/2.png"}
    (tmp_path / "train.json").write_text(json.dumps([q]))
    (tmp_path / "val.json").write_text(json.dumps([q, {**q, "after": "x/none.png"}]))
    for k in (1, 2):
        png(tmp_path / f"images/x/{k}.png", np.zeros((4, 4)))
    counts, rows, _ = run(spark, "cdvqa", tmp_path)
    assert counts["processed"] == 2 and counts["failed"] == 1 and {r["id"] for r in rows} == {"cdvqa_0000000", "cdvqa_0000001"}
    assert {r["split"] for r in rows} == {"train"}
    with pytest.raises(ValueError):
        readers.change_questions(spark, str(tmp_path), "test")


def test_levir(spark, tmp_path):
    for k in range(4):
        for d, e in (("A", "_1"), ("B", "_2")):
            png(tmp_path / f"train/{d}/t{k}{e}.png", np.full((32, 32, 3), 9))
        mask = np.zeros((32, 32))
        mask[: 8 * k, :16] = 255
        png(tmp_path / f"train/label/t{k}.png", mask)
    counts, rows, _ = run(spark, "levir_cd", tmp_path, fraction=1.0)
    assert counts["processed"] == 4 and len(rows) == 8
    by = {r["id"]: r for r in rows}
    assert by["levir_t0"]["task"] == "change_vqa" and by["levir_t2"]["bbox"] == [[0.0, 0.0, 468.75, 468.75]]
    assert (tmp_path / "out/images/levir_t1_before.png").exists()


def test_sn6_opt_and_sar(spark, tmp_path):
    for k, n in enumerate((0, 2, 5)):
        (tmp_path / "train/images").mkdir(parents=True, exist_ok=True)
        (tmp_path / "train/labels").mkdir(exist_ok=True)
        (tmp_path / "train/sar").mkdir(exist_ok=True)
        (tmp_path / f"train/images/t{k}.tif").write_bytes(tiff(np.full((32, 32, 3), 5, np.uint16)))
        (tmp_path / f"train/sar/t{k}.tif").write_bytes(tiff(np.full((32, 32), 5, np.uint32)))
        square = lambda i: {"geometry": {"type": "Polygon", "coordinates": [[[i, i], [i + 4, i], [i + 4, i + 4]]]}}
        (tmp_path / f"train/labels/t{k}.geojson").write_text(json.dumps({"features": [square(i) for i in range(n)]}))
    counts, rows, _ = run(spark, "sn6_opt", tmp_path, fraction=1.0)
    assert counts["processed"] == 3 and len(rows) == 6
    assert sorted(r["response"] for r in rows if not r["id"].endswith("_proxy")) == ["0", "2 buildings detected.", "5 buildings detected."]
    optical = spark.createDataFrame([(r["id"], r["image_path"]) for r in rows if "t1" in r["id"]], "id string, image_path array<string>")
    chosen = spark.createDataFrame([("t1",), ("t2",)], "tile string")
    done = recipes.finish(recipes.sn6_sar(spark, str(tmp_path), recipes.Options(output_dir=str(tmp_path / "out2")), optical, chosen))
    assert {r.id for r in recipes.samples(done).collect()} == {"sn6_sar_t1", "sn6_sar_t2", "sn6_fusion_t1"}


def test_oscd(spark, tmp_path):
    for d in ("imgs_1", "imgs_2"):
        for b in ("B02", "B03", "B04", "B08"):
            (tmp_path / f"images/abu-dhabi/{d}").mkdir(parents=True, exist_ok=True)
            (tmp_path / f"images/abu-dhabi/{d}/x_{b}.tif").write_bytes(tiff(np.full((8, 8), 5000, np.uint16)))
    (tmp_path / "images/lone/imgs_1").mkdir(parents=True)
    (tmp_path / "images/lone/imgs_1/x_B02.tif").write_bytes(tiff(np.full((8, 8), 5000, np.uint16)))
    counts, rows, _ = run(spark, "oscd", tmp_path)
    assert counts["processed"] == 1 and rows[0]["id"] == "abu_dhabi" and rows[0]["bbox"] is None
    assert rasters.read_png((tmp_path / "out/images/abu_dhabi_before.png").read_bytes())[0, 0].tolist() == [127, 127, 127]


def test_sardet_and_resume(spark, tmp_path):
    (tmp_path / "labels").mkdir()
    for k in range(5):
        png(tmp_path / f"images/i{k}.png", np.full((32, 32), 9))
    (tmp_path / "labels/i0.txt").write_text("5 .5 .5 .5 .5\n0 .5 .5 .1 .1\n")
    (tmp_path / "labels/i1.txt").write_text("9 .5 .5 .5 .5\n")
    counts, rows, _ = run(spark, "sardet", tmp_path, fraction=1.0)
    assert counts == {"processed": 1, "failed": 4, "skipped": 0} and rows[0]["response"] == "harbor, ship" and len(rows[0]["bbox"]) == 2
    log = spark.createDataFrame([("sardet_i0", True, 1)], "id string, processed boolean, ord int")
    counts, rows, _ = run(spark, "sardet", tmp_path, fraction=1.0, done=log)
    assert counts["processed"] == 0 and not rows


def jpeg(spark, path, size, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(size, size, 10)
    for k in range(size * size):
        image.getRaster().setSample(k % size, k // size, 0, value)
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(path)))


def test_sardet_jpeg(spark, tmp_path):
    """JPEGs give samples, damaged files count as failed, and a PNG holds before a JPEG of its name."""
    tmp_path = tmp_path / "a b+%"
    (tmp_path / "labels").mkdir(parents=True)
    for name in ("j0", "j1", "both", "cut", "empty_boxes", "text", "half"):
        (tmp_path / f"labels/{name}.txt").write_text("0 .5 .5 .5 .5\n" * (name != "empty_boxes"))
    for name in ("j0.jpg", "j1.JPG", "empty_boxes.jpg", "both.jpg", "half.jpg"):
        jpeg(spark, tmp_path / "images" / name, 32, 90)
    png(tmp_path / "images/both.png", np.full((64, 64), 9))
    (tmp_path / "images/half.png").write_bytes(b"no image")
    (tmp_path / "images/cut.jpg").write_bytes((tmp_path / "images/j1.JPG").read_bytes()[:180])
    (tmp_path / "images/text.jpg").write_text("no image")
    counts, rows, _ = run(spark, "sardet", tmp_path, fraction=1.0)
    assert counts == {"processed": 4, "failed": 3, "skipped": 0}
    assert {r["id"] for r in rows} == {"sardet_j0", "sardet_j1", "sardet_both", "sardet_half"} and all(r["bbox"] == [[250.0, 250.0, 750.0, 750.0]] for r in rows)
    sizes = {n: rasters.read_png((tmp_path / f"out/images/sardet_{n}.png").read_bytes()).shape[:2] for n in ("j0", "both", "half")}
    assert sizes == {"j0": (32, 32), "both": (64, 64), "half": (32, 32)}


def test_sen2lulc(spark, tmp_path):
    (tmp_path / "metadata.csv").write_text("image_id,label\n" + "".join(f"i{k},{k % 2}\n" for k in range(20)) + "rare,6\n")
    png(tmp_path / "images/rare.png", np.zeros((4, 4)))
    counts, rows, _ = run(spark, "sen2lulc", tmp_path, fraction=0.1)
    assert counts == {"processed": 1, "failed": 2, "skipped": 0} and rows[0]["response"] == "Wetland"


def test_bigen(spark, tmp_path):
    spark.createDataFrame([("p0", [0, 11]), ("p1", [2]), ("p2", []), ("p3", [1])], "patch_id string, labels array<long>").coalesce(1).write.parquet(str(tmp_path / "metadata.parquet"))
    for sub, shape in (("s2_npy", (12, 16, 16)), ("s1_npy", (2, 16, 16))):
        (tmp_path / sub).mkdir()
        for p in ("p0", "p2") if sub == "s2_npy" else ("p0",):
            np.save(tmp_path / sub / f"{p}.npy", np.full(shape, 0.05 if sub == "s1_npy" else 700).astype(np.float32 if sub == "s1_npy" else np.uint16))
    (tmp_path / "s2_npy/p3.npy").write_bytes(b"no array")
    counts, rows, _ = run(spark, "bigen", tmp_path)
    assert counts == {"processed": 1, "failed": 3, "skipped": 0}
    assert [r["id"] for r in rows] == ["bigen_00000000", "bigen_00000000_sar", "bigen_00000000_fusion"]
    assert rows[0]["response"] == "Continuous urban fabric, Non-irrigated arable land"
    assert [p.rsplit("/", 1)[1] for p in rows[2]["image_path"]] == ["bigen_00000000_optical.png", "bigen_00000000_sar.png"]
    sizes = {end: rasters.read_png((tmp_path / f"out/images/bigen_00000000_{end}.png").read_bytes()).shape for end in ("optical", "sar", "concat")}
    assert sizes == {"optical": (16, 16, 3), "sar": (16, 16, 3), "concat": (16, 34, 3)}


def test_sen2lulc_masks(spark, tmp_path):
    """With masks rows get boxes, which the rules of their task refuse; without, they pass."""
    (tmp_path / "metadata.csv").write_text("image_id,label\na,1\n,2\n")
    png(tmp_path / "img/a.png", np.zeros((4, 4)))
    mask = np.full((10, 10), 9)
    mask[2:4, 5:8] = 3
    png(tmp_path / "masks/a.png", mask)
    counts, rows, _ = run(spark, "sen2lulc", tmp_path, fraction=1.0)
    assert counts == {"processed": 1, "failed": 1, "skipped": 0} and rows[0]["id"] == "sen2lulc_a" and rows[0]["response"] == "Vegetation"
    made = recipes.sen2lulc(spark, str(tmp_path), recipes.Options(fraction=1.0, masks=True)).filter("source_id = 'sen2lulc_a'").first()
    assert made.rows[0].bbox == [[500.0, 200.0, 700.0, 300.0]]
    assert run(spark, "sen2lulc", tmp_path, fraction=1.0, masks=True)[0]["processed"] == 0


def test_sn6_sar_fusion_picture(spark, tmp_path):
    (tmp_path / "Sentinel-1").mkdir()
    (tmp_path / "Sentinel-1/t1.tif").write_bytes(tiff(np.full((8, 8), 5, np.uint32)))
    png(tmp_path / "opt/sn6_t1.png", np.zeros((8, 8)))
    optical = spark.createDataFrame([("sn6_t1", [str(tmp_path / "opt/sn6_t1.png")])], "id string, image_path array<string>")
    chosen = spark.createDataFrame([("t1",)], "tile string")
    done = recipes.finish(recipes.sn6_sar(spark, str(tmp_path), recipes.Options(output_dir=str(tmp_path / "out")), optical, chosen))
    assert {r.id for r in recipes.samples(done).collect()} == {"sn6_sar_t1", "sn6_fusion_t1"}
    assert rasters.read_png((tmp_path / "out/images/sn6_fusion_t1.png").read_bytes()).shape == (8, 18, 3)


def test_bigen_pictures_take_every_patch(spark, monkeypatch):
    """The recipe's own limit of 60,000 patches isn't the query's: it says how many it has, in the order of their ids."""
    from corpusmill.plans import catalog, catalog_files  # noqa: F401  (registers the query)

    said = []
    bigen = recipes.RECIPES["bigen"]

    def watched(spark, root, o):
        said.append((o.max_samples, spark.read.parquet(f"{root}/metadata.parquet").count()))
        return bigen(spark, root, o)

    monkeypatch.setitem(recipes.RECIPES, "bigen", watched)
    catalog.QUERIES["pictures_bigen"](spark, "/root/testdata/sf0.001")
    ((most, patches),) = said
    assert most == patches > 0

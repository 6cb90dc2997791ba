"""Sample rows of the sources as column expressions. The texts of instructions and responses, which are part of the sample format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import boxes, gsd, text
from ..schema import BOXES, FIELDS


def sample(id: Column, dataset: str, task: Column | str, images: Column, instruction: Column | str, response: Column, *, pair: str = "single", modality: str = "optical", bbox: Column | None = None, bucket: Column | None = None) -> Column:
    """A sample as a struct in field order."""
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    values = {
        "id": id,
        "dataset": F.lit(dataset),
        "task": lit(task),
        "image_path": images.cast("array<string>"),
        "pair_type": F.lit(pair),
        "gsd_bucket": gsd.bucket(F.lit(dataset)) if bucket is None else bucket,
        "split": F.lit("train"),
        "instruction": lit(instruction),
        "response": lit(response),
        "bbox": F.lit(None).cast(BOXES) if bbox is None else bbox.cast(BOXES),
        "modality": F.lit(modality),
    }
    return F.struct(*[values[f].alias(f) for f in FIELDS])


def one_image(path: Column) -> Column:
    """[path], or no image if there is none."""
    return F.when(path.isNull() | (path == ""), F.array().cast("array<string>")).otherwise(F.array(path))


def with_proxy(row: Column, path: Column | None = None) -> Column:
    """The sample and its proxy; the proxy's image is ``path`` where that is not null."""
    images = row["image_path"] if path is None else F.when(path.isNotNull(), F.array(path)).otherwise(row["image_path"])
    proxy = row.withField("id", F.concat(row["id"], F.lit("_proxy"))).withField("gsd_bucket", gsd.proxy_bucket(row["modality"])).withField("image_path", images)
    return F.array(row, proxy)


def conversation_rows(position: Column, turns: Column, image: Column, proxy: Column | None = None) -> Column:
    """Caption, grounding or question; no row for an unknown task, an empty text or a bad box."""
    parsed = text.parse_conversation(turns)
    box = boxes.referring_box(parsed["response"])
    task = F.when(parsed["task"] == "refer", "grounding").otherwise(parsed["task"])
    fine = (parsed["task"] != "unknown") & (parsed["instruction"] != "") & (F.coalesce(parsed["response"], F.lit("")) != "") & ((parsed["task"] != "refer") | box.isNotNull())
    id = F.concat(text.padded(position, 7, "vrsbench_", "_"), task)
    row = sample(id, "vrsbench", task, one_image(image), parsed["instruction"], parsed["response"], bbox=F.when(parsed["task"] == "refer", box))
    return F.when(fine, F.when(F.coalesce(image, F.lit("")) != "", with_proxy(row, proxy)).otherwise(F.array(row)))


def question_rows(id: Column, question: Column, answer: Column, image: Column, proxy: Column | None = None) -> Column:
    row = sample(id, "rsvqa_hr", "vqa", one_image(image), question, answer)
    fine = (F.coalesce(question, F.lit("")) != "") & (F.coalesce(answer, F.lit("")) != "")
    return F.when(fine, F.when(F.coalesce(image, F.lit("")) != "", with_proxy(row, proxy)).otherwise(F.array(row)))


def change_question_rows(id: Column, question: Column, answer: Column, before: Column, after: Column) -> Column:
    """A missing file is an empty path, which validation refuses."""
    row = sample(id, "cdvqa", "change_vqa", F.array(F.coalesce(before, F.lit("")), F.coalesce(after, F.lit(""))), question, answer, pair="bitemporal")
    return F.when((F.coalesce(question, F.lit("")) != "") & (F.coalesce(answer, F.lit("")) != ""), F.array(row))


def change_pair_rows(base: Column, before: Column, after: Column, bbox: Column, proxy: bool = True) -> Column:
    task = F.when(bbox.isNotNull(), "change_grounding").otherwise("change_vqa")
    row = sample(F.concat(F.lit("levir_"), base), "levir_cd", task, F.array(before, after), "What building changes occurred between these two dates?", F.concat(F.lit("Building changes detected in "), base, F.lit(".")), pair="bitemporal", bbox=bbox)
    return with_proxy(row) if proxy else F.array(row)


def building_rows(tile: Column, image: Column, found: Column) -> Column:
    """Grounding with the count of buildings, or the question for it if there is none."""
    n = F.size(found)
    some = n > 0
    said = F.concat(n.cast("string"), F.lit(" building"), F.when(n != 1, "s").otherwise(""), F.lit(" detected."))
    row = sample(F.concat(F.lit("sn6_"), tile), "sn6_opt", F.when(some, "grounding").otherwise("vqa"), F.array(image), F.when(some, "Locate the buildings in this image.").otherwise("How many buildings are in this image?"), F.when(some, said).otherwise("0"), bbox=F.when(some, found))
    return with_proxy(row)


def location_rows(location: Column, before: Column, after: Column) -> Column:
    return F.array(sample(text.location_id(location), "oscd", "change_vqa", F.array(before, after), "What changed between the two dates?", F.concat(F.lit("Change detected in "), location, F.lit(".")), pair="bitemporal"))


def detection_rows(id: Column, image: Column, found: Column) -> Column:
    """found: array of (class_name, bbox); no row without any. Names are sorted."""
    names = F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["class_name"]))), ", ")
    row = sample(id, "sardet", "grounding", F.array(image), "Locate the objects in this SAR image.", names, modality="sar", bbox=F.transform(found, lambda x: x["bbox"]))
    return F.when(F.size(found) > 0, F.array(row))


def radar_tile_rows(tile: Column, image: Column, optical: Column) -> Column:
    """The radar row, and a fusion row if there is an optical image."""
    sar = sample(F.concat(F.lit("sn6_sar_"), tile), "sn6_sar", "vqa", F.array(image), "Describe the SAR characteristics of this scene.", F.concat(F.lit("SAR image of "), tile, F.lit(" showing surface scattering properties.")), modality="sar")
    both = sample(F.concat(F.lit("sn6_fusion_"), tile), "sn6_sar", "fusion_vqa", F.array(optical, image), "Using both the optical and SAR images, describe this scene's surface conditions.", F.concat(F.lit("Optical and SAR imagery of "), tile, F.lit(" show consistent surface conditions across both sensors.")), pair="cross-modal", modality="optical+sar")
    return F.array_compact(F.array(sar, F.when(optical.isNotNull(), both)))


def land_cover_rows(id: Column, image: Column, label: Column, bbox: Column | None = None) -> Column:
    """Boxes are left out by default: a question's row must not have any."""
    return F.array(sample(id, "sen2lulc", "vqa", one_image(image), "What is the primary land cover type in this image?", text.land_cover(label), bbox=bbox))


def patch_rows(position: Column, labels: Column, optical: Column, radar: Column) -> Column:
    """Optical, and where there is a radar image radar and fusion too; no row without an active class."""
    names = text.active_classes(text.multihot(labels))
    id = text.padded(position, 8, "bigen_")
    row = sample(id, "bigen", "vqa", F.array(optical), "What land cover types are present in this image?", names)
    sar = sample(F.concat(id, F.lit("_sar")), "bigen", "vqa", F.array(radar), "Describe the SAR backscatter characteristics of this scene.", F.concat(F.lit("SAR backscatter over a scene classified optically as: "), names, F.lit(".")), modality="sar")
    both = sample(F.concat(id, F.lit("_fusion")), "bigen", "fusion_vqa", F.array(optical, radar), "Using both the optical and SAR images, describe this scene's land cover and surface conditions.", F.concat(F.lit("Optical imagery shows: "), names, F.lit(". SAR backscatter is consistent with these cover types.")), pair="cross-modal", modality="optical+sar")
    return F.when(names.isNotNull(), F.array_compact(F.array(row, F.when(radar.isNotNull(), sar), F.when(radar.isNotNull(), both))))

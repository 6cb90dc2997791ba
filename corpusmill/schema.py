"""The sample schema, its value sets, and the taxonomies of the sources."""

from __future__ import annotations

from pyspark.sql import types as T

# The sample format and the class lists.
DATASETS = ("bigen", "vrsbench", "rsvqa_hr", "cdvqa", "levir_cd", "sn6_opt", "oscd", "sardet", "sn6_sar", "sen2lulc")
TASKS = ("vqa", "caption", "grounding", "change_vqa", "change_grounding", "fusion_vqa", "fusion_grounding")
GROUNDING_TASKS = ("grounding", "change_grounding", "fusion_grounding")
ANSWER_TASKS = ("vqa", "caption", "change_vqa", "fusion_vqa")
PAIR_TYPES = ("single", "bitemporal", "cross-modal")
SPLITS = ("train", "val_internal")
MODALITIES = ("optical", "sar", "optical+sar")
SAR_CATEGORIES = ("ship", "aircraft", "bridge", "tank", "car", "harbor")
LAND_COVER = ("Built-up", "Vegetation", "Water", "Barren", "Agriculture", "Forest", "Wetland")
CORINE = (
    "Continuous urban fabric",
    "Discontinuous urban fabric",
    "Industrial or commercial units",
    "Road and rail networks and associated land",
    "Port areas",
    "Airports",
    "Mineral extraction sites",
    "Dump sites",
    "Construction sites",
    "Green urban areas",
    "Sports and leisure facilities",
    "Non-irrigated arable land",
    "Permanently irrigated land",
    "Rice fields",
    "Vineyards",
    "Fruit trees and berry plantations",
    "Pastures",
    "Annual crops associated with permanent crops",
    "Complex cultivation patterns",
)
RGB_BANDS = ("B04", "B03", "B02")
# Native resolution buckets of sources with one known resolution.
NATIVE_BUCKETS = {
    "rsvqa_hr": "[GSD:0.15m]",
    "sn6_opt": "[GSD:0.5m]",
    "levir_cd": "[GSD:0.5m]",
    "sn6_sar": "[GSD:0.5m]",
    "sardet": "[GSD:5m]",
    "bigen": "[GSD:10m]",
    "oscd": "[GSD:10m]",
    "sen2lulc": "[GSD:10m]",
}

BOX = T.ArrayType(T.DoubleType())
BOXES = T.ArrayType(BOX)
SAMPLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("image_path", T.ArrayType(T.StringType())),
        T.StructField("pair_type", T.StringType()),
        T.StructField("gsd_bucket", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("bbox", BOXES),
        T.StructField("modality", T.StringType()),
    ]
)
FIELDS = tuple(SAMPLE.fieldNames())
MANIFEST = T.StructType([T.StructField("id", T.StringType()), T.StructField("dataset", T.StringType()), T.StructField("split", T.StringType()), T.StructField("processed", T.BooleanType()), T.StructField("output_shard", T.StringType())])

"""Arrow functions over rasters: a raster is a struct (h, w, bands, dtype, data), its bytes in (h, w, bands) order."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rasters
from .tables import few_rows

for _m in (__name__, rasters.__name__):
    cloudpickle.register_pickle_by_value(sys.modules[_m])

RASTER = T.StructType([T.StructField("h", T.IntegerType()), T.StructField("w", T.IntegerType()), T.StructField("bands", T.IntegerType()), T.StructField("dtype", T.StringType()), T.StructField("data", T.BinaryType())])


def pack(image: np.ndarray) -> dict:
    image = np.ascontiguousarray(image if image.ndim == 3 else image[:, :, None])
    return {"h": image.shape[0], "w": image.shape[1], "bands": image.shape[2], "dtype": image.dtype.str, "data": image.tobytes()}


def unpack(raster: dict) -> np.ndarray:
    image = np.frombuffer(raster["data"], raster["dtype"]).reshape(raster["h"], raster["w"], raster["bands"])
    return image[:, :, 0] if raster["bands"] == 1 else image


#: Bytes of input that are turned into Python objects at a time (a larger image alone), of results that are held, and rows at most.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 1000
#: Bytes of a batch (or one row) that Spark hands to a Python worker, where the session doesn't say.
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def slices(batches):
    """Slices of Arrow batches of about SLICE_BYTES: images come by the thousand, but a few at a time are unpacked."""
    for b in batches:
        rows = min(SLICE_ROWS, max(1, int(SLICE_BYTES / max(1, b.nbytes / max(1, b.num_rows)))))
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def _weight(value) -> int:
    """About the bytes of a result as a Python object."""
    if isinstance(value, dict):
        return sum(_weight(v) for v in value.values())
    return len(value) if isinstance(value, bytes) else 40 * len(value) if isinstance(value, list) else getattr(value, "nbytes", 40)


def map_images(df: DataFrame, inputs: list[str], out: str, kind: T.DataType, function: Callable) -> DataFrame:
    """Adds a column: function of the input columns, row by row in Arrow batches; null where an input is null or it fails.

    ``error`` has the failure's text. Rasters come as arrays; an array that is returned is packed. Each call that stands in a stage has a
    Python worker of its own for every task, so steps that follow each other are one function.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, str(SLICE_BYTES))
    schema = T.StructType([*df.schema.fields, T.StructField(out, kind), T.StructField("error", T.StringType())])
    raster = [df.schema[c].dataType == RASTER for c in inputs]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        for b in slices(batches):
            values, failures, first, size = [], [], 0, 0

            def batch(rows):
                return pa.RecordBatch.from_arrays([*rows.columns, pa.array(values, to_arrow_type(kind)), pa.array(failures, pa.string())], names=[*rows.schema.names, out, "error"])

            for k, row in enumerate(zip(*(b.column(c).to_pylist() for c in inputs), strict=True)):
                value = failure = None
                if all(x is not None for x in row):
                    try:
                        value = function(*(unpack(x) if r else x for x, r in zip(row, raster, strict=True)))
                        value = pack(value) if isinstance(value, np.ndarray) else value
                    except Exception as e:  # a bad file is an outcome, not the end of the run
                        value, failure = None, f"{type(e).__name__}: {e}"
                values.append(value)
                failures.append(failure)
                size += _weight(value)
                if size >= SLICE_BYTES:
                    yield batch(b.slice(first, k + 1 - first))
                    values, failures, first, size = [], [], k + 1, 0
            if values:
                yield batch(b.slice(first))

    return df.mapInArrow(run, schema)


def read(name: str, data: bytes) -> np.ndarray:
    """The raster of an npy, TIFF or PNG file, by its name's ending."""
    if name.endswith(".npy"):
        return np.moveaxis(x, 0, -1) if (x := rasters.read_npy(data)).ndim == 3 else x
    return rasters.read_png(data) if name.lower().endswith(".png") else rasters.read_tiff(data)


def decode(files: DataFrame, content: str = "content", path: str = "path", out: str = "image") -> DataFrame:
    """Rasters of npy, TIFF and PNG files by their names' endings."""
    return map_images(files, [path, content], out, RASTER, read)


def see(files: DataFrame, out: str, kind: T.DataType, function: Callable, content: str = "content", path: str = "path") -> DataFrame:
    """Adds what a function says of the decoded files; the rasters themselves stay in the tasks."""
    return map_images(files, [path, content], out, kind, lambda name, data: function(read(name, data)))


#: Paths that the JVM's image source is given one by one at most; beyond it the folder is scanned.
MOST_PATHS = 20_000


def decode_jvm(spark, path: str, glob: str = "*", among: DataFrame | None = None, out: str = "image", kind: T.DataType = RASTER, function: Callable = lambda a: a) -> DataFrame:
    """path and image (gray or RGB), or what a function makes of it, of 8-bit files that the JVM decodes, JPEG among them; files it can't
    read are left out.

    ``among`` (path): only these files are read, or, if they are more than MOST_PATHS, reach Python.
    """
    where: str | list[str] = path
    if among is not None and few_rows(among, MOST_PATHS):
        # names are no globs
        where = [re.sub(r"([\\{}\[\]*?])", r"\\\1", r[0]) for r in among.select("path").distinct().collect()]
        if not where:
            return spark.createDataFrame([], T.StructType([T.StructField("path", T.StringType()), T.StructField(out, kind)]))
    # a damaged JPEG is an IOException of the decoder, which dropInvalid doesn't cover
    files = spark.read.format("image").option("dropInvalid", True).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).option("pathGlobFilter", glob).load(where)
    # origins are percent-encoded, paths of listings aren't
    plain = F.url_decode(F.replace(F.col("image.origin"), F.lit("+"), F.lit("%2B")))
    flat = files.select(F.regexp_replace(plain, "^file:///", "file:/").alias("path"), F.struct(F.col("image.height").alias("h"), F.col("image.width").alias("w"), F.col("image.nChannels").alias("bands"), F.lit("|u1").alias("dtype"), F.col("image.data").alias("data")).cast(RASTER).alias("raw"))
    flat = flat if among is None else flat.join(among, "path", "left_semi")
    # channels are stored blue, green, red
    swap = lambda a: a if a.ndim == 2 else np.ascontiguousarray(a[:, :, 2::-1])
    return map_images(flat, ["raw"], out, kind, lambda a: function(swap(a))).drop("raw", "error")


def decode_any(spark, folder: str, wanted: DataFrame, by_jvm: tuple[str, ...] = ("jpg", "jpeg"), out: str = "image", kind: T.DataType = RASTER, function: Callable = lambda a: a) -> DataFrame:
    """wanted (path and others) with the image of the files in a folder that can be read, or what a function makes of it: JPEGs through
    the JVM, others here. Files that can't be read have a null image or no row; files that aren't wanted aren't opened."""
    from ..sources import stores

    if not stores.exists(spark, folder):
        return wanted.withColumn(out, F.lit(None).cast(kind))
    ext = F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))
    jpeg = wanted.filter(ext.isin(*by_jvm))
    rest = stores.contents_of(spark, wanted.filter(~ext.isin(*by_jvm)), "path", folder).drop("error")
    here = see(rest, out, kind, function).drop("content", "error")
    if not jpeg.limit(1).count():
        return here
    return here.unionByName(decode_jvm(spark, folder, "*", jpeg.select("path"), out, kind, function).join(jpeg, "path"))


def encode(images: DataFrame, image: str = "image", out: str = "png", level: int = 6) -> DataFrame:
    return map_images(images, [image], out, T.BinaryType(), lambda x: rasters.write_png(x, level))


def of_values(v: list, height: int, width: int, dtype: str = "<f4") -> np.ndarray:
    return np.asarray(v[: height * width], dtype).reshape(height, width)


def from_values(df: DataFrame, values: str, height: int, width: int, dtype: str = "<f4", out: str = "image", kind: T.DataType = RASTER, function: Callable = lambda a: a) -> DataFrame:
    """Rasters of arrays of numbers, or what a function makes of them."""
    return map_images(df, [values], out, kind, lambda v: function(of_values(v, height, width, dtype))).drop("error")


def pixels(images: DataFrame, inputs: str | list[str] = "image", function: Callable = lambda a: a) -> DataFrame:
    """y, x, v rows of single-plane rasters, or of those a function makes of the input columns, beside the other columns."""
    inputs = [inputs] if isinstance(inputs, str) else inputs

    def flat(*row):
        a = function(*row)
        return {"w": a.shape[1], "v": np.asarray(a, float).ravel()}

    kind = T.StructType([T.StructField("w", T.IntegerType()), T.StructField("v", T.ArrayType(T.DoubleType()))])
    planes = map_images(images, inputs, "_p", kind, flat).drop("error", *inputs)
    out = planes.select("*", F.posexplode("_p.v").alias("_i", "v")).withColumn("y", F.floor(F.col("_i") / F.col("_p.w")).cast("int")).withColumn("x", (F.col("_i") % F.col("_p.w")).cast("int"))
    return out.drop("_p", "_i")

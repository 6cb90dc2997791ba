"""Files by the file system of their path, from within tasks: listing folders level by level, reading chosen files."""

from __future__ import annotations

import itertools
import os
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tables import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Path schemes whose file systems tasks can open by themselves; others (such as viewfs) only Spark reads.
OPENED = ("file", "s3", "s3a", "gs", "gcs", "abfs", "abfss", "hdfs")
#: Bytes of contents that are handed on at a time (a larger file alone).
BATCH_BYTES = 4 << 20


def scheme(path: str) -> str:
    return m[1] if (m := re.match(r"([A-Za-z][A-Za-z0-9+.-]*):/", path)) else "file"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system that Spark uses for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def resolve(path: str):
    """File system and inner path, local or in an object store; used on the executors."""
    from pyarrow import fs

    if scheme(path) == "file":  # a plain path, whatever characters it has
        return fs.LocalFileSystem(), re.sub("^(file:)?/+", "/", path)
    head, _, rest = path.partition("://")
    bucket, _, inner = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{'s3' if head == 's3a' else head}://{bucket}")
    return store, f"{base}/{inner}" if base not in ("", "/") else f"/{inner}"


def _outer(path: str, base: str, inner: str) -> str:
    """The name of a found file in the form of the path that was asked for, as Spark writes it."""
    return f"file:{inner}" if scheme(path) == "file" else path.rstrip("/") + inner[len(base) :]


def _entries(path: str):
    """Path, whether it is a folder, and size of what a folder holds; a local one is read entry by entry, however many it has."""
    from pyarrow import fs

    store, base = resolve(path)
    base = base.rstrip("/") or "/"
    if scheme(path) != "file":
        for x in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            yield _outer(path, base, x.path), x.type == fs.FileType.Directory, x.size
    elif os.path.isdir(base):
        with os.scandir(base) as found:
            for x in found:
                folder = x.is_dir()
                yield _outer(path, base, x.path), folder, None if folder or not os.path.exists(x.path) else x.stat().st_size


def _level(folders: DataFrame) -> DataFrame:
    """path, folder (whether it is one) and size of what the folders (path) hold."""

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                found = _entries(path)
                while part := list(itertools.islice(found, 20_000)):
                    names, folder, sizes = zip(*part, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(folder, pa.bool_()), pa.array(sizes, pa.int64())], names=["path", "folder", "size"])

    return folders.mapInArrow(run, "path string, folder boolean, size long")


def _by_driver(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    """The same by Spark's own file system, for paths that tasks can't open: one listing, on the driver."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found, files = store.listFiles(p, recursive), []
    while found.hasNext():
        f = found.next()
        files.append((f.getPath().toString(), f.getLen()))
    return spark.createDataFrame(files, "path string, size long")


def files_below(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """path and size of the files in a folder, empty and hidden ones too; none if it isn't there.

    Folders are rows: tasks list those of a level and hand on the ones of the next, so the driver sees no names. A folder is listed by
    one task, and its files are then dealt out, so that what follows isn't left to that task.
    """
    if scheme(path) not in OPENED:
        return _by_driver(spark, path, recursive)
    slots = spark.sparkContext.defaultParallelism
    level = _level(spark.createDataFrame([(path,)], "path string"))
    if not recursive:
        return level.filter("NOT folder").select("path", "size").repartition(slots, "path")
    level = materialise(level)
    out = level.filter("NOT folder").select("path", "size")
    while (below := level.filter("folder").select("path")).limit(1).count():
        level = materialise(_level(below.repartition(slots, "path")))
        out = out.unionByName(level.filter("NOT folder").select("path", "size"))
    return out


def read_selected(files: DataFrame, path: str = "path", out: str = "content", meter=None) -> DataFrame:
    """Adds the content of the files that the rows name, and error: only these files are opened, by the tasks that hold their names.

    A file that can't be read has null content. ``meter`` is an accumulator that gets the bytes that were read.
    """
    columns = files.columns
    schema = T.StructType([*files.schema.fields, T.StructField(out, T.BinaryType()), T.StructField("error", T.StringType())])

    def run(batches):
        def batch(rows, contents, errors):
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())], names=[*columns, out, "error"])

        for b in batches:
            contents, errors, first, size = [], [], 0, 0
            for k, name in enumerate(b.column(path).to_pylist()):
                data = error = None
                if name is not None:
                    try:
                        store, inner = resolve(name)
                        with store.open_input_stream(inner, compression=None) as f:
                            data = f.read()
                    except Exception as e:  # a lost file is an outcome, not the end of the run
                        error = f"{type(e).__name__}: {e}"
                contents.append(data)
                errors.append(error)
                size += len(data or b"")
                if meter is not None:
                    meter.add(len(data or b""))
                if size >= BATCH_BYTES:
                    yield batch(b.slice(first, k + 1 - first), contents, errors)
                    contents, errors, first, size = [], [], k + 1, 0
            if contents:
                yield batch(b.slice(first), contents, errors)

    # names are few bytes: they are dealt out, so that reading is shared however few rows there are
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism, path).mapInArrow(run, schema)


def contents_of(spark: SparkSession, files: DataFrame, path: str = "path", folder: str | None = None, glob: str = "*", recursive: bool = False) -> DataFrame:
    """files with content and error. In a ``folder`` whose file system only Spark can open, its files are scanned and joined."""
    if folder is None or scheme(folder) in OPENED:
        return read_selected(files, path)
    every = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.join(every.select(F.col("path").alias(path), "content"), path, "left").withColumn("error", F.lit(None).cast("string"))

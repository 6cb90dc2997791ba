"""Sinks: JSON lines, image files, compressed tars by shard, small JSON reports."""

from __future__ import annotations

import dataclasses
import io
import json
import sys
import tarfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators import corpus
from ..operators.tables import delete
from ..schema import FIELDS
from . import stores
from .stores import resolve

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def json_line():
    """A sample as one line; null boxes are kept."""
    return F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"})


def write_jsonl(samples: DataFrame, path: str, append: bool = False) -> None:
    """Overwrites by default; ``append`` adds files."""
    samples.select(json_line().alias("value")).write.mode("append" if append else "overwrite").text(path)


def write_split(samples: DataFrame, path: str) -> None:
    """One folder per split; a run again gives the same."""
    samples.select("split", json_line().alias("value")).write.mode("overwrite").partitionBy("split").text(path)


def _attempt() -> str:
    """A name of this attempt of a task: another attempt of it writes to a folder of its own."""
    from pyspark import TaskContext

    at = TaskContext.get()
    return f"{at.stageId()}-{at.taskAttemptId()}" if at else uuid.uuid4().hex


def write_files(files: DataFrame, path: str, content: str, folder: str) -> None:
    """Write each row's bytes to folder/path, by the file system of the folder; a file is whole or isn't there.

    Files are begun in a staging folder and moved; it goes at the end, with what failed attempts have left in it.
    """
    staging = f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex}"

    def run(rows):
        (store, base), (_, begun) = resolve(folder), resolve(f"{staging}/{_attempt()}")
        base, made = base.rstrip("/"), set()
        store.create_dir(begun, recursive=True)
        for k, r in enumerate(rows):
            target = f"{base}/{r[path]}"
            above = target.rsplit("/", 1)[0]
            if above not in made:
                store.create_dir(above, recursive=True)
                made.add(above)
            with store.open_output_stream(f"{begun}/{k}", compression=None) as out:
                out.write(r[content])
            store.move(f"{begun}/{k}", target)

    try:
        files.select(path, content).foreachPartition(run)
    finally:
        delete(files.sparkSession, staging)


@dataclasses.dataclass
class _Written(WriterCommitMessage):
    """What a task has written: shard, number of files and staged name of each tar."""

    tars: list[tuple[int, int, str]]


class _ShardWriter(DataSourceArrowWriter):
    """Tars in a staging folder; commit moves those of the attempts that count and records their numbers, abort leaves nothing."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.prefix, self.token = options["folder"].rstrip("/"), options["prefix"], options["token"]
        self.flat = options["flat"] == "true"

    @property
    def staging(self) -> str:
        return f"{self.folder}/_staging-{self.token}"

    def write(self, iterator) -> _Written:
        """Rows sorted by shard and place: shard, path, and content, or the path of the file that holds it in ``source``."""
        store, begun = resolve(f"{self.staging}/{_attempt()}")
        store.create_dir(begun, recursive=True)
        written, tar, out = [], None, None

        def close():
            tar.close()
            out.close()

        for b in iterator:
            names = b.schema.names
            for k in range(b.num_rows):
                row = {c: b.column(c)[k].as_py() for c in names}
                if not written or row["shard"] != written[-1][0]:
                    if tar:
                        close()
                    at = f"{begun}/{row['shard']}.tar.gz"
                    out = store.open_output_stream(at, compression=None)
                    tar = tarfile.open(fileobj=out, mode="w|gz")
                    written.append([row["shard"], 0, f"{self.staging}/{at.rsplit('/', 2)[1]}/{row['shard']}.tar.gz"])
                info = tarfile.TarInfo(row["path"].rsplit("/", 1)[-1] if self.flat else row["path"])
                if "source" in row:  # the file goes from its store to the tar as a stream
                    home, inner = resolve(row["source"])
                    info.size = home.get_file_info(inner).size
                    with home.open_input_stream(inner, compression=None) as data:
                        tar.addfile(info, data)
                else:
                    info.size = len(row["content"])
                    tar.addfile(info, io.BytesIO(row["content"]))
                written[-1][1] += 1
        if tar:
            close()
        return _Written([tuple(x) for x in written])

    def commit(self, messages) -> None:
        store, base = resolve(self.folder)
        base = base.rstrip("/")
        counts = []
        for shard, n, staged in sorted(t for m in messages if m is not None for t in m.tars):
            name = f"{self.prefix}_shard_{shard:04d}.tar.gz"
            store.move(resolve(staged)[1], f"{base}/{name}")
            counts.append({"shard": shard, "files": n, "tar": name})
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{self.prefix}_shards.jsonl", compression=None) as out:
            out.write("".join(json.dumps(c) + "\n" for c in counts).encode())
        self._clear(store)

    def abort(self, messages) -> None:
        self._clear(resolve(self.folder)[0])

    def _clear(self, store) -> None:
        at = resolve(self.staging)[1]
        if store.get_file_info(at).type.name == "Directory":
            store.delete_dir(at)


class ShardSink(DataSource):
    """Spark's format ``corpusmill_shards``: compressed tars, all or none."""

    @classmethod
    def name(cls) -> str:
        return "corpusmill_shards"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _ShardWriter(self.options)


def _pack(rows: DataFrame, folder: str, prefix: str, flat: bool) -> DataFrame:
    """Write rows (shard, place, path, content or source) as tars; the counts are those of the commit."""
    spark, token = rows.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(ShardSink)
    dealt = rows.repartition("shard").sortWithinPartitions("shard", "place").drop("place")
    try:
        dealt.write.format("corpusmill_shards").options(folder=folder, prefix=prefix, flat=str(flat).lower(), token=token).mode("append").save()
    finally:
        delete(spark, f"{folder.rstrip('/')}/_staging-{token}")
    return spark.read.schema("shard long, files long, tar string").json(f"{folder.rstrip('/')}/{prefix}_shards.jsonl")


def write_shards(files: DataFrame, folder: str, prefix: str, capacity: int = 2000, flat: bool = True) -> DataFrame:
    """Gzip tars <prefix>_shard_<4 digits>.tar.gz of at most ``capacity`` files each; files: path, content. Returns shard, files and tar.

    A shard is written by one task into a staging folder; tars appear together when all tasks are done, and not at all if one fails.
    """
    numbered = corpus.shard_assign(files.select("path"), ["path"], capacity)
    return _pack(files.select("path", "content").join(numbered, "path"), folder, prefix, flat)


def write_folder_shards(spark, source: str, folder: str, prefix: str, capacity: int = 2000, skip: str = ".jsonl") -> DataFrame:
    """Shards of all files below a folder in path order, empty and hidden ones too, without those of the ending ``skip``.

    Tasks list the folders, and the task that writes a shard reads its files: only names are dealt out.
    """
    names = stores.files_below(spark, source).select("path").filter(~F.endswith("path", F.lit(skip)))
    numbered = corpus.shard_assign(names, ["path"], capacity)
    if stores.scheme(source) in stores.OPENED:
        return _pack(numbered.withColumn("source", F.col("path")), folder, prefix, True)
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path", "content")
    return _pack(numbered.join(plain, "path", "left").withColumn("content", F.coalesce("content", F.lit(b""))), folder, prefix, True)


def rename(spark, old: str, new: str) -> None:
    """Move a file or folder by its file system, in place of what is there."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (old, new))
    store = a.getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(b, True)
    if not store.rename(a, b):
        raise OSError(f"{old} can't be moved to {new}")


def write_text(spark, path: str, text: str) -> None:
    """A small text file, written by the driver through the path's file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def report(samples: DataFrame, path: str | None = None, errors: int = 0, duplicates: int = 0) -> dict:
    """Corpus statistics as nested counts; written as JSON if a path is given. Its values are bounded by the enums."""
    out: dict = {"total_samples": 0, **{f"by_{f}": {} for f in corpus.GROUPS}}
    for r in corpus.grouped_counts(samples).collect():
        if r["field"] == "total":
            out["total_samples"] = r["count"]
        else:
            out[f"by_{r['field']}"][r["value"]] = r["count"]
    seen = corpus.coverage(samples).first()
    out |= {"bbox_coverage": seen["bbox_coverage"], "image_paths": {"single": seen["single"], "paired": seen["paired"]}, "errors": errors, "duplicate_ids": duplicates}
    if path:
        write_text(samples.sparkSession, path, json.dumps(out, indent=2))
    return out


def read_selection(spark, path: str) -> DataFrame:
    """tile: the ids of a selection, written by ``write_selection`` or as one JSON list; none if it isn't there."""
    if not stores.exists(spark, path):
        return spark.createDataFrame([], "tile string")
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    listed = F.when(line.startswith("["), F.from_json(line, "array<string>")).otherwise(F.array(line))
    whole = path.endswith(".json")
    return spark.read.text(path, wholetext=whole).select(F.explode(listed).alias("tile")).filter("tile <> ''").distinct()


def write_selection(items: DataFrame, key: str, path: str) -> None:
    """Sorted ids as a one-column text table."""
    items.select(F.col(key).cast("string")).orderBy(key).write.mode("overwrite").text(path)

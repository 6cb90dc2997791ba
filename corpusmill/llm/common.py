"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc
import re
import sys
import tempfile
import threading
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: list[str] = []
_LOCAL = threading.local()
#: Bytes of text that an Arrow function takes up at a time (a longer text alone).
SLICE_BYTES = 1 << 20
#: Bytes of a batch (or one row) that Spark hands to an Arrow function, where the session doesn't say.
BATCH_BYTES, BATCH_LIMIT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Copies of a dimension's rows, and as many parts of each of its keys, where it is too large to be broadcast.
SALTS = 32
#: Rows of one key that go to one task of a join whose keys are cut, and keys that are cut at most.
HOT_ROWS, MOST_HOT = 10_000, 200_000


def ship(module: str) -> None:
    """Send this module's functions to the executors by value, so that they need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one of our own where it is unset and all runs in one process."""
    set_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="corpusmill-"))
    return "file://" + _OWN_DIR[0]


def _scopes() -> list[list[str]]:
    """This thread's open ``scratch`` blocks: pipelines in several threads don't delete each other's tables."""
    return _LOCAL.__dict__.setdefault("open", [])


def materialise(df: DataFrame, outlives: int = 0) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it again: cuts lineage, survives lost executors.

    Within ``scratch`` the table is deleted at the end of the block, or of one further out if it outlives so many; otherwise it stays
    as long as the shared folder.
    """
    path = f"{shared_dir(df.sparkSession)}/corpusmill/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if outlives < len(_scopes()):
        _scopes()[-1 - outlives].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark free what finished steps have left: broadcasts (a table of some 16 MB each, however few rows) and shuffles.

    It does so when the driver collects garbage, which a large driver rarely does.
    """
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession):
    """Delete the tables that ``materialise`` writes in this block, at its end: only what was written before or after it may still be read."""
    _scopes().append([])
    try:
        yield
    finally:
        for path in _scopes().pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        release(spark)


def few_rows(df: DataFrame, most_rows: int) -> bool:
    """Whether a frame has at most so many rows (it is counted that far)."""
    return df.limit(most_rows + 1).count() <= most_rows


def bounded_broadcast(df: DataFrame, most_rows: int) -> DataFrame:
    """Mark a frame for broadcast if it has at most ``most_rows`` rows (it is counted); else leave the join to a shuffle."""
    return F.broadcast(df) if few_rows(df, most_rows) else df


def join_dimension(df: DataFrame, dim: DataFrame, key: str, few: bool, how: str = "inner") -> DataFrame:
    """Join rows with a dimension: by broadcast if it has few rows, or else by a shuffle in which each key is dealt to SALTS tasks.

    Spark sizes the copies by the files they come from, packed and once, so it would broadcast them by its own threshold: the hint says no.
    """
    if few:
        return df.join(F.broadcast(dim), key, how)
    salted = df.withColumn("_salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")


def cut_keys(df: DataFrame, key: str) -> DataFrame | None:
    """The keys of a written table that have more rows than one task should get, with their number of ``_parts``; None if there are none.

    A part has ``HOT_ROWS`` rows, or a ``MOST_HOT``-th of the table if that is more, so no more than MOST_HOT keys are cut.
    """
    rows = df.count()
    most = max(HOT_ROWS, rows // MOST_HOT)
    if rows <= most:
        return None
    parts = materialise(df.groupBy(key).count().filter(F.col("count") > most).select(key, F.ceil(F.col("count") / most).cast("int").alias("_parts")))
    return parts if parts.limit(1).count() else None


def join_cut(df: DataFrame, dim: DataFrame, key: str, by: str, parts: DataFrame | None) -> DataFrame:
    """Join rows with a dimension of one row a key; rows of a cut key are dealt by a hash of column ``by``, and each part gets the dimension's row."""
    if parts is None:
        return df.join(dim, key)
    cut = lambda x: x.join(F.broadcast(parts), key, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    dealt = cut(df).withColumn("_part", F.pmod(F.xxhash64(by), F.col("_parts")).cast("int")).drop("_parts")
    copies = cut(dim).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return dealt.join(copies, [key, "_part"]).drop("_part")


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``, by small batches.

    Each running task holds a batch outside the heap, with room to grow, and once more in Python: of Spark's 64 MB that is some
    hundreds of MB an executor. So the session's limit becomes ``BATCH_BYTES`` where none is set; one that is set stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def sliced(batches, column: str = "text", most: int = SLICE_BYTES):
    """Slices (without copies) of Arrow batches with at most ``most`` bytes in a column of texts, or one row: what is built from them in Python stays small."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi
    pa.default_memory_pool().release_unused()


def record_batches(columns: list, schema: pa.Schema, rows: int = 20_000):
    """Arrow batches of at most ``rows`` rows from parallel columns (lists or numpy arrays)."""
    total = len(columns[0]) if columns else 0
    for lo in range(0, total, rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + rows], type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def lower_az(column):
    """A-Z to a-z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

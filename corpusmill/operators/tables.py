"""Intermediate tables in the folder that driver and executors share, and joins with small tables."""

from __future__ import annotations

import contextlib
import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []
_SCOPES = threading.local()
#: Rows of a small table that are broadcast at most, and copies of its rows (and parts of each key) where it has more.
BROADCAST_ROWS, SALTS = 200_000, 32


def fresh_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, or under one of our own where that is unset and all runs in one process."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="corpusmill-"))
        base = "file://" + _OWN[0]
    return f"{base.rstrip('/')}/corpusmill/{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder by the path's file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write as Parquet to a shared folder and read again: cuts lineage, survives lost executors.

    Within ``scratch`` the table is deleted at the end of the block; otherwise it stays as long as the shared folder.
    """
    path = fresh_folder(df.sparkSession)
    df.write.parquet(path)
    if scopes := getattr(_SCOPES, "open", None):
        scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Delete the tables that this thread's ``materialise`` writes in the block, at its end: for runs that write their result elsewhere."""
    scopes = _SCOPES.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            delete(spark, path)


def few_rows(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most so many rows (it is counted that far)."""
    return df.limit(most_rows + 1).count() <= most_rows


def join_small(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner", most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join rows with a table that is small as a rule: by broadcast if it is, or else by a shuffle that deals each key to SALTS tasks
    (the hint keeps Spark from broadcasting the copies, whose size it underrates)."""
    if few_rows(small, most_rows):
        return df.join(F.broadcast(small), on, how)
    salted = df.withColumn("_salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")

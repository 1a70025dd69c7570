"""Helpers that the text operators share: the folder all executors see, and written intermediate tables."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where none is set, a folder of our own, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="sigmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


def forget(*tables: DataFrame | None) -> None:
    """Delete the files of materialized tables on which no table to come depends."""
    for df in tables:
        path = None if df is None else _written.pop(df, None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


#: The longest table of ids that is broadcast: 16 MB about.
BROADCAST_IDS = 500_000


def small(ids: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """A materialized table of ids, to be broadcast in a join if it has so many rows at most; counted here."""
    return F.broadcast(ids) if ids.count() <= rows else ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until df has no column of that name in any case: for columns that are dropped again."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


def slices(sizes: list[int], most: int):
    """(start, stop) runs of consecutive items whose sizes add up to about `most` at a time; one item at least."""
    start = total = 0
    for k, n in enumerate(sizes):
        if k > start and total + n > most:
            yield start, k
            start, total = k, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def trimmed(run):
    """A function over a task's batches that gives freed memory back to the system at the task's end.

    Python workers outlive their tasks, and what their allocators keep adds up over the stages of a long job.
    """

    def ends(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)

    return ends

"""What the operators share: tables, staged intermediates, size-checked joins."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if it has at most so many rows; each row of such a
#: side has a bounded width, given where it is used.
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.  Where spark.checkpoint.dir is unset, a local
    master gets a folder of its own, and any other one an error: no executor sees the driver's disk."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_dir()


@cache
def _own_dir() -> str:
    path = tempfile.mkdtemp(prefix="kinmesh-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lost executors cost no more
    than the tasks that had not been written, and later plans start from a file."""
    path = f"{shared_dir(df.sparkSession)}/kinmesh-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(staged: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if a staged table has at most `rows` rows; beyond that the
    planner joins by shuffle and splits skewed partitions."""
    n = staged.limit(rows + 1).count()
    return F.broadcast(staged) if n <= rows else staged


def slices(batches, rows: int = 1000):
    """The batches in pieces, so that a worker holds Python objects of few rows at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def tidy(run):
    """run for mapInArrow; at its end the worker, which later tasks use again, returns what it took."""

    def held(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return held


def release() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def lower_ascii(col):
    """A-Z to a-z and nothing else."""
    return F.translate(col, UPPER, LOWER)

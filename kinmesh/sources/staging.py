"""Intermediate tables in the folder that the driver and the executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session.  Where it is unset, a local master gets a folder of its
    own, and any other one an error: executors do not see the driver's disk."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    path = tempfile.mkdtemp(prefix="kinmesh-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet and read back.  Later plans start from the files, so they stay
    small for the optimiser, and an executor that is lost takes no finished stage with it.

    A finished stage's plans and task results are collected at once: of some 100 MB that live in the
    driver's heap no more than that stays, where else garbage lets the heap grow to its limit, and
    Spark removes the stage's shuffle files and broadcasts when the driver collects them."""
    path = f"{shared_folder(df.sparkSession)}/kinmesh-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    df.sparkSession._jvm.java.lang.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What a table that is broadcast holds at most: rows, and characters of texts.
FEW_ROWS, FEW_CHARACTERS = 400_000, 32_000_000


def small(staged: DataFrame) -> DataFrame:
    """A broadcast hint if a staged table is known to be small; beyond that the planner joins by shuffle."""
    texts = sum((F.coalesce(F.length(c), F.lit(0)) for c, kind in staged.dtypes if kind == "string"), F.lit(0))
    n, size = staged.agg(F.count("*"), F.coalesce(F.sum(texts), F.lit(0))).first()
    return F.broadcast(staged) if n <= FEW_ROWS and size <= FEW_CHARACTERS else staged

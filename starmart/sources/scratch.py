"""Cutting lineage through written tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is run inside go as soon as it has ended.  Without that they stay until the driver
    collects its garbage, so how much disk a chain of stored tables takes is left to chance."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; every executor must reach it.  Only a
    local session, where driver and executors are one process, may fall back to a
    temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/") + "/starmart"
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="starmart-")
    return _local_roots[app]


def scratch_path(spark: SparkSession) -> str:
    """A fresh path below the scratch root, removed when the application ends."""
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath.getParent())
    fs.deleteOnExit(jpath)
    return path


def materialize(df: DataFrame, compression: str | None = None) -> tuple[DataFrame, int]:
    """Write ``df`` once; return the stored table and its row count.

    The count is observed during the write, so there is no second scan.  What is read
    back has exact file sizes, which is what Spark's own join selection goes by.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]

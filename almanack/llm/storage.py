"""Files between jobs, in the folder that driver and executors share."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, removed when the JVM ends.

    Where that is unset (tests on one machine), it lies below the warehouse, which
    Spark shares as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return files.makeQualified(path).toString()


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write and reread, which cuts the lineage: a lost executor costs no recomputation."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, path: str) -> None:
    """Remove a finished intermediate table."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def give_back() -> None:
    """Return freed memory to the system, for when a task ends and its Python worker waits for another."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def filesystem(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system for a URI (file, hdfs, s3, gs), and the path within it."""
    return arrow_fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")

"""Session settings for local runs, and the folder for data written between jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "almanack", cores: int | str = "*") -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the session comes from spark-submit; nothing in the library
    depends on the settings below for right results.
    """
    partitions = 8 if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path for files that one job writes and a later one reads.

    They are removed when the session's JVM ends.
    """
    folder = fresh_folder(spark.conf)
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        require_shared(folder, context.master)
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once and read from the shared folder from now on."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require_shared(folder: str, master: str) -> None:
    """Refuse a warehouse on the driver's disk where executors run on other machines."""
    if folder.startswith("file:") and not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")


def fresh_folder(conf) -> str:
    """A folder of its own within one that driver and executors share.

    The cluster names that in ``spark.checkpoint.dir``; where that is unset, it is
    the warehouse, which Spark shares as well.
    """
    shared = conf.get("spark.checkpoint.dir", None) or conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/almanack-{uuid.uuid4().hex}"

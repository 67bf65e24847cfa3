"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "quillspark",
              shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Session with the settings every job here relies on.

    Master, memory and shuffle width are only set when asked for, so what
    spark-submit or the cluster's defaults say stays in force.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the directory the cluster names in ``spark.checkpoint.dir`` (or one
    already set on the context). Only a local-mode session without that
    setting (tests, the bench) gets a fresh scratch folder of its own; a
    cluster session without it is an error, because a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        conf = tempfile.mkdtemp(prefix="qs-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def ship_package(spark: SparkSession) -> None:
    """Make ``quillspark`` importable in the Python workers.

    Functions passed to ``mapInPandas`` / pandas UDFs that live in this
    package are pickled by reference, so every worker must be able to import
    it. The package is zipped once per SparkContext and added with
    ``addPyFile`` (Spark serves it to every executor, as spark-submit's
    ``--py-files`` would). A no-op when already shipped.
    """
    sc = spark.sparkContext
    if getattr(sc, "_qs_package_shipped", False):
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="quillspark-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._qs_package_shipped = True


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its Hadoop file system; other failures
    (rights, network) are raised."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def is_file(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(at) and fs.getFileStatus(at).isFile()


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, empty where nothing was written yet. Only the
    folder's absence counts as that; a failing read is an error."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)

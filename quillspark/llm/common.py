"""Helpers of the operators: stored tables and files in the shared folder."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package

NO_ID = -(1 << 63)             # stands for a null doc_id in join keys


def id_key(name: str = "doc_id"):
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder (URI) below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the
    lineage, and survives the loss of executors."""
    path = fresh_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000              # whole texts are long rows


def prepare(spark: SparkSession) -> None:
    """Ships the package and, unless the session says otherwise, hands
    Python tasks texts in batches of ``BATCH_ROWS``."""
    ship_package(spark)
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The two columns the operators read, whatever else ``docs`` holds."""
    prepare(spark)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _open(uri: str):
    uri = uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def publishing(uri: str):
    """An output stream under a name of this attempt, moved to ``uri`` when
    complete; a repeated or speculative task replaces it with equal bytes."""
    fs, path = _open(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as out:
        yield out
    fs.move(attempt, path)


def reader(uri: str):
    """A random-access file (``read_at(n, offset)``, ``size()``)."""
    fs, path = _open(uri)
    return fs.open_input_file(path)

"""Readers (S1, S2, S3, S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chatlog import read_chat_export  # noqa: F401  (S2)
from ..operators.qa import read_qa_files  # noqa: F401  (S3)


def read_text_documents(spark: SparkSession, path: str, require_glob: str | None = "*.txt") -> DataFrame:
    """Every file of a directory as one document
    ``(file_name, file_size, text)``.

    Like the reference, all files are read; ``require_glob`` is only an
    existence check (at least one match, else ``FileNotFoundError``). Note:
    ``wholetext`` must be passed to ``.text()`` itself; as a reader option it
    is overridden by the method's default.
    """
    if require_glob:
        probe = spark.read.option("pathGlobFilter", require_glob).format("binaryFile").load(path) \
                     .select("path").limit(1).collect()
        if not probe:
            raise FileNotFoundError(f"no {require_glob} files under {path}")
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_size").cast("bigint").alias("file_size"),
                     F.col("value").alias("text"))


def read_published(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read back a published directory (recursively) or one file; an
    empty or missing prefix is an error, as the reference reports it."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listFiles(jvm_path, True) if fs.exists(jvm_path) else None
    hidden = ("_", ".")                          # marks of a finished write and the like
    while files is not None and files.hasNext():
        if not files.next().getPath().getName().startswith(hidden):
            break
    else:
        raise FileNotFoundError(f"{path} is empty or does not exist")
    return spark.read.format(fmt).option("recursiveFileLookup", "true").load(path)

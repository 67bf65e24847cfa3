"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order; each works on all that the stage before it
kept, read again from Parquet in the shared folder, so a lost executor costs
no earlier stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import stored
from quillspark.llm.decontaminate import decontaminate
from quillspark.llm.jaccard_join import one_per_class
from quillspark.llm.line_dedup import dedup_lines
from quillspark.llm.packing import pack
from quillspark.llm.quality_classifier import keep_quality
from quillspark.llm.queries import tokenizer_path
from quillspark.plans.registry import table

_WORD = r"[^\x20\x09-\x0D]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of three lines, or of one or two
    of more than 50 words; a document that lost its last word goes.
    ``n_chars`` follows the text."""
    out = dedup_lines(docs, before="__qs_input", min_words=50)
    emptied = F.col("__qs_input").rlike(_WORD) & ~F.col("text").rlike(_WORD)
    out = out.where(~F.coalesce(emptied, F.lit(False)))
    own = [F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five words, 0.8)."""
    return one_per_class(docs, n=5, threshold=0.8)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), n=10, remove="documents")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return pack(docs, tokenizer_path(), length=1024, end_id=0)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", benchmark),
    ("packing", sequences),
]

#: A fitted classifier, chosen paths and a tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

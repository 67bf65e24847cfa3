"""The document store as Parquet tables, and the two end-to-end jobs of the
reference's main flow: ingest a directory (S1 -> T6 -> S4) and generate
answers for pending chunks (F1/F2 -> P4 -> P1/P2 -> P3).

Layout under ``store``: ``documents/``, ``chunks/``, ``variants/``,
``answers/`` and ``runs/<run id>/`` (every generation run's raw output,
errors included). Appends are anti-joined on their keys, so re-running a job
after a failure adds nothing twice.
"""

from __future__ import annotations

import uuid
from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import generate as G
from ..streaming.incremental import CHUNK_SCHEMA, DOC_SCHEMA, ingest_batch
from ..session import read_or_empty
from .readers import read_text_documents

VARIANT_SCHEMA = ("file_name string, variant_idx bigint, variant_id string, provider string, model string, "
                  "prompt string")
ANSWER_SCHEMA = "chunk_id string, variant_id string, answer string, input_tokens bigint, output_tokens bigint"


def read_table(spark: SparkSession, store: str, name: str, schema: str) -> DataFrame:
    return read_or_empty(spark, f"{store}/{name}", schema)


def ingest_directory(spark: SparkSession, path: str, store: str, **split_kw) -> None:
    """Read every file of ``path`` (S1), split it (T6) and store documents
    whose name is not stored yet (S4)."""
    docs = read_text_documents(spark, path).select("file_name", F.col("file_size").alias("size"), "text")
    ingest_batch(docs, store, **split_kw)


def process_chunks(spark: SparkSession, store: str, provider: str, model: str, prompt: str,
                   responder: Callable[[pd.Series, dict], pd.DataFrame], file_name: str | None = None,
                   chunk_process_limit: int | None = None, calls_per_period: int | None = 49,
                   period_s: float = 60.0, lanes: int = 8, commit_every: int = 1000) -> DataFrame:
    """Generate answers for the pending chunks of one document (or all).

    The variant (provider, model, prompt) is found or appended per document;
    the first ``chunk_process_limit`` pending chunks (all when falsy) go to
    ``responder`` under the rate limit. The work is committed in rounds of
    about ``commit_every`` chunks: a round's raw output is written to
    ``runs/<run>/round=<n>`` (so each chunk is sent once per run) and its
    successful answers are appended to ``answers/`` before the next round
    starts. A run that breaks loses at most the round it was in; started
    again, it sends only what is still pending. Returns the run's rows, failed
    ones with their error (those chunks stay pending).
    """
    docs = read_table(spark, store, "documents", DOC_SCHEMA)
    if file_name is not None:
        docs = docs.filter(F.col("file_name") == file_name)
    chunks = read_table(spark, store, "chunks", CHUNK_SCHEMA).join(docs.select("file_name"), "file_name", "left_semi")
    variants = read_table(spark, store, "variants", VARIANT_SCHEMA)
    answers = read_table(spark, store, "answers", ANSWER_SCHEMA)

    vid = spark.range(1).select(G.variant_id(F.lit(model), F.lit(prompt)).alias("v")).first()["v"]
    variant = {"variant_id": vid, "provider": provider, "model": model, "prompt": prompt}
    pending_docs = G.documents_with_pending(chunks, answers, vid)
    resolved = G.resolve_variant(variants, pending_docs, provider, model, prompt)
    resolved.filter("is_new").drop("is_new").select(*variants.columns) \
            .write.mode("append").parquet(f"{store}/variants")

    run_path = f"{store}/runs/{uuid.uuid4().hex}"
    G.first_pending(chunks, answers, chunk_process_limit, vid).select("chunk_id", "text").write.parquet(f"{run_path}/todo")
    todo = spark.read.schema("chunk_id string, text string").parquet(f"{run_path}/todo")
    rounds = max(1, -(-todo.count() // commit_every))
    raw = f"{ANSWER_SCHEMA}, error string"
    for n in range(rounds):
        part = todo.where(F.pmod(F.xxhash64("chunk_id"), F.lit(rounds)) == n)
        path = f"{run_path}/rows/round={n}"
        G.generate_answers(part, variant, responder, calls_per_period, period_s, lanes).write.parquet(path)
        done = read_table(spark, store, "answers", ANSWER_SCHEMA).where(F.col("variant_id") == vid).select("chunk_id")
        fresh = spark.read.schema(raw).parquet(path).where("error is null").join(done, "chunk_id", "left_anti")
        fresh.select(*answers.columns).write.mode("append").parquet(f"{store}/answers")
    return spark.read.schema(raw).parquet(f"{run_path}/rows")

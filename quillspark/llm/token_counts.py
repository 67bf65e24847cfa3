"""Token counts of documents in flat token files.

A token file is nothing but token ids, each document followed by an
end-of-document id; there is no index. Files are read in blocks by range
reads; in a block the separators are found by one vectorised comparison. A
prefix scan over the blocks' small summaries (separators so far, position of
the last one) stitches documents that cross block boundaries.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textscan as ts
from .common import documents, fresh_folder, publishing, reader, stored
from .encode import SLICE_BYTES, encoder

BLOCK_BYTES = 8 << 20
MAX_TASKS = 100_000            # that blocks are dealt to
SCAN_GROUP = 1024              # blocks scanned together in the first level of the prefix scan


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, dtype: str = "uint16") -> DataFrame:
    """Tokenise ``docs`` into flat files, one per task, below ``folder``.

    Returns which document is where: ``file, ordinal, doc_id``. Special
    strings in a text are ordinary text, so only real ends carry ``end_id``.
    """
    code = np.dtype(dtype).newbyteorder("<")

    def write(batches):
        # A name of this attempt's own: only a committed attempt's rows name its file.
        uri = f"{folder}/tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        first = next(batches, None)
        if first is None:
            return
        enc, ordinal = encoder(tokenizer, True), 0
        with publishing(uri) as out:
            batch = first
            while batch is not None:
                texts = ts.plain(batch.column(1))
                for lo, hi in ts.slices(texts, SLICE_BYTES):
                    flat, at = enc.ids(texts.slice(lo, hi - lo))
                    out.write(np.insert(flat, at[1:], end_id).astype(code).tobytes())
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * n, pa.string()), pa.array(np.arange(ordinal, ordinal + n)), batch.column(0)],
                    names=["file", "ordinal", "doc_id"])
                ordinal += n
                batch = next(batches, None)

    rows = documents(docs.sparkSession, docs).mapInArrow(write, "file string, ordinal bigint, doc_id bigint")
    return stored(rows, "token-manifest")


def scan_token_files(files: DataFrame, end_id: int, dtype: str = "uint16", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Token counts of the documents in flat token files (column ``file``).

    Returns ``file, ordinal, start, n_tokens, complete``: documents in file
    order, their first token's position and their length without the
    separator. Tokens after a file's last separator are a last document with
    ``complete`` false. Two separators in a row enclose an empty document; an
    empty file has no document. Repeated names of one file count once.
    """
    code = np.dtype(dtype).newbyteorder("<")
    wide = code.itemsize
    step = max(block_bytes // wide, 1)

    def sizes(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([reader(f).size() // wide for f in names], pa.int64())],
                names=["file", "total"])

    def scan(batches):
        for batch in batches:
            for file, total, block in zip(*(c.to_pylist() for c in batch.columns)):
                at = block * step
                n = min(step, total - at)
                ids = np.frombuffer(reader(file).read_at(n * wide, at * wide), dtype=code)
                seps = np.flatnonzero(ids == end_id) + at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([total], pa.int64()), pa.array([block], pa.int64()), pa.array([len(seps)], pa.int64()),
                     pa.array([int(seps[-1]) if len(seps) else -1], pa.int64()), pa.array([seps], pa.list_(pa.int64()))],
                    names=["file", "total", "block", "n", "last", "seps"])

    blocks = stored(files.select("file").where("file is not null").distinct().mapInArrow(sizes, "file string, total bigint").where("total > 0")
              .select("file", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(total - 1) div {step}"))).alias("block")), "blocks")
    # The blocks are tiny rows: a number of partitions that is given isn't coalesced, so a task reads about one block.
    summary = stored(blocks.repartition(max(min(blocks.count(), MAX_TASKS), 1), "file", "block")
                     .mapInArrow(scan, "file string, total bigint, block bigint, n bigint, last bigint, seps array<bigint>")
                     .withColumn("grp", F.expr(f"block div {SCAN_GROUP}")), "token-blocks")
    # Exclusive prefix scan in two levels: over groups of blocks, then inside each group.
    outer = Window.partitionBy("file").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("file", "grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    groups = (summary.groupBy("file", "grp").agg(F.sum("n").alias("gn"), F.max("last").alias("glast"))
              .select("file", "grp", F.coalesce(F.sum("gn").over(outer), F.lit(0)).alias("n_outer"),
                      F.coalesce(F.max("glast").over(outer), F.lit(-1)).alias("last_outer")))
    placed = (summary.withColumn("n_inner", F.coalesce(F.sum("n").over(inner), F.lit(0)))
              .withColumn("last_inner", F.coalesce(F.max("last").over(inner), F.lit(-1)))
              .join(groups, ["file", "grp"])
              .select("file", (F.col("n_outer") + F.col("n_inner")).alias("before"),
                      F.greatest("last_outer", "last_inner").alias("prev"), "seps"))
    whole = (placed.select("file", "before", "prev", "seps", F.posexplode("seps").alias("pos", "sep"))
             .select("file", (F.col("before") + F.col("pos")).alias("ordinal"),
                     (F.when(F.col("pos") == 0, F.col("prev")).otherwise(F.expr("seps[pos - 1]")) + 1).alias("start"), "sep")
             .select("file", "ordinal", "start", (F.col("sep") - F.col("start")).alias("n_tokens"), F.lit(True).alias("complete")))
    rest = (summary.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.max("last") + 1).alias("start"), F.max("total").alias("total"))
            .where("total > start")
            .select("file", "ordinal", "start", (F.col("total") - F.col("start")).alias("n_tokens"), F.lit(False).alias("complete")))
    return whole.unionByName(rest)


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, dtype: str = "uint16") -> DataFrame:
    """``doc_id, n_tokens`` of every row of ``docs``, by writing its token
    files and scanning them.

    Null or empty text has 0 tokens; null ids and repeated rows give a row
    each; an empty table gives an empty result; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    manifest = write_token_files(docs, tokenizer, end_id, fresh_folder(spark, "tokens"), dtype)
    counts = scan_token_files(manifest, end_id, dtype)
    # The manifest's compressed files are small enough to be broadcast long after its rows are too many for a driver.
    return manifest.hint("merge").join(counts.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")

"""T1-T6 for documents larger than a row: text files split into chunks by many tasks.

Spark's text source cuts a file at any byte range when its lines end at the
article marker, so a piece is a row, whatever the file's size. Headers are
carried and chunks are numbered by a two-level prefix scan: over the pieces of
each byte range, then over the ranges' summaries (a header, a count and the
bytes of each). A task holds one range; the text is shuffled once, by range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.indexing import stored_table
from ..functions.pytext import PY_NON_WS, py_split, py_strip
from ..operators import chunking as C

_MARK = 3                      # bytes of a byte order mark, which the text source drops


def _check(marker: str, stem: str, size: int) -> int:
    """Bytes of the marker, which may not overlap itself: where such a marker
    is found would depend on where a range begins."""
    m = marker.encode()
    if not m or any(m.startswith(m[i:]) for i in range(1, len(m))):
        raise ValueError("the marker is empty or overlaps itself")
    if len(stem) > size:
        raise ValueError("the stem is longer than a chunk")
    return len(m)


def _pieces(spark: SparkSession, path: str, size: int, marker: str, stem: str, restore_first: bool) -> DataFrame:
    """A row for each piece: its place, header, unlabelled chunks, and whether
    these get a label once a header is known; ``carried`` and ``before`` (the
    last header, the chunks before the piece) are those of its range."""
    raw = spark.read.option("lineSep", marker).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("total"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    place = Window.partitionBy("file", "start").orderBy("at")
    numbered = raw.withColumn("i", F.row_number().over(place)).withColumn("lead", F.first(F.octet_length("text")).over(place))
    # A text that starts with the marker: its empty first piece goes, and the next one lacks the stem unless asked for.
    first = (F.col("start") == 0) & (F.col("i") == 1)
    second = (F.col("start") == 0) & (F.col("i") == 2) & (F.col("lead") == 0)
    bare = first if restore_first else first | second
    cut = numbered.select("file", "total", "start", "at", F.octet_length("text").alias("bytes"), (first & (F.col("lead") == 0)).alias("dropped"),
                          F.when(bare, F.col("text")).otherwise(F.concat(F.lit(stem), "text")).alias("piece"))
    small = F.length("piece") <= size
    worded = cut.select("*", small.alias("small"), F.when(~small, py_split(F.col("piece"))).alias("words"))
    packed = worded.withColumn("starts", F.when(F.size("words") > 0, C.pack_break_starts(F.transform("words", lambda w: F.length(w)), size)))
    chunks = C._chunks_of_piece(F.col("piece"), F.col("small"), F.col("piece").rlike(PY_NON_WS), F.col("words"), F.col("starts"), F.lit(""))
    cut = packed.select("file", "total", "start", "at", "bytes", "dropped", "small", C.article_header(F.col("piece"), stem).alias("header"),
                        py_strip(F.col("piece")).alias("stripped"), chunks.alias("chunks"))
    same = (F.size("chunks") == 1) & (F.get("chunks", 0) == F.col("stripped"))
    cut = cut.select("file", "total", "start", "at", "bytes", "dropped", "header", "chunks", (~F.col("small") & ~same).alias("labelled"))
    return cut.withColumn("carried", F.last(F.nullif("header", F.lit("")), ignorenulls=True).over(place)) \
        .withColumn("before", F.coalesce(F.sum(F.size("chunks")).over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def split_large_documents(spark: SparkSession, path: str, size: int = C.DEFAULT_SIZE, marker: str = C.DEFAULT_MARKER,
                          stem: str = C.DEFAULT_STEM, restore_first: bool = False) -> DataFrame:
    """T6 over the UTF-8 text files of ``path``: ``file, chunk_idx, chunk``, the
    chunks that :func:`quillspark.operators.chunking.split_documents` gives for
    the whole texts, for files of any size; each is read in byte ranges of
    ``spark.sql.files.maxPartitionBytes``, which must hold the marker.

    A piece (the text between two markers) must fit a row, and a marker that
    overlaps itself is refused. An empty or blank file has no chunks. A byte
    order mark isn't text here; with one, a marker of three bytes is an error,
    since the file's end can't be told. Compressed files can't be told to end
    with a marker either and are refused.
    """
    width = _check(marker, stem, size)
    pieces = stored_table(_pieces(spark, path, size, marker, stem, restore_first), "large-text")
    # A written table of the ranges' size: the texts are shuffled for the join only if it is too large to broadcast.
    ranges = stored_table(pieces.groupBy("file", "start").agg(
        F.sum(F.size("chunks")).alias("n"), F.max_by("carried", "at").alias("carried"), F.count("*").alias("rows"),
        F.sum("bytes").alias("bytes"), F.max("total").alias("total"), F.max("dropped").alias("dropped")), "large-text-ranges")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = ranges.select("file", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("chunks_before"),
                          F.coalesce(F.last("carried", ignorenulls=True).over(earlier), F.lit("")).alias("carried_before"))
    header = F.coalesce("carried", "carried_before")
    rows = pieces.join(known, ["file", "start"]).select(
        "file", (F.col("chunks_before") + F.col("before")).alias("offset"), F.when(F.col("labelled"), header).otherwise("").alias("header"),
        F.posexplode("chunks").alias("k", "chunk"))
    label = F.when(F.col("header") != "", F.concat("header", F.lit(C.CONTINUATION))).otherwise("")
    out = rows.select("file", (F.col("offset") + F.col("k")).cast("bigint").alias("chunk_idx"), F.concat(label, "chunk").alias("chunk"))
    # The text source has no row for what follows a marker at a file's end; the bytes tell of it.
    files = ranges.groupBy("file").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
                                       F.max("total").alias("total"), F.max("dropped").alias("dropped"))
    left = F.col("total") - F.col("bytes") - (F.col("rows") - 1) * width
    known_left = left.isin(0, width) if width == _MARK else left.isin(0, width, _MARK, width + _MARK)
    ends = F.when(~known_left, F.raise_error(F.concat("file", F.lit(": compressed, or a byte order mark with a marker of three bytes")))) \
        .otherwise(left.isin(width, width + _MARK))
    stemmed = F.lit(restore_first) | (F.col("rows") > F.col("dropped").cast("int"))
    last = files.where(ends & stemmed & F.lit(bool(stem.strip()))).select("file", F.col("n").cast("bigint").alias("chunk_idx"), F.lit(stem).alias("chunk"))
    return out.unionByName(last)

"""Line dedup by winnowing over line hashes.

The minimum line hash of every window of ``min_lines`` consecutive lines is a
fingerprint: two runs of that many equal lines always share one. Fingerprints
that occur once end there. The others' positions are joined, their contexts
(the windows they are the minimum of, before and after them) compared, and
matching windows that follow each other make up the extended run. Lines of a
later run are deleted; the first occurrence stays. With ``min_words``, windows
of fewer lines with more words than that are found in the same way.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import documents, prepare

MIN_LINES = 3
LAST = (1 << 63) - 1           # a null doc_id comes after all others
_HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")
_CONTEXT = 32                  # windows of one fingerprint row at most


def runs(keys: np.ndarray, valid: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal ``keys`` among ``valid`` places,
    cut to ``limit`` each."""
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (keys[at[1:]] != keys[at[:-1]])
    first = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(within % limit == 0)
    return at[first], np.diff(np.append(first, len(at)))


def _fingerprints(min_lines: int, min_words: int | None):
    def found(u: ts.Units, h: np.ndarray, width: int, valid: np.ndarray):
        minima, windows = ts.sliding_min(h, width), ts.ngrams(h, width)
        if width < min_lines:                                      # apart from the fingerprints of other widths
            minima, windows = (ts.mix(x ^ np.uint64(width)) for x in (minima, windows))
        start, size = runs(minima, valid, _CONTEXT)
        own = u.owners()[start]
        flat = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return own, start - u.first[own], np.full(len(start), width), minima[start].view(np.int64), offsets, windows[flat].view(np.int64)

    def scan(batches):
        for batch in batches:
            texts = ts.plain(batch.column(1))
            for lo, hi in ts.slices(texts):
                part = texts.slice(lo, hi - lo)
                u = ts.cut_lines(part)
                h = u.hashes()
                parts = [found(u, h, min_lines, ts.inside(u, min_lines))]
                if min_words is not None and min_lines > 1:
                    words = ts.cut(part).start
                    before = np.concatenate([[0], np.cumsum(np.searchsorted(words, u.end) - np.searchsorted(words, u.start))])
                    for width in range(1, min_lines):
                        inside = ts.inside(u, width)
                        parts.append(found(u, h, width, inside & (before[width:][:len(inside)] - before[:len(inside)] > min_words)))
                for own, line, width, minima, offsets, windows in parts:
                    take = pa.array(own + lo)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(minima), batch.column(2).take(take), batch.column(3).take(take), pa.array(line), pa.array(width, pa.int32()),
                         pa.ListArray.from_arrays(pa.array(offsets), pa.array(windows))],
                        names=["fp", "dkey", "th", "line", "width", "windows"])
    return scan


def _keys(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(LAST)).alias("dkey"), F.xxhash64("text").alias("th"))


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """``dkey, th, starts``: first line (counted among the lines with a word)
    and number of lines of the windows to delete of each document; see
    :func:`dedup_lines`."""
    keyed = _keys(documents(docs.sparkSession, docs))
    prints = keyed.mapInArrow(_fingerprints(min_lines, min_words), "fp bigint, dkey bigint, th bigint, line bigint, width int, windows array<bigint>")
    # Counts are combined before the shuffle, so a hot line costs a row per task.
    shared = prints.groupBy("fp").agg(F.sum(F.size("windows")).alias("n")).where("n > 1").select("fp")
    place = (prints.join(shared, "fp", "left_semi")
             .select("fp", "dkey", "th", "line", "width", F.posexplode("windows").alias("i", "window"))
             .select("fp", "window", "dkey", "th", (F.col("line") + F.col("i")).alias("line"), "width"))
    first = place.groupBy("fp", "window").agg(F.min(F.struct("dkey", "th", "line")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = place.join(first, ["fp", "window"]).where(F.struct("dkey", "th", "line") > F.col("first"))
    return later.groupBy("dkey", "th").agg(F.collect_set(F.struct("line", "width")).alias("starts"))


def _without():
    @F.pandas_udf("string")
    def without(texts: pd.Series, starts: pd.Series) -> pd.Series:
        out = []
        for text, at in zip(texts, starts):
            if text is None or at is None:
                out.append(None)
                continue
            gone = {s["line"] + j for s in at for j in range(s["width"])}
            kept, n = [], 0
            for line in text.split("\n"):
                if _HAS_WORD.search(line):
                    if n not in gone:
                        kept.append(line)
                    n += 1
                else:
                    kept.append(line)
            out.append("\n".join(kept))
        return pd.Series(out, dtype=object)
    return without


def n_lines(text: Column) -> Column:
    """Lines with a word (0 for null)."""
    return F.coalesce(F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0)).cast("long")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, before: str | None = None, min_words: int | None = None) -> DataFrame:
    """``docs`` with every later repeated run of lines deleted.

    Lines are the newline-separated parts of a text that hold a word; lines
    without one are kept and skipped in runs. A line is deleted if a window of
    ``min_lines`` consecutive lines that covers it occurs, with equal lines,
    at an earlier place: a smaller ``doc_id``, or the same document further
    up. With ``min_words``, this also holds for a window of fewer lines that
    have more than ``min_words`` words in all. So the first occurrence of a run always stays, and a document that
    only repeats earlier runs keeps nothing but its other lines.

    Null text stays null; an empty text stays empty. A null ``doc_id`` comes
    after all others. Fully repeated rows count as one document and come out
    equal; rows of one id with different texts are ordered by a text hash. An
    empty table gives an empty result. All columns of ``docs`` are kept, with
    ``text`` replaced; ``before`` names a column for the input text if wanted
    (it must not be a column of ``docs``).
    """
    prepare(docs.sparkSession)
    if before in docs.columns:
        raise ValueError(f"{before} is a column of the input")
    repeated = repeated_lines(docs, min_lines, min_words).select(F.col("dkey").alias("__qs_dkey"), F.col("th").alias("__qs_th"), F.col("starts").alias("__qs_starts"))
    text = F.col("text").cast("string")
    keyed = (docs.withColumn("__qs_dkey", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
             .withColumn("__qs_th", F.xxhash64(text)))
    joined = keyed.join(repeated, ["__qs_dkey", "__qs_th"], "left")
    hit = F.col("__qs_starts").isNotNull()
    joined = joined.withColumn("__qs_new", _without()(F.when(hit, text), F.col("__qs_starts")))
    out = [F.when(hit, F.col("__qs_new")).otherwise(text).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*out, *([text.alias(before)] if before else []))

"""Packing of tokenised documents into fixed-length sequences.

First-fit decreasing with a tournament tree of bin capacities, run
independently in randomised groups of pieces. Documents are tokenised where
they are read; only one small row per piece (no token ids unless asked for)
is shuffled to its group, so groups stay bounded and even whatever the sizes
or sources of the documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import documents
from .encode import SLICE_BYTES, encoder

GROUP_DOCUMENTS = 4096
COPIES = 64                    # equal pieces that go to one group together


class CapacityTree:
    """Bins in order of opening, with the largest free capacity of each
    sub-tree; finds the first bin with room in logarithmic time."""

    def __init__(self, leaves: int, capacity: int):
        self.width = 1
        while self.width < max(leaves, 1):
            self.width *= 2
        self.best = [capacity] * (2 * self.width)

    def place(self, size: int) -> tuple[int, int]:
        """First bin with ``size`` free; returns it and its free room before."""
        best, node = self.best, 1
        while node < self.width:
            node *= 2
            if best[node] < size:
                node += 1
        free = best[node]
        best[node] = free - size
        leaf, node = node - self.width, node // 2
        while node:
            top = max(best[2 * node], best[2 * node + 1])
            if best[node] == top:
                break
            best[node] = top
            node //= 2
        return leaf, free


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each size; sizes must be in decreasing order."""
    full = 0
    while full < len(sizes) and sizes[full] == capacity:
        full += 1
    bins, offsets = list(range(full)), [0] * full
    tree = CapacityTree(len(sizes) - full, capacity)
    for s in sizes[full:]:
        b, free = tree.place(s)
        bins.append(full + b)
        offsets.append(capacity - free)
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 0,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids: ``doc_id, start, length, ids_crc32,
    doc_tokens`` (and ``ids``). A document is its ids and then ``end_id``."""
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    schema += ", ids array<bigint>" if with_ids else ""

    def cut(batches):
        enc = encoder(tokenizer, False)
        for batch in batches:
            texts, doc_ids = ts.plain(batch.column(1)), batch.column(0)
            for lo, hi in ts.slices(texts, SLICE_BYTES):
                flat, first = enc.ids(texts.slice(lo, hi - lo))
                flat = flat.astype("<u4")
                which, start, size, crc, total, ids = [], [], [], [], [], []
                for i in range(hi - lo):
                    own = np.append(flat[first[i]:first[i + 1]], np.uint32(end_id))
                    raw = own.tobytes()
                    for at in range(0, len(own), length):
                        n = min(length, len(own) - at)
                        which.append(lo + i)
                        start.append(at)
                        size.append(n)
                        crc.append(zlib.crc32(raw[4 * at:4 * (at + n)]))
                        total.append(len(own))
                        if with_ids:
                            ids.append(own[at:at + n].astype(np.int64))
                cols = [doc_ids.take(pa.array(which, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, size, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return documents(docs.sparkSession, docs).mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 0,
         group_documents: int = GROUP_DOCUMENTS, with_ids: bool = False) -> DataFrame:
    """Documents packed into sequences of at most ``length`` ids.

    Returns one row per piece: the columns of :func:`token_pieces`, then
    ``sequence_id`` and ``offset`` (gapless from 0 in each sequence). A
    document longer than a sequence is cut into full pieces and a remainder;
    the remainders of a group are placed first-fit decreasing.

    Pieces get their group from a hash of document, start and content, so a
    group holds about ``group_documents`` documents' pieces at any input size.
    Equal pieces (rows without an id or of one id) are counted first and dealt
    to groups by ``COPIES``, so no group grows with the copies of a piece.
    Ties in length are ordered by document, start and content. A very long
    text is tokenised in one task and cut into as many pieces as it needs.

    Null text is an empty document (one piece, the end id alone); a null
    ``doc_id`` stays null. Repeated rows are packed as often as they occur. An
    empty table gives an empty result. Other columns of ``docs`` are ignored.
    """
    groups = max(1, -(-docs.count() // group_documents))
    pieces = token_pieces(docs, tokenizer, length, end_id, with_ids)
    counted = pieces.groupBy(*pieces.columns).agg(F.count("*").alias("copies"))
    dealt = (counted.withColumn("deal", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
             .withColumn("copies", F.least(F.lit(COPIES), F.col("copies") - F.col("deal") * COPIES)))
    grouped = dealt.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "deal"), F.lit(groups)).cast("long"))
    out = [*pieces.columns, "sequence_id", "offset"]

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        table = table.take(np.repeat(np.arange(table.num_rows), table["copies"].to_numpy()))
        bins, offsets = first_fit_decreasing(table["length"].to_pylist(), length)
        base = (table["grp"][0].as_py()) << 32
        table = table.append_column("sequence_id", pa.array(np.array(bins, np.int64) + base))
        table = table.append_column("offset", pa.array(offsets, pa.int64()))
        return table.select(out)

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return grouped.groupBy("grp").applyInArrow(place, schema)

"""Document fingerprints by I-Match.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters
of the lower-cased text. The lexicon is the terms whose inverse document
frequency lies in a chosen band: they are in at least ``band[0]`` and at most
``band[1]`` of all documents. A document keeps its distinct lexicon terms,
sorted, and hashes them once whole and once for each of several random subsets
of the lexicon. One changed term breaks the whole hash, but only the subsets
that hold it, so the share of subset hashes that two documents have in common
tells how alike they are.

Subsets come in sizes: of the lexicon at random a 4th, 16th, ... 4096th part,
``SUBSETS`` of each, so that short and long documents both have subsets with
about one of their terms. A random partition of the lexicon gives several
subsets at once.

The lexicon is broadcast as term hashes. Its size has a bound: every term is
in at least ``band[0]`` of the documents, so there are at most
``mean distinct terms of a document / band[0]`` terms, whatever the corpus.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import documents, id_key

BAND = (0.001, 0.05)           # shares of the documents that hold a lexicon term
PARTS = (4, 16, 64, 256, 1024, 4096)
SUBSETS = 24                   # of each size
WIDTH = 16 + 4 * SUBSETS * len(PARTS)   # hexadecimal digits of a fingerprint

_GAP = np.ones(256, dtype=bool)
for _c in (b"abcdefghijklmnopqrstuvwxyz0123456789", bytes(range(0x80, 0x100))):
    _GAP[list(_c)] = False


def _distinct(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of the distinct terms of each text, sorted."""
    u = ts.cut(pc.utf8_lower(texts), _GAP)
    h, owner = u.hashes(), u.owners()
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], h[new]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``term, n``: how many of the task's documents hold each term."""
    term, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], names=["term", "n"])

    for batch in batches:
        texts = ts.plain(batch.column(0))
        for lo, hi in ts.slices(texts):
            _, h = _distinct(texts.slice(lo, hi - lo))
            both = np.concatenate([term, h])
            weight = np.concatenate([n, np.ones(len(h), np.int64)])
            term, at = np.unique(both, return_inverse=True)
            n = np.bincount(at, weights=weight, minlength=len(term)).astype(np.int64)
            if len(term) > 500_000:
                yield out()
                term, n = term[:0], n[:0]
    yield out()


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Sorted hashes of the terms in at least ``band[0]`` and at most
    ``band[1]`` of the rows of ``docs``."""
    src = documents(docs.sparkSession, docs)
    total = src.count()
    least, most = max(1, math.ceil(band[0] * total)), math.floor(band[1] * total)
    counts = src.select("text").mapInArrow(_terms, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n").between(least, most)).select("term").toArrow().column("term").to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def _sums(where: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of 32-bit values by cell; exact for two million terms a cell."""
    return np.bincount(where, weights=(values & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size).astype(np.uint64)


def _hashes(texts: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the hash of its lexicon terms, and the 16-bit hashes of
    its terms in each subset (0: none there). A text without any lexicon term
    goes by all its terms."""
    n = len(texts)
    owner, h = _distinct(texts)
    at = np.searchsorted(known, h)
    has = known[np.minimum(at, len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
    some = np.zeros(n, bool)
    some[owner[has]] = True
    keep = has | ~some[owner]
    owner, h = owner[keep], h[keep]
    # Hashes of a set's sorted terms are added up, so a subset's terms needn't be put together first.
    r = ts.mix(h ^ np.uint64(0xA5A5))
    whole = ts.mix(_sums(owner, r, n) + (_sums(owner, r >> np.uint64(32), n) << np.uint64(32)))
    short = np.zeros((n, len(PARTS) * SUBSETS), np.uint16)
    for level, parts in enumerate(PARTS):
        rounds = -(-SUBSETS // parts)
        take = SUBSETS // rounds                                  # classes of a partition that are used
        for k in range(rounds):
            r = ts.mix(h ^ np.uint64((1 + level * 1000 + k) * 0x9E3779B97F4A7C15 % 2**64))
            cls = (r & np.uint64(parts - 1)).astype(np.int64)
            use = np.flatnonzero(cls < take)
            total = _sums(owner[use] * take + cls[use], (r[use] >> np.uint64(20)) | np.uint64(1), n * take)
            cell = np.where(total > 0, ts.mix(total) % np.uint64(65535) + np.uint64(1), np.uint64(0)).astype(np.uint16)
            short[:, level * SUBSETS + k * take:][:, :take] = cell.reshape(n, take)
    return whole, short


def _text(whole: np.ndarray, short: np.ndarray) -> pa.Array:
    digits = np.concatenate([whole.astype(">u8").view(np.uint8).reshape(-1, 8), short.astype(">u2").view(np.uint8).reshape(len(whole), -1)], axis=1)
    return pa.array([row.tobytes().hex() for row in digits], pa.string())


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of subset hashes in common, row by row. Of each pair only the
    sizes count at which some subset holds no term of either, as larger
    subsets break too easily; if no size has one, the smallest. Two without terms are alike."""
    a, b = (x.reshape(len(x), len(PARTS), SUBSETS) for x in (a, b))
    either, both = (a > 0) | (b > 0), (a == b) & (a > 0)
    filled = either.sum(axis=2)
    use = filled < 0.8 * SUBSETS
    use[~use.any(axis=1), -1] = True
    # Where the sizes in use hold no term at all, the next larger ones count.
    none = (filled * use).sum(axis=1) == 0
    use[none] = True
    total, same = (filled * use).sum(axis=1), (both.sum(axis=2) * use).sum(axis=1)
    return np.where(total == 0, 1.0, same / np.maximum(total, 1))


def likeness(a: pa.Array, b: pa.Array) -> np.ndarray:
    """How alike the fingerprints ``a`` and ``b`` (hexadecimal) are, 0 to 1:
    an estimate of the share of lexicon terms that the documents have in
    common among those of either. Equal fingerprints give 1."""
    def short(x):
        data = np.frombuffer(bytes.fromhex("".join(x.to_pylist())), np.uint8).reshape(len(x), WIDTH // 2)
        return data[:, 8:].copy().view(">u2").astype(np.uint16)
    out = _agreement(short(a), short(b)) if len(a) else np.zeros(0)
    return np.where(np.array(a.to_pylist(), object) == np.array(b.to_pylist(), object), 1.0, out) if len(a) else out


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """``doc_id, fingerprint`` of each row of ``docs`` (``doc_id, text``): 16
    hexadecimal digits of the whole I-Match hash, then four for each subset
    (0000: no term). Compare two with :func:`likeness`.

    Null and empty texts, and texts without a term, share the fingerprint of
    no terms. A text with terms, but none in the lexicon, goes by all its
    terms. Whole texts count, however long; one very long text is one slice
    of a task. Repeated rows, ids and null ids are rows of their own; equal
    texts have equal fingerprints. An empty table gives an empty result;
    other columns are ignored.
    """
    spark = docs.sparkSession
    src = documents(spark, docs)
    known = spark.sparkContext.broadcast(lexicon(docs, band))

    def scan(batches):
        for batch in batches:
            texts = ts.plain(batch.column(1))
            for lo, hi in ts.slices(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), _text(*_hashes(texts.slice(lo, hi - lo), known.value))], names=["doc_id", "fingerprint"])

    return src.mapInArrow(scan, "doc_id bigint, fingerprint string")


# ------------------------------------------------- neighbours and edited texts

_KEYS = ["key", "th", "at"]


def _bounds(keyed: DataFrame, parts: int) -> list[tuple]:
    """Least keys of all but the first of about ``parts`` blocks, from a
    sample of about 20 keys a block (as Spark's own range partitioning takes)."""
    keys = keyed.select(*_KEYS)
    every = max(1, keys.count() // (20 * parts))
    sample = sorted(map(tuple, keys.where(F.pmod(F.xxhash64(*_KEYS), F.lit(every)) == 0).collect()))
    step = max(1, len(sample) // parts)
    return sorted(set(sample[step::step]))


def with_next(docs: DataFrame) -> DataFrame:
    """Texts in order of ``doc_id`` (null first, equal ids by a hash of their
    texts, equal rows as they come), in blocks of consecutive rows: ``block,
    tail, doc_id, text``, each partition sorted. Every block ends with a
    ``tail`` row, a copy of the row that follows it (after the last: the
    first), so a task knows the next text of each of its rows.

    Texts are shuffled once. The driver sees a few keys a block, and there
    are four blocks a shuffle partition."""
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows are told apart by their place in the input, which a repeated task finds the same.
    keyed = documents(spark, docs).select("doc_id", "text", id_key().alias("key"), F.xxhash64("text").alias("th"), F.monotonically_increasing_id().alias("at"))
    bounds = _bounds(keyed, 4 * width)

    def place(batches):
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in _KEYS)))
            yield pa.RecordBatch.from_arrays([pa.array([bisect.bisect_right(bounds, k) for k in keys], pa.int32()), *(batch.column(c) for c in _KEYS)], names=["block", *_KEYS])

    firsts = keyed.select(*_KEYS).mapInArrow(place, "block int, key bigint, th bigint, at bigint").groupBy("block").agg(F.min(F.struct(*_KEYS)).alias("k")).collect()
    order = sorted((r["block"], tuple(r["k"])) for r in firsts)
    before = {k: order[i - 1][0] for i, (_, k) in enumerate(order)}

    def deal(batches):
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in _KEYS)))
            rows = [(i, bisect.bisect_right(bounds, k), False) for i, k in enumerate(keys)] + [(i, before[k], True) for i, k in enumerate(keys) if k in before]
            out = batch.take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.bool_()), *out.columns],
                                             names=["block", "tail", *out.schema.names])

    dealt = keyed.mapInArrow(deal, "block int, tail boolean, doc_id bigint, text string, key bigint, th bigint, at bigint")
    return dealt.repartition(width, "block").sortWithinPartitions("block", "tail", *_KEYS).select("block", "tail", "doc_id", "text")


def edited_report(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Fingerprints held against edits: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``. The edited text
    has the last half of its code points (rounded down) replaced by the first
    as many of the next document (or all it has); ``near_...`` is the
    :func:`likeness` of the document's fingerprint to that of the edited text
    and of the next document. Order and next document as in :func:`with_next`;
    null texts are empty; otherwise as :func:`fingerprints`."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(lexicon(docs, band))

    def report(table: pa.Table):
        texts = ts.plain(table["text"])
        block, tail = table["block"].to_numpy(), table["tail"].to_pylist()
        plain = texts.to_pylist()
        rows = [i for i in range(len(plain) - 1) if not tail[i] and block[i] == block[i + 1]]
        edited = [plain[i][:len(plain[i]) - len(plain[i]) // 2] + plain[i + 1][:len(plain[i]) // 2] for i in rows]
        whole, short = _hashes(texts, known.value)
        whole2, short2 = _hashes(pa.array(edited, pa.large_string()), known.value)
        at = np.array(rows, np.int64)
        near = [np.where(w == whole[at], 1.0, _agreement(short[at], s)) for w, s in ((whole2, short2), (whole[at + 1], short[at + 1]))]
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in edited]
        return pa.RecordBatch.from_arrays(
            [table["doc_id"].combine_chunks().take(pa.array(at)), pa.array([len(plain[i]) for i in rows], pa.int64()), pa.array(sha, pa.string()),
             _text(whole[at], short[at]), _text(whole2, short2), pa.array(near[0]), pa.array(near[1])],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def scan(batches):
        last = None                                               # the row whose next one is still to come
        for batch in batches:
            for lo, hi in ts.slices(ts.plain(batch.column(3))):
                now = pa.Table.from_batches([batch.slice(lo, hi - lo)])
                now = now if last is None else pa.concat_tables([last, now])
                yield report(now)
                last = now.slice(len(now) - 1)

    return with_next(docs).mapInArrow(scan, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

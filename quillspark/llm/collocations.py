"""Phrase collocations by multikey three-way quicksort of suffix pointers.

A suffix pointer stands for the words from one place of a text to the end of
its piece, looked at down to ``DEPTH`` words. Words are 64-bit hashes with
their language in them (checked to be one to one over all words).

Counting words comes first: the sizes of the partitions by leading word. A
phrase can be frequent only if all its words are, so pointers end before the
first infrequent word; a bitmap of fixed size tells which words may be
frequent. Pointers are routed to the tasks by their two leading words, equal
ones of a batch folded with their number. In a task, a multikey three-way
quicksort parts them by first word, equal ones by second, and so on down to
``DEPTH``: sizes of equal partitions are the counts of the phrases, and a
partition of any kind that is smaller than the least count is abandoned, as
nothing in it can be frequent. All partitions of a step are parted at once.

A pair of words can hold many pointers only if both words do. The words that
make up more than one in ``HOT`` of all (so at most ``HOT`` of them) are
known from the first step; pointers led by two of them are routed by three
words, and their pairs' counts added up over the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textscan as ts
from .common import prepare, stored

DEPTH = 3
HOT = 2000
FOLD = 800_000                 # pointers that are folded at once
BITS = (1 << 16, 1 << 27)      # of the bitmap: fewest, most; sixteen a frequent word between
TASK_ROWS = 1_000_000          # pointers of a task, at most about, beyond the session's number of partitions

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


def _source(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def _words(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[ts.Units, np.ndarray, pa.Array]]:
    """The words of slices of documents, their hashes (never 0) and the languages of the documents."""
    for batch in batches:
        texts = pc.ascii_lower(ts.plain(batch.column(0)))
        for lo, hi in ts.slices(texts):
            u = ts.cut(texts.slice(lo, hi - lo), _GAP)
            lang = batch.column(1).slice(lo, hi - lo)
            salt = np.array([xxhash.xxh3_64_intdigest(x, seed) for x in lang.to_pylist()], np.uint64)
            h = ts.mix(u.hashes() ^ salt[u.owners()])
            h[h == 0] = 1
            yield u, h, lang


def _count_words(seed: int):
    """``h, lang, word, n`` of the words of a task."""
    def run(batches):
        h, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        word, lang = pa.array([], pa.large_string()), pa.array([], pa.string())

        def out():
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), lang, word.cast(pa.string()), pa.array(n)], names=["h", "lang", "word", "n"])

        for u, now, langs in _words(batches, seed):
            one, first, count = np.unique(now, return_index=True, return_counts=True)
            spell = pa.array([u.data[a:b].tobytes().decode() for a, b in zip(u.start[first].tolist(), u.end[first].tolist())], pa.large_string())
            speak = langs.take(pa.array(u.owners()[first]))
            if len(h) == 0:
                h, n, word, lang = one, count, spell, speak
            else:
                h, at, back = np.unique(np.concatenate([h, one]), return_index=True, return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([n, count]), minlength=len(h)).astype(np.int64)
                word = pa.concat_arrays([word, spell]).take(pa.array(at))
                lang = pa.concat_arrays([lang, speak]).take(pa.array(at))
            if len(h) > 300_000:
                yield out()
                h, n, word, lang = h[:0], n[:0], word[:0], lang[:0]
        yield out()
    return run


def word_counts(docs: DataFrame) -> tuple[DataFrame, int]:
    """``h, lang, word, n`` of all words, and the seed of the hashes: the
    first for which no two words share a hash."""
    src = _source(docs)
    for seed in range(8):
        counts = src.mapInArrow(_count_words(seed), "h bigint, lang string, word string, n bigint")
        counts = stored(counts.groupBy("h", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if not counts.groupBy("h").count().where("count > 1").limit(1).count():
            return counts, seed
    raise RuntimeError("words share hashes under every seed")


def _bitmap(frequent: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Bits set for the hashes ``h`` of ``frequent``, at most ``BITS[1]`` of them."""
    bits = BITS[0]
    while bits < BITS[1] and bits < 16 * n:
        bits *= 2
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    got = frequent.select(F.shiftright(at, 6).alias("at"), F.expr("shiftleft(1L, int(h & 63))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return out, bits


def _in_bitmap(h: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    at = h & np.uint64(bits - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _pointers(seed: int, known, bits: int, hot, buckets: int):
    """Suffix pointers of a task, folded: a row for each bucket with the
    arrays ``w1, w2, w3`` (0: the piece ends or an infrequent word follows) and ``n``."""
    def fold(chunks: list) -> Iterator[pa.RecordBatch]:
        w1, w2, w3 = (np.concatenate(c) for c in zip(*chunks))
        chunks.clear()
        order = np.lexsort((w3, w2, w1))
        w1, w2, w3 = w1[order], w2[order], w3[order]
        new = np.ones(len(w1), bool)
        new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]) | (w3[1:] != w3[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(w1)))
        w1, w2, w3 = w1[first], w2[first], w3[first]
        bucket = (_route(w1, w2, w3, hot.value) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        where, start = np.unique(bucket[order], return_index=True)
        offsets = pa.array(np.append(start, len(order)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order].view(np.int64))) for x in (w1, w2, w3)]
        yield pa.RecordBatch.from_arrays([pa.array(where), *lists, pa.ListArray.from_arrays(offsets, pa.array(n[order].astype(np.int32)))], names=["bucket", "w1", "w2", "w3", "n"])

    def run(batches):
        chunks, size = [], 0
        for u, h, _ in _words(batches, seed):
            if len(h) < 2:
                continue
            ok = _in_bitmap(h, known.value, bits)
            breaks = np.concatenate([[0], np.cumsum(_BREAK[u.data[:len(u.data) - 8]])])
            owner = u.owners()
            # Whether each word and the one after it stand in one piece and are both candidates.
            follows = (owner[1:] == owner[:-1]) & (breaks[u.start[1:]] == breaks[u.end[:-1]]) & ok[1:] & ok[:-1]
            at = np.flatnonzero(follows)
            third = np.append(follows, False)[at + 1]
            w3 = np.where(third, h[np.minimum(at + 2, len(h) - 1)], np.uint64(0))
            chunks.append((h[at], h[at + 1], w3))
            size += len(at)
            if size >= FOLD:
                yield from fold(chunks)
                size = 0
        if size:
            yield from fold(chunks)
    return run


def _is_hot(w: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return hot[np.minimum(np.searchsorted(hot, w), len(hot) - 1)] == w if len(hot) else np.zeros(len(w), bool)


def _route(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, hot: np.ndarray) -> np.ndarray:
    both = _is_hot(w1, hot) & _is_hot(w2, hot)
    return ts.mix(ts.mix(w1) + w2 + np.where(both, ts.mix(w3), np.uint64(0)))


def multikey_quicksort(keys: list[np.ndarray], n: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Three-way quicksort of rows by ``keys`` down to the last of them.
    Yields ``(depth, rows, sizes)``: a row of each partition that is equal in
    the first ``depth`` keys, and the partition's size, the sum of ``n``.
    Partitions smaller than ``least`` are abandoned, whether equal, less or
    greater than their pivot. A key of 0 ends a row: it has no partition at
    that depth. Each step parts all open partitions around a pivot of each."""
    rows = np.arange(len(n))
    size = np.array([len(n)], np.int64)                           # rows of the open partitions, one after the other
    depth = np.zeros(1, np.int64)
    rng = np.random.default_rng(len(n))
    while len(rows):
        part = np.repeat(np.arange(len(size)), size)
        start = np.cumsum(size) - size
        key = np.empty(len(rows), np.uint64)
        at = depth[part]
        for d, k in enumerate(keys):
            mine = at == d
            key[mine] = k[rows[mine]]
        pivot = key[start + (rng.random(len(size)) * size).astype(np.int64)][part]
        three = part * 3 + (key > pivot).astype(np.int64) + (key >= pivot)      # less, equal, greater
        order = np.argsort(three, kind="stable")
        rows, three = rows[order], three[order]
        cells = 3 * len(size)
        total = np.bincount(three, weights=n[rows], minlength=cells).astype(np.int64)
        count = np.bincount(three, minlength=cells)
        begin = np.cumsum(count) - count
        cell = np.arange(cells)
        equal = (cell % 3 == 1) & (total >= least)
        level = depth[cell // 3] + equal
        first = rows[np.minimum(begin, len(rows) - 1)]
        for d in range(1, len(keys) + 1):
            found = np.flatnonzero(equal & (level == d))
            found = found[keys[d - 1][first[found]] != 0]
            if len(found):
                yield d, first[found], total[found]
        ended = np.zeros(cells, bool)
        for d in range(1, len(keys)):                             # rows that end here have nothing deeper
            ended |= equal & (level == d) & (keys[d - 1][first] == 0)
        keep = (total >= least) & (level < len(keys)) & ~ended
        rows, size, depth = rows[keep[three]], count[keep], level[keep]


def _phrases(least: int, hot):
    """``w1, w2, w3, n`` of the frequent phrases of a task (``w3`` 0: a pair);
    pairs of two hot words with what the task has of them."""
    def run(batches):
        got = [[np.zeros(0, np.uint64)] for _ in range(3)] + [[np.zeros(0, np.int64)]]
        for batch in batches:
            for i, c in enumerate(("w1", "w2", "w3", "n")):
                flat = batch.column(c).flatten().to_numpy()
                got[i].append(flat.view(np.uint64) if i < 3 else flat.astype(np.int64))
        w1, w2, w3, n = (np.concatenate(g) for g in got)
        got.clear()
        both = _is_hot(w1, hot.value) & _is_hot(w2, hot.value)
        for mine, limit in ((~both, least), (both, 1)):
            keys, weight = [w1[mine], w2[mine], w3[mine]], n[mine]
            if not len(weight):
                continue
            for depth, rows, sizes in multikey_quicksort(keys, weight, limit):
                keep = sizes >= (least if depth == 3 else limit)
                if depth > 1 and keep.any():
                    at = rows[keep]
                    third = keys[2][at] if depth == 3 else np.zeros(len(at), np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (keys[0][at], keys[1][at], third)] + [pa.array(sizes[keep])], names=["w1", "w2", "w3", "n"])
    return run


def phrase_counts(docs: DataFrame, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """Exact counts of the phrases of two and three words that occur ``least``
    times or more (``w1, w2, w3, n``; ``w3`` 0 for pairs), and all words
    (``h, lang, word, n``)."""
    spark = docs.sparkSession
    words, seed = word_counts(docs)
    frequent = words.where(F.col("n") >= least)
    total = words.agg(F.sum("n")).first()[0] or 0
    known, bits = _bitmap(frequent, frequent.count())
    known = spark.sparkContext.broadcast(known)
    top = words.where(F.col("n") * HOT > total).select("h").toArrow().column("h").to_numpy().astype(np.int64)
    hot = spark.sparkContext.broadcast(np.sort(top.view(np.uint64)))
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))
    found = _source(docs).mapInArrow(_pointers(seed, known, bits, hot, 4 * width), "bucket int, w1 array<bigint>, w2 array<bigint>, w3 array<bigint>, n array<int>")
    found = found.repartition(width, "bucket").mapInArrow(_phrases(least, hot), "w1 bigint, w2 bigint, w3 bigint, n bigint")
    found = found.groupBy("w1", "w2", "w3").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return stored(found, "phrases"), words


def _score(a: str, left: str, right: str) -> Column:
    """``floor(1000000 * a * a / (left * right))``: 38-digit decimals and
    integer division, exact for counts up to 10 ** 15."""
    d = "cast({} as decimal(18,0))".format
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({d(a)} * {d(a)})) div ({d(left)} * {d(right)})")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, share: int = 50) -> DataFrame:
    """Collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), split at ``[.,;:!?]`` and U+000A to U+000D
    into pieces and those at space and tab into words. Candidates are phrases
    of two or three words that occur ``a >= least`` times within pieces.
    Cutting one after its first ``k`` words gives ``l`` and ``r``, the counts
    of its two parts, and the score ``floor(1000000 a a / (l r))``; the least
    score counts, of equal ones the least ``k``. A pair inside a candidate of
    three words with at least ``share`` percent of the pair's count is
    dropped. ``n`` counts the language's words. Rows are ranked by score, then
    ``a`` (both descending), then phrase (UTF-8 bytes), the first ``top`` of
    each language returned.

    A null ``lang`` is ``und``. Null and empty texts have no words; whole
    texts count, however long, and repeated rows and ids count as often as
    they stand there. ``doc_id`` is not read, nor any other column. Ties have
    a rank each, by phrase. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    found, words = phrase_counts(docs, least)
    spelt = words.where(F.col("n") >= least)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    first = spelt.select(F.col("h").alias("w1"), "lang", F.col("word").alias("t1"), F.col("n").alias("f1"))
    later = lambda i: spelt.select(F.col("h").alias(f"w{i}"), F.col("word").alias(f"t{i}"), F.col("n").alias(f"f{i}"))
    pairs, triples = found.where("w3 = 0").drop("w3"), found.where("w3 != 0")

    longest = (triples.select("w1", "w2", "n").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
               .groupBy("w1", "w2").agg(F.max("n").alias("longer")))
    two = pairs.join(longest, ["w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("n"))).drop("longer")
    two = two.join(first, "w1").join(later(2), "w2")
    two = two.select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("n").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"), _score("n", "f1", "f2").alias("score"))

    head = pairs.select("w1", "w2", F.col("n").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("f23"))
    three = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(first, "w1").join(later(2).drop("f2"), "w2").join(later(3), "w3")
    three = three.withColumn("s1", _score("n", "f1", "f23")).withColumn("s2", _score("n", "f12", "f3"))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), F.col("n").alias("a"), F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                         F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The first of each share of a language's phrases; its own first ones are among them.
    scored = two.unionByName(three).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    scored = scored.withColumn("i", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("i") <= top)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

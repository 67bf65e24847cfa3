"""Substring dedup with suffix automata.

The reference is the corpus itself, so one automaton, or one broadcast per
shard of it, would grow with the input. The reference is therefore cut into
small shards that only hold what can match: every window of ``window`` words
has a key, the least hash of the ``GRAM``-word runs in it, and equal windows
have equal keys. Keys that occur once are dropped by a count. Of the rest, a
document's consecutive windows with one key are a segment, and a shard is the
segments of one key. Each shard's suffix automaton is built in document order
and the segments are streamed through it; the matching statistics tell, for
every place where a match of ``window`` words ends, the first document that
has it. Words under a window that an earlier document has are removed.

Keys found in many rows (passages that a large part of all documents share)
make no shard: their segments fall into single windows, whose first document
is an aggregate by content, combined before the shuffle. So no shard exceeds
``HOT`` rows. Of equal texts only that of the least id is searched; the others
are its copies as a whole.

Texts are shuffled once, compressed, by a hash of their content: finding the
segments and removing the words read the same exchange.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import documents
from .line_dedup import LAST, runs

WINDOW = 13
GRAM = 4
HOT = 64
_SEGMENT = 32                  # windows of one segment at most
_SHIFT = np.uint64(16)         # keys of 48 bits: a chance meeting only costs a comparison; hot windows are known by 48 + 48 bits
_RUN_BITS = 6                  # a run of windows is its first one and its length in one number
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class FirstOwners:
    """Generalised suffix automaton over words. Segments are added in
    ascending order of their owner; each state knows the first owner of its
    substrings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.owner = [-1], [0], [None]

    def _state(self, length: int, owner: int, edges: dict) -> int:
        self.next.append(edges)
        self.len.append(length)
        self.link.append(0)
        self.owner.append(owner)
        return len(self.len) - 1

    def _split(self, p: int, q: int, word) -> int:
        """A copy of ``q`` for the shorter substrings that end at ``p`` and ``word``."""
        clone = self._state(self.len[p] + 1, self.owner[q], dict(self.next[q]))
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, owner: int) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.len[q] == self.len[last] + 1 else self._split(last, q, word)
                continue
            new, p = self._state(self.len[last] + 1, owner, {}), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, word)
            last = new

    def stream(self, words: list, window: int) -> list:
        """For each window of ``words`` its first owner, or ``None``."""
        state, length, out = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            while self.len[self.link[state]] >= window if state else False:
                state = self.link[state]
                length = self.len[state]
            if i >= window - 1:
                out.append(self.owner[state] if length >= window else None)
        return out


def _window_keys(u: ts.Units, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = u.hashes()
    keys = ts.sliding_min(ts.ngrams(h, GRAM), window - GRAM + 1) >> _SHIFT
    return h, keys, ts.inside(u, window)


def _keys(window: int):
    """Keys of each text (``text, dkey``), one row per run of windows."""
    def scan(batches):
        for batch in batches:
            texts = ts.plain(batch.column(0))
            for lo, hi in ts.slices(texts):
                u = ts.cut(texts.slice(lo, hi - lo))
                _, keys, valid = _window_keys(u, window)
                start, _ = runs(keys, valid, 1 << 40)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[start].view(np.int64)), batch.column(1).take(pa.array(u.owners()[start] + lo))], names=["fp", "dkey"])
    return scan


def _compress(batches):
    """``doc_id, dkey, th, tg`` and the text, compressed one by one."""
    pack = zstandard.ZstdCompressor(level=6)
    for batch in batches:
        texts = batch.column(4)
        z = pa.array([None if not t.is_valid else pack.compress(t.as_buffer()) for t in texts.cast(pa.binary())], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], z], names=["doc_id", "dkey", "th", "tg", "z"])


def _texts(z: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return ts.plain(pa.array([b"" if x is None else unpack.decompress(x) for x in z.to_pylist()], pa.large_binary()).cast(pa.large_string()))


def _segments(window: int, hot: bool):
    """Segments of the keys (``keys``) that were found more than once, of the
    first document of each text: their words, or for hot keys the hashes of
    their windows."""
    def scan(batches):
        for batch in batches:
            wanted = pc.and_(pc.equal(batch.column("dkey"), batch.column("mind")),
                                     pc.greater(pc.list_value_length(batch.column("keys")), 0))
            batch = batch.filter(wanted)
            texts = _texts(batch.column("z"))
            for lo, hi in ts.slices(texts):
                u = ts.cut(texts.slice(lo, hi - lo))
                h, keys, valid = _window_keys(u, window)
                here = np.unique(batch.column("keys").slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
                start, size = runs(keys, valid & np.isin(keys, here), _SEGMENT)
                own = u.owners()[start]
                if hot:
                    content = (ts.ngrams(h, window) >> _SHIFT).view(np.int64)
                    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    flat = np.repeat(start - offsets[:-1], size) + np.arange(int(offsets[-1]))
                    body = pa.ListArray.from_arrays(pa.array(offsets), pa.array(content[flat]))
                else:
                    view = u.data.tobytes()
                    body = pa.array([b" ".join(view[a:b].split()).decode() for a, b in zip(u.start[start].tolist(), u.end[start + size + window - 2].tolist())], pa.string())
                take = pa.array(own + lo)
                yield pa.RecordBatch.from_arrays([pa.array(keys[start].view(np.int64)), body, *[batch.column(c).take(take) for c in ("dkey", "tag")],
                                                  pa.array(start - u.first[own])], names=["fp", "body", "dkey", "tag", "start"])
    return scan


def _shards(window: int):
    """Windows of each segment that an earlier document has. Rows (``fp,
    words, dkey, tag, start``) arrive sorted by key and document."""
    def answers(group: list) -> list:
        """First owners of the windows of each distinct segment, in order of its own first document."""
        owners, auto = {}, FirstOwners()
        distinct = {}
        for words, owner, *_ in group:
            distinct.setdefault(words, owner)
        for text, owner in distinct.items():
            words = text.split(" ")
            if len(distinct) == 1:
                owners[text] = [owner] * (len(words) - window + 1)
                break
            owners[text] = [owner if x is None else x for x in auto.stream(words, window)]
            auto.add(words, owner)
        out = []
        for words, dkey, tag, start in group:
            spans = []
            for i, o in enumerate(owners[words]):
                if o < dkey:
                    if spans and spans[-1][0] + spans[-1][1] == start + i:
                        spans[-1][1] += 1
                    else:
                        spans.append([start + i, 1])
            if spans:
                out.append((dkey, tag, [at << _RUN_BITS | n for at, n in spans]))
        return out

    def rows(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()),
                                           pa.array([r[2] for r in out], pa.list_(pa.int64()))], names=["dkey", "tag", "runs"])

    def run(batches):
        key, group = None, []
        for batch in batches:
            out = []
            for fp, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if fp != key:
                    if len(group) > 1:
                        out += answers(group)
                    group = []
                key = fp
                group.append(row)
            yield rows(out)
        if len(group) > 1:
            yield rows(answers(group))
    return run


def _same_text(one: DataFrame, other: DataFrame):
    """Equal text hashes. The second hash is compared in a form that is no
    join key, so that ``th`` alone says where rows go."""
    return (one["th"] == other["th"]) & (one["tg"].bitwiseXOR(other["tg"]) == 0)


def _places(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The compressed documents, and ``th, tg, mind, runs`` of each distinct
    text: the least id that has it and its windows that a smaller id has.
    ``docs`` has ``doc_id, dkey, th, tg, text``."""
    packed = docs.select("doc_id", "dkey", "th", "tg", "text").mapInArrow(_compress, "doc_id bigint, dkey bigint, th bigint, tg int, z binary")
    firsts = docs.groupBy("th", "tg").agg(F.min("dkey").alias("mind"))
    # Tells an id's texts apart where it has several; 0, which costs nothing, nearly everywhere.
    several = firsts.groupBy("mind").agg(F.count("*").alias("texts")).where("texts > 1")
    firsts = firsts.join(several, "mind", "left").withColumn("tag", F.when(F.col("texts").isNull(), 0).otherwise(F.col("tg"))).drop("texts")
    keys = docs.select("text", "dkey").mapInArrow(_keys(window), "fp bigint, dkey bigint")
    shared = keys.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp", (F.col("n") > HOT).alias("hot"))
    # The shared keys are distinct and the smaller side of each partition.
    lists = (keys.join(shared.hint("shuffle_hash"), "fp").groupBy(F.col("dkey").alias("mind"))
             .agg(F.collect_set(F.when(~F.col("hot"), F.col("fp"))).alias("fps"), F.collect_set(F.when(F.col("hot"), F.col("fp"))).alias("hots")))
    wanted = firsts.join(lists, "mind")
    # The text is partitioned by th, here and for the removal: one exchange serves both.
    told = packed.join(wanted, _same_text(packed, wanted)).select("z", "dkey", "tag", "mind", "fps", "hots")

    def found(keys: str, kind: str) -> DataFrame:
        return (told.select("z", "dkey", "tag", "mind", F.col(keys).alias("keys"))
                .mapInArrow(_segments(window, keys == "hots"), f"fp bigint, body {kind}, dkey bigint, tag int, start bigint"))

    shards = found("fps", "string").repartition("fp").sortWithinPartitions("fp", "dkey")
    cold = shards.mapInArrow(_shards(window), "dkey bigint, tag int, runs array<bigint>")
    single = (found("hots", "array<bigint>").select("fp", "dkey", "tag", "start", F.posexplode("body").alias("i", "content"))
              .select("fp", "content", "dkey", "tag", (F.col("start") + F.col("i")).alias("at")))
    first = single.groupBy("fp", "content").agg(F.min("dkey").alias("first"))
    hot = (single.join(first, ["fp", "content"]).where("first < dkey")
           .select("dkey", "tag", F.array(F.shiftleft("at", _RUN_BITS).bitwiseOR(1)).alias("runs")))
    removed = (cold.unionByName(hot).groupBy(F.col("dkey").alias("mind"), "tag")
               .agg(F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs")))
    return packed, firsts.join(removed, ["mind", "tag"], "left")


def _apply(window: int):
    schema = "n_words bigint, n_removed bigint, kept string, kept_sha256 string"

    @F.pandas_udf(schema)
    def apply(z: pd.Series, runs: pd.Series, copy: pd.Series) -> pd.DataFrame:
        rows, unpack = [], zstandard.ZstdDecompressor()
        for body, at, whole in zip(z, runs, copy):
            words = _WORD.findall(unpack.decompress(body).decode()) if body is not None else []
            n = len(words)
            if whole and n >= window:
                words = []
            elif at is not None and n:
                mark = np.zeros(n + 1, np.int64)
                at = np.asarray(at, np.int64)
                first, count = at >> _RUN_BITS, at & ((1 << _RUN_BITS) - 1)
                np.add.at(mark, first, 1)
                np.add.at(mark, np.minimum(first + count - 1 + window, n), -1)
                stay = np.cumsum(mark[:n]) == 0
                words = [w for w, s in zip(words, stay) if s]
            kept = " ".join(words)
            rows.append((n, n - len(words), kept, hashlib.sha256(kept.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept", "kept_sha256"])
    return apply


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Removes passages of ``window`` words or more that an earlier document has.

    Words are maximal runs of characters other than space and U+0009 to
    U+000D. A word is removed if a window of ``window`` consecutive words that
    covers it also starts in a document with a smaller ``doc_id``; windows are
    judged on the input. Returns ``doc_id, n_words, n_removed, kept``
    (remaining words joined by one space) and ``kept_sha256``, a row per row.

    Null text has no words. A null ``doc_id`` comes after all others. Rows of
    one id don't remove words from each other. An empty table gives an empty
    result; other columns are ignored.
    """
    keyed = (documents(docs.sparkSession, docs)
             .select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("dkey"), F.xxhash64("text").alias("th"), F.hash("text").alias("tg"), "text"))
    packed, places = _places(keyed, window)
    joined = packed.join(places, _same_text(packed, places), "left")
    return (joined.select("doc_id", _apply(window)(F.col("z"), F.col("runs"), F.col("dkey") > F.col("mind")).alias("r"))
            .select("doc_id", "r.n_words", "r.n_removed", "r.kept", "r.kept_sha256"))

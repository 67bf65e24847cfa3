"""N-gram Jaccard join by chosen paths.

A document is its set of hashed word n-grams. Documents with equal sets are
folded first. A run splits the sets on sampled shared tokens: token ``t`` of
``x`` is chosen if its seeded hash falls below ``RATE / (threshold * |x|)``,
so two sets at the threshold choose about ``RATE`` tokens in common whatever
their sizes. Runs are repeated until a pair at the threshold is missed with
at most ``1 - RECALL``, the further levels counted in. A large bucket of which
at least half is near one of its members, by sketch, would hold together on
every further level: it becomes one plausible part as a whole, and no pair in
it is missed. Any other large bucket is split again, each member going on with
``SPREAD`` of its sampled tokens, each the least under a hash seeded by the
path so far: a pair goes on together with one token about as often as it is
similar. Small buckets are
compared pair by pair on short sketches, which only yields a spanning forest
of plausible pairs. The connected parts of the forest are then verified
exactly, all pairs of a part in one task, or in blocks of it where it is
large; only counts and forest edges leave a task, never all pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import documents, id_key, stored

RATE = 3.0
SKETCH_RATE = 24.0             # further tokens in common, for the sketch alone
SPREAD = (2, 2, 1)             # tokens that a member of a large bucket goes on with, a level
SPLIT_MARGIN = 0.1             # the samples of a pair may agree this much less than its sets
RECALL = 0.99999
SMALL = 64                     # members of a bucket that is compared
NEAR = 0.6                     # likeness of sketches at which a member is near the one it is held against
MAX_BROADCAST = 500_000        # ids (48 bytes each) that are broadcast; beyond it they are shuffled
BLOCK = 1024                   # sets of a block of a part that is verified


def runs_needed(recall: float = RECALL, rate: float = RATE, threshold: float = 0.8) -> int:
    """Runs until a pair at the threshold is missed with ``1 - recall`` at most,
    if every bucket it meets is large on every level. Tokens in common are
    Poisson with ``rate`` a run; one is of no use if all that follows parts the pair."""
    agree, lost = max(threshold - SPLIT_MARGIN, 0.05), 0.0
    for m in reversed(SPREAD):
        lost = (1 - agree + agree * lost) ** m
    return max(1, math.ceil(-math.log(1 - recall) / (rate * (1 - lost))))


def shingles(u: ts.Units, h: np.ndarray, i: int, grams: np.ndarray, n: int) -> np.ndarray:
    """Distinct n-gram hashes of document ``i``; a shorter text is one n-gram."""
    a, b = u.first[i], u.first[i + 1]
    if b - a >= n:
        return np.unique(grams[a:b - n + 1])
    return ts.ngrams(h[a:b], int(b - a)) if b > a else grams[:0]


def set_id(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketch(n: int, threshold: float, runs: int):
    """``doc_id, th, sid, n``, the chosen tokens of all runs, and 16 bits of
    each of them and of the sketch's own tokens."""
    seeds = ts.mix(np.arange(1, runs + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def below(s, seed, rate):
        limit = min(rate / (threshold * max(len(s), 1)), 1.0)
        t = ts.mix(s ^ seed)
        return t[t <= np.uint64(min(int(limit * 2.0**64), 2**64 - 1))]

    def scan(batches):
        for batch in batches:
            texts = ts.plain(batch.column(1))
            for lo, hi in ts.slices(texts):
                u = ts.cut(texts.slice(lo, hi - lo))
                h = u.hashes()
                grams = ts.ngrams(h, n)
                ids, sizes, chosen, sketch = [], [], [], []
                for i in range(hi - lo):
                    s = shingles(u, h, i, grams, n)
                    ids.append(set_id(s))
                    sizes.append(len(s))
                    own = np.concatenate([below(s, seed, RATE) for seed in seeds[:-1]])
                    chosen.append(own.view(np.int64))
                    sketch.append(np.concatenate([own, below(s, seeds[-1], SKETCH_RATE)]).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(chosen, pa.list_(pa.int64())), pa.array(sketch, pa.binary())], names=["doc_id", "th", "sid", "n", "chosen", "sketch"])
    return scan


def _plausible(a: set, b: set, na: int, nb: int, threshold: float, runs: int) -> bool:
    """Whether two sets share about as many sampled tokens as sets at the
    threshold do; a third of that is allowed, missed once in a million."""
    if min(na, nb) < threshold * max(na, nb):
        return False
    most = threshold * max(na, nb)
    return len(a & b) >= (runs * min(RATE, most) + min(SKETCH_RATE, most)) / 3


def _forest(threshold: float, runs: int):
    """Spanning forests of the plausible pairs of each bucket; rows arrive sorted by bucket."""
    def edges(group: list) -> tuple[list, list]:
        group = list({g[0]: g for g in group}.values())
        root = list(range(len(group)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        a, b = [], []
        for i in range(len(group)):
            for j in range(i):
                ri, rj = find(i), find(j)
                if ri != rj and _plausible(group[i][2], group[j][2], group[i][1], group[j][1], threshold, runs):
                    root[max(ri, rj)] = min(ri, rj)
                    a.append(group[j][0])
                    b.append(group[i][0])
        return a, b

    def run(batches):
        bucket, group, seen = None, [], set()

        def out(a, b):
            pairs = [(x, y) if x < y else (y, x) for x, y in zip(a, b)]
            pairs = [p for p in dict.fromkeys(pairs) if p not in seen]
            if len(seen) < 1_000_000:      # only saves repeats; distinct() follows
                seen.update(pairs)
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], names=["a", "b"])

        for batch in batches:
            a, b = [], []
            for key, sid, n, sketch in zip(*(c.to_pylist() for c in batch.columns)):
                if key != bucket and group:
                    x, y = edges(group)
                    a += x
                    b += y
                    group = []
                bucket = key
                group.append((sid, n, set(np.frombuffer(sketch, "<u2").tolist())))
            yield out(a, b)
        if group:
            yield out(*edges(group))
    return run


def _stars(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Edges ``a, b`` from each bucket's ``centre`` to its other members."""
    return (members.join(centres, "path").where("sid != centre")
            .select(F.least("centre", "sid").alias("a"), F.greatest("centre", "sid").alias("b")))


def _near_copies(held: DataFrame) -> DataFrame:
    """``path, centre`` of the buckets of ``held`` (``path, sid, sketch``) of
    which at least half is near the member of the least or the greatest id:
    two tries, as one may be an outlier. One row a bucket is joined back."""
    ends = held.groupBy("path").agg(F.min(F.struct("sid", "sketch")).alias("low"), F.max(F.struct("sid", "sketch")).alias("high"))
    pairs = held.join(ends, "path").select("path", "sketch", F.col("low.sketch").alias("low"), F.col("high.sketch").alias("high"))
    shares = pairs.mapInArrow(_near_ends, "path bigint, low int, high int").groupBy("path").agg(F.avg("low").alias("low"), F.avg("high").alias("high"))
    centres = shares.where("greatest(low, high) >= 0.5").select("path", (F.col("low") >= 0.5).alias("first"))
    return (ends.select("path", F.col("low.sid").alias("least"), F.col("high.sid").alias("greatest")).join(centres, "path")
            .select("path", F.when(F.col("first"), F.col("least")).otherwise(F.col("greatest")).alias("centre")))


def _near_ends(batches):
    """``path`` and whether (0 or 1) the sketch is near those in ``low`` and ``high``."""
    ends: dict = {}

    def near(own: set, end: bytes) -> int:
        if end not in ends:
            if len(ends) > 10_000:                                 # only saves repeats
                ends.clear()
            ends[end] = set(np.frombuffer(end, "<u2").tolist())
        both = len(own & ends[end])
        return int(both >= NEAR * (len(own) + len(ends[end]) - both))

    for batch in batches:
        low, high = [], []
        for sketch, a, b in zip(*(batch.column(c).to_pylist() for c in ("sketch", "low", "high"))):
            own = set(np.frombuffer(sketch, "<u2").tolist())
            low.append(near(own, a))
            high.append(near(own, b))
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(low, pa.int32()), pa.array(high, pa.int32())], names=["path", "low", "high"])


def chosen_path_edges(sets: DataFrame, threshold: float, runs: int) -> DataFrame:
    """Distinct plausible pairs ``a, b`` of ``sets`` (``sid, n, chosen,
    sketch``): a spanning forest of every bucket of every run."""
    level = sets.select("sid", F.explode("chosen").alias("path"))        # hashes of different runs differ
    small, stars = None, []
    for k in range(len(SPREAD) + 1):
        counts = level.groupBy("path").agg(F.count("*").alias("members")).where("members > 1")
        level = stored(level.join(counts, "path"), f"paths-{k}")
        now = level.where(F.col("members") <= SMALL).select("path", "sid")
        small = now if small is None else small.unionByName(now)
        large = level.where(F.col("members") > SMALL).select("path", "sid")
        if k == len(SPREAD):
            # Still large after every level: one part, for the exact step to take apart.
            stars.append(_stars(large, large.groupBy("path").agg(F.min("sid").alias("centre"))))
            break
        held = stored(large.join(sets.select("sid", "sketch"), "sid"), f"large-{k}")
        whole = stored(_near_copies(held), f"whole-{k}")
        stars.append(_stars(held, whole))
        # The sketch holds two bytes of every sampled token.
        least = "array_min(transform(sequence(1, length(sketch), 2), i -> xxhash64(path, seed, substring(sketch, i, 2))))"
        level = (held.join(whole, "path", "left_anti").withColumn("seed", F.explode(F.expr(f"sequence(1, {SPREAD[k]})")))
                 .select("sid", F.xxhash64("path", "seed", F.expr(least)).alias("path")))
    rows = (small.join(sets.select("sid", "n", "sketch"), "sid")
            .select("path", "sid", "n", "sketch").repartition("path").sortWithinPartitions("path"))
    edges = rows.mapInArrow(_forest(threshold, runs), "a binary, b binary")
    for star in stars:
        edges = edges.unionByName(star)
    return stored(edges.distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """``node, part``: connected parts of undirected ``edges`` (``a, b``), by
    rounds of hooking each node to its least neighbour and short-cutting; the
    state is written to the shared folder each round."""
    both = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))), "links")
    links = both
    result = None
    while True:
        # Every node points at the least of itself and its neighbours.
        hook = links.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("to"))
        hook = stored(hook, "hook")
        for _ in range(64):                                        # pointer jumping to the roots
            jumped = stored(hook.alias("h").join(hook.alias("t"), F.col("h.to") == F.col("t.node"), "left")
                            .select("h.node", F.coalesce("t.to", "h.to").alias("to"), (F.coalesce("t.to", "h.to") != F.col("h.to")).alias("moved")), "jump")
            moved = jumped.where("moved").limit(1).count()
            hook = jumped.select("node", "to")
            if not moved:
                break
        result = hook if result is None else stored(
            result.alias("r").join(hook.alias("h"), F.col("r.to") == F.col("h.node"), "left").select("r.node", F.coalesce("h.to", "r.to").alias("to")), "parts")
        # Contract: links between different roots remain.
        root = hook.select(F.col("node").alias("n"), F.col("to").alias("t"))
        links = stored(links.join(root, F.col("u") == F.col("n")).select(F.col("t").alias("u"), "v")
                       .join(root, F.col("v") == F.col("n")).select("u", F.col("t").alias("v")).where("u != v").distinct(), "links")
        if links.limit(1).count() == 0:
            return result.select("node", F.col("to").alias("part"))


def links_of(sets: list, split: int, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs of ``sets`` whose Jaccard similarity
    reaches ``threshold``; only pairs across ``split`` if it is not 0."""
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    col = np.cumsum(new) - 1
    times = np.bincount(col) if len(col) else np.zeros(0, np.int64)
    many = times[col] > 1
    row, col = row[many], np.unique(col[many], return_inverse=True)[1]
    left = slice(0, split or len(sets))
    right = slice(split, len(sets))
    shared = np.zeros((left.stop, len(sets) - right.start), np.float32)
    for c in range(0, int(col.max()) + 1 if len(col) else 0, 2048):
        pick = (col >= c) & (col < c + 2048)
        dense = np.zeros((len(sets), 2048), np.float32)
        dense[row[pick], col[pick] - c] = 1
        shared += dense[left] @ dense[right].T
    union = size[left][:, None] + size[right][None, :] - shared
    out = shared >= threshold * union
    if not split:
        np.fill_diagonal(out, False)
    return out


def _sets(n: int):
    """Shingle sets of the wanted documents (``doc_id, text, sid, ...`` in the rest)."""
    def scan(batches):
        for batch in batches:
            texts = ts.plain(batch.column("text"))
            want = batch.column("sid").to_pylist()
            parts = batch.column("part").to_pylist()
            for lo, hi in ts.slices(texts):
                u = ts.cut(texts.slice(lo, hi - lo))
                h = u.hashes()
                grams = ts.ngrams(h, n)
                keep = [(want[lo + i], parts[lo + i], s) for i in range(hi - lo) if set_id(s := shingles(u, h, i, grams, n)) == want[lo + i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keep], pa.binary()), pa.array([k[1] for k in keep], pa.binary()),
                     pa.array([k[2].view(np.int64) for k in keep], pa.list_(pa.int64()))], names=["sid", "part", "tokens"])
    return scan


def _wanted(src: DataFrame, want: DataFrame) -> DataFrame:
    """``text, sid, part``: the text that holds each wanted set, by id and text
    hash, so rows without an id or of one id don't meet each other's sets."""
    return src.withColumn("key", id_key()).join(want, ["key", "th"]).select("text", "sid", "part")


def _verify(threshold: float):
    """Links of one block pair: their counts and a spanning forest of them."""
    def run(table: pa.Table) -> pa.Table:
        cols = {c: table[c].to_pylist() for c in ("sid", "block", "x", "y")}
        tokens = table["tokens"].combine_chunks()
        offs, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy().view(np.uint64)
        x, y = cols["x"][0], cols["y"][0]
        seen, pick = set(), []
        for i in sorted(range(len(cols["sid"])), key=lambda i: (cols["block"][i] != x, cols["sid"][i])):
            if cols["sid"][i] not in seen:                         # a repeated row
                seen.add(cols["sid"][i])
                pick.append(i)
        sids = [cols["sid"][i] for i in pick]
        sets = [flat[offs[i]:offs[i + 1]] for i in pick]
        split = 0 if x == y else sum(cols["block"][i] == x for i in pick)
        if x != y and split in (0, len(sets)):
            return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
        link = links_of(sets, split, threshold)
        n = np.zeros(len(sets), np.int64)
        n[:link.shape[0]] += link.sum(axis=1)
        if split:
            n[split:] += link.sum(axis=0)
        root = np.arange(len(sets))
        a, b = [], []
        for i in range(link.shape[0]):                             # a forest: the parts so far that a row joins
            near = np.flatnonzero(link[i]) + split
            if len(near):
                roots, first = np.unique(root[near], return_index=True)
                mine = root[i]
                for r, f in zip(roots.tolist(), first.tolist()):
                    if r != mine:
                        a.append(sids[i])
                        b.append(sids[near[f]])
                root[np.isin(root, roots)] = mine
        some = [i for i in range(len(sets)) if n[i]]
        return pa.table({"a": pa.array(a + [sids[i] for i in some], pa.binary()), "b": pa.array(b + [None] * len(some), pa.binary()),
                         "n": pa.array([0] * len(a) + [int(n[i]) for i in some], pa.int64())})
    return run


def _classes(src: DataFrame, n: int, threshold: float, recall: float) -> DataFrame:
    """``doc_id, th, class_id, n_links, n_copies`` of ``src`` (``doc_id, text, th``)."""
    runs = runs_needed(recall, threshold=threshold)
    sketch = stored(src.mapInArrow(_sketch(n, threshold, runs), "doc_id bigint, th bigint, sid binary, n bigint, chosen array<bigint>, sketch binary"), "sketches")
    filled = sketch.where("n > 0")
    # Equal sets have equal n, chosen and sketch.
    fold = stored(filled.groupBy("sid").agg(F.min("doc_id").alias("least"), F.min(F.struct(id_key().alias("key"), "th")).alias("place"), F.count("*").alias("copies"),
                                            *[F.any_value(c).alias(c) for c in ("n", "chosen", "sketch")]), "folded")
    parts = components(chosen_path_edges(fold.select("sid", "n", "chosen", "sketch"), threshold, runs))
    sized = stored(parts.join(parts.groupBy("part").agg(F.count("*").alias("size")), "part")
                   .select(F.col("node").alias("sid"), "part", F.expr(f"(size + {BLOCK} - 1) div {BLOCK}").alias("blocks"))
                   .join(fold.select("sid", "place.key", "place.th"), "sid"), "parts")
    want = sized.select("key", "th", "sid", "part")
    if sized.count() <= MAX_BROADCAST:
        want = F.broadcast(want)
    found = _wanted(src, want).mapInArrow(_sets(n), "sid binary, part binary, tokens array<bigint>")
    placed = (found.join(sized.select("sid", "blocks"), "sid")
              .withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
              .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
              .select("part", "sid", "tokens", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")))
    checked = stored(placed.groupBy("part", "x", "y").applyInArrow(_verify(threshold), "a binary, b binary, n bigint"), "verified")
    links = checked.where("b is null").groupBy(F.col("a").alias("sid")).agg(F.sum("n").alias("n_links"))
    classes = components(checked.where("b is not null").select("a", "b"))
    labelled = fold.join(classes.select(F.col("node").alias("sid"), "part"), "sid", "left").withColumn("part", F.coalesce("part", "sid"))
    names = labelled.groupBy("part").agg(F.min("least").alias("class_id"))
    sets = (labelled.join(names, "part").join(links, "sid", "left")
            .select("sid", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("copies").alias("n_copies")))
    blank = sketch.where("n = 0").select("doc_id", "th", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    return filled.select("doc_id", "th", "sid").join(sets, "sid").select("doc_id", "th", "class_id", "n_links", "n_copies").unionByName(blank)


def similar_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = RECALL) -> DataFrame:
    """Near-duplicate classes: ``doc_id, class_id, n_links, n_copies``, a row per row.

    Two documents are linked if the Jaccard similarity of their sets of
    ``n``-word runs (words are separated by space and U+0009 to U+000D; a
    shorter text is one run of all its words) is at least ``threshold``. A
    class is a connected part of that graph and ``class_id`` its least
    ``doc_id``. ``n_links`` counts the different sets a document's set is
    linked to, ``n_copies`` the rows that share its set, itself included.

    Null texts and texts without words are linked to nothing: each is its own
    class with ``n_copies`` 1. A null ``doc_id`` takes part, but names a class
    only (as null) if no other id is in it. Rows of one ``doc_id`` are
    separate rows. An empty table gives an empty result; other columns are
    ignored.
    """
    return _classes(_source(docs), n, threshold, recall).drop("th")


def _source(docs: DataFrame) -> DataFrame:
    return documents(docs.sparkSession, docs).withColumn("th", F.xxhash64("text"))


def one_per_class(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each class of :func:`similar_classes`:
    the one with the least ``doc_id`` (null ids last, then by a text hash).
    Texts without words all stay, but repeated rows of one id and text count
    as one document. All columns are kept."""
    classes = _classes(_source(docs), n, threshold, recall)
    last = F.lit((1 << 63) - 1)
    place = F.struct(F.coalesce("doc_id", last).alias("__qs_dkey"), F.col("th").alias("__qs_th"))
    # A class of null ids only is known by its text; a document without words by itself.
    name = F.when(F.col("class_id").isNotNull() & (F.col("n_links") + F.col("n_copies") > 1), F.struct(F.col("class_id").alias("c"), F.lit(0).cast("long").alias("t")))
    single = F.struct(F.coalesce("doc_id", last).alias("c"), F.col("th").alias("t"))
    stay = classes.select(place.alias("p"), F.coalesce(name, single).alias("k")).groupBy("k").agg(F.min("p").alias("p")).select("p.*").distinct()
    keyed = docs.withColumn("__qs_dkey", F.coalesce(F.col("doc_id").cast("long"), last)).withColumn("__qs_th", F.xxhash64(F.col("text").cast("string")))
    kept = keyed.join(stay, ["__qs_dkey", "__qs_th"], "left_semi").dropDuplicates(["__qs_dkey", "__qs_th"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

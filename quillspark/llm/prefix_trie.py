"""Conversation prefix trie with count-min screening.

A node of depth ``d`` is a distinct sequence of the first ``d`` turns (role,
text) of some conversation; its members are the conversations that start with
it. Turns are hashed once, texts are never shuffled. The digest of a prefix is
the XOR of its turns' hashes, each taken with its position (two hashes of 64
bits), so digests of long conversations are put together from blocks of turns.

A count-min sketch over the digests of all prefixes never counts too little:
an estimate of one proves that a prefix belongs to one conversation. Such
prefixes, and all that continue them, are nodes of their own conversation
alone and are emitted where they are. Only possibly shared prefixes are
shuffled and grouped exactly. The sketch has a fixed largest size; where a
corpus fills it, more prefixes are grouped exactly and none is judged wrong.

Sums over subtrees need no walk down the tree: every node is named by its
smallest member, so a node's share is put on that conversation's own path,
summed from the end of the path, and added up over the members of each node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .common import NO_ID, prepare, stored

BLOCK_BITS = 10                # positions of a block of one conversation: 1,024
ROWS = 3                       # of the sketch
CELLS = (1 << 16, 1 << 24)     # of a row of the sketch: fewest, most; eight a prefix between
_SEGMENT = 1 << 16             # cells that are merged together
_NODE = ["x1", "x2", "depth"]


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, h1, h2, n_bytes`` of ``turns`` (``conv_id, turn,
    role, text``); null role or text is empty, rows without a ``conv_id`` go."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"), F.octet_length(text).cast("long").alias("n_bytes"))


def _running(df: DataFrame, place: str, values: list[str], how, backward: bool = False) -> DataFrame:
    """``values`` run up along ``place`` within each ``conv_id`` (from the end
    if ``backward``): within blocks of places, then over the blocks' totals,
    so that no task needs all turns of one conversation."""
    df = df.withColumn("__block", F.shiftright(F.col(place) - 1, BLOCK_BITS))
    order = F.col(place).desc() if backward else F.col(place)
    inside = Window.partitionBy("conv_id", "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy("conv_id").orderBy(F.col("__block").desc() if backward else F.col("__block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("conv_id", "__block").agg(*[how(v).alias(f"__t_{v}") for v in values])
    before = totals.select("conv_id", "__block", *[F.coalesce(how(f"__t_{v}").over(across), F.lit(0)).alias(f"__b_{v}") for v in values])
    out = df.select("*", *[how(v).over(inside).alias(f"__i_{v}") for v in values]).join(before, ["conv_id", "__block"])
    both = {v: (F.col(f"__i_{v}") + F.col(f"__b_{v}")) if how is F.sum else F.col(f"__i_{v}").bitwiseXOR(F.col(f"__b_{v}")) for v in values}
    return out.withColumns(both).drop("__block", *[f"__{k}_{v}" for k in "ib" for v in values])


def numbered(dig: DataFrame) -> DataFrame:
    """``conv_id, pos, last, h1, h2, n_bytes``: turns numbered from 1 by
    ``turn`` (null first), equal ones by role, then by their hash; ``last``
    marks the last turn. Numbers are found within blocks of 1,024 turn
    numbers, then over the blocks."""
    block = F.shiftright(F.coalesce("turn", F.lit(NO_ID)), BLOCK_BITS)
    dig = dig.withColumn("block", block)
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "h1", "h2")
    counts = dig.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    one = Window.partitionBy("conv_id")
    before = counts.select("conv_id", "block", F.coalesce(F.sum("n").over(one.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                           F.sum("n").over(one).alias("total"))
    return (dig.withColumn("i", F.row_number().over(inside)).join(before, ["conv_id", "block"]).withColumn("pos", F.col("before") + F.col("i"))
            .select("conv_id", "pos", (F.col("pos") == F.col("total")).alias("last"), "h1", "h2", "n_bytes"))


def with_openings(num: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that open alike: each conversation ``c`` becomes the
    first ``h`` turns of conversation ``c - c % every`` (all if fewer, none if
    absent) and its own after its first ``h``; ``h`` is the unsigned CRC-32 of
    its decimal id modulo ``most``. Returns the numbered turns and all
    conversations (``conv_id, n_turns``)."""
    num = stored(num, "numbered-turns")
    sizes = num.where("last").select("conv_id", F.col("pos").alias("n"))
    parent = sizes.select(F.col("conv_id").alias("parent"), F.col("n").alias("parent_n"))
    plan = (sizes.withColumn("parent", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
            .join(parent, "parent", "left").withColumn("head", F.least("h", F.coalesce("parent_n", F.lit(0))))
            .withColumn("n_turns", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    plan = stored(plan.select("conv_id", "parent", "h", "head", "n_turns"), "openings")
    opening = num.where(F.col("pos") < most).withColumnRenamed("conv_id", "parent").join(plan, "parent").where("pos <= head").withColumn("to", F.col("pos"))
    rest = num.join(plan, "conv_id").where("pos > h").withColumn("to", F.col("head") + F.col("pos") - F.col("h"))
    cols = ["conv_id", F.col("to").alias("pos"), (F.col("to") == F.col("n_turns")).alias("last"), "h1", "h2", "n_bytes"]
    return opening.select(*cols).unionByName(rest.select(*cols)), plan.select("conv_id", "n_turns")


# ------------------------------------------------------------------- the sketch

def _cells(x1: np.ndarray, x2: np.ndarray, cells: int) -> list[np.ndarray]:
    a, b = x1.view(np.uint64), ts.mix(x2.view(np.uint64))
    return [(ts.mix(a + b * np.uint64(r)) & np.uint64(cells - 1)).astype(np.int64) for r in range(ROWS)]


def _counting(cells: int):
    """Counts of a task's prefixes, up to 2, a row for each segment with any."""
    def run(batches):
        count = np.zeros((ROWS, cells), np.uint8)
        for batch in batches:
            x1, x2 = (batch.column(i).to_numpy() for i in (0, 1))
            for r, at in enumerate(_cells(x1, x2, cells)):
                cell, n = np.unique(at, return_counts=True)
                count[r, cell] = np.minimum(count[r, cell] + np.minimum(n, 2), 2)
        parts = count.reshape(-1, min(_SEGMENT, cells))
        for i in np.flatnonzero(parts.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([parts[i].tobytes()], pa.binary())], names=["segment", "counts"])
    return run


def _merging(batches):
    """Bits of the cells that count two or more; rows arrive sorted by segment."""
    segment, total = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())], names=["segment", "bits"])

    for batch in batches:
        for s, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            if s != segment:
                if segment is not None:
                    yield out()
                segment, total = s, np.zeros(len(counts.as_py()), np.uint8)
            total = np.minimum(total + np.frombuffer(counts.as_py(), np.uint8), 2)
    if segment is not None:
        yield out()


def screen(prefixes: DataFrame) -> DataFrame:
    """``prefixes`` with ``shared`` and ``parent_shared``: false only where
    the sketch proves that no other conversation has the prefix (``x1, x2``)
    or its parent (``p1, p2``); the root counts as shared."""
    spark = prefixes.sparkSession
    n = prefixes.count()
    cells = CELLS[0]
    while cells < CELLS[1] and cells < 8 * n:
        cells *= 2
    counts = prefixes.select("x1", "x2").mapInArrow(_counting(cells), "segment int, counts binary")
    merged = counts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merging, "segment int, bits binary")
    bits = np.zeros((ROWS * cells // min(_SEGMENT, cells), min(_SEGMENT, cells) // 8), np.uint8)
    for row in merged.collect():                                  # at most ROWS * CELLS[1] / 8 bytes: 6 MB
        bits[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    sketch = spark.sparkContext.broadcast(bits.reshape(ROWS, -1))

    def estimate(batches):
        many = sketch.value
        for batch in batches:
            col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("x1", "x2", "p1", "p2", "depth")}
            flags = []
            for a, b in (("x1", "x2"), ("p1", "p2")):
                two = np.ones(len(batch), bool)
                for r, at in enumerate(_cells(col[a], col[b], cells)):
                    two &= (many[r, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
                flags.append(two)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flags[0]), pa.array(flags[1] | (col["depth"] == 1))],
                                             names=[*batch.schema.names, "shared", "parent_shared"])

    schema = T.StructType([*prefixes.schema.fields, T.StructField("shared", T.BooleanType()), T.StructField("parent_shared", T.BooleanType())])
    return prefixes.mapInArrow(estimate, schema)


# --------------------------------------------------------------------- the trie

_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends"]


def _alone(rows: DataFrame, parent, *more: str) -> DataFrame:
    """Nodes of one conversation."""
    end = F.col("last").cast("long")
    return rows.select(*more, "conv_id", "depth", parent.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), (1 - end).alias("n_children"),
                       F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), end.alias("n_ends"))


def trie(num: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of numbered turns (see :func:`numbered`) of the conversations
    ``convs`` (``conv_id, n_turns``, turnless ones too): nodes and ends, as
    :func:`prefix_trie`."""
    spark = num.sparkSession
    prepare(spark)
    hashed = num.select("conv_id", F.col("pos").alias("depth"), "last", "n_bytes", F.xxhash64("pos", "h1").alias("x1"), F.xxhash64(F.lit(2), "pos", "h2").alias("x2"))
    hashed = hashed.withColumn("y1", F.col("x1")).withColumn("y2", F.col("x2"))
    prefixes = _running(hashed, "depth", ["x1", "x2"], F.bit_xor)
    prefixes = stored(prefixes.select("conv_id", "depth", "last", "n_bytes", "x1", "x2", F.col("x1").bitwiseXOR(F.col("y1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("y2")).alias("p2")), "prefixes")
    seen = stored(screen(prefixes), "screened")

    # Proven tails stay where they are; the rest learns where its conversation's tail begins.
    tails = seen.where("not shared and not parent_shared")
    rest = seen.where("shared or parent_shared")
    start = rest.where("not shared").groupBy("conv_id").agg(F.min("depth").alias("start"))
    rest = stored(rest.join(start, "conv_id", "left"), "possibly-shared")
    late = rest.where("depth > start")                            # estimates beyond a proven prefix
    heads = rest.where("depth = start")
    open_ = rest.where("start is null or depth < start")

    nodes = stored(open_.groupBy(*_NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("rep"), F.sum(F.col("last").cast("long")).alias("n_ends"),
                                             F.min("p1").alias("p1"), F.min("p2").alias("p2")), "nodes")
    named = F.col("rep") == F.col("conv_id")
    paths = stored(open_.join(nodes.select(*_NODE, "n", "rep", "n_ends"), _NODE)
                   .select(*_NODE, "conv_id", "last", "rep", F.col("start").isNotNull().alias("tail"),
                           F.when(named, (F.col("n") - 1) * F.col("n_bytes")).otherwise(F.lit(0)).cast("long").alias("saved"),
                           (named & F.col("last") & (F.col("n_ends") == F.col("n"))).cast("long").alias("leaf")), "paths")
    below = (_running(paths, "depth", ["saved", "leaf"], F.sum, backward=True)
             .groupBy(*_NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum(F.col("leaf") + F.col("tail").cast("long")).alias("n_leaves")))
    up = [F.col("p1").alias("x1"), F.col("p2").alias("x2"), (F.col("depth") - 1).alias("depth")]
    kids = nodes.select(*up).unionByName(heads.select(*up)).groupBy(*_NODE).agg(F.count("*").alias("n_children"))
    full = (nodes.join(below, _NODE).join(kids, _NODE, "left")
            .select("depth", F.col("rep").alias("conv_id"), "p1", "p2", F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", "n_ends"))
    single = _alone(heads, F.lit(None), "p1", "p2").drop("parent_conv_id")
    above = nodes.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent_conv_id"))
    whole = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.sum((F.col("n_turns") == 0).cast("long")).alias("ends")).first()
    parent = F.when(F.col("depth") == 1, F.lit(whole["least"]).cast("long")).otherwise(F.col("parent_conv_id"))
    placed = full.unionByName(single).join(above, ["p1", "p2", "depth"], "left").withColumn("parent_conv_id", parent).select(*_OUT)
    placed = stored(placed, "placed-nodes")
    out = placed.unionByName(_alone(tails.unionByName(late.drop("start")), F.col("conv_id")))
    if whole["n"]:
        first = placed.where("depth = 1").agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
        root = (whole["least"], 0, None, whole["n"], first["n"], first["leaves"] or 1, first["saved"] or 0, whole["ends"])
        out = out.unionByName(spark.createDataFrame([root], ", ".join(f"{c} bigint" for c in _OUT)))
    ends = paths.where("last").select(F.col("rep").alias("node"), "depth", "conv_id")
    ends = ends.unionByName(tails.unionByName(late.drop("start")).unionByName(heads.drop("start")).where("last").select(F.col("conv_id").alias("node"), "depth", "conv_id"))
    ends = ends.unionByName(convs.where("n_turns = 0").select(F.lit(whole["least"]).cast("long").alias("node"), F.lit(0).cast("long").alias("depth"), "conv_id"))
    return out, ends


def prefix_trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix trie of the conversations in ``turns`` (``conv_id, turn, role,
    text``). Two frames:

    * nodes: ``conv_id`` (smallest member), ``depth`` (0: the root),
      ``parent_conv_id`` (null for the root), ``n_convs`` (members),
      ``n_children``, ``n_leaves`` (childless nodes of the subtree),
      ``saved_tokens`` (over the subtree, (members - 1) times the bytes of
      the node's last text), ``n_ends`` (members that have no further turn).
      ``conv_id`` and ``depth`` name a node.
    * ends: ``node`` (its ``conv_id``), ``depth``, ``conv_id``: where each
      conversation ends.

    Turns are ordered by ``turn``, null first; turns of one number by role,
    then by a hash of role and text (equal rows are turns of their own). Null
    role or text is empty. Rows without a ``conv_id`` are left out. Texts are
    hashed whole and stay in their task, however long. An empty table has no
    nodes, not even the root; other columns are ignored.
    """
    num = stored(numbered(digests(turns)), "numbered-turns")
    return trie(num, num.where("last").select("conv_id", F.col("pos").alias("n_turns")))


ID_BITS = 16                   # ids of a part of an id list: 65,536


def id_digests(ends: DataFrame) -> DataFrame:
    """``node, depth, ends_sha256``: lower-case SHA-256 of the decimal
    ``conv_id`` of each node's ends, ascending, joined by commas. Lists are
    put together from parts of at most 65,536 ids, which pass a hash one by one."""
    parts = (ends.groupBy("node", "depth", F.shiftright("conv_id", ID_BITS).alias("part"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))

    def run(batches):
        key, state = None, None
        for batch in batches:
            keys, done = [], []
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids"))):
                if now != key:
                    if key is not None:
                        keys.append(key)
                        done.append(state.hexdigest())
                    key, state = now, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _digest_rows(keys, done)
        if key is not None:
            yield _digest_rows([key], [state.hexdigest()])

    return parts.repartition("node", "depth").sortWithinPartitions("node", "depth", "part").mapInArrow(run, "node bigint, depth bigint, ends_sha256 string")


def _digest_rows(keys: list, done: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(done, pa.string())], names=["node", "depth", "ends_sha256"])


def opening_report(turns: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """The nodes of :func:`prefix_trie` over the conversations of
    :func:`with_openings`, with ``ends_sha256`` (see :func:`id_digests`) in
    place of ``n_ends``; a node where nothing ends has the hash of the empty
    string. Nulls, ties and repeated rows as there."""
    prepare(turns.sparkSession)
    nodes, ends = trie(*with_openings(numbered(digests(turns)), every, most))
    # A node of one member has its own id's hash, without a shuffle.
    own = F.when(F.col("n_ends") == 0, F.sha2(F.lit("").cast("binary"), 256)).when(F.col("n_convs") == 1, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
    few = nodes.where("n_ends > 0 and n_convs > 1")
    lists = id_digests(ends.join(few.select(F.col("conv_id").alias("node"), "depth"), ["node", "depth"], "left_semi"))
    cols = _OUT[:-1]
    done = few.join(lists.withColumnRenamed("node", "conv_id"), ["conv_id", "depth"]).select(*cols, "ends_sha256")
    return nodes.where("n_ends = 0 or n_convs = 1").select(*cols, own.alias("ends_sha256")).unionByName(done)

"""Dataset assembly.

Ordering is always explicit and partition-independent: a seeded order is
``md5(seed | id)`` (identical in DuckDB), positions come from hash buckets or
range partitions of the keys alone, never from an un-partitioned window over
the rows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions.indexing import HASH_DIGITS, hash_order_index, key_index, stored_table
from ..functions.pytext import PY_WS, md5_key

# Special tokens of the learned vocabulary (pad = end of sequence).
UNK, BOS, EOS = "<unk>", "<s>", "</s>"
SPECIALS = (UNK, BOS, EOS)
MAX_LENGTH = 1024              # the later trainer's sequence limit
MAX_VOCABULARY = 1_000_000     # tokens that are sent to every task
LOOKUP_ROWS = 1024             # texts whose tokens are looked up at once
# Word / punctuation tokens, special tokens first.
TOKEN_RE = r"<s>|</s>|[\p{L}\p{N}_]+|[^\p{L}\p{N}_" + PY_WS[1:]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ D1 / D2 / F8

def union_datasets(*dfs: DataFrame) -> DataFrame:
    """Append datasets with equal columns (UNION ALL by name)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def side_by_side(left: DataFrame, left_order: list, right: DataFrame, right_order: list,
                 index: str = "_pos") -> DataFrame:
    """Concatenate two datasets column-wise by row position (rows beyond
    the shorter side drop, as a positional zip does). Positions are found and
    paired on the order keys alone, which must be unique; each side's other
    columns join the pairs once."""
    li = key_index(left, left_order, index).select(*[F.col(c).alias(f"_qs_l{i}") for i, c in enumerate(left_order)], index)
    ri = key_index(right, right_order, index).select(*[F.col(c).alias(f"_qs_r{i}") for i, c in enumerate(right_order)], index)
    pairs = li.join(ri, index).drop(index)
    on_left = reduce(and_, [pairs[f"_qs_l{i}"].eqNullSafe(left[c]) for i, c in enumerate(left_order)])
    both = left.join(pairs, on_left).drop(*[f"_qs_l{i}" for i in range(len(left_order))])
    on_right = reduce(and_, [both[f"_qs_r{i}"].eqNullSafe(right[c]) for i, c in enumerate(right_order)])
    return both.join(right, on_right).drop(*[f"_qs_r{i}" for i in range(len(right_order))])


def rename_drop(df: DataFrame, renames: dict[str, str] | None = None, drop: list | None = None) -> DataFrame:
    """F8: rename columns and drop unused ones."""
    for a, b in (renames or {}).items():
        df = df.withColumnRenamed(a, b)
    return df.drop(*(drop or []))


# ------------------------------------------------------------------ D3 / D4

def hash_fraction_prefix(fraction: float) -> str:
    """8-hex-digit threshold: ``md5 prefix < threshold`` selects ``fraction``."""
    return format(min(int(fraction * 16 ** 8), 16 ** 8 - 1), "08x")


def split_hash(df: DataFrame, id_cols: list, test_size: float = 0.05, seed: int = 42,
               out: str = "split") -> DataFrame:
    """D3 ``hash`` mode: a row is in test when its md5 order key falls below the
    fraction; approximate size, stable under appends, no shuffle."""
    key = md5_key(seed, *id_cols)
    return df.withColumn(out, F.when(F.substring(key, 1, 8) < hash_fraction_prefix(test_size), F.lit("test"))
                         .otherwise(F.lit("train")))


def _seeded_keys(df: DataFrame, id_cols: list, seed: int) -> DataFrame:
    """The ids and their md5 order key as a stored table (no other column)."""
    return stored_table(df.select(*id_cols, md5_key(seed, *id_cols).alias("_qs_key")), "seeded")


def seeded_order(df: DataFrame, id_cols: list, seed: int, rank: str = "rank") -> DataFrame:
    """Seeded shuffle as a dense ``rank`` in ``md5(seed|id)`` order.
    ``id_cols`` must be unique; other columns join the ranks at the end."""
    ranked = hash_order_index(_seeded_keys(df, id_cols, seed), "_qs_key", id_cols, rank).drop("_qs_key")
    if set(df.columns) == set(id_cols):
        return ranked
    return df.join(ranked, id_cols)


def split_exact(df: DataFrame, id_cols: list, test_size: float = 0.05, seed: int = 42,
                out: str = "split") -> DataFrame:
    """D3 ``exact`` mode: the ``ceil(test_size * n)`` rows first in seeded order
    are test. Only the last test row's key is looked for (bucket sizes, then
    inside one bucket of the keys); the split itself is a comparison."""
    keys = _seeded_keys(df, id_cols, seed)
    prefix = F.substring("_qs_key", 1, HASH_DIGITS)
    sizes = sorted(tuple(r) for r in keys.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())   # 65,536 at most
    left = math.ceil(test_size * sum(n for _, n in sizes))
    last = ""
    for p, n in sizes:
        if left <= 0:
            break
        if left <= n:
            # The hash order is decided inside this bucket.
            last = (keys.where(prefix == p).orderBy("_qs_key", *id_cols).limit(left).agg(F.max("_qs_key")).first()[0])
        left -= n
    return df.withColumn(out, F.when(md5_key(seed, *id_cols) <= last, F.lit("test")).otherwise(F.lit("train")))


# ------------------------------------------------------------------ D5 / D6

def tokenize(text) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(TOKEN_RE), 0)


def build_vocab(df: DataFrame, text: str, vocab_size: int) -> DataFrame:
    """Vocabulary job: token counts (map-side combined), the ``vocab_size``
    most frequent (ties by token) get ids after the special tokens. The
    result has at most ``vocab_size + 3`` rows: a proven bound for
    broadcasting."""
    spark = df.sparkSession
    toks = df.select(F.explode(tokenize(text)).alias("token")).filter(~F.col("token").isin(*SPECIALS))
    top = (toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.asc("token")).limit(vocab_size))
    ranked = top.withColumn("token_id", (F.row_number().over(Window.orderBy(F.desc("n"), F.asc("token")))
                                         - 1 + len(SPECIALS)).cast("int"))
    specials = spark.createDataFrame([(t, i) for i, t in enumerate(SPECIALS)], "token string, token_id int")
    return ranked.select("token", "token_id").unionByName(specials)


def encode_ids(df: DataFrame, text: str, keys: list, vocab: DataFrame, max_len: int | None = None) -> DataFrame:
    """``(*keys, length, ids)``: token ids cut to ``max_len``; ``length`` is
    the number of tokens before the cut.

    Narrow: the tokens of a batch are looked up in the vocabulary, an Arrow
    dictionary that goes to every task once. A vocabulary of more than
    ``MAX_VOCABULARY`` tokens is joined instead."""
    unk = SPECIALS.index(UNK)
    tokens = tokenize(text)
    cut = tokens if max_len is None else F.slice(tokens, 1, max_len)
    toks = df.select(*keys, F.size(tokens).cast("bigint").alias("length"), cut.alias("_qs_tokens"))
    known = vocab.orderBy("token_id").limit(MAX_VOCABULARY + 1).toArrow()      # one run of the vocabulary job
    if known.num_rows > MAX_VOCABULARY:
        rows = toks.select(*keys, "length", F.posexplode_outer("_qs_tokens").alias("pos", "token")).join(vocab, "token", "left")
        item = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("token_id", F.lit(unk)).alias("id")))
        grouped = rows.groupBy(*keys, "length").agg(F.array_sort(F.collect_list(item)).alias("_t"))
        return grouped.select(*keys, "length", F.transform("_t", lambda x: x["id"]).alias("ids"))
    names = df.sparkSession.sparkContext.broadcast((known["token"].to_pylist(), known["token_id"].to_pylist()))

    def look_up(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        tokens, ids = names.value
        tokens, ids = pa.array(tokens, pa.string()), np.append(np.array(ids, np.int32), np.int32(unk))
        for batch in (b.slice(s, LOOKUP_ROWS) for b in batches for s in range(0, b.num_rows, LOOKUP_ROWS)):
            column = batch.column(batch.num_columns - 1)
            at = pc.fill_null(pc.index_in(column.flatten().cast(pa.string()), value_set=tokens), len(tokens)).to_numpy()
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[at]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], names=[*batch.schema.names[:-1], "ids"])

    schema = toks.drop("_qs_tokens").schema.add("ids", ArrayType(IntegerType()))
    return toks.mapInArrow(look_up, schema)


def padded(ids, to, value: int) -> Column:
    """``ids`` followed by ``value`` up to length ``to``."""
    ids = _c(ids)
    return F.concat(ids, F.array_repeat(F.lit(value), F.greatest(F.lit(0), to - F.size(ids))))


def encode(df: DataFrame, text: str, keys: list, vocab: DataFrame, max_len: int = MAX_LENGTH,
           mask_padding: bool = False) -> DataFrame:
    """Tokens -> ids, truncate to ``max_len``, pad with the end-of-sequence
    id, ``labels`` = copy (padding as ``-100`` when ``mask_padding``).
    ``length`` is the number of ids before padding."""
    pad = SPECIALS.index(EOS)
    e = encode_ids(df, text, keys, vocab, max_len)
    return e.select(*keys, F.size("ids").cast("bigint").alias("length"), padded("ids", F.lit(max_len), pad).alias("input_ids"),
                    padded("ids", F.lit(max_len), -100 if mask_padding else pad).alias("labels"))


def batch_padding(df: DataFrame, rank: str, ids: str, batch_size: int, multiple: int = 8) -> DataFrame:
    """Collator padding: batch = floor(rank / B); every example of a batch
    is padded to the batch's longest length rounded up to ``multiple``:
    ``input_ids`` with the end-of-sequence id, ``labels`` with -100. Only the
    batches' lengths are joined back, one number per batch."""
    b = df.withColumn("batch", F.floor(F.col(rank) / batch_size).cast("bigint"))
    to = F.ceil(F.max(F.size(ids)) / multiple) * multiple
    mx = b.groupBy("batch").agg(to.cast("bigint").alias("padded_len"))
    both = b.join(mx, "batch")
    return both.withColumn("input_ids", padded(ids, F.col("padded_len").cast("int"), SPECIALS.index(EOS))) \
               .withColumn("labels", padded(ids, F.col("padded_len").cast("int"), -100))


# ------------------------------------------------------------------ D7-D10, F6

def median_length(df: DataFrame, text: str, by: list | None = None) -> DataFrame:
    """Median character length (average of the two middle values)."""
    g = df.groupBy(*(by or []))
    return g.agg(F.median(F.length(text)).cast("double").alias("median_length"))


def max_encoded_length(df: DataFrame, ids: str = "input_ids", length: str | None = None) -> DataFrame:
    """Maximum encoded length."""
    expr = F.col(length) if length else F.size(ids)
    return df.agg(F.max(expr).cast("bigint").alias("max_length"))


def length_class(length: Column) -> Column:
    """>1000 / 500-1000 / <500 (labels of the reference's buckets)."""
    return (F.when(length > 1000, F.lit("more_than_1000"))
             .when(length >= 500, F.lit("500_to_1000")).otherwise(F.lit("less_than_500")))


def length_classes(df: DataFrame, text: str) -> DataFrame:
    return df.groupBy(length_class(F.length(text)).alias("length_class")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def length_histogram(df: DataFrame, text: str, bins: int = 50) -> DataFrame:
    """Counts per equal-width bin between min and max length (the max
    falls into the last bin). Min and max are one small driver read."""
    lens = df.select(F.length(text).alias("len"))
    row = lens.agg(F.min("len").alias("lo"), F.max("len").alias("hi")).collect()[0]
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return lens.select(F.lit(0).cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("n")).limit(0)
    width = max(hi - lo, 1)
    bin_ = F.least(F.floor((F.col("len") - lo) * bins / width), F.lit(bins - 1)).cast("bigint")
    return lens.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def cascade_length_filters(df: DataFrame, context: str, response: str, max_context: int = 1500,
                           max_response: int = 4000) -> DataFrame:
    """keep context <= 1500 characters, then response <= 4000."""
    return df.filter(F.length(context) <= max_context).filter(F.length(response) <= max_response)


def step_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """Row count after each named step, ``(step, rows)``."""
    out = None
    for name, d in steps.items():
        one = d.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(name).alias("step"), "rows")
        out = one if out is None else out.unionByName(one)
    return out

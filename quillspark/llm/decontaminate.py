"""Benchmark decontamination (DataFrame functions only).

Texts are normalised to lower-case words. The benchmark's windows of ``n``
words (an item of fewer words is one window) form a hash set that is
broadcast after a check of its size; beyond the bound it is joined in blocks
of that size. Every word window of every document is looked up by hash where
it is read, hits are verified word by word, and only hits are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, id_key, prepare, stored

N = 10
MAX_BROADCAST_WINDOWS = 300_000
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased: runs of digits, a-z and characters beyond U+007F."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, _SEPARATOR + "+"), "")


def benchmark_windows(bench: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows: ``key, len, words, items`` (ids as strings)."""
    items = bench.select(F.col("item_id").cast("string").alias("item"), words(F.col("text").cast("string")).alias("w")).where("size(w) > 0")
    parts = items.select("item", "w", F.least(F.size("w"), F.lit(n)).alias("len"))
    parts = parts.select("item", "len", "w", F.explode(F.expr("sequence(0, size(w) - len)")).alias("i"))
    parts = parts.select("item", "len", F.expr("slice(w, i + 1, len)").alias("words"))
    return parts.groupBy("len", "words").agg(F.collect_set("item").alias("items")).select(F.xxhash64("words").alias("key"), "len", "words", "items")


def window_hits(docs: DataFrame, bench: DataFrame, n: int = N, max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """Verified occurrences: ``dkey, th, pos, len, items`` (``pos`` from 0)."""
    spark = docs.sparkSession
    windows = stored(benchmark_windows(bench, n), "benchmark-windows")
    lens = sorted(r["len"] for r in windows.select("len").distinct().collect())      # n values at most
    blocks = max(1, -(-windows.count() // max_broadcast))
    src = (documents(spark, docs).select(id_key().alias("dkey"), F.xxhash64("text").alias("th"), words(F.col("text")).alias("w")))
    src = src.where(F.size("w") >= F.lit(min(lens, default=n)))
    if len(lens) > 1:
        src = src.select("*", F.explode(F.array(*[F.lit(x) for x in lens])).alias("len")).where("size(w) >= len")
    else:
        src = src.withColumn("len", F.lit(lens[0] if lens else n))
    places = src.select("dkey", "th", "w", "len", F.explode(F.expr("sequence(0, size(w) - len)")).alias("pos"))
    keyed = places.withColumn("key", F.xxhash64(F.expr("slice(w, pos + 1, len)")))
    out = None
    for b in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod("key", F.lit(blocks)) == b)
        hit = (keyed.join(F.broadcast(part.withColumnRenamed("len", "wlen")), "key")
               .where("len = wlen and slice(w, pos + 1, len) = words").select("dkey", "th", "pos", "len", "items"))
        out = hit if out is None else out.unionByName(hit)
    return out


def hit_words(docs: DataFrame, bench: DataFrame, n: int = N, max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """``dkey, th, hit, items``: numbers of the hit words and sorted item ids of the documents with hits."""
    hits = window_hits(docs, bench, n, max_broadcast)
    return hits.groupBy("dkey", "th").agg(
        F.array_distinct(F.flatten(F.collect_list(F.expr("sequence(pos, pos + len - 1)")))).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def contamination_report(docs: DataFrame, bench: DataFrame, n: int = N) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, a row per row.

    A document word is hit if it is inside any occurrence of a benchmark
    window; ``n_items`` counts the items with such a window and
    ``items_sha256`` digests their ids, sorted as strings and joined by
    commas. Null texts and items have no words; rows of one ``doc_id`` are
    judged by their own texts; a null id is an id of its own; repeated items
    count once. An item without an id hits words like any other, but is neither
    counted nor named. Very long texts are looked up whole, window by window. Empty tables are allowed on both sides. Other columns are
    ignored.
    """
    src = documents(docs.sparkSession, docs).select("doc_id", id_key().alias("dkey"), F.xxhash64("text").alias("th"),
                                                    F.greatest(F.size(words(F.col("text"))), F.lit(0)).cast("long").alias("n_words"))
    found = hit_words(docs, bench, n).select("dkey", "th", F.size("hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                                             F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (src.join(found, ["dkey", "th"], "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated")))


def decontaminate(docs: DataFrame, bench: DataFrame, n: int = N, remove: str = "documents") -> DataFrame:
    """``docs`` without what the benchmark has.

    ``remove="documents"`` drops every document with a hit word;
    ``remove="spans"`` deletes the hit words with the separators after them.
    Columns are kept as they are; documents without hits are unchanged. Nulls,
    repeated rows and empty tables are as in :func:`contamination_report`.
    """
    prepare(docs.sparkSession)
    hits = hit_words(docs, bench, n).select(F.col("dkey").alias("__qs_dkey"), F.col("th").alias("__qs_th"), F.col("hit").alias("__qs_hit"))
    text = F.col("text").cast("string")
    keyed = docs.withColumn("__qs_dkey", id_key()).withColumn("__qs_th", F.xxhash64(text))
    if remove == "documents":
        return keyed.join(hits, ["__qs_dkey", "__qs_th"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    joined = keyed.join(hits, ["__qs_dkey", "__qs_th"], "left")
    # Words with what follows them; a first part without a word is a lead.
    parts = F.split(text, f"(?<={_ANY_CASE})(?!{_ANY_CASE})")
    lead = F.when(F.regexp_like(text, F.lit("^" + _ANY_CASE)), 1).otherwise(0)
    flagged = joined.withColumn("__qs_parts", parts).withColumn("__qs_marks", F.transform("__qs_hit", lambda p: p + lead))
    kept = F.concat_ws("", F.transform(F.array_except(F.sequence(F.lit(0), F.size("__qs_parts") - 1), F.col("__qs_marks")), lambda i: F.get("__qs_parts", i)))
    out = [F.when(F.col("__qs_hit").isNotNull(), kept).otherwise(text).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return flagged.select(*out)

"""Article-aware document chunking.

The whole splitter is narrow: marker split, header detection, header
carry-forward, greedy word packing and continuation labels are array
expressions evaluated inside the row, and two ``explode`` steps (pieces, then
sub-pieces) turn them into rows, so chunking never shuffles the (large)
document text. Chunk numbers come from a per-document prefix sum of chunk
counts, not from a window.

Semantics follow the reference splitter exactly (see SURVEY 2.9):

1. ``text.split(marker)``; a leading empty piece is dropped; the marker stem
   is re-attached to pieces at index >= 1 after that drop (so a text that
   starts with the marker loses the stem on its first article unless
   ``restore_first``).
2. Header: among the first four whitespace words, the first adjacent pair
   ``(w starts with stem, next is all digits and at most 3 long)``.
3. The carried header is the last non-empty header so far, current included.
4. A piece of at most ``size`` characters is emitted unstripped (dropped when
   whitespace only).
5. A longer piece is packed greedily: a word joins the current sub-piece when
   ``len(cur) + len(word) + 1 <= size`` where ``cur`` keeps a trailing space.
6. Every emitted sub-piece that differs from the stripped piece gets
   ``"{header} (продолжение)\\n"`` when a header is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pytext import PY_NON_WS, PY_WS, literal_split, py_isdigit, py_split, py_strip

# The reference splitter's marker, stem, size and label.
DEFAULT_MARKER = "\nСтат"
DEFAULT_STEM = "Стат"
DEFAULT_SIZE = 2000
CONTINUATION = " (продолжение)\n"

_BLOCK = 256                   # entries of a finished block of an accumulator
_MANY_PIECES = 4096            # pieces of a document that are one row each
_LONG_PIECE = 500_000          # words of a piece whose starts are gathered in blocks


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body``
    reads it inside another array's lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_at_marker(text: Column, marker: str = DEFAULT_MARKER, stem: str = DEFAULT_STEM,
                    restore_first: bool = False) -> Column:
    """Pieces of one text, stem re-attached."""
    parts = literal_split(text, marker)
    starts_with_marker = F.get(parts, 0) == ""
    parts = F.when(starts_with_marker, F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))).otherwise(parts)
    usual = F.transform(parts, lambda x, i: F.when(i >= 1, F.concat(F.lit(stem), x)).otherwise(x))
    if not restore_first:
        return usual
    return F.when(starts_with_marker, F.transform(parts, lambda x: F.concat(F.lit(stem), x))).otherwise(usual)


def article_header(piece: Column, stem: str = DEFAULT_STEM) -> Column:
    """``"Статья 12"`` from the first four words, or ``''``."""
    # A limited split stops early; white space at the start adds one empty part.
    first = F.slice(F.array_remove(F.split(piece, PY_WS + "+", 6), ""), 1, 4)

    def header(w):
        def pair(i):
            a, b = F.get(w, F.lit(i)), F.get(w, F.lit(i + 1))
            return F.when(a.startswith(F.lit(stem)) & py_isdigit(b) & (F.length(b) <= 3), F.concat(a, F.lit(" "), b))
        return F.coalesce(*[pair(i) for i in range(3)], F.lit(""))
    return let(first, header)


def carry_forward(headers: Column) -> Column:
    """For each position the last non-empty header up to it (or ''):
    one run per non-empty header, repeated up to the next one's position."""
    def fill(h):
        at = F.filter(F.transform(h, lambda x, i: F.when(x != "", i).otherwise(-1)), lambda i: i >= 0)
        return let(at, lambda p: F.flatten(F.transform(
            F.arrays_zip(F.concat(F.array(F.lit(0)), p).alias("a"), F.concat(p, F.array(F.size(h))).alias("b")),
            lambda r, k: F.array_repeat(F.when(k == 0, F.lit("")).otherwise(F.get(h, r["a"])), r["b"] - r["a"]))))
    return let(headers, fill)


def exclusive_prefix_sum(counts: Column) -> Column:
    """Sums of the values before each one; gathered in blocks, so that the
    accumulator copied per step stays short."""
    none = F.array().cast("array<bigint>")
    init = F.struct(F.lit(0).cast("bigint").alias("s"), none.alias("block"), F.array().cast("array<array<bigint>>").alias("done"))

    def step(acc, n):
        full = F.size(acc["block"]) >= _BLOCK
        return F.struct((acc["s"] + n).alias("s"),
                        F.when(full, F.array(acc["s"])).otherwise(F.concat(acc["block"], F.array(acc["s"]))).alias("block"),
                        F.when(full, F.concat(acc["done"], F.array(acc["block"]))).otherwise(acc["done"]).alias("done"))
    return F.aggregate(counts, init, step, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["block"]))))


def pack_break_starts(lengths: Column, size: int) -> Column:
    """T4 core: 0-based start index of every packed group of words, from word
    lengths only (integer accumulator). In a very long piece the starts are
    gathered in blocks, so the accumulator copied per break stays short."""
    def over(acc, n):
        return acc["cur"] + n + 1 > size

    def cur(acc, n):
        return F.when(over(acc, n), n + 1).otherwise(acc["cur"] + n + 1).alias("cur")

    def plain(acc, n):
        starts = F.when((acc["cur"] > 0) & over(acc, n), F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"])
        return F.struct(cur(acc, n), (acc["i"] + 1).alias("i"), starts.alias("starts"))

    def blocked(acc, n):
        brk = (acc["cur"] > 0) & over(acc, n)
        full = brk & (F.size(acc["block"]) >= _BLOCK)
        return F.struct(
            cur(acc, n), (acc["i"] + 1).alias("i"),
            F.when(full, F.array(acc["i"])).when(brk, F.concat(acc["block"], F.array(acc["i"]))).otherwise(acc["block"]).alias("block"),
            F.when(full, F.concat(acc["done"], F.array(acc["block"]))).otherwise(acc["done"]).alias("done"))

    zero = [F.lit(0).alias("cur"), F.lit(0).alias("i")]
    short = F.aggregate(lengths, F.struct(*zero, F.array(F.lit(0)).alias("starts")), plain, lambda acc: acc["starts"])
    long = F.aggregate(lengths, F.struct(*zero, F.array(F.lit(0)).alias("block"), F.array().cast("array<array<int>>").alias("done")),
                       blocked, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["block"]))))
    return F.when(F.size(lengths) > _LONG_PIECE, long).otherwise(short)


def _word_lengths(words: Column) -> Column:
    return F.transform(words, lambda w: F.length(w))


def _piece_table(docs: DataFrame, text: str, kc: list, size: int, marker: str, stem: str,
                 restore_first: bool) -> DataFrame:
    """Per document one column ``_pp``: for every piece its text, size class,
    non-blank flag, words (large pieces only) and packed group starts, each
    computed once (the array is projected, later steps only read it)."""
    has_word = lambda p: p.rlike(PY_NON_WS)  # noqa: E731  (== p.strip() != "")
    pieces = split_at_marker(F.col(text), marker, stem, restore_first)
    info = F.transform(pieces, lambda p: F.struct(
        p.alias("piece"), (F.length(p) <= size).alias("small"), has_word(p).alias("nonblank"),
        F.when(F.length(p) > size, py_split(p)).alias("words")))
    packed = F.transform(info, lambda x: F.struct(
        x["piece"].alias("piece"), x["small"].alias("small"), x["nonblank"].alias("nonblank"),
        x["words"].alias("words"),
        F.when(~x["small"] & (F.size(x["words"]) > 0),
               pack_break_starts(_word_lengths(x["words"]), size)).alias("starts")))
    return docs.select(*kc, packed.alias("_pp"))


def _chunks_of_piece(piece, small, nonblank, words, starts, carried) -> Column:
    """The chunks of one piece (T4 + T5) from already computed parts."""
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(words)))
    ranges = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    subs = F.transform(ranges, lambda r: F.array_join(F.slice(words, r["s"] + 1, r["e"] - r["s"]), " "))
    # A sub-piece can equal the stripped piece only when the piece packs into
    # one group, so the (whole-piece) strip is computed only then.
    single = F.size(starts) == 1
    labelled = F.transform(subs, lambda sp: F.when(
        (carried != "") & ~(single & (sp == py_strip(piece))), F.concat(carried, F.lit(CONTINUATION), sp))
        .otherwise(sp))
    empty = F.array().cast("array<string>")
    return F.when(small, F.when(nonblank, F.array(piece)).otherwise(empty)) \
            .otherwise(F.when(starts.isNull(), empty).otherwise(labelled))


def _all_chunks(pp: Column, stem: str) -> Column:
    """The chunks of all pieces of a document, in order."""
    zipped = F.arrays_zip(pp.alias("p"), carry_forward(F.transform(pp, lambda x: article_header(x["piece"], stem))).alias("carried"))
    return F.flatten(F.transform(zipped, lambda z: _chunks_of_piece(
        z["p"]["piece"], z["p"]["small"], z["p"]["nonblank"], z["p"]["words"], z["p"]["starts"], z["carried"])))


def split_documents(docs: DataFrame, text: str = "text", keys: list | None = None,
                    size: int = DEFAULT_SIZE, marker: str = DEFAULT_MARKER, stem: str = DEFAULT_STEM,
                    restore_first: bool = False) -> DataFrame:
    """T6 over a table: one row per chunk ``(*keys, chunk_idx, chunk)``.

    Narrow end to end (no shuffle). Every piece is split into words and
    packed exactly once (``_piece_table``); the header carry-forward, the
    chunk offsets and the explode only read that array.
    """
    keys = keys or [c for c in docs.columns if c != text]
    kc = [F.col(k) for k in keys]
    stage1 = _piece_table(docs, text, kc, size, marker, stem, restore_first)
    pp = F.col("_pp")
    counts = F.transform(pp, lambda x: F.when(x["small"], F.when(x["nonblank"], F.lit(1)).otherwise(F.lit(0)))
                         .otherwise(F.coalesce(F.size(x["starts"]), F.lit(0))).cast("bigint"))
    per_piece = F.arrays_zip(
        pp.alias("p"),
        carry_forward(F.transform(pp, lambda x: article_header(x["piece"], stem))).alias("carried"),
        exclusive_prefix_sum(counts).alias("offset"))
    # A document of very many pieces is one row with all its chunks instead of a row per piece.
    none = F.lit(None).cast("array<string>")
    rows = F.transform(per_piece, lambda z: F.struct(z["p"].alias("p"), z["carried"].alias("carried"), z["offset"].alias("offset"), none.alias("whole")))
    whole = F.array(F.struct(F.get(pp, 0).alias("p"), F.lit("").alias("carried"), F.lit(0).cast("bigint").alias("offset"), _all_chunks(pp, stem).alias("whole")))
    stage2 = stage1.select(*kc, F.explode(F.when(F.size(pp) > _MANY_PIECES, whole).otherwise(rows)).alias("z")).select(
        F.col("z.whole").alias("_whole"),
        *kc, F.col("z.p.piece").alias("_piece"), F.col("z.p.small").alias("_small"),
        F.col("z.p.nonblank").alias("_nonblank"), F.col("z.p.words").alias("_words"),
        F.col("z.p.starts").alias("_starts"), F.col("z.carried").alias("_carried"),
        F.col("z.offset").alias("_offset"))
    chunks = F.when(F.col("_whole").isNotNull(), F.col("_whole")).otherwise(
        _chunks_of_piece(F.col("_piece"), F.col("_small"), F.col("_nonblank"), F.col("_words"), F.col("_starts"), F.col("_carried")))
    out = stage2.select(*kc, "_offset", F.posexplode(chunks).alias("_k", "chunk"))
    return out.select(*kc, (F.col("_offset") + F.col("_k")).cast("bigint").alias("chunk_idx"), "chunk")


def split_documents_arrays(docs: DataFrame, text: str = "text", keys: list | None = None,
                           size: int = DEFAULT_SIZE, marker: str = DEFAULT_MARKER, stem: str = DEFAULT_STEM,
                           restore_first: bool = False) -> DataFrame:
    """T6 as the reference's split result: one row per document with
    ``chunks array<string>`` (e.g. ``(file_name, file_size, chunks)``).
    Narrow, no regrouping: the chunk array is built inside the row."""
    keys = keys or [c for c in docs.columns if c != text]
    kc = [F.col(k) for k in keys]
    stage1 = _piece_table(docs, text, kc, size, marker, stem, restore_first)
    pp = F.col("_pp")
    chunks = _all_chunks(pp, stem)
    return stage1.select(*kc, F.coalesce(chunks, F.array().cast("array<string>")).alias("chunks"))


def pieces_with_headers(docs: DataFrame, text: str = "text", keys: list | None = None,
                        marker: str = DEFAULT_MARKER, stem: str = DEFAULT_STEM) -> DataFrame:
    """T1-T3 exposed as rows: ``(*keys, piece_idx, piece, header, carried)``."""
    keys = keys or [c for c in docs.columns if c != text]
    stage1 = docs.select(*keys, split_at_marker(F.col(text), marker, stem).alias("_pieces"))
    pieces = F.col("_pieces")
    heads = F.transform(pieces, lambda p: article_header(p, stem))
    zipped = F.arrays_zip(pieces.alias("piece"), heads.alias("header"), carry_forward(heads).alias("carried"))
    return (stage1.select(*keys, F.posexplode(zipped).alias("piece_idx", "z"))
                  .select(*keys, F.col("piece_idx").cast("bigint").alias("piece_idx"),
                          F.col("z.piece").alias("piece"), F.col("z.header").alias("header"),
                          F.col("z.carried").alias("carried")))

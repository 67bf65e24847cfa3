"""Quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is a boolean expression over a document with a cost expression
(rough nanoseconds for that document). On a bounded sample the rules' costs
and verdicts are evaluated; the rules are then ordered greedily by rejections
per cost among the sample rows that the rules before them let through. The
order becomes one nested conditional, so a document pays only for the rules
up to its first rejection. The order never changes what is kept.

All features are expressions inside the row: no text is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

SPACE = " \t\n\x0b\f\r"
_SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000             # rows of the sample that orders the rules
SAMPLE_FRACTION = 0.05


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    return F.array_remove(F.split(text, _SPACES), "")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def lines(text: Column) -> Column:
    """Newline-separated lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text_lines: Column) -> Column:
    return (F.size(text_lines) - F.size(F.array_distinct(text_lines))).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_repeat_words(text_words: Column, width: int = 3) -> Column:
    """Words covered by runs of ``width`` words that occur twice or more in
    the text, the first occurrence included. Runs are told apart by a 64-bit
    hash of their words' hashes."""

    def covered(grams: Column) -> Column:
        # Sorted by hash, a repeated run is next to an equal one; back in text order, each run
        # covers up to the next one's start.
        def repeated(s: Column) -> Column:
            same = lambda x, y: F.coalesce(x["g"] == y["g"], F.lit(False))
            near = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
            return F.sort_array(F.transform(near, lambda x: x["i"]))

        def total(p: Column) -> Column:
            gaps = F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

        tagged = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        places = _let(tagged, repeated)
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(_let(places, total))

    def grams(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - (width - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, width)]))

    hashes = F.transform(text_words, lambda w: F.xxhash64(w))
    return _let(_let(hashes, grams), covered)


def upper_share(text: Column) -> Column:
    """Share of A-Z among A-Z and a-z (0 without letters)."""
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    lower = F.length(text) - F.length(F.translate(text, "abcdefghijklmnopqrstuvwxyz", ""))
    return F.coalesce(upper / F.nullif(upper + lower, F.lit(0)), F.lit(0.0))


@dataclass(frozen=True)
class Rule:
    """``fails`` rejects a document; ``cost`` estimates its nanoseconds."""

    name: str
    fails: Column
    cost: Column


def base_features(text: Column) -> dict[str, Column]:
    """The base features over ``words``, ``lines`` and ``body`` columns of :func:`prepared`."""
    return {
        "n_words": F.size("words").cast("long"),
        "word_chars": word_chars(text),
        "n_symbols": n_symbols(text),
        "n_dup_lines": n_dup_lines(F.col("lines")),
        "n_repeat_words": n_repeat_words(F.col("words")),
    }


def default_rules(ready: bool = False) -> list[Rule]:
    """The rules over a ``body`` column (text, null as empty). With ``ready``
    the base features are columns already and cost next to nothing."""
    body = F.col("body")
    chars, one = F.length(body).cast("double"), F.lit(5.0)
    own = words(body)
    n_words = F.col("n_words") if ready else F.size(own).cast("long")
    scan, cut = (one, one) if ready else (chars * 12, chars * 10)
    return [
        Rule("few_words", n_words < 50, cut),
        Rule("repeated_words", 100 * (F.col("n_repeat_words") if ready else n_repeat_words(own)) > 50 * n_words, one if ready else chars * 90),
        Rule("symbols", 10 * (F.col("n_symbols") if ready else n_symbols(body)) > n_words, scan + (one if ready else cut)),
        Rule("word_length", ~(F.col("word_chars") if ready else word_chars(body)).between(3 * n_words, 10 * n_words), scan + (one if ready else cut)),
        Rule("repeated_lines", 2 * (F.col("n_dup_lines") if ready else n_dup_lines(lines(body))) > F.size(lines(body)), chars * (4 if ready else 8)),
        Rule("upper_case", upper_share(body) > 0.3, chars * 24),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, fraction: float = SAMPLE_FRACTION) -> list[Rule]:
    """Rules by rejections per cost, estimated on at most ``sample_rows`` rows
    (a Bernoulli sample of the first partitions with rows). An empty sample
    leaves the given order."""
    flags = [F.struct(F.coalesce(r.fails, F.lit(True)).alias("f"), r.cost.alias("c")).alias(f"r{i}") for i, r in enumerate(rules)]
    rows = docs.sample(False, fraction, 17).select(*flags).limit(sample_rows).collect() or docs.select(*flags).limit(sample_rows).collect()
    left, ordered = list(range(len(rules))), []
    while left:
        def gain(i):
            cost = sum(row[i]["c"] for row in rows) + 1e-9
            return sum(row[i]["f"] for row in rows) / cost

        best = max(left, key=lambda i: (gain(i), -i))
        ordered.append(rules[best])
        left.remove(best)
        rows = [row for row in rows if not row[best]["f"]]
    return ordered


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, or null; later rules aren't evaluated."""
    verdict = None
    for r in rules:
        verdict = F.when(r.fails, F.lit(r.name)) if verdict is None else verdict.when(r.fails, F.lit(r.name))
    return verdict if verdict is not None else F.lit(None).cast("string")


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, verdict: str = "rejected_by") -> DataFrame:
    """``docs`` with the name of a rule that rejects each document in column
    ``verdict`` (null: kept).

    Null text counts as empty and fails ``few_words``. Rows are judged one by
    one, so repeated rows get equal answers; an empty table stays empty. All
    columns are kept; ``verdict`` must not be one of them.
    """
    if verdict in docs.columns:
        raise ValueError(f"{verdict} is a column of the input")
    rules = default_rules() if rules is None else rules
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ordered = order_rules(docs.select(body.alias("body")), rules)
    # The rules read a column named body, which the input may have as well.
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__qs_row"), body.alias("body"))
    return held.select("__qs_row", cascade(ordered).alias("__qs_verdict")).select("__qs_row.*", F.col("__qs_verdict").alias(verdict))


def quality_report(docs: DataFrame) -> DataFrame:
    """Base features and verdict: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept``, a row per row.

    ``base_failed``: fewer than 50 words, or over half of them in repeated
    three-word runs. ``kept``: not base_failed, and no rule of the cascade
    rejects. Null text is empty; a null ``doc_id`` stays null; an empty table
    gives an empty result; other columns are ignored.
    """
    src = documents(docs.sparkSession, docs).select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    ready = src.select("doc_id", "body", words(F.col("body")).alias("words"), lines(F.col("body")).alias("lines"))
    full = ready.select("doc_id", "body", *[c.alias(k) for k, c in base_features(F.col("body")).items()])
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rules = order_rules(full, [r for r in default_rules(ready=True) if r.name not in ("few_words", "repeated_words")])
    out = full.withColumn("base_failed", base)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(rules).isNull()).alias("kept"))

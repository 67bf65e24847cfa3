"""Chat-log export to per-day speaker runs.

Input messages have the columns ``pos`` (input order), ``type``, ``date``
(ISO text or a timestamp), ``sender`` and ``text`` (text after F7), and a
``has_plain`` flag. ``read_chat_export`` builds that table from chat-export
JSON; ``messages_from_table`` from any table.

Runs: messages are ordered by ``(date, pos)`` (a stable sort by date), grouped
by calendar day, and consecutive messages of one sender inside a day merge
into one line ``User: {sender} Msg: {texts joined by a space}``. The run
assignment cuts busy days into time ranges (see ``functions.runs``), so one
day is spread across many tasks; run texts are pre-aggregated map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pytext import py_strip
from ..functions.runs import assign_runs

UNKNOWN_USER = "Unknown User"
# ISO forms ``datetime.fromisoformat`` accepts for naive values.
ISO_NAIVE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?)?$"
ISO_OFFSET = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$"


def coerce_text(v: Column, default: str = "", join_char: str = " ") -> Column:
    """F7 on a VARIANT value: string -> stripped; list -> its string items
    stripped and joined (other items dropped), stripped; null -> default;
    boolean -> ``True``/``False``; other scalars -> their text, stripped."""
    kind = F.schema_of_variant(v)
    as_str = F.try_variant_get(v, "$", "string")
    items = F.try_variant_get(v, "$", "array<variant>")
    strings = F.transform(F.filter(items, lambda e: F.schema_of_variant(e) == "STRING"),
                          lambda e: py_strip(F.variant_get(e, "$", "string")))
    return (F.when(v.isNull() | kind.isin("NULL", "VOID"), F.lit(default))
             .when(kind == "STRING", py_strip(as_str))
             .when(kind.startswith("ARRAY"), py_strip(F.array_join(strings, join_char)))
             .when(kind == "BOOLEAN", F.when(F.variant_get(v, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")))
             .otherwise(py_strip(F.coalesce(as_str, F.to_json(v)))))


def parse_iso_date(s: Column, normalize_utc: bool = False) -> Column:
    """``datetime.fromisoformat``-compatible parse to TIMESTAMP_NTZ; NULL when
    the text would raise. Naive values are cast straight to TIMESTAMP_NTZ (no
    session time zone involved). Offsets are rejected unless
    ``normalize_utc``, which gives their UTC wall time."""
    s = s.cast("string")
    norm = F.regexp_replace(F.regexp_replace(s, " ", "T"), ",", ".")
    naive = F.when(s.rlike(ISO_NAIVE), norm.try_cast("timestamp_ntz"))
    if not normalize_utc:
        return naive
    from pyspark.sql import SparkSession
    tz = SparkSession.active().conf.get("spark.sql.session.timeZone")
    instant = norm.try_cast("timestamp")
    aware = F.when(s.rlike(ISO_OFFSET), F.convert_timezone(F.lit(tz), F.lit("UTC"), instant.cast("timestamp_ntz")))
    return F.coalesce(naive, aware)


def parse_messages(df: DataFrame, message: str = "m", keep: list | None = None,
                   normalize_utc: bool = False) -> DataFrame:
    """S2 + F7 per message: a VARIANT message object -> ``(type, date_text,
    date, sender, text, has_plain)`` (plus ``keep`` columns). Dates with a
    UTC offset are rejected (the reference could not sort them against naive
    ones) unless ``normalize_utc``, which converts them to UTC."""
    keep = keep or []
    m = F.col(message)
    ents = F.try_variant_get(m, "$.text_entities", "array<variant>")
    has_plain = F.coalesce(F.exists(ents, lambda e: F.try_variant_get(e, "$.type", "string") == "plain"), F.lit(False))
    sender_raw = F.variant_get(m, "$.from", "variant")
    sender = F.when(sender_raw.isNull(), F.lit(UNKNOWN_USER)).otherwise(coerce_text(sender_raw, UNKNOWN_USER))
    date_text = F.try_variant_get(m, "$.date", "string")
    return df.select(
        *keep,
        F.try_variant_get(m, "$.type", "string").alias("type"),
        date_text.alias("date_text"),
        parse_iso_date(date_text, normalize_utc).alias("date"),
        F.when(sender == "", F.lit(UNKNOWN_USER)).otherwise(sender).alias("sender"),
        F.coalesce(coerce_text(F.variant_get(m, "$.text", "variant")), F.lit("")).alias("text"),
        has_plain.alias("has_plain"))


_EXPORT = "messages array<variant>, _unreadable string"


def _export_files(spark: SparkSession, path: str) -> DataFrame:
    raw = (spark.read.schema(_EXPORT).option("multiLine", "true").option("columnNameOfCorruptRecord", "_unreadable")
           .json(path).select(F.col("_metadata.file_path").alias("file"), "messages", "_unreadable"))
    return raw.withColumn("error", F.when(F.col("_unreadable").isNotNull(), F.lit("invalid JSON"))
                          .when(F.col("messages").isNull(), F.lit("no messages list")))


def export_errors(spark: SparkSession, path: str) -> DataFrame:
    """``(file, error)`` of the export files that can't be used."""
    return _export_files(spark, path).where("error is not null").select("file", "error")


def read_chat_export(spark: SparkSession, path: str, normalize_utc: bool = False, skip_bad: bool = False) -> DataFrame:
    """S2 + F7: chat-export JSON files -> one row per message.

    Each file is one JSON object with a ``messages`` list, whose items are
    parsed one by one (only one message is bounded by the size of a VARIANT,
    not the file). An unreadable file or one without the list is an error;
    with ``skip_bad`` it yields no rows and :func:`export_errors` lists it.
    Multi-line JSON is not splittable: a large export should be several files.
    """
    raw = _export_files(spark, path)
    msgs = F.coalesce("messages", F.array().cast("array<variant>"))
    if not skip_bad:
        msgs = F.when(F.col("error").isNull(), msgs).otherwise(F.raise_error(F.concat("file", F.lit(": "), "error")))
    rows = raw.select("file", F.posexplode(msgs).alias("pos", "m"))
    rows = rows.withColumn("pos", F.col("pos").cast("bigint"))
    return parse_messages(rows, "m", keep=["file", "pos"], normalize_utc=normalize_utc)


def filter_messages(msgs: DataFrame) -> DataFrame:
    """type == message, non-empty text, at least one ``plain`` entity,
    a parseable date."""
    return msgs.filter((F.col("type") == "message") & (F.col("text") != "") & F.col("has_plain")
                       & F.col("date").isNotNull())


def sender_runs(msgs: DataFrame, partition_key: list[str] | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """``(day, run_idx, sender, n_msgs, text, first_pos)``.

    ``partition_key`` (e.g. the export file) keeps separate exports apart.
    ``num_partitions`` is the number of time ranges that split busy days
    (twice the shuffle partitions by default).
    """
    pk = partition_key or []
    base = msgs.select(*pk, "pos", "date", "sender", "text").withColumn("day", F.to_date("date"))
    n = num_partitions or 2 * int(msgs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = assign_runs(base, [*pk, "day"], "date", "pos", "sender", n)
    merged = runs.groupBy(*pk, "day", "run_idx").agg(
        F.min("sender").alias("sender"),
        F.count(F.lit(1)).cast("bigint").alias("n_msgs"),
        F.min("pos").alias("first_pos"),
        F.array_sort(F.collect_list(F.struct("date", "pos", "text"))).alias("_parts"))
    return merged.select(*pk, "day", "run_idx", "sender", "n_msgs",
                         F.array_join(F.transform("_parts", lambda p: p["text"]), " ").alias("text"), "first_pos")


def run_line(sender: Column, text: Column) -> Column:
    """C4: ``User: {u} Msg: {text}``."""
    return F.concat(F.lit("User: "), sender, F.lit(" Msg: "), text)


def day_file_lines(runs: DataFrame, partition_key: list[str] | None = None) -> DataFrame:
    """C4 / S7 rows: per day ``Date: YYYY-MM-DD``, a blank line, then one line
    per run; ``line_no`` orders them inside the day file."""
    pk = partition_key or []
    # A day's first run brings the two lines above it.
    head = F.array(F.struct(F.lit(0).cast("bigint").alias("line_no"), F.concat(F.lit("Date: "), F.date_format("day", "yyyy-MM-dd")).alias("line")),
                   F.struct(F.lit(1).cast("bigint").alias("line_no"), F.lit("").alias("line")))
    own = F.array(F.struct((F.col("run_idx") + 2).cast("bigint").alias("line_no"), run_line(F.col("sender"), F.col("text")).alias("line")))
    return runs.select(*pk, "day", F.inline(F.when(F.col("run_idx") == 0, F.concat(head, own)).otherwise(own)))


def counters(all_msgs: DataFrame, kept: DataFrame, runs: DataFrame) -> DataFrame:
    """Pipeline counters as ``(counter, value)`` rows: total messages,
    kept messages, days, runs; one pass over each of the three tables."""
    def rows(df, **aggs):
        one = df.agg(*[a.cast("bigint").alias(n) for n, a in aggs.items()])
        return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("counter"), F.col(n).alias("value")) for n in aggs])))
    return (rows(all_msgs, total_messages=F.count(F.lit(1))).unionByName(rows(kept, kept_messages=F.count(F.lit(1))))
            .unionByName(rows(runs, days=F.countDistinct("day"), runs=F.count(F.lit(1)))))


def runs_per_day(runs: DataFrame) -> DataFrame:
    """Runs per day."""
    return runs.groupBy("day").agg(F.count(F.lit(1)).cast("bigint").alias("runs"))

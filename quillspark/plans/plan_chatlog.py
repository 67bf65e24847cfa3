"""Chat-log queries (F4, C1-C5, S7 rows) over ``events``.

``events`` stands in for a chat export: ``event_id`` is the input position,
``ts`` the message date, the sender is ``user_id`` (few adjacent repeats) or
``event_type`` (many), the text is ``event_type`` / ``props``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chatlog as CL
from .registry import query, table


def _msgs(spark, sf, sender, text):
    ev = table(spark, sf, "events")
    return ev.select(F.col("event_id").cast("bigint").alias("pos"), F.lit("message").alias("type"),
                     F.col("ts").alias("date"), F.col(sender).cast("string").alias("sender"),
                     F.col(text).cast("string").alias("text"), F.lit(True).alias("has_plain"))


def _runs(spark, sf, sender, text):
    return CL.sender_runs(CL.filter_messages(_msgs(spark, sf, sender, text)))


def _out(runs):
    return runs.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("run_idx").cast("bigint"),
                       "sender", "n_msgs", "text")


def _runs_sql(sender, text):
    return f"""WITH e AS (SELECT event_id AS pos, ts, CAST(ts AS DATE) AS day, CAST({sender} AS VARCHAR) AS sender,
                CAST({text} AS VARCHAR) AS text FROM events),
f AS (SELECT *, CASE WHEN lag(sender) OVER (PARTITION BY day ORDER BY ts, pos) IS NOT DISTINCT FROM sender
      AND lag(pos) OVER (PARTITION BY day ORDER BY ts, pos) IS NOT NULL THEN 0 ELSE 1 END AS st FROM e),
r AS (SELECT *, sum(st) OVER (PARTITION BY day ORDER BY ts, pos ROWS UNBOUNDED PRECEDING) - 1 AS run_idx FROM f)"""


def _runs_select(sender, text):
    return _runs_sql(sender, text) + """
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(run_idx AS BIGINT) AS run_idx, any_value(sender) AS sender,
       CAST(count(*) AS BIGINT) AS n_msgs, string_agg(text, ' ' ORDER BY ts, pos) AS text
FROM r GROUP BY day, run_idx"""


@query("c3_runs_by_user", _runs_select("user_id", "event_type"), bench=True)
def c3_user(spark, sf):
    return _out(_runs(spark, sf, "user_id", "event_type"))


@query("c3_runs_by_type", _runs_select("event_type", "props"))
def c3_type(spark, sf):
    return _out(_runs(spark, sf, "event_type", "props"))


@query("c4_day_file_lines", _runs_sql("event_type", "props") + """,
runs AS (SELECT day, run_idx, any_value(sender) AS sender, string_agg(text, ' ' ORDER BY ts, pos) AS text
         FROM r GROUP BY day, run_idx)
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(0 AS BIGINT) AS line_no, 'Date: ' || strftime(day, '%Y-%m-%d') AS line
FROM (SELECT DISTINCT day FROM runs)
UNION ALL SELECT strftime(day, '%Y-%m-%d'), CAST(1 AS BIGINT), '' FROM (SELECT DISTINCT day FROM runs)
UNION ALL SELECT strftime(day, '%Y-%m-%d'), CAST(run_idx + 2 AS BIGINT), 'User: ' || sender || ' Msg: ' || text
FROM runs""")
def c4_lines(spark, sf):
    lines = CL.day_file_lines(_runs(spark, sf, "event_type", "props"))
    return lines.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "line_no", "line")


@query("c5_counters", _runs_sql("user_id", "event_type") + """
SELECT 'total_messages' AS counter, CAST(count(*) AS BIGINT) AS value FROM events
UNION ALL SELECT 'kept_messages', CAST(count(*) AS BIGINT) FROM e
UNION ALL SELECT 'days', CAST(count(DISTINCT day) AS BIGINT) FROM r
UNION ALL SELECT 'runs', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT day, run_idx FROM r)""")
def c5_counters(spark, sf):
    all_msgs = _msgs(spark, sf, "user_id", "event_type")
    kept = CL.filter_messages(all_msgs)
    return CL.counters(all_msgs, kept, CL.sender_runs(kept))


@query("c5_runs_per_day", _runs_sql("event_type", "props") + """
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(count(DISTINCT run_idx) AS BIGINT) AS runs FROM r GROUP BY day""")
def c5_per_day(spark, sf):
    return CL.runs_per_day(_runs(spark, sf, "event_type", "props")) \
             .select(F.date_format("day", "yyyy-MM-dd").alias("day"), "runs")


@query("c1_stable_date_order", """SELECT CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS rank,
       event_id AS pos, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events""")
def c1_order(spark, sf):
    from ..functions.indexing import drop_internal, with_global_index
    m = _msgs(spark, sf, "user_id", "event_type")
    ix = with_global_index(m.select("pos", "date"), ["date", "pos"], name="rank")
    return drop_internal(ix).select(F.col("rank").cast("bigint"), "pos",
                                    F.date_format(F.to_date("date"), "yyyy-MM-dd").alias("day"))


def _event_messages(spark, sf):
    """Each event as a chat-export message object (JSON text -> VARIANT): a
    numeric sender, a text list mixing padded strings and an entity object,
    a ``link``-only entity list for ``error`` events, ISO date text."""
    ev = table(spark, sf, "events")
    ents = F.when(F.col("event_type") == "error", F.array(F.struct(F.lit("link").alias("type")))) \
            .otherwise(F.array(F.struct(F.lit("plain").alias("type")), F.struct(F.lit("link").alias("type"))))
    head = F.to_json(F.struct(F.lit("message").alias("type"),
                              F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
                              F.col("user_id").alias("from"), ents.alias("text_entities")))
    props = F.to_json(F.array("props"))                      # ["<escaped props>"]
    text = F.concat(F.lit('[" '), F.col("event_type"), F.lit(' ", {"type": "link"}, '),
                    F.substring(props, 2, F.length(props) - 2), F.lit("]"))
    js = F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(', "text": '), text, F.lit("}"))
    return ev.select(F.col("event_id").cast("bigint").alias("pos"), F.parse_json(js).alias("m"))


@query("s2_f4_f7_parse_export_messages", """SELECT CAST(event_id AS BIGINT) AS pos, CAST(user_id AS VARCHAR) AS sender,
  event_type || ' ' || trim(props) AS text, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS date_text
  FROM events WHERE event_type <> 'error'""")
def s2_parse(spark, sf):
    msgs = CL.filter_messages(CL.parse_messages(_event_messages(spark, sf), "m", keep=["pos"]))
    return msgs.select("pos", "sender", "text", "date_text")

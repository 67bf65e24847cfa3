"""QA queries (S3 text form, F5, Q1-Q4) over ``conversations``.

Each conversation becomes one QA "file": every user turn followed by an
assistant turn gives a block ``Вопрос: {user}\\nОтвет: {assistant}``, blocks
joined by a blank line. The ``lower`` variant writes the marks in lower case
(as the generation prompts ask), which passes the case-insensitive presence
test and then fails the case-sensitive split.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.pytext import PY_WS
from ..operators import qa as QA
from .registry import query, table


def qa_files(spark, sf, lower: bool = False):
    conv = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    nxt = conv.select("conv_id", "turn", "role", "text",
                      F.lead("role").over(w).alias("nrole"), F.lead("text").over(w).alias("ntext"))
    qm, am = ("вопрос:", "ответ:") if lower else (QA.Q_MARK, QA.A_MARK)
    pairs = nxt.filter((F.col("role") == "user") & (F.col("nrole") == "assistant")).select(
        "conv_id", "turn", F.concat(F.lit(qm + " "), "text", F.lit("\n" + am + " "), "ntext").alias("block"))
    files = pairs.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "block"))).alias("_b"))
    return files.select(F.col("conv_id").cast("bigint").alias("conv_id"),
                        F.array_join(F.transform("_b", lambda x: x["block"]), "\n\n").alias("text"))


def qa_blocks(spark, sf, lower=False):
    return QA.blocks(qa_files(spark, sf, lower), keys=["conv_id"])


def _strip(x):
    return f"regexp_replace({x}, '\\A{PY_WS}+|{PY_WS}+\\z', '', 'g')"


def files_sql(lower=False):
    qm, am = ("вопрос:", "ответ:") if lower else ("Вопрос:", "Ответ:")
    return f"""c AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS nrole, lead(text) OVER w AS ntext
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (SELECT conv_id, turn, '{qm} ' || text || '\n{am} ' || ntext AS block
      FROM c WHERE role = 'user' AND nrole = 'assistant'),
f AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, string_agg(block, '\n\n' ORDER BY turn) AS text FROM p GROUP BY conv_id),
s AS (SELECT conv_id, string_split({_strip('text')}, '\n\n') AS bl FROM f),
b AS (SELECT conv_id, CAST(unnest(generate_series(0, len(bl) - 1)) AS BIGINT) AS block_idx,
             {_strip('unnest(bl)')} AS block FROM s)"""


def _pairs_sql(lower=False, ignore_case=False):
    split = ("regexp_split_to_array(block, '(?i)\nОтвет:')" if ignore_case
             else "string_split(block, '\nОтвет:')")
    return f"""WITH {files_sql(lower)},
k AS (SELECT conv_id, block_idx, block, {split} AS parts FROM b
      WHERE regexp_matches(block, 'Вопрос:', 'i') AND regexp_matches(block, '\nОтвет:', 'i'))
"""


Q1_SQL = _pairs_sql() + f"""SELECT conv_id, block_idx, {_strip("replace(parts[1], '\"', '')")} AS question,
  'Ответ: ' || {_strip("replace(parts[2], '\"', '')")} AS answer FROM k WHERE len(parts) >= 2"""


@query("q1_qa_pairs", Q1_SQL, bench=True)
def q1(spark, sf):
    return QA.qa_pairs(qa_blocks(spark, sf))


@query("q1_qa_pairs_ignore_case", _pairs_sql(lower=True, ignore_case=True) + f"""SELECT conv_id, block_idx,
  {_strip("replace(parts[1], '\"', '')")} AS question,
  'Ответ: ' || {_strip("replace(parts[2], '\"', '')")} AS answer FROM k WHERE len(parts) >= 2""")
def q1_ci(spark, sf):
    return QA.qa_pairs(qa_blocks(spark, sf, lower=True), ignore_case=True)


@query("q2_qa_messages", _pairs_sql() + f""", m AS (SELECT conv_id, block_idx,
  {_strip("replace(parts[1], 'Вопрос:', '')")} AS q, {_strip("replace(parts[2], 'Ответ:', '')")} AS a
  FROM k WHERE len(parts) >= 2)
SELECT conv_id, block_idx, CAST(0 AS BIGINT) AS msg_idx, 'user' AS role, q AS content FROM m
UNION ALL SELECT conv_id, block_idx, CAST(1 AS BIGINT), 'assistant', a FROM m""")
def q2(spark, sf):
    msgs = QA.qa_messages(qa_blocks(spark, sf))
    return msgs.select("conv_id", "block_idx", F.posexplode("messages").alias("msg_idx", "m")).select(
        "conv_id", "block_idx", F.col("msg_idx").cast("bigint"), F.col("m.role").alias("role"),
        F.col("m.content").alias("content"))


@query("q3_training_text", "SELECT conv_id, block_idx, '<s>' || question || '</s><s>' || answer || '</s>' AS text "
                           "FROM (" + Q1_SQL + ")")
def q3(spark, sf):
    p = QA.qa_pairs(qa_blocks(spark, sf))
    return p.select("conv_id", "block_idx", QA.training_text("question", "answer").alias("text"))


@query("f5_block_filter", f"""WITH {files_sql(False)}, b2 AS (SELECT * FROM b),
x AS (SELECT 'upper' AS variant, * FROM b2)
SELECT variant, conv_id, block_idx,
  regexp_matches(block, 'Вопрос:', 'i') AND regexp_matches(block, '\nОтвет:', 'i') AS marks_present,
  len(string_split(block, '\nОтвет:')) >= 2 AS split_ok FROM x
UNION ALL
SELECT * FROM (WITH {files_sql(True)}
  SELECT 'lower', conv_id, block_idx,
  regexp_matches(block, 'Вопрос:', 'i') AND regexp_matches(block, '\nОтвет:', 'i'),
  len(string_split(block, '\nОтвет:')) >= 2 FROM b)""")
def f5(spark, sf):
    out = []
    for variant, lower in (("upper", False), ("lower", True)):
        b = qa_blocks(spark, sf, lower)
        out.append(b.select(F.lit(variant).alias("variant"), "conv_id", "block_idx",
                            QA.has_marks("block").alias("marks_present"),
                            (F.size(QA.answer_parts("block")) >= 2).alias("split_ok")))
    return out[0].unionByName(out[1])


@query("q4_collapse_blank_line", """WITH c AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS nrole,
  lead(text) OVER w AS ntext FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn,
  regexp_replace('question: ' || text || '\n\nanswer: ' || ntext, '(?i)(question:[^\n]+?\n)\n(answer:[^\n]+?)',
                 '\\1\\2', 'g') AS text
FROM c WHERE role = 'user' AND nrole = 'assistant'""")
def q4(spark, sf):
    conv = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    nxt = conv.select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("nrole"),
                      F.lead("text").over(w).alias("ntext"))
    pairs = nxt.filter((F.col("role") == "user") & (F.col("nrole") == "assistant"))
    raw = F.concat(F.lit("question: "), "text", F.lit("\n\nanswer: "), "ntext")
    return pairs.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                        QA.collapse_blank_line(raw).alias("text"))

"""Generation lineage queries (S4, S5, S6 rows, F1-F3, P1-P6).

The store is built from ``documents`` (file ``doc_{id}.txt``) and their law
chunks (T6). The responder is a deterministic local function (a stand-in for
a model client) over the prompt and the whole text, with word counts as
token counts; it is written in SQL too, so the oracle can replay a run.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions.indexing import stored_table
from ..functions.pytext import PY_WS
from ..operators import generate as G
from ..sources import sinks as S
from . import plan_chunking as PC
from .registry import query, table

PROVIDER, MODEL = "local", "echo-1"
PROMPT_A = "Задай вопросы к статье и ответь на них."
PROMPT_B = "Ask questions about the article."
LIMIT = 2
_W = "[^" + PY_WS[1:] + "+"


def responder(texts: pd.Series, variant: dict) -> pd.DataFrame:
    answers = [f"Вопрос: {variant['prompt']} {t}\nОтвет: {len(t)}" for t in texts]
    return pd.DataFrame({"answer": answers,
                         "input_tokens": [len(t.split()) for t in texts],
                         "output_tokens": [len(a.split()) for a in answers]})


def store(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt")).alias("file_name"),
        F.col("n_chars").cast("bigint").alias("size"))
    rows = PC.t6_split_law(spark, sf).withColumn("file_name", F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")))
    # As in the ingest flow, the chunk table is stored once and then read.
    return docs, stored_table(G.chunks_table(rows), "chunks")


def empty_answers(spark):
    # Spark sees that it is empty, so no answer is shuffled to be held against it.
    return spark.createDataFrame([], "chunk_id string, variant_id string, answer string, input_tokens bigint, "
                                     "output_tokens bigint").where(F.lit(False))


def variant(spark, prompt=PROMPT_A):
    vid = spark.range(1).select(G.variant_id(F.lit(MODEL), F.lit(prompt)).alias("v")).first()["v"]
    return {"variant_id": vid, "provider": PROVIDER, "model": MODEL, "prompt": prompt}


def first_run(spark, sf, limit=LIMIT):
    """A run over the first ``limit`` chunks of each document (F2), or over all."""
    docs, chunks = store(spark, sf)
    v = variant(spark)
    todo = G.first_pending(chunks, empty_answers(spark), limit, v["variant_id"])
    return docs, chunks, v["variant_id"], G.generate_answers(todo, v, responder, calls_per_period=None)


# ----------------------------------------------------------------- SQL side

VID_SQL = f"'{MODEL}-' || sha256('{PROMPT_A}')"
STORE_SQL = f"""docs AS (SELECT 'doc_' || doc_id || '.txt' AS file_name, CAST(n_chars AS BIGINT) AS size FROM documents),
ch AS (SELECT 'doc_' || doc_id || '.txt' AS file_name, chunk_idx,
       sha256('doc_' || doc_id || '.txt' || '#' || chunk_idx) AS chunk_id, chunk AS text
       FROM ({PC._split_sql(PC.LAW_SQL, PC.C.DEFAULT_MARKER, PC.C.DEFAULT_STEM)})),
todo AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY chunk_idx) <= {LIMIT}),
"""


def _answers_sql(source, prompt, name):
    return f"""{name}0 AS (SELECT chunk_id, '{MODEL}-' || sha256('{prompt}') AS variant_id,
        'Вопрос: {prompt} ' || text || '\nОтвет: ' || length(text) AS answer,
        CAST(len(regexp_extract_all(text, '{_W}')) AS BIGINT) AS input_tokens FROM {source}),
{name} AS (SELECT *, CAST(len(regexp_extract_all(answer, '{_W}')) AS BIGINT) AS output_tokens FROM {name}0)"""


ALL_SQL = STORE_SQL + _answers_sql("ch", PROMPT_A, "answers")
STORE_SQL += _answers_sql("todo", PROMPT_A, "answers") + """,
pending AS (SELECT * FROM ch WHERE chunk_id NOT IN (SELECT chunk_id FROM answers))"""


@query("p1_generate_answers", f"""WITH {ALL_SQL}
SELECT chunk_id, variant_id, answer, input_tokens, output_tokens, CAST(NULL AS VARCHAR) AS error FROM answers""",
       bench=True)
def p1(spark, sf):
    return first_run(spark, sf, None)[3]


@query("f1_documents_with_pending", f"WITH {STORE_SQL} SELECT DISTINCT file_name FROM pending")
def f1(spark, sf):
    _, chunks, vid, new = first_run(spark, sf)
    answers = G.record_answers(empty_answers(spark), new)
    return G.documents_with_pending(chunks, answers, vid)


@query("f2_next_pending_batch", f"""WITH {STORE_SQL}
SELECT file_name, chunk_idx, chunk_id FROM pending
QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY chunk_idx) <= {LIMIT}""")
def f2(spark, sf):
    _, chunks, vid, new = first_run(spark, sf)
    answers = G.record_answers(empty_answers(spark), new)
    return G.first_pending(chunks, answers, LIMIT, vid).select("file_name", "chunk_idx", "chunk_id")


@query("f3_fully_processed", f"""WITH {STORE_SQL}
SELECT file_name FROM docs WHERE file_name NOT IN (SELECT file_name FROM pending)""")
def f3(spark, sf):
    docs, chunks, vid, new = first_run(spark, sf)
    answers = G.record_answers(empty_answers(spark), new)
    return G.fully_processed(docs, chunks, answers, vid).select("file_name")


@query("p3_record_resume", f"""WITH {ALL_SQL}
SELECT variant_id, CAST(count(*) AS BIGINT) AS answers FROM answers GROUP BY variant_id""")
def p3(spark, sf):
    new = stored_table(first_run(spark, sf, None)[3], "run")     # read by both runs' records
    once = G.record_answers(empty_answers(spark), new)
    twice = G.record_answers(once, new)      # resumed run: nothing is added twice
    return twice.groupBy("variant_id").agg(F.count(F.lit(1)).cast("bigint").alias("answers"))


VARIANTS = "file_name string, variant_idx bigint, variant_id string, provider string, model string, prompt string"


def _variants(spark, sf):
    """Documents in mixed states: those labelled quality 1 have the variant of
    the first prompt, toxic ones also (or only) that of the second."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left") \
        .select(F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("file_name"), "quality", "toxic")
    empty = spark.createDataFrame([], VARIANTS)
    v1 = G.upsert_variants(empty, G.resolve_variant(empty, docs.where("quality = 1"), PROVIDER, MODEL, PROMPT_A))
    return docs.select("file_name"), G.upsert_variants(v1, G.resolve_variant(v1, docs.where("toxic = 1"), PROVIDER, MODEL, PROMPT_B))


_STATE = """st AS (SELECT 'doc_' || d.doc_id || '.txt' AS file_name, coalesce(l.quality = 1, false) AS a, coalesce(l.toxic = 1, false) AS b
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


@query("p4_resolve_variant", f"""WITH {_STATE}
SELECT file_name, CAST(CASE WHEN a THEN 0 WHEN b THEN 1 ELSE 0 END AS BIGINT) AS variant_idx, NOT a AS is_new, {VID_SQL} AS variant_id FROM st
UNION ALL SELECT file_name, CAST(CASE WHEN a THEN 1 ELSE 0 END AS BIGINT), NOT b, '{MODEL}-' || sha256('{PROMPT_B}') FROM st""")
def p4(spark, sf):
    docs, have = _variants(spark, sf)
    first = G.resolve_variant(have, docs, PROVIDER, MODEL, PROMPT_A)
    second = G.resolve_variant(have, docs, PROVIDER, MODEL, PROMPT_B)
    return first.unionByName(second).select("file_name", "variant_idx", "is_new", "variant_id")


@query("p5_next_variant_number", f"""WITH {_STATE}
SELECT file_name, CAST(1 + CAST(a AS INTEGER) + CAST(b AS INTEGER) AS BIGINT) AS next_variant FROM st""")
def p5(spark, sf):
    docs, have = _variants(spark, sf)
    return G.next_variant_number(have, docs)


@query("p6_variant_id", """SELECT DISTINCT role AS model, text AS prompt, role || '-' || sha256(text) AS variant_id FROM conversations""")
def p6(spark, sf):
    turns = table(spark, sf, "conversations").select(F.col("role").alias("model"), F.col("text").alias("prompt")).distinct()
    return turns.withColumn("variant_id", G.variant_id("model", "prompt"))


@query("s4_insert_if_absent", """SELECT 'doc_' || doc_id || '.txt' AS file_name FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def s4(spark, sf):
    docs = table(spark, sf, "documents")
    existing = docs.join(table(spark, sf, "labels"), "doc_id", "left_semi")
    name = F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt")).alias("file_name")
    batch = docs.select(name, "text").unionByName(docs.select(name, "text"))   # duplicates inside the batch
    return S.insert_if_absent(existing.select(name), batch).select("file_name")


@query("s5_export_chunk_texts", f"WITH {ALL_SQL} SELECT chunk_idx, text FROM ch WHERE file_name = (SELECT max(file_name) FROM ch)")
def s5(spark, sf):
    _, chunks = store(spark, sf)
    return G.export_document_texts(chunks, chunks.agg(F.max("file_name")).first()[0])


@query("s5_export_all_chunk_texts", f"WITH {ALL_SQL} SELECT file_name, chunk_idx, text FROM ch")
def s5_all(spark, sf):
    _, chunks = store(spark, sf)
    return G.export_document_texts(chunks)


@query("s6_export_rows", f"""WITH {ALL_SQL}, {_STATE}, {_answers_sql("(SELECT ch.* FROM ch JOIN st USING (file_name) WHERE b)", PROMPT_B, "second")},
r AS (SELECT regexp_extract(c.file_name, '^(.*)\\.[^.]*$', 1) || CASE WHEN st.b THEN '_variant_0' ELSE '' END || '.txt' AS output_name, c.chunk_idx, x.answer
      FROM answers x JOIN ch c USING (chunk_id) JOIN st ON st.file_name = c.file_name
      UNION ALL SELECT regexp_extract(c.file_name, '^(.*)\\.[^.]*$', 1) || '_variant_1.txt', c.chunk_idx, x.answer FROM second x JOIN ch c USING (chunk_id))
SELECT output_name, CAST(chunk_idx * 2 AS BIGINT) AS line_no, answer AS line FROM r
UNION ALL SELECT output_name, CAST(chunk_idx * 2 + 1 AS BIGINT), '' FROM r""")
def s6(spark, sf):
    """Every document is answered under the first prompt, toxic ones also under the second."""
    docs, chunks, vid, new = first_run(spark, sf, None)
    toxic = table(spark, sf, "labels").where("toxic = 1").select(F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("file_name"))
    other = G.generate_answers(chunks.join(toxic, "file_name", "left_semi"), variant(spark, PROMPT_B), responder)
    # Both runs are written once: the records and each consumer below read them.
    new, other = stored_table(new, "first-run"), stored_table(other, "second-run")
    answers = G.record_answers(G.record_answers(empty_answers(spark), new), other)
    empty = spark.createDataFrame([], VARIANTS)
    variants = G.upsert_variants(empty, G.resolve_variant(empty, docs, PROVIDER, MODEL, PROMPT_A))
    variants = G.upsert_variants(variants, G.resolve_variant(variants, docs.join(toxic, "file_name", "left_semi"), PROVIDER, MODEL, PROMPT_B))
    full = G.fully_processed(docs, chunks, answers, vid)
    return S.variant_export_lines(docs, variants, answers, chunks, full)

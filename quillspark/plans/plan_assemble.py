"""Dataset assembly queries.

The dataset is the reference's two-source set: QA training texts (Q3) plus
the chunk texts of the split documents (S5 over T6), ``(source, id, text)``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble as A
from ..operators import qa as QA
from . import plan_chunking as PC
from . import plan_qa as PQ
from ..functions.indexing import stored_table
from ..session import checkpoint_dir
from .registry import query, table

V, MAXLEN, BATCH = 32000, 1024, 16


def qa_text(spark, sf):
    p = QA.qa_pairs(PQ.qa_blocks(spark, sf))
    return p.select(F.lit("qa").alias("source"),
                    F.concat(F.lit("qa-"), "conv_id", F.lit("-"), "block_idx").alias("id"),
                    QA.training_text("question", "answer").alias("text"))


def chunk_text(spark, sf):
    c = PC.t6_split_law(spark, sf)
    return c.select(F.lit("chunks").alias("source"),
                    F.concat(F.lit("doc-"), "doc_id", F.lit("-"), "chunk_idx").alias("id"),
                    F.col("chunk").alias("text"))


def dataset(spark, sf):
    checkpoint_dir(spark)
    return A.union_datasets(qa_text(spark, sf), chunk_text(spark, sf))


Q3_SQL = "SELECT conv_id, block_idx, '<s>' || question || '</s><s>' || answer || '</s>' AS text FROM (" + PQ.Q1_SQL + ")"
T6_SQL = PC._split_sql(PC.LAW_SQL, "\nСтат", "Стат")
DS_SQL = (f"SELECT 'qa' AS source, 'qa-' || conv_id || '-' || block_idx AS id, text FROM ({Q3_SQL}) "
          f"UNION ALL SELECT 'chunks', 'doc-' || doc_id || '-' || chunk_idx, chunk FROM ({T6_SQL})")
WITH_DS = f"WITH ds AS ({DS_SQL})\n"


@query("d1_union_sources", WITH_DS + "SELECT source, CAST(count(*) AS BIGINT) AS rows FROM ds GROUP BY source")
def d1(spark, sf):
    return dataset(spark, sf).groupBy("source").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@query("d3_split_hash", WITH_DS + f"""SELECT id, CASE WHEN substr(md5('42|' || id), 1, 8) < '{A.hash_fraction_prefix(0.05)}'
  THEN 'test' ELSE 'train' END AS split FROM ds""")
def d3_hash(spark, sf):
    return A.split_hash(dataset(spark, sf), ["id"], 0.05, 42).select("id", "split")


@query("d3_split_exact", WITH_DS + """SELECT id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || id), id) - 1
  < ceil(0.05 * (SELECT count(*) FROM ds)) THEN 'test' ELSE 'train' END AS split FROM ds""", bench=True)
def d3_exact(spark, sf):
    ids = stored_table(dataset(spark, sf).select("id"), "dataset-ids")       # the splitter runs once
    return A.split_exact(ids, ["id"], 0.05, 42).select("id", "split")


@query("d4_seeded_shuffle", WITH_DS + """SELECT CAST(row_number() OVER (ORDER BY md5('3407|' || id), id) - 1 AS BIGINT)
  AS rank, id FROM ds""")
def d4(spark, sf):
    ids = dataset(spark, sf).select("id")
    return A.seeded_order(ids, ["id"], 3407).select(F.col("rank").cast("bigint"), "id")


_SPEC = "('<unk>', '<s>', '</s>')"
ENC_SQL = WITH_DS + f""", t AS (SELECT id, unnest(regexp_extract_all(text, '{A.TOKEN_RE}')) AS token,
  unnest(generate_series(0, len(regexp_extract_all(text, '{A.TOKEN_RE}')) - 1)) AS pos FROM ds),
cnt AS (SELECT token, count(*) AS n FROM t WHERE token NOT IN {_SPEC} GROUP BY token),
v AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 + 3 AS INTEGER) AS tid FROM cnt
      QUALIFY row_number() OVER (ORDER BY n DESC, token) <= {V}
      UNION ALL SELECT '<unk>', 0 UNION ALL SELECT '<s>', 1 UNION ALL SELECT '</s>', 2),
e AS (SELECT t.id, pos, coalesce(v.tid, 0) AS tid FROM t LEFT JOIN v USING (token) WHERE pos < {MAXLEN}),
g AS (SELECT id, list(tid ORDER BY pos) AS ids FROM e GROUP BY id),
enc AS (SELECT ds.id, CAST(coalesce(len(g.ids), 0) AS BIGINT) AS length,
  trim(coalesce(array_to_string(g.ids, ' '), '') || repeat(' 2', {MAXLEN} - coalesce(len(g.ids), 0))) AS input_ids,
  trim(coalesce(array_to_string(g.ids, ' '), '') || repeat(' -100', {MAXLEN} - coalesce(len(g.ids), 0))) AS labels
  FROM ds LEFT JOIN g USING (id))
"""


def vocabulary_and_texts(spark, sf):
    """Both from a stored dataset, so the splitter runs once."""
    ds = stored_table(dataset(spark, sf).select("id", "text"), "dataset")
    return A.build_vocab(ds, "text", V), ds


@query("d5_encode", ENC_SQL + "SELECT id, length, input_ids, labels FROM enc", bench=True)
def d5(spark, sf):
    vocab, ds = vocabulary_and_texts(spark, sf)
    e = A.encode(ds, "text", ["id"], vocab, MAXLEN, mask_padding=True)
    return e.select("id", "length", F.array_join("input_ids", " ").alias("input_ids"),
                    F.array_join("labels", " ").alias("labels"))


@query("d6_batch_padding", ENC_SQL + f""", r AS (SELECT ds.id, coalesce(g.ids, []) AS ids,
  row_number() OVER (ORDER BY md5('3407|' || ds.id), ds.id) - 1 AS rank FROM ds LEFT JOIN g USING (id)),
b AS (SELECT id, ids, CAST(floor(rank / {BATCH}) AS BIGINT) AS batch FROM r),
w AS (SELECT id, ids, batch, CAST(ceil(max(len(ids)) OVER (PARTITION BY batch) / 8) * 8 AS BIGINT) AS padded_len FROM b)
SELECT id, batch, padded_len, trim(array_to_string(ids, ' ') || repeat(' 2', CAST(padded_len - len(ids) AS INTEGER))) AS input_ids,
  trim(array_to_string(ids, ' ') || repeat(' -100', CAST(padded_len - len(ids) AS INTEGER))) AS labels FROM w""")
def d6(spark, sf):
    vocab, ds = vocabulary_and_texts(spark, sf)
    encoded = stored_table(A.encode_ids(ds, "text", ["id"], vocab, MAXLEN).select("id", "ids"), "encoded")
    ranked = stored_table(A.seeded_order(encoded, ["id"], 3407), "ranked")
    out = A.batch_padding(ranked, "rank", "ids", BATCH)
    return out.select("id", "batch", "padded_len", F.array_join("input_ids", " ").alias("input_ids"), F.array_join("labels", " ").alias("labels"))


@query("d7_median_length", WITH_DS + "SELECT source, CAST(median(length(text)) AS DOUBLE) AS median_length "
                                     "FROM ds GROUP BY source")
def d7(spark, sf):
    return A.median_length(dataset(spark, sf), "text", ["source"])


@query("d8_max_encoded_length", WITH_DS + f"SELECT CAST(max(len(regexp_extract_all(text, '{A.TOKEN_RE}'))) AS BIGINT) AS max_length FROM ds")
def d8(spark, sf):
    """Before the cut, so that it says which limit is needed."""
    return A.max_encoded_length(dataset(spark, sf).select(A.tokenize("text").alias("tokens")), "tokens")


@query("d9_length_classes", f"""SELECT CASE WHEN length(answer) > 1000 THEN 'more_than_1000'
  WHEN length(answer) >= 500 THEN '500_to_1000' ELSE 'less_than_500' END AS length_class,
  CAST(count(*) AS BIGINT) AS n FROM ({PQ.Q1_SQL}) GROUP BY 1""")
def d9(spark, sf):
    return A.length_classes(QA.qa_pairs(PQ.qa_blocks(spark, sf)), "answer")


F6_SQL = f"SELECT * FROM ({PQ.Q1_SQL}) WHERE length(question) <= 1500 AND length(answer) <= 4000"


def _hist_sql(src, column, stage):
    return f"""SELECT '{stage}' AS stage, CAST(least(floor((length({column}) - lo) * 50 / greatest(hi - lo, 1)), 49) AS BIGINT) AS bin,
  CAST(count(*) AS BIGINT) AS n FROM ({src}), (SELECT min(length({column})) AS lo, max(length({column})) AS hi FROM ({src}))
  GROUP BY 1, 2"""


_STEP1_SQL = f"SELECT * FROM ({PQ.Q1_SQL}) WHERE length(question) <= 1500"


@query("d10_length_histograms", " UNION ALL ".join([
    _hist_sql(PQ.Q1_SQL, "question", "context_before"), _hist_sql(_STEP1_SQL, "question", "context_after"),
    _hist_sql(_STEP1_SQL, "answer", "response_before"), _hist_sql(F6_SQL, "answer", "response_after")]))
def d10(spark, sf):
    """The four histograms: context before and after its filter, response of
    what is left before and after its own."""
    pairs = QA.qa_pairs(PQ.qa_blocks(spark, sf))
    first = pairs.where(F.length("question") <= 1500)
    both = A.cascade_length_filters(pairs, "question", "answer")
    stages = [("context_before", pairs, "question"), ("context_after", first, "question"),
              ("response_before", first, "answer"), ("response_after", both, "answer")]
    out = None
    for name, df, column in stages:
        h = A.length_histogram(df, column).select(F.lit(name).alias("stage"), "bin", "n")
        out = h if out is None else out.unionByName(h)
    return out


@query("f6_length_filters", "SELECT conv_id, block_idx FROM (" + F6_SQL.replace(
    "length(question) <= 1500", "length(question) <= 300").replace("length(answer) <= 4000", "length(answer) <= 1200") + ")")
def f6(spark, sf):
    pairs = QA.qa_pairs(PQ.qa_blocks(spark, sf))
    return A.cascade_length_filters(pairs, "question", "answer", 300, 1200).select("conv_id", "block_idx")


@query("d11_step_counts", WITH_DS + f"""SELECT 'qa_pairs' AS step, CAST(count(*) AS BIGINT) AS rows FROM ({PQ.Q1_SQL})
UNION ALL SELECT 'dataset', CAST(count(*) AS BIGINT) FROM ds
UNION ALL SELECT 'test', CAST(ceil(0.05 * count(*)) AS BIGINT) FROM ds
UNION ALL SELECT 'train', CAST(count(*) - ceil(0.05 * count(*)) AS BIGINT) FROM ds""")
def d11(spark, sf):
    pairs = QA.qa_pairs(PQ.qa_blocks(spark, sf))
    ds = stored_table(dataset(spark, sf).select("id"), "dataset-ids")        # the splitter runs once for all steps
    sp = A.split_exact(ds, ["id"], 0.05, 42)
    return A.step_counts({"qa_pairs": pairs, "dataset": ds, "test": sp.filter(F.col("split") == "test"),
                          "train": sp.filter(F.col("split") == "train")})


@query("f8_rename_drop", f"SELECT conv_id, question AS instruction, answer AS output FROM ({PQ.Q1_SQL})")
def f8(spark, sf):
    pairs = QA.qa_pairs(PQ.qa_blocks(spark, sf))
    return A.rename_drop(pairs, {"question": "instruction", "answer": "output"}, ["block_idx"])


@query("d2_side_by_side", """WITH a AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS pos FROM customer),
b AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS pos FROM part)
SELECT c_custkey, c_name, p_partkey, p_name FROM a JOIN b USING (pos)""")
def d2(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_name")
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return A.side_by_side(cust, ["c_custkey"], part, ["p_partkey"])

"""Evaluation queries.

``embeddings`` rows are positions: the vector is the logits over 64 ids and
``label`` the gold id. ``labels.quality`` against ``n_chars > 1000`` of the
joined documents is a second, binary evaluation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from .registry import query, table

_LOGITS = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"
_ARGMAX = "CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER)"
_CE = (f"(list_max({_LOGITS}) + ln(list_sum(list_transform({_LOGITS}, lambda v: exp(v - list_max({_LOGITS}))))) "
       f"- {_LOGITS}[label + 1])")


def _positions(spark, sf):
    emb = table(spark, sf, "embeddings")
    return emb.select("vec_id", F.col("embedding").alias("logits"), "label") \
              .filter(F.col("label") != E.IGNORE).withColumn("pred", E.argmax("logits"))


@query("e1_argmax", f"SELECT vec_id, {_ARGMAX} AS pred FROM embeddings")
def e1(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", E.argmax("embedding").alias("pred"))


@query("e5_cross_entropy", f"SELECT vec_id, round({_CE}, 6) AS ce FROM embeddings WHERE label <> -100")
def e5(spark, sf):
    p = _positions(spark, sf)
    return p.select("vec_id", F.round(E.cross_entropy("logits", "label"), 6).alias("ce"))


def _metrics_sql(src, with_ce):
    ce = f"round(avg({_CE}), 6) FROM s" if with_ce else "CAST(NULL AS DOUBLE)"
    return f"""WITH s AS ({src}),
pairs AS (SELECT label AS y, pred AS p, count(*) AS n FROM s GROUP BY 1, 2),
a AS (SELECT y AS c, sum(n) AS ap, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM pairs GROUP BY 1),
pp AS (SELECT p AS c, sum(n) AS pp FROM pairs GROUP BY 1),
per AS (SELECT coalesce(tp, 0) AS tp, coalesce(ap, 0) AS ap, coalesce(pp, 0) AS pp FROM a FULL OUTER JOIN pp USING (c)),
prf AS (SELECT avg(CASE WHEN pp > 0 THEN tp / pp ELSE 0 END) AS pr, avg(CASE WHEN ap > 0 THEN tp / ap ELSE 0 END) AS rc,
        avg(CASE WHEN pp + ap > 0 THEN 2 * tp / (pp + ap) ELSE 0 END) AS f1 FROM per)
SELECT 'eval_token_accuracy' AS metric, round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS value FROM s
UNION ALL SELECT 'eval_precision', round(pr, 6) FROM prf
UNION ALL SELECT 'eval_recall', round(rc, 6) FROM prf
UNION ALL SELECT 'eval_f1', round(f1, 6) FROM prf
UNION ALL SELECT 'eval_ce_loss', {ce}"""


@query("e6_metrics_embeddings", _metrics_sql(
    f"SELECT embedding, label, {_ARGMAX} AS pred FROM embeddings WHERE label <> -100", True))
def e6_emb(spark, sf):
    return E.metrics_row(_positions(spark, sf), logits="logits", digits=6)


@query("e3_e4_metrics_quality", _metrics_sql(
    "SELECT l.quality AS label, CAST(d.n_chars > 1000 AS INTEGER) AS pred FROM labels l JOIN documents d USING (doc_id)",
    False))
def e34(spark, sf):
    lab = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    preds = lab.join(docs, "doc_id").select(F.col("quality").alias("label"),
                                            (F.col("n_chars") > 1000).cast("int").alias("pred"))
    return E.metrics_row(preds, logits=None, digits=6)


SEQ = 8


def masked_sequences(spark, sf):
    """Eval batches in the trainer's shape: consecutive ``embeddings`` rows
    form sequences of ``SEQ`` positions (``logits array<array<float>>``,
    ``labels array<int>``), with ``-100`` at both ends of every sequence."""
    emb = table(spark, sf, "embeddings")
    seq = F.floor(F.col("vec_id") / SEQ).cast("bigint")
    rows = emb.select(seq.alias("seq_id"), (F.col("vec_id") - seq * SEQ).alias("pos"), "embedding", "label")
    packed = rows.groupBy("seq_id").agg(F.array_sort(F.collect_list(F.struct("pos", "embedding", "label"))).alias("_p"))
    n = F.size("_p")
    labels = F.transform("_p", lambda x, i: F.when((i == 0) | (i == n - 1), F.lit(E.IGNORE)).otherwise(x["label"]))
    return packed.select("seq_id", F.transform("_p", lambda x: x["embedding"]).alias("logits"), labels.alias("labels"))


_MASKED_SRC = f"""SELECT vec_id // {SEQ} AS seq_id, vec_id - (vec_id // {SEQ}) * {SEQ} AS pos, embedding, label,
  row_number() OVER (PARTITION BY vec_id // {SEQ} ORDER BY vec_id) AS rn,
  count(*) OVER (PARTITION BY vec_id // {SEQ}) AS n FROM embeddings"""


@query("e2_masked_positions", f"""SELECT CAST(seq_id AS BIGINT) AS seq_id, CAST(rn - 1 AS INTEGER) AS pos,
  {_ARGMAX} AS pred, label FROM ({_MASKED_SRC}) WHERE rn > 1 AND rn < n""")
def e2(spark, sf):
    pos = E.with_predictions(E.positions(masked_sequences(spark, sf), keys=["seq_id"]))
    return pos.select("seq_id", F.col("pos").cast("int"), "pred", "label")


@query("e2_e6_metrics_masked", _metrics_sql(
    f"SELECT embedding, label, {_ARGMAX} AS pred FROM ({_MASKED_SRC}) WHERE rn > 1 AND rn < n", True))
def e2_metrics(spark, sf):
    pos = E.with_predictions(E.positions(masked_sequences(spark, sf), keys=["seq_id"]))
    return E.metrics_row(pos, digits=6)

"""Token-prediction evaluation (E1-E6) as DataFrame aggregates.

Input is either sequences ``(row_id, logits array<array<float>>, labels
array<int>)`` or already flat positions ``(logits array<float>, label int)``.
``-100`` labels are ignored. Predictions and labels are compared position by
position (no shift, as in the reference; ``shift=True`` compares logits at t
with the label at t+1).

Macro precision / recall / F1 average over every class present in the labels
or the predictions, with 0 where a ratio is undefined; F1 is per class, then
averaged. Cross-entropy is computed from the logits (the reference passes
arg-max ids instead, which makes its value meaningless).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IGNORE = -100
METRIC_NAMES = ("eval_token_accuracy", "eval_precision", "eval_recall", "eval_f1", "eval_ce_loss")


def argmax(logits) -> Column:
    """Index of the first maximum."""
    x = F.col(logits) if isinstance(logits, str) else logits
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def cross_entropy(logits, label) -> Column:
    """E5 per position: ``logsumexp(x) - x[label]``."""
    x = F.col(logits) if isinstance(logits, str) else logits
    y = F.col(label) if isinstance(label, str) else label
    xd = F.transform(x, lambda v: v.cast("double"))
    m = F.array_max(xd)
    lse = m + F.log(F.aggregate(xd, F.lit(0.0).cast("double"), lambda acc, v: acc + F.exp(v - m)))
    return lse - F.get(xd, y)


def positions(seqs: DataFrame, logits: str = "logits", labels: str = "labels", keys: list | None = None,
              shift: bool = False) -> DataFrame:
    """One row per unmasked position ``(*keys, pos, logits, label)``."""
    keys = keys or []
    lab = F.col(labels)
    if shift:
        lab = F.slice(lab, 2, F.greatest(F.size(lab), F.lit(1)))
    z = F.arrays_zip(F.col(logits).alias("logits"), lab.alias("label"))
    exploded = seqs.select(*keys, F.posexplode(z).alias("pos", "z"))
    flat = exploded.select(*keys, "pos", F.col("z.logits").alias("logits"), F.col("z.label").alias("label"))
    return flat.filter(F.col("label").isNotNull() & F.col("logits").isNotNull() & (F.col("label") != IGNORE))


def with_predictions(pos: DataFrame, logits: str = "logits") -> DataFrame:
    return pos.withColumn("pred", argmax(logits))


def accuracy(preds: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """E3."""
    return preds.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("eval_token_accuracy"))


def macro_prf(preds: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """Macro precision, recall, F1 over the union of classes."""
    pairs = preds.groupBy(F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    actual = pairs.groupBy(F.col("y").alias("c")).agg(
        F.sum("n").alias("ap"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    predicted = pairs.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("pp"))
    per = actual.join(predicted, "c", "full_outer").select(
        F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("ap", F.lit(0)).alias("ap"),
        F.coalesce("pp", F.lit(0)).alias("pp"))
    prec = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0)
    rec = F.when(F.col("ap") > 0, F.col("tp") / F.col("ap")).otherwise(0.0)
    f1 = F.when(2 * F.col("tp") + (F.col("pp") - F.col("tp")) + (F.col("ap") - F.col("tp")) > 0,
                2 * F.col("tp") / (F.col("pp") + F.col("ap"))).otherwise(0.0)
    return per.agg(F.avg(prec).alias("eval_precision"), F.avg(rec).alias("eval_recall"),
                   F.avg(f1).alias("eval_f1"))


def metrics_row(preds: DataFrame, pred: str = "pred", label: str = "label",
                logits: str | None = "logits", digits: int | None = None) -> DataFrame:
    """The five named metrics as ``(metric, value)`` rows, in one pass:
    counts and loss per (label, prediction), then per class, then one row."""
    ce = F.sum(cross_entropy(logits, label)) if logits else F.lit(None).cast("double")
    pairs = preds.groupBy(F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"), ce.alias("ce"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(F.struct(F.col("y").alias("c"), F.col("n").alias("ap"), F.lit(0).cast("bigint").alias("pp"), hit.cast("bigint").alias("tp"), F.col("ce").alias("ce")),
                    F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("ap"), F.col("n").alias("pp"), F.lit(0).cast("bigint").alias("tp"), F.lit(None).cast("double").alias("ce")))
    per = pairs.select(F.inline(sides)).groupBy("c").agg(*[F.sum(x).alias(x) for x in ("ap", "pp", "tp", "ce")])
    prec = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0)
    rec = F.when(F.col("ap") > 0, F.col("tp") / F.col("ap")).otherwise(0.0)
    f1 = F.when(F.col("pp") + F.col("ap") > 0, 2 * F.col("tp") / (F.col("pp") + F.col("ap"))).otherwise(0.0)
    one = per.agg((F.sum("tp") / F.sum("ap")).alias("eval_token_accuracy"), F.avg(prec).alias("eval_precision"), F.avg(rec).alias("eval_recall"),
                  F.avg(f1).alias("eval_f1"), (F.sum("ce") / F.sum("ap")).alias("eval_ce_loss"))
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), rnd(F.col(m)).alias("value")) for m in one.columns])
    return one.select(F.inline(rows))

"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled texts (a bounded sample of each) are turned
into features in the tasks that read them; the driver fits an additive model
by minimising the non-negative unbiased risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with the logistic loss, where R_p and R_u are mean losses over positives and
unlabelled texts and ``prior`` is the share of positives among the unlabelled
texts, estimated from the two samples alone: no negative label is read. The
model is a few hundred numbers; documents are scored where they are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import documents, prepare

MAX_POSITIVES = 8000           # bound of the trusted positives that are fitted
MAX_UNLABELLED = 16000         # bound of the unlabelled texts that are fitted
HELD_OUT = 2                   # remainder of the rows whose labels are never read
BINS = 12
THRESHOLD = 0.7

_SYMBOLS, _UPPER, _LOWER, _DIGIT, _BANG, _BAR, _MARKS = range(7)
_CLASS = np.full(256, 255, np.uint8)
for _chars, _c in (("#*$%&<>", _SYMBOLS), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("abcdefghijklmnopqrstuvwxyz", _LOWER),
                   ("0123456789", _DIGIT), ("!", _BANG), ("|", _BAR), (".,;:?'\"()-", _MARKS)):
    _CLASS[[ord(x) for x in _chars]] = _c
FEATURES = ["log_words", "word_bytes", "word_bytes_sd", "short_words", "long_words", "symbols", "upper", "digits", "bangs", "bars",
            "marks", "distinct_words", "top_word", "distinct_trigrams", "repeated_lines", "lines"]


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text (zeros for a text without words)."""
    out = np.zeros((len(texts), len(FEATURES)), np.float32)
    for lo, hi in ts.slices(texts):
        part = texts.slice(lo, hi - lo)
        u, li = ts.cut(part), ts.cut_lines(part)
        h, lh = u.hashes(), li.hashes()
        tri = ts.ngrams(h, 3)
        n = u.counts()
        _, offs = ts._bytes(part)
        kind = _CLASS[u.data[:-8]]
        count = np.zeros((hi - lo, 7))
        for c in range(7):
            total = np.concatenate([[0], np.cumsum(kind == c)])
            count[:, c] = total[offs[1:]] - total[offs[:-1]]
        size = (u.end - u.start).astype(np.float64)
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (size, size * size, size <= 3, size >= 12)]
        a, b = u.first[:-1], u.first[1:]
        m = np.maximum(n, 1)
        mean = (sums[0][b] - sums[0][a]) / m
        o = out[lo:hi]
        o[:, 0] = np.log1p(n)
        o[:, 1] = mean
        o[:, 2] = np.sqrt(np.maximum((sums[1][b] - sums[1][a]) / m - mean * mean, 0))
        o[:, 3] = (sums[2][b] - sums[2][a]) / m
        o[:, 4] = (sums[3][b] - sums[3][a]) / m
        letters = np.maximum(count[:, _UPPER] + count[:, _LOWER], 1)
        o[:, 5] = count[:, _SYMBOLS] / m
        o[:, 6] = count[:, _UPPER] / letters
        o[:, 7] = count[:, _DIGIT] / np.maximum(np.diff(offs), 1)
        o[:, 8] = count[:, _BANG] / m
        o[:, 9] = count[:, _BAR] / m
        o[:, 10] = count[:, _MARKS] / m
        for i in range(hi - lo):
            if n[i]:
                _, times = np.unique(h[a[i]:b[i]], return_counts=True)
                o[i, 11] = len(times) / n[i]
                o[i, 12] = times.max() / n[i]
                grams = tri[a[i]:max(b[i] - 2, a[i])]
                o[i, 13] = len(np.unique(grams)) / len(grams) if len(grams) else 1.0
                own = lh[li.first[i]:li.first[i + 1]]
                o[i, 14] = 1 - len(np.unique(own)) / max(len(own), 1)
                o[i, 15] = len(own) / n[i]
    return out


@dataclass(frozen=True)
class Model:
    """Additive model: a weight for the bin that each feature falls into."""

    edges: tuple
    weights: np.ndarray
    bias: float
    prior: float

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x[:, [j]] > np.asarray(e, np.float32)[None, :] for j, e in enumerate(self.edges)], axis=1).astype(np.float32)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (self.design(x) * self.weights).sum(axis=1) + self.bias     # row by row: equal texts score alike in any batch
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _half(ids: np.ndarray) -> np.ndarray:
    """Which half a document falls into, in either sample."""
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)


def class_prior(positives: np.ndarray, unlabelled: np.ndarray, in_half: np.ndarray, out_half: np.ndarray, delta: float = 0.1, steps: int = 300) -> float:
    """The share of positives among the unlabelled texts, by the best bin: one
    half of each sample (``in_half`` and ``out_half`` are 0 or 1 by row) fits a
    model that tells positives from unlabelled texts, and the other half is
    ranked by it. Above any score the share of the
    unlabelled texts over that of the positives is at least the prior, and it
    comes down to it where no negative scores as high; the least such ratio,
    counting an error bound that holds with ``1 - delta``, is taken. The mean
    over both halves; 0.5 where a half would have no row."""
    found = []
    for turn in (0, 1):
        p, q = positives[in_half == turn], positives[in_half != turn]
        u, v = unlabelled[out_half == turn], unlabelled[out_half != turn]
        if not len(p) or not len(q) or not len(u) or not len(v):
            return 0.5
        model = fit(p, u, 0.5, steps=steps, contrast=True)
        sq, sv = np.sort(model.scores(q)), np.sort(model.scores(v))
        above_q = 1 - np.searchsorted(sq, sq) / len(sq)             # share of the positives at or above each of their scores
        above_v = 1 - np.searchsorted(sv, sq) / len(sv)
        error = np.sqrt(np.log(4 / delta) / 2 / len(sv)) + np.sqrt(np.log(4 / delta) / 2 / len(sq))
        best = np.argmin((above_v + error) / above_q)
        found.append(above_v[best] / above_q[best])
    return float(min(np.mean(found), 1.0))


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05, ridge: float = 2e-4,
        contrast: bool = False) -> Model:
    """Minimises the non-negative PU risk by full-batch Adam steps; with
    ``contrast`` the plain risk R_p(+1) + R_u(-1) of telling positives from
    unlabelled texts. With no positives or no unlabelled texts every score is
    the prior."""
    prior = float(min(max(prior, 0.01), 0.99))
    base = float(np.log(prior / (1 - prior)))
    everything = np.concatenate([positives, unlabelled])
    # Bin edges: quantiles, and finer ones in the tails.
    at = np.unique(np.concatenate([np.linspace(0, 1, BINS + 1)[1:-1], [0.01, 0.03, 0.97, 0.99]]))
    edges = tuple(tuple(np.unique(np.quantile(everything[:, j], at)).tolist()) if len(everything) else () for j in range(len(FEATURES)))
    model = Model(edges, np.zeros(sum(map(len, edges))), base, prior)
    if not len(positives) or not len(unlabelled):
        return model
    xp, xu = model.design(positives), model.design(unlabelled)
    w, b = np.zeros(xp.shape[1]), base
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    for t in range(1, steps + 1):
        w32 = w.astype(np.float32)                                 # one precision for the large products
        zp, zu = (xp @ w32).astype(np.float64) + b, (xu @ w32).astype(np.float64) + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        dp = -prior * sigmoid(-zp) / len(zp)                       # prior * R_p(+1)
        up, un = sigmoid(zu) / len(zu), -prior * sigmoid(zp) / len(zp)
        # Below zero the bracket is overfitted: step back along it.
        gp, gu = (dp + un, up) if negative >= 0 else (-un, -up)
        if contrast:
            gp, gu = -sigmoid(-zp) / len(zp), up
        g = np.concatenate([gp.astype(np.float32) @ xp + gu.astype(np.float32) @ xu + ridge * w, [gp.sum() + gu.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(edges, w, float(b), prior)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never read; a null id has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def _featurise(batches):
    for batch in batches:
        x = features(ts.plain(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))],
            names=["doc_id", "positive", "th", "x"])


def learn(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Fits on at most ``max_positives`` documents labelled 1 and
    ``max_unlabelled`` documents taken whatever their label, all outside the
    held-out rows, chosen by a hash of their id. The prior is estimated from
    these two samples (:func:`class_prior`); rows labelled 0 only withdraw the
    trust in a document that repeated rows label differently. Of texts that
    share an id the one with the least hash is fitted."""
    src = documents(docs.sparkSession, docs)
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    order = F.xxhash64(F.col("doc_id"), F.lit("fit"))

    def picked(ids: DataFrame, n: int) -> DataFrame:
        return ids.select("doc_id").distinct().orderBy(order, "doc_id").limit(n)

    pos = picked(marks.where("quality = 1"), max_positives).withColumn("positive", F.lit(True))
    rest = picked(src.where("doc_id is not null").where(~held_out(F.col("doc_id"))), max_unlabelled).withColumn("positive", F.lit(False))
    # At most max_positives + max_unlabelled ids.
    wanted = F.broadcast(pos.unionByName(rest))
    rows = (src.join(wanted, "doc_id").select("doc_id", "text", "positive", F.xxhash64("text").alias("th"))
            .mapInArrow(_featurise, "doc_id bigint, positive boolean, th bigint, x array<float>")
            .groupBy("doc_id", "positive").agg(F.min(F.struct("th", "x")).alias("least")).select("doc_id", "positive", "least.x").toArrow())
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)) if rows.num_rows else np.zeros((0, len(FEATURES)), np.float32)
    positive = rows["positive"].to_numpy(zero_copy_only=False).astype(bool) if rows.num_rows else np.zeros(0, bool)
    ids = rows["doc_id"].to_numpy() if rows.num_rows else np.zeros(0, np.int64)
    turn = np.argsort(ids, kind="stable")
    x, positive, half = x[turn], positive[turn], _half(ids[turn])
    return fit(x[positive], x[~positive], class_prior(x[positive], x[~positive], half[positive], half[~positive]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, th, score`` of every row (``th``: hash of the text)."""
    def run(batches):
        for batch in batches:
            s = model.scores(features(ts.plain(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(s, pa.float64())], names=["doc_id", "th", "score"])

    return (documents(docs.sparkSession, docs).withColumn("th", F.xxhash64("text"))
            .mapInArrow(run, "doc_id bigint, th bigint, score double"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per row of ``docs``.

    Scores read nothing but the text, a very long one as a whole. Null and empty texts get the score of a
    text without words. Repeated rows get equal scores; empty tables are
    allowed on both sides (without labels every score is about the prior);
    other columns are ignored.
    """
    out = score(docs, learn(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose score reaches ``threshold``, all columns kept;
    scored where they are read, without a shuffle."""
    prepare(docs.sparkSession)
    model = learn(docs, labels)

    at = docs.columns.index("text")

    def good(batches):
        for batch in batches:
            texts = ts.plain(batch.column(at))
            yield batch.filter(pa.array(model.scores(features(texts)) >= threshold))

    return docs.mapInArrow(good, docs.schema)
